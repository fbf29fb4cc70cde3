import pyarrow as pa
from pyspark.sql import functions as F

from tickloom.llm.blocks import grouped_pairs


def test_block_pairs_of_one_key_are_many_tasks(spark):
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    try:
        rows = spark.range(2000).select(F.lit(1).alias("key"), "id")

        def task(table: pa.Table) -> pa.Table:
            from pyspark import TaskContext

            return pa.table({"part": pa.array([TaskContext.get().partitionId()], pa.int64())})

        found = grouped_pairs(rows, "key", "id").applyInArrow(task, "part bigint").collect()
    finally:
        spark.conf.unset(name)
    # Eight blocks meet each other and themselves.
    assert len(found) == 8 * 9 // 2
    assert len({r.part for r in found}) > 1
