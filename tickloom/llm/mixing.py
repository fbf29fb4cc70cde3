"""Mixing sources by temperature.

Shares of tokens per source are raised to an exponent and normalised. The exponent is
found by bisection: the largest that reaches a target entropy, or the smallest that
repeats no document more than allowed. Weights become token budgets; a budget is
filled by whole passes over a source and a part of one more, and every pass is a
permutation in blocks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import free_name, stored, words_of

#: The exponent is a multiple of 2**-GRID_BITS, so that every run finds the same.
GRID_BITS = 20
ROUND_BITS = 4
BLOCK_TOKENS = 1_000_000
#: Blocks grow with the corpus, so that a source has about this many at most.
MOST_BLOCKS = 100_000
MAX_REPEATS = 2.0


@dataclass(frozen=True)
class Mix:
    """How to mix: a limit on passes or a target entropy (of 1 for equal weights).

    ``budget`` is in tokens. Without one it is the smallest that takes every document
    at least once, so that no source is cut.
    """

    max_repeats: float | None = MAX_REPEATS
    entropy: float | None = None
    budget: int | None = None
    block_tokens: int = BLOCK_TOKENS
    seed: int = 0


def _evaluate(totals: DataFrame, tokens: float, exponents: list[float]) -> list[tuple]:
    """Entropy and the span of passes at each exponent, in one aggregate."""
    p = F.col("tokens") / F.lit(tokens)
    sums = []
    for e in exponents:
        w = F.pow(p, F.lit(e))
        sums += [F.sum(w), F.sum(w * F.log(p)), F.min(w / p), F.max(w / p)]
    row = totals.agg(*(s.alias(f"s{i}") for i, s in enumerate(sums))).first()
    out = []
    for i, e in enumerate(exponents):
        z, weighted, least, most = row[4 * i : 4 * i + 4]
        out.append((math.log(z) - e * weighted / z, least / z, most / z))
    return out


def find_exponent(totals: DataFrame, mix: Mix) -> tuple[float, float, int]:
    """The exponent, the sum of shares raised to it, and the budget in tokens.

    ``totals`` has one row per source with ``tokens`` over 0. Only sums over sources
    reach the driver; each round takes sixteen parts of the interval in one job.
    """
    first = totals.agg(F.sum("tokens"), F.count("*")).first()
    if not first[1]:
        return 1.0, 1.0, 0
    tokens, sources = float(first[0]), first[1]

    def fits(found: tuple) -> bool:
        entropy, least, most = found
        if mix.entropy is not None:
            return entropy >= mix.entropy * math.log(sources) - 1e-12
        budget = 1 / least if mix.budget is None else mix.budget / tokens
        return most * budget <= (mix.max_repeats or math.inf) * (1 + 1e-12)

    # Raising the exponent lowers the entropy and the repeats. For an entropy the
    # last grid point that fits is wanted, for repeats the first.
    grid = 1 << GRID_BITS
    low, high = 0, grid
    last = mix.entropy is not None
    while high - low > 0:
        step = max(1, (high - low) >> ROUND_BITS)
        points = sorted({*range(low, high, step), high})
        good = [fits(x) for x in _evaluate(totals, tokens, [k / grid for k in points])]
        if last:
            i = max((i for i, g in enumerate(good) if g), default=0)
            low, high = points[i], points[min(i + 1, len(points) - 1)]
            if high - low <= 1:
                high = low = high if good[min(i + 1, len(points) - 1)] else low
        else:
            i = min((i for i, g in enumerate(good) if g), default=len(points) - 1)
            low, high = points[max(i - 1, 0)], points[i]
            if high - low <= 1:
                low = high = low if good[max(i - 1, 0)] else high
    alpha = low / grid
    _, least, _ = _evaluate(totals, tokens, [alpha])[0]
    z = totals.agg(F.sum(F.pow(F.col("tokens") / F.lit(tokens), F.lit(alpha)))).first()[0]
    budget = round(tokens / least) if mix.budget is None else mix.budget
    return alpha, z, budget


def _key(*parts) -> Column:
    return F.xxhash64(*(p if isinstance(p, Column) else F.lit(p) for p in parts))


def plan_sources(slim: DataFrame, mix: Mix) -> DataFrame:
    """One row per source: weight, passes, blocks, and where its last pass ends.

    ``slim`` has id, source and tokens and is read a few times: store it first. Other
    columns are not looked at.
    """
    slim = slim.select("id", "source", "tokens")
    totals = stored(
        slim.groupBy("source").agg(
            F.sum("tokens").alias("tokens"), F.count("*").alias("rows")
        ),
        "source_totals",
    )
    counted = totals.where("tokens > 0")
    alpha, z, budget = find_exponent(counted, mix)
    whole = counted.agg(F.sum("tokens")).first()[0] or 0
    size = max(mix.block_tokens, math.ceil(whole / MOST_BLOCKS))
    share = F.col("tokens") / F.lit(float(max(whole, 1)))
    weight = F.when(F.col("tokens") > 0, F.pow(share, F.lit(alpha)) / F.lit(z)).otherwise(0.0)
    # Sources without a token cost nothing and are taken once.
    target = F.when(F.col("tokens") > 0, F.rint(F.col("weight") * F.lit(float(budget))).cast("long"))
    sources = (
        totals.withColumn("weight", weight)
        .withColumn("target", target)
        .withColumn("full", F.coalesce(F.floor(F.col("target") / F.col("tokens")), F.lit(1)).cast("int"))
        .withColumn("rest", F.coalesce(F.col("target") - F.col("full") * F.col("tokens"), F.lit(0)))
        .withColumn("blocks", F.greatest(F.ceil(F.col("tokens") / F.lit(size)), F.lit(1)).cast("int"))
    )
    # The part pass: whole blocks in the order of their keys, then single documents.
    open_sources = sources.where("rest > 0").select(
        F.col("source").alias("_source"), "full", "rest", "blocks"
    )
    drawn = slim.join(open_sources, F.col("source").eqNullSafe(F.col("_source")))
    part = stored(
        drawn.withColumns(_place(F.col("full"), F.col("id"), F.col("source"), F.col("blocks"), mix)).select(
            "source", "tokens", "rest", "block", "block_key", "doc_key"
        ),
        "part_pass",
    )
    run = Window.partitionBy("source").orderBy("block_key", "block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    blocks = (
        part.groupBy("source", "block", "block_key", "rest")
        .agg(F.sum("tokens").alias("block_sum"))
        .withColumn("before", F.coalesce(F.sum("block_sum").over(run), F.lit(0)))
    )
    # The block that the budget ends in; block_sum may be 0 before it.
    ends = blocks.where("before <= rest AND before + block_sum > rest").select(
        F.col("source").alias("_source"), F.col("block").alias("_block"),
        F.col("block_key").alias("cut_block"), (F.col("rest") - F.col("before")).alias("room"),
    )
    inside = part.join(
        ends,
        part["source"].eqNullSafe(ends["_source"]) & (part["block"] == ends["_block"]),
    )
    sums = Window.partitionBy("_source").orderBy("doc_key")
    fit = inside.withColumn("sum", F.sum("tokens").over(sums)).where("sum <= room")
    cuts = ends.join(
        fit.groupBy(F.col("_source").alias("_s")).agg(F.max("doc_key").alias("cut_doc")),
        F.col("_source").eqNullSafe(F.col("_s")),
        "left",
    ).select("_source", "cut_block", "cut_doc")
    return stored(
        sources.join(cuts, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source", "rows"),
        "mix_plan",
    )


#: Columns that ``mix_rows`` adds.
DRAWN = ("weight", "pass", "block", "block_key", "doc_key")


def _place(number: Column, row_id: Column, source: Column, blocks: Column, mix: Mix) -> dict[str, Column]:
    """Block and order keys of a document in a pass."""
    block = F.pmod(_key(mix.seed, number, row_id), blocks).cast("int")
    return {
        "block": block,
        "block_key": _key(mix.seed + 1, number, source, block),
        "doc_key": _key(mix.seed + 2, number, row_id),
    }


def mix_rows(
    docs: DataFrame, plan: DataFrame, mix: Mix, row_id: str = "doc_id", source: str = "source"
) -> DataFrame:
    """Every draw of every document: its columns, pass, block, block_key, doc_key.

    The mixed order is that of (block_key, doc_key): whole blocks of all sources and
    passes interleave. The plan has one row per source; it is broadcast only while
    its written size allows, and joined by source beyond. A null source is a source
    of its own. Equal rows are drawn alike. An empty table gives none. Columns may have
    any names; those of the input named as one of ``DRAWN`` are replaced.
    """
    own_id, own_source = free_name(docs, "_id"), free_name(docs, "_src")
    rows = docs.withColumns({own_id: F.col(row_id), own_source: F.col(source)}).drop(*DRAWN)
    figures = ("source", "full", "blocks", "cut_block", "cut_doc", "rest")
    named = {n: free_name(docs, f"_plan_{n}") for n in figures}
    known, full, blocks, cut_block, cut_doc, rest = (F.col(n) for n in named.values())
    chosen = plan.select(*(F.col(n).alias(x) for n, x in named.items()), "weight")
    joined = rows.join(chosen, F.col(own_source).eqNullSafe(known)).withColumn(
        "pass", F.explode(F.sequence(F.lit(0), full))
    )
    number = F.col("pass")
    joined = joined.withColumns(_place(number, F.col(own_id), F.col(own_source), blocks, mix))
    before = cut_block.isNull() | (F.col("block_key") < cut_block)
    at = (F.col("block_key") == cut_block) & (F.col("doc_key") <= cut_doc)
    inside = (number < full) | ((rest > 0) & (before | F.coalesce(at, F.lit(False))))
    return joined.where(inside).drop(own_id, own_source, *named.values())


def slim_rows(docs: DataFrame, row_id: str = "doc_id", source: str = "source", text: str = "text"):
    """What planning needs of documents: id, source and words."""
    return docs.select(
        F.col(row_id).alias("id"), F.col(source).alias("source"), F.size(words_of(F.col(text))).cast("long").alias("tokens")
    )

