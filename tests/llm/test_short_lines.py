from tickloom.llm import line_edits


def test_own_short_lines_outlive_a_repeated_one(spark):
    licence = "this text may be copied by anyone who keeps this very line"
    poem = "\n".join(f"verse {i} is short" for i in range(40))
    rows = [(1, licence), (2, f"{poem}\n{licence}"), (3, f"A title\n{licence}")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    gone = line_edits.repeated_lines(docs)
    left = {r.doc_id: r.text for r in line_edits.remaining(docs, gone).collect()}
    assert left == {1: licence, 2: poem}
