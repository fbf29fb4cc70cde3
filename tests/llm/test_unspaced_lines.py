from tickloom.llm import line_edits


def test_long_lines_without_blanks_are_compared(spark):
    line = "".join(chr(0x4E00 + 37 * i % 5000) for i in range(300))
    near = line[:100] + "x" + line[101:]
    rows = [(1, line), (2, line), (3, near), (4, line[:20]), (5, line[:20])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {(r.doc, r.near) for r in line_edits.repeated_lines(docs).collect()}
    assert got == {(2, False), (3, True)}
