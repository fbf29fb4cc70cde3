"""The stages of the pipeline on small tables: edge cases, clashing names, copies."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tickloom.llm import line_edits

STAGES = dict(corpus_pipeline.STAGES)
#: Names that the operators use for columns of their own.
CLASHES = (
    "weight", "blocks", "full", "rest", "_src", "pass", "block", "_gone", "gone", "_doc", "_kept",
    "_measures", "_host", "n_words", "kept", "host_rejected", "base_failed", "id", "known", "body", "row",
)
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = [f"w{i}" for i in range(300)]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def documents(spark, texts, ids=None):
    rows = [(i, t, "en", ["a", "b", None][k % 3], 0) for k, (i, t) in
            enumerate(zip(ids or range(len(texts)), texts))]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(2)
    base = sentence(rng, 60)
    texts = [None, "", " \n\t", "tie", base, base, sentence(rng, 4000), base + "\n" + sentence(rng, 50),
             *(sentence(rng, 40) for _ in range(20)), "no id"]
    docs = documents(spark, texts, [*range(len(texts) - 1), None])
    return docs.unionByName(docs.where("doc_id = 6"))


@pytest.mark.parametrize("name", list(STAGES))
def test_clashing_columns_come_through(spark, odd, name):
    clashing = odd.withColumns({c: F.lit(f"own {c}") for c in CLASHES})
    out = STAGES[name](spark, clashing, "")
    plain = STAGES[name](spark, odd, "")
    if name == "token_ids":
        assert out.columns == plain.columns
    else:
        assert out.columns == clashing.columns
        for c in CLASHES:
            assert [r[0] for r in out.select(f"`{c}`").distinct().collect()] in ([f"own {c}"], [])
    both = [sorted(map(str, (r.doc_id for r in x.select("doc_id").collect()))) for x in (out, plain)]
    assert both[0] == both[1]


@pytest.mark.parametrize("name", list(STAGES))
def test_empty_tables_stay_empty(spark, odd, name):
    assert STAGES[name](spark, odd.limit(0), "").collect() == []


def test_null_and_repeated_rows(spark, odd):
    ids = lambda name: sorted(str(r.doc_id) for r in STAGES[name](spark, odd, "").collect())
    assert not {"0", "1", "2", "3"} & set(ids("quality_rules"))
    kept = ids("line_dedup")
    assert {"0", "1", "2", "3", "None", "4"} <= set(kept) and "5" not in kept and kept.count("6") == 2
    kept = ids("near_dedup")
    assert {"0", "1", "2", "None", "4"} <= set(kept) and "5" not in kept and kept.count("6") == 2
    assert ids("token_ids") == sorted(str(r.doc_id) for r in odd.collect())


def test_copies_full_of_short_lines_go_whole(spark):
    """Most of these texts are lines too short to count as repeated ones."""
    rng = random.Random(8)
    list_ = "\n".join(f"{w} here" for w in WORDS[:80])
    text = f"{list_}\n{sentence(rng, 30)}"
    other = f"{sentence(rng, 5)}\n{text.splitlines()[-1]}\n{sentence(rng, 60)}"
    docs = documents(spark, [text, text, other, text, list_.replace("here", "there")])
    left = {r.doc_id: r.text for r in STAGES["line_dedup"](spark, docs, "").collect()}
    first, last = other.splitlines()[0], other.splitlines()[2]
    assert left == {0: text, 2: f"{first}\n{last}", 4: list_.replace("here", "there")}


def test_what_is_left_of_a_copy_with_changes_goes(spark):
    rng = random.Random(6)
    lines = [sentence(rng, 20) for _ in range(6)]
    near = "\n".join([*lines[:5], sentence(rng, 20)])
    docs = documents(spark, ["\n".join(lines), near, "\n".join([lines[0], *(sentence(rng, 20) for _ in range(3))])])
    left = {r.doc_id: r.text.count("\n") for r in STAGES["line_dedup"](spark, docs, "").collect()}
    assert left == {0: 5, 2: 2}


def test_equal_texts_of_many_rows(spark):
    docs = documents(spark, ["the same words in every one of these many rows"] * 200 + ["short"] * 5)
    gone = line_edits.repeated_texts(docs)
    assert sorted(r.doc for r in gone.collect()) == list(range(1, 200))
