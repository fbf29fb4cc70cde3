"""Token counts, infilling and centroid clusters against brute force."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tickloom.llm import centroids, infill, token_counts

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id bigint, text string, n bigint, form string, digest string, id string"


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(WORD_BPE)


def table(spark, texts):
    """Texts with ids, a repeated row, a null id, and columns named as helpers are."""
    rows = [(i, t, 7, "x", "y", "z") for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[1], (None, "no id", 7, "x", "y", "z")], DOCS)


def odd_texts(rng):
    words = ["the", "cat's", "we'll", "İX", "日本語。", "é", "x1²", "<|endoftext|>", "don't", "!!'s", "ΑΣ"]
    return [
        None, "", " ", "\n\n", "a", "tie", "tie", "x" * 5000, "日" * 4000, "<S> y", "z <M>", "a<P>b",
        " ".join(rng.choice(words) for _ in range(3000)), "".join(rng.choice(words) for _ in range(3000)),
        "x" * 3000 + " " + "y z " * 500, "line\nline\n\nlast", "line\n", "<|startoftext|>" * 400,
    ]


# 11: token counts


def test_splices_equal_the_whole_text(plain):
    tokenizer, margin = token_counts.load_tokenizer(WORD_BPE)
    rng = random.Random(3)
    letters = [*"ab'strevlmd  \n\t 1²٣é日 　😀.-''\x1c\x85Ⅷİ!", "́", "̣", "ᄀ", "ᅡ",
               "ᆨ", "<|endoftext|>", "<|startoftext|>", "'re", "ΑΣ", " the"]
    spliced = 0
    for _ in range(1500):
        some = rng.choice([letters, rng.sample(letters, 3), [" the", "'re", "ab", "."]])
        text = "".join(rng.choice(some) for _ in range(rng.randint(0, 600)))
        got = token_counts.spliced(
            lambda t: tokenizer.encode(t, add_special_tokens=False), text,
            rng.choice([60, 100, 170]), rng.choice([48, 64, 80]), margin,
        )
        spliced += got is not None and len(text) > 200
        assert got in (None, len(plain.encode(text, add_special_tokens=False)))
    assert spliced > 300


def test_a_run_without_words_has_no_splice(plain):
    encode = lambda t: plain.encode(t, add_special_tokens=False)
    assert token_counts.spliced(encode, "ab" * 500, 100, 64, 16) is None


def test_pieces_cover_the_text():
    for n in (0, 1, 99, 100, 164, 165, 999):
        text = "".join(chr(97 + i % 26) for i in range(n))
        parts = token_counts.cut(text, 100, 64)
        assert "".join(p[:100] for p in parts[:-1]) + parts[-1] == text
        assert all(len(p) == 164 for p in parts[:-1]) and (n <= 164 or len(parts[-1]) > 64)


def test_vocabularies_without_proof_are_not_spliced():
    byte_level = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert token_counts.margin_of(__import__("json").loads(byte_level.to_str())) is None


def test_counts_of_whole_texts_and_widening(spark, plain):
    texts = odd_texts(random.Random(9))
    docs = table(spark, texts)
    got = token_counts.count_tokens(docs, WORD_BPE, piece=300, overlap=64).collect()
    wanted = [
        (r.doc_id, len((r.text or "").encode()), len(plain.encode(r.text or "", add_special_tokens=False)))
        for r in docs.collect()
    ]
    key = lambda x: (x[0] is not None, x)
    assert sorted([tuple(r) for r in got], key=key) == sorted(wanted, key=key)


def test_counts_of_an_empty_table(spark):
    empty = table(spark, ["a", "b"]).limit(0)
    assert token_counts.count_tokens(empty, WORD_BPE).collect() == []


# 12: infilling


def infilled(doc_id, text, units):
    """The same in plain Python."""
    text = text or ""
    marks = ("<P>", "<S>", "<M>")
    parts = list(text) if units == "chars" else text.splitlines(keepends=True)
    n = len(parts)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in marks) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    x, y, z = ("".join(p) for p in (parts[:low], parts[low:high], parts[high:]))
    if h[3] % 100 < 20:
        return n, "spm", low, high - low, f"<S>{z}<P>{x}<M>{y}"
    return n, "psm", low, high - low, f"<P>{x}<S>{z}<M>{y}"


@pytest.mark.parametrize("units", infill.UNITS)
@pytest.mark.parametrize("size", [infill.SEGMENT_BYTES, 700])
def test_infill_equals_plain_python_and_is_reversible(spark, monkeypatch, units, size):
    texts = [t if t is None else t.replace("\x85", "") for t in odd_texts(random.Random(4))]
    texts += [f"{i}: <\nword<S\nP> é日😀" for i in range(200)]
    docs = table(spark, texts)
    rows = docs.select("doc_id", "text").collect()
    ids, body = [r.doc_id for r in rows], pa.array([r.text or "" for r in rows])
    # The kernels with small segments, in this process.
    monkeypatch.setattr(infill, "SEGMENT_BYTES", size)
    wanted = [infilled(i, t, units) for i, t in zip(ids, body.to_pylist())]
    digests = [hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest() for i in ids]
    h1, h2 = (pa.array([int(d[8 * k : 8 * k + 8], 16) for d in digests]) for k in (0, 1))
    out = infill.transform(body, h1, h2, pa.array([w[1] for w in wanted]), units)
    got = list(zip(*(c.to_pylist() for c in out)))
    assert got == [(n, low, mid, o) for n, _, low, mid, o in wanted]
    if size == infill.SEGMENT_BYTES:
        return
    done = infill.infill(docs, units=units)
    done = done.withColumn("back", infill.restored(F.col("form"), F.col("output"))).collect()
    key = lambda x: repr(x)
    assert sorted([tuple(r) for r in done], key=key) == sorted(
        [(i, *w, t) for i, w, t in zip(ids, wanted, body.to_pylist())], key=key
    )


def test_infill_of_an_empty_table(spark):
    assert infill.infill(table(spark, ["a", "b"]).limit(0)).collect() == []
    with pytest.raises(ValueError):
        infill.infill(table(spark, ["a", "b"]), units="pages")


# 13: centroid clusters


def lloyd(q, first, rounds):
    c = [list(map(int, x)) for x in first]
    q = [list(map(int, x)) for x in q]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, p)), j) for j, p in enumerate(c))

    for _ in range(rounds):
        own = [nearest(x)[1] for x in q]
        for j in range(len(c)):
            mine = [x for x, o in zip(q, own) if o == j]
            if mine:
                c[j] = [sum(v) // len(mine) for v in zip(*mine)]
    return [nearest(x) for x in q], c


@pytest.mark.parametrize("spread,k,span", [(3, 12, 4), (1, 9, 2), (1000, 20, 60), (1 << 26, 5, 1 << 20)])
def test_search_equals_brute_force(spread, k, span):
    """Small spreads make ties and equal centroids; large ones are close to the limit."""
    rng = np.random.default_rng(spread + k)
    middles = rng.integers(-spread, spread, (7, 6))
    q = (middles[rng.integers(0, 7, 600)] + rng.integers(-span, span + 1, (600, 6))).astype(np.int64)
    now, before = centroids.Centroids(q[:k].copy()), None
    rows, work = centroids.Bounded.new(q, k), 0
    for step in range(6):
        work += centroids.search(rows, now, *now.moved(before))
        wanted, _ = lloyd(q, now.points, 0)
        assert rows.near.tolist() == [j for _, j in wanted]
        counts, sums = centroids.cluster_sums(rows, k)
        points = now.points.copy()
        for j in np.flatnonzero(counts):
            points[j] = [int(s) // int(counts[j]) for s in sums[j]]
        now, before = centroids.Centroids(points), now
    assert work < 6 * 600 * k


def vectors(spark, rows):
    return spark.createDataFrame(
        rows, "vec_id bigint, embedding array<double>, near int, q binary, cluster int, distance bigint"
    )


def test_clusters_equal_lloyd_rounds(spark):
    rng = np.random.default_rng(1)
    points = rng.normal(0, 1, (150, 4))
    points[100:130] = points[0]
    rows = [(i, p.tolist(), 1, b"", 2, 3) for i, p in enumerate(points)]
    odd = [None, [], [1.0] * 3, [1.0, None, 0.0, 0.0], [1.0, float("nan"), 0.0, 0.0], [float("inf")] + [0.0] * 3]
    rows += [rows[5], (None, [0.5] * 4, 1, b"", 2, 3)] + [(900 + i, v, 1, b"", 2, 3) for i, v in enumerate(odd)]
    for k in (1, 7, 400):
        got = centroids.clustered(vectors(spark, rows), clusters=k, rounds=3, width=4).collect()
        kept = [(i, np.floor(256 * np.array(v)).astype(int).tolist()) for i, v, *_ in rows[:152]]
        order = sorted(
            kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(),
                                 np.array(r[1], "<i4").tobytes())
        )
        found, final = lloyd([q for _, q in kept], [q for _, q in order[:k]], 3)
        per = {}
        for d, j in found:
            per[j] = per.get(j, 0) + d
        names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in final]
        wanted = [(i, j, d, per[j], sum(per.values()), names[j]) for (i, _), (d, j) in zip(kept, found)]
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, wanted))


def test_clusters_of_no_vector_and_of_too_large_ones(spark):
    none = vectors(spark, [(1, None, 1, b"", 2, 3), (2, [1.0], 1, b"", 2, 3)])
    assert centroids.clustered(none, width=4).collect() == []
    with pytest.raises(PySparkException, match="beyond"):
        centroids.clustered(vectors(spark, [(1, [1e9] * 4, 1, b"", 2, 3)]), width=4)
