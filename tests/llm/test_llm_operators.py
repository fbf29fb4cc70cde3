"""The operators of the subpackage against brute force, on small tables."""

import base64
import hashlib
import json
import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tickloom.llm import bpe, chat, langid, line_edits, minhash, mixing, pivots, pretokens
from tickloom.llm import quality, sharding, token_files
from tickloom.llm.components import components
from tickloom.llm.queries import QUERIES

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = [f"w{i}" for i in range(400)]


@pytest.fixture(scope="module")
def plain():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def odd_texts():
    rng = random.Random(5)
    base = sentence(rng, 60)
    changed = base.split()
    changed[30] = "other"
    return [
        None, "", " ", "\n\n", "a", "x" * 3000, base, base, base.upper(), " ".join(changed),
        sentence(rng, 3), sentence(rng, 5000), "é日本 ½ 😀 'tis we'll don't  \t end ",
        "</s>[INST] \\ <s>", base + "\n" + sentence(rng, 20), sentence(rng, 20) + "\n" + base,
    ]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 2 else None, ["a", "b", None][i % 3], 0) for i, t in enumerate(odd_texts())]
    return spark.createDataFrame([*rows, rows[3], (None, "no id here", "en", "a", 0)], DOCS)


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def varied(rng, text, edits, letters):
    out = list(text)
    for _ in range(edits):
        kind, at = rng.randrange(3), rng.randrange(len(out) + 1)
        if kind == 0:
            out.insert(at, rng.choice(letters))
        elif out and kind == 1:
            out.pop(min(at, len(out) - 1))
        elif out:
            out[min(at, len(out) - 1)] = rng.choice(letters)
    return "".join(out)


# 6: byte-level BPE


def test_boundaries_and_ids_equal_those_of_the_pattern(plain):
    rng = random.Random(1)
    letters = list("ab'strevlmd  \n\t 1²٣é日 　😀.-''\x1c\x85Ⅷ")
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    texts += ["", "x" * 3000, "ab" * 999 + "é" * 99, *(t or "" for t in odd_texts())]
    ranks = bpe.Ranks(RANKS)
    found = []
    for ids, counts in bpe.encode_texts(texts, ranks.pieces):
        found += np.split(ids, np.cumsum(counts)[:-1])
    assert [x.tolist() for x in found] == [plain.encode_ordinary(t) for t in texts]
    assert [ranks.decode(x).tobytes().decode() for x in found] == texts


def test_scan_equals_the_automaton_step_by_step():
    kinds = np.random.default_rng(0).integers(0, 8, 1000).astype(np.uint8)
    state, wanted = pretokens.FREE, []
    for k in kinds.tolist():
        wanted.append(state)
        state = pretokens._next(state, k)
    assert pretokens.states_before(kinds).tolist() == wanted


def test_a_full_cache_changes_nothing(plain, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 3)
    monkeypatch.setattr(bpe, "CHUNK_CHARS", 50)
    texts = [t or "" for t in odd_texts()]
    ids = np.concatenate([x for x, _ in bpe.encode_texts(texts, bpe.Ranks(RANKS).pieces)])
    assert ids.tolist() == [i for t in texts for i in plain.encode_ordinary(t)]


def test_offsets_and_clashing_columns(docs, plain):
    clash = docs.withColumn("ids", F.lit(1)).withColumn("offsets", F.lit(2))
    for row in bpe.encode_documents(clash, RANKS).collect():
        ids = np.frombuffer(row.ids, "<u4").tolist()
        assert ids == plain.encode_ordinary(row.text or "")
        sizes = [len(plain.decode_single_token_bytes(i)) for i in ids]
        assert np.frombuffer(row.offsets, "<u4").tolist() == [sum(sizes[:k]) for k in range(len(ids))]


# 1: token files


def test_token_files_round_trip_and_damage(docs, tmp_path):
    files = token_files.write_documents(docs, VOCABULARY, 0, str(tmp_path / "files"))
    own = Tokenizer.from_file(VOCABULARY)
    own.encode_special_tokens = True
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    wanted, start = [], 0
    for r in rows:
        ids = [*own.encode(r.text or "", add_special_tokens=False).ids, 0]
        wanted.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = token_files.read_documents(files).collect()
    key = lambda x: x[1]
    assert sorted(((r.doc_id, r.start, r.n_ids, zlib.crc32(r.ids)) for r in got), key=key) == wanted
    some = token_files.read_documents(files, [6, 11]).collect()
    assert sorted(r.doc_id for r in some) == [6, 11]
    path = next((tmp_path / "files").iterdir())
    data = bytearray(path.read_bytes())
    data[30] ^= 1
    path.write_bytes(data)
    with pytest.raises(Exception):  # noqa: B017
        token_files.read_documents(files).collect()


def test_one_frame_is_decompressed_for_one_document(tmp_path, monkeypatch):
    import pyarrow.fs

    path = str(tmp_path / "one.ids.zst")
    system = pyarrow.fs.LocalFileSystem()
    monkeypatch.setattr(token_files, "FRAME_IDS", 10)
    with system.open_output_stream(path, compression=None) as out:
        writer = token_files.SeekableWriter(out)
        for i in range(50):
            writer.add(i, np.arange(i, dtype=np.uint32))
        writer.close()
    with system.open_input_file(path) as source:
        reader = token_files.SeekableReader(source)
        sizes = [e[1] for e in reader.entries]
        assert len(sizes) > 20 and sizes[-1] == 0
        asked = []
        read = reader._at
        reader._at = lambda a, n: asked.append((a, n)) or read(a, n)
        assert reader.document(33).tolist() == list(range(33))
        assert len(asked) == 1


# 2: quality


def test_quality_measures(docs):
    import re

    rng = random.Random(3)
    repeated = " ".join(WORDS[:9] * 3 + WORDS[20:60])
    texts = [*odd_texts(), repeated, "a b c d e f g h " * 4, "# # |\na\na\n\na"]
    spark = docs.sparkSession
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    assert rng
    for r in quality.measure(frame).collect():
        text = r.text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        wins = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        covered = {i + k for i, w in enumerate(wins) if wins.count(w) > 1 for k in range(8)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r.n_words, r.word_chars) == (len(words), sum(map(len, words)))
        assert r.n_symbols == sum(c in "#*$%&|<>" for c in text)
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.n_repeat_words == len(covered)


def test_a_bad_host_takes_its_documents_with_it(spark):
    rng = random.Random(4)
    rows = [(i, sentence(rng, 40 if i % 10 or i >= 300 else 2), f"h{i % 30}") for i in range(600)]
    rows = [(i, t if s != "h0" else "short", s) for i, t, s in rows]
    rows += [(1000 + i, sentence(rng, 40), "h0") for i in range(3)] + [(2000, sentence(rng, 40), None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    out = {r.doc_id: r for r in quality.judge(quality.measure(frame)).collect()}
    assert all(r.host_rejected == (r.source == "h0") for r in out.values() if r.source)
    assert not out[1000].kept and out[2000].kept and out[1].kept


# 3: mixing


@pytest.mark.parametrize("block", [50, 10**6])
def test_mixing_repeats_up_to_the_limit_and_cuts_nothing(spark, block):
    rows = [(i, s, 1 + (i % 7)) for i, s in enumerate(["big"] * 900 + ["mid"] * 90 + ["small"] * 9 + [None] * 30)]
    rows += [(5000, "empty", 0)]
    slim = spark.createDataFrame(rows, "id bigint, source string, tokens bigint")
    mix = mixing.Mix(max_repeats=4.0, block_tokens=block)
    plan = mixing.plan_sources(slim, mix)
    drawn = mixing.mix_rows(slim, plan, mix, "id", "source").collect()
    totals, taken = {}, {}
    for _, s, t in rows:
        totals[s] = totals.get(s, 0) + t
    for r in drawn:
        taken[r.source] = taken.get(r.source, 0) + r.tokens
    for p in plan.collect():
        if p.tokens:
            assert p.target - 7 < taken[p.source] <= p.target
            assert p.target <= 4.0001 * p.tokens + 1
    assert taken["big"] == totals["big"] and taken["small"] > 3.8 * totals["small"]
    assert {r.id for r in drawn} == {r[0] for r in rows}
    assert len(drawn) == len({(r.id, r["pass"]) for r in drawn})
    again = mixing.mix_rows(slim.repartition(7), mixing.plan_sources(slim.repartition(3), mix), mix, "id", "source")
    assert sorted((r.id, r["pass"]) for r in again.collect()) == sorted((r.id, r["pass"]) for r in drawn)


def test_mixing_by_entropy_and_of_nothing(spark):
    slim = spark.createDataFrame([(i, "a" if i else "b", 1) for i in range(100)], "id bigint, source string, tokens bigint")
    mix = mixing.Mix(max_repeats=None, entropy=0.9)
    weights = [r.weight for r in mixing.plan_sources(slim, mix).collect()]
    assert -sum(w * np.log(w) for w in weights) / np.log(2) == pytest.approx(0.9, abs=1e-4)
    none = slim.limit(0)
    assert mixing.mix_rows(none, mixing.plan_sources(none, mix), mix, "id", "source").count() == 0


# 4: vectors


def test_near_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(0)
    base = rng.standard_normal((300, 16))
    vectors = [base[i % 300] + (0.08 if i >= 300 else 0) * rng.standard_normal(16) for i in range(700)]
    rows = [(i, v.tolist(), i % 300 % 3) for i, v in enumerate(vectors)]
    rows += [(900, [0.0] * 16, 1), (901, None, 1), (902, [float("nan")] + [1.0] * 15, 1), (903, vectors[5].tolist(), None)]
    rows += [(904 + k, (2 * vectors[4]).tolist(), 4 % 3) for k in range(3)] + [(950, [], 0), (951, [1.0, 2.0], 0), (952, [1.0, 2.1], 0)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    links = {}
    good = [(i, np.array(v), x) for i, v, x in rows if v and x is not None and np.isfinite(v).all() and any(v)]
    for i, v, x in good:
        links[i] = {j for j, w, y in good if j != i and x == y and len(v) == len(w)
                    and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= 0.93}
    root = {i: i for i, _, _ in rows}
    moved = True
    while moved:
        moved = False
        for i, near in links.items():
            least = min([root[i], *(root[j] for j in near)])
            moved |= least < root[i]
            root[i] = least
    got = pivots.near_vectors(frame).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == {i: (len(links.get(i, ())), root[i]) for i in root}
    assert pivots.near_vectors(frame.limit(0)).count() == 0


# 5: chat


def test_events_fold_to_final_messages(spark):
    rows = [
        (1, 1, 0, "open", "user", None), (1, 1, 1, "delta", None, "he"), (1, 1, 2, "delta", None, "llo"),
        (1, 1, 2, "delta", None, "llo"), (1, 2, 0, "open", "assistant", None), (1, 2, 1, "delta", None, "draft"),
        (1, 2, 2, "regenerate", None, None), (1, 2, 3, "delta", None, "final"), (1, 2, 4, "delta", None, None),
        (1, 3, 0, "open", "user", None), (1, 3, 1, "delta", None, "typo"), (1, 3, 2, "edit", None, "fixed"),
        (1, 3, 3, "delta", None, "!"), (None, 1, 0, "delta", None, "lost"),
    ]
    log = spark.createDataFrame(rows, "conv_id long, message int, seq long, kind string, role string, text string")
    got = {(r.conv_id, r.message): (r.role, r.text) for r in chat.fold_messages(log).collect()}
    assert got == {
        (1, 1): ("user", "hello"), (1, 2): ("assistant", "final"), (1, 3): ("user", "fixed!"), (None, 1): ("", "lost"),
    }


def test_render_and_parse_are_inverse(spark):
    texts = [t or "" for t in odd_texts()] + ["\\I", "[\\INST]", "<", "</", "</s", "[INST", "a</s></s>"]
    rows = [(i % 3, i, ["user", "assistant", "a[/INST]\nb"][i % 3 if i < 9 else i % 2], t) for i, t in enumerate(texts)]
    messages = spark.createDataFrame(rows, "conv_id long, message int, role string, text string")
    for r in chat.parse(chat.render(messages)).collect():
        own = [(x[2], x[3]) for x in rows if x[0] == r.conv_id]
        assert [(t.role, t.text) for t in r.turns] == own
        assert r.loss_texts == [t for role, t in own if role == "assistant"]


# 7: line dedup


def test_repeated_lines_equal_brute_force(spark):
    rng = random.Random(7)
    lines = []
    for _ in range(150):
        line = sentence(rng, rng.randint(7, 12))
        lines.append(line)
        for _ in range(rng.randrange(3)):
            lines.append(varied(rng, line, rng.randint(0, 4), "abw1 "))
    hot = sentence(rng, 9)
    lines += [varied(rng, hot, rng.randint(0, 3), "abw1") for _ in range(120)] + ["short line"] * 5
    rng.shuffle(lines)
    texts = ["\n".join(lines[i : i + 3]) for i in range(0, len(lines), 3)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(9000, None), (9001, ""), (9002, texts[0])]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    places = [(d, k, x) for d, t in rows if t for k, x in enumerate(t.split("\n")) if len(x.split()) >= 8]
    first = {}
    for d, k, x in places:
        first.setdefault(x, (d, k))
    wanted = {(d, k, False) for d, k, x in places if first[x] != (d, k)}
    for x, p in first.items():
        if any(q < p and abs(len(x) - len(y)) <= 2 and edit_distance(x, y) <= 2 for y, q in first.items()):
            wanted.add((*p, True))
    got = line_edits.repeated_lines(frame)
    assert {(r.doc, r.line_no, r.near) for r in got.collect()} == wanted
    left = {r.doc_id: r.text for r in line_edits.remaining(frame, got).collect()}
    gone = {(d, k) for d, k, _ in wanted}
    for d, t in rows:
        if t and any((d, k) in gone for k in range(9)):
            before = len("".join(t.split()))
            t = "\n".join(x for k, x in enumerate(t.split("\n")) if (d, k) not in gone)
            after = len("".join(t.split()))
            # A document goes if nothing is left, or less than half of it.
            if not after or 2 * after < before:
                assert d not in left
                continue
        assert left[d] == t


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_banded_distance(edits):
    rng = random.Random(edits)
    left = ["".join(rng.choice("abc") for _ in range(rng.randint(0, 14))) for _ in range(2000)]
    right = [varied(rng, x, rng.randint(0, 4), "abc") for x in left]
    wanted = [edit_distance(a, b) <= edits for a, b in zip(left, right)]
    assert line_edits.near_pairs(left, right, edits).tolist() == wanted


def test_one_segment_is_always_found(spark):
    rng = random.Random(8)
    left = [sentence(rng, 3)[: rng.randint(3, 14)] for _ in range(800)]
    pairs = [(x, varied(rng, x, rng.randint(0, 2), "w1a ")) for x in left]
    pairs = [(a, b) if len(a) <= len(b) else (b, a) for a, b in pairs if min(len(a), len(b)) > 2]
    frame = spark.createDataFrame(pairs, "a string, b string")
    keys = F.array(*line_edits.index_keys(F.col("a"), F.length("a")))
    own = line_edits.index_keys(F.col("b"), F.length("b"))
    probes = F.array_compact(F.array(*own, *line_edits.probe_keys(F.col("b"), F.length("b"))))
    assert frame.where(~F.arrays_overlap(keys, probes)).collect() == []


# 8: language


def test_language_gradients_and_held_out_accuracy(spark, folder):
    net = langid.fresh(["a", "b"], 1)
    rng = np.random.default_rng(2)
    windows = rng.integers(0, 257, (3, langid.WINDOW)).astype(np.int16)
    targets = np.array([0, 1, 1])
    net.out = net.out.astype(np.float64)
    grads = langid.gradients(net, windows, targets)
    loss = lambda: -langid.forward(net, windows)[0][np.arange(3), targets].mean()
    at = (5, 1)
    before, net.out[at] = loss(), net.out[at] + 1e-4
    assert (loss() - before) / 1e-4 == pytest.approx(grads[-2][at], abs=1e-3)
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang", "text")
    got = {r.doc_id: r for r in QUERIES["op8_language"](spark, folder).collect()}
    held = [(r.lang, got[r.doc_id]) for r in rows.collect() if got[r.doc_id].held_out and len(r.text) > 50]
    assert all(g.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, g in got.items())
    assert sum(x == g.lang_pred for x, g in held) >= 0.93 * len(held)


def test_texts_without_letters_are_unknown(docs):
    net = langid.fit([b"the house", b"das Haus"], ["en", "de"])
    for r in langid.predict(docs, net).collect():
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
        assert 0 <= r.score <= 1
    assert {r.lang_pred for r in langid.predict(docs, langid.train(docs.limit(0))).collect()} == {"und"}


# 9: sharding


@pytest.mark.parametrize("total", [0, 1, 5, 1000])
def test_shards_are_exact_and_gapless(spark, total):
    rows = spark.range(total).select(F.col("id").alias("doc_id"), F.lit("x").alias("shard"))
    rows = rows.unionByName(rows.limit(2))
    got = sharding.shard_rows(rows, 16).collect()
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert len(got) == total + min(total, 2)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    sizes = [len(slots.get(s, [])) for s in range(16)]
    assert max(sizes) - min(sizes) <= 1


def test_hypergeometric_draws_follow_their_law():
    from math import comb

    rng = random.Random(0)
    draws = [sharding.hypergeometric(rng, 12, 20, 9) for _ in range(20000)]
    for k in range(10):
        law = comb(12, k) * comb(20, 9 - k) / comb(32, 9)
        assert draws.count(k) / 20000 == pytest.approx(law, abs=0.012)
    matrix = sharding.communication_matrix({0: 700, 1: 3, 2: 0, 5: 3 * 10**9}, 7, 1)
    assert [sum(row) for _, row in matrix] == [700, 3, 0, 3 * 10**9]
    columns = [sum(x) for x in zip(*(row for _, row in matrix))]
    assert max(columns) - min(columns) <= 1


# 10: MinHash


def shingle_set(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))}


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(10)
    texts = [*odd_texts(), sentence(rng, 4), "a b c d"]
    for _ in range(25):
        base = sentence(rng, rng.randint(30, 120)).split()
        for _ in range(rng.randint(1, 6)):
            own = list(base)
            for _ in range(rng.randint(0, 4)):
                own[rng.randrange(len(own))] = rng.choice(WORDS)
            texts.append(" ".join(own))
    hot = sentence(rng, 100).split()
    for _ in range(70):
        own = list(hot)
        for _ in range(rng.randint(1, 5)):
            own[rng.randrange(len(own))] = rng.choice(WORDS)
        texts.append(" ".join(own))
    sets = [shingle_set(t) for t in texts]
    root = list(range(len(texts)))
    links = [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i])
             if a and b and 100 * len(a & b) >= 75 * len(a | b)]
    moved = True
    while moved:
        moved = False
        for i, j in links:
            if root[i] != root[j]:
                root[i] = root[j] = min(root[i], root[j])
                moved = True
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(frame).collect()}
    assert got == {i: (len(s), root[i]) for i, s in enumerate(sets)}
    assert minhash.near_duplicates(frame.limit(0)).count() == 0


def test_estimates_correct_for_chance():
    rng = np.random.default_rng(1)
    one = np.unique(rng.integers(0, 1 << 63, 4000, np.uint64))
    two = np.unique(np.concatenate((one[:3000], rng.integers(0, 1 << 63, 1000, np.uint64))))
    low = minhash.minima(np.concatenate((one, two)), np.array([len(one), len(two)]))
    bits = minhash.packed_bits(low).view(np.uint64)
    d = bits[0] ^ bits[1]
    d |= d >> np.uint64(2)
    d |= d >> np.uint64(1)
    equal = 1 - np.bitwise_count(d & np.uint64(0x1111111111111111)).sum() / minhash.HASHES
    assert (equal - 1 / 16) / (15 / 16) == pytest.approx(0.6, abs=0.15)


def test_components_of_chains_and_stars(spark):
    rng = random.Random(11)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 300)] + [(5, 5), (1, 2), (2, 1)]
    rng.shuffle(edges)
    frame = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r.id: r.component for r in components(frame).collect()}
    wanted = {i: 100 for i in range(100, 161)} | {i: 7 for i in [7, *range(200, 300)]} | {1: 1, 2: 1}
    assert got == wanted


# Queries


def test_pipeline_keeps_one_of_each_group(spark, folder):
    import corpus_pipeline

    got = {r.doc_id for r in corpus_pipeline.run(spark, folder).select("doc_id").collect()}
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    first = {}
    for r in sorted(rows):
        first.setdefault(r.text, r.doc_id)
    assert got and got <= set(first.values())
    assert len(corpus_pipeline.STAGES) == 5


def test_results_with_fixed_columns(spark, folder):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet'").fetchall()
    got = {r.doc_id: r for r in QUERIES["op6_byte_bpe"](spark, folder).collect()}
    assert all(got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest() for i, t in rows)
    shards = QUERIES["op9_uniform_shards"](spark, folder).collect()
    assert {(r.doc_id, r.size, r.text_crc32) for r in shards} == {
        (i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in rows
    }
    assert json.dumps(sorted({r.law for r in shards})) == '["rows"]'
