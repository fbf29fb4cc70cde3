"""Mixing, sharding and language scores replayed step by step; clashing names; scratch tables."""

import os
import random
import struct

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tickloom.llm import langid, mixing, quality, sharding
from tickloom.llm.common import scratch, stored
from tickloom.session import shared_dir


def hash_of(*values):
    """Spark's xxhash64: ints in 4 bytes, ("long", n) in 8, texts in UTF-8, nulls skipped."""
    state = 42
    for v in values:
        if v is None:
            continue
        if isinstance(v, str):
            data = v.encode()
        elif isinstance(v, tuple):
            data = struct.pack("<q", v[1])
        else:
            data = struct.pack("<i", v)
        state = xxhash.xxh64_intdigest(data, state)
    return state - (1 << 64) if state >> 63 else state


def long(n):
    return None if n is None else ("long", n)


# Sharding


def replayed_shards(rows, n_shards, seed):
    """(shard, slot) of every (id, text), by sorting lists."""
    order = [hash_of(long(i), t) for i, t in rows]
    total = len(rows)
    parts = sharding.LEAST_PARTITIONS
    pieces = max(1, -(-total // (n_shards * sharding.PIECE_ROWS)))
    part = [hash_of(seed, long(o)) % parts for o in order]
    sizes = {p: part.count(p) for p in set(part)}
    matrix = dict(sharding.communication_matrix(sizes, n_shards, seed))
    shard = {}
    for p, counts in matrix.items():
        local = sorted((hash_of(seed + 1, long(order[k])), order[k], k) for k in range(total) if part[k] == p)
        dealt = [s for s, n in enumerate(counts) for _ in range(n)]
        shard.update({k: s for (_, _, k), s in zip(local, dealt)})
    out = {}
    for s in range(n_shards):
        inside = sorted(
            (hash_of(seed + 2, long(order[k])) % pieces, hash_of(seed + 3, long(order[k])), order[k], k)
            for k in range(total) if shard[k] == s
        )
        out.update({rows[k]: (s, slot) for slot, (*_, k) in enumerate(inside)})
    return out


def test_the_deal_is_that_of_the_replay(spark, monkeypatch):
    monkeypatch.setattr(sharding, "PIECE_ROWS", 40)
    rows = [(i, f"t{i % 7}") for i in range(700)] + [(None, f"n{i}") for i in range(350)] + [(5000, None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {(r.doc_id, r.text): (r.shard, r.slot) for r in sharding.shard_rows(frame, 5, seed=3).collect()}
    assert got == replayed_shards(rows, 5, 3)


def test_rows_of_one_id_spread_over_partitions(spark):
    rows = spark.range(4000).select(F.lit(7).cast("long").alias("doc_id"), F.col("id").alias("other"))
    sizes = [r["count"] for r in sharding.shard_rows(rows, 8).groupBy("shard").count().collect()]
    assert sizes == [500] * 8
    order = [hash_of(long(7), long(i)) for i in range(4000)]
    part = [hash_of(0, long(o)) % sharding.LEAST_PARTITIONS for o in order]
    assert max(part.count(p) for p in set(part)) < 150


# Mixing


def replayed_mix(rows, mix):
    """{(id, pass, block)} of every draw."""
    tokens = {}
    for _, s, n in rows:
        tokens[s] = tokens.get(s, 0) + n
    whole = sum(tokens.values())
    share = {s: n / whole for s, n in tokens.items() if n}
    # Repeats are (share / least share) ** (1 - exponent), whatever the budget.
    ratio = max(share.values()) / min(share.values())
    grid = 1 << mixing.GRID_BITS
    exponents = np.arange(grid + 1) / grid
    alpha = exponents[np.argmax(ratio ** (1 - exponents) <= mix.max_repeats * (1 + 1e-12))]
    z = sum(p**alpha for p in share.values())
    budget = round(whole / min(p ** (alpha - 1) / z for p in share.values()))
    out = set()
    for s, total in tokens.items():
        own = [(i, n) for i, x, n in rows if x == s]
        if not total:
            out |= {(i, 0, hash_of(mix.seed, 0, long(i)) % 1) for i, _ in own}
            continue
        target = int(np.rint(share[s] ** alpha / z * budget))
        full, rest = divmod(target, total)
        blocks = max(-(-total // mix.block_tokens), 1)

        def place(number, i):
            block = hash_of(mix.seed, number, long(i)) % blocks
            return hash_of(mix.seed + 1, number, s, block), block, hash_of(mix.seed + 2, number, long(i))

        out |= {(i, number, place(number, i)[1]) for number in range(full) for i, _ in own}
        queue = sorted((*place(full, i), i, n) for i, n in own)
        room = rest
        for key in sorted({q[0] for q in queue}):
            members = [q for q in queue if q[0] == key]
            size = sum(q[4] for q in members)
            if rest and size <= room:
                out |= {(q[3], full, q[1]) for q in members}
                room -= size
                continue
            for q in members if rest else []:
                room -= q[4]
                if room < 0:
                    break
                out.add((q[3], full, q[1]))
            break
    return out


@pytest.mark.parametrize("repeats, block", [(2.0, 300), (4.0, 50), (1.3, 10**6)])
def test_draws_are_those_of_the_replay(spark, repeats, block):
    rng = random.Random(4)
    sources = ["big"] * 300 + ["middle"] * 60 + ["small"] * 20 + [None] * 9 + ["wordless"] * 3
    rows = [(i, s, 0 if s == "wordless" else rng.randint(1, 30)) for i, s in enumerate(sources)]
    slim = spark.createDataFrame(rows, "id bigint, source string, tokens bigint")
    mix = mixing.Mix(max_repeats=repeats, block_tokens=block, seed=5)
    drawn = mixing.mix_rows(slim, mixing.plan_sources(slim, mix), mix, "id", "source").collect()
    assert len(drawn) == len({(r.id, r["pass"]) for r in drawn})
    assert {(r.id, r["pass"], r.block) for r in drawn} == replayed_mix(rows, mix)


# Language


def test_scores_equal_plain_loops():
    net = langid.fresh(["a", "b", "c"], 1)
    texts = ["Der Hund läuft.".encode(), b"x", ("one two " * 60).encode()]
    wanted = []
    for text in texts:
        logs = []
        for at in range(0, len(text), langid.WINDOW):
            window = [*text[at : at + langid.WINDOW]]
            window += [256] * (langid.WINDOW - len(window))
            features = []
            for width, kernel, bias in zip(langid.WIDTHS, net.filters, net.biases):
                for f in range(kernel.shape[1]):
                    responses = [
                        sum(float(net.embed[window[p + k]] @ kernel[k * langid.EMBEDDING : (k + 1) * langid.EMBEDDING, f])
                            for k in range(width))
                        for p in range(langid.WINDOW - width + 1)
                    ]
                    features.append(max(0.0, max(responses) + float(bias[f])))
            scores = np.array(features) @ net.out + net.out_bias
            logs.append(scores - np.log(np.exp(scores).sum()))
        means = np.exp(np.mean(logs, axis=0))
        wanted.append(means / means.sum())
    assert langid.classify(net, texts) == pytest.approx(np.array(wanted), abs=1e-4)


# Names of helper columns


HELPERS = (
    "_id", "_src", "_plan", "_plan_full", "full", "rest", "blocks", "cut_block", "cut_doc", "_measures", "_host",
    "_known", "_known_salt", "_salt", "_verdict", "_host_rejected", "_rank", "_ends", "_first", "_part", "_order",
    "_piece", "count", "tokens", "known",
)


def test_helper_names_of_the_input_come_through(spark):
    rows = [(i, f"{'word ' * (30 + i % 9)}{i}", "ab"[i % 2]) for i in range(60)]
    plain = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    clashing = plain.withColumns({c: F.lit(f"own {c}") for c in HELPERS})
    mix = mixing.Mix()

    def mixed(docs):
        return mixing.mix_rows(docs, mixing.plan_sources(mixing.slim_rows(docs), mix), mix)

    for run in (
        mixed,
        lambda docs: quality.judge(quality.measure(docs)),
        lambda docs: sharding.shard_rows(docs, 4),
    ):
        out, without = run(clashing), run(plain)
        assert out.columns == [*clashing.columns, *without.columns[3:]]
        for c in HELPERS:
            assert [r[0] for r in out.select(c).distinct().collect()] == [f"own {c}"]
        if run is mixed or "kept" in out.columns:
            assert sorted(out.select(*without.columns).collect()) == sorted(without.collect())


def test_names_of_results_are_replaced(spark):
    rows = [(i, "word " * 40, "a") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    mix = mixing.Mix()
    own = docs.withColumns({c: F.lit("own") for c in mixing.DRAWN})
    plan = mixing.plan_sources(mixing.slim_rows(own), mix)
    assert mixing.mix_rows(own, plan, mix).columns == [*docs.columns, *mixing.DRAWN]
    assert {r.weight for r in mixing.mix_rows(own, plan, mix).collect()} == {1.0}


def test_a_hot_host_meets_its_verdict_in_groups(spark):
    rows = [(i, "short", "bad") for i in range(300)] + [(1000 + i, "word%d " % i * 40, "bad") for i in range(20)]
    rows += [(2000 + i, " ".join(f"w{i}x{k}" for k in range(30)), ["good", None][i % 2]) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    judged = quality.judge(quality.measure(docs))
    assert judged.count() == len(rows)
    assert {(r.source, r.host_rejected) for r in judged.collect()} == {("bad", True), ("good", False), (None, False)}


# Scratch tables


def test_scratch_tables_go_with_their_block(spark):
    root = shared_dir(spark)

    def folders():
        return {x for x in os.listdir(root) if x.startswith(("gone-", "stays-"))}

    with scratch(spark):
        first = stored(spark.range(5), "gone")
        last = stored(first.where("id > 2"), "stays", keep=True)
    assert [x.split("-")[0] for x in folders()] == ["stays"]
    assert last.count() == 2
    with pytest.raises(ValueError):
        with scratch(spark):
            stored(spark.range(5), "gone")
            raise ValueError
    assert [x.split("-")[0] for x in folders()] == ["stays"]
