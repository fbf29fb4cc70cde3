"""Token counts of whole texts, huge ones in overlapping pieces.

A text of ordinary size is encoded at once. A huge one is cut into pieces that overlap,
which are encoded by tasks of their own, with offsets. Two neighbours are spliced at a
position that both begin a word at: tokens before it are the left piece's, tokens from
it on the right one's.

Why such a position is safe: words are found from left to right by a pattern that looks
at no character before a word, and two behind one at most. So what follows a word start
depends on the text behind it alone, and two encodings that share a word start agree
from there on, as far as both reach. What could still differ is left out: positions too
close to a piece's end (a pattern, or a special string that is cut by the end), and
positions at which the characters around do not normalise apart. By induction over the
pieces the spliced words are those of the whole text; merges never leave a word.

Where an overlap has no safe position, as in a run of letters without end, the document
is cut anew into pieces and overlaps four times as large, at last into one.

The parts of a text between blanks are encoded apart for the same reason: no word of these
patterns holds a blank, and nothing composes with one. So a text has the tokens of its
parts, and a task encodes a part once as long as it remembers it.
"""

from __future__ import annotations

import json
import os
import unicodedata
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.bpe import chunks_of
from tickloom.llm.common import ship_code, stored

#: Texts of up to so many bytes are encoded at once; pieces of others have as many
#: characters, and share so many with the next one. Neither changes a result.
PIECE, OVERLAP = 65_536, 1_024
WIDER = 4
#: Characters around a position that decide whether a text normalises apart there.
AROUND = 16
SALTS = 16
#: Characters of parts whose counts a task remembers at most, besides one group of texts.
KNOWN_CHARS = 8_000_000

#: Word patterns that the argument above holds for. Fixed values.
WORD_PATTERNS = (r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",)


@cache
def load_tokenizer(path: str):
    """The vocabulary and the length of its longest special string; one per worker.

    The length is null where the argument for splicing does not hold.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer, margin_of(json.loads(tokenizer.to_str()))


def margin_of(description: dict) -> int | None:
    """Characters that a splice keeps from the ends of pieces, or None for no splices."""
    special = [t["content"] for t in description["added_tokens"]]
    if any(" " in s for s in special):
        return None
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]
           for t in description["added_tokens"]):
        return None
    # Strings that overlap themselves or each other are found depending on where one starts.
    if any(a[-n:] == b[:n] for a in special for b in special for n in range(1, min(len(a), len(b)))):
        return None
    steps = (description["normalizer"] or {"normalizers": []}).get("normalizers")
    if steps is None or any(s["type"] not in ("NFC", "Lowercase") and s != BLANKS for s in steps):
        return None
    split, *rest = (description["pre_tokenizer"] or {}).get("pretokenizers", [{"type": None}])
    apart = split["type"] == "Split" and split["pattern"].get("Regex") in WORD_PATTERNS
    apart &= all(s["type"] == "ByteLevel" and not s["use_regex"] and not s["add_prefix_space"] for s in rest)
    if not apart or description["post_processor"] is not None:
        return None
    return max([AROUND, *map(len, special)])


BLANKS = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}


def cut(text: str, piece: int, overlap: int) -> list[str]:
    """Pieces of a text; each starts ``piece`` characters after the one before."""
    count = max(1, -(-(len(text) - overlap) // piece))
    ends = [(i + 1) * piece + overlap for i in range(count - 1)] + [len(text)]
    return [text[i * piece : end] for i, end in enumerate(ends)]


def normalises_apart(text: str, at: int) -> bool:
    before, behind = text[max(at - AROUND, 0) : at], text[at : at + AROUND]
    form = unicodedata.normalize
    return form("NFC", before) + form("NFC", behind) == form("NFC", before + behind)


def word_starts(encoding, text: str, low: int, high: int) -> tuple[list[int], list[int]]:
    """Safe word starts in ``low <= position < high`` and the tokens before each."""
    words = np.array([-1 if w is None else w for w in encoding.word_ids], np.int64)
    places = np.array(encoding.offsets, np.int64).reshape(-1, 2)[:, 0]
    first = np.flatnonzero(np.concatenate(([True], words[1:] != words[:-1]))[: len(words)])
    at, index = np.unique(places[first], return_index=True)
    first = first[index]
    inside = np.flatnonzero((at >= low) & (at < high))
    kept = [i for i in inside.tolist() if normalises_apart(text, int(at[i]))]
    return at[kept].tolist(), first[kept].tolist()


def edges(encoding, text: str, number: int, last: bool, piece: int, overlap: int, margin: int | None):
    """Word starts near a piece's two ends, as (position in the text, surplus tokens).

    The surplus is what the piece has on the wrong side of a splice there.
    """
    before: list[tuple[int, int]] = []
    behind: list[tuple[int, int]] = []
    if margin is not None and number:
        at, index = word_starts(encoding, text, margin, overlap)
        before = [(number * piece + a, i) for a, i in zip(at, index)]
    if margin is not None and not last:
        at, index = word_starts(encoding, text, piece, len(text) - margin)
        behind = [(number * piece + a, len(encoding) - i) for a, i in zip(at, index)]
    return before, behind


def spliced(encode, text: str, piece: int, overlap: int, margin: int | None) -> int | None:
    """Tokens of one text by its pieces; None where a splice has no safe position."""
    parts = cut(text, piece, overlap)
    total, open_ = 0, {}
    for i, part in enumerate(parts):
        encoding = encode(part)
        before, behind = edges(encoding, part, i, i + 1 == len(parts), piece, overlap, margin)
        total += len(encoding)
        if i:
            both = [(at, n + open_[at]) for at, n in before if at in open_]
            if not both:
                return None
            total -= min(both)[1]
        open_ = dict(behind)
    return total


class PartCounts:
    """Token counts of the parts of texts between blanks, each encoded once."""

    def __init__(self, tokenizer, limit: int = KNOWN_CHARS):
        self.tokenizer, self.limit = tokenizer, limit
        self.known: dict[str, int] = {"": 0}
        self.size = 0

    def of(self, texts: list[str]) -> list[int]:
        parts = [text.split(" ") for text in texts]
        if self.size > self.limit:
            self.known, self.size = {"": 0}, 0
        new = list(set(chain.from_iterable(parts)).difference(self.known))
        found = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
        self.known.update(zip(new, map(len, found)))
        self.size += sum(map(len, new))
        return [sum(map(self.known.__getitem__, some)) for some in parts]


def _short_counts(rows: DataFrame, tokenizer_path: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, margin = load_tokenizer(tokenizer_path)
        parts = None if margin is None else PartCounts(tokenizer)
        for batch in batches:
            counts: list[int] = []
            for group in chunks_of(batch.column(2).to_pylist()):
                if parts is not None:
                    counts += parts.of(group)
                    continue
                found = tokenizer.encode_batch_fast(group, add_special_tokens=False)
                counts += [len(e) for e in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64())], ["id", "n_bytes", "n_tokens"]
            )

    kind = dict(rows.dtypes)["id"]
    return rows.select("id", "n_bytes", "text").mapInArrow(run, f"id {kind}, n_bytes bigint, n_tokens bigint")


EDGES = "array<struct<at: bigint, surplus: bigint>>"
_EDGES = pa.list_(pa.struct([("at", pa.int64()), ("surplus", pa.int64())]))


def _encoded_pieces(texts: DataFrame, tokenizer_path: str, piece: int, overlap: int) -> DataFrame:
    """(digest, number, n_tokens, before, behind) of the pieces of distinct texts."""

    def in_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for digest, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                parts = cut(text, piece, overlap)
                # Few pieces at a time: a text may be as large as memory allows.
                for at in range(0, len(parts), 64):
                    some = parts[at : at + 64]
                    numbers = range(at, at + len(some))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([digest] * len(some)), pa.array(numbers, pa.int64()),
                         pa.array([i + 1 == len(parts) for i in numbers]), pa.array(some, pa.string())],
                        ["digest", "number", "last", "text"],
                    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, margin = load_tokenizer(tokenizer_path)
        for batch in batches:
            out = []
            for digest, number, last, text in zip(*(c.to_pylist() for c in batch.columns)):
                found = tokenizer.encode(text, add_special_tokens=False)
                out.append((digest, number, len(found), *edges(found, text, number, last, piece, overlap, margin)))
            digests, numbers, counts, before, behind = zip(*out) if out else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(digests, pa.string()), pa.array(numbers, pa.int64()), pa.array(counts, pa.int64()),
                 pa.array(before, _EDGES), pa.array(behind, _EDGES)],
                ["digest", "number", "n_tokens", "before", "behind"],
            )

    pieces = texts.mapInArrow(in_pieces, "digest string, number bigint, last boolean, text string")
    # Deals the pieces of a document over tasks, and copies of a piece become one.
    dealt = pieces.groupBy("digest", "number").agg(F.first("last").alias("last"), F.first("text").alias("text"))
    return dealt.mapInArrow(
        encode, f"digest string, number bigint, n_tokens bigint, before {EDGES}, behind {EDGES}"
    )


def _spliced_counts(encoded: DataFrame) -> DataFrame:
    """(digest, n_tokens, failed): tokens of all pieces less the surplus at every seam."""
    left = F.struct(F.col("number").alias("seam"), F.col("before"), F.lit(None).cast(EDGES).alias("behind"))
    right = F.struct((F.col("number") + 1).alias("seam"), F.lit(None).cast(EDGES).alias("before"), F.col("behind"))
    sides = encoded.select("digest", F.explode(F.array(left, right)).alias("s")).select("digest", "s.*")
    seams = sides.groupBy("digest", "seam").agg(
        F.first("before", ignorenulls=True).alias("before"), F.first("behind", ignorenulls=True).alias("behind")
    )
    # The first and the last seam of a document are its ends.
    seams = seams.where("before IS NOT NULL AND behind IS NOT NULL AND seam > 0")
    common = F.array_min(F.array_intersect(F.col("before")["at"], F.col("behind")["at"]))
    seams = seams.withColumn("splice", common)

    def surplus(side: str):
        return F.get(F.filter(side, lambda x: x["at"] == F.col("splice")), F.lit(0))["surplus"]

    losses = seams.select(
        "digest", F.coalesce(-(surplus("before") + surplus("behind")), F.lit(0)).alias("n"),
        F.col("splice").isNull().alias("failed"),
    )
    whole = encoded.select("digest", F.col("n_tokens").alias("n"), F.lit(False).alias("failed"))
    return whole.unionByName(losses).groupBy("digest").agg(
        F.sum("n").alias("n_tokens"), F.max("failed").alias("failed")
    )


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    row_id: str = "doc_id",
    text: str = "text",
    piece: int = PIECE,
    overlap: int = OVERLAP,
) -> DataFrame:
    """(id, n_bytes, n_tokens) of every row: UTF-8 bytes and tokens of its whole text.

    Tokens are those of the library's plain call without added tokens; special strings
    inside a text are found as it finds them. Null counts as the empty text: no bytes
    and no tokens. Null and repeated ids keep a row each, equal texts have equal
    counts, an empty table gives none, and further columns are not read. A vocabulary
    whose words the splices are not proven for has its huge texts encoded whole.
    ``tokenizer_path`` must exist on every executor.
    """
    ship_code(docs.sparkSession)
    rows = docs.select(F.col(row_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("n_bytes", F.octet_length("text").cast("long"))
    short = _short_counts(rows.where(F.col("n_bytes") <= piece), tokenizer_path)
    huge = rows.where(F.col("n_bytes") > piece).withColumn("digest", F.sha2("text", 256))
    todo, counted = huge.select("digest", "text"), None
    while True:
        encoded = stored(_encoded_pieces(todo, tokenizer_path, piece, overlap), "pieces")
        found = stored(_spliced_counts(encoded), "spliced")
        done = found.where(~F.col("failed")).select("digest", "n_tokens")
        counted = done if counted is None else counted.unionByName(done)
        failed = found.where("failed").select("digest")
        if failed.isEmpty():
            break
        todo = todo.join(failed, "digest", "left_semi")
        piece, overlap = WIDER * piece, WIDER * overlap
    # Many rows may hold one text: they are spread over salts.
    salted = counted.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")
    long = huge.select("id", "n_bytes", "digest", salt.alias("salt")).join(salted, ["digest", "salt"])
    return short.unionByName(long.select("id", "n_bytes", "n_tokens"))
