"""Byte-level BPE encoding and decoding of whole texts.

Pre-tokens found by ``pretokens`` are looked up in a cache; those not in it are merged
pair by pair, lowest rank first and leftmost among equals. Everything else works on
arrays of many texts at once.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from tickloom.llm.common import ship_code
from tickloom.llm.pretokens import boundaries

#: Code points worked on at once, and pre-tokens kept in a cache before it is emptied.
#: Both bound memory and change no result.
CHUNK_CHARS = 1_000_000
CACHE_PIECES = 500_000
CACHE_IDS = 8_000_000
SHORT_PIECE = 32

Encoder = Callable[[list[str]], tuple[np.ndarray, np.ndarray]]


class KeyTable:
    """64-bit keys to numbers: open addressing on arrays, for many keys at once."""

    def __init__(self, bits: int = 16):
        self.bits, self.size = bits, 0
        self.keys = np.zeros(1 << bits, np.uint64)
        self.values = np.zeros(1 << bits, np.int64)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for unknown ones. Keys are not 0."""
        slots = self._slots(keys)
        held = self.keys[slots]
        out = np.where(held == keys, self.values[slots], -1)
        open_ = np.flatnonzero((held != keys) & (held != 0))
        mask = len(self.keys) - 1
        slots = slots[open_]
        while len(open_):
            slots = (slots + 1) & mask
            held, wanted = self.keys[slots], keys[open_]
            hit = held == wanted
            out[open_[hit]] = self.values[slots[hit]]
            on = ~hit & (held != 0)
            open_, slots = open_[on], slots[on]
        return out

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Distinct keys that are not in the table yet."""
        self.size += len(keys)
        if 2 * self.size > len(self.keys):
            old = self.keys != 0
            keys = np.concatenate((self.keys[old], keys))
            values = np.concatenate((self.values[old], values))
            self.bits = max(self.bits + 1, int(3 * self.size).bit_length())
            self.keys = np.zeros(1 << self.bits, np.uint64)
            self.values = np.zeros(1 << self.bits, np.int64)
        slots, mask = self._slots(keys), len(self.keys) - 1
        while len(keys):
            free = self.keys[slots] == 0
            self.keys[slots[free]] = keys[free]
            won = free & (self.keys[slots] == keys)
            self.values[slots[won]] = values[won]
            keys, values, slots = keys[~won], values[~won], (slots[~won] + 1) & mask


@cache
def _point_values() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(7)
    return tuple(rng.integers(0, 1 << 64, 0x110000, np.uint64) for _ in range(2))


_STEP = 0x9DDFEA08EB382D69


@cache
def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""

    def run(base: int) -> np.ndarray:
        factors = np.full(count, base, np.uint64)
        factors[0] = 1
        return np.cumprod(factors)

    return run(_STEP), run(pow(_STEP, -1, 1 << 64))


def piece_keys(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Two independent 64-bit hashes of each slice of code points, by prefix sums."""
    up, down = _powers(1 << max(20, len(points).bit_length()))
    out = []
    for values in _point_values():
        sums = np.zeros(len(points) + 1, np.uint64)
        np.cumsum(values[points] * up[: len(points)], out=sums[1:])
        out.append((sums[ends] - sums[starts]) * down[starts])
    out[0] = out[0] | np.uint64(1)
    return np.stack(out)


class PieceCache:
    """Ids of pre-tokens seen before. A pre-token is known by 127 bits of hash."""

    def __init__(self, encode: Encoder):
        self.encode = encode
        self.clear()

    def clear(self) -> None:
        self.table = KeyTable()
        self.second = np.empty(0, np.uint64)
        self.flat = np.empty(0, np.uint32)
        self.ends = np.zeros(1, np.int64)

    def ids_of(self, joined: str, points: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """The ids of the slices, joined, and how many each slice has."""
        if len(self.second) > CACHE_PIECES or len(self.flat) > CACHE_IDS:
            self.clear()
        first, second = piece_keys(points, starts, ends)
        rows = self.table.find(first)
        known = rows >= 0
        known[known] = self.second[rows[known]] == second[known]
        new = np.flatnonzero(~known)
        if len(new):
            keys, at, back = np.unique(first[new], return_index=True, return_inverse=True)
            one = new[at]
            clash = second[one][back] != second[new]
            fresh = self.table.find(keys) < 0
            if clash.any() or not fresh.all():
                # Two pre-tokens with one first hash: encode without the cache.
                flat, counts = self.encode([joined[a:b] for a, b in zip(starts, ends)])
                return flat, counts
            pieces = [joined[a:b] for a, b in zip(starts[one].tolist(), ends[one].tolist())]
            flat, counts = self.encode(pieces)
            numbers = len(self.second) + np.arange(len(one))
            self.table.add(keys, numbers)
            self.second = np.concatenate((self.second, second[one]))
            self.ends = np.concatenate((self.ends, self.ends[-1] + np.cumsum(counts)))
            self.flat = np.concatenate((self.flat, flat))
            rows[new] = numbers[back]
        begin = self.ends[rows]
        counts = self.ends[rows + 1] - begin
        return gather(self.flat, begin, counts), counts


def gather(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Slices of ``flat``, one after the other."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    shift = np.repeat(starts - (ends - counts), counts)
    return flat[shift + np.arange(total)]


def chunks_of(texts: list[str]) -> Iterator[list[str]]:
    """The texts in groups of bounded length; a longer text is a group of its own."""
    group: list[str] = []
    size = 0
    for text in texts:
        if group and size + len(text) > CHUNK_CHARS:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield group


def encode_texts(texts: list[str], pieces: PieceCache) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Groups of texts, in order: their ids, joined, and how many each text has."""
    for group in chunks_of(texts):
        joined = "".join(group)
        sizes = np.fromiter(map(len, group), np.int64, len(group))
        text_starts = np.cumsum(sizes) - sizes
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        starts = boundaries(points, text_starts[sizes > 0])
        ends = np.append(starts[1:], len(points)) if len(starts) else starts
        ids, counts = pieces.ids_of(joined, points, starts, ends)
        # Pre-tokens of each text, then ids of each text.
        bounds = np.append(np.searchsorted(starts, text_starts), len(starts))
        sums = np.concatenate(([0], np.cumsum(counts)))
        yield ids, sums[bounds[1:]] - sums[bounds[:-1]]


class Ranks:
    """A rank file: bytes to ids, in the order of merging."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines]
        self.ids = {base64.b64decode(a): int(b) for a, b in pairs}
        size = max(self.ids.values()) + 1
        tokens = [b""] * size
        for token, i in self.ids.items():
            tokens[i] = token
        counts = np.fromiter(map(len, tokens), np.int64, size)
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.counts = counts
        self.starts = np.cumsum(counts) - counts
        # Pairs of tokens that merge, with the token they become: its id is its rank.
        whole, left, right = [], [], []
        for token, i in self.ids.items():
            for cut in range(1, len(token)):
                a, b = self.ids.get(token[:cut]), self.ids.get(token[cut:])
                if a is not None and b is not None:
                    whole.append(i)
                    left.append(a)
                    right.append(b)
        self.pairs = KeyTable()
        self.pairs.add(self._pair(np.array(left), np.array(right)), np.array(whole, np.int64))
        self.single = np.array([self.ids[bytes([i])] for i in range(256)], np.int64)
        self.pieces = PieceCache(self.encode)

    @staticmethod
    def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return ((left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)) + np.uint64(1)

    def encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pre-tokens, joined, and how many each has."""
        raw = [p.encode() for p in pieces]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        counts = np.zeros(len(raw), np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        low = 0
        for high in (8, 16, SHORT_PIECE):
            some = np.flatnonzero((sizes > low) & (sizes <= high))
            low = high
            if len(some):
                ids, lengths = self._merge_short([raw[i] for i in some], sizes[some], high)
                counts[some] = lengths
                found.append((np.repeat(some, lengths), ids[np.arange(high) < lengths[:, None]]))
        for i in np.flatnonzero(sizes > SHORT_PIECE):
            whole = self.ids.get(raw[i])
            ids = np.array([whole] if whole is not None else self._merge_long(raw[i]))
            counts[i] = len(ids)
            found.append((np.full(len(ids), i), ids))
        if not found:
            return np.empty(0, np.uint32), counts
        owner = np.concatenate([x for x, _ in found])
        flat = np.concatenate([x for _, x in found])
        return flat[np.argsort(owner, kind="stable")].astype(np.uint32), counts

    def _merge_short(self, raw: list[bytes], sizes: np.ndarray, width: int):
        """Merges many pre-tokens side by side, one pair of each at a time."""
        far = np.int64(1 << 40)
        cells = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in raw), np.uint8)
        ids = self.single[cells.reshape(len(raw), width)]
        lengths = sizes.copy()
        place = np.arange(width)

        def ranks_of(left: np.ndarray, right: np.ndarray) -> np.ndarray:
            found = self.pairs.find(self._pair(left, right))
            return np.where(found < 0, far, found)

        ranks = np.full((len(raw), width), far)
        inside = place[1:] < lengths[:, None]
        rows, columns = np.nonzero(inside)
        ranks[rows, columns] = ranks_of(ids[rows, columns], ids[rows, columns + 1])
        live = np.arange(len(raw))
        a, r, n = ids, ranks, lengths
        while True:
            at = r.argmin(axis=1)
            each = np.arange(len(a))
            least = r[each, at]
            on = least < far
            if not on.all():
                ids[live], lengths[live] = a, n
                live, a, r, n, at, least = live[on], a[on], r[on], n[on], at[on], least[on]
                each = np.arange(len(a))
            if not len(live):
                return ids, lengths
            moved = np.minimum(place + (place > at[:, None]), width - 1)
            a = np.take_along_axis(a, moved, 1)
            a[each, at] = least
            n = n - 1
            moved = np.minimum(place + (place >= at[:, None]), width - 1)
            r = np.take_along_axis(r, moved, 1)
            r[:, -1] = far
            for spot in (at - 1, at):
                good = np.flatnonzero((spot >= 0) & (spot + 1 < n))
                i = spot[good]
                r[good, i] = ranks_of(a[good, i], a[good, i + 1])

    def _merge_long(self, raw: bytes) -> list[int]:
        """The same by a heap: a long run of letters takes n log n steps."""
        get, n = self.ids.get, len(raw)
        end = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        alive = [True] * n
        heap: list[tuple[int, int, int]] = []

        def offer(i: int) -> None:
            j = end[i]
            if j < n:
                rank = get(raw[i : end[j]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, end[j]))

        for i in range(n):
            offer(i)
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not alive[i] or end[i] >= stop or end[i] >= n or end[end[i]] != stop:
                continue
            alive[end[i]] = False
            end[i] = stop
            if stop < n:
                before[stop] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [self.ids[raw[i : end[i]]] for i in range(n) if alive[i]]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the ids."""
        return gather(self.flat, self.starts[ids], self.counts[ids])


@cache
def load_ranks(path: str) -> Ranks:
    """One table per worker process; its cache serves all its tasks."""
    return Ranks(path)


def encode_documents(docs: DataFrame, ranks_path: str, text: str = "text") -> DataFrame:
    """Adds ``ids`` (little-endian unsigned 32-bit) and ``offsets`` of every text.

    ``offsets`` has the first byte of each id in the text, in the same form. Null is
    encoded as the empty text, which has no ids. Columns named ids and offsets are
    replaced. ``ranks_path`` must exist on every executor.
    """
    ship_code(docs.sparkSession)
    rows = docs.drop("ids", "offsets")
    schema = StructType([*rows.schema.fields, *_binary("ids", "offsets")])
    place = rows.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = load_ranks(ranks_path)
        for batch in batches:
            texts = [x or "" for x in batch.column(place).to_pylist()]
            at = 0
            for ids, counts in encode_texts(texts, ranks.pieces):
                ends = np.concatenate(([0], np.cumsum(ranks.counts[ids])))
                stops = np.cumsum(counts)
                offsets = ends[:-1] - np.repeat(ends[stops - counts], counts)
                cut = list(zip((stops - counts).tolist(), stops.tolist()))
                part = batch.slice(at, len(counts))
                at += len(counts)
                yield extended(
                    part,
                    ids=pa.array([ids[a:b].astype("<u4").tobytes() for a, b in cut], pa.binary()),
                    offsets=pa.array(
                        [offsets[a:b].astype("<u4").tobytes() for a, b in cut], pa.binary()
                    ),
                )

    return rows.mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, ranks_path: str, ids: str = "ids") -> DataFrame:
    """Adds ``decoded``: the bytes of ``ids``; null stays null.

    A column named decoded is replaced.
    """
    ship_code(encoded.sparkSession)
    rows = encoded.drop("decoded")
    schema = StructType([*rows.schema.fields, *_binary("decoded")])
    place = rows.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = load_ranks(ranks_path)
        for batch in batches:
            # Pieces of a batch, as bytes are several times as many as ids.
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [
                    None if x is None else ranks.decode(np.frombuffer(x, "<u4")).tobytes()
                    for x in part.column(place).to_pylist()
                ]
                yield extended(part, decoded=pa.array(texts, pa.binary()))

    return rows.mapInArrow(run, schema)


def encode_and_decode(docs: DataFrame, ranks_path: str, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, ids, decoded) of every row: ids of the whole text, and their bytes.

    One pass and one rank table a task serve both directions, and the text does not
    come back. Null is encoded as the empty text, which has no ids and no bytes.
    Repeated rows stay, an empty table gives none, further columns are not read.
    """
    ship_code(docs.sparkSession)
    rows = docs.select(F.col(row_id).alias("id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = load_ranks(ranks_path)
        for batch in batches:
            column, at = batch.column(1), 0
            for a, count in bounded_runs(column):
                texts = [x or "" for x in column.slice(a, count).to_pylist()]
                for ids, counts in encode_texts(texts, ranks.pieces):
                    stops = np.cumsum(counts)
                    parts = [ids[s - n : s] for n, s in zip(counts.tolist(), stops.tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(at, len(parts)),
                         pa.array([p.astype("<u4").tobytes() for p in parts], pa.binary()),
                         pa.array([ranks.decode(p).tobytes() for p in parts], pa.binary())],
                        ["id", "ids", "decoded"],
                    )
                    at += len(parts)

    return rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, ids binary, decoded binary")


def bounded_runs(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(first row, rows) of runs of some megabytes, so that few texts are copied at once."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    at, seen = 0, 0
    while at < len(texts):
        stop = int(np.searchsorted(sizes, seen + 4 * CHUNK_CHARS, "right"))
        stop = max(stop, at + 1)
        yield at, stop - at
        at, seen = stop, int(sizes[stop - 1])


def _binary(*names: str) -> list[StructField]:
    return [StructField(n, BinaryType()) for n in names]


def extended(batch: pa.RecordBatch, **more: pa.Array) -> pa.RecordBatch:
    """The batch with more columns behind its own."""
    names = [*batch.schema.names, *more]
    return pa.RecordBatch.from_arrays([*batch.columns, *more.values()], names)
