"""Fill-in-the-middle transformation as a pipeline of Arrow kernels.

A text is a row of units (code points, or lines). Two cuts make it a prefix, a middle
and a suffix, which are written in another order behind marks, so that a model learns
to write the middle last. Per batch, units become list arrays, lists are flattened with
the numbers of their parents, every unit gets its ordinal in its text and from it a
role, units of one role are filtered, rebuilt into lists and joined to strings again.
No text is looped over in Python.

Cuts and forms follow from a hash of the id alone: the same on every run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import ship_code

#: Marks of the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM, SPM_BELOW = 90, 20
UNITS = ("chars", "lines")
#: Bytes of text whose units are taken apart at once, and bytes of text that make one
#: batch of results. Both bound memory only; a longer text is taken apart in segments.
SEGMENT_BYTES, OUTPUT_BYTES = 1_000_000, 16_000_000


def unit_marks(data: np.ndarray, units: str) -> np.ndarray:
    """Whether a unit starts at each byte; the first byte of ``data`` starts one."""
    if units == "chars":
        return (data & 0xC0) != 0x80
    return np.concatenate(([True], data[:-1] == 0x0A))[: len(data)]


def unit_counts(texts: pa.Array, units: str) -> pa.Array:
    if units == "chars":
        return pc.utf8_length(texts).cast(pa.int64())
    ends = pc.count_substring(texts, "\n").cast(pa.int64())
    open_ = pc.and_(pc.not_equal(texts, ""), pc.invert(pc.ends_with(texts, "\n")))
    return pc.add(ends, open_.cast(pa.int64()))


def _buffers(texts: pa.Array) -> tuple[np.ndarray, pa.Buffer, np.ndarray]:
    """Offsets, bytes and the bytes as an array of a string array without nulls."""
    _, offsets, data = texts.buffers()
    starts = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = data if data is not None else pa.py_buffer(b"")
    return starts.astype(np.int64), data, np.frombuffer(data, np.uint8)


def segments(starts: np.ndarray, data: np.ndarray, units: str) -> Iterator[list[tuple[int, int, int]]]:
    """Groups of (row, first byte, end byte), in order and of bounded size.

    A text longer than a group is cut before units; a unit is never cut.
    """
    group, size = [], 0
    for row, (a, end) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist())):
        while a < end:
            stop = min(end, a + max(SEGMENT_BYTES - size, 1))
            if stop < end and (group or stop - a < SEGMENT_BYTES):
                # The rest of a group is left to texts that fit.
                yield group
                group, size = [], 0
                continue
            if stop < end:
                marks = unit_marks(data[a : stop + 1], units)
                inside = np.flatnonzero(marks[1:])
                if len(inside):
                    stop = a + 1 + int(inside[-1])
                else:
                    stop = _next_unit(data, stop, end, units)
            group.append((row, a, stop))
            size += stop - a
            a = stop
            if size >= SEGMENT_BYTES:
                yield group
                group, size = [], 0
    if group:
        yield group


def _next_unit(data: np.ndarray, at: int, end: int, units: str) -> int:
    while at < end:
        marks = np.flatnonzero(unit_marks(data[at : min(at + 65_536, end)], units)[1:])
        if len(marks):
            return at + 1 + int(marks[0])
        # Overlaps by one byte, as a line starts behind the byte that ends the one before.
        at += max(min(65_536, end - at) - 1, 1)
    return end


def lists_of(values: pa.Array, parents: np.ndarray, count: int) -> pa.ListArray:
    """One list per parent number out of values in the order of their parents."""
    ends = np.cumsum(np.bincount(parents, minlength=count))
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), values)


def in_three(texts: pa.Array, low: pa.Array, high: pa.Array, units: str) -> list[pa.Array]:
    """Prefix, middle and suffix of each text, cut after ``low`` and ``high`` units."""
    starts, buffer, data = _buffers(texts)
    rows: list[int] = []
    joined: list[list[pa.Array]] = [[], [], []]
    seen_row, seen = -1, 0
    for group in segments(starts, data, units):
        begin, end = group[0][1], group[-1][2]
        row, first = (np.array([g[i] for g in group], np.int64) for i in (0, 1))
        marks = unit_marks(data[begin:end], units)
        marks[first - begin] = True
        at = np.flatnonzero(marks)
        # Units as list arrays, one list per segment, without copying a byte.
        offsets = pa.py_buffer(np.append(at, end - begin).astype(np.int32).tobytes())
        values = pa.StringArray.from_buffers(len(at), offsets, buffer.slice(begin, end - begin))
        list_starts = np.append(np.searchsorted(at, first - begin), len(at))
        lists = pa.ListArray.from_arrays(pa.array(list_starts, pa.int32()), values)
        flat, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
        # A segment that continues a text counts on from the segment before.
        before = np.zeros(len(group), np.int64)
        if group[0][0] == seen_row:
            before[0] = seen
        shift = pa.array(before - list_starts[:-1]).take(parent)
        ordinal = pc.add(pa.array(np.arange(len(at))), shift)
        seen_row = group[-1][0]
        seen = int(before[-1] + list_starts[-1] - list_starts[-2])
        owner = pa.array(row).take(parent)
        is_prefix = pc.less(ordinal, low.take(owner))
        is_suffix = pc.greater_equal(ordinal, high.take(owner))
        is_middle = pc.invert(pc.or_(is_prefix, is_suffix))
        for role, mask in enumerate((is_prefix, is_middle, is_suffix)):
            own = parent.filter(mask).to_numpy()
            joined[role].append(pc.binary_join(lists_of(flat.filter(mask), own, len(group)), ""))
        rows += row.tolist()
    out = []
    for parts in joined:
        pieces = pa.concat_arrays(parts) if parts else pa.array([], pa.string())
        out.append(pc.binary_join(lists_of(pieces, np.array(rows, np.int64), len(texts)), ""))
    return out


def _modulo(value: pa.Array, by: pa.Array) -> pa.Array:
    return pc.subtract(value, pc.multiply(pc.divide(value, by), by))


def transform(texts: pa.Array, h1: pa.Array, h2: pa.Array, form: pa.Array, units: str) -> list[pa.Array]:
    """n, units of the prefix and of the middle (null for plain), and the output."""
    n = unit_counts(texts, units)
    room = pc.add(n, 1)
    one, two = _modulo(h1, room), _modulo(h2, room)
    low, high = pc.min_element_wise(one, two), pc.max_element_wise(one, two)
    moved = pc.not_equal(form, "plain")
    out = texts
    if pc.any(moved).as_py():
        prefix, middle, suffix = in_three(*(x.filter(moved) for x in (texts, low, high)), units)
        psm = pc.binary_join_element_wise(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle, "")
        spm = pc.binary_join_element_wise(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle, "")
        chosen = pc.if_else(pc.equal(form.filter(moved), "spm"), spm, psm)
        out = pc.replace_with_mask(texts, moved, chosen)
    none = pa.scalar(None, pa.int64())
    return [n, pc.if_else(moved, low, none), pc.if_else(moved, pc.subtract(high, low), none), out]


def _row_groups(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(first row, rows) of groups of bounded length; a longer text is one of its own."""
    starts, _, _ = _buffers(texts)
    at = 0
    while at < len(texts):
        stop = int(np.searchsorted(starts, starts[at] + OUTPUT_BYTES, "right")) - 1
        stop = min(max(stop, at + 1), len(texts))
        yield at, stop - at
        at = stop


def infill(
    docs: DataFrame,
    row_id: str = "doc_id",
    text: str = "text",
    units: str = "chars",
    plain_from: int = PLAIN_FROM,
    spm_below: int = SPM_BELOW,
) -> DataFrame:
    """(id, n, form, prefix_units, middle_units, output) of every row.

    Of every hundred documents some stay plain, and of the others some have the suffix
    first (``spm``), the rest the prefix (``psm``). Null text is empty, and an empty
    text is plain, as is one that holds a mark, which could not be read back. Equal ids
    are cut at places drawn from the same numbers, a null id counts as the empty one.
    An empty table gives none; further columns are not read.
    """
    if units not in UNITS:
        raise ValueError(f"units is one of {UNITS}")
    ship_code(docs.sparkSession)
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col(row_id).cast("string"), F.lit(""))), 256)
    rows = docs.select(
        F.col(row_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"), digest.alias("digest")
    )
    h = [F.conv(F.substring("digest", 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]
    holds = F.contains("text", F.lit(PREFIX)) | F.contains("text", F.lit(SUFFIX)) | F.contains("text", F.lit(MIDDLE))
    plain = (F.col("text") == "") | holds | (h[2] % 100 >= plain_from)
    form = F.when(plain, "plain").when(h[3] % 100 < spm_below, "spm").otherwise("psm")
    rows = rows.select("id", "text", h[0].alias("h1"), h[1].alias("h2"), form.alias("form"))
    names = ["id", "n", "form", "prefix_units", "middle_units", "output"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, count in _row_groups(batch.column(1)):
                ids, texts, h1, h2, forms = batch.slice(at, count).columns
                n, low, middle, out = transform(texts, h1, h2, forms, units)
                yield pa.RecordBatch.from_arrays([ids, n, forms, low, middle, out], names)

    kind = dict(rows.dtypes)["id"]
    schema = f"id {kind}, n bigint, form string, prefix_units bigint, middle_units bigint, output string"
    return rows.mapInArrow(run, schema)


def restored(form, output):
    """The text out of an output and its form; a column expression.

    A text that holds no mark has none where its parts meet marks either, as no mark
    begins with the end of another.
    """
    parts = F.split(F.substr(output, F.lit(len(PREFIX) + 1)), f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    order = F.when(form == "psm", F.concat(parts[0], parts[2], parts[1]))
    return order.when(form == "spm", F.concat(parts[1], parts[2], parts[0])).otherwise(output)
