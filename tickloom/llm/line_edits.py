"""Line deduplication by a segment-partition edit join.

A line is repeated if an equal line, or one within two edits, came earlier in the
order of (document, line). Lines are cut into three segments: of two lines within two
edits, one keeps a whole segment, found in the other close to where it was. Segments
of the longer line are probed with substrings of the shorter lines' index, by length,
and candidates are verified by an edit distance on bit vectors of the band.

Links are not chained: a line goes because a line before it is near, whether or not
that one goes too. Lines with fewer than MIN_WORDS words and fewer than MIN_CHARS
characters besides blanks stay, as headings and short answers repeat in clean documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.blocks import grouped_pairs
from tickloom.llm.common import packed, ship_code, stored

EDITS = 2
MIN_WORDS = 8
#: Characters besides blanks that make up for words, as in text without blanks.
MIN_CHARS = 40
#: The line number that stands for all lines of a document.
WHOLE = -1
SALTS = 16
#: Buckets up to this many lines are paired by a join, others block by block.
SMALL_BUCKET = 32
#: Pairs compared in one step, and code points of one side with their padding.
VERIFY_PAIRS, VERIFY_CELLS = 2048, 2_000_000
LINE_END = "\n"


def segment_key(
    line: Column, length: Column, less: Column | int, number: Column | int, shift: Column | int, edits: int
) -> Column:
    """What a line has in the place of a segment of a line that is shorter by ``less``.

    Of its ``edits + 1`` segments, the last are longer. The key is that line's length, the
    segment's number and the text that starts ``shift`` places off; null where the line
    does not reach.
    """
    parts = edits + 1
    other = length - (F.lit(less) if isinstance(less, int) else less)
    number = F.lit(number) if isinstance(number, int) else number
    longer = other % parts
    least = ((other - longer) / parts).cast("int")
    before = F.greatest(longer - (parts - number), F.lit(0))
    size = least + F.when(parts - number <= longer, 1).otherwise(0)
    begin = least * number + before + 1 + shift
    inside = (begin >= 1) & (begin + size - 1 <= length)
    return F.when(inside, F.xxhash64(other, number, F.substring(line, begin, size)))


def lookups(edits: int = EDITS) -> list[tuple[int, int, int]]:
    """(less, number, shift) of all places that a line is looked up by; its own come first.

    Of segment i (from 0) in a line shorter by ``less``, substrings start at most i
    places off, counted from either end, as at most i edits lie before it or the rest
    behind it.
    """
    own = [(0, i, 0) for i in range(edits + 1)]
    out = []
    for less in range(edits + 1):
        for i in range(edits + 1):
            behind = edits - i
            low, high = max(-i, less - behind), min(i, less + behind)
            out += [(less, i, shift) for shift in range(low, high + 1)]
    return own + [x for x in out if x not in own]


def index_keys(line: Column, length: Column, edits: int = EDITS) -> list[Column]:
    """A key per segment of a line."""
    return [segment_key(line, length, *x, edits) for x in lookups(edits)[: edits + 1]]


def probe_keys(line: Column, length: Column, edits: int = EDITS) -> list[Column]:
    """Keys a line is looked up by, besides its own index keys, for lines as long as
    it or shorter."""
    return [segment_key(line, length, *x, edits) for x in lookups(edits)[edits + 1 :]]


def within_edits(left: np.ndarray, m: np.ndarray, right: np.ndarray, n: np.ndarray, edits: int) -> np.ndarray:
    """Whether pairs of lines lie within ``edits`` of each other.

    Rows of ``left`` and ``right`` are code points, padded by different values; m and
    n are lengths that differ by ``edits`` at most. The band of 2 * edits + 1 cells
    moves down one row a column; its vertical differences are bits of two numbers.
    """
    width = 2 * edits + 1
    full = np.uint64((1 << width) - 1)
    pairs = len(m)
    # Bit b of a column stands for row (column - edits + b), both from 1. In column 0
    # every row from 1 on is one more than the row before.
    up = np.full(pairs, ((1 << (edits + 1)) - 1) << edits, np.uint64)
    down = np.zeros(pairs, np.uint64)
    score = np.minimum(m, edits)
    columns = int(n.max(initial=0))
    padded = np.full((pairs, max(left.shape[1], columns) + 2 * width), -1, np.int64)
    padded[:, edits : edits + left.shape[1]] = left
    one = np.uint64(1)
    for j in range(columns):
        match = np.zeros(pairs, np.uint64)
        for b in range(width):
            match |= (padded[:, j + b] == right[:, j]).astype(np.uint64) << np.uint64(b)
        flat = ((((match & up) + up) ^ up) | match | down) & full
        over = (down | ~(flat | up)) & full
        under = flat & up
        live = j < n
        lowest = j + 1 + edits
        # Along the lowest diagonal of the band while it is inside the left line,
        # then along that line's last row.
        diagonal = live & (lowest <= m)
        score += diagonal & ((flat >> np.uint64(width - 1)) & one == 0)
        flatly = live & (lowest > m)
        bit = np.clip(m - (j + 1) + edits, 0, width - 1).astype(np.uint64)
        score += flatly & ((over >> bit) & one == 1)
        score -= flatly & ((under >> bit) & one == 1)
        shifted = flat >> one
        up = (under | ~(shifted | over)) & full
        down = shifted & over
    return score <= edits


def _points(lines: list[str], pad: int) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    flat = np.frombuffer("".join(lines).encode("utf-32-le"), np.uint32)
    out = np.full((len(lines), max(int(sizes.max(initial=0)), 1)), pad, np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out, sizes


def near_pairs(left: list[str], right: list[str], edits: int = EDITS) -> np.ndarray:
    """Whether left[i] and right[i] lie within ``edits``."""
    out = np.zeros(len(left), bool)
    size_l = np.fromiter(map(len, left), np.int64, len(left))
    size_r = np.fromiter(map(len, right), np.int64, len(right))
    fit = np.flatnonzero(np.abs(size_l - size_r) <= edits)
    # Lines of like lengths together, so that padding stays small.
    fit = fit[np.argsort(np.maximum(size_l[fit], size_r[fit]), kind="stable")]
    longest = np.maximum(np.maximum(size_l[fit], size_r[fit]), 1)
    at = 0
    while at < len(fit):
        # All lines of a step are padded to its longest, which is its last.
        cells = longest[at : at + VERIFY_PAIRS] * np.arange(1, len(fit[at : at + VERIFY_PAIRS]) + 1)
        stop = at + max(1, int(np.searchsorted(cells, VERIFY_CELLS, side="right")))
        some = fit[at:stop]
        a, m = _points([left[i] for i in some], -2)
        b, n = _points([right[i] for i in some], -3)
        out[some] = within_edits(a, m, b, n, edits)
        at = stop
    return out


def occurrences(docs: DataFrame, row_id: str, text: str, min_words: int) -> DataFrame:
    """(doc, line_no, line) of every line with enough words or characters."""
    lines = F.split(F.col(text), LINE_END)
    rows = docs.select(F.col(row_id).alias("doc"), F.posexplode(lines).alias("line_no", "line"))
    return rows.where(is_long(F.col("line"), min_words))


def is_long(line: Column, min_words: int) -> Column:
    return has_words(line, min_words) | has_chars(line, MIN_CHARS)


def has_words(line: Column, count: int) -> Column:
    """Whether a line has so many words; stops reading at the last one needed."""
    gap, word = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"
    return line.rlike(f"^{gap}*+(?:{word}++{gap}++){{{count - 1}}}{word}")


def has_chars(line: Column, count: int) -> Column:
    """Whether a line has so many characters besides blanks; stops at the last one needed."""
    return line.rlike(rf"^(?:[\x20\x09-\x0D]*+[^\x20\x09-\x0D]){{{count}}}")


def repeated_lines(
    docs: DataFrame,
    row_id: str = "doc_id",
    text: str = "text",
    edits: int = EDITS,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """(doc, line_no, near) of every line that repeats an earlier one.

    ``near`` is false for an equal line and true for one within some edits. Lines of
    null texts and short lines do not count. Rows that repeat an id and a text are one
    document, and so are their lines; a null id sorts first. An empty table gives none.
    """
    ship_code(docs.sparkSession)
    place = F.struct("doc", "line_no")
    # Equal lines become one: their first place, and a number that only narrows the
    # search for candidates (texts decide).
    seen = occurrences(docs, row_id, text, min_words)
    firsts = seen.groupBy("line").agg(F.min(place).alias("first"), F.count("*").alias("places"))
    size = F.length("line").alias("length")
    firsts = firsts.select(F.xxhash64("line").alias("line_key"), "line", size, "first", "places")
    firsts = stored(firsts, "first_lines", compression="zstd")
    near = stored(_near_lines(firsts, edits), "near_lines")
    # A place that is not its line's first repeats it; a first place may be near. Two
    # hashes stand for the text here: 128 bits.
    digest = F.struct(F.xxhash64("line").alias("x"), F.xxhash64(F.lit(1), "line").alias("y"))
    digest = digest.alias("digest")
    own = firsts.where("places > 1").select(digest, "first")
    later = (
        seen.select("doc", "line_no", digest)
        .join(own, "digest")
        .where(~F.struct("doc", "line_no").eqNullSafe(F.col("first")))
        .select("doc", "line_no", F.lit(False).alias("near"))
    )
    first = near.select(
        F.col("first.doc").alias("doc"), F.col("first.line_no").alias("line_no"), F.lit(True).alias("near")
    )
    return later.unionByName(first).distinct()


def _near_lines(firsts: DataFrame, edits: int) -> DataFrame:
    """(first) of the lines within some edits of a line with an earlier place."""
    # One short expression for every place, as one for all of them at once is more code
    # than the JVM compiles.
    places = F.array(*(
        F.struct(*map(F.lit, x), F.lit(int(n <= edits)).alias("i")) for n, x in enumerate(lookups(edits))
    )).cast("array<struct<less: int, number: int, shift: int, i: int>>")
    entered = firsts.where(F.col("length") > edits).select("line_key", "line", "length", F.inline(places))
    key = segment_key(F.col("line"), F.col("length"), F.col("less"), F.col("number"), F.col("shift"), edits)
    entered = entered.select(key.alias("key"), "line_key", "i").where("key IS NOT NULL")
    # Only keys under which an indexed line meets another line go on.
    own = Window.partitionBy("key")
    met = entered.select(
        "*",
        F.count("*").over(own).alias("n"),
        F.max("i").over(own).alias("held"),
        F.min("line_key").over(own).alias("least"),
        F.max("line_key").over(own).alias("most"),
    )
    met = met.where("held = 1 AND least <> most").select("key", "line_key", "i", "n")
    met = stored(met, "met_lines")
    few = met.where(F.col("n") <= 2 * SMALL_BUCKET)
    a = few.where("i = 1").select("key", F.col("line_key").alias("a"))
    b = few.select("key", F.col("line_key").alias("b"))
    pairs = a.join(b, "key").where("a <> b")
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    wanted = met.select("line_key").distinct()
    # Keys grow with the corpus, so they are never broadcast.
    texts = stored(firsts.join(wanted.hint("merge"), "line_key", "left_semi"), "met_texts")
    one = texts.select(F.col("line_key").alias("a"), F.col("line").alias("la"), F.col("first").alias("fa"))
    two = texts.select(F.col("line_key").alias("b"), F.col("line").alias("lb"), F.col("first").alias("fb"))
    compared = pairs.join(one, "a").join(two, "b").select("la", "fa", "lb", "fb")
    first_type = firsts.schema["first"].dataType.simpleString()

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = near_pairs(batch.column(0).to_pylist(), batch.column(2).to_pylist(), edits)
            kept = batch.filter(pa.array(good))
            yield pa.RecordBatch.from_arrays([kept.column(1), kept.column(3)], ["fa", "fb"])

    linked = compared.mapInArrow(verify, f"fa {first_type}, fb {first_type}")
    linked = linked.select(F.greatest("fa", "fb").alias("first"))
    many = met.where(F.col("n") > 2 * SMALL_BUCKET).select("key", "line_key").distinct()
    many = many.join(texts, "line_key").withColumn("place", F.xxhash64("first"))

    def compare(table: pa.Table) -> pa.Table:
        sides = [table.filter(pc.equal(table["side"], s)) for s in (0, 1)]
        left, right = sides[0], sides[1] if sides[1].num_rows else None
        later = later_in_block(left["line"].to_pylist(), _places(left), None if right is None
                               else right["line"].to_pylist(), None if right is None else _places(right), edits)
        firsts_left = left["first"].take(pa.array(later[0], pa.int64()))
        if right is None:
            return pa.table({"first": firsts_left})
        firsts_right = right["first"].take(pa.array(later[1], pa.int64()))
        return pa.table({"first": pa.chunked_array(firsts_left.chunks + firsts_right.chunks, firsts_left.type)})

    heavy = grouped_pairs(many, "key", "place").applyInArrow(compare, f"first {first_type}")
    return linked.unionByName(heavy).distinct()


def _places(rows: pa.Table) -> list[tuple]:
    """Places as tuples in their order; a null id comes first."""
    return [
        (x["doc"] is not None, x["doc"] if x["doc"] is not None else 0, x["line_no"])
        for x in rows["first"].to_pylist()
    ]


def later_in_block(left: list[str], place_l: list, right: list[str] | None, place_r: list | None, edits: int):
    """Numbers of lines, on either side, that have a near line with an earlier place."""
    inside = right is None
    if inside:
        right, place_r = left, place_l
    gone_l, gone_r = np.zeros(len(left), bool), np.zeros(len(right), bool)
    bins_l, bins_r = _letters(left), _letters(right)
    for x in range(len(left)):
        # An edit changes the counts of letters by two at most.
        some = np.flatnonzero(np.abs(bins_r - bins_l[x]).sum(axis=1) <= 2 * edits)
        some = some[some > x] if inside else some
        if not len(some):
            continue
        near = some[near_pairs([left[x]] * len(some), [right[y] for y in some], edits)]
        for y in near.tolist():
            if place_l[x] > place_r[y]:
                gone_l[x] = True
            elif place_l[x] < place_r[y]:
                gone_r[y] = True
    if inside:
        return np.flatnonzero(gone_l | gone_r), np.empty(0, np.int64)
    return np.flatnonzero(gone_l), np.flatnonzero(gone_r)


def _letters(lines: list[str]) -> np.ndarray:
    """Counts of code points modulo 32."""
    out = np.zeros((len(lines), 32), np.int64)
    for i, line in enumerate(lines):
        out[i] = np.bincount(np.frombuffer(line.encode("utf-32-le"), np.uint32) % 32, minlength=32)
    return out


def repeated_texts(docs: DataFrame, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, line_no, near) of documents whose whole text equals that of an earlier one.

    ``line_no`` is WHOLE: all lines go, short ones included. Texts too short for a line
    that counts do not count either. A null id sorts first; rows that repeat an id and
    a text are one document.
    """
    whole = docs.where(is_long(F.col(text), MIN_WORDS)).select(
        F.col(row_id).alias("doc"),
        F.struct(F.xxhash64(text).alias("x"), F.xxhash64(F.lit(1), text).alias("y")).alias("digest"),
    )
    first = whole.groupBy("digest").agg(F.min(F.struct("doc")).alias("first"), F.count("*").alias("n"))
    # A text may be that of a third of all documents: its copies are spread over salts.
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    first = first.where("n > 1").select("digest", "first", salts.alias("salt"))
    salt = F.pmod(F.xxhash64("doc", F.lit(2)), F.lit(SALTS)).cast("int")
    later = whole.withColumn("salt", salt).join(first, ["digest", "salt"])
    return later.where(~F.struct("doc").eqNullSafe(F.col("first"))).select(
        "doc", F.lit(WHOLE).alias("line_no"), F.lit(False).alias("near")
    )


def remaining(
    docs: DataFrame,
    dropped: DataFrame,
    row_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Documents without their repeated lines.

    A document goes as a whole if it repeats an earlier one, if no word is left, or if
    the lines that go make up most of it (by characters besides blanks): what is left
    of a copy with changes should not pass for a document. Others keep all their other
    lines, short ones included. Documents that lose no line are unchanged, null texts
    among them; further columns are kept whatever their names.
    """
    rows = packed(docs, F.col(row_id).alias("id"), F.col(text).alias("body"))
    lists = dropped.groupBy(F.col("doc").alias("known")).agg(F.collect_set("line_no").alias("gone"))
    joined = rows.join(lists, F.col("id").eqNullSafe(F.col("known")), "left")
    kept = F.filter(F.split("body", LINE_END), lambda x, i: ~F.array_contains(F.col("gone"), i))
    touched = F.col("gone").isNotNull()
    joined = joined.withColumn("left", F.when(touched, F.array_join(kept, LINE_END)))

    def chars(value: Column) -> Column:
        return F.length(F.regexp_replace(value, r"[\x20\x09-\x0D]+", ""))

    most = 2 * chars(F.col("left")) < chars(F.col("body"))
    goes = touched & (F.array_contains("gone", WHOLE) | most | (chars(F.col("left")) == 0))
    changed = F.col("row").withField(f"`{text}`", F.coalesce("left", "body"))
    return joined.where(~F.coalesce(goes, F.lit(False))).select(changed.alias("row")).select("row.*")
