"""Exponential moving average as windows over chunks.

With smoothing ``a = 2 / (span + 1)`` and ``q = 1 - a``, a known price ``x`` that
comes ``g`` rows after the last known one has the share ``c = a / (q**g + a)`` in
the new average: ``e -> (1 - c) * e + c * x``. That step is affine in ``e``. Let
``e_1`` be the average at the first known price of a chunk and ``P`` the product of
``1 - c`` over the steps since; then

    e_t = P_t * (e_1 + sum(c_i * x_i / P_i))

which is a cumulative sum. Every term weighs less the older it is, exactly as in
the recursion, so nothing cancels; ``P`` stays inside the range of a double because
a chunk's length is bounded (``chunk_days``). What a chunk needs from the chunks
before is ``e_1``; a short fold over the chunks of a symbol supplies it.

Rows without a price repeat the last average; rows before the first price have
none. The expressions are SQL text, which builds a plan of this size in a fraction
of the calls that column objects take.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators.chunks import CHUNK, CHUNK_DAYS

# Powers of ten a chunk's factor may shrink by.
MAX_SHRINK = 290

ORDERED = f"PARTITION BY symbol, {CHUNK} ORDER BY date"
SO_FAR = f"OVER ({ORDERED} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
BEFORE = f"OVER ({ORDERED} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


def smoothing(span: int) -> float:
    return 2.0 / (span + 1)


def chunk_days(spans: Sequence[int]) -> int:
    """Chunk length that keeps every span's factor representable."""
    if not spans:
        return CHUNK_DAYS
    if min(spans) < 2:
        raise ValueError("a span is at least 2")
    decades_per_row = -math.log10(1 - smoothing(min(spans)))
    return min(CHUNK_DAYS, int(MAX_SHRINK / decades_per_row))


def add(rows: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    return rows.selectExpr("*", *[f"{text} AS {name}" for name, text in columns.items()])


def known(value: str) -> str:
    """``value`` on the chunk's own rows that have a price."""
    return f"CASE WHEN NOT _halo AND current_price IS NOT NULL THEN {value} END"


# Number of the row within its chunk, halo rows not counted.
POSITION = f"sum(CASE WHEN NOT _halo THEN 1 END) {SO_FAR}"
# Rows since the last known price; null on the chunk's first one.
GAP = known(f"_at - last({known('_at')}, true) {BEFORE}")


def share(span: int, rows: str) -> str:
    """Weight of a price that comes ``rows`` rows after the last known one."""
    alpha = smoothing(span)
    return f"({alpha!r}D / (power({(1 - alpha)!r}D, {rows}) + {alpha!r}D))"


def with_factors(
    rows: DataFrame, spans: Sequence[int], also: Mapping[str, str] | None = None
) -> DataFrame:
    """Adds ``_share_<span>`` and ``_factor_<span>`` (``c`` and ``P``) from ``_gap``.

    Steps of one row are counted, so their factor is one exact power; only the few
    longer ones go through logarithms. ``also`` are window columns to add on the way.
    """
    shares, logs, factors = {}, {}, {}
    for s in spans:
        shares[f"_share_{s}"] = (
            f"CASE WHEN _gap = 1 THEN {smoothing(s)!r}D "
            f"WHEN _gap > 1 THEN {share(s, '_gap')} END"
        )
        logs[f"_log_{s}"] = f"sum(CASE WHEN _gap > 1 THEN ln(1 - _share_{s}) END) {SO_FAR}"
        factors[f"_factor_{s}"] = (
            f"power({(1 - smoothing(s))!r}D, _steps) * coalesce(exp(_log_{s}), 1.0D)"
        )
    steps = f"count(CASE WHEN _gap = 1 THEN 1 END) {SO_FAR}"
    rows = add(add(rows, shares), {"_steps": steps, **logs, **(also or {})})
    return add(rows, factors)


def _term(span: int) -> str:
    return f"_share_{span} * current_price / _factor_{span}"


def summary_columns(spans: Sequence[int]) -> dict[str, str]:
    """Aggregates that reduce one chunk to what the fold needs."""
    at = known("_at")
    columns = {
        "_rows": "count(1)",
        "_first_at": f"min({at})",
        "_last_at": f"max({at})",
        "_first_price": f"min_by(current_price, {at})",
    }
    for s in spans:
        columns[f"_factor_{s}"] = f"min(_factor_{s})"
        columns[f"_terms_{s}"] = f"coalesce(sum({_term(s)}), 0.0D)"
    return columns


def carry_fold(chunks: DataFrame, spans: Sequence[int], keep: Sequence[str]) -> DataFrame:
    """Per chunk: ``keep``, ``_trailing``, ``_carry_<span>`` and ``_open_<span>``.

    ``_trailing`` counts the rows before the chunk since the last known price. A carry
    is the average before the chunk, an open the one at its first known price. One row
    per chunk goes in, so a symbol is at most a few thousand small structs.
    """
    fields = [CHUNK, "_rows", "_first_at", "_last_at", "_first_price"]
    for s in spans:
        fields += [f"_factor_{s}", f"_terms_{s}"]
    ordered = F.sort_array(F.collect_list(F.struct(*fields, *keep)))
    grouped = chunks.groupBy("symbol").agg(ordered.alias("_chunks"))

    names = [f"{part}_{s}" for s in spans for part in ("_carry", "_open")]
    entry_type = ", ".join(["_trailing: bigint", *(f"{name}: double" for name in names)])
    start = ", ".join(
        [f"'done', cast(array() AS array<struct<{entry_type}>>)", "'trailing', 0L"]
        + [f"'ema_{s}', cast(null AS double)" for s in spans]
    )
    entry, averages = ["'_trailing', state.trailing"], []
    for s in spans:
        old = f"state.ema_{s}"
        weight = share(s, "(state.trailing + chunk._first_at)")
        opening = (
            f"coalesce({old} + {weight} * (chunk._first_price - {old}), chunk._first_price)"
        )
        closing = f"chunk._factor_{s} * ({opening} + chunk._terms_{s})"
        entry += [f"'_carry_{s}', {old}", f"'_open_{s}', {opening}"]
        averages.append(f"'ema_{s}', coalesce({closing}, {old})")
    step = ", ".join(
        [
            f"'done', concat(state.done, array(named_struct({', '.join(entry)})))",
            "'trailing', CASE WHEN chunk._first_at IS NOT NULL "
            "THEN chunk._rows - chunk._last_at ELSE state.trailing + chunk._rows END",
            *averages,
        ]
    )
    fold = (
        f"aggregate(_chunks, named_struct({start}), "
        f"(state, chunk) -> named_struct({step})).done"
    )
    pairs = grouped.selectExpr("symbol", f"explode(arrays_zip(_chunks, {fold})) AS p")
    return pairs.selectExpr(
        "symbol",
        *[f"p._chunks.{name}" for name in (CHUNK, *keep)],
        *[f"p.done.{name}" for name in ("_trailing", *names)],
    )


def carried_columns(spans: Sequence[int]) -> dict[str, str]:
    """Spread the carried values from a chunk's halo rows over its own rows.

    A symbol's first chunk has no halo; its average opens at its first price.
    """
    columns = {"_known_rows": f"count({known('1')}) {SO_FAR}"}
    for s in spans:
        opening = f"coalesce(_open_{s}, {known('current_price')})"
        columns[f"_carried_{s}"] = f"first(_carry_{s}, true) {SO_FAR}"
        columns[f"_opening_{s}"] = f"first({opening}, true) {SO_FAR}"
    return columns


def with_averages(rows: DataFrame, spans: Sequence[int]) -> DataFrame:
    """Adds ``ema_<span>`` to rows that have factors and carried values."""
    sums = {f"_sum_{s}": f"sum({_term(s)}) {SO_FAR}" for s in spans}
    averages = {
        f"ema_{s}": f"CASE WHEN _known_rows > 0 "
        f"THEN _factor_{s} * (_opening_{s} + coalesce(_sum_{s}, 0.0D)) "
        f"ELSE _carried_{s} END"
        for s in spans
    }
    return add(add(rows, sums), averages)
