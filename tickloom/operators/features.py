"""All feature columns of the price table in one pass over its chunks.

What a symbol's past leaves to its future is small: the last rows that frames reach
back to, first and last known price, and the averages. ``feature_state`` keeps that,
one row per symbol, and ``add_features`` goes on from it, so that a day's features need
the day's rows and the state alone. A stored state enters the computation as a chunk
before all others; a new one is what a chunk behind all others would start from.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators import ema
from tickloom.operators.chunks import CHUNK, HALO, attach_per_symbol, chunk_of, rows_before
from tickloom.operators.ema import BEFORE, ORDERED, SO_FAR, add
from tickloom.schemas import FULL_STOCK_CALCULATIONS

MEAN_SIZES = (10, 30)
VOLATILITY_SIZE = 30
SPANS = (10, 30)
WARM_UP = 30

CHUNKS_BEFORE = (
    f"OVER (PARTITION BY symbol ORDER BY {CHUNK} "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
)
CHUNKS_SO_FAR = (
    f"OVER (PARTITION BY symbol ORDER BY {CHUNK} "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
)


# Numbers of the chunk that a stored state stands for and of the one behind all rows.
BEGIN, END = -(1 << 31), (1 << 31) - 1


def _chunk_table(rows: DataFrame, back: int, spans: Sequence[int]) -> DataFrame:
    """One row per chunk: its last rows, its prices and its part of the averages."""
    local = rows.selectExpr("symbol", CHUNK, "date", "current_price", f"false AS {HALO}")
    local = add(
        local,
        {
            "_at": ema.POSITION,
            "_seed": f"last(current_price, true) {SO_FAR}",
            "_size": f"count(1) OVER (PARTITION BY symbol, {CHUNK})",
        },
    )
    local = ema.with_factors(add(local, {"_gap": ema.GAP}), spans)
    aggregates = {
        "_tail": f"sort_array(collect_list(CASE WHEN _size - _at < {back} "
        "THEN struct(date, current_price, _seed) END))",
        "_first_row_price": "min_by(current_price, _at)",
        "_last_known": "max_by(_seed, _at)",
        **ema.summary_columns(spans),
    }
    return local.groupBy("symbol", CHUNK).agg(
        *[F.expr(text).alias(name) for name, text in aggregates.items()]
    )


def _state_chunks(state: DataFrame, spans: Sequence[int]) -> DataFrame:
    """A stored state as a chunk: one price of 0 whose further terms are the average."""
    known = "last_price IS NOT NULL"
    one = f"CASE WHEN {known} THEN 1L END"
    return state.selectExpr(
        "symbol",
        f"{BEGIN} AS {CHUNK}",
        "transform(tail, r -> struct(r.date, r.current_price, r.known AS _seed)) AS _tail",
        "first_price AS _first_row_price",
        "last_price AS _last_known",
        "trailing + 1 AS _rows",
        f"{one} AS _first_at",
        f"{one} AS _last_at",
        f"CASE WHEN {known} THEN 0.0D END AS _first_price",
        *[f"1.0D AS _factor_{s}" for s in spans],
        *[f"coalesce(ema_{s}, 0.0D) AS _terms_{s}" for s in spans],
    )


def _chunk_carries(
    rows: DataFrame,
    back: int,
    spans: Sequence[int],
    state: DataFrame | None = None,
    behind: bool = False,
) -> DataFrame:
    """What every chunk starts from: ``_before`` (rows), known price and averages.

    ``_start`` is the first price of the symbol. With ``behind`` there is a chunk more,
    which starts where the symbol's rows end.
    """
    chunks = _chunk_table(rows, back, spans)
    if state is not None:
        chunks = chunks.unionByName(_state_chunks(state, spans))
    if behind:
        last = chunks.select("symbol").distinct().selectExpr(
            "symbol", f"{END} AS {CHUNK}", "0L AS _rows", *[f"0.0D AS _terms_{s}" for s in spans]
        )
        chunks = chunks.unionByName(last, allowMissingColumns=True)
    chunks = add(
        chunks,
        {
            "_known_before": f"last(_last_known, true) {CHUNKS_BEFORE}",
            "_start": f"first(_first_row_price) {CHUNKS_SO_FAR}",
        },
    )
    seeded = (
        "transform(coalesce(_tail, array()), r -> struct(r.date, r.current_price, "
        "coalesce(r._seed, _known_before) AS _seed))"
    )
    chunks = add(chunks, {"_seeded": seeded})
    chunks = chunks.withColumn("_before", rows_before("_seeded", back))
    return ema.carry_fold(chunks, spans, keep=["_start", "_known_before", "_before"])


def _halo_rows(
    rows: DataFrame, back: int, spans: Sequence[int], state: DataFrame | None = None
) -> DataFrame:
    """Halo rows of every chunk, each with the values carried into the chunk.

    ``_seed`` is the last known price at a halo row, ``_start`` the first price of
    the symbol, ``_carry_<span>`` and ``_open_<span>`` belong to the averages.
    """
    carried = _chunk_carries(rows, back, spans, state).where(f"{CHUNK} > {BEGIN}")
    return carried.selectExpr("*", "inline(_before)").drop("_before", "_known_before", "_trailing")


def feature_state(
    prices: DataFrame,
    state: DataFrame | None = None,
    back: int = max(WARM_UP, VOLATILITY_SIZE, *MEAN_SIZES),
    spans: Sequence[int] = SPANS,
) -> DataFrame:
    """One row per symbol: what the features of later rows need of these.

    With ``state``, what an earlier call left, ``prices`` holds later rows; those of a
    symbol up to the day its state reaches do not count. Symbols without a later row
    keep their state.
    """
    if state is not None:
        prices = rows_after(prices, state)
    rows = prices.withColumn(CHUNK, chunk_of(days=ema.chunk_days(spans)))
    carried = _chunk_carries(rows, back, spans, state, behind=True).where(f"{CHUNK} = {END}")
    return carried.selectExpr(
        "symbol",
        "element_at(_before, -1).date AS last_date",
        "transform(_before, r -> struct(r.date, r.current_price, r._seed AS known)) AS tail",
        "_start AS first_price",
        "_known_before AS last_price",
        "_trailing AS trailing",
        *[f"_carry_{s} AS ema_{s}" for s in spans],
    )


def rows_after(prices: DataFrame, state: DataFrame) -> DataFrame:
    """Rows of each symbol after the day its state reaches; all of a new symbol."""
    reached = state.select("symbol", F.col("last_date").alias("_reached"))
    rows = attach_per_symbol(prices, reached)
    return rows.where("_reached IS NULL OR date > _reached").drop("_reached")


def _with_carries(
    prices: DataFrame,
    back: int,
    spans: Sequence[int],
    since: datetime.date | None = None,
    state: DataFrame | None = None,
) -> DataFrame:
    """Price rows cut into chunks, with halo rows and what they carry.

    With ``since`` only the chunks that reach that day are kept. The chunks before
    are still summed up, which takes three columns of them.
    """
    days = ema.chunk_days(spans)
    rows = prices.withColumn(CHUNK, chunk_of(days=days))
    halo = _halo_rows(rows, back, spans, state)
    if since is not None:
        epoch = datetime.date(1970, 1, 1)
        first = (since - epoch).days // days
        begin = epoch + datetime.timedelta(days=first * days)
        rows = rows.where(F.col("date") >= F.lit(begin))
        halo = halo.where(F.col(CHUNK) >= first)
    return rows.withColumn(HALO, F.lit(False)).unionByName(
        halo.withColumn(HALO, F.lit(True)), allowMissingColumns=True
    )


def _percent(now: str, before: str) -> str:
    return f"(try_divide({now}, {before}) - 1) * 100"


def _over_last(figure: str, size: int) -> str:
    return f"{figure} OVER ({ORDERED} ROWS BETWEEN {size - 1} PRECEDING AND CURRENT ROW)"


def _before_frame(running: str, size: int) -> str:
    """A running count as it stood just before a frame of ``size`` rows."""
    return f"lag({running}, {size}, 0L) OVER ({ORDERED})"


def add_features(
    prices: DataFrame,
    warm_up: int = WARM_UP,
    mean_sizes: Sequence[int] = MEAN_SIZES,
    volatility_size: int = VOLATILITY_SIZE,
    spans: Sequence[int] = SPANS,
    since: datetime.date | None = None,
    state: DataFrame | None = None,
) -> DataFrame:
    """Returns, rolling means, volatility and averages; warm-up rows left out.

    ``prices`` has one row per (symbol, date). Its other columns are kept. The
    single-figure operators in ``returns`` give the same columns one at a time.
    ``since`` leaves out rows before that day; the rows that stay are the same.
    With ``state``, what ``feature_state`` made of earlier rows, ``prices`` holds later
    ones, and the past is not read: the rows are those of a run over everything.
    """
    if state is not None:
        prices = rows_after(prices, state)
    back = max(warm_up, volatility_size, *mean_sizes)
    known_price = f"CASE WHEN {HALO} THEN _seed ELSE current_price END"
    first_price = f"CASE WHEN {HALO} THEN _start ELSE current_price END"
    # Values inside a frame are the difference of two running counts. Counting them
    # frame by frame would visit every row of the frame again.
    rows = add(
        _with_carries(prices, back, spans, since, state),
        {
            "_at": ema.POSITION,
            "_nth": f"row_number() OVER ({ORDERED})",
            "_known": f"last({known_price}, true) {SO_FAR}",
            "_known_before": f"last({known_price}, true) {BEFORE}",
            "_base": f"first({first_price}) {SO_FAR}",
            "_prices": f"count(current_price) {SO_FAR}",
            **ema.carried_columns(spans),
            **{f"_mean_{n}": _over_last("avg(current_price)", n) for n in mean_sizes},
        },
    )
    rows = add(
        rows,
        {
            "percent_change": f"rint({_percent('_known', '_known_before')} * 100) / 100",
            "cumulative_return": _percent("current_price", "_base"),
        },
    )
    rows = add(
        rows,
        {
            "_gap": ema.GAP,
            "_changes": f"count(percent_change) {SO_FAR}",
            "_deviation": _over_last("stddev_samp(percent_change)", volatility_size),
            **{f"_prices_{n}": _before_frame("_prices", n) for n in mean_sizes},
        },
    )
    changes_before = {"_changes_before": _before_frame("_changes", volatility_size)}
    rows = ema.with_averages(ema.with_factors(rows, spans, changes_before), spans)
    volatility = f"volatility_{volatility_size}_day"
    rows = add(
        rows,
        {
            volatility: f"CASE WHEN _changes - _changes_before >= {volatility_size} "
            "THEN _deviation END",
            **{
                f"ma_{n}_day": f"CASE WHEN _prices - _prices_{n} >= {n} THEN _mean_{n} END"
                for n in mean_sizes
            },
        },
    )
    # Halo rows count here: a chunk has as many as come before it, up to ``back``.
    rows = rows.where(f"NOT {HALO} AND _nth > {warm_up}")
    if since is not None:
        rows = rows.where(F.col("date") >= F.lit(since))
    return rows.select(
        *prices.columns,
        "percent_change",
        "cumulative_return",
        *[f"ma_{n}_day" for n in mean_sizes],
        volatility,
        *[f"ema_{s}" for s in spans],
    )


def exponential_averages(prices: DataFrame, spans: Sequence[int] = SPANS) -> DataFrame:
    """Adds ``ema_<span>`` for each span and nothing else."""
    rows = add(
        _with_carries(prices, 1, spans),
        {"_at": ema.POSITION, **ema.carried_columns(spans)},
    )
    rows = ema.with_factors(add(rows, {"_gap": ema.GAP}), spans)
    rows = ema.with_averages(rows, spans).where(f"NOT {HALO}")
    return rows.select(*prices.columns, *[f"ema_{s}" for s in spans])


def features_table(
    prices: DataFrame, since: datetime.date | None = None, state: DataFrame | None = None
) -> DataFrame:
    """``full_stock_calculations`` from ``stock_prices``."""
    return add_features(prices, since=since, state=state).select(*FULL_STOCK_CALCULATIONS.names)
