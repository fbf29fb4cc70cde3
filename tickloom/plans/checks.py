"""The registered queries as SQL over the same tables, for a second engine."""

from __future__ import annotations

import datetime

from tickloom.operators import dashboard
from tickloom.plans import frames
from tickloom.plans.queries import (
    CUT,
    HEAD_ROWS,
    LATE_DAYS,
    OUTLIER_DEVIATIONS,
    RECENT_MONTHS,
)


def r(value: str, digits: int = 4) -> str:
    scale = f"{10.0**digits}::DOUBLE"
    return f"round_even(({value}) * {scale}, 0) / {scale}"


W = "(PARTITION BY symbol ORDER BY date)"


def last(rows: int) -> str:
    return f"(PARTITION BY symbol ORDER BY date ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"


SO_FAR = "(PARTITION BY symbol ORDER BY date ROWS UNBOUNDED PRECEDING)"


def full(figure: str, value: str, rows: int) -> str:
    return (
        f"CASE WHEN count({value}) OVER {last(rows)} >= {rows} "
        f"THEN {figure}({value}) OVER {last(rows)} END"
    )


def quotes_with(more: str = "") -> str:
    return f"""
        SELECT symbol, name, CAST(local AS DATE) AS date, current_price, open_price{more}
        FROM (SELECT *, timezone('America/Chicago', timezone('UTC', utc)) AS local
              FROM (SELECT concat('S', l_suppkey) AS symbol,
                           CASE WHEN l_suppkey % 13 <> 0 THEN s_name ELSE 'N/A' END AS name,
                           CASE WHEN n % 97 <> 0 THEN price END AS current_price,
                           low_price AS open_price,
                           CAST(date AS TIMESTAMP) + to_hours(CAST(17 + n % 8 AS BIGINT)) AS utc
                    FROM daily JOIN supplier ON l_suppkey = s_suppkey
                    WHERE n % 11 <> 0))
        WHERE hour(local) >= 15"""


FRAGMENTS = {
    "daily": """
        SELECT l_suppkey, CAST(l_shipdate AS DATE) AS date,
               max(l_extendedprice) AS price, min(l_extendedprice) AS low_price,
               l_suppkey + dayofyear(CAST(l_shipdate AS DATE)) AS n
        FROM lineitem GROUP BY l_suppkey, CAST(l_shipdate AS DATE)""",
    "series": """
        SELECT concat('S', l_suppkey) AS symbol, date, price AS current_price FROM daily""",
    "gappy": """
        SELECT concat('S', l_suppkey) AS symbol, date,
               CASE WHEN n % 97 <> 0 THEN price END AS current_price FROM daily""",
    "early": """
        SELECT concat('S', l_suppkey) AS symbol, CAST(l_shipdate AS DATE) AS date,
               max(l_extendedprice) AS current_price
        FROM lineitem WHERE l_linenumber <= 3 GROUP BY 1, 2""",
    "names": f"""
        SELECT concat('S', s_suppkey) AS symbol, concat(s_name, ' ', n_name) AS name
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        WHERE s_nationkey <> {frames.UNNAMED_NATION}""",
    "wide": "SELECT CAST(l_shipdate AS DATE) AS date"
    + "".join(
        f", max(CASE WHEN l_linenumber = {n} THEN l_extendedprice END) AS L{n}"
        for n in frames.LINES
    )
    + " FROM lineitem GROUP BY 1",
    "quotes": quotes_with(),
    "forecasts": f"""
        SELECT * FROM (SELECT symbol, date,
               {full('avg', 'current_price', 10)} AS predicted_price FROM series)
        WHERE predicted_price IS NOT NULL""",
    "compared": f"""
        SELECT g.symbol, g.date, g.current_price AS y, p.p FROM gappy g JOIN
        (SELECT symbol, date, {full('avg', 'current_price', 10)} AS p FROM series) p
        ON g.symbol = p.symbol AND g.date = p.date""",
}


def cleaned_from(source: str) -> str:
    return f"""
        SELECT c.symbol, n.name, c.date, c.current_price, c.open_price FROM
        (SELECT symbol, date, {r('current_price', 2)} AS current_price,
                lag({r('current_price', 2)}) OVER {W} AS open_price FROM {source}) c
        LEFT JOIN names n ON c.symbol = n.symbol WHERE c.current_price IS NOT NULL"""


FRAGMENTS["cleaned"] = cleaned_from("gappy")


def feature_fragments(source: str, extra: str = "") -> dict[str, str]:
    """Features of ``source``; the averages walk row by row in a recursive query."""

    def average(span: int) -> str:
        alpha = f"(2::DOUBLE / {span + 1})"
        weight = f"pow(1 - {alpha}, w.gap + 1)"
        return (
            f"CASE WHEN n.x IS NULL THEN w.e{span} WHEN w.e{span} IS NULL THEN n.x "
            f"ELSE ({weight} * w.e{span} + {alpha} * n.x) / ({weight} + {alpha}) END"
        )

    return {
        "numbered": f"""
            SELECT symbol, date, current_price AS x, row_number() OVER {W} AS rn
            FROM {source}""",
        "walk": f"""
            SELECT symbol, date, rn, x AS e10, x AS e30, 0::BIGINT AS gap
            FROM numbered WHERE rn = 1
            UNION ALL
            SELECT n.symbol, n.date, n.rn, {average(10)}, {average(30)},
                   CASE WHEN n.x IS NULL AND w.e10 IS NOT NULL THEN w.gap + 1 ELSE 0 END
            FROM walk w JOIN numbered n ON n.symbol = w.symbol AND n.rn = w.rn + 1""",
        "known": f"""
            SELECT *, last_value(current_price IGNORE NULLS) OVER {SO_FAR} AS k,
                   first_value(current_price) OVER {SO_FAR} AS base,
                   row_number() OVER {W} AS position
            FROM {source}""",
        "changed": f"""
            SELECT *, {r(f'(k / lag(k) OVER {W} - 1) * 100', 2)} AS percent_change FROM known""",
        "figures": f"""
            SELECT symbol, date, current_price, {extra} position, percent_change,
                   (current_price / base - 1) * 100 AS cumulative_return,
                   {full('avg', 'current_price', 10)} AS ma_10_day,
                   {full('avg', 'current_price', 30)} AS ma_30_day,
                   {full('stddev_samp', 'percent_change', 30)} AS volatility_30_day
            FROM changed""",
        "featured": f"""
            SELECT f.* EXCLUDE (position), w.e10 AS ema_10, w.e30 AS ema_30
            FROM figures f JOIN walk w ON f.symbol = w.symbol AND f.date = w.date
            WHERE position > 30""",
    }


def sql(body: str, *fragments: str, **more: str) -> str:
    """A query over the named fragments, in the order given."""
    parts = {name: FRAGMENTS[name] for name in fragments}
    parts.update(more)
    if not parts:
        return body
    named = ",\n".join(f"{name} AS ({text})" for name, text in parts.items())
    return f"WITH RECURSIVE {named}\n{body}"


ROUNDED_FIGURES = ", ".join(
    f"{r(c)} AS {c}"
    for c in (
        "cumulative_return", "ma_10_day", "ma_30_day", "volatility_30_day", "ema_10", "ema_30",
    )
)

CLEANED_FEATURES = feature_fragments("cleaned", "name, open_price,")
CLEANED = ("daily", "gappy", "names", "cleaned")

PREDICTIONS = f"""
    SELECT * FROM (SELECT symbol, date, current_price,
           lag(ma_10_day) OVER {W} AS predicted_price,
           ma_10_day AS previous_day_predicted_price,
           row_number() OVER {W} AS rn FROM featured) WHERE rn > 1"""

METRICS = f"""
    SELECT symbol,
           {r('''CASE WHEN regr_count(y, p) < 2 THEN NULL
                      WHEN regr_syy(y, p) = 0 THEN CASE WHEN sum((y - p) ^ 2) = 0 THEN 1.0 ELSE 0.0 END
                      ELSE 1 - sum((y - p) ^ 2) / regr_syy(y, p) END''')} AS r_squared,
           {r('avg(abs(y - p))', 2)} AS mae,
           {r('sqrt(avg((y - p) ^ 2))', 2)} AS rmse,
           {r('avg((y - p) ^ 2)', 2)} AS mse,
           {r('''avg(CASE WHEN rn > 1 THEN CASE WHEN sign(dy) = sign(dp) THEN 1.0::DOUBLE
                 ELSE 0.0::DOUBLE END END)''')} AS directional_accuracy
    FROM (SELECT *, y - lag(y) OVER {W} AS dy, p - lag(p) OVER {W} AS dp,
                 row_number() OVER {W} AS rn FROM compared) GROUP BY symbol"""

COMPARED = ("daily", "series", "gappy", "compared")


def one_figure(name: str, value: str, source: str = "gappy") -> str:
    return sql(f"SELECT symbol, date, current_price, {value} AS {name} FROM {source}", "daily", source)


def element_sql(tag: str) -> str:
    found = f"regexp_extract(html, '(?is)<{tag}(?:\\s[^>]*)?>(.*?)</{tag}\\s*>', 1)"
    text = f"regexp_replace({found}, '<[^>]*>', '', 'g')"
    for entity, character in (
        ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&"),
    ):
        text = f"replace({text}, '{entity}', '{character}')"
    blanks = "concat(' ', chr(9), chr(10), chr(13), chr(11), chr(12), chr(160))"
    return (
        f"CASE WHEN regexp_matches(html, '(?is)<{tag}(?:\\s[^>]*)?>(.*?)</{tag}\\s*>') "
        f"THEN trim({text}, {blanks}) END"
    )


UNPIVOT = " UNION ALL ".join(
    f"SELECT 'L{n}' AS symbol, date, L{n} AS current_price FROM wide" for n in frames.LINES
)

SPIKED = """
    SELECT symbol, date, CASE WHEN (CAST(symbol[2:] AS BIGINT) + dayofyear(date)) % 101 = 0
                         THEN 3 * y ELSE y END AS y, p FROM compared"""


def outliers(deviations: float, points: str = "compared", **more: str) -> str:
    return sql(
        f"""SELECT symbol, date, actual, {r('predicted')} AS predicted, {r('residual')} AS residual,
            {r('deviation')} AS residual_deviation
            FROM (SELECT symbol, date, y AS actual, p AS predicted, y - p AS residual,
                         stddev_samp(y - p) OVER (PARTITION BY symbol) AS deviation
                  FROM {points} WHERE y IS NOT NULL AND p IS NOT NULL)
            WHERE abs(residual) > {deviations}::DOUBLE * deviation""",
        *COMPARED, **more,
    )


TRAINING = f"""
    SELECT * FROM (SELECT *, lead(current_price) OVER {W} AS target FROM featured)
    WHERE name IS NOT NULL AND open_price IS NOT NULL AND percent_change IS NOT NULL
      AND cumulative_return IS NOT NULL AND ma_10_day IS NOT NULL AND ma_30_day IS NOT NULL
      AND volatility_30_day IS NOT NULL AND ema_10 IS NOT NULL AND ema_30 IS NOT NULL
      AND target IS NOT NULL"""

IS_TEST = """row_number() OVER (PARTITION BY symbol ORDER BY md5(concat(symbol, '|', date, '|42')), date)
    <= ceil(0.2::DOUBLE * count(*) OVER (PARTITION BY symbol))"""

# The trees of ``frames.rule_forests``: tree, node, feature, threshold, left, right, prediction.
NODES = """
    SELECT symbol, n.* FROM (SELECT symbol, lo, hi, (lo + hi) / 2 AS mid FROM
        (SELECT symbol, min(current_price) AS lo, max(current_price) AS hi FROM gappy GROUP BY symbol)
        WHERE CAST(symbol[2:] AS BIGINT) % 4 <> 0),
    LATERAL (VALUES
        (0, 0, 3, mid, 1, 2, mid), (0, 1, -1, NULL, -1, -1, lo), (0, 2, 1, 0.0::DOUBLE, 3, 4, mid),
        (0, 3, -1, NULL, -1, -1, mid), (0, 4, -1, NULL, -1, -1, hi),
        (1, 0, 7, (lo + mid) / 2, 1, 2, mid), (1, 1, 2, 0.0::DOUBLE, 3, 4, lo),
        (1, 2, -1, NULL, -1, -1, hi), (1, 3, -1, NULL, -1, -1, lo), (1, 4, -1, NULL, -1, -1, mid)
    ) AS n(tree, node, feature, threshold, l, r, prediction)"""

STEPS = """
    SELECT f.symbol, f.date, t.tree, 0 AS node, [open_price, percent_change, cumulative_return,
           ma_10_day, ma_30_day, volatility_30_day, ema_10, ema_30] AS x
    FROM featured f, range(0, 2) AS t(tree)
    UNION ALL
    SELECT s.symbol, s.date, s.tree, CASE WHEN x[n.feature + 1] <= n.threshold THEN n.l ELSE n.r END, x
    FROM steps s JOIN nodes n ON n.symbol = s.symbol AND n.tree = s.tree AND n.node = s.node
    WHERE n.feature >= 0"""


SQL = {
    "wide_csv_scan": sql("SELECT * FROM wide", "wide"),
    "quote_extract": sql("SELECT * FROM quotes", "daily", "quotes"),
    "table_scan": "SELECT * FROM orders",
    "page_extract": f"""SELECT page_id, url, {element_sql('title')} AS title,
        {element_sql('h1')} AS heading FROM pages""",
    "sink_prices": sql(
        """SELECT * FROM first_batch UNION ALL SELECT * FROM second_batch s WHERE NOT EXISTS
           (SELECT 1 FROM first_batch f WHERE f.symbol = s.symbol AND f.date = s.date)""",
        "daily", "series", "early", "names",
        first_batch=cleaned_from("early"), second_batch=cleaned_from("series"),
    ),
    "sink_features": sql(
        f"""SELECT symbol, name, date, current_price, open_price, percent_change,
            {ROUNDED_FIGURES.replace(r('ema_30'), r('CASE WHEN month(date) % 2 = 0 THEN ema_30 ELSE -ema_30 END'))}
            FROM featured""",
        *CLEANED, **CLEANED_FEATURES,
    ),
    "sink_predictions": sql(
        f"""SELECT symbol, date, current_price,
            {r('CASE WHEN month(date) % 2 = 0 THEN predicted_price ELSE -predicted_price END')} AS predicted_price,
            {r('previous_day_predicted_price')} AS previous_day_predicted_price
            FROM predictions""",
        *CLEANED, **CLEANED_FEATURES, predictions=PREDICTIONS,
    ),
    "sink_eval": sql(METRICS, *COMPARED),
    "upsert_eval": sql(
        """SELECT symbol, r_squared, CASE WHEN symbol LIKE '%3' THEN 0.0::DOUBLE ELSE mae END AS mae,
           rmse, mse, directional_accuracy FROM metrics""",
        *COMPARED, metrics=METRICS,
    ),
    "insert_if_absent": sql(
        """SELECT * FROM early UNION ALL
           SELECT concat('S', l_suppkey), CAST(l_shipdate AS DATE),
                  arg_min(l_extendedprice, l_orderkey * 10 + l_linenumber)
           FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM early e
             WHERE e.symbol = concat('S', l.l_suppkey) AND e.date = CAST(l.l_shipdate AS DATE))
           GROUP BY 1, 2""",
        "early",
    ),
    "eval_pairs": sql(
        f"""SELECT symbol, date, current_price,
            {r('previous_day_predicted_price')} AS previous_day_predicted_price FROM predictions""",
        *CLEANED, **CLEANED_FEATURES, predictions=PREDICTIONS,
    ),
    "unpivot_prices": sql(UNPIVOT, "wide"),
    "symbol_name_lookup": sql(
        """SELECT s.symbol, s.date, s.current_price, n.name FROM series s
           LEFT JOIN names n ON s.symbol = n.symbol""",
        "daily", "series", "names",
    ),
    "date_coerce": """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date,
        CAST(o_orderdate AS DATE) AS date_us FROM orders""",
    "clean_prices": sql("SELECT * FROM cleaned ORDER BY date, symbol", *CLEANED),
    "union_history_current": sql(
        "SELECT *, 0 AS source FROM cleaned UNION ALL SELECT *, 1 FROM quotes", *CLEANED, "quotes"
    ),
    "history_then_current": sql(
        """SELECT * FROM cleaned UNION ALL SELECT * FROM quotes q WHERE NOT EXISTS
           (SELECT 1 FROM cleaned c WHERE c.symbol = q.symbol AND c.date = q.date)""",
        *CLEANED, "quotes",
    ),
    "symbol_filter": sql("SELECT * FROM series WHERE symbol = 'S1'", "daily", "series"),
    "training_frame": sql(
        f"""SELECT symbol, date, open_price, percent_change, {ROUNDED_FIGURES}, target
            FROM training""",
        *CLEANED, **CLEANED_FEATURES, training=TRAINING,
    ),
    "train_test_split": sql(
        f"SELECT symbol, date, {IS_TEST} AS is_test FROM series", "daily", "series"
    ),
    "holdout_metrics_of_mean": sql(
        f"""SELECT symbol, count(*) AS "rows", {r('avg((target - ma_10_day) ^ 2)', 2)} AS mse,
            {r('''CASE WHEN regr_count(target, ma_10_day) < 2 THEN NULL
                  WHEN regr_syy(target, ma_10_day) = 0
                  THEN CASE WHEN sum((target - ma_10_day) ^ 2) = 0 THEN 1.0 ELSE 0.0 END
                  ELSE 1 - sum((target - ma_10_day) ^ 2) / regr_syy(target, ma_10_day) END''')} AS r_squared
            FROM (SELECT *, {IS_TEST} AS is_test FROM training) WHERE is_test GROUP BY symbol""",
        *CLEANED, **CLEANED_FEATURES, training=TRAINING,
    ),
    "warmup_trim": sql(
        f"""SELECT symbol, date, current_price FROM
            (SELECT *, row_number() OVER {W} AS rn FROM series) WHERE rn > 30""",
        "daily", "series",
    ),
    "head_drop": sql(
        f"SELECT * FROM series ORDER BY date, symbol OFFSET {HEAD_ROWS}", "daily", "series"
    ),
    "after_close": """SELECT event_id, ts FROM events
        WHERE hour(timezone('America/Chicago', timezone('UTC', ts))) >= 15""",
    "business_days": """SELECT event_id, CAST(ts AS DATE) AS day,
        CAST(date_trunc('week', ts) AS DATE) AS week_start,
        CAST(date_trunc('week', ts) AS DATE) + 6 AS week_end
        FROM events WHERE isodow(ts) <= 5""",
    "features_left_predictions": sql(
        f"""SELECT g.symbol, g.date, g.current_price, {r('f.predicted_price')} AS predicted_price
            FROM gappy g LEFT JOIN forecasts f ON g.symbol = f.symbol AND g.date = f.date""",
        "daily", "series", "gappy", "forecasts",
    ),
    "actual_join_predicted": sql(
        f"""SELECT g.symbol, g.date, g.current_price, {r('f.predicted_price')} AS predicted_price
            FROM gappy g JOIN forecasts f ON g.symbol = f.symbol AND g.date = f.date""",
        "daily", "series", "gappy", "forecasts",
    ),
    "model_metrics": sql(METRICS, *COMPARED),
    "directional_accuracy": sql(
        "SELECT symbol, directional_accuracy FROM metrics", *COMPARED, metrics=METRICS
    ),
    "distinct_symbols": sql("SELECT DISTINCT symbol FROM series", "daily", "series"),
    "open_from_prev_close": one_figure(
        "open_price", r(f"lag(current_price) OVER {W}", 2)
    ),
    "lag_predictions": sql(
        f"""SELECT symbol, date, {r('predicted_price')} AS predicted_price,
            {r(f'lag(predicted_price) OVER {W}')} AS previous_day_predicted_price FROM forecasts""",
        "daily", "series", "forecasts",
    ),
    "percent_change": sql(
        f"""SELECT symbol, date, current_price, {r(f'(k / lag(k) OVER {W} - 1) * 100', 2)} AS percent_change
            FROM (SELECT *, last_value(current_price IGNORE NULLS) OVER {SO_FAR} AS k FROM gappy)""",
        "daily", "gappy",
    ),
    "percent_change_unfilled": one_figure(
        "percent_change", r(f"(current_price / lag(current_price) OVER {W} - 1) * 100", 2)
    ),
    "cumulative_return": one_figure(
        "cumulative_return",
        r(f"(current_price / first_value(current_price) OVER {SO_FAR} - 1) * 100"),
    ),
    "ma_10_day": one_figure("ma_10_day", r(full("avg", "current_price", 10))),
    "ma_30_day": one_figure("ma_30_day", r(full("avg", "current_price", 30))),
    "volatility_30_day": sql(
        f"""SELECT symbol, date, current_price, percent_change,
            {r(full('stddev_samp', 'percent_change', 30))} AS volatility_30_day FROM changed""",
        "daily", "gappy",
        known=feature_fragments("gappy")["known"], changed=feature_fragments("gappy")["changed"],
    ),
    **{
        f"ema_{span}": sql(
            f"""SELECT n.symbol, n.date, n.x AS current_price, {r(f'w.e{span}')} AS ema_{span}
                FROM numbered n JOIN walk w ON n.symbol = w.symbol AND n.rn = w.rn""",
            "daily", "gappy",
            numbered=feature_fragments("gappy")["numbered"], walk=feature_fragments("gappy")["walk"],
        )
        for span in (10, 30)
    },
    "features": sql(
        f"SELECT symbol, date, current_price, percent_change, {ROUNDED_FIGURES} FROM featured",
        "daily", "gappy", **feature_fragments("gappy"),
    ),
    "round2": f"""SELECT l_orderkey, l_linenumber,
        {r('l_extendedprice * (1 - l_discount)', 2)} AS net_price FROM lineitem""",
    "parse_price": """SELECT o_orderkey, CASE o_orderkey % 8
        WHEN 1 THEN NULL WHEN 3 THEN NULL WHEN 5 THEN NULL
        WHEN 2 THEN CAST(concat(CAST(o_totalprice AS VARCHAR), 'e1') AS DOUBLE)
        WHEN 4 THEN -o_totalprice ELSE o_totalprice END AS price FROM orders""",
    "parse_name": """SELECT s_suppkey,
        CASE WHEN s_suppkey % 5 <> 0 THEN s_name ELSE 'N/A' END AS name FROM supplier""",
    "quote_url": """SELECT s_suppkey,
        concat('https://finance.yahoo.com/quote/S', s_suppkey, '/') AS url FROM supplier""",
    "scatter_points": sql(
        f"""SELECT symbol, date, y AS actual, {r('p')} AS predicted FROM compared
            WHERE y IS NOT NULL AND p IS NOT NULL""",
        *COMPARED,
    ),
    "residual_outliers": outliers(OUTLIER_DEVIATIONS),
    "residual_outliers_by_rule": outliers(dashboard.OUTLIER_DEVIATIONS, "spiked", spiked=SPIKED),
    "recent_period": sql(
        f"""SELECT * FROM series WHERE date >=
            (SELECT CAST(max(date) - INTERVAL {RECENT_MONTHS} MONTH AS DATE) FROM series)""",
        "daily", "series",
    ),
    "incremental_ingest": sql(
        """SELECT symbol, CASE WHEN dayofyear(date) % 2 = 0 OR name = 'N/A' THEN name
                  ELSE replace(name, 'Supplier', 'Vendor') END AS name,
                  date, current_price, open_price FROM quotes""",
        "daily", "quotes",
    ),
    "incremental_ingest_late": sql(
        f"""SELECT symbol, name, date, current_price, open_price FROM fetched
            WHERE dayofweek(date) <> 3 OR utc >
              (SELECT max(utc) - INTERVAL {LATE_DAYS} DAY FROM fetched WHERE dayofweek(date) <> 3)""",
        "daily", fetched=quotes_with(", utc"),
    ),
}

SQL["features_from_state"] = SQL["features"]
SQL["merged_metrics"] = SQL["model_metrics"]
SQL["predict_per_symbol"] = sql(
    f"""SELECT s.symbol, s.date, {r('CASE WHEN len([v FOR v IN any_value(x) IF v IS NULL]) = 0 THEN sum(n.prediction) / 2 END')}
            AS predicted_price
        FROM steps s JOIN nodes n ON n.symbol = s.symbol AND n.tree = s.tree AND n.node = s.node
        WHERE n.feature < 0 GROUP BY s.symbol, s.date""",
    *CLEANED, **CLEANED_FEATURES, nodes=NODES, steps=STEPS,
)
LONG = f"""
    SELECT symbol, date, current_price, open_price FROM
    (SELECT symbol, date, {r('current_price', 2)} AS current_price,
            lag({r('current_price', 2)}) OVER {W} AS open_price FROM ({UNPIVOT}))
    WHERE current_price IS NOT NULL"""
SQL["run_daily"] = sql(
    f"""SELECT p.symbol, p.price_rows, r_squared, mae, rmse, mse, directional_accuracy FROM
        (SELECT symbol, count(*) AS price_rows FROM
            (SELECT symbol FROM long UNION ALL
             SELECT symbol FROM quotes WHERE date IN (DATE '{CUT}', DATE '{CUT + datetime.timedelta(days=3)}'))
            GROUP BY symbol) p
        LEFT JOIN metrics m ON m.symbol = p.symbol""",
    "daily", "wide", "quotes", long=LONG, **feature_fragments("long"), predictions=PREDICTIONS,
    compared="SELECT symbol, date, current_price AS y, previous_day_predicted_price AS p FROM predictions",
    metrics=METRICS,
)
SQL["bucketed_insert"] = SQL["sink_prices"]
SQL["bucketed_join"] = sql(
    f"""SELECT c.symbol, c.date, c.current_price, {r('p.predicted_price')} AS predicted_price
        FROM cleaned c LEFT JOIN predictions p ON p.symbol = c.symbol AND p.date = c.date""",
    *CLEANED, **CLEANED_FEATURES, predictions=PREDICTIONS,
)
SQL["filtered_insert"] = SQL["sink_prices"]
OLD = f"CASE WHEN date <= DATE '{CUT}'"
SQL["wide_csv_union"] = sql(
    f"""SELECT date, L1, {OLD} THEN L2 END AS L2, L3,
        {', '.join(f'{OLD} THEN L{n} END AS L{n}' for n in frames.LINES[3:])},
        {OLD} THEN NULL ELSE L2 END AS M2 FROM wide""",
    "wide",
)
