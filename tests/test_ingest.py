import datetime

import pytest
from pyspark.sql import functions as F

from conftest import column, day
from tickloom.functions import html
from tickloom.functions.scalars import parse_price
from tickloom.operators import ingest
from tickloom.schemas import TABLES
from tickloom.sources import sinks
from tickloom.sources.files import one_row_per_date, scan_wide_csv
from tickloom.sources.sinks import insert_if_absent, upsert
from tickloom.sources.tables import read_range, read_table
from tickloom.streaming.incremental import ingest_new_pages

PRICES = TABLES["stock_prices"]


def price_frame(spark, rows):
    return spark.createDataFrame(rows, PRICES.schema)


def write_csv(path, *lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_wide_csv(spark, tmp_path):
    path = write_csv(tmp_path / "h.csv", "Date,AAPL,X.Y", "2024-01-01,1.5,", "2024-01-02,,2")
    rows = one_row_per_date(scan_wide_csv(spark, path)).orderBy("date").collect()
    assert [tuple(r) for r in rows] == [(day(0), 1.5, None), (day(1), None, 2.0)]


def test_wide_csv_with_bad_text_fails(spark, tmp_path):
    path = write_csv(tmp_path / "n.csv", "Date,A", "2024-01-01,many")
    with pytest.raises(Exception):
        scan_wide_csv(spark, path).collect()
    path = write_csv(tmp_path / "d.csv", "Date,A", "someday,1")
    with pytest.raises(Exception, match="not a date"):
        scan_wide_csv(spark, path).collect()


def test_repeated_date_keeps_each_symbols_first_price(spark, tmp_path):
    path = write_csv(
        tmp_path / "r.csv", "Date,A,B", "2024-01-01,1,", "2024-01-01,2,5", "2024-01-02,3,6"
    )
    rows = one_row_per_date(scan_wide_csv(spark, path)).orderBy("date").collect()
    assert [tuple(r) for r in rows] == [(day(0), 1.0, 5.0), (day(1), 3.0, 6.0)]


def test_unpivot_undoes_pivot(spark):
    wide = spark.createDataFrame(
        [(day(0), 1.0, None), (day(1), float("nan"), 4.0)], "date date, A double, `B.C` double"
    )
    long = ingest.unpivot_prices(wide)
    assert long.count() == 4
    back = long.groupBy("date").pivot("symbol", ["A", "B.C"]).agg(F.first("current_price"))
    assert [tuple(r) for r in back.orderBy("date").collect()] == [
        (day(0), 1.0, None), (day(1), None, 4.0),
    ]


@pytest.mark.parametrize("as_table", [False, True])
def test_clean_takes_the_open_before_dropping_gaps(spark, price_rows, as_table):
    names = {"A": "Acme"}
    if as_table:
        names = spark.createDataFrame(list(names.items()), "symbol string, name string")
    rows = price_rows([1.004, None, 3.0, 4.0]).unionByName(price_rows([9.0], symbol="B"))
    clean = ingest.clean_prices(rows, names).orderBy("symbol", "date").collect()
    assert [tuple(r) for r in clean] == [
        ("A", "Acme", day(0), 1.0, None),
        ("A", "Acme", day(2), 3.0, None),
        ("A", "Acme", day(3), 4.0, 3.0),
        ("B", None, day(0), 9.0, None),
    ]


def page(symbol, status, at, price="1,234.50", name="Acme (A)"):
    html = (
        f'<h1 class="x yf-xxbei9">{name}</h1><span data-testid="qsp-price">{price}</span>'
        '<fin-streamer data-field="regularMarketOpen">1,200</fin-streamer>'
    )
    return (symbol, status, at, html)


PAGE_TYPE = "symbol string, status int, fetched_at timestamp_ntz, html string"


def test_quotes(spark):
    late = datetime.datetime(2024, 1, 6, 1, 0)
    pages = spark.createDataFrame(
        [
            page("A", 200, late),
            page("B", 503, late),
            page("C", 200, datetime.datetime(2024, 1, 5, 20, 59)),
            page("D", 200, late, price="soon"),
            ("E", 200, late, "<p>nothing</p>"),
        ],
        PAGE_TYPE,
    )
    rows = ingest.extract_quotes(pages).drop("fetched_at").orderBy("symbol").collect()
    friday = datetime.date(2024, 1, 5)
    assert [tuple(r) for r in rows] == [
        ("A", "Acme", friday, 1234.5, 1200.0),
        ("D", "Acme", friday, None, 1200.0),
        ("E", "N/A", friday, None, None),
    ]


def test_history_wins_over_today(spark):
    history = price_frame(spark, [("A", "h", day(0), 1.0, None)])
    today = spark.createDataFrame(
        [("A", "late", day(0), 3.0, 3.0, datetime.datetime(2024, 1, 1, 23)),
         ("B", "late", day(0), 5.0, 5.0, datetime.datetime(2024, 1, 1, 23)),
         ("B", "early", day(0), 4.0, 4.0, datetime.datetime(2024, 1, 1, 22))],
        "symbol string, name string, date date, current_price double, open_price double, "
        "fetched_at timestamp_ntz",
    )
    rows = ingest.union_history_current(history, today)
    kept = ingest.first_per_key(rows, ["symbol", "date"])
    assert sorted((r["symbol"], r["current_price"]) for r in kept.collect()) == [("A", 1.0), ("B", 4.0)]
    empty = ingest.union_history_current(history, today.limit(0))
    assert ingest.first_per_key(empty, ["symbol", "date"]).count() == 1


def test_first_writer_wins_across_and_inside_batches(spark, tmp_path):
    path = str(tmp_path / "t")
    first = price_frame(spark, [("A", "a", day(0), 1.0, None), ("A", "a", day(400), 2.0, 1.0)])
    insert_if_absent(spark, first, PRICES, path)
    insert_if_absent(spark, first, PRICES, path)
    changed = first.withColumn("current_price", F.lit(9.0)).unionByName(
        price_frame(spark, [("B", "b", day(0), 7.0, None)])
    )
    insert_if_absent(spark, changed, PRICES, path, dates=(day(0), day(400)))
    stored = read_table(spark, path, PRICES)
    assert stored.schema.names == PRICES.schema.names
    assert sorted((r["symbol"], r["current_price"]) for r in stored.collect()) == [
        ("A", 1.0), ("A", 2.0), ("B", 7.0),
    ]
    assert read_range(spark, path, PRICES, day(300), day(500)).count() == 1


def test_a_hot_key_costs_one_row(spark, tmp_path):
    """A third of the batch is copies of one key; the first arrival is kept."""
    batch = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("S"), "id")).alias("symbol"),
        F.lit("n").alias("name"),
        F.lit(day(0)).alias("date"),
        (F.col("id") + 1.0).alias("current_price"),
        F.lit(None).cast("double").alias("open_price"),
        (-F.col("id")).alias(ingest.ARRIVAL),
    )
    path = str(tmp_path / "t")
    insert_if_absent(spark, batch, PRICES, path)
    stored = read_table(spark, path, PRICES)
    assert stored.count() == 6001
    assert column(stored.where("symbol = 'HOT'"), "current_price") == [8998.0]
    plan = ingest.first_per_key(batch, ["symbol", "date"])._jdf.queryExecution().executedPlan()
    assert "partial_min_by" in plan.toString()


def test_null_key_fails_the_whole_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    insert_if_absent(spark, price_frame(spark, [("A", "a", day(0), 1.0, None)]), PRICES, path)
    bad = price_frame(spark, [("B", "b", day(0), 1.0, None), (None, "c", day(0), 1.0, None)])
    with pytest.raises(Exception, match="symbol is null"):
        insert_if_absent(spark, bad, PRICES, path)
    assert read_table(spark, path, PRICES).count() == 1


def test_nan_is_stored_as_null(spark, tmp_path):
    path = str(tmp_path / "t")
    insert_if_absent(spark, price_frame(spark, [("A", "a", day(0), 1.0, float("nan"))]), PRICES, path)
    assert column(read_table(spark, path, PRICES), "open_price") == [None]


def test_upsert_replaces(spark, tmp_path):
    table, path = TABLES["model_eval"], str(tmp_path / "t")

    def rows(*items):
        return spark.createDataFrame([(s, v, v, v, v, v) for s, v in items], table.schema)

    upsert(spark, rows(("A", 1.0), ("B", 2.0)), table, path)
    upsert(spark, rows(("B", 3.0), ("C", 4.0)), table, path)
    stored = read_table(spark, path, table).orderBy("symbol").collect()
    assert [(r["symbol"], r["mae"]) for r in stored] == [("A", 1.0), ("B", 3.0), ("C", 4.0)]
    insert_if_absent(spark, rows(("A", 9.0)), table, path)
    assert read_table(spark, path, table).where("mae = 9.0").count() == 0


def test_missing_table_is_an_error(spark, tmp_path):
    with pytest.raises(Exception):
        read_table(spark, str(tmp_path / "absent"), PRICES).count()


def test_incremental_ingest_adds_only_new_keys(spark, tmp_path):
    landing, table, state = (str(tmp_path / n) for n in ("landing", "table", "state"))
    at = datetime.datetime(2024, 1, 5, 22)

    def deliver(*pages):
        spark.createDataFrame(list(pages), PAGE_TYPE).coalesce(1).write.mode("append").parquet(landing)
        ingest_new_pages(spark, landing, table, state)
        return sorted((r["symbol"], r["current_price"]) for r in spark.read.parquet(table).collect())

    assert deliver(page("A", 200, at, "1")) == [("A", 1.0)]
    assert deliver(page("A", 200, at, "2"), page("B", 200, at, "3")) == [("A", 1.0), ("B", 3.0)]
    ingest_new_pages(spark, landing, table, state)
    assert spark.read.parquet(table).count() == 2


def test_repeated_and_late_pages_of_a_stream(spark, tmp_path, monkeypatch):
    from tickloom.streaming import incremental

    landing, table, state = (str(tmp_path / n) for n in ("landing", "table", "state"))
    checked = []

    def counted(session, rows, *args, **kwargs):
        checked.append(rows.count())
        insert_if_absent(session, rows, *args, **kwargs)

    monkeypatch.setattr(incremental, "insert_if_absent", counted)

    def deliver(*pages):
        checked.clear()
        if pages:
            spark.createDataFrame(list(pages), PAGE_TYPE).coalesce(1).write.mode("append").parquet(landing)
        ingest_new_pages(spark, landing, table, state, late="3 days")
        rows = read_table(spark, table, PRICES).select("symbol", "date", "current_price").collect()
        return sorted((r[0], r[1].day, r[2]) for r in rows), list(checked)

    def at(day, minute=0):
        return datetime.datetime(2024, 1, day, 22, minute)

    first = [page("A", 200, at(10), "1"), page("B", 200, at(10), "2")]
    stored = [("A", 10, 1.0), ("B", 10, 2.0)]
    assert deliver(*first) == (stored, [2])
    # Delivered again: nothing reaches the key check. After a restart without files neither.
    assert deliver(*first, first[0]) == (stored, [])
    assert deliver() == (stored, [])
    # Another page of a stored key is checked and loses; inside a batch the first fetch wins.
    later = [page("C", 200, at(10, 9), "9"), page("C", 200, at(10, 5), "5"), page("A", 200, at(10, 7), "7")]
    stored.append(("C", 10, 5.0))
    assert deliver(*later) == (stored, [3])
    # Late inside the watermark goes in, outside of it is left to the daily ingest.
    stored = [("A", 8, 4.0), *stored]
    assert deliver(page("A", 200, at(8), "4"), page("D", 200, at(6), "6")) == (stored, [1])
    # The batch ingest may add to the table meanwhile; the stream keeps what is there.
    insert_if_absent(spark, price_frame(spark, [("E", "e", at(11).date(), 3.0, None)]), PRICES, table)
    stored = sorted([*stored, ("E", 11, 3.0)])
    assert deliver(page("E", 200, at(11), "8")) == (stored, [1])


def test_stream_and_batch_write_one_table(spark, tmp_path):
    landing, table, state = (str(tmp_path / n) for n in ("landing", "table", "state"))
    at = datetime.datetime(2024, 1, 5, 22)
    insert_if_absent(spark, price_frame(spark, [("A", "a", at.date(), 1.0, None)]), PRICES, table)
    pages = [page("A", 200, at, "2"), page("B", 200, at, "3")]
    spark.createDataFrame(pages, PAGE_TYPE).write.parquet(landing)
    ingest_new_pages(spark, landing, table, state)
    late = [("B", "b", at.date(), 9.0, None), ("C", "c", datetime.date(2025, 1, 1), 4.0, None)]
    insert_if_absent(spark, price_frame(spark, late), PRICES, table)
    prices = read_table(spark, table, PRICES).select("symbol", "current_price").collect()
    assert sorted(map(tuple, prices)) == [("A", 1.0), ("B", 3.0), ("C", 4.0)]
    year = read_range(spark, table, PRICES, datetime.date(2024, 1, 1), datetime.date(2024, 12, 31))
    assert year.count() == 2


def test_a_page_without_symbol_fails_the_stream(spark, tmp_path):
    at = datetime.datetime(2024, 1, 5, 22)
    spark.createDataFrame([page(None, 200, at, "1")], PAGE_TYPE).write.parquet(str(tmp_path / "landing"))
    with pytest.raises(Exception, match="symbol is null"):
        ingest_new_pages(spark, *(str(tmp_path / n) for n in ("landing", "table", "state")))


@pytest.mark.parametrize(
    "html, price",
    [
        ('<span data-testid="qsp-price">1, <b> 234.5</b></span>', 1234.5),
        ('<!-- <span data-testid="qsp-price">9</span> --><span data-testid="qsp-price">7</span>', 7.0),
        ('<script>x = \'<span data-testid="qsp-price">9</span>\'</script><span data-testid=qsp-price>8</span>', 8.0),
    ],
)
def test_price_in_odd_markup(spark, html, price):
    at = datetime.datetime(2024, 1, 5, 22)
    pages = spark.createDataFrame([("A", 200, at, html)], PAGE_TYPE)
    assert ingest.extract_quotes(pages).first()["current_price"] == price


def test_wide_csv_with_other_dates(spark, tmp_path):
    path = write_csv(tmp_path / "o.csv", "Date,A", "01/02/2024,3")
    rows = one_row_per_date(scan_wide_csv(spark, path, "MM/dd/yyyy")).collect()
    assert [tuple(r) for r in rows] == [(datetime.date(2024, 1, 2), 3.0)]


def test_price_files_of_different_headers(spark, tmp_path):
    folder = tmp_path / "files 1"
    folder.mkdir()
    (folder / "a [1] b.csv").write_text("Date,A,B\n2024-01-01,1,2\n2024-01-02,3,\n")
    (folder / "b.csv").write_text('Date,"C, x",A\n2024-01-02,5,6\n2024-01-03,7,8\n')
    (folder / "c.csv").write_text("Date,A,B\n2024-01-04,9,10\n")
    (folder / "empty.csv").write_text("")
    wide = one_row_per_date(scan_wide_csv(spark, str(folder)))
    assert wide.columns == ["date", "A", "B", "C, x"]
    got = [tuple(r)[1:] for r in wide.orderBy("date").collect()]
    # The second file comes after the first, whose prices of a date win.
    assert got == [(1, 2, None), (3, None, 5), (8, None, 7), (9, 10, None)]
    (folder / "d.csv").write_text("Date,A,A\n2024-01-05,1,2\n")
    with pytest.raises(ValueError, match="twice"):
        scan_wide_csv(spark, str(folder))
    nothing = tmp_path / "nothing"
    nothing.mkdir()
    (nothing / "e.csv").write_text("")
    with pytest.raises(ValueError, match="header"):
        scan_wide_csv(spark, str(nothing))


def test_a_symbol_is_read_from_its_own_files(spark, tmp_path):
    """With more files, fewer rows are read to find the rows of one symbol."""
    rows = spark.range(40_000).select(
        F.concat(F.lit("S"), F.col("id") % 40).alias("symbol"), F.lit("n").alias("name"),
        F.date_add(F.lit(day(0)), (F.col("id") / 40 % 300).cast("int")).alias("date"),
        F.col("id").cast("double").alias("current_price"), F.lit(None).cast("double").alias("open_price"),
    )
    read = {}
    few, merged = "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled"
    before = {k: spark.conf.get(k) for k in (few, merged)}
    try:
        spark.conf.set(merged, "false")
        for files in (1, 16):
            spark.conf.set(few, str(files))
            path = str(tmp_path / f"files{files}")
            sinks.write_rows(rows, TABLES["stock_prices"], path, "append")
            one = spark.read.parquet(path).where("symbol = 'S7'")
            assert len(one.collect()) == 1000
            leaf = one._jdf.queryExecution().executedPlan().collectLeaves().head()
            read[files] = leaf.metrics().apply("numOutputRows").value()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    # In one file, only pages are passed over.
    assert 4 * read[16] < read[1], read


def test_a_stream_remembers_only_quotes_in_time(spark, tmp_path):
    """What is kept between batches grows with ``late``, not with a delivery; late pages go unsearched."""
    landing, table, state = (str(tmp_path / n) for n in ("landing", "table", "state"))
    first = datetime.datetime(2024, 1, 1, 22)

    def deliver(*pages):
        spark.createDataFrame(list(pages), PAGE_TYPE).write.mode("append").parquet(landing)
        ingest_new_pages(spark, landing, table, state, late="3 days")
        return read_table(spark, table, PRICES).count()

    def kept():
        return sum(
            spark.read.parquet(str(f)).count() for f in tmp_path.glob("state*/**/*.parquet") if "sources" not in f.parts
        )

    days = [page("A", 200, first + datetime.timedelta(days=n), str(n)) for n in range(40)]
    assert deliver(*days, *days) == 40
    assert kept() == 3 and not list(tmp_path.glob("state/state"))
    # A page without any figures is new; one exactly three days behind the newest is late.
    at = first + datetime.timedelta(days=39)
    assert deliver(("B", 200, at, "<p></p>"), page("C", 200, at - datetime.timedelta(days=3), "1"), *days) == 41
    assert deliver(("B", 200, at, "<p></p>")) == 41
    assert kept() == 8 and len(list((tmp_path / "state.seen").iterdir())) == 2


def test_text_of_a_price_is_read_once(spark):
    plan = spark.range(1).select(parse_price(F.col("id").cast("string")).alias("price"))
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract(") == 1
    texts = spark.createDataFrame([("1,234.5",), ("1e999",), ("-1e999",), ("x",), (None,)], "t string")
    assert [r[0] for r in texts.select(parse_price("t")).collect()] == [1234.5, None, None, None, None]


ODD_ELEMENTS = [
    "<span> 1 </span>", "<span></span>", "<span> </span>", "<span>a<b> c </b></span>", "<SPAN\n>a > b</Span >",
    "<span>a &amp; b</span>", "<span x='&amp;'>\u00a0a\n</span>", "<span <span>a</span>b</span>", "<span>a",
    "<span x='>'>a</span>", "<span>a<span>b</span>c</span>", "<span/>a</span>", "<spanner>a</spanner>",
    "<span><!-- c -->a</span>", "<span>$1 \\1</span>", "", None,
]


@pytest.mark.parametrize("pieces", [(), ("text",)])
def test_an_element_of_text_alone_has_the_same_text(spark, pieces):
    pages = spark.createDataFrame([(f, h) for f, h in enumerate(ODD_ELEMENTS)], "id int, html string")
    got = ingest.extract_page_text(pages, {"text": {"tag": "span"}}, pieces)
    element = html.element_markup(html.visible(F.col("html")), tag="span")
    wanted = pages.select("id", html.markup_text(element, bool(pieces)).alias("text"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, wanted.collect()))
    bare = spark.createDataFrame([("<p>a </p>",), ("<p></p>",), ("<p>a<b>c</b></p>",), ("",)], "m string")
    found = [r[0] for r in bare.select(html.text_alone(F.col("m"))).collect()]
    assert found == ["a ", "<p></p>", "<p>a<b>c</b></p>", ""]


def test_hidden_source_is_that_of_two_patterns(spark):
    """One start for comments, scripts and styles hides what a pattern for each did."""
    whole = r"(?is)<!--.*?-->|<(script|style)\b[^>]*>.*?</\1\s*>"
    pages = [
        "a<!-- <script> -->b</script>c", "<SCRIPT x>a</style></Script >b", "<scripty>a</scripty>", "<!-a-->",
        "<style\n>a<!--</style>b-->", "<script>a", "<<!---->>", "<s>a</s><!--\n-->", "<script>a</script\n><style>b</style>",
    ]
    rows = spark.createDataFrame([(p,) for p in pages], "html string")
    got = rows.select("html", html.visible(F.col("html")), F.regexp_replace("html", whole, "")).collect()
    assert [r[1] for r in got] == [r[2] for r in got]
    assert "|<" not in html.HIDDEN
