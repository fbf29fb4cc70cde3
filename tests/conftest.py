import datetime
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tickloom.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[8]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return SMALL


def day(n: int) -> datetime.date:
    return datetime.date(2024, 1, 1) + datetime.timedelta(days=n)


@pytest.fixture
def price_rows(spark):
    """Rows of one symbol, one per day, from a list of prices."""

    def make(prices, symbol="A", days=None):
        days = days or range(len(prices))
        rows = [
            (symbol, day(d), None if p is None else float(p)) for d, p in zip(days, prices)
        ]
        return spark.createDataFrame(
            rows, "symbol string, date date, current_price double"
        )

    return make


def column(frame, name):
    return [r[name] for r in frame.orderBy("symbol", "date").collect()]
