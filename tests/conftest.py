import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from acreledger import Ledger  # noqa: E402
from acreledger.session import build_session  # noqa: E402
from acreledger.sources.schema import LEDGER_TABLES  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[8]",
        "tests",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": f"file://{tempfile.mkdtemp(prefix='checkpoints-')}",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def ledger_of(spark):
    """Ledger from ``{table: [dict, ...]}``; tables not given are empty."""

    def build(**tables):
        def frame(name):
            schema = LEDGER_TABLES[name]
            columns = [c.strip().split(" ")[0] for c in schema.split(",")]
            rows = [tuple(row.get(c) for c in columns) for row in tables.get(name, [])]
            return spark.createDataFrame(rows, schema)

        return Ledger(frame)

    return build


@pytest.fixture
def at():
    return lambda text: dt.datetime.fromisoformat(text)


def values(df, *columns):
    """Rows as a sorted list of tuples, decimals as floats."""
    picked = df.select(*columns) if columns else df
    import decimal

    cell = lambda v: float(v) if isinstance(v, decimal.Decimal) else v
    return sorted((tuple(cell(v) for v in r) for r in picked.collect()), key=lambda t: [(v is None, str(v)) for v in t])
