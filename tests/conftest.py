from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ledgerloom.session import build_session  # noqa: E402

SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

#: Settings under which every input counts as large and every key with some rows as hot.
LARGE = {
    "spark.ledgerloom.smallInputBytes": "0",
    "spark.ledgerloom.broadcastBytes": "0",
    "spark.ledgerloom.hotKeyRows": "10",
    "spark.ledgerloom.blockRows": "15",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[*]", spark__sql__shuffle__partitions="8", spark__driver__memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def large(spark):
    """Run as if the data did not fit into one task."""
    before = {k: spark.conf.get(k, None) for k in LARGE}
    for k, v in LARGE.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def plain(v):
    """Comparable form of a value from either engine."""
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return ("f", repr(v))
    if isinstance(v, decimal.Decimal):
        return ("d", str(v.normalize()))
    if isinstance(v, int):
        return ("i", v)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    if isinstance(v, datetime.date):
        return ("day", v.isoformat())
    return str(v)


def table_of(columns, rows):
    """Sorted rows with the columns in name order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(str([plain(r[i]) for i in order]) for r in rows)


def spark_table(df):
    return table_of(df.columns, [tuple(r) for r in df.collect()])
