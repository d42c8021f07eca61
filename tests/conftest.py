import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import local_session

    session = local_session(4, "tests")
    session.sparkContext.setLogLevel("ERROR")
    return session


def day(text):
    return dt.date.fromisoformat(text)


def days(start, end):
    a, b = day(start), day(end)
    return [a + dt.timedelta(days=i) for i in range((b - a).days + 1)]


@pytest.fixture(scope="session")
def panel(spark):
    """Rows without entity -> a panel with two entities, the second ten times the first where asked."""

    def make(rows, schema, entities=("one", "two")):
        rows = [(e, *((day(r[0]) if isinstance(r[0], str) else r[0]), *r[1:])) for e in entities for r in rows]
        return spark.createDataFrame(rows, f"entity STRING, date DATE, {schema}")

    return make


@pytest.fixture(scope="session")
def by_date():
    """{date text: row} of one entity."""

    def collect(df, entity="one", key="date"):
        return {str(r[key]): r for r in df.collect() if r["entity"] == entity}

    return collect
