import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from evstream.session import local_session, prepare_streaming  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", shuffle_partitions=4)
    session.sparkContext.setLogLevel("OFF")
    prepare_streaming(session)
    yield session
    session.stop()


@pytest.fixture
def sliced(spark):
    """Force the hot-key path: every key above three rows is cut into slices."""
    spark.conf.set("evstream.slice.rows", "3")
    spark.conf.set("evstream.slice.floor.bytes", "0")
    yield
    spark.conf.unset("evstream.slice.rows")
    spark.conf.unset("evstream.slice.floor.bytes")


@pytest.fixture(scope="session")
def sql():
    import compare

    return compare.tables(DATA)


def at(seconds, base="2024-01-01"):
    """A time ``seconds`` after midnight, exact to the microsecond."""
    import datetime as dt

    return dt.datetime.fromisoformat(base) + dt.timedelta(microseconds=round(seconds * 1_000_000))


def rows_of(df, *cols):
    """The rows as a sorted list of tuples."""
    data = [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
    return sorted(data, key=lambda r: tuple((v is None, str(type(v)), v) for v in r))
