from __future__ import annotations

import contextlib
import os
import sys

import pytest
from pyspark import SparkContext
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def _session() -> SparkSession:
    os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, (ROOT, os.environ.get("PYTHONPATH"))))
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def _lost(session: SparkSession) -> bool:
    try:
        return session.sparkContext._jsc.sc().isStopped()
    except Exception:  # the JVM is gone
        return True


_current: list[SparkSession] = []


def _alive() -> SparkSession:
    if _current and _lost(_current[0]):
        _current.clear()
        with contextlib.suppress(Exception):
            SparkContext._gateway.shutdown()
        SparkContext._gateway = SparkContext._jvm = SparkContext._active_spark_context = None
        SparkSession._instantiatedSession = None
    if not _current:
        _current.append(_session())
    return _current[0]


class _Restarting:
    """The one session of all tests; where it has been lost, the test that follows gets a new one."""

    def __getattr__(self, name: str):
        return getattr(_alive(), name)


@pytest.fixture(scope="session")
def spark():
    return _Restarting()


def pytest_sessionfinish():
    if _current and not _lost(_current[0]):
        _current[0].stop()
