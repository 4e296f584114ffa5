from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from frametide.session import build_session

    extra = {}
    # Tests set their own checkpoint folder only when the environment names none.
    from pyspark import SparkConf

    if not SparkConf().get("spark.checkpoint.dir", None):
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="frametide-test-")
    session = build_session(app="frametide-tests", master="local[4]", shuffle_partitions=4, extra=extra)
    yield session
    session.stop()
