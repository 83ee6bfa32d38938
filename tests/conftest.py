import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from graphloom.session import ensure_checkpoint_dir

    session = (
        SparkSession.builder.master("local[*]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    # the session's own checkpoint folder wins; a private one only where none is set
    ensure_checkpoint_dir(session, tempfile.mkdtemp(prefix="graphloom-test-ckpt-"))
    yield session


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="graphloom-test-")
