import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from cohortflow.session import prepare, shared_dir

    b = (SparkSession.builder.master("local[*]").appName("cohortflow-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false"))
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    prepare(s)
    if not (s.conf.get("spark.checkpoint.dir", None)):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="cohortflow-test-"))
    shared_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="cohortflow-t-")
