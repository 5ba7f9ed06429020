import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# Python workers must import functions defined in test modules
os.environ["PYTHONPATH"] = os.pathsep.join(
    [ROOT, os.path.join(ROOT, "tests")] + [p for p in [os.environ.get("PYTHONPATH")] if p])

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="quarry-tests-"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    from quarry.session import checkpoint_dir
    checkpoint_dir(s)
    yield s
