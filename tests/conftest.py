import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    # tests set their own shared folder only where the session names none
    if not (s.sparkContext.getCheckpointDir() or s.conf.get("spark.checkpoint.dir", None)):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="usagetally-test-"))
    yield s


def rows(df, *cols):
    """Sorted list of tuples of the given columns (all when none given)."""
    sel = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in sel.collect())
