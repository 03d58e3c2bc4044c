import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from biblioflow.session import tuned

    s = (SparkSession.builder.master("local[4]").appName("biblioflow-tests")
         .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g")
         .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared"))).getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    tuned(s)
    yield s


def rows(df, *cols):
    """Sorted list of tuples (for order-insensitive comparisons)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=repr)
