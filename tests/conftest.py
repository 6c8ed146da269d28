import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from playmart.session import DEFAULT_CONF, ensure_checkpoint_dir
    b = (SparkSession.builder.master("local[*]").appName("playmart-tests")
         .config("spark.sql.shuffle.partitions", "8"))
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # the session's spark.checkpoint.dir when the environment names one;
    # a temporary folder only when it is unset
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


def rows(df, order=None):
    """Collect as sorted tuples (order-insensitive comparison)."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=repr)
