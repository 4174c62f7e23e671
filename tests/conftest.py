import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from canvass.session import CORE_CONF
    b = (SparkSession.builder.master("local[*]").appName("canvass-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false"))
    for k, v in CORE_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # tests own their checkpoint folder (a cluster would name a shared one)
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="canvass-test-ckpt-"))
    yield s
    s.stop()
