import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from pulsehouse.session import BASE_CONF
    b = (SparkSession.builder.master("local[*]").appName("pulsehouse-tests")
         .config("spark.sql.shuffle.partitions", "8"))
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    # tests only: a checkpoint folder of our own when the cluster names none
    if not os.environ.get("SPARK_CHECKPOINT_DIR_SET"):
        b = b.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="ph-test-ckpt-"))
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


SMALL = "/root/testdata/sf0.001"
