import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from pressio.session import SESSION_CONF
    b = (SparkSession.builder.master("local[4]").appName("pressio-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "8g")
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="pressio-test-ckpt-")))
    for k, v in SESSION_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    from pressio.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(s)
    yield s
