import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from affinity.session import ensure_checkpoint_dir

    s = (SparkSession.builder.master("local[4]").appName("affinity-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    # Tests set their own shared folder only where the session has none.
    ensure_checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="affinity-test-ckpt-"))
    yield s


#: A small rating table made by a rule: (user, item, rating).
INLINE = [(u, 100 + i, 1 + (7 * u + 3 * i + u * i * i) % 5)
          for u in range(1, 10) for i in range(1, 13) if (u * u + 5 * i + 2 * u * i) % 7 < 3]
TARGET = 3


@pytest.fixture(scope="session")
def inline_ratings(spark):
    return spark.createDataFrame(INLINE, "user_id bigint, item_id bigint, rating int")


def rows_to_dict(df, key, value):
    return {r[key]: r[value] for r in df.collect()}
