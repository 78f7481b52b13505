import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from traitlens.session import get_session

    warehouse = tmp_path_factory.mktemp("warehouse")
    s = get_session("local[*]", shuffle_partitions=8, app_name="traitlens-tests",
                    extra={"spark.sql.warehouse.dir": str(warehouse),
                           "spark.driver.memory": "8g"})
    s.sparkContext.setLogLevel("ERROR")
    ckpt = tmp_path_factory.mktemp("checkpoints")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(str(ckpt))
    yield s


@pytest.fixture(scope="session")
def inputs(spark):
    from traitlens.plans.registry import inputs as make

    return make(spark, SF_SMALL)


def rows(df, *cols):
    """Collect ``cols`` as tuples, ordered as the frame is (use with ordered input)."""
    return [tuple(r[c] for c in cols) for r in df.collect()]
