import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tallyspark.session import build_session, ensure_checkpoint_dir, ship_package

    s = build_session("local[*]", shuffle_partitions=8, app_name="tallyspark-tests",
                      driver_memory="8g")
    ship_package(s)
    ensure_checkpoint_dir(s)  # tests: unset, so a local temp folder is set
    yield s
    from tallyspark.session import drop_scratch
    drop_scratch(s)


@pytest.fixture
def edges_df(spark):
    def make(pairs):
        return spark.createDataFrame(list(pairs), "u bigint, v bigint")
    return make


@pytest.fixture
def items_df(spark):
    def make(values, batch_size=None):
        rows = [(int(x), (i // batch_size) if batch_size else 0)
                for i, x in enumerate(values)]
        return spark.createDataFrame(rows, "item bigint, batch bigint")
    return make
