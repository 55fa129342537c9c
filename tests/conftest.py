from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from cohortlab.session import build_session

    ckpt = str(tmp_path_factory.mktemp("ckpt"))
    s = build_session("local[4]", app_name="cohortlab-tests", shuffle_partitions=4, extra_conf={
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": ckpt,
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(ckpt)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.exists(f"{SMOKE}/customer.parquet"):
        pytest.skip("driver test data not present")
    return SMOKE
