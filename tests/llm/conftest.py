import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from eventflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return build_session(master="local[4]", shuffle_partitions=4)


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
