from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.plans.frames import Frames  # noqa: E402
from tidemark.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    os.environ.setdefault("SPARK_LOCAL_DIRS", str(tmp_path_factory.mktemp("spark")))
    SparkSession.builder.config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
    return local_session("tests", partitions=4)


@pytest.fixture()
def frames(spark):
    return Frames(spark, SMALL)
