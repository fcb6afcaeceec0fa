"""Rows on which the first round gave wrong results."""

from __future__ import annotations

import os
import subprocess
import sys

import numpy as np
import pyarrow as pa

from tidemark.functions.numbers import parse_number
from tidemark.operators import evidence
from tidemark.operators.contract import duplicate_rows
from tidemark.operators.retrieval import _unit_rows


def test_duplicates_see_microseconds_and_no_sign_of_zero(spark):
    times = spark.sql(
        "SELECT * FROM VALUES (timestamp'2024-01-01 00:00:00.000001'), (timestamp'2024-01-01 00:00:00.000002') t(x)"
    )
    assert duplicate_rows(times).first()["duplicates"] == 0
    zeros = spark.createDataFrame([(0.0,), (-0.0,), (None,)], "x double")
    assert duplicate_rows(zeros).first()["duplicates"] == 1


def test_infinite_text_is_no_number(spark):
    df = spark.createDataFrame([("Infinity",), ("-Infinity",), ("NaN",), ("1.5",)], "x string")
    assert [r[0] for r in df.select(parse_number("x")).collect()] == [None, None, None, 1.5]


def test_missing_vectors_do_not_shift_others():
    vectors = pa.array([[3.0, 4.0], None, [1.0], [0.0, 2.0], [None, 1.0]], pa.list_(pa.float64()))
    assert np.allclose(_unit_rows(vectors, 2), [[0.6, 0.8], [0, 0], [0, 0], [0, 1], [0, 0]])


def test_all_reviews_without_a_limit(spark):
    reviews = spark.range(3_500).selectExpr("concat('R', id) AS review_id", "cast(id AS double) AS sentiment_score")
    assert evidence.select_reviews(reviews).count() == 3_500
    assert evidence.select_reviews(reviews, 7).count() == 7


def test_workers_get_the_package(tmp_path):
    """A session started elsewhere runs functions that refer to this package."""
    code = (
        "import sys, importlib.util\n"
        f"sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})\n"
        "from tidemark.session import local_session, ship_package\n"
        "from tidemark.functions import text\n"
        "spark = local_session('elsewhere', cores='1')\n"
        "ship_package(spark)\n"
        "def run(batches):\n"
        "    import tidemark.functions.text, pyarrow as pa\n"
        "    yield pa.RecordBatch.from_arrays([pa.array([tidemark.functions.text.__name__])], ['x'])\n"
        "print(spark.range(1).mapInArrow(run, 'x string').first()[0])\n"
    )
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_LOCAL_DIRS")}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert "tidemark.functions.text" in done.stdout, done.stderr[-800:]
