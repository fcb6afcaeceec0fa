from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from tidemark.operators.joins import hot_keys, join_to_one
from tidemark.operators.ranking import with_group_totals
from tidemark.scratch import discard, keep


def test_join_to_one_equals_join_with_a_hot_key(spark):
    many = keep(spark.range(900).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id"), "m")
    many = many.union(spark.createDataFrame([(None, -1)], "k long, id long"))
    one = spark.range(0, 900, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    one = one.union(spark.createDataFrame([(7, 70)], "k long, v long"))
    assert [r["k"] for r in hot_keys(many, ["k"]).collect()] == [7]
    for how in ("inner", "left"):
        got = Counter(map(tuple, join_to_one(many, one, ["k"], how).select("k", "id", "v").collect()))
        assert got == Counter(map(tuple, many.join(one, ["k"], how).select("k", "id", "v").collect()))


def test_join_to_one_of_nothing(spark):
    empty = spark.createDataFrame([], "k long, id long")
    assert join_to_one(empty, empty.withColumnRenamed("id", "v"), ["k"]).count() == 0


def test_group_totals_carry_over_partitions(spark):
    rows = [(g, i, (i * 7 + len(g)) % 11) for g, n in (("hot", 400), ("a", 3), ("zz", 120)) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, i int, v long")
    got = {(r["g"], r["i"]): r["cum_v"] for r in with_group_totals(df, ["g"], [F.col("i")], ["v"]).collect()}
    want, total = {}, Counter()
    for g, i, v in sorted(rows):
        total[g] += v
        want[g, i] = total[g]
    assert got == want


def test_discard_deletes_the_files(spark):
    kept = keep(spark.range(5), "short")
    path = kept._scratch_path
    discard(kept)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    assert not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
