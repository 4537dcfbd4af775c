"""Dense numbering and selection by hash histogram: exact, lazy, balanced."""
import hashlib
import math

from pyspark.sql import functions as F

from eventflow.operators import models as J
from eventflow.operators.numbering import dense_index, hash_cut


def md5(x):
    return hashlib.md5(x.encode()).hexdigest()


def test_dense_index_is_the_position_in_order(spark):
    names = [f"name {i * 7919 % 5000}" for i in range(5000)] + ["", "é", "Z", "a"]
    df = spark.createDataFrame([(n,) for n in names], "name string").repartition(7)
    got = {r.name: r.idx for r in dense_index(df, [F.col("name")]).collect()}
    order = sorted(names, key=lambda n: n.encode())
    assert got == {n: i for i, n in enumerate(order, 1)}
    groups = spark.range(0, 3000).select(F.col("id"), F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 2).alias("g"))
    rows = dense_index(groups, [F.col("id")], group_cols=["g"], out="i").collect()
    place = {}
    for r in sorted(rows, key=lambda r: r.id):
        place[r.g] = place.get(r.g, 0) + 1
        assert r.i == place[r.g]
    assert len(rows) == 3000
    few = dense_index(df.limit(0), [F.col("name")])
    assert few.count() == 0
    assert [r.idx for r in dense_index(spark.createDataFrame([("x",)], "name string"), [F.col("name")]).collect()] == [1]


def test_cut_takes_the_smallest_hashes(spark):
    df = spark.range(0, 4001).select(F.col("id"), F.when(F.col("id") % 10 == 0, "rare").otherwise("common").alias("g"),
                                     F.md5(F.col("id").cast("string")).alias("h"))
    for share in (0.0, 0.2, 0.5, 1.0):
        got = df.where(hash_cut(df, "h", share, "g")).groupBy("g").agg(F.sort_array(F.collect_list("h")).alias("hs")).collect()
        want = {}
        for i in range(4001):
            want.setdefault("rare" if i % 10 == 0 else "common", []).append(md5(str(i)))
        assert {r.g: r.hs for r in got} == {g: sorted(hs)[:math.ceil(share * len(hs))] for g, hs in want.items() if share}
    assert df.limit(0).where(hash_cut(df.limit(0), "h", 0.2)).count() == 0


def test_splits_plan_without_running_a_job_or_a_sort_of_all_rows(spark):
    df = spark.range(0, 1000).select(F.col("id"), (F.col("id") % 3).cast("int").alias("label"), (F.col("id") % 50).cast("string").alias("series_id"))
    seen = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    splits = [J.stratified_split(df), J.group_split(df), dense_index(df.select(F.col("series_id")).distinct(), [F.col("series_id")])]
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == len(seen)
    for s in splits:
        plan = s._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in plan and "Scan ExistingRDD" not in plan


def test_null_keys_spread_over_both_sides_and_all_tasks(spark):
    df = spark.range(0, 4000).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("id"), F.col("id").alias("payload"),
                                     (F.col("id") % 2).cast("int").alias("label"))
    s = J.stratified_split(df).collect()
    by = {}
    for r in s:
        by.setdefault((r.label, r.split), []).append(r)
    assert {k: len(v) for k, v in by.items()} == {(0, "test"): 400, (0, "train"): 1600, (1, "test"): 400, (1, "train"): 1600}
    hashed = df.withColumn("h", J.seeded_hash(F.col("id"), "42", df.columns)).where("id is null")
    tasks = hashed.repartition(8, "h").groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) == 8 and max(r["count"] for r in tasks) < 1.4 * 2000 / 8
    again = {(r.id, r.payload): r.split for r in J.stratified_split(df.repartition(5)).collect()}
    assert again == {(r.id, r.payload): r.split for r in s}


def test_copies_of_a_key_stay_together(spark):
    df = spark.range(0, 300).select((F.col("id") % 100).alias("id"), F.lit(1).alias("label"))
    s = J.stratified_split(df)
    assert s.groupBy("id").agg(F.count_distinct("split").alias("k")).where("k > 1").count() == 0
    assert 60 <= s.where("split = 'test'").count() <= 62
