"""Hot keys: one series / uid holds a third of all rows. Results must be
whole and exact, and the per-key work must be partial-aggregated before the
shuffle (no window over the hot key)."""
from collections import Counter

from pyspark.sql import functions as F

from eventflow.operators import merge as G
from eventflow.operators import propagate as P
from eventflow.operators.numbering import dense_index

N = 3000


def hot_frame(spark):
    # ids 0..999 share series 'hot'; the rest spread over 500 series
    return spark.range(0, N).select(
        F.col("id"),
        F.when(F.col("id") < N // 3, F.lit("hot")).otherwise((F.col("id") % 500).cast("string")).alias("series_id"),
        F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise((F.col("id") % 3 == 0).cast("int")).alias("label"))


def test_majority_fill_hot_series(spark):
    df = hot_frame(spark)
    rows = df.collect()
    votes = {}
    for r in rows:
        if r.label is not None:
            votes.setdefault(r.series_id, Counter())[r.label] += 1
    maj = {s: sorted(c.items(), key=lambda kv: (-kv[1], kv[0]))[0][0] for s, c in votes.items()}
    out = P.propagate_majority_fill(df)
    got = {r.id: r.label for r in out.collect()}
    assert len(got) == N
    for r in rows:
        assert got[r.id] == (r.label if r.label is not None else maj.get(r.series_id))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_mode" in plan and "Window" not in plan


def test_keep_first_hot_uid(spark):
    df = spark.range(0, N).select(F.col("id").alias("ord"),
                                  F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("uid"))
    out = G.merge_first_wins(df, df.limit(0), order_col="ord")
    got = out.collect()
    assert len(got) == N - N // 3 + 1
    assert [r.ord for r in got if r.uid == "hot"] == [0]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "Window" not in plan


def test_dense_index_hot_group(spark):
    df = spark.range(0, N).select(F.col("id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7).alias("g"))
    out = dense_index(df, [F.col("id")], group_cols=["g"], out="i")
    hot = [r.i for r in out.where("g = 0").orderBy("id").collect()]
    assert hot == list(range(1, len(hot) + 1))


def test_rows_without_series_are_spread(spark):
    """Half the rows have no series: no task of the join takes them all."""
    from pyspark.sql import functions as F

    from eventflow.operators import propagate as P
    df = spark.range(0, 20000, 1, 8).select("id", F.when(F.col("id") % 2 == 0, (F.col("id") % 500).cast("string")).alias("series_id"),
                                            F.when(F.col("id") % 7 == 0, 1).alias("label"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for f in (P.propagate_unanimous, P.propagate_majority_fill, P.propagate_majority_overwrite):
            out = f(df)
            sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
            assert sum(sizes) == 20000 and max(sizes) < 2 * 20000 / len(sizes)
            assert out.where("series_id is null and label is not null and id % 7 <> 0").count() == 0
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
