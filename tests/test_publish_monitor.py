"""Calendar payloads, dimension upkeep, cleanup, metadata, monitoring (K, L)."""
from pyspark.sql import functions as F

from eventflow.operators import monitor as L
from eventflow.operators import publish as K
from eventflow.operators.numbering import dense_index


def test_calendar_meta(spark):
    df = spark.createDataFrame([("2025-09-05 18:30:00", "2025-09-05T21:15:00-05:00", "https://e/1"),
                                ("2025-09-06", None, None), (None, None, None)],
                               "start string, end string, url string")
    rows = [r.meta for r in K.calendar_meta(df).collect()]
    m = rows[0]
    assert m["evcal_srow"] == "1757097000"
    assert (m["evcal_start_date"], m["evcal_start_time_hour"], m["evcal_start_time_min"], m["evcal_start_time_ampm"]) \
        == ("2025-09-05", "06", "30", "pm")
    assert m["evcal_erow"] == "1757124900"                 # the instant of the zoned text
    assert m["evcal_end_time_hour"] == "09"                 # its own wall clock
    assert m["evcal_lmlink"] == "https://e/1"
    assert rows[1]["evcal_start_time_ampm"] == "am" and "evcal_erow" not in rows[1]
    assert rows[2] == {}
    post = K.calendar_post(K.calendar_meta(df.withColumn("description", F.lit(None).cast("string")))).first().post
    assert (post.title, post.content, post.status, post.type) == ("Untitled Event", "", "draft", "ajde_events")


def test_upsert_locations(spark):
    dim = spark.createDataFrame([(1, "Library"), (5, "Park")], "id bigint, name string")
    ev = spark.createDataFrame([(1, "Park"), (2, "Zoo"), (3, "Arena"), (4, None), (5, ""), (6, "Zoo")],
                               "e int, location string")
    with_ids, updated = K.upsert_locations(ev, dim)
    got = {r.e: r.location_id for r in with_ids.collect()}
    assert got == {1: 5, 2: 7, 3: 6, 4: None, 5: None, 6: 7}
    assert updated.count() == 4


def test_dense_index_groups(spark):
    df = spark.range(0, 1000).select((F.col("id") % 3).alias("g"), F.col("id"))
    out = dense_index(df, [F.col("id")], group_cols=["g"], out="i")
    per = out.groupBy("g").agg(F.min("i").alias("lo"), F.max("i").alias("hi"), F.count("*").alias("n"),
                               F.count_distinct("i").alias("d")).collect()
    for r in per:
        assert r.lo == 1 and r.hi == r.n == r.d
    assert out.where((F.col("g") == 0) & (F.col("id") == 3)).first().i == 2


def test_delete_publish(spark):
    posts = spark.createDataFrame([(i, "draft") for i in (1, 2, 3, 10)], "id bigint, status string")
    remaining, outcome = K.delete_range(posts, 2, 5)
    assert [r.id for r in remaining.collect()] == [1, 10]
    assert tuple(outcome.first()) == (2, 0, 4)
    remaining, outcome = K.delete_range(posts, 2, 5, failed=spark.createDataFrame([(3,), (3,), (10,)], "id bigint"))
    assert sorted(r.id for r in remaining.collect()) == [1, 3, 10]
    assert tuple(outcome.first()) == (1, 1, 4)
    pub = K.publish(posts, spark.createDataFrame([(3,), (99,)], "id bigint"))
    assert {r.id: r.status for r in pub.collect()} == {1: "draft", 2: "draft", 3: "publish", 10: "draft"}


def test_meta_filter_sanitize_upsert(spark):
    df = spark.createDataFrame([(1, {"evcal_srow": "1", "evo_x": "<b>bold</b>\n\n  text %2F", "other": "x",
                                     "_featured": "yes", "event_location": "<script>bad()</script>7"})],
                               "id int, meta map<string,string>")
    m = df.select(K.sanitize_meta(K.filter_meta(F.col("meta"))).alias("m")).first().m
    assert m == {"evcal_srow": "1", "evo_x": "bold text", "_featured": "yes", "event_location": "7"}
    old = spark.createDataFrame([(1, {"evcal_srow": "1", "evcal_lmlink": "a"}), (2, {"evcal_srow": "2"})],
                                "id int, meta map<string,string>")
    new = spark.createDataFrame([(1, 1, {"evcal_lmlink": "b"}, "ajde_events"), (1, 2, {"evcal_lmlink": "c", "zzz": "q"},
                                 "ajde_events"), (2, 1, {}, "ajde_events"), (2, 3, {"evcal_srow": "9"}, "post")],
                                "id int, seq int, meta map<string,string>, type string")
    got = {(r.id, r.key): r.value for r in K.upsert_meta(old, new, seq="seq").collect()}
    assert got == {(1, "evcal_srow"): "1", (1, "evcal_lmlink"): "c", (2, "evcal_srow"): "2"}


def test_monitor(spark):
    posts = spark.createDataFrame([(i, "publish" if i % 2 else "draft", s) for i, s in
                                   [(1, "100"), (2, "500"), (3, " 300 "), (5, "12.5"), (7, None), (9, "x")]],
                                  "id bigint, status string, evcal_srow string")
    latest = L.latest_published(posts, k=3)
    assert [r.id for r in latest.collect()] == [9, 7, 5]
    assert L.count_upcoming(posts, 200).first().upcoming == 1      # drafts do not count
    pages = spark.createDataFrame([("<div class='AJDE_EVCAL'>",), ("<p>none</p>",)], "html string")
    assert [r.markup_detected for r in L.markup_detected(pages).collect()] == [True, False]
    up = L.count_upcoming(posts, 0)
    ok = pages.select(F.lit(False).alias("page_ok")).limit(1)
    v = L.health_verdict(up, ok, require_page=False).first()
    assert v.healthy and v.upcoming == 5
    assert not L.health_verdict(up, ok, require_page=True).first().healthy


def test_upload_plan_and_outcome(spark):
    df = spark.createDataFrame([(1, "Fest", "2025-09-06"), (2, None, None), (3, "Walk", "2025-09-07")],
                               "id bigint, title string, start string")
    lines = [r.plan_line for r in K.upload_plan(df).orderBy("id").collect()]
    assert lines == ["Fest (2025-09-06)", "nan (nan)", "Walk (2025-09-07)"]
    assert K.upload_plan(df.drop("title", "start")).first().plan_line == "Untitled (No date)"
    out = K.upload_outcome(df, spark.createDataFrame([(1,), (3,), (9,)], "id bigint")).first()
    assert (out.created, out.total) == (2, 3)
