"""Upload and publication: once per event, whatever is replayed; pages to summary."""
import json

from pyspark.sql import functions as F

from eventflow.operators import models as J
from eventflow.plans import jobs
from eventflow.streaming.publishing import publish_batch, publish_increment

B = "https://calendar.example.org"
EVENT = "uid string, title string, description string, start string, `end` string, location string, url string"


def given_model(spark):
    """A model by hand: "festival" is a community event, "board" is none."""
    terms = spark.createDataFrame([("festival", 1.0, 2.0), ("board", 1.0, -2.0)], "term string, idf double, coef double")
    return J.TextModel(J.FeatureSpec(kind="four_field", vocab="topk"), terms, 2, platt=(1.0, 0.0))


def event(i, title="Harbour festival", location="Pier"):
    return (f"u{i}" if i is not None else None, f"{title} {i}", "music", f"2025-09-{(i or 0) % 28 + 1:02d} 10:00:00", None, location, f"{B}/e/{i}")


def empty(spark):
    return spark.createDataFrame([], jobs.POSTS), spark.createDataFrame([], "id bigint, name string")


def test_given_model_scores_by_hand(spark):
    df = spark.createDataFrame([("festival board festival", ""), ("festival", "x"), ("", None)], "title string, description string")
    got = [round(r.score, 9) for r in J.predict(df, given_model(spark)).orderBy("score").collect()]
    assert got == [0.0, round((2 * 2 - 2) / 5 ** 0.5, 9), 2.0]


def test_upload_then_publish(spark):
    posts, places = empty(spark)
    events = spark.createDataFrame([event(1), event(1), event(2, location="Park"), event(3), event(None), event(None, "Other festival")], EVENT)
    failed = spark.createDataFrame([("u3",)], "uid string")
    first = jobs.upload_publish_job(events, posts, places, failed)
    assert first["outcome"] == {"created": 4, "total": 5, "published": 4}
    rows = first["posts"].orderBy("id").collect()
    assert [r.id for r in rows] == [1, 2, 3, 4] and {r.status for r in rows} == {"publish"}
    one = next(r for r in rows if r.uid == "u1")
    assert one.title == "Harbour festival 1" and one.meta["evcal_lmlink"] == B + "/e/1"
    ids = {r.name: str(r.id) for r in first["locations"].collect()}
    assert set(ids) == {"Pier", "Park"} and one.meta["event_location"] == ids["Pier"]
    assert first["summary"].count() == 4 and {r.confidence_text for r in first["summary"].collect()} == {"0.0%"}
    # the same events again: only the one that failed is new, ids go on
    again = jobs.upload_publish_job(events, first["posts"], first["locations"])
    assert again["outcome"] == {"created": 1, "total": 1, "published": 1}
    assert again["new_posts"].first().id == 5 and again["posts"].count() == 5


def test_pages_to_published_summary(spark, tmp_dir):
    cal = lambda uid, title: ("BEGIN:VCALENDAR\r\nBEGIN:VEVENT\r\n" f"UID:{uid}\r\nSUMMARY:{title}\r\n"  # noqa: E731
                              "DTSTART:20250906T150000Z\r\nLOCATION:Pier\r\nEND:VEVENT\r\nEND:VCALENDAR\r\n")
    month = spark.createDataFrame([(1, B + "/events/calendar/2025-09-01", "".join(
        f'<a href="/events/details/{n}">x</a>' for n in ("fest-1", "board-2", "fest-1")))], "page_id bigint, url string, html string")
    details = spark.createDataFrame([(B + "/events/details/fest-1", ""), (B + "/events/details/board-2", "")], "url string, html string")
    ics = spark.createDataFrame([(B + "/events/ical/fest-1.ics", cal("f", "Harbour festival")),
                                 (B + "/events/ical/board-2.ics", cal("b", "The board"))], "ics_url string, content string")
    out = jobs.calendar_job(month, details, ics, given_model(spark), tmp_dir + "/run", *empty(spark), run_ts="20250901_000000")
    assert out["stats"]["total_events"] == 2 and out["stats"]["community_events"] == 1
    assert out["outcome"] == {"created": 1, "total": 1, "published": 1}
    assert [(r.title, r.location_text) for r in out["summary"].collect()] == [("Harbour festival", "Pier")]
    assert out["posts_table"].first().uid == "f" and out["errors"].count() == 0


def test_replayed_batch_changes_nothing(spark, tmp_dir):
    model, base = given_model(spark), tmp_dir + "/calendar"

    def put(name, rows):
        with open(f"{tmp_dir}/in/{name}.json", "w") as f:
            for r in rows:
                f.write(json.dumps(dict(zip(("uid", "title", "description", "start", "end", "location", "url"), r))) + "\n")

    import os
    os.mkdir(tmp_dir + "/in")
    put("a", [event(1), event(2), event(9, "The board")])
    run = lambda: publish_increment(spark, tmp_dir + "/in", base, tmp_dir + "/ck", model)
    assert run() == [{"created": 2, "total": 2, "published": 2}]
    assert run() == []  # nothing new
    put("b", [event(2), event(3, location="Park")])
    assert run() == [{"created": 1, "total": 1, "published": 1}]
    read = lambda: sorted(map(str, spark.read.parquet(base + "/posts").drop("batch_id").collect()))
    places = lambda: sorted((r.id, r.name) for r in spark.read.parquet(base + "/locations").collect())
    before, held = read(), places()
    assert len(before) == 3 and held == [(1, "Pier"), (2, "Park")]
    batch = spark.createDataFrame([event(2), event(3, location="Park")], EVENT).withColumn("category", F.lit(None).cast("array<string>"))
    assert publish_batch(batch, 1, base, model) == {"created": 1, "total": 1, "published": 1}
    assert read() == before and places() == held
