"""Sources and sinks (A1-A14) and the file stream."""
import json
import os
import time

from pyspark.sql import functions as F

from eventflow.operators.shaping import EVENT_SCHEMA
from eventflow.sources import readers as A
from eventflow.sources import writers as W
from eventflow.streaming.intake import ingest_increment


def test_csv_multiline_and_na(spark, tmp_dir):
    p = os.path.join(tmp_dir, "ev.csv")
    with open(p, "w") as f:
        f.write('title,description,label\n"Fest","line one\nline ""two""",1.0\nMarket,NA,\nMeet,,x\n')
    df = A.read_events_csv(spark, p)
    rows = df.collect()
    assert len(rows) == 3
    assert rows[0].description == 'line one\nline "two"' and rows[0].label == "1.0"
    assert rows[1].description is None and rows[1].label is None


def test_json_shapes(spark, tmp_dir):
    a, b = os.path.join(tmp_dir, "a.json"), os.path.join(tmp_dir, "b.json")
    ev = [{"title": "A", "venue": {"name": "Hall", "geo": {"lat": 1.5}}, "tags": ["x", "y"]}]
    json.dump(ev, open(a, "w"))
    json.dump({"events": ev + [{"title": "B"}]}, open(b, "w"))
    da, db = A.read_events_json(spark, a), A.read_events_json(spark, b)
    assert "venue.name" in da.columns and "venue.geo.lat" in da.columns
    assert da.first()["tags"] == ["x", "y"] and da.first()["venue.geo.lat"] == 1.5
    assert db.count() == 2
    assert A.load_any(spark, b).count() == 2


def test_ics_files_and_writers(spark, tmp_dir):
    d = os.path.join(tmp_dir, "ics")
    os.makedirs(d)
    with open(os.path.join(d, "one.ics"), "w") as f:
        f.write("BEGIN:VCALENDAR\r\nBEGIN:VEVENT\r\nUID:1\r\nSUMMARY:S\r\nEND:VEVENT\r\nEND:VCALENDAR\r\n")
    with open(os.path.join(d, "skip.txt"), "w") as f:
        f.write("not a calendar")
    files, _ = A.scan_ics(spark, d)
    assert files.count() == 1 and "BEGIN:VEVENT" in files.first().content
    events = spark.createDataFrame([("T", "D", "L", "2025-01-01", None, "u", "1", ["a", "", "b"], None, None,
                                     "s.ics", "p")], EVENT_SCHEMA)
    out = os.path.join(tmp_dir, "csv")
    assert W.write_events_csv(events, out)
    back = A.read_events_csv(spark, out)
    assert back.columns == ["title", "start", "end", "location", "url", "description", "uid", "category"]
    assert back.first().category == "a;b"
    assert not W.write_events_csv(events.limit(0), os.path.join(tmp_dir, "empty"))
    assert not os.path.exists(os.path.join(tmp_dir, "empty"))
    W.write_events_json(events, os.path.join(tmp_dir, "json"))
    assert spark.read.schema(EVENT_SCHEMA).json(os.path.join(tmp_dir, "json")).first().category == ["a", "", "b"]
    assert W.default_output("/d/in.csv", "tagged") == "/d/in_tagged.csv"


def test_snapshot_export_latest(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, title string")
    base = os.path.join(tmp_dir, "snap")
    W.write_run_snapshot(df, base, "20250101_000000")
    W.write_run_snapshot(df, base, "20250102_000000")
    assert spark.read.parquet(base).where(F.col("run_ts") == "20250102_000000").count() == 2
    exp = os.path.join(tmp_dir, "exp")
    W.export_for_calendar(df.where("id = 1"), exp, "20250101_000000", "csv")
    time.sleep(1.1)
    W.export_for_calendar(df.repartition(2), exp, "20250102_000000", "csv")   # several part files
    assert W.export_for_calendar(df, exp, "x", "ical") is None
    latest = A.read_latest_export(spark, exp)
    assert sorted(r.title for r in latest.collect()) == ["a", "b"]


def test_stream_takes_new_files_only(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, x) for x in ("in", "out", "ck"))
    os.makedirs(src)

    def drop(name, titles):
        with open(os.path.join(src, name), "w") as f:
            for t in titles:
                f.write(json.dumps({"title": t, "uid": t.lower()}) + "\n")
    drop("a.json", ["A", "B"])
    def label_batch(b):
        from eventflow.functions.text import title_desc_text
        from eventflow.operators import rules as D
        from eventflow.operators import shaping as B
        return D.weak_label(B.make_series_id(b), F.lower(title_desc_text("title", "description")))
    n1 = ingest_increment(spark, src, out, ck, transform=label_batch)
    drop("b.json", ["C"])
    n2 = ingest_increment(spark, src, out, ck)
    assert n1 >= 1 and n2 >= 1
    got = spark.read.parquet(out)
    assert sorted(r.title for r in got.collect()) == ["A", "B", "C"]
    first = {r.title: r for r in got.where("batch_id = 0").collect()}
    assert first["A"].series_id == "a" and "weak_label" in got.columns
    assert ingest_increment(spark, src, out, ck) == 0


def test_write_tagged_flattens_complex_columns(spark, tmp_dir):
    df = spark.createDataFrame([(1, ["a", "b"], {"k": "v"})], "id int, category array<string>, meta map<string,string>")
    W.write_tagged(df, tmp_dir + "/t.csv")
    row = A.read_events_csv(spark, tmp_dir + "/t.csv").first()
    assert row.category == '["a","b"]' and row.meta == '{"k":"v"}'


def test_latest_export_with_other_column_order(spark, tmp_dir):
    import os
    import time
    spark.createDataFrame([("t1", "s1")], "title string, start string").write.option("header", True).csv(tmp_dir + "/exp/one.csv")
    time.sleep(1.1)
    spark.createDataFrame([("s2", "t2")], "start string, title string").write.option("header", True).csv(tmp_dir + "/exp/two.csv")
    rows = A.read_latest_export(spark, tmp_dir + "/exp").collect()
    assert [(r.title, r.start) for r in rows] == [("t2", "s2")] and set(rows[0].asDict()) == {"title", "start"}
    time.sleep(1.1)
    with open(tmp_dir + "/exp/three.csv", "w") as f:
        f.write("title,start\nt3,s3\n")
    assert [r.title for r in A.read_latest_export(spark, tmp_dir + "/exp").collect()] == ["t3"]
    os.makedirs(tmp_dir + "/none")


def test_strict_json_shapes(spark, tmp_dir):
    import pytest
    for name, text, ok in (("list", '[{"a": 1}]', True), ("wrap", '{"events": [{"a": 1}]}', True), ("plain", '{"foo": 1}', False), ("text", '"x"', False)):
        with open(f"{tmp_dir}/{name}.json", "w") as f:
            f.write(text)
        if ok:
            assert A.read_events_json(spark, f"{tmp_dir}/{name}.json", strict=True).count() == 1
        else:
            with pytest.raises(ValueError):
                A.read_events_json(spark, f"{tmp_dir}/{name}.json", strict=True)


def test_skipped_calendar_files_are_reported(spark, tmp_dir):
    from eventflow.plans.jobs import calendar_scan_job
    event, cut = b"BEGIN:VEVENT\nSUMMARY:caf\xc3\xa9\nEND:VEVENT\n", b"BEGIN:VEVENT\nSUMMARY:cut\n"
    for name, body in (("good", b"BEGIN:VCALENDAR\n" + event + b"END:VCALENDAR\n"), ("bad", b"BEGIN:VCALENDAR \xff\xfe"),
                       ("page", b"<html>"), ("half", b"BEGIN:VCALENDAR\n" + cut + event + cut)):
        with open(f"{tmp_dir}/{name}.ics", "wb") as f:
            f.write(body)
    files, errors = A.scan_ics(spark, tmp_dir)
    assert sorted(r.source_ics.rsplit("/", 1)[1] for r in files.collect()) == ["good.ics", "half.ics"]
    got = {r.source_ics.rsplit("/", 1)[1]: (r.error, r.n_broken) for r in errors.collect()}
    assert got == {"bad.ics": ("not valid UTF-8", None), "page.ics": ("no calendar", None),
                   "half.ics": ("event without an end", 2)}
    out = calendar_scan_job(spark, tmp_dir, tmp_dir + "/out")
    assert out == {"events": 2, "skipped": {"not valid UTF-8": 1, "no calendar": 1, "event without an end": 1}}
    assert {r.title for r in spark.read.parquet(tmp_dir + "/out/events").collect()} == {"café"}


def test_quarantine_of_text_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([("a", None), ("b", "begin:vcalendar"), ("c", "\ufeff BEGIN:VCALENDAR")], "source_ics string, content string")
    good, errors = A.quarantine(df)
    assert sorted(r.source_ics for r in good.collect()) == ["b", "c"]
    assert [(r.source_ics, r.error) for r in errors.collect()] == [("a", "unreadable")]
    good, errors = A.quarantine(df.limit(0))
    assert good.count() == errors.count() == 0
