"""End-to-end jobs on small stored inputs."""
import json
import os

from pyspark.sql import functions as F

from eventflow.operators import models as J
from eventflow.plans import jobs

B = "https://calendar.example.org"


def _cal(uid, title, desc, loc, start):
    return ("BEGIN:VCALENDAR\r\nBEGIN:VEVENT\r\n"
            f"UID:{uid}\r\nSUMMARY:{title}\r\nDESCRIPTION:{desc}\r\nLOCATION:{loc}\r\n"
            f"DTSTART:{start}\r\nCATEGORIES:Community\r\nEND:VEVENT\r\nEND:VCALENDAR\r\n")


def test_scrape_classify_publish(spark, tmp_dir):
    month = spark.createDataFrame(
        [(1, B + "/events/calendar/2025-09-01",
          '<a href="/events/details/fest-1">f</a><a href="/events/details/board-2">b</a>'
          '<a href="/events/details/fest-1">again</a><a href="/events/details/lost-3">l</a>')],
        "page_id bigint, url string, html string")
    details = spark.createDataFrame([
        (B + "/events/details/fest-1", '<a href="/events/ical/fest-1.ics">Add to Calendar - iCal</a>'),
        (B + "/events/details/board-2", "<p>no link</p>"),
    ], "url string, html string")
    ics = spark.createDataFrame([
        (B + "/events/ical/fest-1.ics", _cal("f1", "Family festival", "music and food", "Town park", "20250906T150000Z")),
        (B + "/events/ical/board-2.ics", _cal("b2", "Board meeting", "committee agenda", "Chamber office",
                                              "20250908T090000")),
    ], "ics_url string, content string")
    events, errors = jobs.scrape_frame(month, details, ics)
    rows = {r.uid: r for r in events.collect()}
    assert set(rows) == {"f1", "b2"}
    assert rows["f1"].source_page == B + "/events/details/fest-1"
    assert errors.count() == 0          # lost-3 resolves by slug but has no calendar file
    train = spark.createDataFrame(
        [("Family festival %d" % i, "music food kids", "park", "Community", 1) for i in range(12)] +
        [("Board meeting %d" % i, "committee agenda members", "office", "Business", 0) for i in range(12)],
        "title string, description string, location string, category string, label int")
    model = J.fit_svm_prob(train, folds=3)
    out = jobs.periodic_run(events, model, tmp_dir + "/run", run_ts="20250901_000000")
    assert out["stats"]["total_events"] == 2
    assert out["stats"]["community_events"] == 1
    assert os.path.isdir(tmp_dir + "/run/calendar_upload/run_ts=20250901_000000")
    assert spark.read.parquet(tmp_dir + "/run/scraped").count() == 2
    post = out["posts"].first().post
    assert post.title == "Family festival" and post.meta["evcal_start_time_ampm"] == "pm"


def test_train_and_tag_jobs(spark, tmp_dir):
    src = os.path.join(tmp_dir, "events.json")
    evs = []
    for i in range(30):
        fam = i % 2 == 0
        evs.append({"uid": f"e{i % 10}", "title": ("Youth art class" if fam else "Leads group lunch") + f" {i}",
                    "description": "kids families fun" if fam else "business networking members",
                    "start": f"2025-09-{i % 28 + 1:02d}T1{i % 10}:00:00", "location": "library" if fam else "hotel",
                    "url": f"https://x/{i}", "label": 1.0 if fam else (0 if i % 3 else None)})
    json.dump({"events": evs}, open(src, "w"))
    res = jobs.train_job(spark, src, tmp_dir + "/model", propagate=True)
    assert res["balance"]["labeled"] >= 20
    model = J.TextModel.load(spark, tmp_dir + "/model")
    assert model.columns["title"] == "title"
    counts = jobs.tag_job(spark, tmp_dir + "/model", src, tmp_dir + "/tagged.json", confidence=True)
    assert counts["positives"] + counts["negatives"] == 30
    tagged = spark.read.json(tmp_dir + "/tagged.json")
    assert {"predicted_label", "prediction_confidence"} <= set(tagged.columns)
    default = jobs.tag_job(spark, tmp_dir + "/model", src)
    assert default["output"].endswith("/events_tagged.csv")
    assert tagged.where(F.col("predicted_label").isNull()).count() == 0
    smart = jobs.smart_label_job(spark, tmp_dir + "/model", src, tmp_dir + "/smart.json", auto=True)
    assert sum(smart["confidence"].values()) == 30
    assert all(r.label is None for r in smart["flagged"])


def test_self_train_job(spark, tmp_dir):
    import csv
    ex, nw = os.path.join(tmp_dir, "existing.csv"), os.path.join(tmp_dir, "new.csv")
    with open(ex, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(["uid", "title", "description", "location", "category", "label"])
        for i in range(24):
            fam = i % 2 == 0
            w.writerow([f"e{i}?series_id={i % 6}", ("Kids craft fair" if fam else "Members webinar") + f" {i}",
                        "families fun" if fam else "sponsor committee", "park" if fam else "office", "x",
                        "1.0" if fam else "0"])
    with open(nw, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(["uid", "title", "description", "location", "category"])
        for i in range(10):
            w.writerow([f"n{i}?series_id={i % 6}", "Kids craft fair again", "families", "park", "x"])
        w.writerow(["e0?series_id=0", "Duplicate of existing", "x", "y", "x"])
    out = jobs.self_train_job(spark, ex, nw, tmp_dir + "/merged", tmp_dir + "/model")
    assert out["total"] == 34                     # 24 existing + 10 new; the duplicate uid keeps the existing row
    assert out["report"] is not None and any(r.cls == "accuracy" for r in out["report"])
    merged = spark.read.parquet(tmp_dir + "/merged")
    assert merged.where("uid = 'e0?series_id=0'").first().label_source == "series_propagation"


def test_labelset_fill_merge_jobs(spark, tmp_dir):
    import csv
    src = os.path.join(tmp_dir, "ev.csv")
    with open(src, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(["uid", "title", "description", "location", "url", "label"])
        w.writerow(["a", "Farmers market", "fresh food", "Park", "https://x/1", "1.0"])
        w.writerow(["a", "Farmers market", "fresh food", "Park", "https://x/2", ""])
        w.writerow(["", "Board meeting", "committee", "Hall", "https://x/3?y=1", "0"])
        w.writerow(["", "Board meeting", "committee", "Hall", "https://x/3/", ""])
        w.writerow(["", "Solo", "", "", "", ""])
    raw, lbl = jobs.labelset_job(spark, src, tmp_dir + "/ls")
    ls = {r.title: r for r in spark.read.option("header", True).csv(lbl).collect()}
    assert ls["Farmers market"].weak_label == "1" and ls["Board meeting"].weak_label == "0"
    res = jobs.fill_job(spark, src, tmp_dir + "/filled.csv")
    assert (res["coverage"]["labeled_before"], res["coverage"]["labeled_after"]) == (2, 4)
    filled = spark.read.option("header", True).csv(tmp_dir + "/filled.csv")
    assert sorted((r.title, r.label) for r in filled.collect() if r.title != "Solo") == \
        [("Board meeting", "0"), ("Board meeting", "0"), ("Farmers market", "1"), ("Farmers market", "1.0")]
    comb = os.path.join(tmp_dir, "combined.csv")
    with open(comb, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(["series_id", "title", "label", "predicted_label"])
        w.writerows([["s1", "A", "1.0", ""], ["s1", "A", "", "0"], ["s1", "A", "", ""], ["", "B", "", ""],
                     ["s2", "C", "", ""]])
    out = jobs.merge_propagate_job(spark, comb, tmp_dir + "/merged")
    got = [r.label for r in spark.read.parquet(tmp_dir + "/merged").orderBy("title", "label").collect()]
    assert sorted(got, key=lambda v: (v is None, v)) == [0.0, 0.0, 1.0, None, None]
    assert {r.label: r.n for r in out["counts"]} == {0.0: 2, 1.0: 1, None: 2}


def test_upload_health_delete_jobs(spark, tmp_dir):
    from eventflow.sources.writers import export_for_calendar
    ev = spark.createDataFrame([("Fest", "2025-09-06 18:00:00", None, "Town park", "https://x/1", "d"),
                                ("Walk", "2025-09-07T08:00:00-05:00", None, "Zoo", None, None)],
                               "title string, start string, end string, location string, url string, description string")
    export_for_calendar(ev, tmp_dir + "/exp", "20250901_000000", "csv")
    plan = [r.plan_line for r in jobs.upload_job(spark, tmp_dir + "/exp")["plan"].collect()]
    assert sorted(plan) == ["Fest (2025-09-06 18:00:00)", "Walk (2025-09-07T08:00:00-05:00)"]
    dim = spark.createDataFrame([(4, "Zoo")], "id bigint, name string")
    real = jobs.upload_job(spark, tmp_dir + "/exp", dim, dry_run=False)
    metas = {r.post.title: r.post.meta for r in real["posts"].collect()}
    assert metas["Walk"]["event_location"] == "4" and metas["Fest"]["event_location"] == "5"
    assert metas["Walk"]["evcal_start_time_hour"] == "08" and metas["Fest"]["evcal_lmlink"] == "https://x/1"
    posts = spark.createDataFrame([(i, "publish", str(1000 * i)) for i in range(1, 9)],
                                  "id bigint, status string, evcal_srow string")
    pages = spark.createDataFrame([("<div class='evo_cal'>",)], "html string")
    h = jobs.health_job(posts, pages, now_epoch=4000, require_page=True)
    assert h == {"upcoming": 5, "page_ok": True, "healthy": True}
    remaining, out = jobs.delete_job(posts, 2, 20)
    assert out == {"deleted": 7, "failed": 0, "attempted": 19} and remaining.count() == 1
