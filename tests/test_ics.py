"""iCalendar parsing (C9-C11), FIXTURES.md ics_fx."""
from eventflow.operators import extract as C

CAL = ("BEGIN:VCALENDAR\r\nVERSION:2.0\r\n"
       "BEGIN:VEVENT\r\nUID:a-1\r\nSUMMARY:Farmers market\\, weekly\r\n"
       "DESCRIPTION:Fresh produce\\nand crafts\\; bring bags. A long line that is\r\n  folded here\r\n"
       "LOCATION:Town park\r\nDTSTART;VALUE=DATE:20250906\r\nDTEND;VALUE=DATE:20250907\r\n"
       "CATEGORIES:Community,Food\\, Drink\r\nURL:https://x.example/a\r\n"
       "LAST-MODIFIED:20250801T120000Z\r\n"
       "BEGIN:VALARM\r\nDESCRIPTION:alarm text\r\nEND:VALARM\r\nEND:VEVENT\r\n"
       "BEGIN:VEVENT\r\nUID:b-2\r\nSUMMARY:Board meeting\r\n"
       "DTSTART;TZID=America/Chicago:20250115T180000\r\nDTEND;TZID=America/Chicago:20250715T190000\r\n"
       "CREATED:20250101T090000\r\nEND:VEVENT\r\nEND:VCALENDAR\r\n")
EMPTY = "BEGIN:VCALENDAR\r\nVERSION:2.0\r\nEND:VCALENDAR\r\n"


def test_parse_two_events(spark):
    df = spark.createDataFrame([("u1.ics", "p1", CAL), ("u2.ics", "p2", EMPTY)],
                               "source_ics string, source_page string, content string")
    rows = {r.uid: r for r in C.parse_vevents(df).collect()}
    assert set(rows) == {"a-1", "b-2"}
    a, b = rows["a-1"], rows["b-2"]
    assert a.title == "Farmers market, weekly"
    assert a.description == "Fresh produce\nand crafts; bring bags. A long line that is folded here"
    assert a.location == "Town park"
    assert (a.start, a.end) == ("2025-09-06", "2025-09-07")
    assert a.category == ["Community", "Food, Drink"]
    assert a.last_modified == "2025-08-01T12:00:00+00:00"
    assert a.source_ics == "u1.ics" and a.source_page == "p1"
    assert b.start == "2025-01-15T18:00:00-06:00"     # CST
    assert b.end == "2025-07-15T19:00:00-05:00"       # CDT
    assert b.created == "2025-01-01T09:00:00"          # floating time stays naive
    assert b.description is None and b.category is None


def test_bad_zone_and_date_do_not_fail(spark):
    cal = ("BEGIN:VCALENDAR\r\nBEGIN:VEVENT\r\nUID:z\r\nDTSTART;TZID=Mars/Olympus:20250115T180000\r\n"
           "DTEND:20251340T250000\r\nEND:VEVENT\r\nEND:VCALENDAR\r\n")
    df = spark.createDataFrame([("z.ics", None, cal)], "source_ics string, source_page string, content string")
    r = C.parse_vevents(df).first()
    assert r.start == "2025-01-15T18:00:00"      # unknown zone: floating time
    assert r.end == "2025-13-40T25:00:00"         # shape kept, no failure


def test_quoted_parameters_and_repeated_categories(spark):
    cal = ("BEGIN:VCALENDAR\r\nBEGIN:VEVENT\r\nuid:q\r\nSUMMARY;LANGUAGE=en;X-P=\"a:b;c\":Title: with colon\r\n"
           "DTSTART;TZID=\"America/Chicago\":20250115T180000\r\nDTEND;X-P=\"a:b\":20250901T110000\r\n"
           "CATEGORIES:One,Two\\, too\r\nCATEGORIES;LANGUAGE=en:Three\r\nSUMMARY:second\r\nEND:VEVENT\r\nEND:VCALENDAR\r\n")
    df = spark.createDataFrame([("q.ics", None, cal)], "source_ics string, source_page string, content string")
    r = C.parse_vevents(df).first()
    assert (r.uid, r.title, r.start, r.end) == ("q", "Title: with colon", "2025-01-15T18:00:00-06:00", "2025-09-01T11:00:00")
    assert r.category == ["One", "Two, too", "Three"]


def test_long_parameters_and_broken_blocks(spark):
    big = 1 << 20
    cal = ("BEGIN:VCALENDAR\r\nBEGIN:VEVENT\r\nUID:lost\r\nSUMMARY:never closed\r\n"
           "BEGIN:VEVENT\r\nUID:one\r\nSUMMARY;X-P=" + "p" * big + ":Long parameter\r\n"
           'DTSTART;X-P="' + "q:;" * (big // 3) + '";TZID="America/Chicago":20250115T180000\r\n'
           "DESCRIPTION:" + "d" * big + "\r\n" + "X-A;" * 5 + "\r\n" + "LOCATION" + ";A=b" * (big // 4) + ":Far\r\nEND:VEVENT\r\n"
           "BEGIN:VEVENT\r\nUID:two\r\nDTEND;X-TZID=Europe/Berlin:20250115T180000\r\nEND:VEVENT\r\n" + "BEGIN:VEVENT\r\n" * 20000)
    df = spark.createDataFrame([("l.ics", None, cal)], "source_ics string, source_page string, content string")
    rows = {r.uid: r for r in C.parse_vevents(df).collect()}
    assert set(rows) == {"one", "two"}
    one, two = rows["one"], rows["two"]
    assert (one.title, one.start, one.location, len(one.description)) == ("Long parameter", "2025-01-15T18:00:00-06:00", "Far", big)
    assert two.end == "2025-01-15T18:00:00"  # another parameter whose name ends alike is no zone
