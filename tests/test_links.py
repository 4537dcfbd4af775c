"""Calendar-link resolution."""
from pyspark.sql import functions as F

from eventflow.operators import extract as C

BASE = "https://calendar.example.org"

DETAIL = BASE + "/events/details/"


def resolve(spark, rows):
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    return {r.page_id: r.ics_url for r in C.resolve_ics_url(df).collect()}


def test_caption_slug_and_nothing(spark):
    rows = [
        (1, DETAIL + "harbour-walk-7", '<div><p>When: noon</p><a class="b" href="/files/walk.ics">Add to Calendar - iCal</a></div>'),
        (2, DETAIL + "choir-evening-31", "<main><h1>Choir</h1>no file</main>"),
        (3, BASE + "/about-us", "<main>no file</main>"),
    ]
    got = resolve(spark, rows)
    assert got == {1: BASE + "/files/walk.ics", 2: BASE + "/events/ical/choir-evening-31.ics", 3: None}


def test_html_edges(spark):
    rows = [
        # .ics anchor without the caption -> generic link
        (1, DETAIL + "a-1", '<a href="/x/other.ics">download</a>'),
        # single quotes, attributes before href, caption with extra spaces and case
        (2, DETAIL + "b-2", "<A class='btn' id=x HREF='/cal/b.ics?x=1&amp;y=2'>add to calendar  -  ical</A>"),
        # caption link wins over an earlier generic .ics link
        (3, DETAIL + "c-3", '<a href="/first.ics">f</a> <a title="t" href="/cap">Add to Calendar - iCal</a>'),
        # upper-case suffix is not a .ics link -> slug fallback
        (4, DETAIL + "d-4", '<a href="/x/OTHER.ICS">download</a>'),
        # absolute link kept as is
        (5, DETAIL + "e-5", '<a href="https://cdn.example.org/e.ics">x</a>'),
    ]
    got = resolve(spark, rows)
    assert got[1] == BASE + "/x/other.ics"
    assert got[2] == BASE + "/cal/b.ics?x=1&y=2"
    assert got[3] == BASE + "/cap"
    assert got[4] == BASE + "/events/ical/d-4.ics"
    assert got[5] == "https://cdn.example.org/e.ics"


def test_links_dedupe_and_order(spark):
    html = ('<a href="/events/details/x-1">1</a><a href="/about">a</a>'
            "<a class='c' href='/events/details/y-2'>2</a><a href=\"/events/details/x-1\">dup</a>"
            '<a href="https://other.example/events/details/z-3">3</a>')
    df = spark.createDataFrame([(7, BASE + "/events/calendar/2025-09-01", html)],
                               "page_id bigint, url string, html string")
    out = [(r.pos, r.link) for r in C.extract_event_links(df).orderBy("pos").collect()]
    assert out == [(0, BASE + "/events/details/x-1"), (1, BASE + "/events/details/y-2"),
                   (2, "https://other.example/events/details/z-3")]


def test_same_ics_from_two_pages(spark):
    html = '<a href="/events/ical/shared.ics">Add to Calendar - iCal</a>'
    df = spark.createDataFrame([(2, DETAIL + "p-2", html), (1, DETAIL + "p-1", html), (3, DETAIL + "p-3", "")],
                               "page_id bigint, url string, html string")
    res = C.resolve_ics_url(df)
    d = C.dedupe_ics(res).collect()
    assert len(d) == 2
    shared = [r for r in d if r.ics_url.endswith("shared.ics")][0]
    assert shared.first_page == 1 and shared.source_page == DETAIL + "p-1"
    n, msgs = C.extraction_errors(res)
    assert n.first().n_errors == 0


def test_month_frame():
    assert C.month_frame(2025, 9) == [(2025, 9), (2025, 10)]
    assert C.month_frame(2025, 12) == [(2025, 12)]
    assert C.month_frame(2025, 12, roll_year=True) == [(2025, 12), (2026, 1)]


def test_month_window_pushdown(spark):
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    w = C.month_window(o, "o_orderdate", 1997, 5)
    plan = w._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "o_orderdate" in plan
    months = {r.frame_month for r in w.select("frame_month").distinct().collect()}
    assert months <= {"1997-05", "1997-06"}
    assert w.where(F.col("frame_month") == "1997-05").count() == o.where(
        (F.col("o_orderdate") >= "1997-05-01") & (F.col("o_orderdate") < "1997-06-01")).count()


def test_unquoted_and_data_href(spark):
    rows = [
        (1, DETAIL + "u-1", "<a href=/events/ical/u-1.ics>Add to Calendar - iCal</a>"),
        (2, DETAIL + "v-2", '<a data-href="/wrong.ics" href=/right.ics>x</a>'),
        (3, DETAIL + "w-3", '<a href="">Add to Calendar - iCal</a>'),
    ]
    got = resolve(spark, rows)
    assert got[1] == BASE + "/events/ical/u-1.ics"
    assert got[2] == BASE + "/right.ics"
    assert got[3] == BASE + "/events/ical/w-3.ics"   # empty href is no link
    df = spark.createDataFrame([(9, BASE, '<a href=/events/details/a-1>1</a><a data-href="/events/details/no">n</a>')],
                               "page_id bigint, url string, html string")
    assert [r.link for r in C.extract_event_links(df).collect()] == [BASE + "/events/details/a-1"]


def test_hidden_and_quoted_markup(spark):
    rows = [
        (1, DETAIL + "m-1", '<!-- <a href="/old.ics">Add to Calendar - iCal</a> --><a href="/new.ics">file</a>'),
        (2, DETAIL + "n-2", '<a title="a > b" href="/n.ics">file</a>'),
        (3, DETAIL + "o-3", '<a href="/o"><span> Add to Calendar - iCal </span></a>'),
        (4, DETAIL + "p-4", '<script>var x = \'<a href="/s.ics">\';</script><style>a</style>'),
        (5, BASE + "/events/details/q/r-5", '<a href="../cal/./c.ics?x=../y">Add to Calendar - iCal</a>'),
        (6, DETAIL + "s-6", '<a href="&#x2F;caf&eacute;&amp;lt;&#46;ics">Add to Calendar - iCal</a>'),
    ]
    got = resolve(spark, rows)
    assert got == {1: BASE + "/new.ics", 2: BASE + "/n.ics", 3: BASE + "/o", 4: BASE + "/events/ical/p-4.ics",
                   5: BASE + "/cal/c.ics?x=../y", 6: BASE + "/café&lt;.ics"}


def test_join_of_relative_links(spark):
    from eventflow.functions.html import url_join
    base = "https://h.example/a/b/page?q=1"
    want = {"c.ics": "https://h.example/a/b/c.ics", "../c.ics": "https://h.example/a/c.ics", "../../../c": "https://h.example/c",
            "./": "https://h.example/a/b/", "..": "https://h.example/a/", "/x/../y": "https://h.example/y", "?z": "https://h.example/a/b/page?z",
            "//o.example/p": "https://o.example/p", "mailto:x@y": "mailto:x@y", "a..b/c": "https://h.example/a/b/a..b/c"}
    df = spark.createDataFrame([(h,) for h in want], "h string").select("h", url_join(base, "h").alias("u"))
    assert {r.h: r.u for r in df.collect()} == want


def test_error_messages(spark):
    df = spark.createDataFrame([(1, BASE + "/x", ""), (2, DETAIL + "y-1", "")], "page_id bigint, url string, html string")
    n, msgs = C.extraction_errors(C.resolve_ics_url(df))
    assert n.first().n_errors == 1 and msgs.first().message.endswith(BASE + "/x")


def test_long_tags_and_stray_markup(spark):
    """A megabyte in one tag, in prose after a stray tag, in a caption: constant stack, one pass."""
    big = 1 << 20
    link = '<a href="/right.ics">file</a>'
    rows = [
        (1, DETAIL + "a-1", "<a " + "x" * big + ' href="/long.ics">file</a>'),
        (2, DETAIL + "b-2", "<a " + 'data-x="1" ' * (big // 11) + "href='/many.ics'>Add to Calendar - iCal</a>"),
        (3, DETAIL + "c-3", "<p>if a <a and then " + "plain prose, don't stop. " * (big // 25) + "</p>" + link),
        (4, DETAIL + "d-4", "<a title='" + "y > " * (big // 4) + "' href=/quoted.ics>file</a>"),
        (5, DETAIL + "e-5", '<a href="/open.ics' + "z" * big),  # neither the quote nor the tag ends
        (6, DETAIL + "f-6", '<a href="/deep">' + "<b>" * (big // 7) + "Add to Calendar - iCal" + "</b>" * (big // 7) + "</a>"),
        (7, DETAIL + "g-7", "<a " * (big // 3) + link),
        (8, DETAIL + "h-8", "<!--" + "<a href='/x.ics'>" * (big // 20) + "-->" + link),
        (9, DETAIL + "i-9", '<a href="/s">' + " " * big + "Add to Calendar -" + " " * 1000 + "iCal</a>"),
    ]
    got = resolve(spark, rows)
    assert got[1] == BASE + "/long.ics" and got[2] == BASE + "/many.ics" and got[4] == BASE + "/quoted.ics"
    # the stray tag runs to the first ">", as a browser reads it; the next anchor is found
    assert got[3] == got[7] == got[8] == BASE + "/right.ics"
    assert got[5] == BASE + "/events/ical/e-5.ics" and got[6] == BASE + "/deep" and got[9] == BASE + "/s"


def test_attributes_as_a_browser_reads_them(spark):
    rows = [
        (1, DETAIL + "a-1", '<a title="it\'s" class=x"y href="/one.ics">f</a>'),
        (2, DETAIL + "b-2", '<a title = "x"href=/two.ics>f</a>'),
        (3, DETAIL + "c-3", '<a href hreflang="/no.ics" HREF = \'/three.ics\'>f</a>'),
        (4, DETAIL + "d-4", '<area href="/no.ics"><abbr href="/no.ics"></abbr><a/href="/four.ics">f</a>'),
        (5, DETAIL + "e-5", '<a href="/first.ics" href="/second.ics">f</a>'),
        (6, DETAIL + "f-6", '<a name="top">Add to Calendar - iCal</a><a href="/cap">Add to Calendar - iCal</a><a href="/gen.ics">f</a>'),
        (7, DETAIL + "g-7", '<a href="/six">Add to Calendar - <b>iCal</b></a><a href="/seven.ics">f</a>'),
        (8, DETAIL + "h-8", None),
    ]
    got = resolve(spark, rows)
    assert [got[i] for i in range(1, 6)] == [BASE + x for x in ("/one.ics", "/two.ics", "/three.ics", "/four.ics", "/first.ics")]
    assert got[6] == BASE + "/gen.ics"  # only the first captioned anchor counts, and it has no href
    assert got[7] == BASE + "/seven.ics" and got[8] == BASE + "/events/ical/h-8.ics"


def test_page_is_scanned_once(spark):
    import time
    df = spark.createDataFrame([(1, DETAIL + "a-1", "")], "page_id bigint, url string, html string")
    C.resolve_ics_url(df)
    start = time.time()
    out = C.resolve_ics_url(df).where("ics_url is not null")
    plan = out._jdf.queryExecution().executedPlan().toString()
    print("built in", time.time() - start)
    print(len(plan), plan.count("regexp_extract"))
    assert plan.count("regexp_extract") < 30 and plan.count("regexp_extract_all") <= 2
    assert time.time() - start < 5
