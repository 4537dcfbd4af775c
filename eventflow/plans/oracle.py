"""DuckDB SQL oracles for the driver-table queries (same names, same columns).

Each statement computes the expected result from the original table columns
with plain SQL; only fixed value lists (keywords, meta keys) are shared with
the Spark code.
"""

from __future__ import annotations

from ..functions.text import COMMUNITY_KEYWORDS, NON_COMMUNITY_KEYWORDS


def q(s: str) -> str:
    return s.replace("'", "''")

from ..operators.publish import META_KEYS

# Unicode White_Space as one RE2 class (Java's (?U)\s)
WS = r"[\s\x{0B}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
# anchors of the given pages, which hold double-quoted attributes only
ANCHOR = r"""(?is)<a\s[^>]*?href="([^"]*)\""""
ORIGIN = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)"
PATH = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)"
TOKEN = r"[\p{L}\p{N}_]{2,}"




def strip_ws(x):
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def norm_url(x):
    return f"regexp_replace(regexp_replace({strip_ws(f'coalesce({x}, {chr(39)}{chr(39)})')}, '[?#].*$', ''), '/+$', '')"


def norm_str(x):
    return (f"regexp_replace(trim(regexp_replace(lower(coalesce({x}, '')), '{WS}+', ' ', 'g')), "
            f"'[^a-z0-9 ]+', '', 'g')")


def unescape(x):
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&#x27;", "''"),
                    ("&amp;", "&")):
        x = f"replace({x}, '{ent}', '{ch}')"
    return x


def url_join(base, href):
    scheme = f"regexp_extract({base}, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)"
    return (f"CASE WHEN {href} IS NULL THEN NULL "
            f"WHEN regexp_matches({href}, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN {href} "
            f"WHEN starts_with({href}, '//') THEN {scheme} || ':' || {href} "
            f"WHEN starts_with({href}, '/') THEN regexp_extract({base}, '{ORIGIN}', 1) || {href} "
            f"WHEN {href} = '' THEN {base} "
            f"WHEN starts_with({href}, '?') THEN regexp_replace({base}, '[?#].*$', '') || {href} "
            f"WHEN starts_with({href}, '#') THEN regexp_replace({base}, '#.*$', '') || {href} "
            f"WHEN {base} = '' THEN {href} "
            f"ELSE {base} || '/' || {href} END")


def sanitize(x):
    x = f"regexp_replace({x}, '(?is)<script[^>]*?>.*?</script>', '', 'g')"
    x = f"regexp_replace({x}, '(?is)<style[^>]*?>.*?</style>', '', 'g')"
    x = f"regexp_replace({x}, '(?s)<[^>]*>', '', 'g')"
    x = f"regexp_replace({x}, '%[a-fA-F0-9]{{2}}', '', 'g')"
    return f"trim(regexp_replace({x}, '[\\r\\n\\t ]+', ' ', 'g'))"


def epoch(x):
    return f"(epoch_us({x}) // 1000000)"


DL = """dl AS (SELECT d.doc_id, d.lang, d.source, d.n_chars, d.text, l.quality AS label,
  d.lang || '|' || d.source AS series_id, split_part(d.text, chr(10), 1) AS title
  FROM documents d LEFT JOIN labels l USING (doc_id))"""
ES = """es AS (SELECT event_id, ts, event_type, value, user_id, props,
  CAST(user_id AS VARCHAR) || '|' || CAST(CAST(ts AS DATE) AS VARCHAR) AS series_id FROM events)"""
CONF = "(value - floor(value))"
PRED = "CAST(event_type IN ('purchase', 'signup', 'view') AS INTEGER)"


def majority(src, out="maj", extra=""):
    return f"""c AS (SELECT series_id, label, count(*) AS n FROM {src}
  WHERE label IS NOT NULL AND series_id IS NOT NULL AND series_id <> '|' {extra} GROUP BY ALL),
m AS (SELECT series_id, label AS {out} FROM (SELECT *, row_number() OVER
  (PARTITION BY series_id ORDER BY n DESC, label) AS rn FROM c) WHERE rn = 1)"""


def tfidf(text_expr, pruned):
    vocab = ("SELECT * FROM st WHERE df >= 2 AND df <= 0.9 * (SELECT n FROM nd)" if pruned
             else "SELECT * FROM st ORDER BY cf DESC, term LIMIT 500")
    tfw = "(1 + ln(tc.tf))" if pruned else "tc.tf"
    return f"""WITH t AS (SELECT doc_id, regexp_extract_all({text_expr}, '{TOKEN}') AS t FROM documents),
toks AS (SELECT doc_id, unnest(t) AS term, generate_subscripts(t, 1) AS pos FROM t),
terms AS (SELECT doc_id, term FROM toks UNION ALL
  SELECT doc_id, nxt FROM (SELECT doc_id, term || ' ' || lead(term) OVER (PARTITION BY doc_id ORDER BY pos) AS nxt
  FROM toks) WHERE nxt IS NOT NULL),
tc AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
st AS (SELECT term, count(*) AS df, sum(tf) AS cf FROM tc GROUP BY term),
nd AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM documents),
v AS ({vocab}),
w AS (SELECT tc.doc_id, tc.term, tc.tf, {tfw} * (ln((1 + nd.n) / (1 + v.df)) + 1) AS raw FROM tc JOIN v USING (term), nd)
SELECT doc_id, term, tf, round(CASE WHEN sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) > 0
  THEN raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) ELSE 0 END, 6) AS weight FROM w"""


def given_scores():
    """Scores by a model given by rule: cosine-normalised weights times coefficients, and the numeric part."""
    text = "strip_accents(lower(coalesce(split_part(text, chr(10), 1), '') || ' ' || coalesce(text, '')))"
    ctes = tfidf(text, pruned=True).split("\nSELECT doc_id, term, tf")[0]
    return ctes + f""",
x AS (SELECT doc_id, sum(raw * ((ascii(term) * 31 + length(term)) % 21 - 10) / 10.0) / sqrt(sum(raw * raw)) AS dot FROM w GROUP BY doc_id),
{DL}, f AS (SELECT *, TIMESTAMP '2024-01-01' + to_seconds(doc_id * 5003) AS starts, CASE doc_id % 5 WHEN 0 THEN 0.5 WHEN 1 THEN -0.4 WHEN 2 THEN 0.7 ELSE 0 END AS place FROM dl),
g AS (SELECT f.*, coalesce(x.dot, 0) - 2.0 + place + 0.2 * 0.3 * CASE WHEN f.doc_id % 6 = 0 THEN -1 ELSE hour(starts) END
  - 0.5 * CASE WHEN f.doc_id % 6 <> 0 AND isodow(starts) IN (6, 7) THEN 1 ELSE 0 END AS score FROM f LEFT JOIN x USING (doc_id)),
s AS (SELECT *, CAST(score > 0 AS INTEGER) AS pred, 1 / (1 + abs(score)) AS mconf,
  greatest(1 / (1 + exp(-(1.3 * score - 0.2))), 1 - 1 / (1 + exp(-(1.3 * score - 0.2)))) AS conf FROM g)"""


PLATT = """WITH RECURSIVE m AS (SELECT (n_chars % 1000 - 500) / 250.0 + (quality - 0.5) AS s, quality AS y FROM documents JOIN labels USING (doc_id)
  WHERE quality IN (0, 1)),
c AS (SELECT count(*) FILTER (WHERE y = 1) AS p, count(*) FILTER (WHERE y = 0) AS n FROM m),
t AS (SELECT CAST(s AS DOUBLE) AS s, CASE WHEN y = 1 THEN (p + 1.0) / (p + 2.0) ELSE 1.0 / (n + 2.0) END AS t FROM m, c),
it(i, a, b) AS (SELECT 0, CAST(0 AS DOUBLE), CAST(ln((p + 1.0) / (n + 1.0)) AS DOUBLE) FROM c
  UNION ALL SELECT i + 1, a - (hbb * ga - hab * gb) / (haa * hbb - hab * hab), b - (haa * gb - hab * ga) / (haa * hbb - hab * hab) FROM
  (SELECT i, a, b, sum((p - t) * s) AS ga, sum(p - t) AS gb, sum(p * (1 - p) * s * s) AS haa, sum(p * (1 - p) * s) AS hab, sum(p * (1 - p)) AS hbb
   FROM (SELECT i, a, b, s, t, 1 / (1 + exp(-(a * s + b))) AS p FROM it, t WHERE i < 25) GROUP BY i, a, b))
SELECT round(a, 6) AS a, round(b, 6) AS b, true AS converged FROM it WHERE i = 25"""


def review_base():
    return f"""SELECT event_id, event_type AS title, strftime(ts, '%b %d, %Y %I:%M %p') AS start_text,
  coalesce(CASE WHEN event_type = 'view' THEN NULL ELSE 'user ' || CAST(user_id AS VARCHAR) END, 'N/A') AS location_text"""


def resolved():
    """From the construction of the pages: what each kind must resolve to."""
    return """k AS (SELECT page_id, page_id % 4 AS kind, url, regexp_extract(url, '^[a-z]+://[^/?#]+') AS origin FROM pages),
r0 AS (SELECT *, split_part(regexp_replace(substr(url, length(origin) + 1), '[?#].*$', ''), '/', 3) AS name FROM k),
r AS (SELECT page_id, CASE WHEN kind = 3 THEN origin || '/none' ELSE url END AS url,
  CASE kind WHEN 0 THEN origin || '/files/cal' || page_id WHEN 1 THEN origin || '/f' || page_id || '.ics'
    WHEN 2 THEN CASE WHEN name <> '' THEN origin || '/events/ical/' || name || '.ics' END END AS ics_url,
  CASE kind WHEN 0 THEN 'caption' WHEN 1 THEN 'suffix' WHEN 2 THEN CASE WHEN name <> '' THEN 'slug' END END AS ics_method
  FROM r0)"""


def vevents():
    def one(suffix, pos, cond):
        return f"""SELECT 'order-' || o_orderkey || '{suffix}@shop' AS uid, 'Order ' || o_orderkey || ', ' || o_orderpriority AS title,
  'Total ' || printf('%.2f', o_totalprice) || '; customer ' || o_custkey || ', priority ' || o_orderpriority || chr(10)
    || 'status ' || o_orderstatus || ' of a long order description line' AS description,
  'Customer ' || o_custkey AS location,
  CASE WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y-%m-%d')
       ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '+00:00' END AS start,
  strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%S') AS "end",
  'https://shop.example.com/orders/' || o_orderkey AS url, o_orderstatus || ';' || o_orderpriority AS category_text,
  'orders/' || o_orderkey || '.ics' AS source_ics, {pos} AS vevent_pos FROM orders WHERE {cond}"""
    return one("", 0, "o_orderstatus IN ('O', 'F')") + "\nUNION ALL\n" + one("-ship", 1, "o_orderstatus = 'F'")


def calendar_meta():
    start_epoch = f"CASE WHEN event_type = 'error' THEN {epoch('ts')} - 18000 ELSE {epoch('ts')} END"
    end_ts = "ts + INTERVAL 90 MINUTE"
    has_end = "event_type IN ('purchase', 'error')"
    vals = {
        "evcal_srow": f"CAST({start_epoch} AS VARCHAR)",
        "evcal_start_date": "strftime(ts, '%Y-%m-%d')",
        "evcal_start_time_hour": "strftime(ts, '%I')",
        "evcal_start_time_min": "strftime(ts, '%M')",
        "evcal_start_time_ampm": "lower(strftime(ts, '%p'))",
        "evcal_erow": f"CASE WHEN {has_end} THEN CAST({epoch(end_ts)} AS VARCHAR) END",
        "evcal_end_date": f"CASE WHEN {has_end} THEN strftime({end_ts}, '%Y-%m-%d') END",
        "evcal_end_time_hour": f"CASE WHEN {has_end} THEN strftime({end_ts}, '%I') END",
        "evcal_end_time_min": f"CASE WHEN {has_end} THEN strftime({end_ts}, '%M') END",
        "evcal_end_time_ampm": f"CASE WHEN {has_end} THEN lower(strftime({end_ts}, '%p')) END",
        "evcal_lmlink": "CASE WHEN event_type = 'signup' THEN 'https://cal.example.com/e/' || event_id END",
    }
    cols = ", ".join(f"{vals.get(k, 'CAST(NULL AS VARCHAR)')} AS {k}" for k in META_KEYS)
    return f"SELECT event_id, {cols} FROM events"


def meta_entries():
    sub = sanitize("'<b>' || event_type || '</b>' || chr(10) || '  ' || props || ' %41' || chr(9) || 'end'")
    rows = [("evcal_srow", f"CAST({epoch('ts')} AS VARCHAR)"), ("evo_hide_endtime", "'no'"),
            ("event_type", sanitize("event_type")),
            ("_featured", "CASE WHEN value > 40 THEN 'yes' ELSE 'no' END"),
            ("_evcal_exlink_option", "'1'"), ("evcal_subtitle", sub)]
    return "\nUNION ALL\n".join(f"SELECT event_id, '{k}' AS key, {v} AS value FROM events" for k, v in rows)


LATEST = "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderkey DESC LIMIT 100"
UPCOMING = (f"SELECT count(*) FILTER (WHERE {epoch('o_orderdate')} >= {epoch(chr(39) + '1998-01-01' + chr(39) + '::TIMESTAMP')}) "
            "AS upcoming FROM orders WHERE o_orderstatus = 'F'")
MARKUP = "(contains(lower(html), 'track(1') OR contains(lower(html), '<table'))"


def _sql() -> dict:
    d = {}
    d["flatten_category"] = """SELECT p_partkey, concat_ws(';', NULLIF(p_brand, ''),
  CASE WHEN p_size > 25 THEN NULL ELSE NULLIF(p_type, '') END) AS category_text FROM part"""
    d["canonicalize"] = """SELECT CAST(doc_id AS VARCHAR) AS event_id, split_part(text, chr(10), 1) AS title,
  text AS description, '' AS url, lang AS location, '' AS start_time, '' AS end_time, '' AS cost_text,
  '' AS tags, source FROM documents"""
    d["ensure_event_id"] = """SELECT url AS event_id, regexp_extract(html, '<title>(.*?)</title>', 1) AS title,
  url, url AS source FROM pages"""
    lt = "lower(coalesce(split_part(text, chr(10), 1), '') || ' ' || coalesce(text, ''))"
    d["labelset"] = f"""SELECT CAST(doc_id AS VARCHAR) AS event_id,
  CASE WHEN regexp_matches({lt}, '{q(NON_COMMUNITY_KEYWORDS)}') THEN 0
       WHEN regexp_matches({lt}, '{q(COMMUNITY_KEYWORDS)}') THEN 1 END AS weak_label, '' AS label FROM documents"""
    d["four_field_text"] = """SELECT event_id, concat_ws(' ', event_type, props,
  CASE WHEN event_type = 'view' THEN NULL ELSE 'user ' || CAST(user_id AS VARCHAR) END,
  CASE WHEN event_type = 'click' THEN NULL WHEN event_type = 'error' THEN ''
       ELSE 'cat' || CAST(user_id AS VARCHAR) END) AS text FROM events"""
    d["review_rows"] = review_base() + f""",
  printf('%.1f', {CONF} * 100) || '%' AS confidence_text,
  CASE WHEN {CONF} < 0.75 THEN 'Review Needed' ELSE 'High Confidence' END AS status,
  CASE WHEN {CONF} >= 0.75 THEN 'high-confidence' ELSE 'low-confidence' END AS confidence_class,
  CASE WHEN {CONF} < 0.75 THEN 'review-needed' ELSE '' END AS row_class FROM events"""
    d["published_rows"] = review_base() + ", '0.0%' AS confidence_text FROM events"
    pt = "lower(coalesce(p_name, '') || ' ' || coalesce(p_type, ''))"
    d["weak_label"] = f"""SELECT p_partkey, CASE WHEN regexp_matches({pt}, 'small') THEN 0
  WHEN regexp_matches({pt}, 'ring|widget') THEN 1 END AS weak_label FROM part"""
    fill = strip_ws("regexp_replace(label_raw, '\\.0', '')")
    d["parse_label"] = f"""WITH s AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN CAST(quality AS VARCHAR) || '.0'
  WHEN 1 THEN CAST(quality AS VARCHAR) WHEN 2 THEN ' ' || CAST(quality AS VARCHAR) ELSE 'x' END AS label_raw FROM labels)
SELECT doc_id, label_raw,
  CASE WHEN {fill} IN ('0', '1') THEN CAST({fill} AS INTEGER) END AS label_fill,
  CASE WHEN regexp_replace(label_raw, '\\.0', '') IN ('0', '1') THEN CAST(regexp_replace(label_raw, '\\.0', '') AS INTEGER) END AS label_mask,
  CASE WHEN replace(label_raw, '.0', '') IN ('0', '1') THEN CAST(replace(label_raw, '.0', '') AS INTEGER) END AS label_all_dot0,
  CASE WHEN label_raw IN ('0', '1') THEN CAST(label_raw AS INTEGER) END AS label_strict FROM s"""
    d["norm_url_series"] = f"""WITH b AS (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN CAST(page_id AS VARCHAR) END AS uid,
  CASE WHEN page_id % 5 = 0 THEN '' ELSE url END AS url,
  regexp_extract(html, '<title>(.*?)</title>', 1) AS title,
  regexp_extract(html, '<html lang="([^"]*)"', 1) AS location FROM pages),
n AS (SELECT page_id, {strip_ws("coalesce(uid, '')")} AS uid_s, {norm_url('url')} AS url_norm,
  {norm_str('title')} AS title_norm, {norm_str('location')} AS loc_norm FROM b)
SELECT page_id, url_norm, title_norm, CASE WHEN uid_s <> '' THEN uid_s WHEN url_norm <> '' THEN url_norm
  ELSE title_norm || '|' || loc_norm END AS series_id FROM n"""
    d["extract_series_id"] = """SELECT page_id, TRY_CAST(NULLIF(regexp_extract(url, 'page=(\\d+)', 1), '') AS BIGINT)
  AS series_id FROM pages"""
    vf = {"venue_library": r"\bring\b", "venue_park": r"\bwidget\b", "venue_church": r"\bbolt\b",
          "venue_museum": r"\bgear\b|gizmo"}
    d["venue_flags"] = "SELECT p_partkey, " + ", ".join(
        f"CAST(regexp_matches(lower(coalesce(p_name, '')), '{rx}') AS INTEGER) AS {n}" for n, rx in vf.items()) + " FROM part"
    mc = "(1.0::DOUBLE / (1.0::DOUBLE + abs(score)))"
    d["margin_confidence"] = f"""WITH s AS (SELECT event_id, (value - 20.0::DOUBLE) / 10.0::DOUBLE AS score FROM events)
SELECT event_id, CAST(score > 0 AS INTEGER) AS predicted_label, round({mc}, 6) AS confidence,
  {mc} < 0.55 AS needs_review, CASE WHEN NOT ({mc} < 0.55) THEN CAST(score > 0 AS INTEGER) END AS label FROM s"""
    d["flagged"] = f"""SELECT event_id, event_type AS title, {PRED} AS predicted_label, round({CONF}, 6) AS confidence
  FROM events WHERE {CONF} < 0.75 ORDER BY event_id LIMIT 20"""
    d["labeled_only"] = f"WITH {DL} SELECT doc_id, label FROM dl WHERE label IS NOT NULL"
    d["unlabeled_only"] = f"WITH {DL} SELECT doc_id, series_id FROM dl WHERE label IS NULL"
    tl = f"""WITH {ES}, b AS (SELECT event_id, series_id, CASE WHEN event_type = 'purchase' THEN '1'
  WHEN event_type = 'signup' THEN '1.0' WHEN event_type = 'error' THEN '0' END AS label FROM es)"""
    d["propagate_unanimous"] = tl + f""",
s AS (SELECT series_id, min(v) AS mn, max(v) AS mx FROM (SELECT series_id, {strip_ws("regexp_replace(label, '\\.0', '')")} AS v
  FROM b WHERE series_id <> '|') WHERE v IN ('0', '1') GROUP BY series_id)
SELECT b.event_id, b.series_id, CASE WHEN s.mn = s.mx AND coalesce(regexp_replace(b.label, '\\.0', '') NOT IN ('0', '1'), true)
  THEN s.mn ELSE b.label END AS label FROM b LEFT JOIN s USING (series_id)"""
    d["propagate_unanimous_strict"] = tl + """,
s AS (SELECT series_id, min(label) AS mn, max(label) AS mx FROM b WHERE label IN ('0', '1') AND series_id <> '|' GROUP BY series_id)
SELECT b.event_id, b.series_id, CASE WHEN s.mn = s.mx AND coalesce(b.label NOT IN ('0', '1'), true)
  THEN s.mn ELSE b.label END AS label FROM b LEFT JOIN s USING (series_id)"""
    il = f"""WITH {ES}, b AS (SELECT event_id, series_id, CASE WHEN event_type IN ('purchase', 'signup') THEN 1
  WHEN event_type = 'error' THEN 0 END AS label,
  CASE WHEN event_type = 'purchase' THEN 'manual_or_previous' END AS label_source FROM es)"""
    d["propagate_majority_overwrite"] = il + ", " + majority("b") + """
SELECT b.event_id, coalesce(m.maj, b.label) AS label,
  CASE WHEN m.maj IS NOT NULL THEN 'series_propagation' ELSE b.label_source END AS label_source
  FROM b LEFT JOIN m USING (series_id)"""
    d["propagate_majority_fill"] = il + ", " + majority("b", extra="AND series_id <> ''") + """
SELECT b.event_id, coalesce(b.label, m.maj) AS label FROM b LEFT JOIN m USING (series_id)"""
    d["coverage"] = f"WITH {DL}, " + majority("dl", extra="AND series_id <> ''") + """,
f AS (SELECT dl.label AS before, coalesce(dl.label, m.maj) AS after FROM dl LEFT JOIN m USING (series_id))
SELECT count(*) AS total, count(before) AS labeled_before, count(after) AS labeled_after,
  count(after) - count(before) AS filled, count(*) - count(after) AS remaining FROM f"""
    d["merge_manual_predicted"] = f"""WITH {DL} SELECT doc_id, coalesce(label, CAST(n_chars > 1000 AS INTEGER))
  AS final_label FROM dl"""
    sets = f"""WITH {DL}, d AS (SELECT *, NULLIF(split_part(text, ' ', 1), '') AS uid FROM dl),
ex AS (SELECT doc_id, uid, label, 'manual_or_previous' AS label_source, 0 AS side FROM d WHERE lang IN ('en', 'de')),
nw AS (SELECT doc_id, uid, CAST(n_chars > 1000 AS INTEGER) AS label,
  CASE WHEN n_chars > 5000 THEN 'series_propagation' ELSE 'model_prediction' END AS label_source, 1 AS side
  FROM d WHERE lang IN ('en', 'fr', 'es')),
u AS (SELECT * FROM ex UNION ALL SELECT * FROM nw)"""
    d["merge_by_priority"] = sets + """,
r AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY label_source IS NULL, label_source, side, doc_id) AS rn
  FROM u WHERE uid IS NOT NULL)
SELECT doc_id, uid, label, label_source FROM r WHERE rn = 1
UNION ALL SELECT doc_id, uid, label, label_source FROM u WHERE uid IS NULL"""
    d["merge_first_wins"] = sets + """,
r AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY side, doc_id) AS rn FROM u WHERE uid IS NOT NULL)
SELECT doc_id, uid, CASE WHEN side = 0 THEN 'existing' ELSE 'new' END AS origin FROM r WHERE rn = 1
UNION ALL SELECT doc_id, uid, CASE WHEN side = 0 THEN 'existing' ELSE 'new' END FROM u WHERE uid IS NULL"""
    d["collapse_series"] = f"""WITH {DL} SELECT series_id, doc_id, CAST(length(text) AS INTEGER) AS desc_len FROM
  (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY coalesce(length(text), 0) DESC, doc_id) AS rn FROM dl)
  WHERE rn = 1"""
    d["distinct_series_sample"] = f"""WITH {DL} SELECT title, series_id FROM (SELECT series_id,
  arg_min(title, doc_id) AS title, min(doc_id) AS first FROM dl GROUP BY series_id) ORDER BY first, series_id LIMIT 10"""
    d["valid_series_head"] = f"""WITH {DL} SELECT doc_id, series_id, label FROM dl
  WHERE lang NOT IN ('de', 'fr') ORDER BY doc_id LIMIT 25"""
    d["value_counts"] = f"WITH {DL} SELECT label, count(*) AS n FROM dl GROUP BY label"
    d["series_summary"] = f"""WITH {DL}, g AS (SELECT series_id,
  count(*) FILTER (WHERE regexp_replace(CAST(label AS VARCHAR), '\\.0', '') IN ('0', '1')) AS labeled_count,
  arg_min(title, doc_id) AS title FROM dl GROUP BY series_id)
SELECT series_id, labeled_count, title FROM g WHERE labeled_count > 0 ORDER BY labeled_count DESC, series_id LIMIT 15"""
    d["unlabeled_series"] = f"""WITH {DL} SELECT series_id, arg_min(title, doc_id) AS title FROM dl
  WHERE label IS NULL AND series_id IS NOT NULL GROUP BY series_id ORDER BY series_id LIMIT 10"""
    d["batch_stats"] = f"""SELECT count(*) AS total_events, count(*) FILTER (WHERE {PRED} = 1) AS community_events,
  count(*) FILTER (WHERE {PRED} <> 1) AS non_community_events,
  count(*) FILTER (WHERE {PRED} = 1 AND {CONF} < 0.75) AS needs_review FROM events"""
    d["prediction_counts"] = f"""SELECT count(*) FILTER (WHERE {PRED} = 1) AS positives,
  count(*) FILTER (WHERE {PRED} = 0) AS negatives FROM events"""
    d["confidence_breakdown"] = f"""SELECT count(*) FILTER (WHERE NOT ({CONF} < 0.55)) AS high_confidence,
  count(*) FILTER (WHERE {CONF} < 0.55) AS needs_review FROM events"""
    d["train_guards"] = f"""WITH {DL}, a AS (SELECT count(*) AS labeled, count(DISTINCT series_id) AS n_series,
  count(DISTINCT label) AS n_classes FROM dl WHERE label IS NOT NULL)
SELECT *, n_series >= 3 AND n_classes >= 2 AS can_group_split, labeled >= 5 AS can_first_model,
  labeled >= 10 AS can_final_model, labeled >= 20 AS can_holdout FROM a"""
    d["class_balance"] = """SELECT count(*) AS labeled, count(*) FILTER (WHERE quality = 1) AS positives,
  count(*) - count(*) FILTER (WHERE quality = 1) AS negatives FROM labels WHERE quality IN (0, 1)"""
    d["confusion_matrix"] = """SELECT quality AS truth, count(*) FILTER (WHERE 1 - toxic = 0) AS pred_0,
  count(*) FILTER (WHERE 1 - toxic = 1) AS pred_1 FROM labels WHERE quality IN (0, 1) GROUP BY quality"""
    per = []
    for c in (0, 1):
        per.append(f"""CASE WHEN pp{c} > 0 THEN tp{c} / pp{c} ELSE 0 END AS pr{c},
  CASE WHEN sup{c} > 0 THEN tp{c} / sup{c} ELSE 0 END AS rc{c}""")
    d["classification_report"] = f"""WITH s AS (SELECT quality AS t, 1 - toxic AS p FROM labels),
a AS (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (WHERE t = p) AS DOUBLE) AS correct,
  {", ".join(f"CAST(count(*) FILTER (WHERE t = {c} AND p = {c}) AS DOUBLE) AS tp{c}, CAST(count(*) FILTER (WHERE t = {c}) AS DOUBLE) AS sup{c}, CAST(count(*) FILTER (WHERE p = {c}) AS DOUBLE) AS pp{c}" for c in (0, 1))} FROM s),
b AS (SELECT *, {", ".join(per)} FROM a),
f AS (SELECT *, CASE WHEN pr0 + rc0 > 0 THEN 2 * pr0 * rc0 / (pr0 + rc0) ELSE 0 END AS f0,
  CASE WHEN pr1 + rc1 > 0 THEN 2 * pr1 * rc1 / (pr1 + rc1) ELSE 0 END AS f1 FROM b)
SELECT '0' AS cls, round(pr0, 6) AS precision, round(rc0, 6) AS recall, round(f0, 6) AS f1, CAST(sup0 AS BIGINT) AS support FROM f
UNION ALL SELECT '1', round(pr1, 6), round(rc1, 6), round(f1, 6), CAST(sup1 AS BIGINT) FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, round(CASE WHEN n > 0 THEN correct / n ELSE 0 END, 6), CAST(n AS BIGINT) FROM f
UNION ALL SELECT 'macro avg', round((pr0 + pr1) / 2, 6), round((rc0 + rc1) / 2, 6), round((f0 + f1) / 2, 6), CAST(n AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', round((pr0 * sup0 + pr1 * sup1) / n, 6), round((rc0 * sup0 + rc1 * sup1) / n, 6),
  round((f0 * sup0 + f1 * sup1) / n, 6), CAST(n AS BIGINT) FROM f"""
    d["accuracy"] = "SELECT round(avg(CAST(quality = 1 - toxic AS DOUBLE)), 6) AS accuracy FROM labels"
    d["time_features"] = """SELECT event_id,
  CAST(CASE WHEN event_type = 'purchase' THEN hour(ts) WHEN event_type = 'error' THEN hour(ts - INTERVAL 5 HOUR)
       WHEN event_type = 'view' THEN 0 ELSE -1 END AS INTEGER) AS hour,
  CASE WHEN event_type IN ('purchase', 'view') THEN CAST(isodow(ts) IN (6, 7) AS INTEGER)
       WHEN event_type = 'error' THEN CAST(isodow(ts - INTERVAL 5 HOUR) IN (6, 7) AS INTEGER) ELSE 0 END AS is_weekend
  FROM events"""
    d["tfidf_topk"] = tfidf("lower(text)", pruned=False)
    d["tfidf_pruned"] = tfidf("strip_accents(lower(text))", pruned=True)
    given = given_scores()
    d["linear_scores"] = given + " SELECT doc_id, round(score, 6) AS score, pred AS predicted_label, round(mconf, 6) AS prediction_confidence FROM s"
    d["classify_given"] = given + " SELECT doc_id, pred AS is_community_event, round(conf, 6) AS confidence, conf < 0.75 AS needs_review FROM s"
    d["smart_label_given"] = given + """ SELECT doc_id, CASE WHEN label IS NOT NULL THEN label WHEN NOT mconf < 0.55 THEN pred END AS label,
  CASE WHEN label IS NULL THEN pred END AS predicted_label, CASE WHEN label IS NULL THEN round(mconf, 6) END AS confidence,
  CASE WHEN label IS NULL THEN mconf < 0.55 END AS needs_review FROM s"""
    d["self_train_given"] = given + """, r1 AS (SELECT series_id, pred AS label, count(*) AS n FROM s WHERE series_id IS NOT NULL GROUP BY ALL),
m1 AS (SELECT series_id, label FROM r1 QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY n DESC, label) = 1),
u AS (SELECT s.doc_id, s.series_id, coalesce(s.label, m1.label, s.pred) AS label FROM s LEFT JOIN m1 USING (series_id)),
r2 AS (SELECT series_id, label, count(*) AS n FROM u WHERE series_id IS NOT NULL GROUP BY ALL),
m2 AS (SELECT series_id, label FROM r2 QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY n DESC, label) = 1)
SELECT u.doc_id, m2.label, 'series_propagation' AS label_source FROM u JOIN m2 USING (series_id)"""
    d["platt_calibration"] = PLATT
    d["scale_no_mean"] = """WITH s AS (SELECT stddev_pop(value) AS sv, stddev_pop(CAST(user_id AS DOUBLE)) AS su FROM events)
SELECT event_id, round(value / coalesce(CASE WHEN sv <> 0 THEN sv END, 1.0), 6) AS value_scaled,
  round(CAST(user_id AS DOUBLE) / coalesce(CASE WHEN su <> 0 THEN su END, 1.0), 6) AS user_id_scaled FROM events, s"""
    d["group_split"] = f"""WITH {DL}, s AS (SELECT DISTINCT series_id FROM dl WHERE series_id IS NOT NULL),
r AS (SELECT series_id, row_number() OVER (ORDER BY md5(series_id || '42'), series_id) AS gi, count(*) OVER () AS n FROM s),
t AS (SELECT series_id FROM r WHERE gi <= ceil(n * 0.2::DOUBLE))
SELECT CASE WHEN t.series_id IS NOT NULL THEN 'test' ELSE 'train' END AS split, count(DISTINCT dl.series_id) AS n_series,
  count(*) AS n_rows FROM dl LEFT JOIN t USING (series_id) GROUP BY 1"""
    d["stratified_split"] = """WITH l AS (SELECT doc_id, quality AS label FROM labels WHERE quality IS NOT NULL),
r AS (SELECT doc_id, label, row_number() OVER (PARTITION BY label ORDER BY md5(CAST(doc_id AS VARCHAR) || '42'), doc_id) AS ci,
  count(*) OVER (PARTITION BY label) AS nc, count(*) OVER () AS total FROM l)
SELECT CASE WHEN total < 20 THEN 'both' WHEN ci <= ceil(nc * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS split, label,
  count(*) AS n_rows FROM r GROUP BY ALL"""
    d["extract_links"] = f"""WITH a AS (SELECT page_id, origin, unnest(h) AS href, generate_subscripts(h, 1) AS i FROM
  (SELECT page_id, regexp_extract(url, '{ORIGIN}', 1) AS origin, regexp_extract_all(regexp_replace(html, '(?is)<!--.*?-->|<script.*?</script>|<style.*?</style>', '', 'g'), '{ANCHOR}', 1) AS h FROM pages)),
u AS (SELECT page_id, i, origin, {unescape('href')} AS href FROM a WHERE href <> ''),
f AS (SELECT page_id, i, {url_join('origin', 'href')} AS link FROM u WHERE contains(href, '/')),
g AS (SELECT page_id, link, min(i) AS first FROM f GROUP BY ALL)
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY first) - 1 AS INTEGER) AS pos, link FROM g"""
    d["resolve_ics"] = f"WITH {resolved()} SELECT page_id, ics_url, ics_method FROM r"
    d["dedupe_ics"] = f"""WITH {resolved()} SELECT ics_url, min(page_id) AS first_page, arg_min(url, page_id) AS source_page
  FROM r WHERE ics_url IS NOT NULL GROUP BY ics_url"""
    d["extraction_errors"] = f"""WITH {resolved()} SELECT page_id, 'no calendar file for page ' || url AS message,
  (SELECT count(*) FROM r WHERE ics_url IS NULL) AS n_errors FROM r WHERE ics_url IS NULL ORDER BY page_id LIMIT 5"""
    d["parse_vevents"] = vevents()
    d["calendar_quarantine"] = """SELECT CAST(o_orderkey AS VARCHAR) AS source_ics,
  CAST(CASE o_orderkey % 6 WHEN 0 THEN 1 WHEN 4 THEN 1 WHEN 5 THEN 2 ELSE 0 END AS BIGINT) AS n_events,
  CASE o_orderkey % 6 WHEN 1 THEN 'not valid UTF-8' WHEN 2 THEN 'no calendar' WHEN 3 THEN 'unreadable'
   WHEN 4 THEN 'event without an end' WHEN 5 THEN 'event without an end' END AS error,
  CASE o_orderkey % 6 WHEN 4 THEN 2 WHEN 5 THEN 1 END AS n_broken FROM orders"""
    d["month_window"] = """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS frame_month FROM orders
  WHERE (o_orderdate >= TIMESTAMP '1998-12-01' AND o_orderdate < TIMESTAMP '1999-01-01')
     OR (o_orderdate >= TIMESTAMP '1997-05-01' AND o_orderdate < TIMESTAMP '1997-07-01')"""
    d["calendar_meta"] = calendar_meta()
    d["calendar_post"] = """SELECT event_id, event_type AS title, coalesce(CASE WHEN event_type = 'view' THEN NULL ELSE props END, '')
  AS content, 'draft' AS status, 'ajde_events' AS post_type,
  CASE WHEN event_type = 'signup' THEN 'https://cal.example.com/e/' || event_id END AS link,
  CAST(5 + CASE WHEN event_type IN ('purchase', 'error') THEN 5 ELSE 0 END
       + CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS BIGINT) AS n_meta FROM events"""
    d["upload_plan"] = """SELECT event_id, event_type || ' (' || CASE WHEN event_type = 'error'
  THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+05:00' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END || ')' AS plan_line
  FROM events"""
    d["accepted_review"] = f"""SELECT event_id, round({CONF}, 6) AS confidence, {CONF} < 0.75 AS needs_review
  FROM events WHERE {PRED} = 1"""
    d["promote_label"] = f"""WITH {DL} SELECT doc_id, coalesce(label, CAST(n_chars > 1000 AS INTEGER)) AS label FROM dl"""
    d["concat_sets"] = """SELECT doc_id, lang, NULL::VARCHAR AS source FROM documents WHERE lang IS NULL OR lang NOT IN ('fr', 'es')
UNION ALL SELECT doc_id, NULL::VARCHAR, source FROM documents WHERE lang IN ('fr', 'es')"""
    d["ensure_columns"] = "SELECT page_id, url AS title, '' AS description, '' AS start, '' AS location FROM pages"
    d["title_desc_text"] = f"""WITH {DL} SELECT doc_id,
  md5(lower(coalesce(title, '') || ' ' || coalesce(text, ''))) AS text_md5,
  CAST(length(coalesce(title, '') || ' ' || coalesce(text, '')) AS INTEGER) AS text_len FROM dl"""
    d["upsert_locations"] = """WITH ex AS (SELECT name, row_number() OVER (ORDER BY name) AS id FROM
  (SELECT DISTINCT p_brand AS name FROM part WHERE p_brand LIKE 'Brand#1%' OR p_brand LIKE 'Brand#2%')),
nw AS (SELECT name, (SELECT coalesce(max(id), 0) FROM ex) + row_number() OVER (ORDER BY name) AS id FROM
  (SELECT DISTINCT p_brand AS name FROM part WHERE p_brand IS NOT NULL AND p_brand <> ''
   AND p_brand NOT IN (SELECT name FROM ex))),
dim AS (SELECT * FROM ex UNION ALL SELECT * FROM nw)
SELECT p.p_partkey, p.p_brand, d.id AS location_id FROM part p LEFT JOIN dim d ON p.p_brand = d.name"""
    rng = "o_orderkey BETWEEN 767 AND 924"
    d["publish"] = f"""SELECT count(*) FILTER (WHERE {rng}) AS published, count(*) FILTER (WHERE NOT ({rng})) AS drafts FROM orders"""
    d["delete_range"] = f"""SELECT count(*) FILTER (WHERE {rng} AND o_orderkey % 7 <> 0) AS deleted, count(*) FILTER (WHERE {rng} AND o_orderkey % 7 = 0) AS failed,
  CAST(924 - 767 + 1 AS BIGINT) AS attempted, count(*) FILTER (WHERE NOT ({rng}) OR o_orderkey % 7 = 0) AS remaining FROM orders"""
    d["filter_meta"] = meta_entries()
    d["upsert_meta"] = f"""WITH o AS (SELECT event_id, 'evcal_srow' AS key, CAST({epoch('ts')} AS VARCHAR) AS value, 0 AS seq FROM events
  UNION ALL SELECT event_id, 'evcal_lmlink', 'old', 0 FROM events),
n AS (SELECT event_id, 'evcal_lmlink' AS key, 'https://x.example/' || event_id AS value, 1 AS seq FROM events
  WHERE event_type = 'purchase'
  UNION ALL SELECT event_id, 'evo_year_long', 'no', 1 FROM events WHERE event_type = 'purchase')
SELECT event_id, key, arg_max(value, seq) AS value FROM (SELECT * FROM o UNION ALL SELECT * FROM n) GROUP BY event_id, key"""
    d["latest_published"] = f"SELECT o_orderkey FROM ({LATEST})"
    d["count_upcoming"] = UPCOMING
    d["markup_detected"] = f"SELECT page_id, {MARKUP} AS markup_detected FROM pages"
    d["health_verdict"] = f"""WITH u AS ({UPCOMING}), p AS (SELECT coalesce(bool_or({MARKUP}), false) AS page_ok FROM pages)
SELECT u.upcoming, p.page_ok, u.upcoming >= 5 AND p.page_ok AS healthy FROM u, p"""
    return d


ORACLE_SQL = _sql()
