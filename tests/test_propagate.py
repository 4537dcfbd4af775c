"""Series propagation (F1-F5): unanimous, conflicting, tied and unlabelled
series, null series; idempotence."""
from eventflow.operators import propagate as P

ROWS = [
    # series s1: unanimous '1' (int text, float text, padded) with gaps
    (1, "s1", "1"), (2, "s1", "1.0"), (3, "s1", None), (4, "s1", " 1"),
    # s2: conflict
    (5, "s2", "0"), (6, "s2", "1"), (7, "s2", None),
    # s3: no labels
    (8, "s3", None), (9, "s3", "x"),
    # null series keeps its label, '|' is no series
    (10, None, "1"), (11, "|", "1"), (12, "|", None),
]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "id int, series_id string, label string")


def test_unanimous(spark):
    got = {r.id: r.label for r in P.propagate_unanimous(frame(spark)).collect()}
    assert got[3] == "1" and got[1] == "1" and got[2] == "1.0"
    assert got[4] == "1"          # ' 1' is not a valid row label for the mask, so it is rewritten
    assert got[7] is None and got[5] == "0"   # conflict untouched
    assert got[8] is None and got[9] == "x"
    assert got[10] == "1" and got[12] is None


def test_unanimous_strict(spark):
    got = {r.id: r.label for r in P.propagate_unanimous_strict(frame(spark)).collect()}
    assert got[3] == "1" and got[2] == "1"    # only exact '1' counts; '1.0' is overwritten
    assert got[7] is None


def test_idempotent(spark):
    once = P.propagate_unanimous(frame(spark))
    twice = P.propagate_unanimous(once)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


INT_ROWS = [(1, "a", 1, "manual_or_previous"), (2, "a", 0, None), (3, "a", 0, None), (4, "a", None, None),
            (5, "b", 1, None), (6, "b", 0, None), (7, "b", None, None),       # tie -> 0
            (8, "c", None, None), (9, None, 1, None), (10, "", 1, None), (11, "", None, None)]


def int_frame(spark):
    return spark.createDataFrame(INT_ROWS, "id int, series_id string, label int, label_source string")


def test_majority_overwrite(spark):
    got = {r.id: (r.label, r.label_source) for r in P.propagate_majority_overwrite(int_frame(spark)).collect()}
    assert got[1] == (0, "series_propagation")         # manual label overwritten (reference behaviour)
    assert got[4] == (0, "series_propagation")
    assert got[5] == (0, "series_propagation") and got[7] == (0, "series_propagation")
    assert got[8] == (None, None) and got[9] == (1, None)
    assert got[11] == (1, "series_propagation")         # '' is a series for the overwrite variant
    protected = {r.id: r.label for r in P.propagate_majority_overwrite(int_frame(spark), protect_manual=True).collect()}
    assert protected[1] == 1


def test_majority_fill_and_coverage(spark):
    df = int_frame(spark)
    filled = P.propagate_majority_fill(df.withColumnRenamed("label_source", "src"))
    got = {r.id: r.label for r in filled.collect()}
    assert got[1] == 1 and got[4] == 0 and got[7] == 0
    assert got[11] is None                               # '' is not a valid series here
    cov = P.coverage(filled.join(df.select("id", df.label.alias("before")), "id"), "before", "label").first()
    assert (cov.total, cov.labeled_before, cov.labeled_after, cov.filled, cov.remaining) == (11, 7, 9, 2, 2)
