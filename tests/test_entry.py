"""Driver contract and a sample of oracle comparisons on sf0.001."""
import math

import duckdb

import __spark_entry__ as E
from eventflow.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
MODEL_QUERIES = {"svm_train_eval", "classify", "tag", "smart_label", "self_train", "upload_plan"}


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["label", "n"] and len(rows) >= 1


def test_registry_consistent():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert set(QUERIES) <= set(q) and set(QUERIES) - set(s) <= MODEL_QUERIES


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def test_oracles_small(spark):
    con = duckdb.connect()
    for t in ("part", "events", "documents", "labels", "pages", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name in ("propagate_majority_fill", "merge_by_priority", "parse_vevents", "extract_links",
                 "tfidf_topk", "calendar_meta", "group_split"):
        df = E.queries()[name](spark, SF)
        order = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
        got = sorted((tuple(_norm(r[i]) for i in order) for r in df.collect()), key=repr)
        res = con.execute(E.oracle_sql()[name])
        cols = [d[0] for d in res.description]
        o2 = sorted(range(len(cols)), key=lambda i: cols[i])
        exp = sorted((tuple(_norm(r[i]) for i in o2) for r in res.fetchall()), key=repr)
        assert got == exp, name


def test_all_oracles_sf0001(spark):
    """Every oracle-backed query matches DuckDB on the smallest table set."""
    con = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events documents embeddings pages "
              "benchmark labels conversations").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    bad = []
    for name, sql in E.oracle_sql().items():
        if name not in QUERIES:
            continue
        df = E.queries()[name](spark, SF)
        order = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
        got = sorted((tuple(_norm(r[i]) for i in order) for r in df.collect()), key=repr)
        res = con.execute(sql)
        cols = [d[0] for d in res.description]
        o2 = sorted(range(len(cols)), key=lambda i: cols[i])
        exp = sorted((tuple(_norm(r[i]) for i in o2) for r in res.fetchall()), key=repr)
        if sorted(df.columns) != sorted(cols) or got != exp:
            bad.append(name)
    assert not bad, bad


def test_bench_headline_registered():
    import bench
    assert set(bench.HEADLINE) <= set(E.queries())
