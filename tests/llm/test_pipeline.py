"""Pipeline: every stage against a plain version on its own input; registration; edges."""
from collections import Counter

import corpus_pipeline as P
import __spark_entry__ as E
from llm import lines, mixing, pieces, queries, simhash, toxicity
from llm.common import materialize

SF = "/root/testdata/sf0.001"


def _naive_lines(rows):
    first, out = [], {}
    for doc, text in sorted(rows):
        kept = []
        own = dict(lines._lines(text, lines.MIN_WORDS))
        for n, raw in enumerate((text or "").split("\n")):
            x = own.get(n)
            if x is not None and any(y == x or (abs(len(y) - len(x)) <= 2 and lines.near(x, y, 2, 0.8)) for y in first):
                first.append(x)
                continue
            if x is not None:
                first.append(x)
            kept.append(raw)
        out[doc] = "\n".join(kept)
    return out


def _naive_groups(rows):
    fps = [(d, simhash.fingerprint(t, 4)) for d, t in rows]
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i][1] ^ fps[j][1]).bit_count() <= 4:
                parent[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(fps):
        low[find(i)] = min(low.get(find(i), d), d)
    return set(low.values())


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = [(n, materialize(f(spark, docs, SF))) if n == "toxicity" else (n, f) for n, f in P.STAGES]
    clean = kept[0][1]
    assert clean.columns == columns
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scores = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, labels).collect()}
    assert {r.doc_id for r in clean.collect()} == {d for d, s in scores.items() if s < 0.3}
    one = materialize(P.line_dedup_stage(spark, clean, SF))
    want = _naive_lines([(r.doc_id, r.text) for r in clean.collect()])
    assert one.columns == columns and {r.doc_id: r.text for r in one.collect()} == want
    two = materialize(P.simhash_stage(spark, one, SF))
    assert two.columns == columns and sorted(r.doc_id for r in two.collect()) == sorted(_naive_groups([(r.doc_id, r.text) for r in one.collect()]))
    three = materialize(P.mixing_stage(spark, two, SF))
    taken = {r.doc_id: (r.copies, r.size) for r in mixing.mix(two).collect()}
    assert three.columns == columns
    assert Counter(r.doc_id for r in three.collect()) == Counter({d: c if n else 1 for d, (c, n) in taken.items() if c or not n})
    last = pieces.decode(P.sentencepiece_stage(spark, three, SF)).collect()
    assert len(last) == three.count() and all(t == (r.text or "") for r in last for t in r.decoded)


def test_registered(spark):
    q = E.queries()
    assert "pipeline" in q and {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in queries.QUERIES}
    assert set(queries.QUERIES) <= set(q) and all(name in E.oracle_sql() for name in queries.ORACLE_SQL)


def test_nulls_and_empty_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None, None, None, None), (None, "a b c d e f", "en", "s", 1), (2, "", "en", "s", 0), (2, "a b c d e f\na b c d e f", "en", None, 1),
            (3, "you fool " * 3000, "en", "s", 9), (3, "you fool " * 3000, "en", "s", 9)]
    spark.createDataFrame([(1, 0)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for name, stage in P.STAGES:
            out = materialize(stage(spark, docs, str(tmp_path)))
            if name != "sentencepiece":
                assert out.columns == docs.columns
            docs = out
        assert docs.count() >= (1 if data else 0) and (data or docs.count() == 0)
