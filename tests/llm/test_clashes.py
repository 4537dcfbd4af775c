"""Further columns that have the names the operators use inside: kept, values unchanged."""
import pytest
from pyspark.sql import functions as F

from llm import lines, mixing, pieces, simhash, toxicity

NAMES = ["_of", "_y", "_id", "_text", "_toxicity", "_toxicity_text", "_gone", "_row_file", "_row_pos", "_copies", "_copy", "_key",
         "_fp", "_b", "_root", "node", "component", "_n", "_at", "_salt", "_off", "size", "nth", "copies", "line", "line_no", "id", "late", "score"]


@pytest.fixture(scope="module")
def clashing(spark):
    rows = [(i, f"words of row {i % 7} are said here by row {i % 7} once more\n\u4e00\u4e8c\u4e09\u56db\u4e94\u516d\u4e03\u516b\u4e5d\u5341" * 1, "en", ["a", "b", None][i % 3], 40)
            for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs.withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in NAMES})


def kept(df):
    rows = df.collect()
    assert rows and set(NAMES) <= set(df.columns)
    assert all(r[n] == f"{n}{r.doc_id}" for r in rows for n in NAMES)
    return rows


def test_toxicity(spark, clashing):
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, toxic int").withColumn("_of", F.lit(1)).withColumn("text", F.lit(2))
    out = toxicity.reject_toxic(clashing, labels)
    assert out.columns == clashing.columns
    out.collect()
    kept(toxicity._scored(clashing, toxicity.Machine({}, -3.0), "text", "_toxicity_"))


def test_lines(clashing):
    rows = kept(lines.dedup_lines(clashing))
    assert len(rows) == 30 and sum("\n" in r.text for r in rows) == 1  # first lines are within two edits of the first; second lines, 10 characters, stay


def test_simhash(clashing):
    assert len(kept(simhash.simhash_dedup(clashing))) <= 7


def test_mixing(clashing):
    rows = kept(mixing.mixed_rows(clashing))
    assert {r.source for r in rows} == {"a", "b", None}


def test_pieces(clashing):
    assert len(kept(pieces.encode(clashing))) == 30


def test_lines_without_spaces_are_compared(spark):
    long = "\u6587" * 30
    df = spark.createDataFrame([(1, long), (2, long), (3, long[:-1] + "x"), (4, "\u6587" * 5), (5, "\u6587" * 5)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in lines.dedup_lines(df).collect()}
    assert got == {1: long, 2: "", 3: "", 4: "\u6587" * 5, 5: "\u6587" * 5}
