"""Mixing sources to target weights by pivotal dependent rounding (operator 5).

Only DataFrame functions. A document's copies are floor(rate) or one more,
where rate is its source's target over its source's size. The fractional parts
are rounded in a reduction tree: units of a source are dealt by hash into
buckets of about ``FAN`` units; in a bucket, from the largest unit to the
smallest, the open unit and the next one trade words (what one gains the other
loses) until one of the two is a whole copy or none, by one of the two
possible trades, chosen at random so that neither unit's expectation moves.
What stays open of a bucket goes up a level; the last open unit of a source
goes to the nearer whole. So a source's words differ from its target by half of
one document at most.

Targets: sources by code point, null last, weigh 1, 2, 3, repeating, and share
all words; a target stops at ``LIMIT`` times its source's size and the excess is
shared again by weight until none is above.

Cases: null or word-free texts have size 0 and take 0; a source without words
has target 0; equal rows are units of their own; ids may be null or repeat; an
empty table gives an empty result; choices hash ids, sizes and an ordinal among
equal (id, source, size), so a rerun agrees, whatever the partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventflow.operators.numbering import dense_index

from .common import fresh, materialize, with_row_key

#: Most copies of a document, and of a source's words.
LIMIT = 3
#: Units that meet in one node of the reduction tree, about.
FAN = 64
#: Parts that the rows of one repeated (id, source, size) are numbered in.
SALTS = 64
WORD = r"[^\x20\x09-\x0D]+"


def words(text: str) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(F.col(f"`{text}`").cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(source, source_size, target) from rows (source, size)."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("_null", F.col("source").isNull())
    per = materialize(dense_index(per, ["_null", "source"], out="_rank")
                      .select("source", "source_size", ((F.col("_rank") - 1) % 3 + 1).alias("_w")))
    total = per.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    share, capped = 0.0, -1
    while True:  # a full source stays full as the share of the others grows
        full = F.col("source_size") * limit <= F.col("_w") * F.lit(share)
        n, held, weight = per.agg(F.count_if(full), F.coalesce(F.sum(F.when(full, F.col("source_size") * limit)), F.lit(0)),
                                  F.coalesce(F.sum(F.when(~full, F.col("_w"))), F.lit(0))).first()
        if n == capped or not weight:
            break
        capped, share = n, (total - held) / weight
    return per.select("source", "source_size",
                      F.least(F.lit(share) * F.col("_w"), (F.col("source_size") * limit).cast("double")).alias("target"))


def _let(value: Column, f) -> Column:
    """f(value), with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), f), 1)


def _chance(seed: int, *cols: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(1 << 52)).cast("double") / F.lit(float(1 << 52))


def _pair(seed: int):
    """One step of a bucket: (open unit, settled units), next unit -> the same."""

    def settled(u, up):
        return F.struct(u["size"].alias("size"), u["doc_id"].alias("doc_id"), u["nth"].alias("nth"), up.cast("int").alias("up"))

    def left(u, p):
        return F.struct(u["size"].alias("size"), u["doc_id"].alias("doc_id"), u["nth"].alias("nth"), p.alias("p"))

    def step(acc, b):
        a = acc["open"]
        # words that the open unit can gain from, and lose to, the next one
        room_a, own_a = (1 - a["p"]) * a["size"], a["p"] * a["size"]
        room_b, own_b = (1 - b["p"]) * b["size"], b["p"] * b["size"]

        def trade(t):
            gain = t["gain"]
            end_a = F.when(gain, t["room_a"] <= t["own_b"]).otherwise(t["own_a"] <= t["room_b"])
            end_b = F.when(gain, t["own_b"] <= t["room_a"]).otherwise(t["room_b"] <= t["own_a"])
            p_a = F.when(gain, a["p"] + t["own_b"] / a["size"]).otherwise(a["p"] - t["room_b"] / a["size"])
            p_b = F.when(gain, b["p"] - t["room_a"] / b["size"]).otherwise(b["p"] + t["own_a"] / b["size"])
            none = F.lit(None)
            return F.struct(
                F.when(~end_a, left(a, p_a)).when(~end_b, left(b, p_b)).otherwise(none).alias("open"),
                F.concat(acc["done"], F.when(end_a & end_b, F.array(settled(a, gain), settled(b, ~gain)))
                         .when(end_a, F.array(settled(a, gain))).otherwise(F.array(settled(b, ~gain)))).alias("done"))

        def choose(t):
            up, down = F.least(t["room_a"], t["own_b"]), F.least(t["own_a"], t["room_b"])
            gain = _chance(seed, a["doc_id"], a["nth"], a["size"], b["doc_id"], b["nth"], b["size"]) * (up + down) < down
            return _let(F.struct(t["room_a"].alias("room_a"), t["own_a"].alias("own_a"), t["room_b"].alias("room_b"),
                                 t["own_b"].alias("own_b"), gain.alias("gain")), trade)

        paired = _let(F.struct(room_a.alias("room_a"), own_a.alias("own_a"), room_b.alias("room_b"), own_b.alias("own_b")), choose)
        return F.when(a.isNull(), F.struct(left(b, b["p"]).alias("open"), acc["done"].alias("done"))).otherwise(paired)

    return step


def copies(sizes: DataFrame, limit: int = LIMIT, seed: int = 5) -> DataFrame:
    """Rows (doc_id, source, size) -> one row for each, with nth (1, 2, ... among
    equal ones), source_size, target and copies."""
    sizes = materialize(sizes.select("doc_id", "source", "size").groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("_n")))
    targets = source_targets(sizes.select("source", (F.col("size") * F.col("_n")).alias("size")), limit)
    targets = materialize(targets.withColumnRenamed("source", "_source"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    units = (sizes.join(targets, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
             .withColumn("base", F.floor(rate).cast("long")).withColumn("p", rate - F.floor(rate))
             .withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n")))).drop("_n"))
    group = ["source", "source_size", "target", "base"]
    whole = (F.col("size") == 0) | (F.col("p") <= 0)
    out = [units.filter(whole).select("doc_id", "nth", "size", *group, F.col("base").alias("copies"))]
    live = units.filter(~whole)
    # units a source starts with; sizes of 0 are counted too, which only makes buckets smaller
    counts = sizes.groupBy("source").agg(F.sum("_n").alias("_units"))
    most = counts.agg(F.coalesce(F.max("_units"), F.lit(0))).first()[0]
    live = live.join(counts.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    level = 0
    unit = "struct<size:bigint,doc_id:bigint,nth:bigint,p:double>"
    start = F.struct(F.lit(None).cast(unit).alias("open"),
                     F.array().cast("array<struct<size:bigint,doc_id:bigint,nth:bigint,up:int>>").alias("done"))
    while most:
        level += 1
        buckets = F.ceil(F.col("_units") / FAN).cast("long")
        folded = (live.withColumn("_buckets", buckets)
                  .withColumn("_bucket", F.pmod(F.xxhash64(F.lit(seed + level), "doc_id", "nth", "size"), F.col("_buckets")))
                  .groupBy(*group, "_buckets", "_bucket")
                  .agg(F.sort_array(F.collect_list(F.struct("size", "doc_id", "nth", "p")), asc=False).alias("_all"))
                  .select(*group, F.col("_buckets").alias("_units"), F.aggregate("_all", start, _pair(seed + 1000 * level)).alias("_f")))
        folded = materialize(folded.select(*group, "_units", "_f.open", "_f.done"))
        out.append(folded.select(*group, F.explode("done").alias("d"))
                   .select("d.doc_id", "d.nth", "d.size", *group, (F.col("base") + F.col("d.up")).alias("copies")))
        live = folded.filter("open is not null").select(*group, "_units", "open.*")
        if most <= FAN:
            break
        most = -(-most // FAN)
    if most:
        out.append(live.select("doc_id", "nth", "size", *group, (F.col("base") + (F.col("p") >= 0.5).cast("int")).alias("copies")))
    made = out[0]
    for x in out[1:]:
        made = made.union(x)
    return made.drop("base")


def mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", limit: int = LIMIT, seed: int = 5) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken (words)."""
    sizes = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{source}`").cast("string").alias("source"),
                        words(text).alias("size"))
    return copies(sizes, limit, seed).select("doc_id", "source", "size", "source_size", "target", "copies",
                                             (F.col("copies") * F.col("size")).alias("taken"))


def mixed_rows(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id",
               limit: int = LIMIT, seed: int = 5) -> DataFrame:
    """``docs`` with each row as often as the mix takes it. A row without words takes no words
    and stays once, where its source has a target."""
    keyed, keys = with_row_key(docs)
    own, keys = keys, ["_file", "_pos"]
    rows = materialize(keyed.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{source}`").cast("string").alias("source"),
                                    words(text).alias("size"), *[F.col(k).alias(n) for k, n in zip(own, keys)]))
    made = materialize(copies(rows, limit, seed))
    same = ["doc_id", "source", "size"]
    lone = rows.groupBy(*same).agg(F.count(F.lit(1)).alias("_n"), *[F.min(k).alias(k) for k in keys])
    alone = lone.filter("_n = 1").select(*same, *keys, F.lit(1).cast("long").alias("nth"))
    # rows of a repeated key are numbered in SALTS parts, so that no key sits in one task
    again = _match(rows, lone.filter("_n > 1").select(*same), same).withColumn("_salt", F.pmod(F.xxhash64(*keys), F.lit(SALTS)))
    parts = again.groupBy(*same, "_salt").agg(F.count(F.lit(1)).alias("_m"))
    before = Window.partitionBy(*same).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_off", F.coalesce(F.sum("_m").over(before), F.lit(0))).drop("_m")
    inside = Window.partitionBy(*same, "_salt").orderBy(*keys)
    many = _match(again.withColumn("_at", F.row_number().over(inside)), parts, [*same, "_salt"], ["_off"])
    numbered = alone.union(many.select(*same, *keys, (F.col("_at") + F.col("_off")).alias("nth")))
    times, copy = fresh(keyed, "_copies", "_copy")
    chosen = _match(numbered, made, [*same, "nth"], ["copies"]).select(
        *[F.col(n).alias(k) for k, n in zip(own, keys)], F.when(F.col("size") == 0, 1).otherwise(F.col("copies")).cast("int").alias(times)).filter(F.col(times) > 0)
    taken = keyed.join(chosen, own).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times))))
    return taken.select(*[F.col(f"`{c}`") for c in docs.columns])


def _match(a: DataFrame, b: DataFrame, on: list[str], take: list[str] = ()) -> DataFrame:
    """Inner join on columns that may be null; ``take`` comes from ``b``."""
    right = b.select(*[F.col(c).alias(f"_r_{c}") for c in on], *take)
    cond = None
    for c in on:
        eq = F.col(c).eqNullSafe(F.col(f"_r_{c}"))
        cond = eq if cond is None else cond & eq
    return a.join(right, cond, "inner" if take else "left_semi").drop(*[f"_r_{c}" for c in on])
