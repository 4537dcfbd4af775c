"""Order statistics without a global sort: dense numbering and exact selection.

Both split the rows into many small buckets whose order is known, count the
buckets (a table of bounded size), and sort only inside a bucket. Nothing is
cached, checkpointed or collected; the plans stay lazy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staging import stage

#: Split points of a numbering.
SPLITS = 256
#: Leading hex digits of a hash that name its bucket: 65,536 buckets.
DIGITS = 4


def dense_index(df: DataFrame, order_cols: list, group_cols: list | tuple = (),
                out: str = "idx") -> DataFrame:
    """Add ``out`` = 1-based position of each row by ``order_cols`` within
    ``group_cols`` (ties are the caller's to break: make the order total).

    The split points are the rows of the ``SPLITS`` smallest hashes: a uniform
    sample, the same whenever it is taken. A row's bucket is the number of split
    points below it; its position is its group's rows in earlier buckets plus its
    place in its own. A hot group is cut by the split points like all rows.
    """
    group = F.struct(*group_cols) if group_cols else F.struct(F.lit(0))
    keyed = df.withColumns({"_group": group, "_key": F.struct(*group_cols, *order_cols)})
    sample = keyed.select("_key").orderBy(F.xxhash64("_key"), "_key").limit(SPLITS)
    points = sample.agg(F.sort_array(F.collect_list("_key"))).scalar()
    placed = (stage(keyed, {"_points": points})
              .withColumn("_bucket", F.size(F.filter("_points", lambda p: p < F.col("_key")))).drop("_points"))
    counts = placed.groupBy("_group", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_group").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_group", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    place = F.row_number().over(Window.partitionBy("_group", "_bucket").orderBy("_key"))
    return (placed.join(offsets, ["_group", "_bucket"])
            .withColumn(out, (F.col("_off") + place).cast("long")).drop("_group", "_key", "_bucket", "_off"))


def seeded_hash(key: Column, seed: str, columns: list[str]) -> Column:
    """md5 of the key's text and the seed; a null key takes a hash of its row, so
    rows without a key spread like all others."""
    row = F.concat(F.lit("row "), F.xxhash64(*[F.col(f"`{c}`") for c in columns]).cast("string"))
    return F.md5(F.concat(F.coalesce(key.cast("string"), row), F.lit(seed)))


def hash_cut(df: DataFrame, hash_col: str, share: float, group: str | None = None) -> Column:
    """Whether a row is among the ``ceil(share * n)`` smallest hashes (of its
    ``group``, not null): exact where hashes are distinct; equal hashes stay on one side.

    A histogram of the hashes' leading digits finds the bucket in which the cut
    lies, and only the rows of that bucket, one in 65,536, are ranked. The cuts
    come back as one value, a map of group to hash (one entry per group).
    """
    g = F.col(f"`{group}`") if group else F.lit(0)
    rows = df.select(g.alias("_g"), F.col(hash_col).alias("_hash"), F.substring(hash_col, 1, DIGITS).alias("_bucket"))
    hist = rows.groupBy("_g", "_bucket").agg(F.count(F.lit(1)).alias("_c"))
    order = Window.partitionBy("_g").orderBy("_bucket")
    running = hist.withColumns({"_upto": F.sum("_c").over(order), "_all": F.sum("_c").over(Window.partitionBy("_g"))})
    need = F.ceil(F.col("_all") * F.lit(share))
    edge = running.where((F.col("_upto") >= need) & (F.col("_upto") - F.col("_c") < need)).select(
        "_g", "_bucket", (need - (F.col("_upto") - F.col("_c"))).alias("_rank"))
    inside = rows.join(edge, ["_g", "_bucket"]).withColumn(
        "_at", F.row_number().over(Window.partitionBy("_g").orderBy("_hash"))).where(F.col("_at") == F.col("_rank"))
    cuts = inside.agg(F.map_from_entries(F.collect_list(F.struct("_g", "_hash")))).scalar()
    return F.coalesce(F.col(hash_col) <= F.try_element_at(cuts, g), F.lit(False))
