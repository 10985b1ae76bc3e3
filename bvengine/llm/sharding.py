"""Shards of near-equal bytes by sampled splitters, in DataFrame functions only.

The key of a record is (hash of the text, hash of the id, stored row number), so equal texts lie side by side, and a
large group of copies, even of rows alike in every column, can be cut anywhere. A record's weight is its share of all
bytes and of all rows, half each: a sample of keys is drawn with probability proportional to it, and every
`PER_RANGE`-th sampled key is a splitter. The splitters, `ranges_per_shard` for each shard whatever the input, cut the
key space into ranges of about equal weight. Ranges of more than twice their share, or of more than `range_rows` rows,
are subdivided by samples of their own records, each range in its own group; so the number of pieces grows with the
input while the one table of splitters does not. Bytes and rows are summed per piece; running totals, over the pieces
of a range and over the ranges, place every piece, and a window inside each piece places its records. The shard is the
place of a record's first byte in the whole, cut in equal lengths, so a shard's size is off by less than one record;
a record larger than a shard fills the shard that it begins in, and those that it covers stay empty.

Law: ``bytes``. Null text has size 16 and the checksum of nothing; a text of any length is one record. Rows with equal
text and id are interchangeable. Extra columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bvengine.llm.common import stored

#: Expected sampled keys per range.
PER_RANGE = 16
#: The order of the records.
KEY = ("k1", "k2", "k3")


def drawn(share: Column, seed: int) -> Column:
    """Whether a key is in a sample that it enters with probability `share`: by a hash of the key, alike at every run."""
    u = F.xxhash64(*KEY, F.lit(seed)).bitwiseAND(F.lit((1 << 52) - 1)).cast("double") / float(1 << 52)
    return u < share


def splitters() -> Column:
    """Every PER_RANGE-th of the keys of a group, in order: a sorted array. For samples of bounded expected size."""
    return F.filter(F.array_sort(F.collect_list(F.struct(*KEY))), lambda x, i: i % PER_RANGE == PER_RANGE - 1)


def place(cut: Column, key: Column) -> Column:
    """Number of splitters at or below the key, by binary search on the sorted array. `cut` is evaluated once a row."""
    powers = F.array(*[F.lit(1 << b) for b in reversed(range(24))])

    def search(array: Column) -> Column:
        def step(at: Column, p: Column) -> Column:
            return F.when((at + p <= F.size(array)) & (F.get(array, F.least(at + p, F.size(array)) - 1) <= key), at + p).otherwise(at)

        return F.aggregate(powers, F.lit(0), step)

    return F.get(F.transform(F.array(cut), search), F.lit(0))


def pieces(keyed: DataFrame, total: int, count: int, ranges: int, range_rows: int) -> DataFrame:
    """The keyed rows with `range` and `sub`, whose order is the order of the keys."""
    weight = F.col("size") / F.lit(2.0 * total) + F.lit(0.5 / count)
    cut = keyed.where(drawn(weight * ranges * PER_RANGE, 1)).agg(splitters().alias("cut"))  # about `ranges` keys
    at = keyed.withColumn("cut", cut.scalar()).withColumn("range", place(F.col("cut"), F.struct(*KEY)))
    at = stored(at.drop("cut"), "ranges")
    load = (F.sum(weight) * ranges).alias("load")
    loads = at.groupBy("range").agg(load, F.count(F.lit(1)).alias("n"))
    parts = F.ceil(F.greatest(F.when(F.col("load") > 2, F.col("load")).otherwise(1.0), F.col("n") / range_rows))
    full = loads.select("range", "load", parts.alias("parts")).where("parts > 1")
    finer = (
        at.join(full, "range")
        .where(drawn(weight * ranges / F.col("load") * F.col("parts") * PER_RANGE, 2))
        .groupBy("range")
        .agg(splitters().alias("cut"))
    )
    sub = F.when(F.col("cut").isNull(), 0).otherwise(place(F.col("cut"), F.struct(*KEY)))
    return at.join(finer, "range", "left").withColumn("sub", sub).drop("cut")


def by_bytes(docs: DataFrame, shards: int = 40, range_rows: int = 1 << 20, ranges_per_shard: int = 64) -> DataFrame:
    """Per row of (doc_id, text): size, text_crc32, shard and slot.

    `range_rows` is about what one window task sorts. The keyed rows, without texts, are written once, so the
    samples, sums and windows read narrow rows. Nothing is broadcast but the first places of the `shards`; other
    small tables are joined as Spark finds their sizes.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = stored(
        docs.select(
            "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("k1"), F.xxhash64("doc_id").alias("k2"), F.monotonically_increasing_id().alias("k3"),
        ),
        "keyed",
    )
    total, count = keyed.agg(F.sum("size"), F.count(F.lit(1))).first()
    if not count:
        return keyed.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    placed = stored(pieces(keyed, total, count, shards * ranges_per_shard, range_rows), "pieces")
    sums = stored(placed.groupBy("range", "sub").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")), "sums")
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # over ranges: `ranges` rows at most, about
    of_range = sums.groupBy("range").agg(F.sum("b").alias("b"), F.sum("n").alias("n"))
    of_range = of_range.select("range", F.coalesce(F.sum("b").over(earlier), F.lit(0)).alias("rb"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("rn"))
    before = Window.partitionBy("range").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sums.select("range", "sub", F.coalesce(F.sum("b").over(before), F.lit(0)).alias("b0"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"))
        .join(of_range, "range")
        .select("range", "sub", (F.col("b0") + F.col("rb")).alias("b0"), (F.col("n0") + F.col("rn")).alias("n0"))
    )
    inside = Window.partitionBy("range", "sub").orderBy(*KEY)
    rows = stored(
        placed.withColumn("n1", F.row_number().over(inside))
        .withColumn("b1", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)))
        .join(starts, ["range", "sub"])
        .withColumn("n", F.col("n0") + F.col("n1") - 1)
        .withColumn("shard", F.least(F.lit(shards - 1), F.floor((F.col("b0") + F.coalesce("b1", F.lit(0))) * shards / F.lit(total))).cast("int"))
        .select("doc_id", "size", "text_crc32", "shard", "n"),
        "placed",
    )
    firsts = rows.groupBy("shard").agg(F.min("n").alias("first"))  # one row a shard
    return rows.join(F.broadcast(firsts), "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("n") - F.col("first")).cast("long").alias("slot"))
