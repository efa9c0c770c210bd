"""Sharding by proportional stratified interleaving.

The rows of each source are put into a seeded random order and numbered. A row's fractional
rank is its number plus a random offset of its source, divided by the size of the source, so
the rows of every source lie evenly between 0 and 1. Sorted by it, the sources are
interleaved in proportion, and the order is cut into shards whose row counts differ by one
at most. Every stretch of the order, so every shard too, has the table's mixture.

Nothing is sorted as a whole. Numbers within a source come from buckets of the random order,
which is even by construction, and numbers within the table from buckets of the fractional
rank, which is as even: each bucket is sorted by itself, and what lies before it is a prefix
sum over one small row per bucket. A source with a third of all rows is many buckets.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from perennial.llm.shared import settle

_HASH_BITS = 60
_OFFSET_BITS = 30
_RUN = 4096


@dataclass(frozen=True)
class Shards:
    shards: int = 24
    seed: str = "interleave"
    bucket_rows: int = 1 << 12


def _hash(seed: str, value: Column) -> Column:
    """Sixty bits of a digest, the same in any engine."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), value).cast("binary"))
    return F.conv(F.substring(digest, 1, _HASH_BITS // 4), 16, 10).cast("long")


def _before(counts: DataFrame, bucket: str, *keys: str) -> DataFrame:
    """Add ``before``, the rows in the buckets before each one. One row per bucket.

    Buckets are summed in runs of ``_RUN`` each, so no task sees all of them.
    """

    def running(by: str, *within: str) -> Column:
        order = W.partitionBy(*within).orderBy(by).rowsBetween(W.unboundedPreceding, -1)
        return F.coalesce(F.sum("n").over(order), F.lit(0)).cast("long")

    runs = counts.withColumn("run", F.floor(F.col(bucket) / _RUN))
    inner = runs.withColumn("inner", running(bucket, *keys, "run"))
    totals = runs.groupBy(*keys, "run").agg(F.sum("n").alias("n"))
    totals = totals.withColumn("outer", running("run", *keys))
    totals = totals.select(*(F.col(k).alias(f"{k}_") for k in (*keys, "run")), "outer")
    same = [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in (*keys, "run")]
    return inner.join(totals, same).select(*counts.columns, (F.col("inner") + F.col("outer")).alias("before"))


def _buckets(rows: int, params: Shards) -> int:
    """A power of two, so that buckets of one size are parts of those of another."""
    return 1 << max(0, (max(1, rows // params.bucket_rows) - 1).bit_length())


def fractional_ranks(rows: DataFrame, params: Shards = Shards()) -> DataFrame:
    """(row, source, draw, rank, fraction): ``row`` is a struct of all columns as given.

    ``draw`` is the row's place in the random order, ``rank`` its number within its source
    from 0. Needs doc_id and source.
    """
    drawn = rows.select(
        F.struct("*").alias("row"),
        F.col("source").cast("string").alias("source"),
        _hash(params.seed, F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("draw"),
    )
    wide = _HASH_BITS - (_buckets(rows.count(), params).bit_length() - 1)
    drawn = drawn.withColumn("bucket", F.shiftright("draw", wide))
    counts = settle(drawn.groupBy("source", "bucket").agg(F.count(F.lit(1)).alias("n")), "source_buckets")
    sizes = counts.groupBy("source").agg(F.sum("n").alias("size"))
    # A known source and the unknown one never share a name.
    name = F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), "source"))
    unit = float(1 << _OFFSET_BITS)
    offset = F.shiftright(_hash(params.seed, name), _HASH_BITS - _OFFSET_BITS) / F.lit(unit)
    sizes = sizes.select(F.col("source").alias("s"), "size", offset.alias("offset"))
    places = _before(counts, "bucket", "source")
    places = places.join(sizes, F.col("source").eqNullSafe(F.col("s"))).select(
        "s", F.col("bucket").alias("b"), "before", "size", "offset"
    )
    within = W.partitionBy("source", "bucket").orderBy("draw", "row.doc_id")
    numbered = drawn.withColumn("number", F.row_number().over(within) - 1)
    ranked = numbered.join(
        places, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))
    ).withColumn("rank", F.col("before") + F.col("number"))
    fraction = (F.col("rank").cast("double") + F.col("offset")) / F.col("size").cast("double")
    return ranked.select("row", "source", "draw", "rank", fraction.alias("fraction"))


def interleaved_shards(rows: DataFrame, params: Shards = Shards()) -> DataFrame:
    """(row, shard, slot): every row in one of ``shards`` shards, slots from 0 without gaps.

    Row counts of shards differ by one at most; the rows of a source in a shard differ from
    its even share by one and by what the fractional rank at the shard's ends differs from
    an even cut, about the square root of the number of sources in all.

    Needs doc_id and source; ``row`` carries all columns as given, further ones of any name
    included. Rows without source are a source of their own, rows without doc_id are drawn
    as one place of the order. Repeated rows are rows like any other and follow one another
    in their source's order; rows of one doc_id share a bucket, so doc_id should be nearly a
    key. An empty table gives an empty table. The same rows give the same shards whatever
    their order and partitions.
    """
    ranked = settle(fractional_ranks(rows, params), "ranked")
    total = ranked.count()
    buckets = _buckets(total, params)
    slice_of = F.least(F.floor(F.col("fraction") * buckets), F.lit(buckets - 1)).cast("long")
    ranked = ranked.withColumn("slice", slice_of)
    places = _before(ranked.groupBy("slice").agg(F.count(F.lit(1)).alias("n")), "slice").drop("n")
    within = W.partitionBy("slice").orderBy("fraction", "source", "rank")
    ordered = ranked.withColumn("number", F.row_number().over(within) - 1).join(places, "slice")
    place = F.col("before") + F.col("number") - 1
    # Shard s begins at the first place p with p * shards >= s * total.
    cut, size = params.shards, max(total, 1)
    placed = ordered.select("row", (F.col("before") + F.col("number")).cast("long").alias("place"))
    placed = placed.withColumn("shard", F.expr(f"place * {cut}L div {size}L"))
    slot = F.expr(f"place - (shard * {size}L + {cut - 1}L) div {cut}L")
    return placed.select("row", F.col("shard").cast("int").alias("shard"), slot.alias("slot"))


def write_shards(sharded: DataFrame, path: str, shards: int, files_per_shard: int = 1) -> None:
    """One folder per shard, its rows in files that follow one another by slot."""
    pieces = sharded.withColumn("shard_of", F.col("shard"))
    # Sorted by the folder's column: the writer would sort by it again and lose the slots' order.
    pieces.repartitionByRange(shards * files_per_shard, "shard_of", "slot").sortWithinPartitions(
        "shard_of", "slot"
    ).select("row.*", "slot", "shard_of").write.partitionBy("shard_of").mode("errorifexists").parquet(path)


def shard_digests(documents: DataFrame, params: Shards = Shards()) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every document.

    ``size`` is the text's UTF-8 bytes and eight more; a NULL text has no bytes. Texts are
    reduced to size and checksum before any shuffle.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    narrow = documents.select(
        "doc_id", "source", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    return interleaved_shards(narrow, params).select(
        "row.doc_id",
        "row.size",
        "row.text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
