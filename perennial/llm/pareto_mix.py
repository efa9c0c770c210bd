"""Mixing sources to target weights by Pareto order sampling, DataFrame functions only.

Every source gets a target in words. A document of its source is expected
``e = min(max_copies, c * size**0.25)`` times in the mix, c being chosen so that the expected
words equal the target: longer documents are a little likelier, none is certain by its
length alone. floor(e) whole copies are certain. For what is left, p = e - floor(e), documents
are ranked by random odds over inclusion odds, (u / (1-u)) / (p / (1-p)), and the sample is
the first of this order, its size fixed by the words that are still wanted: it ends before
the document that would exceed them, and up to ``closings`` times the later document that
comes nearest to the gap closes it.

The random number u is a hash of the document, so reruns agree. The rank where a source's
sample ends is found in a histogram of ranks first and then among the documents of one
histogram cell, so no source is ordered as a whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from perennial.llm.shared import settle, word_count


@dataclass(frozen=True)
class Mix:
    weights: tuple[int, ...] = (5, 2, 1)  # by the source's place, repeating
    share: float = 1.5  # of all words
    max_copies: int = 2
    cells: int = 4096
    closings: int = 3
    salt: str = "mix"


def targets(sizes: DataFrame, params: Mix) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    The words are shared by weight; what a source cannot take within ``max_copies`` of its
    size goes to the others by weight. Filled in the order of size per weight, the level at
    which the rest is shared is known when the first source is below its bound. The windows
    have no partition because they order the sources themselves.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(by_name) - 1
    weights = F.array(*(F.lit(w).cast("double") for w in params.weights))
    weighted = sizes.select(
        "source",
        "source_size",
        F.get(weights, (place % len(params.weights)).cast("int")).alias("weight"),
        (F.col("source_size") * params.max_copies).cast("double").alias("bound"),
    )
    fill = W.orderBy(F.col("bound") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(W.unboundedPreceding, -1)
    all_rows = fill.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    total = F.sum(F.col("source_size").cast("double")).over(all_rows) * params.share
    full = F.coalesce(F.sum("bound").over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = (total - full) / weight_left
    filled = weighted.withColumn("level", level).withColumn(
        "open", F.col("weight") * F.col("level") < F.col("bound")
    )
    # The first open source fixes the level of all after it.
    opened = F.first(F.when(F.col("open"), F.col("level")), ignorenulls=True).over(all_rows)
    return filled.withColumn("opened", opened).select(
        "source",
        "source_size",
        F.least(F.col("bound"), F.coalesce(F.col("weight") * F.col("opened"), F.col("bound"))).alias("target"),
    )


def _power(size: Column) -> Column:
    """size ** 0.25 by square roots, which every engine rounds alike."""
    return F.sqrt(F.sqrt(size.cast("double")))


def _factors(sized: DataFrame, wanted: DataFrame, params: Mix) -> DataFrame:
    """(source, factor): the c of the expected copies, from the counts of equal sizes.

    From the longest documents down, those whose expected copies exceed the bound are fixed
    at it and the rest of the target is shared by the others. The window holds the different
    sizes of a source, not its documents.
    """
    counts = sized.where("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.join(wanted, counts.source.eqNullSafe(wanted.source)).select(
        counts.source, "size", "n", "target"
    )
    longest_first = W.partitionBy("source").orderBy(F.col("size").desc())
    above = longest_first.rowsBetween(W.unboundedPreceding, -1)
    upto = longest_first.rowsBetween(W.currentRow, W.unboundedFollowing)
    words = (F.col("n") * F.col("size")).cast("double")
    bound = float(params.max_copies)
    fixed = F.coalesce(F.sum(words).over(above), F.lit(0.0)) * bound
    factor = (F.col("target") - fixed) / F.sum(words * _power(F.col("size"))).over(upto)
    tried = counts.withColumn("factor", factor)
    return (
        tried.where(F.col("factor") * _power(F.col("size")) <= bound)
        .groupBy("source")
        .agg(F.max_by("factor", "size").alias("factor"))
    )


def _odds(p: Column) -> Column:
    return p / (1 - p)


def with_copies(documents: DataFrame, params: Mix = Mix()) -> DataFrame:
    """(row, size, source_size, target, copies): ``row`` is a struct of all columns of
    ``documents`` as given, so further columns of any name do no harm; copies is how often
    the mix takes the row.

    Needs doc_id, text and source. NULL sources are a source of their own, the last in
    order. NULL, empty and blank texts have size 0 and are not taken. Repeated rows have the
    same random number and are taken alike; a NULL doc_id counts as an empty name. A source
    without words has target 0. An empty table gives an empty table.
    """
    name = F.concat_ws(":", F.lit(params.salt), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    number = F.conv(F.substring(F.md5(name.cast("binary")), 1, 12), 16, 10).cast("double")
    given = documents.select(
        F.struct("*").alias("row"),
        F.col("source").cast("string").alias("source"),
        word_count(F.col("text")).alias("size"),
        ((number + 0.5) / float(1 << 48)).alias("u"),
    )
    light = settle(given.drop("row"), "sizes")
    sizes = light.groupBy("source").agg(F.sum("size").alias("source_size"))
    wanted = settle(targets(sizes, params), "targets")
    factors = _factors(light, wanted, params).withColumnRenamed("source", "name")
    plan = settle(
        wanted.join(factors, wanted.source.eqNullSafe(factors.name), "left").drop("name"), "plan"
    )

    def expected(frame: DataFrame, sources: DataFrame) -> DataFrame:
        sources = sources.withColumnRenamed("source", "name")
        bound = F.lit(float(params.max_copies))
        # Without a factor every document is at its bound.
        e = F.when(F.col("size") == 0, 0.0).otherwise(
            F.least(bound, F.coalesce(F.col("factor") * _power(F.col("size")), bound))
        )
        frame = frame.join(sources, F.col("source").eqNullSafe(F.col("name")), "left").drop("name")
        frame = frame.withColumn("certain", F.floor(e)).withColumn("p", e - F.floor(e))
        odds = _odds(F.col("u")) / _odds(F.col("p"))
        return frame.withColumn("rank", F.when(F.col("p") > 0, odds / (1 + odds)))

    ranked = expected(light, plan)
    left = ranked.groupBy("source").agg(
        (F.first("target") - F.sum(F.col("certain") * F.col("size"))).alias("wanted")
    )
    cell = F.floor(F.col("rank") * params.cells)
    chances = settle(
        ranked.where("rank is not null").select("source", "size", "rank", cell.alias("cell")), "ranks"
    )
    histogram = chances.groupBy("source", "cell").agg(F.sum("size").alias("words"))
    running = W.partitionBy("source").orderBy("cell").rowsBetween(W.unboundedPreceding, W.currentRow)
    left = left.withColumnRenamed("source", "name")
    crossing = (
        histogram.withColumn("upto", F.sum("words").over(running))
        .join(left, F.col("source").eqNullSafe(F.col("name")))
        .where((F.col("upto") >= F.col("wanted")) & (F.col("upto") - F.col("words") < F.col("wanted")))
        .select("name", F.col("cell").alias("at"), (F.col("wanted") - F.col("upto") + F.col("words")).alias("missing"))
    )
    inside = W.partitionBy("source").orderBy("rank").rangeBetween(W.unboundedPreceding, W.currentRow)
    fits = F.when(F.col("total") <= F.col("missing"), F.struct("rank", "total"))
    cut = (
        chances.join(crossing, F.col("source").eqNullSafe(F.col("name")) & (F.col("cell") == F.col("at")))
        .withColumn("total", F.sum("size").over(inside))
        .groupBy("source", "at", "missing")
        .agg(F.max(fits).alias("last"))
        .select(
            "source",
            "at",
            F.col("last.rank").alias("last"),
            (F.col("missing") - F.coalesce("last.total", F.lit(0))).alias("gap"),
        )
    )
    ends = left.select("name", "wanted").join(cut, F.col("name").eqNullSafe(F.col("source")), "left")
    ends = settle(
        ends.select(
            F.col("name").alias("end_of"),
            # Ranks below `under` and, within its cell, up to `last` are in the sample. A
            # source whose chances do not reach what is wanted takes them all.
            F.when(F.col("wanted") <= 0, 0.0)
            .when(F.col("at").isNotNull(), F.col("at") / params.cells)
            .otherwise(2.0)
            .alias("under"),
            F.when(F.col("wanted") > 0, F.col("last")).alias("last"),
            F.when(F.col("wanted") > 0, F.col("gap")).alias("gap"),
        ),
        "ends",
    )

    def sampled() -> Column:
        first = (F.col("rank") < F.col("under")) | (F.col("rank") <= F.col("last"))
        return F.coalesce(first, F.lit(False)) | F.coalesce(F.array_contains("closing", F.col("rank")), F.lit(False))

    ends = ends.withColumn("closing", F.array().cast("array<double>"))
    for _closing in range(params.closings):
        miss = F.abs(F.col("size") - F.col("gap"))
        closing = (
            chances.join(ends, F.col("source").eqNullSafe(F.col("end_of")))
            .where(~sampled() & (miss < F.col("gap")))
            .groupBy("end_of")
            .agg(F.min_by(F.struct("rank", "size"), F.struct(miss, "rank")).alias("found"))
            .withColumnRenamed("end_of", "closed")
        )
        ends = settle(
            ends.join(closing, F.col("end_of").eqNullSafe(F.col("closed")), "left").select(
                "end_of",
                "under",
                "last",
                (F.col("gap") - F.coalesce("found.size", F.lit(0))).alias("gap"),
                F.when(F.col("found").isNull(), F.col("closing"))
                .otherwise(F.array_append("closing", F.col("found.rank")))
                .alias("closing"),
            ),
            "ends",
        )
    plan = plan.join(ends.drop("gap"), F.col("source").eqNullSafe(F.col("end_of")), "left").drop("end_of")
    plan = settle(plan, "plan")
    taken = sampled()
    copies = F.col("certain") + F.when(taken, 1).otherwise(0)
    return expected(given, plan).select("row", "size", "source_size", "target", copies.cast("int").alias("copies"))


def mixed(documents: DataFrame, params: Mix = Mix()) -> DataFrame:
    """The mix itself: every taken row as often as it is taken, columns as given."""
    return (
        with_copies(documents, params)
        .where("copies > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
        .select("row.*")
    )
