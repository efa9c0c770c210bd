"""Document fingerprints by order MinHash, with DataFrame functions only.

A text is a sequence of tokens (runs of at most ``TOKEN`` characters other than white
space), its k-mers are ``k`` tokens in a row, and equal k-mers of a text are numbered in
order of occurrence. Each numbered k-mer has a hash. For each of ``slots`` orderings the
``least`` smallest ones are selected, put back into text order and hashed together. The
share of equal hashes of two fingerprints estimates a likeness that falls with every edit
and with every change of order.

The orderings are rotations of one hash: ordering j counts upwards from j/slots of the hash
range and around. One sort of a text's hashes serves all of them, and a short text, whose
hashes leave many ranges empty, borrows from the next range.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

TOKEN = 12
_POSITION_BITS = 30
_HASH_BITS = 32
_HASH_MASK = (1 << _HASH_BITS) - 1
_POSITION_MASK = (1 << _POSITION_BITS) - 1


@dataclass(frozen=True)
class OrderMinHash:
    k: int = 3
    least: int = 2
    slots: int = 32
    bucket_bytes: int = 8 << 20
    max_buckets: int = 1024


def _hash_of(packed: Column) -> Column:
    return F.shiftright(packed, _POSITION_BITS)


def with_fingerprint(rows: DataFrame, text: str, name: str, params: OrderMinHash) -> DataFrame:
    """Add ``name``, an array of ``slots`` hashes, empty for a text without tokens.

    The steps are columns of their own, each named after the last one it needs, because a
    lambda may only refer to columns and to its own variables.
    """
    at = f"__{name}_"
    mask, n = F.lit(_HASH_MASK), F.size(f"{at}tokens")

    def packed(token, i):
        following = [F.get(F.col(f"{at}tokens"), i + step) for step in range(1, params.k)]
        code = F.xxhash64(token, *following).bitwiseAND(mask)
        return F.shiftleft(code, _POSITION_BITS).bitwiseOR(i.cast("long"))

    # Where runs of equal k-mers begin in the sorted array.
    def begins(i):
        before = _hash_of(F.get(F.col(f"{at}sorted"), i - 1))
        return (i == 0) | (before != _hash_of(F.get(F.col(f"{at}sorted"), i)))

    def renumbered(start, j):
        end = F.coalesce(F.get(F.col(f"{at}starts"), j + 1), n) - 1

        def with_occurrence(i):
            kmer = F.get(F.col(f"{at}sorted"), i)
            number = i - start
            code = F.xxhash64(_hash_of(kmer), number).bitwiseAND(mask)
            renamed = F.shiftleft(code, _POSITION_BITS).bitwiseOR(kmer.bitwiseAND(F.lit(_POSITION_MASK)))
            return F.when(number == 0, kmer).otherwise(renamed)

        return F.transform(F.sequence(start, end), with_occurrence)

    width = (1 << _HASH_BITS) // params.slots

    def leading(item, i):
        """Among the first ``least`` of its hash range."""
        earlier = F.get(F.col(f"{at}hashes"), i - params.least)
        bucket = F.floor(_hash_of(item) / width)
        return (i < params.least) | (F.floor(_hash_of(earlier) / width) != bucket)

    def tuple_hash(bound, j):
        # Items before the boundary: its place among items and boundaries, less the
        # boundaries before it.
        begin = F.array_position(F.col(f"{at}ranked"), bound).cast("int") - j
        chosen = F.slice(F.col(f"{at}twice"), begin, F.least(F.lit(params.least), n))
        in_text_order = F.array_sort(
            F.transform(
                chosen,
                lambda x: F.shiftleft(x.bitwiseAND(F.lit(_POSITION_MASK)), _HASH_BITS).bitwiseOR(_hash_of(x)),
            )
        )
        return F.xxhash64(F.transform(in_text_order, lambda x: x.bitwiseAND(mask)))

    bounds = F.array(*(F.lit((j * width << _POSITION_BITS) - 1).cast("long") for j in range(params.slots)))
    pattern = F.lit(r"[^\x20\x09-\x0D]{1,%d}" % TOKEN)
    steps = {
        "tokens": F.regexp_extract_all(F.col(text), pattern, F.lit(0)),
        "sorted": F.sort_array(F.transform(F.col(f"{at}tokens"), packed)),
        "starts": F.when(n > 0, F.filter(F.sequence(F.lit(0), n - 1), begins)).otherwise(
            F.array().cast("array<int>")
        ),
        "hashes": F.when(F.size(f"{at}starts") == n, F.col(f"{at}sorted")).otherwise(
            F.sort_array(F.flatten(F.transform(F.col(f"{at}starts"), renumbered)))
        ),
        "first": F.filter(F.col(f"{at}hashes"), leading),
        "twice": F.concat(F.col(f"{at}first"), F.col(f"{at}first")),
        "ranked": F.sort_array(F.concat(F.col(f"{at}first"), bounds)),
    }
    out = rows
    for step, column in steps.items():
        out = out.withColumn(f"{at}{step}", column)
    empty = F.array().cast("array<bigint>")
    # The sizes keep the optimizer from moving the arrays' own steps into the lambda.
    filled = (n > 0) & (F.size(f"{at}ranked") > 0) & (F.size(f"{at}twice") > 0)
    out = out.withColumn(name, F.when(filled, F.transform(bounds, tuple_hash)).otherwise(empty))
    return out.drop(*(f"{at}{step}" for step in steps))


def likeness(a: str, b: str) -> Column:
    """The share of equal slots; two empty fingerprints are alike, one is not like another."""
    slots = F.greatest(F.size(a), F.size(b))
    equal = F.size(F.filter(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), lambda x: x))
    return F.when(slots == 0, F.lit(1.0)).when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(
        equal / slots
    )


def as_text(fingerprint: str) -> Column:
    """Sixteen hexadecimal digits per slot."""
    return F.array_join(F.transform(fingerprint, lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), "")


def _buckets(documents: DataFrame, params: OrderMinHash) -> list[int]:
    """Ids that cut the table into buckets of about ``bucket_bytes`` of text."""
    shares = [k / params.max_buckets for k in range(1, params.max_buckets)]
    row = documents.agg(
        F.sum(F.octet_length("text")).alias("bytes"), F.percentile_approx("doc_id", shares, 20 * len(shares)).alias("ids")
    ).first()
    wanted = min(params.max_buckets, max(1, -(-(row["bytes"] or 0) // params.bucket_bytes)))
    ids = row["ids"] or []
    step = params.max_buckets / wanted
    return sorted({ids[round(k * step) - 1] for k in range(1, wanted)}) if ids else []


def with_next(documents: DataFrame, sign, carried: list[str], params: OrderMinHash) -> DataFrame:
    """The rows of ``sign(documents)`` with ``next_<c>``, for each of ``carried``, of the row
    after them by ascending (doc_id, text); after the last row comes the first.

    The table is cut by id into buckets of bounded size, each a window of its own; the last
    row of a bucket takes the first row of the next one from a table with one row per bucket.
    Rows without doc_id come first. Only rows of one id share a bucket at any rate.
    """
    cuts = _buckets(documents, params)
    bucket = F.lit(0)
    if cuts:
        bounds = F.array(*(F.lit(c).cast("long") for c in cuts))
        bucket = F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(
            F.size(F.filter(bounds, lambda b: b <= F.col("doc_id")))
        )
    placed = documents.withColumn("__bucket", bucket)
    window = W.partitionBy("__bucket").orderBy(F.col("doc_id").asc_nulls_first(), F.col("text"))
    ahead = F.struct(*(F.col(c) for c in carried))
    rows = sign(placed).withColumn("__next", F.lead(ahead).over(window))

    least = placed.groupBy("__bucket").agg(F.min("doc_id").alias("least"))
    least = least.select(F.col("__bucket").alias("bucket"), "least")
    leading = placed.join(
        F.broadcast(least),
        (F.col("__bucket") == F.col("bucket")) & F.col("doc_id").eqNullSafe(F.col("least")),
        "left_semi",
    )
    heads = sign(leading.groupBy("__bucket").agg(F.min("doc_id").alias("doc_id"), F.min("text").alias("text")))
    # One row per bucket, at most max_buckets + 1; each takes the head of the one after it.
    turn = W.orderBy("__bucket")
    whole = turn.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    heads = heads.select(
        "__bucket", F.coalesce(F.lead(ahead).over(turn), F.first(ahead).over(whole)).alias("__head")
    )
    rows = rows.join(F.broadcast(heads), "__bucket")
    return rows.select(
        *(c for c in rows.columns if not c.startswith("__")),
        *(
            F.when(F.col("__next").isNull(), F.col(f"__head.{c}")).otherwise(F.col(f"__next.{c}")).alias(f"next_{c}")
            for c in carried
        ),
    )


def fingerprints(documents: DataFrame, params: OrderMinHash = OrderMinHash()) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next) for every row of ``documents``.

    The edited text is the text with its last floor(n_chars / 4) characters replaced by the
    first as many (or all) of the next text. Needs doc_id (long) and text; further columns
    are not read. NULL texts are empty. An empty fingerprint is that of a text without
    tokens. Rows of equal doc_id follow each other by text; a single row is its own next.
    Rows without doc_id come first. An empty table gives an empty table.
    """
    docs = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    paired = with_next(
        docs,
        lambda rows: with_fingerprint(rows, "text", "fingerprint", params),
        ["text", "fingerprint"],
        params,
    )
    n_chars = F.length("text").cast("long")
    cut = F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(F.expr("left(text, length(text) - cast(floor(length(text) / 4) as int))"), F.left("next_text", cut))
    paired = paired.select(
        "doc_id", n_chars.alias("n_chars"), edited.alias("edited"), "fingerprint", "next_fingerprint"
    )
    both = with_fingerprint(paired, "edited", "edited_fingerprint", params)
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        as_text("fingerprint").alias("fingerprint"),
        as_text("edited_fingerprint").alias("edited_fingerprint"),
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        likeness("fingerprint", "next_fingerprint").alias("near_next"),
    )
