"""Best-fit packing of documents into sequences of several permitted lengths.

Lengths are words. A document longer than the largest capacity is split into whole
capacities and a rest, without loss. The table is dealt by a hash into groups of about
``group_words`` words; each group is packed by best-fit decreasing over all its open bins,
a new bin being opened at the capacity of least cost per word that it will hold, by the
lengths still to come, and every bin is cut down at the end to the smallest capacity that
holds it. A sequence costs its words, their square over ``square_words`` (attention) and a
fixed part, so neither the longest nor the shortest capacity is always the cheapest. Only ids and lengths are
shuffled. A group leaves no more than a few bins partly filled, so groups cost next to
nothing against packing all documents at once, which no single task could hold.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perennial.llm.bins import pack, split_lengths
from perennial.llm.shared import settle, word_count


@dataclass(frozen=True)
class Capacities:
    words: tuple[int, ...] = (256, 512, 1024, 2048)
    # Cost of a bin besides its words: the fixed part favours long bins, the square short ones.
    bin_cost: int = 32
    square_words: float = 8192
    group_words: int = 1 << 22


_PIECE = (
    "doc_id long, piece int, n_pieces int, length long, start_word long, bin_id string, "
    "bin_offset long, bin_capacity long, bin_used long"
)


def _pack_group(params: Capacities):
    def run(rows: pa.Table) -> pa.Table:
        group = rows.column("group")[0].as_py()
        pieces = []
        for doc_id, length in sorted(
            zip(rows.column("doc_id").to_pylist(), rows.column("length").to_pylist(), strict=True),
            key=lambda r: (r[0] is not None, r[0] or 0, r[1]),
        ):
            sizes = split_lengths(length, max(params.words))
            at = 0
            for k, size in enumerate(sizes):
                pieces.append((doc_id, k, len(sizes), size, at))
                at += size
        bin_of, offset, capacity = pack([p[3] for p in pieces], list(params.words), params.bin_cost, params.square_words)
        used = [0] * len(capacity)
        for p, b in zip(pieces, bin_of, strict=True):
            used[b] += p[3]
        columns = list(zip(*pieces, strict=True)) if pieces else [[]] * 5
        columns += [
            [f"{group}-{b}" for b in bin_of],
            offset,
            [capacity[b] for b in bin_of],
            [used[b] for b in bin_of],
        ]
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        names = [part.split()[0] for part in _PIECE.split(",")]
        return pa.table([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names=names)

    return run


def packed_documents(documents: DataFrame, params: Capacities = Capacities()) -> DataFrame:
    """One row per piece of a document: doc_id, piece, n_pieces, length and start_word in
    words, bin_id, bin_offset, bin_capacity and bin_used.

    Needs doc_id (long) and text; further columns are not read. NULL, empty and blank texts
    take no room: they have one row of length 0 without a bin. Repeated rows and rows
    without doc_id are packed like any other, each in its place. An empty table gives an
    empty table. Which bin a document gets depends on how the table is cut into tasks.
    """
    # The input's own partition is part of the hash: rows that a third of the table repeat
    # are dealt over as many groups as files hold them.
    lengths = settle(
        documents.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            word_count(F.col("text")).alias("length"),
            F.xxhash64("doc_id", F.md5(F.coalesce("text", F.lit("")).cast("binary")), F.spark_partition_id()).alias("deal"),
        ),
        "lengths",
    )
    total = lengths.agg(F.sum("length").alias("words")).first()["words"] or 0
    groups = max(1, -(-total // params.group_words))
    packed = (
        lengths.where("length > 0")
        .select(F.pmod("deal", F.lit(groups)).alias("group"), "doc_id", "length")
        .groupBy("group")
        .applyInArrow(_pack_group(params), _PIECE)
    )
    empty = lengths.where("length = 0").select(
        "doc_id", F.lit(0).alias("piece"), F.lit(1).alias("n_pieces"), "length", F.lit(0).cast("long").alias("start_word"),
        *(F.lit(None).cast("string" if c == "bin_id" else "long").alias(c) for c in ("bin_id", "bin_offset", "bin_capacity", "bin_used")),
    )
    return packed.unionByName(empty)
