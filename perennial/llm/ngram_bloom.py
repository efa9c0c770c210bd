"""Language-model scores from n-gram counts in a log-frequency Bloom filter.

The corpus is written once as blocks of word codes with a dictionary per block. Word counts
stay exact: every block's dictionary goes in parts to the shard that owns a range of codes
and comes back with the totals. Counts of word pairs are quantised on a logarithmic scale;
a pair of level q enters the filter q times, as (pair, 1) to (pair, q), and its level is
read back by probing 1, 2, ... until a probe fails.

The score of a text is the sum over its tokens of

    log10((count(previous, token) + strength * p(token)) / (count(previous) + strength))

with p(token) = (c + 0.5) / (N + 0.5 (V + 1)) from the exact counts, the pair's count from
the filter, and the end token before the first word.

The filter is cut into segments by the pair's hash. The driver broadcasts as many segments
at a time as ``pass_bytes`` allows; a token needs only its own pair, so the passes add up
to the same score for a corpus of any size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perennial.llm.shared import settle, small_batches
from perennial.llm.wordcodes import mix, slices, word_codes

END = np.uint64(0x51_7C_C1_B7_27_22_0A_95)


@dataclass(frozen=True)
class BloomModel:
    base: float = 2.0  # level q stands for counts from base**(q-1) up to below base**q
    bits_per_token: float = 6.0
    probes: int = 3
    strength: float = 4.0
    block_words: int = 1 << 19
    shard_words: int = 1 << 21
    segment_tokens: int = 1 << 19
    pass_bytes: int = 256 << 20


# -------------------------------------------------------------------- blocks


def _blocks(params: BloomModel):
    """Texts as blocks of about ``block_words`` codes into the block's own dictionary.

    A block never splits a text. ``trained`` counts each dictionary word over the texts
    that are learnt from.
    """

    def block(number: int, ids, held, codes):
        part = TaskContext.get().partitionId()
        tokens = np.array([len(c) for c in codes], dtype=np.int64)
        words, places = np.unique(np.concatenate(codes), return_inverse=True)
        learnt = ~np.repeat(np.array(held), tokens)
        trained = np.bincount(places[learnt], minlength=len(words)).astype(np.uint32)
        return pa.RecordBatch.from_pydict(
            {
                "block": [(part << 32) + number],
                "doc_ids": pa.array([ids], pa.list_(pa.int64())),
                "held": pa.array([held], pa.list_(pa.bool_())),
                "tokens": pa.array([tokens.tolist()], pa.list_(pa.int64())),
                "codes": pa.array([places.astype(np.uint32).tobytes()], pa.binary()),
                "words": pa.array([words.tobytes()], pa.binary()),
                "trained": pa.array([trained.tobytes()], pa.binary()),
                "train_tokens": pa.array([int(learnt.sum())], pa.int64()),
                "size": pa.array([len(words)], pa.int64()),
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, held, codes, size = 0, [], [], [], 0
        for batch in batches:
            for part in slices(batch):
                words = word_codes(part.column("text"))
                ids += part.column("doc_id").to_pylist()
                held += part.column("held_out").to_pylist()
                for k in range(len(words)):
                    codes.append(np.append(words.of(k), END))
                size += len(words.codes) + len(words)
                if size >= params.block_words:
                    yield block(number, ids, held, codes)
                    number, ids, held, codes, size = number + 1, [], [], [], 0
        if ids:
            yield block(number, ids, held, codes)

    return run


_BLOCK = (
    "block long, doc_ids array<long>, held array<boolean>, tokens array<long>, codes binary, "
    "words binary, trained binary, train_tokens long, size long"
)


def _u64(cell: bytes) -> np.ndarray:
    return np.frombuffer(cell, dtype=np.uint64)


def _u32(cell: bytes) -> np.ndarray:
    return np.frombuffer(cell, dtype=np.uint32)


# --------------------------------------------------------------- word counts


def _to_shards(shards: int):
    edges = (np.arange(1, shards, dtype=np.float64) * (2.0**64 / shards)).astype(np.uint64)

    def run(batches):
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("block", "words", "trained")), strict=True)
            for block, words, trained in rows:
                words, trained = _u64(words), _u32(trained)
                cuts = [0, *np.searchsorted(words, edges), len(words)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "shard": pa.array(range(shards), pa.int64()),
                        "block": pa.array([block] * shards, pa.int64()),
                        "words": [words[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)],
                        "trained": [trained[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)],
                    }
                )

    return run


def _shard_totals(rows: pa.Table) -> pa.Table:
    words = [_u64(x) for x in rows.column("words").to_pylist()]
    trained = np.concatenate([_u32(x) for x in rows.column("trained").to_pylist()])
    different, places = np.unique(np.concatenate(words), return_inverse=True)
    totals = np.bincount(places, weights=trained, minlength=len(different)).astype(np.uint64)
    known = [int((totals > 0).sum())] + [0] * (len(words) - 1)
    counts = np.split(totals[places], np.cumsum([len(w) for w in words])[:-1])
    return pa.table(
        {
            "block": rows.column("block"),
            "shard": rows.column("shard"),
            "counts": pa.array([c.tobytes() for c in counts], pa.binary()),
            "known": pa.array(known, pa.int64()),
        }
    )


# --------------------------------------------------------------- pair filter


def _pairs(codes: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """A hash for each token and the one before it; the end token precedes a text."""
    before = np.empty_like(codes)
    before[1:] = codes[:-1]
    before[np.cumsum(tokens) - tokens] = END
    return mix(before * np.uint64(0xD6E8FEB86659FD93) + codes)


def _segment_of(pairs: np.ndarray, bits: int) -> np.ndarray:
    return (pairs >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(pairs), np.int64)


def _to_segments(bits: int):
    def run(batches):
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("codes", "words", "tokens", "held")), strict=True)
            for codes, words, tokens, held in rows:
                tokens = np.array(tokens)
                pairs = _pairs(_u64(words)[_u32(codes)], tokens)[~np.repeat(np.array(held), tokens)]
                pairs, counts = np.unique(pairs, return_counts=True)
                segments = _segment_of(pairs, bits)
                cuts = np.flatnonzero(np.diff(segments)) + 1
                yield pa.RecordBatch.from_pydict(
                    {
                        "segment": pa.array(segments[np.concatenate([[0], cuts])] if len(pairs) else [], pa.int64()),
                        "pairs": pa.array(
                            [x.astype(np.uint32).tobytes() for x in np.split(pairs, cuts)] if len(pairs) else [],
                            pa.binary(),
                        ),
                        "counts": pa.array(
                            [x.astype(np.uint32).tobytes() for x in np.split(counts, cuts)] if len(pairs) else [],
                            pa.binary(),
                        ),
                    }
                )

    return run


def _slots(pairs: np.ndarray, level: int, probes: int, size: int) -> np.ndarray:
    """Bits of (pair, level) within a segment of ``size`` bits; pairs are 32-bit here."""
    mixed = mix(pairs.astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D) + np.uint64(level))
    first, step = mixed & np.uint64(0xFFFFFFFF), (mixed >> np.uint64(32)) | np.uint64(1)
    return (first[:, None] + np.arange(probes, dtype=np.uint64)[None, :] * step[:, None]) % np.uint64(size)


def _levels(counts: np.ndarray, base: float) -> np.ndarray:
    return 1 + np.floor(np.log(counts) / math.log(base) + 1e-9).astype(np.int64)


def _filled(params: BloomModel, size: int):
    def run(rows: pa.Table) -> pa.Table:
        pairs, places = np.unique(
            np.concatenate([_u32(x) for x in rows.column("pairs").to_pylist()]), return_inverse=True
        )
        weights = np.concatenate([_u32(x) for x in rows.column("counts").to_pylist()])
        levels = _levels(np.bincount(places, weights=weights), params.base)
        bits = np.zeros(size, dtype=bool)
        for level in range(1, int(levels.max(initial=0)) + 1):
            bits[_slots(pairs[levels >= level], level, params.probes, size)] = True
        return pa.table(
            {
                "segment": rows.column("segment")[:1],
                "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary()),
            }
        )

    return run


def _read_levels(filter_bits, first_segment, pairs, segments, params, size) -> np.ndarray:
    """The quantised level of each pair: how many probes in a row succeed."""
    offset = (segments - first_segment).astype(np.uint64) * np.uint64(size)
    levels = np.zeros(len(pairs), dtype=np.int64)
    open_ = np.arange(len(pairs))
    level = 0
    while len(open_):
        level += 1
        slots = _slots(pairs[open_].astype(np.uint32), level, params.probes, size) + offset[open_][:, None]
        hit = (filter_bits[slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype(np.uint8)) & 1
        open_ = open_[hit.all(axis=1)]
        levels[open_] = level
    return levels


def _level_counts(base: float, top: int = 64) -> np.ndarray:
    """What a level stands for: the middle of its whole counts, nothing for level 0."""
    low = np.ceil(base ** np.arange(top) - 1e-9)
    high = np.ceil(base ** np.arange(1, top + 1) - 1e-9) - 1
    return np.concatenate([[0.0], (low + np.maximum(low, high)) / 2])


# -------------------------------------------------------------------- scores


def _scored(params, filter_bits, first, last, bits, size, total, distinct):
    def run(batches):
        middle = _level_counts(params.base)
        packed = filter_bits.value
        for batch in batches:
            columns = ("block", "doc_ids", "held", "tokens", "codes", "words", "counts")
            for row in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
                block, doc_ids, held, tokens, codes, words, counts = row
                tokens, codes = np.array(tokens), _u32(codes)
                counts = np.concatenate([_u64(x["counts"]) for x in counts]).astype(np.float64)
                starts = np.cumsum(tokens) - tokens
                of_word = counts[codes]
                p = (of_word + 0.5) / (total + 0.5 * (distinct + 1))
                base = np.add.reduceat(np.log10(p), starts)
                known = np.add.reduceat((of_word > 0).astype(np.int64), starts)
                words = _u64(words)
                end_count = counts[np.searchsorted(words, END)]
                before = np.empty_like(of_word)
                before[1:] = of_word[:-1]
                before[starts] = end_count
                pairs = _pairs(words[codes], tokens)
                segments = _segment_of(pairs, bits)
                mine = np.flatnonzero((segments >= first) & (segments < last))
                seen = middle[_read_levels(packed, first, pairs[mine], segments[mine], params, size)]
                # A pair is never more frequent than its first word.
                seen = np.minimum(seen, before[mine])
                log = np.zeros(len(codes))
                log[mine] = np.log10((seen + params.strength * p[mine]) / (before[mine] + params.strength))
                yield pa.RecordBatch.from_pydict(
                    {
                        "block": pa.array([block] * len(tokens), pa.int64()),
                        "row": pa.array(range(len(tokens)), pa.int64()),
                        "doc_id": pa.array(doc_ids, pa.int64()),
                        "held_out": pa.array(held, pa.bool_()),
                        "n_tokens": pa.array(tokens, pa.int64()),
                        "n_known": pa.array(known, pa.int64()),
                        "base_score": pa.array(base, pa.float64()),
                        "part": pa.array(np.add.reduceat(log, starts), pa.float64()),
                    }
                )

    return run


_SCORED = (
    "block long, row long, doc_id long, held_out boolean, n_tokens long, n_known long, "
    "base_score double, part double"
)


def score_texts(documents: DataFrame, params: BloomModel = BloomModel()) -> DataFrame:
    """Scores of every row of ``documents`` (doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score), learnt from the rows that are not held out.

    Needs doc_id (long), text and held_out (boolean, NULL counts as false); further columns
    are not read. A NULL or empty text is its end token alone. Repeated rows and rows
    without doc_id are each scored, and learnt from, like any other. An empty table gives
    an empty table; with nothing to learn from, the model is uniform.
    """
    spark = documents.sparkSession
    small_batches(spark)
    docs = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.coalesce("held_out", F.lit(False)).alias("held_out"),
    )
    blocks = settle(docs.mapInArrow(_blocks(params), _BLOCK), "blocks")
    figures = blocks.agg(F.sum("train_tokens").alias("tokens"), F.sum("size").alias("words")).first()
    total = figures["tokens"] or 0

    shards = max(1, -(-(figures["words"] or 0) // params.shard_words))
    counted = settle(
        blocks.select("block", "words", "trained")
        .mapInArrow(_to_shards(shards), "shard long, block long, words binary, trained binary")
        .groupBy("shard")
        .applyInArrow(_shard_totals, "block long, shard long, counts binary, known long"),
        "counts",
    )
    distinct = counted.agg(F.sum("known").alias("known")).first()["known"] or 0

    segment_bits = max(0, math.ceil(math.log2(max(1, total) / params.segment_tokens)))
    size = max(64, -(-math.ceil(params.bits_per_token * total / (1 << segment_bits)) // 64) * 64)
    filters = settle(
        blocks.select("codes", "words", "tokens", "held")
        .mapInArrow(_to_segments(segment_bits), "segment long, pairs binary, counts binary")
        .groupBy("segment")
        .applyInArrow(_filled(params, size), "segment long, bits binary"),
        "filter",
    )
    # A block's parts of the counts, one per shard, add up to the size of its dictionary.
    given = blocks.drop("trained", "train_tokens", "size").join(
        counted.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("shard", "counts"))).alias("counts")),
        "block",
    )
    step = max(1, params.pass_bytes // (size // 8))
    passes = range(0, 1 << segment_bits, step)
    if len(passes) > 1:
        given = settle(given, "given")
    scored = None
    for first in passes:
        last = min(first + step, 1 << segment_bits)
        packed = np.zeros((last - first) * size // 8, dtype=np.uint8)
        for row in filters.where(F.col("segment").between(first, last - 1)).toLocalIterator():
            at = (row["segment"] - first) * size // 8
            packed[at : at + size // 8] = np.frombuffer(row["bits"], dtype=np.uint8)
        sent = spark.sparkContext.broadcast(packed)
        part = given.mapInArrow(_scored(params, sent, first, last, segment_bits, size, total, distinct), _SCORED)
        if len(passes) > 1:
            part = settle(part, "part")
            sent.unpersist()
        scored = part if scored is None else scored.unionByName(part)
    if len(passes) > 1:
        scored = scored.groupBy("block", "row").agg(
            *(F.first(c).alias(c) for c in ("doc_id", "held_out", "n_tokens", "n_known", "base_score")),
            F.sum("part").alias("part"),
        )
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(total).cast("long").alias("train_tokens"),
        "base_score",
        F.col("part").alias("score"),
    )


def with_held_out(documents: DataFrame, folds: int = 5, fold: int = 1) -> DataFrame:
    """(doc_id, text, held_out): held out are the ids whose checksum falls in ``fold``."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return documents.select("doc_id", "text", (F.crc32(name) % folds == fold).alias("held_out"))
