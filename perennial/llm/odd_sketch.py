"""Near duplicates by MinHash bands, odd sketches and an exact check of whole sets.

Every text becomes the set of its word shingles. Equal sets are one class from the start.
A class has 100 MinHash samples: 25 bands of four propose partners, and the samples folded
into a parity bitmap of 512 bits (an odd sketch) tell by the population count of an XOR how
far two sets differ, without reading them. Proposals that the sketches accept group classes
into families; inside a family the whole sets are compared.

Two sets of similarity 0.8 share no band with probability 2e-6 and are refused by their
sketches with probability below 1e-8; a larger similarity is missed less often.

No step lists the pairs of a group. Members of a band bucket are first held against its
least member (one row each). Only those the sketches refuse there are held against the
whole bucket, 1,024 at a time while the members stream by, and at most one edge per member
leaves the task. Families larger than ``FAMILY_SHINGLES`` are cut into blocks and compared
block by block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perennial.llm.components import components
from perennial.llm.shared import settle, small_batches
from perennial.llm.wordcodes import mix, odd_constants, sequence_codes, slices, word_codes

SAMPLES = 100
BAND = 4
SKETCH_BITS = 512
# Accepts every pair with at most 40 differing samples; similarity 0.8 differs in 20 +- 4.
SKETCH_LIMIT = 82
CHUNK = 1024
FAMILY_SHINGLES = 2_000_000

_SALTS = odd_constants(SAMPLES, 11)
_FACTORS = odd_constants(SAMPLES, 12)
_BAND_FACTORS = odd_constants(SAMPLES, 13)
_BAND_NAMES = odd_constants(SAMPLES // BAND, 14)


@dataclass(frozen=True)
class Rule:
    """Linked if ``100 * common >= percent * all`` over sets of ``shingle`` words."""

    shingle: int = 5
    percent: int = 80


def shingle_set(codes: np.ndarray, n: int) -> np.ndarray:
    """The distinct shingles, sorted; fewer than ``n`` words are one shingle, none is empty."""
    return np.unique(sequence_codes(codes, n, salt=7))


def samples(shingles: np.ndarray) -> np.ndarray:
    """The least value of the set under each of the hash functions."""
    least = np.full(SAMPLES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), 2048):
        part = (shingles[None, at : at + 2048] ^ _SALTS[:, None]) * _FACTORS[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return least


def odd_sketches(sampled: np.ndarray) -> np.ndarray:
    """Parity bitmaps: every (function, sample) flips one bit. One row of words per set."""
    sets = len(sampled)
    bit = mix(sampled + _FACTORS[None, :]) >> np.uint64(64 - SKETCH_BITS.bit_length() + 1)
    flat = bit.astype(np.int64) + np.arange(sets)[:, None] * SKETCH_BITS
    parity = np.bincount(flat.ravel(), minlength=sets * SKETCH_BITS) & 1
    return np.packbits(parity.astype(np.uint8).reshape(sets, SKETCH_BITS), axis=1).view(np.uint64)


def similarity(differing_bits: float) -> float:
    """The similarity that so many differing sketch bits stand for."""
    share = min(differing_bits / SKETCH_BITS, 0.499)
    return 1 + SKETCH_BITS * float(np.log1p(-2 * share)) / (4 * SAMPLES)


def band_codes(sampled: np.ndarray) -> np.ndarray:
    bands = (sampled * _BAND_FACTORS[None, :]).reshape(len(sampled), -1, BAND)
    return mix(bands.sum(axis=2, dtype=np.uint64) ^ _BAND_NAMES[None, :])


_FEATURES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_shingles", T.LongType()),
        T.StructField("set_low", T.LongType()),
        T.StructField("set_high", T.LongType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
        T.StructField("sketch", T.ArrayType(T.LongType())),
    ]
)


def _lists(rows: np.ndarray) -> pa.ListArray:
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel().view(np.int64)))


def _features(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words = word_codes(part.column("text"))
                sets = [shingle_set(words.of(i), shingle) for i in range(len(words))]
                sampled = np.stack([samples(s) for s in sets])
                low = np.array([s.sum(dtype=np.uint64) for s in sets]).view(np.int64)
                high = np.array([np.bitwise_xor.reduce(mix(s)) for s in sets], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(low),
                        pa.array(high.view(np.int64)),
                        _lists(band_codes(sampled)),
                        _lists(odd_sketches(sampled)),
                    ],
                    names=_FEATURES.fieldNames(),
                )

    return run


def _differing(a: str, b: str):
    """Differing bits of two sketches."""
    return sum(
        (F.bit_count(F.col(a)[k].bitwiseXOR(F.col(b)[k])) for k in range(SKETCH_BITS // 64)),
        start=F.lit(0),
    )


def _refused_partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hold a chunk of refused members against all members of their bucket.

    Rows come sorted by (bucket, chunk), the chunk's own rows before the members, so only
    the chunk is kept. A union-find over the chunk leaves out edges that say nothing new.
    """
    at, own_ids, own, parent = None, [], None, {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        out_a, out_b = [], []
        buckets = batch.column("bucket").to_numpy(zero_copy_only=False)
        chunks = batch.column("chunk").to_numpy(zero_copy_only=False)
        roles = batch.column("member").to_numpy(zero_copy_only=False)
        ids = batch.column("id").to_numpy(zero_copy_only=False)
        linked = batch.column("linked").to_numpy(zero_copy_only=False)
        sketches = batch.column("sketch").flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        sketches = sketches.reshape(batch.num_rows, -1)
        changes = np.flatnonzero((np.diff(buckets) != 0) | (np.diff(chunks) != 0) | (np.diff(roles) != 0)) + 1
        for start, end in zip([0, *changes], [*changes, batch.num_rows], strict=True):
            key = (buckets[start], chunks[start])
            if key != at:
                at, own_ids, own, parent = key, [], None, {}
            if not roles[start]:
                own_ids.extend(ids[start:end].tolist())
                part = sketches[start:end]
                own = part if own is None else np.concatenate([own, part])
                continue
            for k in range(start, end):
                near = np.bitwise_count(own ^ sketches[k]).sum(axis=1) <= SKETCH_LIMIT
                # Members that the bucket's least one holds already count as one node.
                node = -1 if linked[k] else int(ids[k])
                for u in np.flatnonzero(near):
                    a, b = find(own_ids[u]), find(node)
                    if a != b:
                        parent[a] = b
                        out_a.append(own_ids[u])
                        out_b.append(int(ids[k]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"]
        )


def _families(classes: DataFrame) -> DataFrame:
    """(node, component): classes joined by band proposals that their sketches accept."""
    banded = classes.select("id", F.explode("bands").alias("bucket"))
    buckets = (
        banded.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("least"))
        .where("size > 1")
    )
    members = settle(banded.join(buckets, "bucket").select("bucket", "least", "id", "size"), "members")
    sketches = classes.select("id", "sketch")
    pairs = members.where("id <> least").select("least", "id").distinct()
    held = settle(
        pairs.join(sketches, "id")
        .join(sketches.select(F.col("id").alias("least"), F.col("sketch").alias("other")), "least")
        .select("least", "id", (_differing("sketch", "other") <= SKETCH_LIMIT).alias("linked")),
        "held",
    )
    accepted = held.where("linked").select(F.col("least").alias("a"), F.col("id").alias("b"))

    open_members = members.where("size > 2 and id <> least").join(
        held.where("not linked").drop("linked"), ["least", "id"]
    )
    chunks = open_members.groupBy("bucket").agg(
        F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks")
    )
    refused = open_members.join(chunks, "bucket").select(
        "bucket", F.pmod(F.xxhash64("id"), "chunks").cast("int").alias("chunk"), F.lit(False).alias("member"),
        "id", F.lit(False).alias("linked"),
    )
    streamed = (
        members.where("size > 2 and id <> least")
        .join(chunks, "bucket")
        .join(held, ["least", "id"])
        .select(
            "bucket",
            F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
            F.lit(True).alias("member"),
            "id",
            "linked",
        )
    )
    rest = (
        refused.unionByName(streamed)
        .join(sketches, "id")
        .repartition("bucket", "chunk")
        .sortWithinPartitions("bucket", "chunk", "member", "id")
        .mapInArrow(_refused_partners, "a long, b long")
    )
    return components(accepted.unionByName(rest))


def link_sets(ids: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between sets, over the whole sets.

    Sets linked with the first one need no comparison among themselves. The others are
    counted against all by the places of their shingles.
    """
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    sizes = np.array([len(s) for s in sets])
    _values, places = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(places, kind="stable")
    owners = owner[order]
    begin = np.searchsorted(places[order], np.arange(places.max() + 2))
    ends = np.cumsum(sizes)
    links = []
    for k in range(len(sets)):
        if k and find(k) == find(0):
            continue
        mine = places[ends[k] - sizes[k] : ends[k]]
        counts = begin[mine + 1] - begin[mine]
        at = np.repeat(begin[mine] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        common = np.bincount(owners[at], minlength=len(sets))
        for other in np.flatnonzero(100 * common >= percent * (sizes + sizes[k] - common)):
            a, b = find(k), find(int(other))
            if a != b:
                parent[a] = b
                links.append((ids[k], ids[int(other)]))
    return links


def _verified(rule: Rule):
    def groups(batches):
        """Whole groups (family, block, block) from rows sorted by them."""
        at, ids, sets = None, [], []
        for batch in batches:
            keys = list(
                zip(*(batch.column(c).to_pylist() for c in ("family", "block_a", "block_b")), strict=True)
            )
            words = word_codes(batch.column("text"))
            for k, (key, doc) in enumerate(zip(keys, batch.column("doc_id").to_pylist(), strict=True)):
                if key != at:
                    if len(ids) > 1:
                        yield ids, sets
                    at, ids, sets = key, [], []
                ids.append(doc)
                sets.append(shingle_set(words.of(k), rule.shingle))
        if len(ids) > 1:
            yield ids, sets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sets in groups(batches):
            links = link_sets(ids, sets, rule.percent)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"]
            )

    return run


def near_duplicates(documents: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``documents``.

    Needs columns doc_id (long) and text; further columns, of whatever names, are not read.
    NULL, empty and blank texts have no shingles and link with nothing. A row with a NULL
    doc_id is its own component, named NULL, and is kept. Rows that repeat a doc_id are
    nodes of that one id. An empty table gives an empty table.
    """
    small_batches(documents.sparkSession)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = settle(docs.mapInArrow(_features(rule.shingle), _FEATURES), "features")
    sets = found.where("n_shingles > 0 and doc_id is not null")
    key = ["set_low", "set_high", "n_shingles"]
    classes = settle(
        sets.groupBy(*key).agg(
            F.min("doc_id").alias("id"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")
        ),
        "classes",
    )
    families = settle(_families(classes), "families").join(
        classes.select(F.col("id").alias("node"), "n_shingles"), "node"
    )
    blocks = families.groupBy("component").agg(
        F.ceil(F.sum("n_shingles") / FAMILY_SHINGLES).cast("int").alias("blocks")
    )
    placed = families.join(blocks, "component").select(
        F.col("component").alias("family"),
        F.col("node").alias("doc_id"),
        "blocks",
        F.pmod(F.xxhash64("node"), "blocks").cast("int").alias("block"),
    )
    compared = placed.select(
        "family",
        "doc_id",
        "block",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
    ).select(
        "family",
        "doc_id",
        F.least("block", "other").alias("block_a"),
        F.greatest("block", "other").alias("block_b"),
    )
    texts = (
        docs.join(placed.select("doc_id"), "doc_id", "left_semi")
        .withColumn("same", F.xxhash64("text"))
        .dropDuplicates(["doc_id", "same"])
        .drop("same")
    )
    links = (
        compared.join(texts, "doc_id")
        .repartition("family", "block_a", "block_b")
        .sortWithinPartitions("family", "block_a", "block_b", "doc_id")
        .mapInArrow(_verified(rule), "a long, b long")
    )
    joined = components(links)
    named = classes.join(joined, classes.id == joined.node, "left").select(
        *(F.col(k).alias(f"class_{k}") for k in key), F.coalesce("component", "id").alias("component")
    )
    on = [F.col(k) == F.col(f"class_{k}") for k in key] + [F.col("doc_id").isNotNull()]
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(
        F.least("component", "doc_id")
    )
    return (
        found.select("doc_id", *key)
        .join(named, on, "left")
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def drop_near_duplicates(documents: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The rows of ``documents`` that stand for their group, all columns as given.

    One row per kept doc_id stays, the least by its text; rows without doc_id stay. Every
    other column is passed on unread.
    """
    kept = near_duplicates(documents, rule).where("kept and doc_id is not null").select("doc_id").distinct()
    rows = documents.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("key"))
    one = rows.where("key is not null").join(kept.withColumnRenamed("doc_id", "key"), "key", "left_semi")
    single = one.groupBy("key").agg(F.min_by("row", F.coalesce("row.text", F.lit(""))).alias("row"))
    return single.select("row.*").unionByName(rows.where("key is null").select("row.*"))
