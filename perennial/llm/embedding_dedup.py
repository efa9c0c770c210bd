"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

Iterative quantisation (ITQ) learns on a bounded sample a rotation of the principal axes
under which the signs of the coordinates are balanced and lose little. The signs are a
code of 64 bits. Codes are indexed in four tables, one per quarter of the code; two vectors
meet in a table if their quarters are within two bits, so every pair of codes within eleven
bits of each other meets. Pairs that meet are held against the codes, then the cosine of
the original vectors decides.

The codes are of centred vectors, the cosine is not: the stronger the direction that all
vectors share, the more bits a pair of the same cosine differs in. So the recall is measured
when the codes are fitted, on partners made at the least cosine for vectors of the sample,
and further codes from other rotations are added, four tables each, until it is reached.

A pair is proposed by the first table in which it meets and by that one alone. Equal
vectors of a label are one class before anything is paired, so a vector that a third of
all rows repeat is one entry of the index.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perennial.llm.components import components
from perennial.llm.shared import settle

TABLES = 4
TABLE_BITS = 16
_MASK = (1 << TABLE_BITS) - 1


@dataclass(frozen=True)
class Itq:
    """Fit on at most about ``sample`` vectors, whatever the size of the table."""

    sample: int = 20_000
    rounds: int = 50
    seed: int = 7
    min_cosine: float = 0.93
    # Cosine 0.93 differs in 12% of the bits, 7.7 +- 2.6 of 64; unrelated codes in half. Where
    # a common direction makes pairs differ in more, the bound follows what was measured.
    max_differing: int = 26
    min_recall: float = 0.995
    measured: int = 4000  # partners made for the measurement
    # Beyond so many codes the vectors are coded as given: near all of a label meet then.
    max_codes: int = 40


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    projections: list[np.ndarray]  # one per code, dimensions x bits
    max_differing: int  # of the bits of all codes
    recall: float  # of the partners made


def rotations(vectors: np.ndarray, mean: np.ndarray, bits: int, rounds: int, seed: int) -> Iterator[np.ndarray]:
    """Projections (dimensions x bits) for sign codes, each from starts of its own.

    With fewer dimensions than bits, further rotations fill the code.
    """
    centred = vectors - mean
    _values, axes = np.linalg.eigh(centred.T @ centred)
    axes = axes[:, ::-1][:, :bits]
    projected = centred @ axes
    random = np.random.default_rng(seed)
    width = axes.shape[1]
    while True:
        found = []
        while width * len(found) < bits:
            rotation, _r = np.linalg.qr(random.standard_normal((width, width)))
            for _round in range(rounds):
                signs = np.where(projected @ rotation >= 0, 1.0, -1.0)
                left, _s, right = np.linalg.svd(signs.T @ projected)
                rotation = (left @ right).T
            found.append(axes @ rotation)
        yield np.concatenate(found, axis=1)[:, :bits]


def partners(vectors: np.ndarray, mean: np.ndarray, cosine: float, seed: int) -> np.ndarray:
    """For each unit vector another one at the given cosine, turned towards a third one drawn
    from the rest. Both lean alike towards the mean, which leaves centred codes the least
    to go by."""
    length = np.linalg.norm(mean)
    common = mean / length if length > 1e-9 else np.zeros_like(mean)
    shared = vectors @ common
    own = vectors - shared[:, None] * common
    across = np.random.default_rng(seed).permutation(vectors) - mean
    for axis in (np.broadcast_to(common, own.shape), _unit_or_zero(own)):
        across = across - (across * axis).sum(axis=1, keepdims=True) * axis
    radius = np.linalg.norm(own, axis=1)
    inner = (cosine - shared**2) / np.maximum(radius**2, 1e-12)
    inner = np.clip(inner, -1.0, 1.0)[:, None]
    turned = inner * _unit_or_zero(own) + np.sqrt(1 - inner * inner) * _unit_or_zero(across)
    return shared[:, None] * common + radius[:, None] * turned


def _unit_or_zero(rows: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, lengths, out=np.zeros_like(rows), where=lengths > 1e-9)


def fit(vectors: np.ndarray, params: Itq) -> Model:
    """Codes that find ``min_recall`` of the partners at the least cosine."""
    some = vectors[:: max(1, len(vectors) // params.measured)][: params.measured]
    bits = TABLES * TABLE_BITS
    mean = vectors.mean(axis=0)
    others = partners(some, mean, params.min_cosine, params.seed)
    found, met = [], np.zeros(len(some), dtype=bool)
    differing = np.zeros(len(some))
    for projection in rotations(vectors, mean, bits, params.rounds, params.seed):
        found.append(projection)
        apart = sign_codes(some, mean, projection) ^ sign_codes(others, mean, projection)
        quarters = [np.bitwise_count((apart >> np.uint64(TABLE_BITS * k)) & np.uint64(_MASK)) for k in range(TABLES)]
        met |= np.min(quarters, axis=0) <= 2
        differing += np.sum(quarters, axis=0)
        if met.mean() >= params.min_recall or len(found) == params.max_codes:
            break
    if met.mean() < params.min_recall:
        nothing = np.zeros_like(mean)
        plain = next(rotations(vectors, nothing, bits, params.rounds, params.seed))
        return Model(nothing, [plain], bits, 1.0)
    bound = max(params.max_differing * len(found), int(np.ceil(differing.mean() + 6 * differing.std())))
    return Model(mean, found, bound, float(met.mean()))


def sign_codes(vectors: np.ndarray, mean: np.ndarray, projection: np.ndarray) -> np.ndarray:
    signs = (vectors - mean) @ projection >= 0
    padded = np.zeros((len(vectors), TABLES * TABLE_BITS), dtype=np.uint8)
    # Deal the bits out in turn, so that no table holds only the weakest axes.
    order = np.argsort(np.arange(signs.shape[1]) % TABLES, kind="stable")
    slots = np.sort(np.arange(padded.shape[1]) % TABLES * TABLE_BITS + np.arange(padded.shape[1]) // TABLES)
    padded[:, slots[: signs.shape[1]]] = signs[:, order]
    return np.packbits(padded, axis=1).view(">u8").astype(np.uint64).ravel()


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _code_names(n: int) -> list[str]:
    return [f"code{k}" for k in range(n)]


def _coded(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = model.value
        names = ["id", *_code_names(len(fitted.projections))]
        for batch in batches:
            vectors = _unit(_matrix(batch.column("vector")))
            codes = [pa.array(sign_codes(vectors, fitted.mean, p).view(np.int64)) for p in fitted.projections]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *codes], names=names)

    return run


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True) if rows.size else rows


def _reranked(min_cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = _matrix(batch.column("va")), _matrix(batch.column("vb"))
            norms = np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1))
            near = (a * b).sum(axis=1) / norms >= min_cosine
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(pa.array(near)), batch.column("b").filter(pa.array(near))],
                names=["a", "b"],
            )

    return run


def _quarter(column: str, k: int):
    return F.shiftrightunsigned(column, TABLE_BITS * k).bitwiseAND(F.lit(_MASK))


def candidates(codes: DataFrame, n_codes: int, max_differing: int) -> DataFrame:
    """(a, b), a < b, of equal label and dimension whose codes meet in some table.

    Both vectors are entered under their quarter and all values one bit away, so quarters
    within two bits share an entry: 17 entries a table and vector instead of the 137 that
    one side alone would have to look up. Of the entries a pair shares, one counts.
    """
    names = _code_names(n_codes)
    places = [(name, k) for name in names for k in range(TABLES)]
    near = F.array(F.lit(0).cast("long"), *(F.lit(1 << bit).cast("long") for bit in range(TABLE_BITS)))
    tables = F.array(
        *(F.struct(F.lit(t).alias("t"), _quarter(name, k).alias("own")) for t, (name, k) in enumerate(places))
    )
    entries = (
        codes.select("label", "dim", "id", *names, F.explode(tables).alias("entry"))
        .select("label", "dim", "id", *names, "entry.t", "entry.own", F.explode(near).alias("change"))
        .withColumn("value", F.col("own").bitwiseXOR(F.col("change")))
        .drop("change")
    )
    key = ["label", "dim", "t", "value"]

    def side(end: str) -> DataFrame:
        own = [F.col(name).alias(f"{name}_{end}") for name in names]
        return entries.select(*key, F.col("id").alias(end), *own, F.col("own").alias(f"own_{end}"))

    a, b = side("a"), side("b")
    on = [a[k] == b[k] for k in key]
    apart = F.col("own_a").bitwiseXOR(F.col("own_b"))
    lowest = apart.bitwiseAND(-apart)
    one_way = F.col("own_a").bitwiseXOR(lowest)
    other_way = F.col("own_b").bitwiseXOR(lowest)
    # Equal quarters share all entries, others two: their own if they differ in one bit, the
    # two between them if they differ in two.
    counts = F.when(apart == 0, a["value"] == F.col("own_a")).otherwise(a["value"] == F.least(one_way, other_way))
    differs = {name: F.col(f"{name}_a").bitwiseXOR(F.col(f"{name}_b")) for name in names}
    first = F.lit(True)
    for t, (name, k) in enumerate(places[:-1]):
        missed = F.bit_count(F.shiftrightunsigned(differs[name], TABLE_BITS * k).bitwiseAND(F.lit(_MASK)))
        first = first & ((a["t"] <= t) | (missed > 2))
    differing = sum((F.bit_count(d) for d in differs.values()), start=F.lit(0))
    meets = (F.col("a") < F.col("b")) & counts & (differing <= max_differing) & first
    # The entries are many times the codes, which the optimizer's estimate does not see.
    return a.hint("merge").join(b, [*on, meets]).select("a", "b")


def near_vectors(embeddings: DataFrame, params: Itq = Itq()) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``embeddings``.

    Needs vec_id (long), embedding (array of numbers) and label; further columns are not
    read. Vectors that are NULL, empty, zero or hold NULL or non-finite components, and
    those of NULL label, link with nothing; so do vectors of different length or label. A
    row with a NULL vec_id links with nothing, counts for nothing and is kept. An empty
    table gives an empty table. Rows that repeat a vec_id count as vectors of their own.
    """
    spark = embeddings.sparkSession
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )
    finite = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    ) & F.exists("vector", lambda x: x != 0)
    usable = F.coalesce(finite, F.lit(False)) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    # Scaled by its largest component, no finite vector over- or underflows.
    largest = F.aggregate("vector", F.lit(0.0), lambda m, x: F.greatest(m, F.abs(x)))
    rows = settle(
        rows.select(
            "vec_id",
            F.when(usable, F.col("label")).alias("label"),
            F.when(usable, F.transform("vector", lambda x: x / largest)).alias("vector"),
        ),
        "vectors",
    )
    classes = settle(
        rows.where("vector is not null")
        .groupBy("label", "vector")
        .agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies"))
        .withColumn("dim", F.size("vector")),
        "classes",
    )
    found = []
    for dim in [r.dim for r in classes.select("dim").distinct().collect()]:
        found.append(_linked(spark, classes.where(F.col("dim") == dim), params))
    links = None
    for part in found:
        links = part if links is None else links.unionByName(part)
    if links is None:
        links = spark.createDataFrame([], "a long, b long")
    links = settle(links, "links")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    copies = classes.select(F.col("id").alias("b"), F.col("copies").alias("others"))
    degrees = both.join(copies, "b").groupBy("a").agg(F.sum("others").alias("others"))
    joined = components(links)
    named = (
        classes.join(degrees, classes.id == degrees.a, "left")
        .join(joined, classes.id == joined.node, "left")
        .select(
            "label",
            "vector",
            (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
            F.coalesce("component", "id").alias("component"),
        )
    )
    return (
        rows.join(named, ["label", "vector"], "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )


def _linked(spark, classes: DataFrame, params: Itq) -> DataFrame:
    """Links between classes of one dimension, original vectors compared."""
    total = classes.count()
    sample = classes.select("vector")
    if total > params.sample:
        sample = sample.where(F.pmod(F.xxhash64("vector"), F.lit(1 << 30)) < (1 << 30) * params.sample / total)
    fitted = fit(_unit(_matrix(sample.toArrow().column("vector"))), params)
    model, n_codes = spark.sparkContext.broadcast(fitted), len(fitted.projections)
    vectors = classes.select("id", "vector")
    schema = ", ".join(f"{name} long" for name in ["id", *_code_names(n_codes)])
    codes = classes.select("id", "vector").mapInArrow(_coded(model), schema)
    keyed = settle(codes.join(classes.select("id", "label", "dim"), "id"), "codes")
    return (
        candidates(keyed, n_codes, fitted.max_differing)
        .join(vectors.select(F.col("id").alias("a"), F.col("vector").alias("va")), "a")
        .join(vectors.select(F.col("id").alias("b"), F.col("vector").alias("vb")), "b")
        .select("a", "b", "va", "vb")
        .mapInArrow(_reranked(params.min_cosine), "a long, b long")
    )


def drop_near_vectors(embeddings: DataFrame, params: Itq = Itq()) -> DataFrame:
    """The rows of ``embeddings`` that are kept, all columns as given."""
    kept = near_vectors(embeddings, params).where("kept").select(F.col("vec_id").alias("key")).distinct()
    rows = embeddings.select(F.struct("*").alias("row"), F.col("vec_id").cast("long").alias("key"))
    return rows.join(kept, rows.key.eqNullSafe(kept.key), "left_semi").select("row.*")
