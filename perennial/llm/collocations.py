"""Phrases of two to four words from a weighted de Bruijn graph.

Texts are cut into pieces at punctuation and line ends. The words of a piece are a walk in a
graph whose nodes are three words in a row and whose edges are four: an edge leads from its
first three words to its last three. Only edges are counted over the corpus, and the shorter
ends of pieces, which are no edges: the last three words of a piece, the last two, and the
last one. A shorter phrase is counted by what flows through its node,

    count(phrase) = sum of the edges that begin with it + pieces that end with it

from four words to three, from three to two, from two to one.

Few pairs of words occur ``min_count`` times, and no phrase that holds another pair can be
a candidate. Counting the pairs by hash in a table of fixed size, whose cells are never less
than a pair's count, shows most of the others; there a walk is cut, as at the end of a piece.
Counts of candidates and of their parts are not changed by that.

Among the frequent edges, a node that is entered by one edge and left by one, with the
node's own count, is a mere point of a path. Paths are compacted to one row each, by doubling
pointers from edge to edge, so a passage of n words takes about log n rounds. Their inner
nodes have the count of the path and are never candidates, as the path's edges hold them as
often; the other nodes, where paths meet, are judged by the edges in and out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from perennial.llm.shared import drop_settled, settle, small_batches
from perennial.llm.wordcodes import _LOWER, mix, slices, span_codes, text_bytes

LONGEST = 4
# Bytes that end a piece, bytes between words.
BREAKS = b".,;:!?\n\x0b\x0c\r"
SPACES = b" \t"
NO_LANG = "und"

_KIND = np.zeros(256, dtype=np.uint8)
_KIND[list(SPACES)] = 1
_KIND[list(BREAKS)] = 2
_FIRST, _SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_TEXT_BYTES = 1 << 20  # of texts handled at a time
_TASKS = 256


@dataclass(frozen=True)
class Collocations:
    min_count: int = 30
    cover_percent: int = 80
    top: int = 2000
    # Cells of the table of pairs; one byte each in a task, one bit each when sent around.
    cell_bits: int = 25
    slice_bits: int = 16


# ----------------------------------------------------------------- words and walks


class Walks:
    """The words of some texts, with the place of every break between them."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        data, offsets = text_bytes(texts)
        self.data = _LOWER[data]
        kind = _KIND[self.data]
        inside = kind == 0
        before = np.zeros(len(inside), dtype=bool)  # a word goes on from the byte before
        before[1:] = inside[:-1]
        inner = offsets[1:-1]
        before[inner[inner < len(data)]] = False
        self.starts = np.flatnonzero(inside & ~before)
        after = np.zeros(len(inside), dtype=bool)
        after[:-1] = inside[1:] & before[1:]
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.owner = np.searchsorted(offsets, self.starts, side="right") - 1
        n = len(self.starts)
        # Whether a word is followed by another one of its piece.
        self.linked = np.zeros(n, dtype=bool)
        if n > 1:
            breaks = np.concatenate([[0], np.cumsum(kind == 2)])
            self.linked[:-1] = (breaks[self.starts[1:]] == breaks[self.ends[:-1]]) & (self.owner[1:] == self.owner[:-1])
        salts = {}
        for lang in langs.to_pylist():
            salts.setdefault(lang, xxhash.xxh64_intdigest(lang.encode()))
        salt = np.array([salts[lang] for lang in langs.to_pylist()], dtype=np.uint64)
        codes = span_codes(self.data, self.starts, self.ends)
        self.pairs = np.zeros(n, dtype=np.uint64)
        if n > 1:
            self.pairs[:-1] = mix(codes[:-1] * _FIRST + codes[1:] * _SECOND + salt[self.owner[:-1]])

    def cells(self, cell_bits: int) -> np.ndarray:
        return (self.pairs >> np.uint64(64 - cell_bits)).astype(np.int64)

    def sizes(self, linked: np.ndarray) -> np.ndarray:
        """How many words, up to the longest phrase, follow from each word by links, itself included."""
        sizes = np.ones(len(linked), dtype=np.int64)
        going = linked.copy()
        for step in range(1, LONGEST):
            sizes += going
            going[:-step] &= linked[step:]
            going[-step:] = False
        return sizes

    def grams(self, sizes: np.ndarray) -> pa.Array:
        """The words from each place on, as many as ``sizes`` says, with one space between."""
        n = len(sizes)
        lengths = self.ends - self.starts
        clean_starts = np.cumsum(lengths + 1) - (lengths + 1)
        total = int((lengths + 1).sum())
        source = np.repeat(self.starts - clean_starts, lengths + 1) + np.arange(total)
        clean = self.data[np.minimum(source, len(self.data) - 1)]
        clean_ends = clean_starts + lengths
        clean[clean_ends] = 0x20
        spans = clean_ends[np.arange(n) + sizes - 1] - clean_starts
        offsets = np.concatenate([[0], np.cumsum(spans)])
        gather = np.repeat(clean_starts - offsets[:-1], spans) + np.arange(offsets[-1])
        return pa.LargeStringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(clean[gather]))


def _walks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Walks]]:
    for batch in batches:
        for part in slices(batch, limit=_TEXT_BYTES):
            walks = Walks(part.column("text"), part.column("lang"))
            if len(walks.starts):
                yield part, walks


# --------------------------------------------------------- which pairs may be frequent


def _pair_cells(params: Collocations):
    """One task's counts of pairs by cell, no cell above ``min_count``, in slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, task = np.zeros(1 << params.cell_bits, dtype=np.uint8), TaskContext.get().partitionId()
        for _part, walks in _walks(batches):
            found, times = np.unique(walks.cells(params.cell_bits)[walks.linked], return_counts=True)
            cells[found] = np.minimum(cells[found] + np.minimum(times, params.min_count), params.min_count)
        size = 1 << params.slice_bits
        for number in range(len(cells) // size):
            held = cells[number * size : (number + 1) * size]
            if held.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int32()), pa.array([task // _TASKS], pa.int32()), pa.array([held.tobytes()])],
                    names=["slice", "tasks", "cells"],
                )

    return run


def _summed_cells(params: Collocations, last: bool):
    """Adds up the slices that a task gets; the last round marks the cells that reach ``min_count``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, held in zip(batch.column("slice").to_pylist(), batch.column("cells"), strict=True):
                part = np.frombuffer(held.as_buffer(), dtype=np.uint8)
                known = sums.get(number)
                sums[number] = part if known is None else np.minimum(known + part, params.min_count)
        for number, held in sums.items():
            held = np.packbits(held >= params.min_count) if last else held
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([held.tobytes()])], names=["slice", "cells"])

    return run


def frequent_cells(texts: DataFrame, params: Collocations = Collocations()) -> np.ndarray:
    """One bit per cell of pairs: whether its pairs may reach ``min_count`` together.

    2 ** cell_bits bits whatever the size of the table (4 MB), which is what the driver gets
    and sends around. Tasks are added up ``_TASKS`` at a time, then those sums.
    """
    if params.min_count > 127:
        raise ValueError("cells of one byte hold counts up to 127")
    slices_ = 1 << (params.cell_bits - params.slice_bits)
    counted = texts.mapInArrow(_pair_cells(params), "slice int, tasks int, cells binary")
    some = counted.repartition("slice", "tasks").mapInArrow(_summed_cells(params, False), "slice int, cells binary")
    marked = some.repartition(slices_, "slice").mapInArrow(_summed_cells(params, True), "slice int, cells binary")
    bits = np.zeros((slices_, (1 << params.slice_bits) // 8), dtype=np.uint8)
    for row in marked.collect():
        bits[row["slice"]] = np.frombuffer(row["cells"], dtype=np.uint8)
    return bits.reshape(-1)


# ------------------------------------------------------------------------ the graph


def _edges(sent, params: Collocations):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sent.value
        for part, walks in _walks(batches):
            cells = walks.cells(params.cell_bits)
            frequent = (bits[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8)) & 1
            sizes = walks.sizes(walks.linked & (frequent == 1))
            yield pa.RecordBatch.from_arrays(
                [part.column("lang").take(pa.array(walks.owner)), pa.array(sizes, pa.int32()), walks.grams(sizes).cast(pa.string())],
                names=["lang", "size", "phrase"],
            )

    return run


def _words(phrase: str, n) -> Column:
    """The first ``n`` words of a phrase, or the last ones if ``n`` is negative."""
    return F.call_function("substring_index", F.col(phrase), F.lit(" "), n if isinstance(n, Column) else F.lit(n))


@dataclass
class Graph:
    """``flows`` (lang, size, phrase, n): frequent edges (four words) and nodes' counts.
    ``words`` (lang, n): all words of a language. ``nodes`` (lang, size, phrase, a, most_in,
    most_out): phrases with their largest edge in and out."""

    flows: DataFrame
    words: DataFrame
    nodes: DataFrame


def de_bruijn_graph(documents: DataFrame, params: Collocations = Collocations()) -> Graph:
    small_batches(documents.sparkSession, 500)
    texts = documents.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"), F.col("text").cast("string").alias("text")
    ).where(F.length("text") > 0)
    sent = documents.sparkSession.sparkContext.broadcast(frequent_cells(texts, params))
    keys = ["lang", "size", "phrase"]
    counted = texts.mapInArrow(_edges(sent, params), "lang string, size int, phrase string")
    edges = settle(counted.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), "edges")
    sent.unpersist()
    words = settle(edges.groupBy("lang").agg(F.sum("n").alias("n")), "words")
    levels = [edges.where(F.col("size") == LONGEST)]
    settled = []
    for size in range(LONGEST - 1, 0, -1):
        through = levels[-1].select("lang", F.lit(size).alias("size"), _words("phrase", size).alias("phrase"), "n")
        ended = edges.where(F.col("size") == size)
        flow = settle(through.unionByName(ended).groupBy(*keys).agg(F.sum("n").alias("n")), "flow")
        levels.append(flow)
        settled.append(flow)
    frequent = [level.where(F.col("n") >= params.min_count) for level in levels]
    flows = frequent[0]
    for level in frequent[1:]:
        flows = flows.unionByName(level)
    flows = settle(flows, "flows")
    for frame in (edges, *settled):
        drop_settled(frame)
    # The edges out of a phrase begin with it, the edges into it end with it.
    none = F.lit(0).cast("long")
    out = F.struct(_words("phrase", F.col("size") - 1).alias("phrase"), F.col("n").alias("out"), none.alias("into"))
    into = F.struct(_words("phrase", 1 - F.col("size")).alias("phrase"), none.alias("out"), F.col("n").alias("into"))
    longer = flows.where("size > 2").select("lang", F.explode(F.array(out, into)).alias("e"))
    ends = longer.groupBy("lang", F.col("e.phrase").alias("phrase")).agg(
        F.max("e.into").alias("most_in"), F.max("e.out").alias("most_out")
    )
    nodes = (
        flows.where("size > 1")
        .withColumnRenamed("n", "a")
        .join(ends, ["lang", "phrase"], "left")
        .select("lang", "size", "phrase", "a", F.coalesce("most_in", F.lit(0)).alias("most_in"), F.coalesce("most_out", F.lit(0)).alias("most_out"))
    )
    return Graph(flows, words, settle(nodes, "nodes"))


def _inner() -> Column:
    """Points of a path: all of a node's walks come by one edge and leave by one."""
    return (F.col("size") == LONGEST - 1) & (F.col("most_in") == F.col("a")) & (F.col("most_out") == F.col("a"))


def unary_paths(graph: Graph) -> DataFrame:
    """(lang, words, n): every maximal path of edges without a branch, as its words, and how
    often it occurs; an edge that no point joins to another is a path of four words.

    A walk that enters a path goes on to its end, so a path is no longer than the longest
    text, and no path is a cycle.
    """
    edges = graph.nodes.where(F.col("size") == LONGEST).select("lang", F.col("phrase").alias("edge"), F.col("a").alias("n"))
    ends = edges.select(
        "lang", "edge", _words("edge", LONGEST - 1).alias("tail"), _words("edge", 1 - LONGEST).alias("head")
    )
    inner = graph.nodes.where(_inner()).select("lang", F.col("phrase").alias("node"))
    entered = ends.join(inner, (F.col("head") == F.col("node")) & (ends["lang"] == inner["lang"]), "left_semi")
    left = ends.join(inner, (F.col("tail") == F.col("node")) & (ends["lang"] == inner["lang"]), "left_semi")
    links = settle(
        left.select("lang", "edge", F.col("tail").alias("node")).join(
            entered.select("lang", F.col("edge").alias("up"), F.col("head").alias("node")), ["lang", "node"]
        ).select("lang", "edge", "up", F.lit(1).cast("long").alias("steps")),
        "links",
    )
    # Double the pointers of edges that have an edge before them, until all point to a first one.
    now, open_ = links, links.count()
    while open_:
        further = now.select("lang", F.col("edge").alias("up"), F.col("up").alias("far"), F.col("steps").alias("more"))
        after = settle(
            now.join(further, ["lang", "up"], "left").select(
                "lang", "edge", F.coalesce("far", "up").alias("up"),
                (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"), F.col("far").isNotNull().alias("moved"),
            ),
            "links",
        )
        open_ = after.where("moved").count()
        if now is not links:
            drop_settled(now)
        now = after.drop("moved")
    placed = edges.join(now, ["lang", "edge"], "left").select(
        "lang", F.coalesce("up", "edge").alias("first"), F.coalesce("steps", F.lit(0)).alias("steps"), "n",
        _words("edge", -1).alias("word"),
    )
    rows = placed.groupBy("lang", "first").agg(
        F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("steps", "word"))).alias("added")
    )
    further = F.transform(F.filter("added", lambda x: x["steps"] > 0), lambda x: x["word"])
    return rows.select("lang", F.concat(F.split("first", " "), further).alias("words"), "n")


def candidates(graph: Graph, paths: DataFrame, params: Collocations = Collocations()) -> DataFrame:
    """(lang, phrase, size, a) of phrases that no longer one holds nearly as often."""
    fours = paths.select(
        "lang",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.size("words") - LONGEST + 1),
                lambda k: F.array_join(F.slice("words", k, LONGEST), " "),
            )
        ).alias("phrase"),
        F.lit(LONGEST).alias("size"),
        F.col("n").alias("a"),
    )
    covered = 100 * F.greatest("most_in", "most_out") >= params.cover_percent * F.col("a")
    shorter = graph.nodes.where((F.col("size") < LONGEST) & ~_inner() & ~covered)
    return fours.unionByName(shorter.select("lang", "phrase", "size", "a"))


def scored(graph: Graph, found: DataFrame) -> DataFrame:
    """Add l, r and score of the lowest-scoring cut to (lang, phrase, size, a)."""
    count = F.col("size")
    cuts = found.withColumn("k", F.explode(F.sequence(F.lit(1), count - 1)))
    parts = cuts.select(
        "lang", F.col("phrase").alias("whole"), "a", "k",
        F.explode(
            F.array(
                F.struct(F.lit(True).alias("left"), _words("phrase", F.col("k")).alias("phrase")),
                F.struct(F.lit(False).alias("left"), _words("phrase", F.col("k") - count).alias("phrase")),
            )
        ).alias("part"),
    )
    known = graph.flows.where(F.col("size") < LONGEST).select("lang", F.col("phrase").alias("sought"), "n")
    met = parts.select("lang", "whole", "a", "k", "part.left", F.col("part.phrase").alias("sought")).join(known, ["lang", "sought"])
    halves = met.groupBy("lang", "whole", "a", "k").agg(
        F.max(F.when(F.col("left"), F.col("n"))).alias("l"), F.max(F.when(~F.col("left"), F.col("n"))).alias("r")
    )
    # Whole-number division of decimals: products may pass 64 bits.
    score = F.expr("cast(a as decimal(20,0)) * 2000000 div (cast(l as decimal(20,0)) + r)")
    best = halves.withColumn("score", score).groupBy("lang", F.col("whole").alias("phrase"), "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )
    return best.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def collocations(documents: DataFrame, params: Collocations = Collocations()) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language.

    Needs text and lang; further columns are not read. Texts are lower-cased (A-Z). NULL and
    empty texts have no words, NULL languages are ``und``, the same as that word. Repeated
    rows count as often as they occur. Equal scores are ranked by count, then by the phrase's
    bytes. An empty table gives an empty table.
    """
    graph = de_bruijn_graph(documents, params)
    paths = unary_paths(graph)
    found = scored(graph, candidates(graph, paths, params)).withColumn("deal", F.pmod(F.hash("phrase"), F.lit(64)))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # The best of each deal first, so that a language of very many phrases is no one task.
    for keys in (["lang", "deal"], ["lang"]):
        found = found.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(
            F.col("rank") <= params.top
        )
    return found.join(graph.words, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
