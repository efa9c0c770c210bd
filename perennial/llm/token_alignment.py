"""Alignment of the tokens of two tokenizers by merge-path partitioning.

Both tokenizers cut the same bytes, so each gives a rising list of byte offsets where its
tokens end. Where both lists hold the same offset, a group of tokens ends: a group is the
least run of A tokens and of B tokens over the same bytes.

Groups come from merging the two lists. The ends of all texts of a batch are two lists over
one axis of bytes, in which every text's end is common. The merge is a path through a grid
of A ends by B ends; diagonals at equal distances cut it into pieces of equal work, and
where the path crosses a diagonal is found by a binary search that needs nothing but the
two lists. So a long text is many pieces and many short ones are one. Each piece finds the
common ends inside it by itself; an end whose A half closes one piece and whose B half opens
the next is found by looking at the two sides of the cut, which stitches the group together.

How many texts hold a pair of ids linked is counted over the whole table. The counts go back
to the texts in two ways: those of at least total / ``hot_pairs`` texts, of which there
cannot be more than ``hot_pairs``, are sent to every task; texts join the others by a shuffle,
in which no pair has more rows than that. The largest count of each A id is one number
per id of the vocabulary.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perennial.llm.shared import settle, small_batches
from perennial.llm.token_packing import _WIDE_SPACE
from perennial.llm.wordcodes import slices, span_codes, text_bytes, word_spans

_DIGITS = 10
_RUN_BYTES = 1 << 16


@dataclass(frozen=True)
class Alignment:
    byte_level: str = "/opt/tokenizers/byte_bpe_50k.json"
    pieces: str = "/opt/tokenizers/piece_bpe_32k.model"
    piece_work: int = 1 << 14  # ends that a piece of the merge holds
    cached_words: int = 1 << 19
    hot_pairs: int = 1 << 20
    block_pairs: int = 1 << 20


# ------------------------------------------------------------------- tokens


def _byte_of_letter() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable ones for
    themselves, the others for letters from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Tokenizers:
    """Both tokenizers, and what they gave for the parts of texts seen so far."""

    def __init__(self, byte_level: bytes, pieces: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_str(byte_level.decode("utf-8"))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        letters = _byte_of_letter()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, number in self.a.get_vocab().items():
            known = all(c in letters for c in token)
            self.a_bytes[number] = bytes(letters[c] for c in token) if known else token.encode()
        self.b_bytes = []
        for number in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(number)
            self.b_bytes.append(
                bytes([int(piece[3:5], 16)]) if self.b.is_byte(number) else piece.replace("▁", " ").encode()
            )
        self.a_sizes = np.array([len(b) for b in self.a_bytes], dtype=np.int64)
        self.b_sizes = np.array([len(b) for b in self.b_bytes], dtype=np.int64)
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.same = np.zeros(0, dtype=bool)
        self.ids = [np.zeros(0, dtype=np.int32)] * 2  # of A and of B, part after part
        self.first = [np.zeros(1, dtype=np.int64)] * 2

    def places(self, parts: list[bytes]) -> np.ndarray:
        """Where ``ids`` and ``same`` hold each of some different parts."""
        new = [p for p in parts if p not in self.known]
        if new:
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
            a, a_counts, b, b_counts, same = self._encoded(new)
            self.same = np.concatenate([self.same, same])
            for k, (ids, counts) in enumerate(((a, a_counts), (b, b_counts))):
                self.ids[k] = np.concatenate([self.ids[k], ids.astype(np.int32)])
                self.first[k] = np.concatenate([self.first[k], self.first[k][-1] + np.cumsum(counts)])
        return np.fromiter((self.known[p] for p in parts), np.int64, len(parts))

    def _both(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """What each tokenizer gives for texts that begin with white space.

        B puts a space before what it is given. One that is there is left out for that; other
        white space gets a line end before it, which B joins with nothing, and both are taken
        off again.
        """
        of_a = [np.array(e.ids, dtype=np.int64) for e in self.a.encode_batch(texts, add_special_tokens=False)]
        of_b = self.b.encode([t[1:] if t[0] == " " else "\n" + t for t in texts], num_threads=1)
        # Nothing is what B gives for the one space that it puts before nothing.
        of_b = [[self.b.piece_to_id("▁")] if t == " " else b if t[0] == " " else b[2:] for t, b in zip(texts, of_b, strict=True)]
        return of_a, [np.array(b, dtype=np.int64) for b in of_b]

    def _encoded(self, parts: list[bytes]):
        """Ids and their numbers for A and B, and whether both give back the part's bytes.

        Parts that end in a sign are encoded many in a row, as the white space that each begins
        with ends the tokens before it, and told apart by their bytes.
        """
        texts = [p.decode("utf-8") for p in parts]
        runs, at = [], 0
        while at < len(parts):
            to, size = at, 0
            while to < len(parts) and size < _RUN_BYTES and not texts[to][-1].isspace() and "▁" not in texts[to]:
                size += len(parts[to])
                to += 1
            runs.append((at, max(to, at + 1)))
            at = max(to, at + 1)
        joined = ["".join(texts[p:q]) for p, q in runs]
        out = [[], [], [], [], []]
        for (p, q), text, a, b in zip(runs, joined, *self._both(joined), strict=True):
            given = text.encode()
            ends = np.cumsum([len(x) for x in parts[p:q]])
            cut = [np.searchsorted(np.cumsum(sizes[ids]), ends) + 1 for ids, sizes in ((a, self.a_sizes), (b, self.b_sizes))]
            whole = b"".join(map(self.a_bytes.__getitem__, a)) == given == b"".join(map(self.b_bytes.__getitem__, b))
            same = whole and bool(
                (np.cumsum(self.a_sizes[a])[cut[0] - 1] == ends).all() and (np.cumsum(self.b_sizes[b])[cut[1] - 1] == ends).all()
            )
            if not same and q - p > 1:  # a vocabulary that joins words with the white space after them
                for column, value in zip(out, zip(*map(self._encoded, ([x] for x in parts[p:q])), strict=True), strict=True):
                    column += value
                continue
            cut = cut if same else [np.array([len(a)]), np.array([len(b)])]
            for column, value in zip(
                out, (a, np.diff(cut[0], prepend=0), b, np.diff(cut[1], prepend=0), np.full(q - p, same)), strict=True
            ):
                column.append(value)
        return [np.concatenate(column) for column in out]


@lru_cache(maxsize=1)
def _tokenizers(byte_level: bytes, pieces: bytes) -> Tokenizers:
    """Built once per Python worker."""
    return Tokenizers(byte_level, pieces)


@dataclass
class Tokens:
    """The tokens of some texts in a row. ``a_first`` and ``b_first``: where each text's begin."""

    a: np.ndarray
    b: np.ndarray
    a_first: np.ndarray
    b_first: np.ndarray


def _flat(ids: np.ndarray, first: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the parts at ``place``, and where each begins, and the total at the end."""
    counts = np.diff(first)[place]
    begins = np.concatenate([[0], np.cumsum(counts)])
    gather = np.repeat(first[:-1][place] - begins[:-1], counts) + np.arange(begins[-1])
    return ids[gather].astype(np.int64), begins


def tokenize(texts: pa.Array, tokenizers: Tokenizers, cached: int) -> Tokens:
    """Encode each different word of the texts once, with the white space before it.

    No token of A or B runs from a word into ASCII white space, but for carriage returns,
    which B joins with signs, so texts may be cut there. Texts with other white space, which
    A's pattern joins with it, are one part.
    """
    given = texts.to_pylist()
    spaced = pa.array([" " + t if t else "" for t in given], pa.large_string())
    data, offsets = text_bytes(spaced)
    starts, ends = word_spans(data, offsets)
    # A part is a word with what precedes it; white space at the end of a text is one more.
    whole = np.array([bool(t and _WIDE_SPACE.search(t)) for t in given], dtype=bool)
    owner = np.searchsorted(offsets, starts, side="right") - 1
    joins = data[np.minimum(ends, max(len(data) - 1, 0))] == 0x0D if len(ends) else np.zeros(0, dtype=bool)
    stops = np.concatenate([ends[~(whole[owner] | joins)], offsets[1:]])
    stops = np.unique(stops[stops > 0])
    begins = np.concatenate([[0], stops[:-1]]) if len(stops) else stops
    codes = span_codes(data, begins, stops)
    _codes, at, place = np.unique(codes, return_index=True, return_inverse=True)
    if len(tokenizers.known) > cached:
        tokenizers.forget()
    place = tokenizers.places([data[begins[k] : stops[k]].tobytes() for k in at])[place]
    # Parts of a text whose bytes one tokenizer does not give back are left out.
    first = np.searchsorted(begins, offsets)
    wrong = ~tokenizers.same[place]
    text_of = np.searchsorted(offsets, begins, side="right") - 1
    bad = np.zeros(len(given), dtype=bool)
    bad[text_of[wrong]] = True
    kept = ~bad[text_of]
    place = place[kept]
    first = np.concatenate([[0], np.cumsum(kept)])[first]
    a, a_begins = _flat(tokenizers.ids[0], tokenizers.first[0], place)
    b, b_begins = _flat(tokenizers.ids[1], tokenizers.first[1], place)
    return Tokens(a, b, a_begins[first], b_begins[first])


# -------------------------------------------------------------------- merge


def crossings(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many of ``a`` are among the first d of the merge of two rising lists, for each d.

    Equal ends come from ``a`` first. All diagonals are searched at once.
    """
    low, high = np.maximum(0, diagonals - len(b)), np.minimum(diagonals, len(a))
    while np.any(low < high):
        middle = (low + high) // 2
        open_ = low < high
        i = np.minimum(middle, len(a) - 1)
        j = np.clip(diagonals - middle - 1, 0, len(b) - 1)
        more = open_ & (a[i] <= b[j])  # the path has more of a before this diagonal
        low = np.where(more, middle + 1, low)
        high = np.where(open_ & ~more, middle, high)
    return low


def _common(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the ends that both sides of one piece hold."""
    if not len(a) or not len(b):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    at = np.searchsorted(b, a)
    same = b[np.minimum(at, len(b) - 1)] == a
    return np.flatnonzero(same), at[same]


def common_ends(a: np.ndarray, b: np.ndarray, work: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and in ``b`` of the ends that both hold, from pieces of ``work`` ends."""
    total = len(a) + len(b)
    diagonals = np.minimum(np.arange(0, total + work, work), total)
    if not len(a) or not len(b):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    i = crossings(a, b, diagonals)
    j = diagonals - i
    in_a, in_b = [], []
    for k in range(len(diagonals) - 1):
        x, y = _common(a[i[k] : i[k + 1]], b[j[k] : j[k + 1]])
        in_a.append(x + i[k])
        in_b.append(y + j[k])
        # Cut apart: this piece's last end of a is the next one's first of b.
        if 0 < i[k + 1] and j[k + 1] < len(b) and a[i[k + 1] - 1] == b[j[k + 1]]:
            in_a.append(np.array([i[k + 1] - 1]))
            in_b.append(np.array([j[k + 1]]))
    return np.concatenate(in_a), np.concatenate(in_b)


@dataclass
class Groups:
    """Groups of the tokens of some texts. ``a_end`` and ``b_end``: where each one's tokens
    end; ``first``: where each text's groups begin."""

    a_end: np.ndarray
    b_end: np.ndarray
    first: np.ndarray

    @property
    def a_sizes(self) -> np.ndarray:
        return np.diff(self.a_end, prepend=0)

    @property
    def b_sizes(self) -> np.ndarray:
        return np.diff(self.b_end, prepend=0)


def grouped(tokens: Tokens, a_sizes: np.ndarray, b_sizes: np.ndarray, work: int) -> Groups:
    a_at, b_at = common_ends(np.cumsum(a_sizes[tokens.a]), np.cumsum(b_sizes[tokens.b]), work)
    return Groups(a_at + 1, b_at + 1, np.searchsorted(a_at, tokens.a_first))


def _written(ids: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of decimal ids, each followed by its separator, and how many each has."""
    digits = np.ones(len(ids), dtype=np.int64)
    for k in range(1, _DIGITS):
        digits += ids >= 10**k
    width = int(digits.max(initial=1))
    cells = np.zeros((len(ids), width + 1), dtype=np.uint8)
    for k in range(width):
        power = np.maximum(digits - 1 - k, 0)
        cells[:, k] = ids // (10**power) % 10 + 0x30
    cells[np.arange(len(ids)), digits] = separators
    return cells[np.arange(width + 1) <= digits[:, None]], digits + 1


def group_texts(tokens: Tokens, groups: Groups) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` of each text; nothing for one without tokens."""
    n_a, n_b = len(tokens.a), len(tokens.b)
    if not n_a:
        return [b""] * (len(groups.first) - 1)
    a_group = np.repeat(np.arange(len(groups.a_end)), groups.a_sizes)
    b_group = np.repeat(np.arange(len(groups.b_end)), groups.b_sizes)
    ids = np.empty(n_a + n_b, dtype=np.int64)
    marks = np.full(n_a + n_b, ord(","), dtype=np.uint8)
    a_place = np.arange(n_a) + np.concatenate([[0], groups.b_end[:-1]])[a_group]
    b_place = np.arange(n_b) + groups.a_end[b_group]
    ids[a_place], ids[b_place] = tokens.a, tokens.b
    marks[a_place[groups.a_end - 1]] = ord("|")
    marks[b_place[groups.b_end - 1]] = ord(";")
    data, sizes = _written(ids, marks)
    bounds = np.concatenate([[0], np.cumsum(sizes)])[tokens.a_first + tokens.b_first]
    text = data.tobytes()
    return [text[p : max(p, q - 1)] for p, q in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


def pair_links(tokens: Tokens, groups: Groups, n_b_ids: int, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, pair, times): how often each text links each pair, a * n_b_ids + b.

    Ids of a group that would give more than ``block`` pairs are counted first.
    """
    a_sizes, b_sizes = groups.a_sizes, groups.b_sizes
    text_of = np.repeat(np.arange(len(groups.first) - 1), np.diff(groups.first))
    a_begin, b_begin = groups.a_end - a_sizes, groups.b_end - b_sizes
    links = a_sizes * b_sizes
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(texts, pairs, times):
        order = np.lexsort((pairs, texts))
        texts, pairs, times = texts[order], pairs[order], times[order]
        new = np.ones(len(texts), dtype=bool)
        new[1:] = (texts[1:] != texts[:-1]) | (pairs[1:] != pairs[:-1])
        at = np.flatnonzero(new)
        found.append((texts[at], pairs[at], np.add.reduceat(times, at) if len(at) else times))

    usual = np.flatnonzero(links <= block)
    blocks = np.cumsum(links[usual]) // block
    for g in np.split(usual, np.flatnonzero(np.diff(blocks)) + 1) if len(usual) else []:
        n = links[g]
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        width = np.repeat(b_sizes[g], n)
        a = tokens.a[np.repeat(a_begin[g], n) + inner // width]
        b = tokens.b[np.repeat(b_begin[g], n) + inner % width]
        add(np.repeat(text_of[g], n), a * n_b_ids + b, np.ones(len(a), dtype=np.int64))
    for g in np.flatnonzero(links > block):
        a, a_times = np.unique(tokens.a[a_begin[g] : groups.a_end[g]], return_counts=True)
        b, b_times = np.unique(tokens.b[b_begin[g] : groups.b_end[g]], return_counts=True)
        pairs = (a[:, None] * n_b_ids + b[None, :]).ravel()
        add(np.full(len(pairs), text_of[g]), pairs, (a_times[:, None] * b_times[None, :]).ravel())
    if not found:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    if len(found) > 1:
        texts, pairs, times = (np.concatenate(c) for c in zip(*found, strict=True))
        found = []
        add(texts, pairs, times)
    return found[0]


# -------------------------------------------------------------------- tables


def _lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


_ALIGNED = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, groups_sha256 string, "
    "pairs array<long>, times array<long>"
)


def _aligned(sent, params: Alignment, with_groups: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = _tokenizers(*sent.value)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch):
                tokens = tokenize(part.column("text"), both, params.cached_words)
                groups = grouped(tokens, both.a_sizes, both.b_sizes, params.piece_work)
                texts = group_texts(tokens, groups)
                links = groups.a_sizes * groups.b_sizes
                n_links = np.diff(np.concatenate([[0], np.cumsum(links)])[groups.first])
                text_of, pairs, times = pair_links(tokens, groups, len(both.b_bytes), params.block_pairs)
                bounds = np.searchsorted(text_of, np.arange(len(texts) + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row, row + len(texts))),
                        part.column("doc_id"),
                        pa.array(np.diff(tokens.a_first)),
                        pa.array(np.diff(tokens.b_first)),
                        pa.array(np.diff(groups.first)),
                        pa.array(n_links),
                        pa.array([t.decode() if with_groups else None for t in texts], pa.string()),
                        pa.array([hashlib.sha256(t).hexdigest() if t else "" for t in texts], pa.string()),
                        _lists(pairs, bounds, pa.int64()),
                        _lists(times, bounds, pa.int64()),
                    ],
                    names=[c.split(" ")[0] for c in _ALIGNED.split(", ")],
                )
                row += len(texts)

    return run


def aligned_tokens(documents: DataFrame, params: Alignment = Alignment(), with_groups: bool = True) -> DataFrame:
    """One row per document: its token counts, groups (``a1,a2|b1;a3|b2,b3``, if
    ``with_groups``), their digest, links, and how often it links each pair of ids.

    The vocabularies' files are read by the driver and sent to the workers.
    """
    spark = documents.sparkSession
    small_batches(spark, 500)
    files = []
    for path in (params.byte_level, params.pieces):
        with open(path, "rb") as file:
            files.append(file.read())
    sent = spark.sparkContext.broadcast(tuple(files))
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_aligned(sent, params, with_groups), _ALIGNED)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n): how many documents hold each pair of ids linked."""
    return aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))


def _ids(params: Alignment) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=params.pieces).get_piece_size()


def _counted(sent, n_b_ids: int):
    """Adds up the counts that were sent; pairs without one stay in ``pairs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, counts, ids, most = sent.value
        for batch in batches:
            lists = batch.column("pairs")
            pairs = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            times = batch.column("times").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            n = batch.num_rows
            sizes = np.array([len(x) for x in lists], dtype=np.int64)
            text_of = np.repeat(np.arange(n), sizes)
            at = np.minimum(np.searchsorted(hot, pairs), max(len(hot) - 1, 0))
            known = hot[at] == pairs if len(hot) else np.zeros(len(pairs), dtype=bool)
            count = counts[at] * known if len(hot) else np.zeros(len(pairs), dtype=np.int64)
            best = known & (most[np.searchsorted(ids, pairs // n_b_ids)] == count) if len(pairs) else known
            sums = np.zeros((2, n), dtype=np.int64)
            np.add.at(sums[0], text_of, times * best)
            np.add.at(sums[1], text_of, times * count)
            rest = np.concatenate([[0], np.cumsum(~known)])[np.concatenate([[0], np.cumsum(sizes)])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    pa.array(sums[0]),
                    pa.array(sums[1]),
                    _lists(pairs[~known], rest, pa.int64()),
                    _lists(times[~known], rest, pa.int64()),
                ],
                names=["row", "n_best", "count_sum", "pairs", "times"],
            )

    return run


def alignment_digests(documents: DataFrame, params: Alignment = Alignment()) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row.

    ``n_best``: links whose pair is in as many documents as any pair of its A id.
    ``count_sum``: over links, the documents that hold the pair.

    Needs doc_id and text; further columns are not read. NULL and empty texts, and texts
    whose bytes a tokenizer does not give back (such as those with U+2581), have no tokens:
    zeros and an empty digest. Repeated rows are documents like any other. An empty table
    gives an empty table.
    """
    spark = documents.sparkSession
    aligned = settle(aligned_tokens(documents, params, with_groups=False).drop("groups"), "aligned")
    counts = settle(pair_counts(aligned), "pair_counts")
    n_b_ids = _ids(params)
    total = counts.agg(F.sum("n").alias("n")).first()["n"] or 0
    # At most hot_pairs pairs can have that many of all (document, pair) rows.
    least = total // params.hot_pairs + 1
    hot = counts.where(F.col("n") >= least).orderBy("pair").toArrow()
    a_id = F.expr(f"pair div {n_b_ids}L")
    most = counts.groupBy(a_id.alias("a")).agg(F.max("n").alias("most"))
    arrow = most.orderBy("a").toArrow()  # no more rows than A has ids
    sent = spark.sparkContext.broadcast(
        tuple(np.array(c) for c in (hot["pair"], hot["n"], arrow["a"], arrow["most"]))
    )
    schema = "row long, n_best long, count_sum long, pairs array<long>, times array<long>"
    known = settle(aligned.select("row", "pairs", "times").mapInArrow(_counted(sent, n_b_ids), schema), "counted")
    cold = counts.where(F.col("n") < least).withColumn("a", a_id).join(F.broadcast(most), "a")
    rest = known.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x"))
    rest = rest.select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times")).join(cold, "pair")
    rest = rest.groupBy("row").agg(
        F.sum(F.when(F.col("n") == F.col("most"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("times") * F.col("n")).alias("more_sum"),
    )
    rows = aligned.drop("pairs", "times").join(known.select("row", "n_best", "count_sum"), "row")
    none = F.lit(0).cast("long")
    return rows.join(rest, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("n_best") + F.coalesce("more_best", none)).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", none)).alias("count_sum"),
        "groups_sha256",
    )

