"""Quality classifier: perplexity under a Kneser-Ney model of trusted text.

An interpolated modified Kneser-Ney model of word n-grams is trained on all trusted
documents. Counts, continuation counts, discounts and back-off weights come
from grouped counts and joins that Spark shards by n-gram. The log probability of a text
is brought into a form that adds up over its n-grams: each n-gram of the model carries
what its presence adds to the score of its shorter suffix,

    gain(h w) = log p(w | h) - log backoff(h) - log p(w | h without its first word)

and every occurrence as a context adds log backoff(h). An n-gram outside the model adds
nothing, so a text's score is its n-grams joined with the model, summed.

All that an n-gram's probability needs, but for the counts of its last word, is found among the
n-grams with the same last word of context: counts, continuation counts, sums of contexts. So
n-grams are dealt to buckets by that word, those of the trusted texts and those of the texts to
be scored alike, and a bucket is counted and scored at once; no n-gram is written, nor sent on.
Frequent words are dealt by their places among the 65,535 most frequent ones. A bucket has a count
of an n-gram for each model, so the models that leave out a fold cost no more shuffles.
There every probability takes the form a + b * p(last word). Words that are in very many n-grams
have several buckets, by the word before; what follows them is counted in the fit and given to
each. Of the words' own counts the most frequent, at most ``pass_bytes``, are sent to the
workers; what ends in another word meets the other counts by that word. A score is a sum, so
the table is scored in ``passes``, each with the buckets of some words, and only a pass's n-grams are
on disk. Within a pass a text is named by its place in a slice of texts; a pass leaves one sum a text,
and the sums meet the texts' keys, two hashes, once, at the end.

Perplexities of short texts are drawn towards their language's mean by ``prior_words``
words. The threshold of a language is a quantile over its trusted documents, each scored by a
model that was trained without its fold (cross-fitting); the model that judges the table is
trained on all of them. Mean and quantile are
drawn towards those of all languages by ``prior_documents`` documents, by the same rule for
every language and every size of table; a threshold is never below the language's own
quantile. Documents of a language without trusted text are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from perennial.llm.shared import drop_settled, freed_shuffles, settle, small_batches
from perennial.llm.wordcodes import Words, mix, odd_constants, slices, word_codes

_ORDER_SALTS = odd_constants(8, 31)
_PLACE = odd_constants(8, 32)
START = np.uint64(0x1F83D9ABFB41BD6B)
END = np.uint64(0x5BE0CD19137E2179)


@dataclass(frozen=True)
class QualityModel:
    order: int = 3
    # The fit reads all trusted documents, or about so many per language at most, in
    # ``calibrate`` folds, each scored without itself.
    sample_per_language: int | None = None
    calibrate: int = 3
    quantile: float = 0.995
    slack: float = 1.25  # on the logarithm's distance from the language's mean
    prior_words: float = 20.0
    prior_documents: float = 10.0
    pass_bytes: int = 24 << 20
    passes: int = 8
    bucket_words: int = 1 << 20  # n-grams that a task works on at a time


def trusted_ids(labels: DataFrame) -> DataFrame:
    """doc_id of the documents labelled good and not toxic; conflicting labels are not."""
    return (
        labels.where("doc_id is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic"))
        .where("quality = 1 and toxic = 0")
        .select("doc_id")
    )


# ------------------------------------------------------------- n-grams to buckets


@dataclass(frozen=True)
class Plan:
    """How n-grams are dealt: the buckets of a pass, the passes, the words whose n-grams
    are dealt to several buckets (sorted codes, and to how many), and the most frequent
    words (sorted codes), which are sent by their place among these."""

    buckets: int
    passes: int
    hot: np.ndarray
    parts: np.ndarray
    common: np.ndarray


def _padded(codes: np.ndarray, order: int) -> np.ndarray:
    return np.concatenate([np.full(order - 1, START, dtype=np.uint64), codes, [END]])


def _lined_up(words: Words, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in a row, padded; where their n-grams end; the text of each n-gram."""
    texts = len(words)
    flat = np.full(len(words.codes) + texts * order, START, dtype=np.uint64)
    text = np.repeat(np.arange(texts), np.diff(words.first) + 1)
    ends = np.arange(len(text)) + text * (order - 1) + order - 1
    last = np.cumsum(np.diff(words.first) + 1) - 1
    inner = np.ones(len(text), dtype=bool)
    inner[last] = False
    flat[ends[inner]] = words.codes
    flat[ends[last]] = END
    return flat, ends, text


def _frequent(order: int):
    """The words by which many n-grams of a slice are dealt, and under NULL all n-grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                flat, ends, _text = _lined_up(word_codes(part.column("text"), lower=False), order)
                words, n = np.unique(flat[ends - min(order - 1, 1)], return_counts=True)
                often = n >= max(2, len(ends) >> 16)
                words = pa.concat_arrays([pa.nulls(1, pa.int64()), pa.array(words[often].view(np.int64))])
                n = pa.array(np.concatenate([[len(ends)], n[often]]).astype(np.int64))
                yield pa.RecordBatch.from_arrays([words, n], names=["word", "n"])

    return run


_OTHER = (1 << 16) - 1  # in place of a word that is not among the most frequent


def _plan(texts: DataFrame, params: QualityModel) -> tuple[Plan, int]:
    """A plan for these texts, and how many n-grams they have."""
    cores = texts.sparkSession.sparkContext.defaultParallelism
    found = texts.select("text").mapInArrow(_frequent(params.order), "word long, n long")
    found = settle(found.groupBy("word").agg(F.sum("n").alias("n")), "frequent")
    room = max(1, params.bucket_words // 2)
    rows = found.where((F.col("n") > room) | F.col("word").isNull()).collect()
    common = found.where("word is not null").orderBy(F.desc("n"), "word").limit(_OTHER).select("word").toArrow()
    drop_settled(found)
    total = sum(r["n"] for r in rows if r["word"] is None)
    passes = max(1, min(params.passes, -(-total // params.bucket_words)))
    buckets = max(4 * cores, -(-total // (passes * params.bucket_words)))
    hot = sorted((r["word"] % (1 << 64), min(buckets, -(-r["n"] // room))) for r in rows if r["word"] is not None)
    if params.order == 1:
        hot = []
    codes, parts = (np.array([h[k] for h in hot], dtype=np.uint64) for k in (0, 1))
    common = np.sort(common.column("word").to_numpy().view(np.uint64))
    return Plan(buckets, passes, codes, parts, common), total


def _in(sorted_codes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each code is in the sorted ones, and whether it is there."""
    # By a hash table, several times faster than a binary search for each.
    found = pa.compute.index_in(pa.array(codes), value_set=pa.array(sorted_codes))
    return found.fill_null(0).to_numpy(zero_copy_only=False), found.is_valid().to_numpy(zero_copy_only=False)


def _segments(sorted_values: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Each value of a sorted array, and where it is."""
    cuts = np.flatnonzero(np.diff(sorted_values)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(sorted_values)]):
        if b > a:
            yield int(sorted_values[a]), slice(a, b)


# A row holds n-grams of one slice of texts in one bucket, sorted by the word by which they are
# dealt: these words, how many n-grams each is in, the texts' places in the slice, the other
# words' places among the most frequent ones, and the codes of those that are not.
_DEALT = "bucket int, kind int, fold int, slice long, keys binary, runs binary, doc binary, ids binary, rest binary"
_FIT, _ASKED, _FOLLOWERS, _TEXTS = 0, 1, 2, 3
_NO_FOLD = -1
_KEYS = ("key1", "key2")
_KEY = np.dtype([(key, "<i8") for key in _KEYS])
_TEXT = np.dtype([*_KEY.descr, ("words", "<i4")])


def _rows_of(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, types = zip(*(c.split() for c in schema.split(", ")))
    of = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    columns = zip(*rows) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, of[t]) for c, t in zip(columns, types)], names=list(names))


def _binaries(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """The bytes of the values, so many of them a row."""
    ends = np.zeros(len(counts) + 1, dtype=np.int64)
    np.cumsum(counts * values.itemsize, out=ends[1:])
    data = pa.py_buffer(np.ascontiguousarray(values))
    return pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(ends), data]).cast(pa.binary())


def _values(rows: pa.Table, column: str, dtype) -> tuple[np.ndarray, np.ndarray]:
    """The values of all rows of a binary column, and how many each row has."""
    found, dtype = rows.column(column).cast(pa.large_binary()).combine_chunks(), np.dtype(dtype)
    if not len(found):
        return np.zeros(0, dtype=dtype), np.zeros(0, dtype=np.int64)
    _valid, ends, data = found.buffers()
    ends = np.frombuffer(ends, dtype=np.int64)[found.offset : found.offset + len(found) + 1]
    if ends[-1] == ends[0]:
        return np.zeros(0, dtype=dtype), np.zeros(len(found), dtype=np.int64)
    data = np.frombuffer(data, dtype=np.uint8)[ends[0] : ends[-1]]
    return data.view(dtype), np.diff(ends) // dtype.itemsize


_BLOCK = 1 << 18  # bytes of text


def _deal(order: int, plan: Plan, turn: int, kind: int, named: bool = False):
    """The n-grams of a pass, by bucket and fold. If ``named``, n-grams know their texts, and a
    row of each slice has the keys of its texts."""
    own = min(order - 1, 1)  # how far from the end the word is by which an n-gram is dealt
    others = [k for k in range(order - 1, -1, -1) if k != own]

    def coded(block: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        words = word_codes(block.column("text"), lower=False)
        flat, ends, text = _lined_up(words, order)
        key = flat[ends - own]
        if plan.passes > 1:
            wanted = np.flatnonzero(key % np.uint64(plan.passes) == np.uint64(turn))
            key, ends, text = key[wanted], ends[wanted], text[wanted]
        bucket = key // np.uint64(plan.passes) % np.uint64(plan.buckets)
        if len(plan.hot):
            at, hot = _in(plan.hot, key)
            beside = flat[ends[hot] - (2 if order > 2 else 0)]
            bucket[hot] = (bucket[hot] + mix(beside) % plan.parts[at[hot]]) % np.uint64(plan.buckets)
        sent = np.empty((len(key), len(others)), dtype=np.uint64)
        for column, k in enumerate(others):
            sent[:, column] = flat[ends - k]
        return key, bucket, text, sent, np.diff(words.first)

    def dealt(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        # In blocks small enough for the cache, of which a pass keeps a part.
        blocks, rows = [], 0
        for block in slices(part, limit=_BLOCK):
            key, bucket, text, *more = coded(block)
            blocks.append((key, bucket, text + rows, *more))
            rows += block.num_rows
        key, bucket, text, sent, sizes = map(np.concatenate, zip(*blocks))
        group, width = bucket.astype(np.int64), 1
        if "fold" in part.schema.names:
            fold = part.column("fold").fill_null(_NO_FOLD).to_numpy(zero_copy_only=False).astype(np.int64) + 1
            width = int(fold.max(initial=0)) + 1
            group = group * width + fold[text]
        by = np.argsort(group.astype(np.uint64) << np.uint64(40) | key >> np.uint64(24))
        key, text, group, sent = key[by], text[by], group[by], sent[by]
        first = np.flatnonzero(np.diff(group, prepend=-1))
        new = np.ones(len(key), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        new[first] = True
        runs = np.flatnonzero(new)
        n = np.diff(first, append=len(key))
        at, known = _in(plan.common, sent.ravel())
        rest = (~known).reshape(sent.shape).sum(axis=1)

        def a_row(per_gram: np.ndarray) -> np.ndarray:
            return np.add.reduceat(per_gram.astype(np.int64), first) if len(first) else first

        name = 0
        if named:
            texts = np.empty(part.num_rows, dtype=_TEXT)
            for column in _KEYS:
                texts[column] = part.column(column).to_numpy(zero_copy_only=False)
            texts["words"] = sizes
            name = xxhash.xxh64_intdigest(texts.tobytes(), seed=kind)
            name -= (name >> 63) << 64
            # Once is enough.
            if turn == 0:
                yield _rows_of([(name % plan.buckets, _TEXTS, int(kind == _FIT), name, texts.tobytes(), *[b""] * 4)], _DEALT)
        rows = len(first)
        columns = [
            pa.array((group[first] // width).astype(np.int32)),
            pa.array(np.full(rows, kind, dtype=np.int32)),
            pa.array((group[first] % width - 1 if width > 1 else np.full(rows, _NO_FOLD)).astype(np.int32)),
            pa.array(np.full(rows, name, dtype=np.int64)),
            _binaries(key[runs], a_row(new)),
            _binaries(np.diff(runs, append=len(key)).astype(np.uint32), a_row(new)),
            _binaries(text.astype(np.uint16), n if named else np.zeros(rows, dtype=np.int64)),
            _binaries(np.where(known, at, _OTHER).astype(np.uint16), n * len(others)),
            _binaries(sent.ravel()[~known], a_row(rest)),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _DEALT.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=8 << 20):
                for at in range(0, part.num_rows, 1 << 16):
                    yield from dealt(part.slice(at, 1 << 16))

    return run


def column_codes(columns: np.ndarray) -> np.ndarray:
    """The codes of n-grams whose words are columns; see ``gram_codes``."""
    total = np.full(columns.shape[1], _ORDER_SALTS[len(columns)], dtype=np.uint64)
    for k, words in enumerate(columns):
        total += words * _PLACE[k]
    return mix(total)


def _of_kind(group: pa.Table, kind: int) -> pa.Table:
    return group.filter(pa.compute.equal(group.column("kind"), kind))


class Grams:
    """The n-grams of the rows of a kind: their words as columns, the row, fold and text of each."""

    def __init__(self, group: pa.Table, kind: int, order: int, common: np.ndarray):
        rows = _of_kind(group, kind)
        keys, per_row = _values(rows, "keys", np.uint64)
        runs, _per_row = _values(rows, "runs", np.uint32)
        ids, _per_row = _values(rows, "ids", np.uint16)
        rest, _per_row = _values(rows, "rest", np.uint64)
        self.doc, _per_row = _values(rows, "doc", np.uint16)
        key = np.repeat(keys, runs)
        n = np.diff(np.concatenate([[0], np.cumsum(runs, dtype=np.int64)])[np.concatenate([[0], np.cumsum(per_row)])])
        sent, known = np.empty(len(ids), dtype=np.uint64), ids != _OTHER
        sent[known] = common[ids[known]]
        sent[~known] = rest
        self.words = np.empty((order, len(key)), dtype=np.uint64)
        own = order - 1 - min(order - 1, 1)
        self.words[own] = key
        self.words[[k for k in range(order) if k != own]] = sent.reshape(len(key), order - 1).T
        self.slices = rows.column("slice").to_numpy()
        self.row = np.repeat(np.arange(rows.num_rows), n)
        self.fold = rows.column("fold").to_numpy()[self.row]


def _by_model(at: np.ndarray, size: int, weights: np.ndarray) -> np.ndarray:
    """Sums by place of each model's weights."""
    return np.stack([np.bincount(at, w, size) for w in weights])


def _occurrences(at: np.ndarray, size: int, fold: np.ndarray, left_out: list[int | None]) -> np.ndarray:
    """How often each place occurs, for each model without the fold that it leaves out."""
    total = np.bincount(at, minlength=size)
    return np.stack([total if f is None else total - np.bincount(at[fold == f], minlength=size) for f in left_out])


def _counted(grams: Grams, left_out: list[int | None]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each order above 1 the different n-grams: codes (sorted), words, counts for each model;
    of the lower orders how many different words come before."""
    words, n, levels = grams.words, None, {}
    for k in range(len(words), 1, -1):
        codes, first, at = np.unique(column_codes(words), return_index=True, return_inverse=True)
        if n is None:
            n = _occurrences(at, len(codes), grams.fold, left_out)
        else:
            n = _by_model(at, len(codes), n > 0).astype(np.int64)
        words = words[:, first]
        levels[k] = codes, words, n
        words = words[1:]
    return levels


# ------------------------------------------------------------------ training

_PAIRS = -2


def _columns_of(models: int) -> list[str]:
    return [f"n{m}" for m in range(models)]


def _pieces_schema(models: int) -> str:
    """Order, last word or count, word before, and for each model a count: of n-grams with a
    count (orders above 1), of the words before a word (order 1), of n-grams of two whose first
    word has several buckets."""
    return ", ".join(["k int, word long, before long", *(f"{n} long" for n in _columns_of(models))])


def _pieces(order: int, plan: Plan, left_out: list[int | None]):
    def run(group: pa.Table) -> pa.Table:
        grams, out = Grams(group, _FIT, order, plan.common), []

        def add(k: int, word: np.ndarray, n: np.ndarray, before: np.ndarray | None = None) -> None:
            before = np.zeros(len(word), dtype=np.int64) if before is None else before.view(np.int64)
            out.append((np.full(len(word), k, dtype=np.int32), word.view(np.int64), before, *n.astype(np.int64)))

        for k, (_codes, words, n) in _counted(grams, left_out).items():
            if k == 2:
                hot = _in(plan.hot, words[0])[1]
                add(_PAIRS, words[1][hot], n[:, hot], words[0][hot])
                words, n = words[:, ~hot], n[:, ~hot]
                last, at = np.unique(words[1], return_inverse=True)
                add(1, last, _by_model(at, len(last), n > 0))
            sizes = np.stack([np.bincount(np.minimum(x, 5), minlength=6)[1:5] for x in n])
            add(k, np.arange(1, 5), sizes)
        if order == 1:
            last, at = np.unique(grams.words[0], return_inverse=True)
            add(1, last, _occurrences(at, len(last), grams.fold, left_out))
        columns = [np.concatenate(x) for x in zip(*out)]
        return pa.table(dict(zip(("k", "word", "before", *_columns_of(len(left_out))), columns)))

    return run


def _discounts(counts: dict[int, int]) -> list[float]:
    """The discounts of counts 1, 2 and above, from the counts of counts."""
    n1, n2, n3, n4 = (counts.get(k, 0) for k in (1, 2, 3, 4))
    if not (n1 and n2):
        return [0.5, 0.5, 0.5]
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 0.5]
    return [min(max(d, 0.05), k + 0.95) for k, d in enumerate(found)]


@dataclass
class Fit:
    """What a model needs to know beyond a bucket's n-grams."""

    texts: DataFrame
    plan: Plan
    discounts: dict[int, list[float]]
    words: DataFrame  # word, n: of how many different words it is preceded
    pairs: DataFrame | None  # before, word, n0: pairs whose first word has several buckets
    total: int
    even: float  # the probability of an unknown word

    def without_words(self) -> "Fit":
        """As sent to tasks."""
        return replace(self, texts=None, words=None, pairs=None)

    def word_probability(self, n: np.ndarray) -> np.ndarray:
        cut = np.array([0.0, *self.discounts[1]])[np.minimum(n, 3).astype(np.int64)]
        return (n - cut) / self.total + self.even


def _dealt_fit(texts: DataFrame, pairs: DataFrame | None, order: int, plan: Plan, turn: int, named: bool) -> DataFrame:
    """The n-grams of the fitted texts in a pass, with the pairs given to their buckets."""
    rows = texts.mapInArrow(_deal(order, plan, turn, _FIT, named), _DEALT)
    if pairs is None:
        return rows
    # Grouped, then copied to each bucket of the first word.
    some = F.pmod(F.xxhash64("word"), F.lit(16))
    columns = [c for c in pairs.columns if c != "before"]
    pairs = pairs.groupBy("before", some.alias("some")).agg(*(F.collect_list(c).alias(c) for c in columns))
    return rows.unionByName(pairs.mapInArrow(_given(plan, turn, columns), _DEALT))


def _given(plan: Plan, turn: int, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            before = batch.column("before").to_numpy(zero_copy_only=False).view(np.uint64)
            for row in np.flatnonzero(before % np.uint64(plan.passes) == np.uint64(turn)):
                found = [batch.column(c)[row].values.to_numpy().view(np.uint64) for c in columns]
                # One n-gram after the other, so that rows can be put together.
                data = np.stack([np.full(len(found[0]), before[row], dtype=np.uint64), *found], axis=1).tobytes()
                first = int(before[row]) // plan.passes % plan.buckets
                parts = min(plan.buckets, int(plan.parts[np.searchsorted(plan.hot, before[row])]))
                yield _rows_of(
                    [((first + k) % plan.buckets, _FOLLOWERS, _NO_FOLD, 0, data, *[b""] * 4) for k in range(parts)], _DEALT
                )

    return run


class Counts:
    """What several models need of their texts' counts, as far as it is not found in a bucket.

    The texts are dealt and counted once for all models, of which each leaves out a fold, or
    none (None). ``words`` and ``pairs`` have a count of each model.
    """

    def __init__(self, texts: DataFrame, params: QualityModel, plan: Plan, left_out: list[int | None]):
        self.plan, self.left_out, order = plan, left_out, params.order
        n = _columns_of(len(left_out))
        # Few texts are fitted, so a few passes do.
        few = replace(plan, passes=-(-plan.passes // 4))
        parts = []
        with freed_shuffles(texts.sparkSession):
            for turn in range(few.passes):
                dealt = texts.mapInArrow(_deal(order, few, turn, _FIT), _DEALT)
                found = dealt.groupBy("bucket").applyInArrow(_pieces(order, few, left_out), _pieces_schema(len(n)))
                found = found.groupBy("k", "word", "before").agg(*(F.sum(c).alias(c) for c in n))
                parts.append(settle(found, "counts"))
            found = parts[0]
            for part in parts[1:]:
                found = found.unionByName(part)
            self.pairs, preceded = None, found.where("k = 1").select("word", *n)
            sizes = found.where("k >= 2").groupBy("k", "word").agg(*(F.sum(c).alias(c) for c in n))
            if len(plan.hot):
                # A first word is in one pass, so the pairs of passes are different.
                self.pairs = settle(found.where(F.col("k") == _PAIRS).select("before", "word", *n), "pairs")
                some = (F.count_if(F.col(c) > 0).alias(c) for c in n)
                preceded = preceded.unionByName(self.pairs.groupBy("word").agg(*some))
                for count in range(1, 5):
                    some = (F.count_if(F.col(c) == count).alias(c) for c in n)
                    of_pairs = self.pairs.agg(*some).select(F.lit(2).alias("k"), F.lit(count).alias("word"), *n)
                    sizes = sizes.unionByName(of_pairs)
            self.words = settle(preceded.groupBy("word").agg(*(F.sum(c).alias(c) for c in n)), "words")
            self.of_counts: list[dict[int, dict[int, int]]] = [{k: {} for k in range(1, order + 1)} for _ in n]
            for r in sizes.collect():
                for c, counts in zip(n, self.of_counts):
                    counts[r["k"]][r["word"]] = counts[r["k"]].get(r["word"], 0) + r[c]
            by_count = [F.count_if(F.col(c) == k).alias(f"{c}_{k}") for c in n for k in range(1, 5)]
            known = [F.count_if(F.col(c) > 0).alias(f"{c}_known") for c in n]
            row = self.words.agg(*(F.sum(c).alias(c) for c in n), *known, *by_count).first()
        for c, counts in zip(n, self.of_counts):
            counts[1] = {k: row[f"{c}_{k}"] for k in range(1, 5)}
        self.totals, self.known = [row[c] or 0 for c in n], [row[f"{c}_known"] for c in n]
        for part in parts:
            drop_settled(part)

    def fit(self, texts: DataFrame, model: int) -> Fit:
        """A model's counts and discounts; the texts are those it does not leave out."""
        of_counts, total, known, n = self.of_counts[model], self.totals[model], self.known[model], F.col(f"n{model}")
        discounts = {k: _discounts(counts) for k, counts in of_counts.items()}
        more = known - of_counts[1][1] - of_counts[1][2]
        left = sum(size * d for size, d in zip((of_counts[1][1], of_counts[1][2], more), discounts[1]))
        even = left / total / (known + 1) if total else 1.0
        words = self.words.where(n > 0).select("word", n.alias("n"))
        pairs = None if self.pairs is None else self.pairs.where(n > 0).select("before", "word", n.alias("n0"))
        return Fit(texts, self.plan, discounts, words, pairs, total or 1, even)

    def free(self) -> None:
        for frame in (self.words, self.pairs):
            if frame is not None:
                drop_settled(frame)


def fit(texts: DataFrame, params: QualityModel, plan: Plan | None = None) -> Fit:
    """Count the n-grams of the texts, as far as their counts are not found in a bucket."""
    texts = texts.select(F.col("text").cast("string").alias("text"))
    if plan is None:
        plan = _plan(texts, params)[0]
    return Counts(texts, params, plan, [None]).fit(texts, 0)


class Bucket:
    """The n-grams above single words in a bucket, as the models count them."""

    def __init__(self, group: pa.Table, grams: Grams, abouts: list[Fit], left_out: list[int | None]):
        self.levels, hot = _counted(grams, left_out), abouts[0].plan.hot
        if 2 in self.levels and len(hot):
            _codes, words, n = self.levels[2]
            own = ~_in(hot, words[0])[1]
            # Rows of one word may come in any order, but each once.
            given = _values(_of_kind(group, _FOLLOWERS), "keys", np.uint64)[0].reshape(-1, 2 + len(abouts)).T
            words = np.concatenate([words[:, own], given[:2]], axis=1)
            n = np.concatenate([n[:, own], given[2:].astype(np.int64)], axis=1)
            codes = column_codes(words)
            by = np.argsort(codes)
            self.levels[2] = codes[by], words[:, by], n[:, by]
        self.contexts = {}
        self.cuts = [{k: np.array([0.0, *d]) for k, d in about.discounts.items()} for about in abouts]
        for k, (_codes, words, n) in self.levels.items():
            codes, first, at = np.unique(column_codes(words[:-1]), return_index=True, return_inverse=True)
            total = _by_model(at, len(codes), n)
            left = _by_model(at, len(codes), [cuts[k][np.minimum(x, 3)] for cuts, x in zip(self.cuts, n)])
            self.contexts[k] = codes, words[:-1, first], total, left / np.maximum(total, 1)

    def affine(self, grams: np.ndarray, model: int) -> tuple[np.ndarray, np.ndarray]:
        """a and b of p(last word | words before) = a + b * p(last word)."""
        a, b = np.zeros(grams.shape[1]), np.ones(grams.shape[1])
        # A longer context, or n-gram, occurs only where the shorter one does.
        seen, known = np.arange(grams.shape[1]), np.ones(grams.shape[1], dtype=bool)
        for k in range(2, len(grams) + 1):
            words = grams[len(grams) - k :]
            contexts, _words, total, backoff = self.contexts[k]
            codes, _grams, n = self.levels[k]
            total, backoff, n = total[model], backoff[model], n[model]
            if not len(contexts):
                break
            at, found = _in(contexts, column_codes(words[:-1])[seen])
            found &= total[at] > 0
            seen, at, known = seen[found], at[found], known[found]
            place, hit = _in(codes, column_codes(words)[seen[known]])
            of_known = np.where(hit, n[place], 0)
            n = np.zeros(len(seen), dtype=np.int64)
            n[known] = of_known
            known = n > 0
            a[seen] = (n - self.cuts[model][k][np.minimum(n, 3)]) / total[at] + backoff[at] * a[seen]
            b[seen] *= backoff[at]
        return a, b


_MODEL = "order int, words array<bigint>, a double, b double, a_lower double, b_lower double, backoff double, n long"


def _model_rows(order: int, about: Fit):
    """n-grams with what their gains are made of, and contexts with their back-off."""

    def run(group: pa.Table) -> pa.Table:
        bucket, tables = Bucket(group, Grams(group, _FIT, order, about.plan.common), [about], [None]), []

        def add(words: np.ndarray, **columns: np.ndarray) -> None:
            k, size = words.shape
            ends = pa.array(np.arange(size + 1, dtype=np.int32) * k)
            of = {"order": pa.array(np.full(size, k, dtype=np.int32))}
            of["words"] = pa.ListArray.from_arrays(ends, pa.array(words.T.ravel().view(np.int64)))
            for name in ("a", "b", "a_lower", "b_lower", "backoff"):
                of[name] = pa.array(columns[name]) if name in columns else pa.nulls(size, pa.float64())
            of["n"] = pa.array(columns["n"].astype(np.int64)) if "n" in columns else pa.nulls(size, pa.int64())
            tables.append(pa.table(of))

        for k, (_codes, words, n) in bucket.levels.items():
            (a, b), (a_lower, b_lower) = bucket.affine(words, 0), bucket.affine(words[1:], 0)
            add(words, a=a, b=b, a_lower=a_lower, b_lower=b_lower, n=n[0])
            _codes, contexts, _total, backoff = bucket.contexts[k]
            add(contexts, backoff=np.log(backoff[0]))
        return pa.concat_tables(tables)

    return run


def train(
    texts: DataFrame,
    params: QualityModel,
    plan: Plan | None = None,
    fits: list[Fit] | None = None,
    counts: Counts | None = None,
    number: int = 0,
) -> tuple[DataFrame, float]:
    """The model's n-grams (order, words, gain, backoff, n) and the log of an unknown word; n is
    the count that the n-gram's order goes by, NULL for contexts of starts alone.

    ``counts`` may have counted the texts already, for the model of that number. ``fits`` gets
    the counts from which texts are scored; the table of n-grams, which the scorer does without,
    is made when it is read.
    """
    about = fit(texts, params, plan) if counts is None else counts.fit(texts, number)
    if fits is not None:
        fits.append(about)
    d1, d2, d3 = about.discounts[1]
    cut = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
    p = ((F.col("n") - cut) / about.total + about.even).alias("p")
    singles = about.words.select(F.col("word").alias("last"), p, "n")
    model = singles.select(
        F.lit(1).alias("order"), F.array("last").alias("words"), F.log("p").alias("gain"),
        F.lit(None).cast("double").alias("backoff"), "n",
    )
    if params.order > 1:
        whole = replace(about, plan=replace(about.plan, passes=1))
        rows = _dealt_fit(whole.texts.select("text"), whole.pairs, params.order, whole.plan, 0, False).groupBy("bucket")
        rows = rows.applyInArrow(_model_rows(params.order, whole.without_words()), _MODEL)
        rows = rows.withColumn("last", F.element_at("words", -1)).join(singles.drop("n"), "last", "left")
        here, lower = (F.log(F.expr(f"a{x} + b{x} * p")) for x in ("", "_lower"))
        gain = here - F.log(F.col("b") / F.col("b_lower")) - lower
        model = model.unionByName(rows.select("order", "words", gain.alias("gain"), "backoff", "n"))
    # An n-gram and the context it is are dealt by different words; copies of a row are alike.
    model = model.groupBy("order", "words").agg(*(F.max(c).alias(c) for c in ("gain", "backoff", "n")))
    return model.fillna(0.0, ["gain", "backoff"]), float(np.log(about.even))


# ------------------------------------------------------------------- scoring


def gram_codes(codes: np.ndarray, n: int) -> np.ndarray:
    """A code for each n-gram of a padded text."""
    total = np.full(len(codes) - n + 1, _ORDER_SALTS[n], dtype=np.uint64)
    for k in range(n):
        total += codes[k : len(codes) - n + 1 + k] * _PLACE[k]
    return mix(total)


class Table:
    """n-grams sorted by code, with the first of each shard (the code's high bits)."""

    def __init__(self, codes: np.ndarray, gains: np.ndarray, backoffs: np.ndarray):
        order = np.argsort(codes)
        self.codes = codes[order]
        self.values = np.stack([gains[order], backoffs[order]], axis=1).astype(np.float32)
        self.bits = max(1, int(len(codes)).bit_length())
        shards = self.codes >> np.uint64(64 - self.bits)
        self.first = np.searchsorted(shards, np.arange((1 << self.bits) + 1, dtype=np.uint64)).astype(np.int32)
        self.widest = int(np.diff(self.first).max(initial=0))

    def find(self, codes: np.ndarray) -> np.ndarray:
        """(gain, backoff) of each code; zeros for those outside the model."""
        out = np.zeros((len(codes) + 1, 2), dtype=np.float32)
        if not len(self.codes):
            return out[:-1]
        shard = (codes >> np.uint64(64 - self.bits)).astype(np.int64)
        at, end = self.first[shard], self.first[shard + 1]
        open_ = np.flatnonzero(at < end)
        for step in range(self.widest):
            places = at[open_] + step
            hit = self.codes[places] == codes[open_]
            out[open_[hit]] = self.values[places[hit]]
            open_ = open_[~hit]
            open_ = open_[at[open_] + step + 1 < end[open_]]
        return out[:-1]


def _coded_grams(k: int):
    """n-grams as their codes, 16 bytes of each with its values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("words").flatten().to_numpy(zero_copy_only=False)
            codes = column_codes(words.view(np.uint64).reshape(batch.num_rows, k).T)
            yield pa.RecordBatch.from_arrays(
                [pa.array(codes.view(np.int64)), *map(batch.column, ("gain", "backoff", "n"))],
                names=["code", "gain", "backoff", "n"],
            )

    return run


GRAM_BYTES = 16  # of a code and its two values


def _coded(model: DataFrame, params: QualityModel) -> DataFrame:
    """(code, gain, backoff, n, order) of the model's n-grams."""
    coded = None
    for k in range(1, params.order + 1):
        grams = model.where(F.col("order") == k).select(
            "words", F.col("gain").cast("float").alias("gain"), F.col("backoff").cast("float").alias("backoff"), "n"
        )
        rows = grams.mapInArrow(_coded_grams(k), "code long, gain float, backoff float, n long")
        rows = rows.withColumn("order", F.lit(k))
        coded = rows if coded is None else coded.unionByName(rows)
    return coded


def _held(coded: DataFrame) -> Table:
    rows = coded.select("code", "gain", "backoff").toArrow()
    code, gain, backoff = (rows.column(name).to_numpy() for name in ("code", "gain", "backoff"))
    return Table(code.view(np.uint64), gain, backoff)


def _table(model: DataFrame, params: QualityModel) -> Table:
    """The whole model as one table."""
    return _held(_coded(model, params))


def gain_sum(codes: np.ndarray, table: Table, order: int) -> tuple[float, int]:
    """What the table's n-grams add to the logarithm of a text's probability, and how many
    of its words, the end included, the table knows."""
    padded = _padded(codes, order)
    total, known = 0.0, 0
    for n in range(1, order + 1):
        found = table.find(gram_codes(padded, n))
        gains = found[order - n :, 0]  # grams that end in a word of the text or its end
        total += float(gains.sum(dtype=np.float64))
        if n == 1:
            known = int(np.count_nonzero(gains))
        if n < order:  # as the context of the next word
            total += float(found[order - 1 - n : len(padded) - n, 1].sum(dtype=np.float64))
    return total, known


def log_probability(codes: np.ndarray, table: Table, log_unknown: float, order: int) -> float:
    """Natural logarithm of the probability of one text, its end included."""
    total, known = gain_sum(codes, table, order)
    return total + log_unknown * (len(codes) + 1 - known)


def with_keys(rows: DataFrame, *named: Column | str) -> DataFrame:
    """Add two hashes of 64 bits that name a row of these columns; equal rows have equal ones."""
    return rows.withColumns({key: F.xxhash64(F.lit(key), *named) for key in _KEYS})


# What a bucket sends on: of a slice its texts' keys, the places of some of its texts with what
# n-grams add to them; n-grams whose last word's count is not at hand, and such counts.
_SENT = "kind int, home int, model int, slice long, a binary, b binary"
_NAMES, _SUMS, _OPENS, _WORDS = 0, 1, 2, 3
_OPEN = np.dtype([("slice", "<i8"), ("doc", "<u2"), ("model", "<u2"), ("word", "<u8"), ("a", "<f8"), ("b", "<f8")])


def _word_dtype(models: int) -> np.dtype:
    return np.dtype([("word", "<u8"), ("n", "<f4", (models,))])


def _sent_table(kind: int, homes: int, model: int, slices: np.ndarray, a: pa.Array, b: pa.Array) -> pa.Table:
    columns = [np.full(len(slices), kind), slices % homes, np.full(len(slices), model)]
    columns = [pa.array(c.astype(np.int32)) for c in columns]
    return pa.Table.from_arrays([*columns, pa.array(slices), a, b], names=[c.split()[0] for c in _SENT.split(", ")])


def _nothing(rows: int) -> pa.Array:
    return _binaries(np.zeros(0, dtype=np.uint8), np.zeros(rows, dtype=np.int64))


def _by_word(records: np.ndarray, homes: int, kind: int) -> pa.RecordBatch:
    home = mix(records["word"]) % np.uint64(homes)
    by = np.argsort(home, kind="stable")
    records, home = records[by], home[by]
    return _rows_of([(kind, h, 0, 0, records[own].tobytes(), b"") for h, own in _segments(home)], _SENT)


def _added(slice_of: np.ndarray, doc: np.ndarray, log: np.ndarray, names: np.ndarray, homes: int, model: int) -> pa.Table:
    """One sum for each text; ``names`` are of the slices, or rows, that the n-grams are numbered by."""
    place = slice_of.astype(np.int64) << 16 | doc
    by = np.argsort(place)
    place, log = place[by], log[by]
    first = np.flatnonzero(np.diff(place, prepend=-1))
    log = np.add.reduceat(log, first) if len(first) else log
    row, n = np.unique(place[first] >> 16, return_counts=True)
    a = _binaries((place[first] & 0xFFFF).astype(np.uint16), n)
    return _sent_table(_SUMS, homes, model, names[row], a, _binaries(log, n))


def _scored(sent, order: int, abouts: list[Fit], left_out: list[int | None], homes: int, all_sent: list[bool]):
    """What a bucket's n-grams add to the texts they are of: the fitted ones by the model that
    leaves out their fold, the others by the last model."""

    def run(group: pa.Table) -> pa.Table:
        common = abouts[0].plan.common
        fitted, asked = (Grams(group, kind, order, common) for kind in (_FIT, _ASKED))
        bucket = Bucket(group, fitted, abouts, left_out)
        texts = _of_kind(group, _TEXTS)
        names, n = _values(texts, "keys", _TEXT)
        # A slice's row says by its model whether its texts are fitted ones.
        out = [
            _sent_table(_NAMES, homes, 0, texts.column("slice").to_numpy(), _binaries(names, n), _nothing(len(n))).set_column(
                2, "model", texts.column("fold").cast(pa.int32())
            )
        ]
        todo = [(m, fitted, np.flatnonzero(fitted.fold == f)) for m, f in enumerate(left_out) if f is not None]
        for m, grams, own in [*todo, (len(abouts) - 1, asked, slice(None))]:
            words, row, doc, about = grams.words[:, own], grams.row[own], grams.doc[own], abouts[m]
            if not len(row):
                continue
            a, b = bucket.affine(words, m)
            n = sent[m].value.find(words[-1])[:, 0].astype(np.float64)
            log = np.log(a + b * np.where(n > 0, about.word_probability(n), about.even))
            if not all_sent[m]:
                left = np.flatnonzero(n == 0)
                opens = np.empty(len(left), dtype=_OPEN)
                opens["slice"], opens["doc"], opens["model"] = grams.slices[row[left]], doc[left], m
                # Mostly a is 0, so that b can be added here; what is sent is easily compressed then.
                alone = a[left] == 0
                log[left] = np.where(alone, np.log(b[left]), 0.0)
                opens["word"], opens["a"], opens["b"] = words[-1][left], a[left], np.where(alone, 1.0, b[left])
                out.append(pa.Table.from_batches([_by_word(opens, homes, _OPENS)]))
            out.append(_added(row, doc, log, grams.slices, homes, m))
        return pa.concat_tables(out)

    return run


def _word_rows(homes: int, models: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records(batch: pa.RecordBatch) -> np.ndarray:
            found = np.empty(batch.num_rows, dtype=_word_dtype(models))
            found["word"] = batch.column("word").to_numpy(zero_copy_only=False).view(np.uint64)
            for m, n in enumerate(_columns_of(models)):
                found["n"][:, m] = batch.column(n).to_numpy(zero_copy_only=False)
            return found

        # Batches are small, and a home gets a row of each, so some are put together.
        batches = map(records, batches)
        while some := list(islice(batches, 50)):
            yield _by_word(np.concatenate(some), homes, _WORDS)

    return run


def _summed(group: pa.Table, homes: int) -> list[pa.Table]:
    """The names of slices as they are, and one row of sums for each slice."""
    names = _of_kind(group, _NAMES).select([c.split()[0] for c in _SENT.split(", ")])
    sums = _of_kind(group, _SUMS)
    doc, n = _values(sums, "a", np.uint16)
    slices, at = np.unique(sums.column("slice").to_numpy(), return_inverse=True)
    return [names, _added(np.repeat(at, n), doc, _values(sums, "b", np.float64)[0], slices, homes, 0)]


def _sums(homes: int):
    return lambda group: pa.concat_tables(_summed(group, homes))


def _closed(abouts: list[Fit], homes: int):
    """Sums of slices; n-grams meet the counts of their last words."""

    def run(group: pa.Table) -> pa.Table:
        out = _summed(group, homes)
        opens, _n = _values(_of_kind(group, _OPENS), "a", _OPEN)
        words, _n = _values(_of_kind(group, _WORDS), "a", _word_dtype(len(abouts)))
        if len(opens):
            at, known = _in(words["word"], opens["word"])
            p = np.empty(len(opens))
            for m, about in enumerate(abouts):
                own = np.flatnonzero(opens["model"] == m)
                n = np.zeros(len(own))
                n[known[own]] = words["n"][at[own[known[own]]], m]
                p[own] = np.where(n > 0, about.word_probability(n), about.even)
            log = np.log(opens["a"] + opens["b"] * p)
            names, row = np.unique(opens["slice"], return_inverse=True)
            out.append(_added(row, opens["doc"], log, names, homes, 0))
        return pa.concat_tables(out)

    return run


_ADDED = "fitted int, key1 long, key2 long, words long, log double"


def _put_together(group: pa.Table) -> pa.Table:
    """The sums of a slice's texts, once for each copy of the slice."""
    named = _of_kind(group, _NAMES)
    names, sums = _values(named, "a", _TEXT)[0], _of_kind(group, _SUMS)
    copies = named.num_rows
    if not copies:
        raise ValueError("texts came in another order when they were read again")
    doc, log = _values(sums, "a", np.uint16)[0], _values(sums, "b", np.float64)[0]
    log = np.bincount(doc, log, len(names) // copies) / copies
    columns = {name: np.ascontiguousarray(names[name], dtype=np.int64) for name in (*_KEYS, "words")}
    fitted = np.full(len(names), named.column("model")[0].as_py(), dtype=np.int32)
    return pa.table({"fitted": fitted, **columns, "log": np.tile(log, copies)})


class Scorer:
    """Trained models; scores texts (key1, key2, text) by (key1, key2, quality_words,
    quality_log), one row per different text of a key.

    The model of all texts scores. If they have a ``fold`` and keys, there is a model more for each of
    the ``folds``, which leaves it out; ``left_out`` are the scores of the fitted texts by these.
    """

    def __init__(self, texts: DataFrame, params: QualityModel, plan: Plan | None = None, folds: list[int] | None = None):
        self.spark, self.order = texts.sparkSession, params.order
        self.plan = plan or _plan(texts, params)[0]
        columns, self.folds = ("text", *_KEYS, "fold") if folds else ("text",), [*(folds or []), None]
        self.texts, self.left_out = texts.select(*columns), None
        self.counts = Counts(self.texts.drop(*_KEYS), params, self.plan, self.folds)
        fits: list[Fit] = []
        for m, fold in enumerate(self.folds):
            own = texts if fold is None else texts.where(F.col("fold") != fold)
            _model, self.log_unknown = train(own, params, self.plan, fits, self.counts, m)
        self.abouts, self.sent, self.all_sent, rest = fits, [], [], F.lit(False)
        for m, about in enumerate(fits):
            # The model of all has half of what may be sent, or all of it.
            room = params.pass_bytes // GRAM_BYTES
            if folds:
                room = room // 2 if m == len(folds) else room // (2 * len(folds))
            # Frequent words have high levels.
            words = about.words.select("word", "n", F.floor(F.log2("n") * 4).cast("int").alias("level"))
            # As many of the highest levels as may be sent; at most 256 levels.
            sent_level, all_sent = 256, True
            for row in words.groupBy("level").count().orderBy(F.desc("level")).collect():
                room -= row["count"]
                if room < 0:
                    all_sent = False
                    break
                sent_level = row["level"]
            self.all_sent.append(all_sent)
            sent = words.where(F.col("level") >= sent_level)
            backoff = F.lit(0.0).cast("float").alias("backoff")
            self.sent.append(sent.select(F.col("word").alias("code"), F.col("n").cast("float").alias("gain"), backoff))
            n = F.col(_columns_of(len(fits))[m])
            rest = rest | ((n > 0) & (F.floor(F.log2(F.when(n > 0, n)) * 4) < sent_level))
        self.rest = self.counts.words.where(rest)
        self.all_sent, self._all_sent = all(self.all_sent), self.all_sent

    def __call__(self, rows: DataFrame) -> DataFrame:
        rows = rows.select(*_KEYS, "text")
        order, plan, folds = self.order, self.plan, len(self.folds) > 1
        abouts = [about.without_words() for about in self.abouts]
        sent = [self.spark.sparkContext.broadcast(_held(words)) for words in self.sent]
        homes, parts = plan.buckets, []
        with freed_shuffles(self.spark):
            for turn in range(plan.passes):
                asked = rows.mapInArrow(_deal(order, plan, turn, _ASKED, True), _DEALT)
                dealt = _dealt_fit(self.texts, self.counts.pairs, order, plan, turn, folds).unionByName(asked)
                sums = dealt.groupBy("bucket").applyInArrow(
                    _scored(sent, order, abouts, self.folds, homes, self._all_sent), _SENT
                )
                if not self.all_sent:
                    words = self.rest.mapInArrow(_word_rows(homes, len(abouts)), _SENT)
                    sums = sums.unionByName(words).groupBy(F.col("kind") <= _SUMS, "home")
                    sums = sums.applyInArrow(_closed(abouts, homes), _SENT)
                # What is kept of a pass is a number a text.
                parts.append(settle(sums.groupBy("home").applyInArrow(_sums(homes), _SENT), "sums"))
            added = parts[0]
            for part in parts[1:]:
                added = added.unionByName(part)
            # Rows with the same keys have the same text and add the same.
            added = added.groupBy("slice").applyInArrow(_put_together, _ADDED)
            log = (F.sum("log") / F.count(F.lit(1))).alias("quality_log")
            added = added.groupBy("fitted", *_KEYS).agg(F.max("words").alias("quality_words"), log)
            added = settle(added, "sums")
        for part in parts:
            drop_settled(part)
        for words in sent:
            words.unpersist()
        self.left_out = added.where("fitted = 1").drop("fitted")
        return added.where("fitted = 0").drop("fitted")

    def free(self) -> None:
        self.counts.free()


def judged(
    documents: DataFrame,
    trusted: DataFrame,
    params: QualityModel = QualityModel(),
    carried: tuple[str, ...] | None = None,
) -> DataFrame:
    """(row, quality_words, quality_log, perplexity, threshold, keep): ``row`` is a struct
    of all columns of ``documents`` as given, so further columns of any name do no harm, or
    of the ``carried`` ones; what it holds is shuffled once, so leave out texts not wanted.

    Needs text, lang and doc_id (long); ``trusted`` holds doc_id. NULL and empty texts hold
    no words, are judged by their end alone and drawn to the mean, so they are kept; NULL
    languages are a language of their own; documents of a language without trusted ones are
    kept, under an infinite threshold. An empty table gives an empty table. Repeated rows
    are judged alike.
    """
    spark = documents.sparkSession
    small_batches(spark)
    docs = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
    )
    # The fit reads all trusted documents unless it is told how many per language; then a hash
    # of the id decides. They are dealt evenly over the folds, so that a language of few
    # documents is in each; a language of many is dealt in parts.
    named = docs.select("doc_id", "lang").join(trusted.select(F.col("doc_id").cast("long")).distinct(), "doc_id")
    named = settle(named.distinct(), "trusted")
    sizes = named.groupBy("lang").agg(F.count(F.lit(1)).alias("size"))
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.ceil(F.col("size") / 10_000))
    dealt = W.partitionBy("lang", part).orderBy(F.xxhash64("doc_id", F.lit("split")), "doc_id")
    named = named.join(sizes, "lang")
    if params.sample_per_language is not None:
        draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
        named = named.where(draw * F.col("size") < params.sample_per_language)
    wanted = settle(
        named.select(
            "doc_id",
            F.pmod(F.row_number().over(dealt), F.lit(params.calibrate)).alias("fold"),
        ),
        "fitted",
    )
    sample = docs.join(wanted.groupBy("doc_id").agg(F.min("fold").alias("fold")), "doc_id")
    sample = settle(with_keys(sample, "doc_id", "lang", "text"), "fitted_texts")
    folds = [r["fold"] for r in wanted.select("fold").distinct().orderBy("fold").collect()]
    per_word = -F.col("quality_log") / (F.col("quality_words") + 1)
    given = documents.select(
        F.struct(*(carried or "*")).alias("given"),
        F.col("doc_id").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        F.col("text").cast("string").alias("text"),
    )
    # The id spreads copies of a text; rows alike in all three are judged alike.
    given = with_keys(given, "doc_id", "lang", "text")
    # The models without a fold score it, the last one judges the table, all from one count.
    scorer = Scorer(sample, params, _plan(docs, params)[0], folds or [0])
    scores = scorer(given)
    held = sample.select(*_KEYS, "lang").join(scorer.left_out, list(_KEYS))
    held = settle(held.select("lang", "quality_words", "quality_log", per_word.alias("per_word")), "calibration")
    scorer.free()
    drop_settled(sample)
    everything = held.agg(F.avg("per_word").alias("mean")).first()["mean"]
    if everything is None:
        everything = -scorer.log_unknown
    size, prior = F.count(F.lit(1)), F.lit(params.prior_documents)

    def towards(own: Column, pooled: float) -> Column:
        return (size * own + prior * pooled) / (size + prior)

    means = held.groupBy("lang").agg(towards(F.avg("per_word"), everything).alias("mean"))

    def shrunk(frame: DataFrame) -> DataFrame:
        mean = F.coalesce("mean", F.lit(everything))
        words = F.col("quality_words") + 1
        return frame.withColumn("mean", mean).withColumn(
            "drawn", (-F.col("quality_log") + params.prior_words * mean) / (words + params.prior_words)
        )

    calibrated = settle(shrunk(held.join(means, "lang")), "calibrated")
    quantile = F.percentile("drawn", F.lit(params.quantile))
    overall = calibrated.agg(quantile.alias("limit")).first()["limit"]
    limit = F.greatest(quantile, towards(quantile, overall if overall is not None else float("inf")))
    # One row per language of the trusted documents.
    bounds = settle(calibrated.groupBy("lang").agg(F.first("mean").alias("mean"), limit.alias("limit")), "bounds")
    found = given.drop("doc_id", "text").join(scores, list(_KEYS))
    found = shrunk(found.join(bounds, "lang", "left"))
    limit = F.coalesce("limit", F.lit(float("inf")))
    limit = F.col("mean") + F.greatest(F.lit(0.0), limit - F.col("mean")) * params.slack
    return found.select(
        F.col("given").alias("row"),
        "quality_words",
        "quality_log",
        F.exp("drawn").alias("perplexity"),
        F.exp(limit).alias("threshold"),
        F.coalesce(F.col("drawn") <= limit, F.lit(True)).alias("keep"),
    )


def keep_good(documents: DataFrame, trusted: DataFrame, params: QualityModel = QualityModel()) -> DataFrame:
    """The rows of ``documents`` that the classifier keeps, columns as given."""
    return judged(documents, trusted, params).where("keep").select("row.*")
