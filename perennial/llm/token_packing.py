"""Texts as token ids in packed training sequences, written as binary matrices.

Each task tokenises its texts and packs them as it goes, a block of about ``block_tokens``
ids at a time, so no token crosses the network. Texts longer than a sequence are split into
whole sequences and a rest; nothing is cut off. The pieces of a block are packed by best-fit
decreasing, the tightest open sequence being found in a segment tree.

A row of the result is one sequence: its ids as little-endian integers of ``id_bytes`` each,
always ``length`` of them (padded with the end token), the cumulative lengths of its
segments, and position ids (two bytes, four beyond 65,536 places) that start from 0 again
in every segment.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perennial.llm.bins import pack, split_lengths
from perennial.llm.shared import small_batches
from perennial.llm.wordcodes import slices, span_codes, text_bytes, word_spans

# Fixed value: the pre-tokenisation pattern of the byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# White space of Unicode beyond ASCII, next to which words are not cut apart.
_WIDE_SPACE = re.compile("[\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")


@dataclass(frozen=True)
class PackedTokens:
    vocabulary: str = "/opt/tokenizers/byte_bpe_50k.tiktoken"
    length: int = 2048
    end_token: int = 50256
    id_bytes: int = 2
    block_tokens: int = 1 << 21
    cached_words: int = 1 << 18


@lru_cache(maxsize=2)
def _encoding(vocabulary: str) -> tiktoken.Encoding:
    """Built once per Python worker."""
    with open(vocabulary, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class Tokenizer:
    """Byte-level BPE that encodes each different word of a batch once.

    A piece of the pattern never runs from a word into white space, so a text may be cut
    before the white space that precedes a word. Texts with other white space than ASCII's
    are encoded whole.
    """

    def __init__(self, params: PackedTokens):
        self.encoding = _encoding(params.vocabulary)
        self.limit = params.cached_words
        self.cache: dict[int, np.ndarray] = {}

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        plain = [t is None or not _WIDE_SPACE.search(t) for t in texts.to_pylist()]
        data, offsets = text_bytes(texts)
        starts, ends = word_spans(data, offsets)
        first = np.searchsorted(starts, offsets)
        # From the end of the word before, or of the text's begin, to the word's own end.
        begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        heads = first[:-1][first[:-1] < first[1:]]
        begins[heads] = offsets[:-1][first[:-1] < first[1:]]
        codes = span_codes(data, begins, ends)
        different, at, place = np.unique(codes, return_index=True, return_inverse=True)
        if len(self.cache) > self.limit:
            self.cache.clear()
        pieces = []
        for code, k in zip(different.tolist(), at, strict=True):
            ids = self.cache.get(code)
            if ids is None:
                text = data[begins[k] : ends[k]].tobytes().decode("utf-8")
                ids = np.array(self.encoding.encode_ordinary(text), dtype=np.int32)
                self.cache[code] = ids
            pieces.append(ids)
        sizes = np.array([len(p) for p in pieces], dtype=np.int64)
        flat = np.concatenate(pieces) if pieces else np.zeros(0, np.int32)
        from_ = np.cumsum(sizes) - sizes
        counts = sizes[place]
        begin_of = np.cumsum(counts) - counts
        gather = np.repeat(from_[place] - begin_of, counts) + np.arange(counts.sum())
        ids = flat[gather]
        bounds = np.concatenate([begin_of, [len(ids)]])
        out = []
        for i, ok in enumerate(plain):
            if not ok:
                out.append(np.array(self.encoding.encode_ordinary(texts[i].as_py()), dtype=np.int32))
                continue
            words = ids[bounds[first[i]] : bounds[first[i + 1]]]
            last = ends[first[i + 1] - 1] if first[i + 1] > first[i] else offsets[i]
            if last < offsets[i + 1]:
                tail = self.encoding.encode_ordinary(data[last : offsets[i + 1]].tobytes().decode("utf-8"))
                words = np.concatenate([words, np.array(tail, dtype=np.int32)])
            out.append(words)
        return out

    def decode(self, ids) -> str:
        return self.encoding.decode(list(ids))


def _sequences(block: list[tuple[int | None, np.ndarray]], params: PackedTokens, name: str) -> pa.RecordBatch:
    """Pack the texts of one block; every text is closed by the end token."""
    pieces, owners = [], []
    for doc_id, ids in block:
        closed = np.append(ids, np.int32(params.end_token))
        at = 0
        for k, size in enumerate(split_lengths(len(closed), params.length)):
            pieces.append(closed[at : at + size])
            owners.append((doc_id, k))
            at += size
    bin_of, _offset, capacities = pack([len(p) for p in pieces], [params.length])
    contents: list[list[int]] = [[] for _ in capacities]
    for piece, chosen in enumerate(bin_of):
        contents[chosen].append(piece)
    kind, place = np.dtype(f"<u{params.id_bytes}"), np.dtype("<u2" if params.length <= 1 << 16 else "<u4")
    rows = {"seq_id": [], "n_tokens": [], "input_ids": [], "cu_seqlens": [], "position_ids": [], "doc_ids": [], "pieces": []}
    for number, held in enumerate(contents):
        sizes = [len(pieces[p]) for p in held]
        ids = np.full(params.length, params.end_token, dtype=kind)
        positions = np.zeros(params.length, dtype=place)
        ids[: sum(sizes)] = np.concatenate([pieces[p] for p in held])
        positions[: sum(sizes)] = np.concatenate([np.arange(s, dtype=place) for s in sizes])
        rows["seq_id"].append(f"{name}-{number}")
        rows["n_tokens"].append(sum(sizes))
        rows["input_ids"].append(ids.tobytes())
        rows["cu_seqlens"].append([0, *np.cumsum(sizes).tolist()])
        rows["position_ids"].append(positions.tobytes())
        rows["doc_ids"].append([owners[p][0] for p in held])
        rows["pieces"].append([owners[p][1] for p in held])
    kinds = (pa.string(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()))
    return pa.RecordBatch.from_arrays(
        [pa.array(v, t) for v, t in zip(rows.values(), kinds, strict=True)], names=list(rows)
    )


_SEQUENCE = (
    "seq_id string, n_tokens int, input_ids binary, cu_seqlens array<int>, position_ids binary, "
    "doc_ids array<long>, pieces array<int>"
)


def _packed(params: PackedTokens):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, part, number = Tokenizer(params), TaskContext.get().partitionId(), 0
        block, size = [], 0
        for batch in batches:
            for rows in slices(batch):
                for doc_id, ids in zip(rows.column("doc_id").to_pylist(), tokenizer.encode(rows.column("text")), strict=True):
                    block.append((doc_id, ids))
                    size += len(ids) + 1
                    if size >= params.block_tokens:
                        yield _sequences(block, params, f"{part}-{number}")
                        block, size, number = [], 0, number + 1
        if block:
            yield _sequences(block, params, f"{part}-{number}")

    return run


def packed_sequences(documents: DataFrame, params: PackedTokens = PackedTokens()) -> DataFrame:
    """One row per sequence of ``length`` ids: seq_id, n_tokens (without padding), input_ids,
    cu_seqlens, position_ids, and for each segment its doc_id and piece number.

    Needs doc_id (long) and text; further columns are not read. NULL and empty texts are an
    end token alone. Repeated rows and rows without doc_id are packed like any other. An
    empty table gives an empty table. Sequences depend on how the table is cut into tasks,
    their texts do not.
    """
    small_batches(documents.sparkSession)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_packed(params), _SEQUENCE)


def write_sequences(documents: DataFrame, path: str, params: PackedTokens = PackedTokens()) -> None:
    """The packed sequences as Parquet, matrices in binary cells."""
    packed_sequences(documents, params).write.mode("overwrite").parquet(path)


def segments(row, params: PackedTokens = PackedTokens()) -> list[tuple[int | None, int, np.ndarray]]:
    """The (doc_id, piece, ids) of a row, for readers and tests."""
    ids = np.frombuffer(row["input_ids"], dtype=f"<u{params.id_bytes}")
    cuts = row["cu_seqlens"]
    return [
        (doc, piece, ids[a:b])
        for doc, piece, a, b in zip(row["doc_ids"], row["pieces"], cuts, cuts[1:], strict=False)
    ]
