from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from perennial.llm.bins import FreeSpace, pack, split_lengths
from perennial.llm.token_packing import (
    PackedTokens,
    Tokenizer,
    packed_sequences,
    segments,
    write_sequences,
)

SMALL = PackedTokens(length=16, block_tokens=200)


def whole(rows, params):
    pieces = defaultdict(dict)
    for row in rows:
        for doc, piece, ids in segments(row, params):
            pieces[doc][piece] = ids
    return {d: np.concatenate([p[k] for k in sorted(p)]) for d, p in pieces.items()}


def test_round_trip_and_layout(documents, prose):
    rows = [(i, prose(1 + 5 * i, i)) for i in range(20)]
    rows += [(50, None), (51, ""), (52, "  spaces\n\n and\ttabs  "), (53, "a b 　 c"), (54, "it's <|endoftext|> 12,5")]
    packed = packed_sequences(documents(rows), SMALL).collect()
    tokenizer = Tokenizer(SMALL)
    got = whole(packed, SMALL)
    for doc, text in rows:
        assert got[doc][-1] == SMALL.end_token
        assert tokenizer.decode(got[doc][:-1].tolist()) == (text or "")
    for row in packed:
        ids, positions = np.frombuffer(row.input_ids, "<u2"), np.frombuffer(row.position_ids, "<u2")
        assert len(ids) == len(positions) == 16 and row.cu_seqlens[-1] == row.n_tokens
        for a, b in zip(row.cu_seqlens, row.cu_seqlens[1:], strict=False):
            assert positions[a:b].tolist() == list(range(b - a))
        assert (ids[row.n_tokens :] == SMALL.end_token).all()


TEXT = st.text(alphabet="aA1.'é漢 \n\t  -<|>", max_size=60)


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=4))
def test_words_encoded_apart_equal_the_whole_text(texts):
    tokenizer = Tokenizer(SMALL)
    got = tokenizer.encode(pa.array(texts, pa.string()))
    assert [g.tolist() for g in got] == [tokenizer.encoding.encode_ordinary(t) for t in texts]


def test_wide_ids(documents):
    params = PackedTokens(length=8, id_bytes=4)
    (row,) = packed_sequences(documents([(1, "a b")]), params).collect()
    assert len(row.input_ids) == 32 and isinstance(Tokenizer(params).encoding, tiktoken.Encoding)


def test_odd_tables(documents, spark, root):
    assert packed_sequences(documents([])).collect() == []
    df = documents([(None, "x y"), (None, "x y"), (1, "z")]).withColumnRenamed("lang", "pieces")
    assert sorted(packed_sequences(df.coalesce(1), SMALL).first().doc_ids, key=str) == [1, None, None]
    write_sequences(df.coalesce(1), f"{root}/packed", SMALL)
    assert spark.read.parquet(f"{root}/packed").count() == 1


@given(st.lists(st.integers(1, 64), max_size=120), st.sampled_from([[64], [16, 64], [8, 32, 64]]))
def test_packing_is_best_fit_decreasing(lengths, capacities):
    bin_of, offset, final = pack(lengths, capacities)
    held = defaultdict(list)
    for k, b in enumerate(bin_of):
        held[b].append((offset[k], lengths[k]))
    for b, parts in held.items():
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at <= final[b] and final[b] == min(c for c in capacities if c >= at)
    if len(capacities) == 1:  # against a plain search over all bins
        space, want = [], []
        for k in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
            fits = [s for s in space if s >= lengths[k]]
            if fits:
                space.remove(min(fits))
                space.append(min(fits) - lengths[k])
            else:
                space.append(64 - lengths[k])
            want.append(lengths[k])
        assert len(space) == len(final)


def test_free_space_and_splitting():
    space = FreeSpace(10)
    assert space.tightest(1) is None
    space.put(7, 1)
    space.put(4, 2)
    assert (space.tightest(4), space.tightest(5), space.tightest(8)) == (4, 7, None)
    assert space.take(4) == 2 and space.tightest(1) == 7
    assert split_lengths(0, 5) == [] and split_lengths(12, 5) == [5, 5, 2] and split_lengths(10, 5) == [5, 5]


@pytest.mark.parametrize("cost", [0, 1000])
def test_a_bin_costs(cost):
    _bins, _offsets, final = pack([8, 8, 8, 8], [8, 32], cost)
    assert final == ([32] if cost else [8, 8, 8, 8])
