import random
from collections import Counter, defaultdict

import pytest

from perennial.llm.bins import pack
from perennial.llm.variable_bins import Capacities, packed_documents


def run(df, **params):
    return packed_documents(df, Capacities(**params)).collect()


def test_every_word_is_placed_once(documents, prose):
    rows = [(i, prose((i * 37) % 150, i)) for i in range(1, 120)]
    rows += [(500, None), (501, ""), (502, " \t"), (503, "w " * 5000)]
    out = run(documents(rows), words=(16, 32, 64), group_words=1500)
    length = {d: len((t or "").split()) for d, t in rows}
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in out:
        pieces[r.doc_id].append((r.start_word, r.length, r.piece, r.n_pieces))
        if r.bin_id is not None:
            bins[r.bin_id].append(r)
    assert pieces.keys() == length.keys()
    for d, parts in pieces.items():
        at = 0
        for k, (start, n, piece, of) in enumerate(sorted(parts)):
            assert (start, piece, of) == (at, k, len(parts)) and n <= 64
            at += n
        assert at == length[d]
    for parts in bins.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.bin_offset):
            assert r.bin_offset == at
            at += r.length
        assert {r.bin_used for r in parts} == {at}
        assert {r.bin_capacity for r in parts} == {min(c for c in (16, 32, 64) if c >= at)}
    used = sum(length.values())
    room = sum(parts[0].bin_capacity for parts in bins.values())
    assert used > 0.97 * room


def test_small_contents_get_small_bins(documents):
    out = run(documents([(1, "a b c")]))
    assert [(r.bin_capacity, r.bin_used) for r in out] == [(256, 3)]


def test_odd_tables(documents):
    assert run(documents([])) == []
    df = documents([(None, "a b"), (None, "a b"), (1, "c")]).withColumnRenamed("lang", "length").withColumnRenamed("source", "group")
    out = run(df)
    assert sorted(r.length for r in out) == [1, 2, 2] and len({r.bin_id for r in out}) == 1


def _cost(capacities, square=8192, bin_cost=32):
    return sum(c + c * c / square + bin_cost for c in capacities)


@pytest.mark.parametrize("longest", [120, 400, 900, 2048])
def test_several_capacities_cost_less_than_one(longest):
    draw = random.Random(longest)
    lengths = [draw.randint(1, longest) for _ in range(4000)]
    sizes = [256, 512, 1024, 2048]
    _bins, _offsets, joint = pack(lengths, sizes, 32, 8192)
    alone = []
    for size in (s for s in sizes if s >= longest):
        _bins, _offsets, single = pack(lengths, [size], 32, 8192)
        alone.append(_cost(single))
    assert _cost(joint) <= 1.001 * min(alone)


def test_capacities_are_chosen_by_the_lengths():
    sizes = [256, 512, 1024, 2048]
    # Nothing fits beside 250 words in the smallest bin, two of them fill the next one.
    _bins, _offsets, pairs = pack([250] * 1000, sizes, 32, 8192)
    # The last ones find too little left beside them and open the smallest bin.
    assert Counter(pairs)[512] >= 480 and set(pairs) <= {256, 512}
    # Beside 240 words nothing is left to fill a longer bin but words of other bins.
    _bins, _offsets, alone = pack([240], sizes, 32, 8192)
    assert alone == [256]
    draw = random.Random(5)
    _bins, _offsets, mixed = pack([draw.randint(1, 1500) for _ in range(3000)], sizes, 32, 8192)
    count = Counter(mixed)
    assert min(count[512], count[1024], count[2048]) > 50


def test_open_bins_have_their_part_first():
    # The 100 words to come go beside the 400, so nothing is left to fill a bin of 2,048.
    bins, offsets, final = pack([400, 300, 100], [400, 512, 2048], 0)
    assert sorted(final) == [400, 400] and bins[1] == bins[2] and offsets[2] == 300
