import random
import re

import numpy as np
import pytest

from perennial.llm import odd_sketch
from perennial.llm.components import components
from perennial.llm.odd_sketch import Rule, drop_near_duplicates, near_duplicates

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, n=5, percent=80):
    sets = {}
    for doc, text in rows:
        w = WORD.findall((text or "").translate(LOWER))
        sets[doc] = {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def edited(text, changes, seed):
    words, draw = text.split(), random.Random(seed)
    for _ in range(changes):
        words[draw.randrange(len(words))] = f"x{draw.random()}"
    return " ".join(words)


@pytest.fixture
def rows(prose):
    out = [(i, prose(20 + i, i)) for i in range(20)]
    for group in range(12):
        base = prose(60 + 10 * group, 100 + group)
        out += [(len(out) + 10 + k, edited(base, k % 5, k)) for k in range(12)]
    out += [(900, None), (901, ""), (902, " \n"), (903, "one"), (904, "ONE"), (905, "one two"), (906, "a b c d e"), (907, "w " * 90_000)]
    return out


@pytest.mark.parametrize("shingle", [4, 5])
def test_components_equal_brute_force(documents, rows, shingle):
    assert found(near_duplicates(documents(rows), Rule(shingle))) == brute(rows, shingle)


def test_large_groups_in_chunks_and_blocks(documents, prose, monkeypatch):
    """Copies at the edge of the rule, with chunks and blocks far smaller than the group."""
    base = prose(120, 1)
    rows = [(i, edited(base, 1 + i % 6, i)) for i in range(150)]
    monkeypatch.setattr(odd_sketch, "CHUNK", 8)
    monkeypatch.setattr(odd_sketch, "FAMILY_SHINGLES", 2000)
    monkeypatch.setattr(odd_sketch, "SKETCH_LIMIT", 70)
    got, want = found(near_duplicates(documents(rows))), brute(rows)
    assert got == want and len({c for _n, c in want.values()}) > 3


def test_a_third_are_exact_copies(documents, prose):
    rows = [(i, prose(40, 1) if i % 3 == 0 else prose(40, 10 + i)) for i in range(90)]
    got = found(near_duplicates(documents(rows)))
    assert all(got[i][1] == (0 if i % 3 == 0 else i) for i in range(90))


def test_null_ids_repeated_rows_empty_tables_and_columns(documents, prose):
    text = prose(30, 1)
    df = documents([(5, text), (5, text), (None, text), (3, text), (9, None), (9, None)])
    df = df.withColumnRenamed("lang", "component_id").withColumnRenamed("source", "key")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_duplicates(df).collect()), key=str)
    assert got == [(3, 3, True), (5, 3, False), (5, 3, False), (9, 9, True), (9, 9, True), (None, None, True)]
    out = drop_near_duplicates(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id for r in out.collect()), key=str) == [3, 9, None]
    assert near_duplicates(documents([])).collect() == [] == drop_near_duplicates(documents([])).collect()


def test_sketches_estimate_similarity():
    draw = np.random.default_rng(1)
    for share in (0.7, 0.8, 0.9, 1.0):
        guesses = []
        for _ in range(60):
            common = draw.integers(0, 2**63, int(400 * share)).astype(np.uint64)
            own = draw.integers(0, 2**63, (2, (400 - len(common)) // 2)).astype(np.uint64)
            sets = [np.unique(np.concatenate([common, o])) for o in own]
            sketch = odd_sketch.odd_sketches(np.stack([odd_sketch.samples(s) for s in sets]))
            bits = int(np.bitwise_count(sketch[0] ^ sketch[1]).sum())
            assert bits <= odd_sketch.SKETCH_LIMIT or share < 0.8
            guesses.append(odd_sketch.similarity(bits))
        assert abs(np.mean(guesses) - share) < 0.03


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(1, 60)]
    star = [(100, 100 + i) for i in range(1, 30)]
    edges = [*chain, *star, (200, 200), (301, 300), (300, 301), (302, 301)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = dict.fromkeys(range(1, 61), 1) | dict.fromkeys(range(100, 130), 100) | dict.fromkeys((300, 301, 302), 300)
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
