import math

import numpy as np
import pytest

from perennial.llm.embedding_dedup import TABLE_BITS, Itq, drop_near_vectors, fit, near_vectors, sign_codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, least=0.93):
    links = {v: set() for v, _e, _l in rows}
    for a, x, k in rows:
        for b, y, m in rows:
            if a == b or k is None or k != m or not x or not y or len(x) != len(y):
                continue
            if any(c is None or not math.isfinite(c) for c in [*x, *y]):
                continue
            norm = math.hypot(*x) * math.hypot(*y)
            if norm and sum(p * q for p, q in zip(x, y, strict=True)) / norm >= least:
                links[a].add(b)
    root = {}
    for v in sorted(links):
        todo = [v]
        while todo:
            u = todo.pop()
            if u not in root:
                root[u] = v
                todo += links[u]
    return {v: (len(links[v]), root[v]) for v in links}


def found(df):
    return {r.vec_id: (r.n_links, r.component_id) for r in df.collect()}


def vectors(seed=1, groups=30, dim=16):
    random = np.random.default_rng(seed)
    rows, number = [], 0
    for group in range(groups):
        centre = random.standard_normal(dim)
        for _copy in range(1 + group % 5):
            noisy = centre + random.standard_normal(dim) * 0.18 * (group % 3)
            rows.append((number, noisy.astype(np.float32).tolist(), group % 2))
            number += 1
    return rows


def test_links_and_components_equal_brute_force(spark):
    rows = vectors()
    got, want = found(near_vectors(spark.createDataFrame(rows, SCHEMA))), brute(rows)
    assert got.keys() == want.keys()
    recall = sum(n for n, _c in got.values()) / sum(n for n, _c in want.values())
    assert recall >= 0.99
    assert all(got[v][0] <= want[v][0] for v in got)


def test_odd_vectors_link_with_nothing(spark):
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1),
        (6, [], 1), (7, [0.0, 0.0], 1), (8, [1.0, None], 1), (9, [1.0, float("nan")], 1),
        (10, [1.0, float("inf")], 1), (11, [1.0, 0.0, 0.0], 1), (12, [1e-30, 0.0], 1),
    ]
    got = found(near_vectors(spark.createDataFrame(rows, SCHEMA)))
    assert got == brute(rows)
    assert got[1] == (2, 1) and got[12] == (2, 1) and got[7] == (0, 7)


def test_null_ids_repeated_rows_and_clashing_columns(spark):
    schema = "vec_id long, embedding array<float>, label int, id string, code long, a int"
    same = [1.0, 2.0, 3.0]
    rows = [(7, same, 1, "x", 1, 1), (7, same, 1, "y", 1, 1), (8, same, 1, "z", 1, 1), (None, same, 1, "n", 1, 1)]
    df = spark.createDataFrame(rows, schema)
    got = sorted(near_vectors(df).collect(), key=lambda r: (r.vec_id is None, r.vec_id, r.n_links))
    assert [(r.vec_id, r.n_links, r.kept) for r in got] == [(7, 2, True), (7, 2, True), (8, 2, False), (None, 0, True)]
    assert sorted(r.id for r in drop_near_vectors(df).collect()) == ["n", "x", "y"]


def test_empty_table(spark):
    assert near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []


def test_small_sample_still_finds(spark):
    rows = vectors(seed=3)
    got, want = found(near_vectors(spark.createDataFrame(rows, SCHEMA), Itq(sample=20))), brute(rows)
    assert sum(n for n, _c in got.values()) >= 0.95 * sum(n for n, _c in want.values())


def _around_a_direction(share, n, dim=128, seed=5):
    """Unit vectors whose mean has the squared norm ``share``."""
    own = np.random.default_rng(seed).standard_normal((n, dim))
    own[:, 0] = 0
    own /= np.linalg.norm(own, axis=1, keepdims=True)
    rows = np.sqrt(1 - share) * own
    rows[:, 0] = np.sqrt(share)
    return rows


@pytest.mark.parametrize("share", [0.0, 0.5, 0.7, 0.8, 0.9])
def test_codes_meet_at_the_least_cosine_whatever_the_mean(share):
    rows = _around_a_direction(share, 6000)
    model = fit(rows[:3000], Itq(rounds=20))
    # Pairs not seen by the fit, at raw cosine 0.93 to 0.95, both about the common direction.
    random = np.random.default_rng(9)
    x, cosine = rows[3000:], random.uniform(0.93, 0.95, 3000)
    own = x.copy()
    own[:, 0] = 0
    own /= np.linalg.norm(own, axis=1, keepdims=True)
    across = random.standard_normal(own.shape)
    across[:, 0] = 0
    across -= (across * own).sum(axis=1, keepdims=True) * own
    across /= np.linalg.norm(across, axis=1, keepdims=True)
    inner = ((cosine - share) / (1 - share))[:, None]
    y = np.sqrt(1 - share) * (inner * own + np.sqrt(1 - inner * inner) * across)
    y[:, 0] = np.sqrt(share)
    assert np.allclose((x * y).sum(axis=1), cosine)
    met, differing = np.zeros(len(x), dtype=bool), np.zeros(len(x))
    for projection in model.projections:
        apart = sign_codes(x, model.mean, projection) ^ sign_codes(y, model.mean, projection)
        for k in range(4):
            bits = np.bitwise_count((apart >> np.uint64(TABLE_BITS * k)) & np.uint64(0xFFFF))
            met |= bits <= 2
            differing += bits
    assert (met & (differing <= model.max_differing)).mean() >= 0.99
    assert share > 0 or len(model.projections) == 1


@pytest.mark.parametrize("share", [0.6, 0.97])
def test_links_of_vectors_about_a_direction(spark, share):
    base = _around_a_direction(share, 60, dim=32)
    noise = np.random.default_rng(3).standard_normal(base.shape) * 0.05
    every = np.concatenate([base, base + noise])
    rows = [(k, v.astype(np.float32).tolist(), 1) for k, v in enumerate(every)]
    got, want = found(near_vectors(spark.createDataFrame(rows, SCHEMA))), brute(rows)
    recall = sum(n for n, _c in got.values()) / sum(n for n, _c in want.values())
    assert recall >= 0.99 and all(got[v][0] <= want[v][0] for v in got)
