import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from perennial.llm.pareto_mix import Mix, mixed, with_copies

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def water_fill(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Targets by the wording: share by weight, cut at the bound, share the rest again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target = dict.fromkeys(names, 0.0)
    left, open_ = share * sum(sizes.values()), set(names)
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if target[s] + left * weight[s] / total >= most * sizes[s]}
        if not over:
            for s in open_:
                target[s] += left * weight[s] / total
            break
        for s in over:
            left -= most * sizes[s] - target[s]
            target[s] = most * sizes[s]
        open_ -= over
    return target


def run(df, params=Mix()):
    return with_copies(df, params).select("row.*", "size", "source_size", "target", "copies").collect()


@pytest.fixture
def table(documents, prose):
    rows = []
    for s, n in (("s0", 120), ("s1", 60), ("s2", 30), ("s3", 80), (None, 40)):
        rows += [(len(rows) + i, prose(3 + (i * i) % 90, i), "en", s) for i in range(n)]
    return documents(rows + [(9000, None, "en", "s1"), (9001, " \n", "en", "s1"), (9002, "", "en", "empty")])


def test_targets_and_words_taken(table):
    rows = run(table)
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        n = len(WORD.findall(r.text or ""))
        assert r.size == n and r.copies in (0, 1, 2) and (n or not r.copies)
        sizes[r.source] += n
        taken[r.source] += n * r.copies
        target[r.source] = r.target
    assert target == pytest.approx(water_fill(sizes))
    for source, words in target.items():
        assert abs(taken[source] - words) <= max(3, 0.02 * words)


def test_reruns_and_layouts_agree(table):
    first = {r.doc_id: r.copies for r in run(table)}
    assert first == {r.doc_id: r.copies for r in run(table.repartition(7))}
    assert first != {r.doc_id: r.copies for r in run(table, Mix(salt="other"))}


def test_inclusion_grows_with_the_expected_copies(documents, prose):
    rows = [(i, prose(16 if i % 2 else 256, i), "en", "a") for i in range(400)]
    rows += [(1000 + i, prose(50, i), "en", "b") for i in range(3000)]
    mix = [r for r in run(documents(rows), Mix(weights=(1, 9), share=0.4)) if r.source == "a"]
    short, long = ([r.copies for r in mix if r.size == n] for n in (16, 256))
    # Expected copies stand as the fourth roots of the sizes, 2 to 4.
    assert 1.5 < (sum(long) / len(long)) / (sum(short) / len(short)) < 2.7


def test_odd_tables(documents):
    assert run(documents([])) == []
    (row,) = run(documents([(1, None, "en", "a")]))
    assert (row.size, row.source_size, row.target, row.copies) == (0, 0, 0.0, 0)
    twice = run(documents([(None, "a b c", "en", None), (None, "a b c", "en", None), (3, "d", "en", None)]))
    assert len({r.copies for r in twice if r.doc_id is None}) == 1


def test_the_mix_keeps_the_columns(documents):
    df = documents([(i, f"w{i} x", "en", f"s{i % 4}") for i in range(40)]).withColumn("size", F.lit("own")).withColumn("rank", F.lit(1))
    out = mixed(df)
    assert out.columns == df.columns
    times = {r.doc_id: r.n for r in out.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert times == {r["doc_id"]: r["copies"] for r in with_copies(df).select("row.doc_id", "copies").collect() if r["copies"]}
