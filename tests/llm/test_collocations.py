"""Collocations against plain counting, paths against the texts, and edge cases."""

import random
import re
from collections import Counter

import pytest

from perennial.llm.collocations import Collocations, candidates, collocations, de_bruijn_graph, unary_paths

SCHEMA = "doc_id long, text string, lang string"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def counted(rows):
    counts, totals = {}, Counter()
    for _id, text, lang in rows:
        of = counts.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for n in range(1, 5):
                of.update(" ".join(words[i : i + n]) for i in range(len(words) - n + 1))
    return counts, totals


def plain(rows, least, top=2000):
    counts, totals = counted(rows)
    out = []
    for lang, of in counts.items():
        frequent = {p: a for p, a in of.items() if a >= least}
        most = Counter()
        for longer, a in frequent.items():
            w = longer.split(" ")
            for s in range(1, len(w)):
                for i in range(len(w) - s + 1):
                    part = " ".join(w[i : i + s])
                    most[part] = max(most[part], a)
        found = []
        for phrase, a in frequent.items():
            w = phrase.split(" ")
            if len(w) < 2 or 100 * most[phrase] >= 80 * a:
                continue
            cuts = []
            for k in range(1, len(w)):
                left, right = of[" ".join(w[:k])], of[" ".join(w[k:])]
                cuts.append((2_000_000 * a // (left + right), k, left, right))
            score, _k, left, right = min(cuts)
            found.append((-score, -a, phrase.encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def prose(seed, texts):
    """Texts of few words with fixed expressions and copied passages in them."""
    draw = random.Random(seed)
    words = ["ab", "Cd", "é", "new", "york", "city", "x", "of", "the", "state"]
    passage = " ".join(f"p{k}" for k in range(40))
    rows = []
    for k in range(texts):
        parts = [draw.choices(words, weights=range(1, 11))[0] for _ in range(draw.randint(0, 60))]
        if draw.random() < 0.5:
            parts.insert(len(parts) // 2, "New York City hall")
        if draw.random() < 0.4:
            parts.insert(0, passage)
        text = "".join(p + draw.choice([" ", " ", " ", "  ", "\t", ". ", ", ", "\n"]) for p in parts)
        rows.append((k, text, draw.choice(["en", "en", None, "fr"])))
    return rows


@pytest.mark.parametrize("params", [Collocations(min_count=5), Collocations(min_count=5, cell_bits=10, slice_bits=8, top=7)])
def test_equals_plain_counting(spark, params):
    rows = prose(7, 120)
    found = collocations(spark.createDataFrame(rows, SCHEMA).repartition(3), params).collect()
    assert sorted(map(tuple, found)) == plain(rows, params.min_count, params.top)


def test_flows_are_counts_and_paths_are_passages(spark):
    rows = prose(11, 100)
    params = Collocations(min_count=6)
    graph = de_bruijn_graph(spark.createDataFrame(rows, SCHEMA), params)
    counts, totals = counted(rows)
    flows = {(r.lang, r.phrase): r.n for r in graph.flows.collect()}
    assert flows == {(lang, p): a for lang, of in counts.items() for p, a in of.items() if a >= 6}
    assert {r.lang: r.n for r in graph.words.collect()} == dict(totals)
    paths = unary_paths(graph)
    held = {}
    for r in paths.collect():
        for k in range(len(r.words) - 3):
            edge = (r.lang, " ".join(r.words[k : k + 4]))
            assert edge not in held
            held[edge] = r.n
    assert held == {key: n for key, n in flows.items() if key[1].count(" ") == 3}
    assert max(len(r.words) for r in paths.collect()) >= 38
    assert candidates(graph, paths, params).where("size = 3 and phrase like 'p1_ p1_ p1_'").count() == 0


def test_edges_of_pieces(spark):
    rows = [(k, "a b", "en") for k in range(30)] + [(k, "a,b;a b\x0bc A\tB", "en") for k in range(5)]
    found = collocations(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, found)) == plain(rows, 30)
    assert found[0].phrase == "a b" and found[0].a == 40


def test_edge_cases(spark):
    assert collocations(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(None, None, None), (1, "", "en"), (2, " \n.,", "en"), (3, "the " * 20_000, None), (3, "the " * 20_000, "und")]
    frame = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA + ", n long, phrase string, a int")
    found = collocations(frame).collect()
    assert sorted(map(tuple, found)) == plain(rows, 30)
    assert found[0].lang == "und" and found[0].phrase == "the the the the"


def test_large_counts_do_not_overflow(spark):
    from perennial.llm.collocations import Graph, scored

    big = 8 * 10**15
    flows = spark.createDataFrame([("en", 1, "a", big), ("en", 1, "b", big)], "lang string, size int, phrase string, n long")
    found = spark.createDataFrame([("en", "a b", 2, big - 1)], "lang string, phrase string, size int, a long")
    assert scored(Graph(flows, flows, flows), found).first()["score"] == 2_000_000 * (big - 1) // (2 * big)
