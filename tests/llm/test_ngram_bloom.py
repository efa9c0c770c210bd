import math
import re
import zlib
from collections import Counter

import pytest

from perennial.llm.ngram_bloom import BloomModel, score_texts, with_held_out

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*WORD.findall((text or "").translate(LOWER)), None]


def brute(rows, strength, base=2.0):
    """Exact counts, quantised as the filter does; the filter's own errors aside."""
    held = {d: zlib.crc32(str(d if d is not None else "").encode()) % 5 == 1 for d, _t in rows}
    words, pairs = Counter(), Counter()
    for d, text in rows:
        if not held[d]:
            t = tokens(text)
            words.update(t)
            pairs.update(zip([None, *t[:-1]], t, strict=True))
    n, v = sum(words.values()), len(words)

    def quantised(c):
        if not c:
            return 0.0
        low, high = base ** (q := math.floor(math.log(c, base) + 1e-9)), base ** (q + 1)
        return (math.ceil(low) + max(math.ceil(low), math.ceil(high) - 1)) / 2

    out = {}
    for d, text in rows:
        t = tokens(text)
        p = {w: (words[w] + 0.5) / (n + 0.5 * (v + 1)) for w in t}
        score = sum(
            math.log10((min(quantised(pairs[a, b]), words[a]) + strength * p[b]) / (words[a] + strength))
            for a, b in zip([None, *t[:-1]], t, strict=True)
        )
        out[d] = (held[d], len(t), sum(words[w] > 0 for w in t), n, sum(math.log10(p[w]) for w in t), score)
    return out


def run(df, params):
    return {
        r.doc_id: (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)
        for r in score_texts(with_held_out(df), params).collect()
    }


ROOMY = {"bits_per_token": 64.0, "probes": 6}


def rows(prose, n=40):
    return [(i, prose(5 + 7 * (i % 9), i % 7, 60).capitalize()) for i in range(n)]


@pytest.mark.parametrize("extra", [{}, {"segment_tokens": 64, "pass_bytes": 2048, "block_words": 50, "shard_words": 100}])
def test_scores_equal_brute_force(documents, prose, extra):
    params = BloomModel(**ROOMY, **extra)
    given = [*rows(prose), (100, None), (101, ""), (102, " \t\n "), (103, "Ünïcode   x y " * 3), (104, "a" * 70_000 + " b")]
    got, want = run(documents(given), params), brute(given, params.strength)
    assert got.keys() == want.keys()
    for d in want:
        assert got[d][:4] == want[d][:4]
        assert got[d][4:] == pytest.approx(want[d][4:], rel=1e-9)


def test_a_tight_filter_only_overestimates_a_little(documents, prose):
    given = rows(prose, 60)
    got, want = run(documents(given), BloomModel()), brute(given, BloomModel().strength)
    total = sum(w[5] for w in want.values())
    assert abs(sum(got[d][5] for d in want) - total) < 0.05 * abs(total)


def test_likelier_texts_score_higher_than_shuffled(documents, prose):
    text = prose(30, 1, 20)
    given = [(i, text) for i in range(20)] + [(50, " ".join(reversed(text.split())))]
    got = run(documents(given), BloomModel(**ROOMY))
    assert got[0][5] > got[50][5] and got[0][4] == pytest.approx(got[50][4])


def test_null_ids_repeated_rows_empty_and_untrained_tables(documents):
    df = documents([(None, "a b"), (None, "a b"), (3, "a b")])
    assert score_texts(with_held_out(df)).count() == 3
    assert score_texts(with_held_out(documents([]))).collect() == []
    held = next(i for i in range(50) if zlib.crc32(str(i).encode()) % 5 == 1)
    row = score_texts(with_held_out(documents([(held, "x y")]))).first()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (True, 3, 0, 0)
    assert row.base_score == 0 and row.score == 0
