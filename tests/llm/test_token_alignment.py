"""Alignment against the tokenizers' own output, merged one token at a time."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from perennial.llm.token_alignment import (
    Alignment, Tokenizers, aligned_tokens, alignment_digests, common_ends, crossings, tokenize,
)

SCHEMA = "doc_id long, text string"
TEXTS = [
    None, "", " ", "a", "  a", "two  words\nand\tmore ", "\n\n", "\n x", "  y", "a  b \n c", "<|endoftext|> is text",
    "é à ü ß", "日本語のテキスト", "👍🏽 ok", "x▁y", "don't we'll 3.14 x=1;", "tab\x0bv\x0cf\r\ncr", "the " * 200, "0123456789" * 30,
    "\x1c\x1f", "a\x00b", "<0x0A>", "</s><s>", "ﬁ①", "word" * 500, "ÀÁ　Â    z",
]


@pytest.fixture(scope="module")
def own():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    return a, b


@pytest.fixture(scope="module")
def both():
    params = Alignment()
    return Tokenizers(open(params.byte_level, "rb").read(), open(params.pieces, "rb").read())


def plain(text, own, both):
    """(ids of A, ids of B, groups) of one text, straight from the tokenizers."""
    if not text:
        return [], [], []
    a = own[0].encode(" " + text, add_special_tokens=False).ids
    b = own[1].encode(text)
    a_bytes, b_bytes = [both.a_bytes[k] for k in a], [both.b_bytes[k] for k in b]
    if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
        return [], [], []
    groups, i, j, at_a, at_b, now_a, now_b = [], 0, 0, 0, 0, [], []
    while i < len(a) or j < len(b):
        if at_a <= at_b and i < len(a):
            at_a += len(a_bytes[i])
            now_a.append(a[i])
            i += 1
        else:
            at_b += len(b_bytes[j])
            now_b.append(b[j])
            j += 1
        if at_a == at_b:
            groups.append((now_a, now_b))
            now_a, now_b = [], []
    return a, b, groups


def digests(rows, own, both):
    plains = [plain(text, own, both) for _id, text in rows]
    links = [Counter((x, y) for xs, ys in groups for x in xs for y in ys) for _a, _b, groups in plains]
    counts = Counter(p for of in links for p in of)
    most = {}
    for (x, _y), n in counts.items():
        most[x] = max(most.get(x, 0), n)
    out = []
    for (doc_id, _text), (a, b, groups), of in zip(rows, plains, links):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((
            doc_id, len(a), len(b), len(groups), sum(of.values()),
            sum(n for p, n in of.items() if counts[p] == most[p[0]]), sum(n * counts[p] for p, n in of.items()),
            hashlib.sha256(text.encode()).hexdigest() if text else "",
        ))
    return sorted(out, key=repr)


def random_texts(n, seed):
    draw = random.Random(seed)
    pool = [t for t in TEXTS if t and len(t) < 100] + ["the", "cat", " sat", "\n", " ", "über", "...", "  "]
    return ["".join(draw.choices(pool, k=draw.randint(1, 12))) for _ in range(n)]


def test_tokens_are_those_of_whole_texts(own, both):
    texts = TEXTS + random_texts(300, 3)
    tokens = tokenize(pa.array(texts, pa.string()), both, 1 << 10)
    for k, text in enumerate(texts):
        a, b, _groups = plain(text, own, both)
        assert tokens.a[tokens.a_first[k] : tokens.a_first[k + 1]].tolist() == a, repr(text)
        assert tokens.b[tokens.b_first[k] : tokens.b_first[k + 1]].tolist() == b, repr(text)
    assert plain("x▁y", own, both) == ([], [], []) and plain("é", own, both)[0]


@pytest.mark.parametrize("work", [1, 2, 3, 7, 1000])
def test_pieces_of_the_merge(work):
    draw = random.Random(work)
    for _ in range(60):
        a = np.array(sorted(draw.sample(range(1, 80), draw.randint(1, 40))))
        b = np.array(sorted(draw.sample(range(1, 80), draw.randint(1, 40))))
        merged = sorted([(v, 0) for v in a] + [(v, 1) for v in b])
        d = np.arange(len(merged) + 1)
        assert crossings(a, b, d).tolist() == [sum(side == 0 for _v, side in merged[:k]) for k in d]
        x, y = common_ends(a, b, work)
        assert a[x].tolist() == b[y].tolist() == sorted(set(a) & set(b))


@pytest.mark.parametrize(
    "params", [Alignment(), Alignment(piece_work=5, hot_pairs=40, block_pairs=3, cached_words=10), Alignment(hot_pairs=1)]
)
def test_digests_against_plain(spark, own, both, params):
    rows = list(enumerate(TEXTS + random_texts(60, 5)))
    found = alignment_digests(spark.createDataFrame(rows, SCHEMA).repartition(3), params)
    assert sorted(map(tuple, found.collect()), key=repr) == digests(rows, own, both)


def test_edges(spark, own, both):
    assert alignment_digests(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(None, "same text"), (1, "same text"), (1, "same text"), (2, None), (3, "long words " * 20_000)]
    frame = spark.createDataFrame([(*r, 1, "x", [1]) for r in rows], SCHEMA + ", row long, groups string, pairs array<int>")
    found = alignment_digests(frame)
    assert sorted(map(tuple, found.collect()), key=repr) == digests(rows, own, both)


def test_groups_as_text(spark, own, both):
    rows = [(1, "Hello wörld, 日本"), (2, "")]
    found = {r.doc_id: r.groups for r in aligned_tokens(spark.createDataFrame(rows, SCHEMA)).collect()}
    groups = plain(rows[0][1], own, both)[2]
    assert found == {1: ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups), 2: ""}
