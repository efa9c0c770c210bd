import hashlib

from perennial.llm.order_minhash import OrderMinHash, fingerprints


def expected(rows):
    """(n_chars, sha of the edited text) by ascending id."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for k, (doc, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), edited))
    return out


def run(df, **params):
    rows = fingerprints(df, OrderMinHash(**params)).collect()
    return sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.n_chars))


def test_edited_texts_follow_the_ids(documents, prose):
    rows = [(i * 3, prose(5 + i * 3, i)) for i in range(30)]
    rows += [(200, None), (201, ""), (202, "é😀漢字" * 9), (203, "one"), (204, " \n\t ")]
    for bucket_bytes in (1 << 30, 300):
        got = run(documents(rows), bucket_bytes=bucket_bytes)
        assert [(r.doc_id, r.n_chars, r.edited_sha256) for r in got] == [e[:3] for e in expected(rows)]


def test_fingerprints_depend_on_the_text_alone(documents, prose):
    texts = [prose(50, 1), prose(50, 2), "", "w " * 40, prose(900, 3)]
    got = run(documents([(i, t) for i, t in enumerate(texts * 2)]))
    assert [r.fingerprint for r in got[:5]] == [r.fingerprint for r in got[5:]]
    assert len({r.fingerprint for r in got}) == 5
    # The fingerprint of an edited text is the one it has as a text of its own.
    edited = [e[3] for e in expected([(i, t) for i, t in enumerate(texts * 2)])]
    again = run(documents(list(enumerate(edited))))
    assert [r.edited_fingerprint for r in got] == [r.fingerprint for r in again]


def test_likeness_falls_with_edits_and_with_order(documents, prose):
    words = prose(400, 5, 300).split()
    swapped = words[200:] + words[:200]
    few = words[:390] + ["other"] * 10
    rows = [(1, " ".join(words)), (2, " ".join(words)), (3, " ".join(few)), (4, " ".join(words)), (5, " ".join(swapped)), (6, " ".join(reversed(words)))]
    got = run(documents(rows), slots=64)
    near = [r.near_next for r in got]
    assert near[0] == 1.0
    assert near[1] > 0.8 > near[3] > near[4]


def test_occurrences_are_numbered(documents):
    rows = [(1, "a b c " * 20), (2, "a b c " * 25), (3, "x"), (4, "x")]
    got = run(documents(rows))
    assert 0 < got[0].near_next < 1 and got[2].near_next == 1.0


def test_odd_tables(documents, spark):
    assert fingerprints(documents([])).collect() == []
    (one,) = run(documents([(5, "alone in here")]))
    assert one.near_next == 1.0
    blank = run(documents([(1, None), (2, ""), (3, "word")]))
    assert [r.near_next for r in blank] == [1.0, 0.0, 0.0] and blank[0].fingerprint == ""
    df = documents([(None, "a b"), (None, "a b"), (7, "a c"), (7, "a b")]).withColumnRenamed("lang", "fingerprint")
    got = run(df.withColumnRenamed("source", "__bucket"))
    assert [r.doc_id for r in got] == [None, None, 7, 7]
