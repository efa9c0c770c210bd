import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from perennial.llm import kneser_ney as kn
from perennial.llm.wordcodes import word_codes

import pyarrow as pa


def brute(train, order):
    """Interpolated modified Kneser-Ney by the textbook: a function (text) -> natural log."""
    counts = {order: Counter()}
    for text in train:
        t = ["<s>"] * (order - 1) + text.split() + ["</s>"]
        counts[order].update(tuple(t[i : i + order]) for i in range(len(t) - order + 1))
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])

    def discounts(c):
        n = Counter(c.values())
        if not (n[1] and n[2]):
            return [0.5] * 3
        y = n[1] / (n[1] + 2 * n[2])
        d = [1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3] if n[3] else 0.5]
        return [min(max(x, 0.05), k + 0.95) for k, x in enumerate(d)]

    d = {k: discounts(c) for k, c in counts.items()}
    total, left = defaultdict(Counter), defaultdict(lambda: defaultdict(float))
    for k, c in counts.items():
        for g, n in c.items():
            total[k][g[:-1]] += n
            left[k][g[:-1]] += d[k][min(n, 3) - 1]
    words = len(counts[1]) + 1

    def p(gram):
        k, h = len(gram), gram[:-1]
        lower = 1 / words if k == 1 else p(gram[1:])
        if not total[k][h]:
            return lower
        n = counts[k][gram]
        own = n - d[k][min(n, 3) - 1] if n else 0
        return (own + left[k][h] * lower) / total[k][h]

    def log(text):
        t = ["<s>"] * (order - 1) + text.split() + ["</s>"]
        return sum(math.log(p(tuple(t[i - order + 1 : i + 1]))) for i in range(order - 1, len(t)))

    return log


def sentences(n, seed, words=40, length=25):
    draw = random.Random(seed)
    vocabulary = [f"w{int(draw.paretovariate(0.8)) % words}" for _ in range(400)]
    return [" ".join(draw.choice(vocabulary) for _ in range(draw.randint(1, length))) for _ in range(n)]


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_the_model_is_kneser_ney(spark, order):
    train = sentences(60, 1)
    params = kn.QualityModel(order=order)
    model, unknown = kn.train(spark.createDataFrame([(t,) for t in train], "text string"), params)
    table, log = kn._table(model, params), brute(train, order)
    tests = [*sentences(20, 2, 60), "", "never seen before", "w1", train[0]]
    words = word_codes(pa.array(tests), lower=False)
    for k, text in enumerate(tests):
        assert kn.log_probability(words.of(k), table, unknown, order) == pytest.approx(log(text), rel=1e-4)


@pytest.fixture
def corpus(documents):
    rows = []
    for lang in ("en", "fr"):
        rows += [(len(rows) + i, t, lang, "s") for i, t in enumerate(sentences(300, lang, 60, 60))]
    for i in range(40):
        junk = " ".join(f"{w}###" for w in sentences(1, i, 60, 60)[0].split() * 5)
        rows.append((5000 + i, junk, "en" if i % 2 else "fr", "s"))
    return documents(rows)


PARAMS = kn.QualityModel(sample_per_language=200)


def test_junk_is_rejected_and_clean_text_kept(spark, corpus):
    trusted = corpus.where("doc_id < 450").select("doc_id")
    rows = kn.judged(corpus, trusted, PARAMS).select("row.doc_id", "keep", "perplexity", "threshold").collect()
    assert len(rows) == 640
    assert not any(r.keep for r in rows if r.doc_id >= 5000)
    assert sum(r.keep for r in rows if r.doc_id < 5000) >= 0.98 * 600


def test_odd_rows(spark, corpus, documents):
    odd = documents([(None, None, None, None), (7001, "", "xx", "s"), (7002, "a" * 100_000, "en", "s"), (7001, "", "xx", "s")])
    odd = odd.withColumnRenamed("source", "mean").withColumnRenamed("n_chars", "limit")
    given = corpus.withColumnRenamed("source", "mean").withColumnRenamed("n_chars", "limit").unionByName(odd)
    out = kn.keep_good(given, corpus.where("doc_id < 450").select("doc_id"), PARAMS)
    assert out.columns == given.columns
    kept = [r.doc_id for r in out.where("doc_id is null or doc_id >= 7000").collect()]
    # One unknown word says too little against a document.
    assert sorted(kept, key=str) == [7001, 7001, 7002, None]


def test_nothing_trusted_or_nothing_given(spark, corpus, documents):
    nobody = spark.createDataFrame([], "doc_id long")
    assert kn.keep_good(corpus, nobody, PARAMS).count() == corpus.count()
    assert kn.keep_good(documents([]), corpus.select("doc_id"), PARAMS).collect() == []


def test_trusted_ids(spark):
    labels = spark.createDataFrame(
        [(1, 1, 0), (2, 0, 0), (3, 1, 1), (4, 1, None), (5, 1, 0), (5, 0, 0), (None, 1, 0), (6, None, 0)],
        "doc_id long, quality int, toxic int",
    )
    assert sorted(r.doc_id for r in kn.trusted_ids(labels).collect()) == [1, 4]


def test_model_sample_is_bounded(spark, corpus):
    trusted = corpus.select("doc_id")
    bounded = kn.judged(corpus, trusted, kn.QualityModel(sample_per_language=60))
    assert bounded.where(F.col("perplexity") > 0).count() == corpus.count()


def test_small_languages_are_judged_by_their_own_text(spark, corpus, documents):
    """A language of nine trusted documents, and one of none, beside two of 225."""
    rare = [" ".join(f"{w}{i % 7}x" for i, w in enumerate(t.split())) for t in sentences(60, "rare", 300, 60)]
    none = [" ".join(f"{w}q" for w in t.split()) for t in sentences(20, "none", 300, 60)]
    rows = [(9000 + i, t, "mt", "s") for i, t in enumerate(rare)]
    rows += [(9500 + i, t, "zz", "s") for i, t in enumerate(none)]
    given = corpus.unionByName(documents(rows))
    trusted = given.where("doc_id < 450 or doc_id between 9000 and 9008").select("doc_id")
    rows = kn.judged(given, trusted, PARAMS).select("row.doc_id", "row.lang", "keep", "threshold").collect()
    assert all(r.keep and r.threshold == float("inf") for r in rows if r.lang == "zz")
    assert sum(r.keep for r in rows if r.lang == "mt") >= 57
    assert len({r.threshold for r in rows}) == 4
    assert not any(r.keep for r in rows if 5000 <= r.doc_id < 6000)


def test_passes_add_up_and_bound_what_is_held(spark, corpus, monkeypatch):
    trusted = corpus.where("doc_id < 450").select("doc_id")
    sizes, held = [], kn._held

    def noted(coded):
        table = held(coded)
        sizes.append(len(table.codes) * kn.GRAM_BYTES)
        return table

    monkeypatch.setattr(kn, "_held", noted)
    columns = ["row.doc_id", "quality_words", F.round("quality_log", 6), "keep"]
    whole = kn.judged(corpus, trusted, PARAMS).select(*columns).collect()
    widest = max(sizes)
    sizes.clear()
    bound = widest // 2
    parts = kn.QualityModel(sample_per_language=200, pass_bytes=bound)
    assert sorted(kn.judged(corpus, trusted, parts).select(*columns).collect()) == sorted(whole)
    assert len(sizes) > 3 and max(sizes) <= 1.1 * bound


def test_every_trusted_document_is_fitted_and_calibrates(spark, documents, monkeypatch):
    """More than the fit once read of a language: each fold is left out once, and the model that
    judges the table leaves out none."""
    fitted, train = [], kn.train

    def noted(texts, *more):
        fitted.append(texts.count())
        return train(texts, *more)

    monkeypatch.setattr(kn, "train", noted)
    given = documents([(i, t, "en", "s") for i, t in enumerate(sentences(1200, 5, 60, 6))])
    assert kn.judged(given, given.select("doc_id"), kn.QualityModel()).count() == 1200
    assert fitted == [800, 800, 800, 1200]


@pytest.mark.parametrize("order", [1, 2, 3, 4])
@pytest.mark.parametrize("pass_bytes", [1 << 20, 160])
def test_scores_of_buckets_are_kneser_ney(spark, order, pass_bytes):
    """Words in several buckets, several passes, words' counts sent and joined, copies, odd texts."""
    train = sentences(80, 3)
    texts = [*sentences(30, 4, 60), "", None, "never seen before", train[0], train[0]]
    params = kn.QualityModel(order=order, passes=3, bucket_words=40, pass_bytes=pass_bytes)
    fitted = spark.createDataFrame([(t,) for t in train], "text string")
    plan = kn._plan(fitted, params)[0]
    assert order == 1 or max(plan.parts) > 2
    scorer = kn.Scorer(fitted, params)
    assert scorer.all_sent == (pass_bytes > 160)
    asked = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string")
    rows = {r.key1: r for r in scorer(kn.with_keys(asked, F.coalesce("text", F.lit("-")))).collect()}
    keys = [r.key1 for r in kn.with_keys(asked, F.coalesce("text", F.lit("-"))).orderBy("k").collect()]
    log = brute(train, order)
    assert len(rows) == len(texts) - 1
    for text, key in zip(texts, keys):
        assert rows[key].quality_words == len((text or "").split())
        assert rows[key].quality_log == pytest.approx(log(text or ""), rel=1e-6)


def test_scores_come_from_buckets_without_tables_of_n_grams(spark, documents, monkeypatch):
    """Nothing that is written has a row per n-gram."""
    settled, settle = [], kn.settle

    def noted(frame, name):
        out = settle(frame, name)
        settled.append((name, out.count()))
        return out

    monkeypatch.setattr(kn, "settle", noted)
    texts = sentences(300, 6, 4000, 200)
    given = documents([(i, t, "en", "s") for i, t in enumerate(texts)])
    assert kn.judged(given, given.select("doc_id"), kn.QualityModel()).count() == 300
    n_grams = len({g for t in texts for w in [t.split()] for g in zip(w, w[1:], w[2:])})
    assert max(n for _name, n in settled) < n_grams / 4


def test_all_models_share_a_pass_of_short_rows(spark, corpus, monkeypatch):
    """Each n-gram to be scored is dealt once, whatever the number of folds, in less than its codes."""
    kinds, deal = [], kn._deal

    def noted(order, plan, turn, kind, *more):
        kinds.append(kind)
        return deal(order, plan, turn, kind, *more)

    monkeypatch.setattr(kn, "_deal", noted)
    assert kn.judged(corpus, corpus.where("doc_id < 450").select("doc_id"), PARAMS).count() == 640
    assert kinds.count(kn._ASKED) == 1
    texts = sentences(400, 7, 60, 60)
    given = spark.createDataFrame([(t,) for t in texts], "text string")
    plan = kn._plan(given, PARAMS)[0]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    dealt = [c for b in deal(3, plan, 0, kn._FIT)([batch]) for c in b.columns if pa.types.is_binary(c.type)]
    size = sum(len(value) for column in dealt for value in column.to_pylist())
    assert size < 12 * sum(len(t.split()) + 1 for t in texts)


@pytest.mark.parametrize("order", [1, 2, 3])
@pytest.mark.parametrize("pass_bytes", [1 << 20, 160])
def test_fitted_texts_are_scored_without_their_fold(spark, order, pass_bytes):
    """By counts made once for all models; words in several buckets, several passes, copies of slices."""
    train = sentences(90, 8)
    rows = [(k, t, k % 3) for k, t in enumerate(train)]
    fitted = kn.with_keys(spark.createDataFrame(rows, "k int, text string, fold int"), "k").repartition(2).cache()
    params = kn.QualityModel(order=order, passes=2, bucket_words=60, pass_bytes=pass_bytes)
    scorer = kn.Scorer(fitted, params, None, [0, 1, 2])
    asked = fitted.select("key1", "key2", "text")
    whole = {r.key1: r for r in scorer(asked.unionByName(asked)).collect()}
    found = {r.key1: r for r in scorer.left_out.collect()}
    assert len(whole) == len(found) == len(train)
    logs = [brute([t for _k, t, f in rows if f != fold], order) for fold in range(3)] + [brute(train, order)]
    for r in fitted.collect():
        assert found[r.key1].quality_words == len(r.text.split())
        assert found[r.key1].quality_log == pytest.approx(logs[r.fold](r.text), rel=1e-6)
        assert whole[r.key1].quality_log == pytest.approx(logs[3](r.text), rel=1e-6)
