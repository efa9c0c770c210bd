"""Stratified interleaving against a plain computation, and its edge cases."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest

from perennial.llm.stratified_shards import Shards, fractional_ranks, interleaved_shards, shard_digests, write_shards

SCHEMA = "doc_id long, text string, source string"


def draw(text):
    return int(hashlib.md5(f"interleave:{text}".encode()).hexdigest()[:15], 16)


def plain(rows, shards):
    """{(doc_id, source): (shard, slot)} by sorting the whole table."""
    by_source = defaultdict(list)
    for doc_id, _text, source in rows:
        by_source[source].append((draw("" if doc_id is None else doc_id), -1 if doc_id is None else doc_id))
    order = []
    for source, drawn in by_source.items():
        begin = (draw("-" if source is None else f"={source}") >> 30) / 2**30
        for rank, (_draw, doc_id) in enumerate(sorted(drawn)):
            order.append(((rank + begin) / len(drawn), source or "", rank, doc_id, source))
    order.sort(key=lambda o: o[:3])
    out, total = {}, len(order)
    for place, (_f, _s, _r, doc_id, source) in enumerate(order):
        shard = place * shards // total
        out[doc_id, source] = (shard, place - -(-shard * total // shards))
    return out


@pytest.mark.parametrize("bucket_rows", [4, 64, 1 << 15])
def test_equals_one_sort_of_the_whole_table(spark, bucket_rows):
    sources = ["hot"] * 300 + ["b"] * 61 + ["c"] * 7 + [None] * 20 + [f"single {k}" for k in range(15)]
    rows = [(k, f"text {k}", source) for k, source in enumerate(sources)]
    found = interleaved_shards(spark.createDataFrame(rows, SCHEMA), Shards(bucket_rows=bucket_rows))
    got = {(r.row.doc_id, r.row.source): (r.shard, r.slot) for r in found.collect()}
    assert got == plain(rows, 24)


def test_every_shard_matches_the_mixture(spark):
    sources = ["hot"] * 800 + ["b"] * 300 + ["c"] * 100
    frame = spark.createDataFrame([(k, "x", s) for k, s in enumerate(sources)], SCHEMA)
    shards = interleaved_shards(frame, Shards(shards=10, bucket_rows=32)).collect()
    sizes = Counter(r.shard for r in shards)
    assert len(sizes) == 10 and max(sizes.values()) - min(sizes.values()) <= 1
    mixture = Counter((r.shard, r.row.source) for r in shards)
    for shard in range(10):
        for source, n in (("hot", 80), ("b", 30), ("c", 10)):
            assert abs(mixture[shard, source] - n) <= 2
    for shard in range(10):
        assert sorted(r.slot for r in shards if r.shard == shard) == list(range(sizes[shard]))


def test_ranks_lie_evenly(spark):
    frame = spark.createDataFrame([(k, "x", "s") for k in range(50)], SCHEMA)
    fractions = sorted(r.fraction for r in fractional_ranks(frame).collect())
    assert all(abs(b - a - 1 / 50) < 1e-12 for a, b in zip(fractions, fractions[1:])) and 0 <= fractions[0] and fractions[-1] < 1


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert shard_digests(empty).count() == 0
    rows = [(None, None, None), (1, None, "a"), (2, "", "a"), (3, "é" * 30_000, None), (4, "same", "a"), (4, "same", "a")]
    found = shard_digests(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == 6 and all(r.law == "rows" and r.grown_shard is None for r in found)
    of = {r.doc_id: r for r in found}
    assert (of[1].size, of[1].text_crc32) == (of[2].size, of[2].text_crc32) == (8, 0)
    assert (of[3].size, of[3].text_crc32) == (60_008, zlib.crc32(("é" * 30_000).encode()))
    assert len({(r.shard, r.slot) for r in found}) == 6


def test_further_columns_and_order_of_rows(spark):
    rows = [(k, "t", f"s{k % 3}", k, k, k) for k in range(40)]
    frame = spark.createDataFrame(rows, SCHEMA + ", rank int, shard int, n long")
    one = interleaved_shards(frame.repartition(5)).collect()
    two = interleaved_shards(frame.orderBy("doc_id", ascending=False)).collect()
    assert sorted((r.row.doc_id, r.row.n, r.shard, r.slot) for r in one) == sorted((r.row.doc_id, r.row.n, r.shard, r.slot) for r in two)


def test_written_shards(spark, root):
    frame = spark.createDataFrame([(k, f"t{k}", f"s{k % 3}") for k in range(60)], SCHEMA)
    write_shards(interleaved_shards(frame, Shards(shards=4)), f"{root}/shards", 4)
    back = spark.read.parquet(f"{root}/shards")
    assert back.count() == 60 and sorted(r.shard_of for r in back.select("shard_of").distinct().collect()) == [0, 1, 2, 3]
    assert sorted(r.slot for r in back.where("shard_of = 2").collect()) == list(range(15))
    ordered = back.selectExpr("*", "_metadata.file_path as file", "_metadata.row_index as at")
    by_file = {}
    for r in ordered.orderBy("file", "at").collect():
        by_file.setdefault(r.file, []).append(r.slot)
    assert all(slots == sorted(slots) for slots in by_file.values())
