import zlib

from edges import edge_docs, no_docs, sf  # noqa: F401  (fixtures)
from panes.llm import sharding
from panes.llm.queries import LLM_QUERIES

DIMS = ["n_chars", "source", "lang", "doc_id"]


def sizes(rows):
    out = {}
    for r in rows:
        out.setdefault(r["shard"], []).append(r)
    return out


def test_whole_table_in_near_equal_shards(spark, sf):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    rows = LLM_QUERIES["op1_kd_shards"](spark, sf).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    by = sizes(rows)
    assert set(by) == set(range(16))
    for own in by.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    for r in rows:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
    total = [sum(r["size"] for r in own) for own in by.values()]
    largest = max(r["size"] for r in rows)
    assert max(total) - min(total) <= 2 * largest


def test_edges_and_hot_values(spark, edge_docs, no_docs):
    rows = sharding.kd_shards(edge_docs, DIMS, shards=4).collect()
    assert len(rows) == edge_docs.count()
    assert {r["size"] for r in rows if r["doc_id"] == 6} == {1}
    for own in sizes(rows).values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    assert sharding.kd_shards(no_docs, DIMS, shards=4).collect() == []
    # Rows that repeat, and one value in every dimension, still have a median.
    same = spark.range(4000).selectExpr("cast(null as long) as doc_id", "'same text' as text", "'en' as lang", "'s' as source", "9L as n_chars")
    counts = {k: len(v) for k, v in sizes(sharding.kd_shards(same, DIMS, shards=8).collect()).items()}
    assert set(counts) == set(range(8)) and max(counts.values()) - min(counts.values()) <= 2


def test_target_bytes_and_odd_numbers_of_shards(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "repeat('x', cast(id % 97 as int)) as text", "'en' as lang",
                                        "concat('s', id % 7) as source", "id % 97 as n_chars")
    rows = sharding.kd_shards(docs, DIMS, target_bytes=21_000).collect()
    total = [sum(r["size"] for r in own) for own in sizes(rows).values()]
    assert len(total) == 7 and sum(total) == sum(i % 97 + 1 for i in range(3000))
    assert max(total) - min(total) < 400
