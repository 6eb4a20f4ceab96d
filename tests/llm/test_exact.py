import hashlib
import re

from conftest import SF_SMALL

from edges import edge_docs, no_docs  # noqa: F401  (fixtures)
from panes.llm import exact
from panes.llm.queries import LLM_QUERIES
from panes.session import scratch_path


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    out = []
    for i, t in rows:
        ids = groups[norm(t)]
        keep = min((x for x in ids if x is not None), default=None)
        out.append((i, hashlib.sha256(norm(t).encode()).hexdigest(), keep, len(ids), keep is None or i == keep))
    return sorted(out, key=repr)


def test_against_brute_force(spark, edge_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.select("doc_id", "text").collect()]
    got = exact.duplicates(edge_docs).collect()
    assert sorted([(r["doc_id"], bytes(r["digest"]).hex(), r["keep_id"], r["group_size"], r["kept"]) for r in got], key=repr) == brute(rows)
    assert exact.duplicates(no_docs).collect() == []
    assert exact.drop_duplicates(no_docs).collect() == []


def test_dropping_leaves_one_row_of_each_text_and_all_columns(spark, edge_docs):
    out = exact.drop_duplicates(edge_docs)
    assert out.columns == edge_docs.columns
    rows = out.collect()
    texts = [norm(r["text"]) for r in rows]
    assert len(texts) == len(set(texts))
    assert set(texts) == {norm(r["text"]) for r in edge_docs.select("text").collect()}
    assert {r["doc_id"] for r in rows if norm(r["text"]) == norm(rows[0]["text"])} == {rows[0]["doc_id"]}
    assert 1 in {r["doc_id"] for r in rows} and 2 not in {r["doc_id"] for r in rows}


def test_index_persists_and_takes_batches(spark):
    path = scratch_path(spark, "index-test")
    rows = [(i, f"text {i % 30}") for i in range(100)]
    batch = lambda a, b: spark.createDataFrame(rows[a:b], "doc_id long, text string")
    first = exact.duplicates(batch(40, 100), exact.DigestIndex(spark, path, buckets=4)).collect()
    assert {r["keep_id"] for r in first} == set(range(40, 70))
    # Opened again by its path, as a later session would: smaller ids come too late.
    spark.catalog.clearCache()
    again = exact.DigestIndex(spark, path, buckets=99)
    assert again.buckets == 4
    second = exact.duplicates(batch(0, 40), again).collect()
    assert not any(r["kept"] for r in second) and {r["keep_id"] for r in second} == set(range(40, 70))
    assert exact.drop_duplicates(batch(0, 40), again).count() == 0
    assert again.table().count() == 30


def test_the_index_side_is_not_shuffled(spark):
    index = exact.DigestIndex(spark, scratch_path(spark, "index-plan"), buckets=8)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    exact.duplicates(docs, index)
    groups = docs.groupBy(exact.text_digest(docs["text"]).alias("digest")).count()
    plan = groups.join(index.table().hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Python" not in plan and "Arrow" not in plan
    assert plan.count("Exchange hashpartitioning") == 1  # the groups' own


def test_the_index_decides_in_the_registered_query(spark, monkeypatch):
    """Later batches bring texts that the index has: the anti-join drops them, and keep_id is the index's."""
    brought, real = [], exact.DigestIndex.add

    def add(self, groups):
        before = self.table().count()
        real(self, groups)
        brought.append((groups.count(), self.table().count() - before))

    monkeypatch.setattr(exact.DigestIndex, "add", add)
    rows = LLM_QUERIES["op3_digest_index"](spark, SF_SMALL).collect()
    assert len(brought) == exact.BATCHES and all(n > 0 for n, _ in brought)
    assert sum(n - new for n, new in brought[1:]) > 0 and brought[0][0] == brought[0][1]
    assert sum(new for _, new in brought) == len({r["text_sha256"] for r in rows})
    brought.clear()
    exact.drop_duplicates(spark.read.parquet(f"{SF_SMALL}/documents.parquet")).count()
    assert len(brought) == exact.BATCHES and sum(n - new for n, new in brought) > 0


def test_ids_of_any_type_and_number_of_batches(spark, edge_docs):
    want = sorted((str(r["doc_id"]), r["group_size"], r["kept"]) for r in exact.duplicates(edge_docs, batches=1).collect())
    for batches in (2, 9):
        assert sorted((str(r["doc_id"]), r["group_size"], r["kept"]) for r in exact.duplicates(edge_docs, batches=batches).collect()) == want
    text_ids = edge_docs.withColumn("doc_id", edge_docs["doc_id"].cast("string"))
    assert exact.duplicates(text_ids).count() == edge_docs.count()


def test_a_hot_text_is_joined_by_plain_shuffles(spark):
    """Both sides of the join by digest are shuffles of scans: Spark can split a text that many rows have."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = exact.duplicates(docs)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("SortMergeJoin") == 1 and plan.count("Exchange hashpartitioning") == 2 and "Aggregate" not in plan
