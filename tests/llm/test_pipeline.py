import hashlib
import re

from edges import edge_docs, no_docs  # noqa: F401  (fixtures)
import corpus_pipeline
from conftest import SF_SMALL
from panes.llm.common import write_table


def test_stages_on_edges_and_no_rows(spark, edge_docs, no_docs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "MinHash near-dedup", "packing"]
    docs, empty = edge_docs, no_docs
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs, empty = (write_table(stage(spark, d, SF_SMALL), "test-stage") for d in (docs, empty))
        assert empty.count() == 0
        if name != "packing":
            assert docs.columns == before.columns
            assert docs.count() < before.count()
    assert docs.count() > 0


def test_whole_run(spark):
    """What is left has no bad, equal or near-equal texts, and all of it is packed."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = write_table(stage(spark, kept, SF_SMALL), "test-stage")
    rows = kept.collect()
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", r["text"]) for r in rows]
    assert len(set(texts)) == len(texts)
    sets = []
    for t in texts:
        w = t.encode().lower().split()
        sets.append(frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)]))
    assert not any(len(a & b) >= 0.8 * len(a | b) for i, a in enumerate(sets) for b in sets[:i] if a & b)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    left = [labels[r["doc_id"]] for r in rows if r["doc_id"] in labels]
    assert sum(left) / len(left) > 0.98
    out = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert {r["doc_id"] for r in out} == {r["doc_id"] for r in rows}
    lengths = {}
    for r in out:
        lengths.setdefault(r["doc_id"], set()).add(r["doc_tokens"])
    assert all(len(v) == 1 for v in lengths.values())
    assert hashlib.sha256(b"".join(bytes(r["ids"]) for r in sorted(out, key=lambda r: (r["doc_id"], r["start"])))).hexdigest()
