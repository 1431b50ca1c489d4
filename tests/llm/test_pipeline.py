"""The stages one after the other, each against what a brute-force version keeps."""

import re
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from cohortwave.llm import decontaminate, toxicity
from cohortwave.session import keep
from tests.llm.test_documents import SPACE, brute_targets
from tests.llm.test_models import score
from tests.llm.test_similar import brute_kept

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    cols = docs.columns
    (_, clean), (_, dedup), (_, decon), (_, mix), (_, order) = corpus_pipeline.STAGES

    rows = docs.collect()
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    docs = keep(clean(spark, docs, SF), "a")
    assert docs.columns == cols and sorted(r.doc_id for r in docs.collect()) == sorted(r.doc_id for r in rows if score(model, r.text) < 0.5)

    rows = docs.collect()
    docs = keep(dedup(spark, docs, SF), "b")
    assert docs.columns == cols and sorted((False, r.doc_id) for r in docs.collect()) == brute_kept(rows)

    rows = docs.collect()
    items = [decontaminate.normalise(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = keep(decon(spark, docs, SF), "c")
    left = {r.doc_id for r in docs.collect()}
    exact = {r.doc_id for r in rows if any(t in decontaminate.normalise(r.text) for t in items)}
    assert docs.columns == cols and exact and not exact & left and len(left) >= len(rows) - len(exact) - 2

    rows, sizes = docs.collect(), Counter()
    for r in rows:
        sizes[r.source] += len(re.findall(SPACE, r.text))
    docs = keep(mix(spark, docs, SF), "d")
    got, copies = Counter(), Counter()
    for r in docs.collect():
        got[r.source] += len(re.findall(SPACE, r.text))
        copies[r.doc_id] += 1
    assert docs.columns == cols and max(copies.values()) <= 3 and set(copies) <= left
    longest = {s: max(len(re.findall(SPACE, r.text)) for r in rows if r.source == s) for s in sizes}
    assert all(abs(got[s] - t) <= longest[s] / 2 for s, t in brute_targets(sizes).items())

    out = order(spark, docs, SF)
    assert out.agg(F.count_distinct("slot")).first()[0] == out.count() > 0
    assert {d for r in out.select("doc_ids").collect() for d in r.doc_ids} == set(copies)


def test_all_queries_are_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
    assert set(entry.oracle_sql()) <= names
