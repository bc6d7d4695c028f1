"""The pipeline: columns, decisions of each stage, awkward input."""

import corpus_pipeline as p
from shelfcast.llm import secrets
from shelfcast.session import cut_lineage

SF = "/root/testdata/sf0.001"


def test_stages_and_their_decisions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in p.STAGES] == ["quality classifier", "n-gram Jaccard join", "suffix-array dedup", "secret scans", "packing"]
    counts = [docs.count()]
    for name, stage in p.STAGES[:-1]:
        out = stage(spark, docs, SF)
        out.write.mode("overwrite").parquet(path := f"{spark.sparkContext.getCheckpointDir()}/pipeline-test/{name}")
        docs = spark.read.parquet(path)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        counts.append(docs.count())
    assert counts[1] < counts[0] and counts[2] < counts[1] and counts[2] == counts[3] == counts[4]
    assert all(not secrets.base_spans(r.text or "") for r in docs.collect())
    assert all(r.n_chars == len(r.text or "") for r in docs.collect())
    packed = p.packing_stage(spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == counts[4]
    # and the whole run gives the same rows
    key = lambda df: sorted(str(tuple(r)) for r in df.collect())
    first = p.run(spark, SF)
    assert key(first) == key(packed)
    # results of several runs, and a single stage called after them, leave each other alone
    second = p.run(spark, SF)
    p.quality_stage(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF).count()
    assert key(first) == key(second) == key(packed)


def test_stages_take_awkward_and_empty_input(spark, awkward, nothing):
    for docs in (cut_lineage(awkward), cut_lineage(nothing)):
        n = docs.count()
        path = f"{spark.sparkContext.getCheckpointDir()}/pipeline-awkward/{n}"
        docs.write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        for name, stage in p.STAGES:
            out = stage(spark, docs, SF)
            if name != "packing":
                assert out.columns == docs.columns
            assert out.count() <= n if name != "packing" else out.count() >= n
