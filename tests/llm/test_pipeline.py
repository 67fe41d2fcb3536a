"""The pipeline's stages one after the other, each against what its operator decides on its own input."""

import collections

import corpus_pipeline
from boxloom.cluster import cut
from boxloom.llm import mixing

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, cut(stage(spark, docs, SF))
        seen[name] = (before, docs)
        if name != "sharding":
            assert sorted(docs.columns) == sorted(columns)
    ids = {k: ({r[0] for r in a.select("doc_id").collect()}, [r[0] for r in b.select("doc_id").collect()]) for k, (a, b) in seen.items()}
    for name in ("quality rules", "SimHash near-dedup", "benchmark decontamination"):
        before, after = ids[name]
        assert set(after) < before and len(after) == len(set(after))
    before, _ = seen["mixing sources to target weights"]
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(before).collect()}
    assert collections.Counter(ids["mixing sources to target weights"][1]) == {d: n for d, n in copies.items() if n}
    assert corpus_pipeline.run(spark, SF).count() == seen["sharding"][1].count() == len(ids["mixing sources to target weights"][1])


def test_registered(spark):
    import __spark_entry__ as entry

    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)


def test_stages_without_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = cut(stage(spark, docs, SF))
        assert docs.count() == 0


def test_near_dedup_keeps_rows_without_id(spark):
    text = " ".join(f"w{n}" for n in range(60))
    rows = [(1, text, "en", "a", 1), (2, text, "en", "b", 1), (None, text, "en", "a", 1), (None, "x y", "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.near_dedup(spark, docs, SF).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == [(0, text), (0, "x y"), (1, text)]
