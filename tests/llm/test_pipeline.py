"""The stages against plain versions of what each may keep."""

import corpus_pipeline
from brute import components, secrets

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, FOLDER)
        out.write.parquet(str(tmp_path / str(number)))
        before, docs = docs, spark.read.parquet(str(tmp_path / str(number)))
        if number < len(corpus_pipeline.STAGES) - 1:
            assert docs.schema == before.schema, name
        kept[name] = docs
    texts = {name: {r.doc_id: r.text for r in df.collect()} for name, df in list(kept.items())[:4]}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rejected = [q for i, q in labels.items() if i not in texts["quality classifier"]]
    assert rejected and sum(rejected) <= 0.1 * len(rejected) and sum(q == 0 for i, q in labels.items() if i in texts["quality classifier"]) <= 2
    found = components(texts["quality classifier"], 5, 80, 100)
    assert set(texts["n-gram Jaccard join"]) == {i for i, (n, first) in found.items() if first == i or n == 0}
    assert set(texts["secret scans"]) == set(texts["benchmark decontamination"]) <= set(texts["n-gram Jaccard join"])
    assert not any(secrets(t) for t in texts["secret scans"].values())
    packed = kept["best-fit packing"].collect()
    assert {r.doc_id for r in packed} == set(texts["secret scans"])


def test_empty_and_odd_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = spark.createDataFrame([(1, None, "en", None, None, 1), (1, "", None, "s", 0, 2), (None, "some words", "de", "s", 10, 3)], "doc_id long, text string, lang string, source string, n_chars long, key int")
    for start in (docs.limit(0), odd):
        current = start
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES[1:]):
            current = stage(spark, current, FOLDER)
            if number < 3:
                assert current.columns == start.columns
        assert current.count() == start.count()
