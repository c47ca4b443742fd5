import corpus_pipeline
from voltframe.llm import bpe, jaccard_join, mixing, pii, toxicity

SF = "/root/testdata/sf0.001"


def test_stages_by_hand(spark):
    """run() equals the operators' own results, put together plainly on the driver."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    toxic = {r["doc_id"] for r in toxicity.score_documents(docs, labels).collect() if r["predicted"]}
    kept = docs.where(~docs.doc_id.isin(list(toxic) or [-1]))
    groups = {r["doc_id"]: r["component_id"]
              for r in jaccard_join.join(kept, 5, jaccard_join.Threshold(4, 5)).collect()}
    kept = kept.where(kept.doc_id.isin([d for d, c in groups.items() if d == c]))
    model = pii.train(pii.scan(kept))
    rows = [(r["doc_id"], pii.redacted(r["text"], model), r["lang"], r["source"], 0) for r in kept.collect()]
    clean = spark.createDataFrame(rows, docs.schema)
    copies = {r["doc_id"]: r["copies"] for r in mixing.mixture(clean).collect()}
    codec = bpe.Codec(bpe.load_vocabulary(bpe.vocabulary_path()))
    want = sorted((d, len(codec.encode(t)) // 4) for d, t, *_ in rows for _ in range(copies[d]))
    got = sorted((r["doc_id"], r["n_tokens"]) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == want and got


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert dict(out.dtypes) == dict(docs.dtypes), name


def test_near_copies_are_found_without_large_groups_of_others(spark, documents, monkeypatch):
    """Texts that share half of their n-grams with the next are not compared as whole sets."""
    parts = [" ".join(f"p{k}w{j}" for j in range(40)) for k in range(31)]
    rows = [(k, f"{parts[k]} {parts[k + 1]}") for k in range(30)] + [(50, f"{parts[3]} {parts[4]} more")]
    sizes, compared = [], jaccard_join._compared

    def spied(docs, groups, threshold, words):
        sizes.append(groups.count())
        return compared(docs, groups, threshold, words)

    monkeypatch.setattr(jaccard_join, "_compared", spied)
    got = corpus_pipeline.drop_near_copies(spark, documents(rows), SF)
    assert sorted(r["doc_id"] for r in got.collect()) == list(range(30)) and sizes == [2]
