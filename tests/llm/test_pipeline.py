import collections

import corpus_pipeline as cp
from pyspark.sql import functions as F

from tessera.llm import mixing, toxicity
from tessera.llm._common import stored
from tessera.llm.queries import label_quality
from tests.llm.test_corpus_operators import brute_components


def test_stages_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = stored(cp.drop_toxic(spark, docs, sf))
    model = toxicity.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    all_docs = docs.collect()
    score = model.score([r.text for r in all_docs])
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r, s in zip(all_docs, score) if s < 0.3)
    one = stored(cp.drop_near_duplicates(spark, kept, sf))
    comp = brute_components([(r.doc_id, r.text) for r in kept.collect()], 5)
    assert one.columns == docs.columns and sorted(r.doc_id for r in one.collect()) == sorted(i for i, c in comp.items() if i == c)
    mixed = stored(cp.mix_sources(spark, one, sf))
    want = {r.doc_id: r.copies for r in mixing.mix(one, quality=label_quality(spark, sf)).collect() if r.copies}
    assert mixed.columns == docs.columns and collections.Counter(r.doc_id for r in mixed.collect()) == want
    out = cp.encode(spark, mixed, sf)
    assert out.count() == sum(want.values()) and out.where(F.length("ids_sha256") != 64).count() == 0


def test_stages_survive_odd_tables(spark, sf, odd_docs, no_docs):
    for docs in (odd_docs, no_docs, odd_docs.withColumn("toxicity", F.lit(1)).withColumn("copies", F.lit(1))):
        now = docs
        for _, stage in cp.STAGES:
            now = stored(stage(spark, now, sf))
        assert now.count() >= 0


def test_shape():
    assert [n for n, _ in cp.STAGES] == ["toxicity", "near_duplicates", "mixing", "encoding"] and cp.ORACLE_SQL is None
