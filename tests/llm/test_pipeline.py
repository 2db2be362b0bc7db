"""The pipeline against its stages applied by hand, with near-duplicates by brute force."""

import corpus_pipeline
from tests.llm.test_operators import SF, components, shingles


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    one = corpus_pipeline.drop_toxic(spark, docs, SF).cache()
    two = corpus_pipeline.keep_good(spark, one, SF).cache()
    three = corpus_pipeline.drop_near_copies(spark, two, SF).cache()
    assert one.columns == two.columns == three.columns == docs.columns
    rows = {r.doc_id: r for r in two.collect()}
    first = components([(i, shingles(r.text, 5)) for i, r in rows.items()], 80)
    assert {r.doc_id for r in three.collect()} == set(first.values())
    out = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in out} == set(first.values()) and len(corpus_pipeline.STAGES) == 4
    assert one.count() >= 0.7 * docs.count()
