"""The pipeline's stages on awkward rows and on the sample."""

import corpus_pipeline
from tests.llm.conftest import SF


def test_stages(spark, awkward, nothing):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "decontamination", "personal_data", "packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, awkward, SF)
        assert kept.columns == awkward.columns and kept.schema == awkward.schema
        assert kept.count() <= awkward.count()
        assert stage(spark, nothing, SF).count() == 0


def test_decisions_take_effect(spark):
    text = lambda k: " ".join(f"w{k}x{n}" for n in range(60))
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    rows = [(1, text(1)), (2, text(1) + " end"), (3, text(3) + " " + item), (4, text(4) + " mail a@b.example now"), (5, "too short")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    got = {r.doc_id: r for r in docs.collect()}
    assert sorted(got) == [1, 4]
    assert got[4].text.endswith("mail [EMAIL] now") and got[4].n_chars == len(got[4].text)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert sorted(r.doc_id for r in packed) == [1, 4]
