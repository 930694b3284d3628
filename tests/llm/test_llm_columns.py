"""Columns that clash with the operators' own names come back as they were, or are replaced where the docstring says so."""

import pytest
from fixtures_llm import documents, prose
from pyspark.sql import functions as F

from cyclograph.llm import decontamination, jaccard_join, language_id, mixing, pii, quality_rules, sharding, substring_dedup, url_filter

CLASHING = [
    "Score", "PII", "Kept", "N_Words", "Removed", "Shard", "Virtual_Slot", "Copies", "Target", "Source_Size", "row", "own_id", "key", "node",
    "__key", "__id", "__score", "__masks", "__copy", "__size", "__chunk", "__rate", "__source", "__source_id", "__tilt", "___key", "with.dot",
]


@pytest.fixture
def docs(spark):
    base = documents(spark, [" ".join(prose(i % 6, 60)) for i in range(10)] + [None, ""])
    return base.select("*", *[F.lit(7).alias(c) for c in CLASHING], F.create_map(F.lit("a"), F.col("doc_id")).alias("m"))


def check(docs, out, replaced=()):
    rows = out.collect()
    assert len(set(c.lower() for c in out.columns)) == len(out.columns) and rows
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for c in docs.columns:
        if c.lower() not in replaced:
            assert c in out.columns
    for r in rows:
        assert r["text"] == texts[r["doc_id"]] and r["m"] == {"a": r["doc_id"]}
        assert all(r[c] == 7 for c in CLASHING if c.lower() not in replaced)
    return rows


def test_operators(spark, docs):
    some = spark.createDataFrame([(1, "none of it")], "item_id bigint, text string")
    model = language_id.fit(docs)
    assert len(check(docs, language_id.predict(docs, model), ("score", "lang_pred"))) == 12
    assert len(check(docs, pii.with_spans(docs), ("pii",))) == 12
    assert len(check(docs, quality_rules.with_features(docs), (*quality_rules.FEATURES, "base_failed"))) == 12
    judged = url_filter.judge(docs.withColumn("Host", F.lit(7)).withColumn("url", F.lit("http://a.net/b")), [("net/", "block")])
    assert {(r["host"], r["verdict"]) for r in check(docs, judged)} == {("a.net", "block")}
    assert len(check(docs, substring_dedup.remove_repeats(docs), ("n_words", "removed", "kept"))) == 12
    assert len(check(docs, sharding.with_shard(docs, 4), ("shard", "virtual_slot"))) == 12
    assert len(check(docs, jaccard_join.one_of_each(docs))) == 8
    assert len(check(docs, decontamination.remove_contaminated(docs, some))) == 12
    sized = docs.withColumn("size", F.length("text"))
    assert len(check(sized, mixing.mix(sized), mixing.ADDED)) == 12


def test_stages(spark, docs):
    pipeline = pytest.importorskip("corpus_pipeline")
    for name, stage in pipeline.STAGES:
        wide = docs.withColumn("Size", F.lit(7)) if name == "mix" else docs
        rows = check(wide, stage(spark, wide, "/root/testdata/sf0.001"), ("shard", "virtual_slot") if name == "shards" else ())
        assert name != "mix" or all(r["Size"] == 7 for r in rows)


def test_no_tilts(spark, monkeypatch):
    monkeypatch.setattr(mixing, "STEPS", 1)
    sized = documents(spark, [" ".join(prose(i, 10 + i)) for i in range(12)]).withColumn("size", F.length("text"))
    with pytest.raises(RuntimeError, match="no tilts"):
        mixing.mix(sized)
