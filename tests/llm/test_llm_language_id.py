import zlib

import numpy as np
from fixtures_llm import ODD_TEXTS, documents
from pyspark.sql import functions as F

from cyclograph.llm import language_id

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_rule(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept_back = language_id.held_out(F.col("doc_id"))
    model = language_id.fit(docs.filter(~kept_back))
    rows = language_id.predict(docs.withColumn("held_out", kept_back), model).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    tested = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == r["lang"] for r in tested]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_odd_texts_and_clashing_columns(spark):
    model = language_id.fit(documents(spark, ["the cat and the dog"] * 3).unionAll(documents(spark, ["le chat et le chien"] * 3, 10, "fr")))
    docs = documents(spark, [*ODD_TEXTS, "123 !?", "the dog", "le chien"]).withColumn("score", F.lit("mine")).withColumn("lang_pred", F.lit(1))
    rows = language_id.predict(docs, model).orderBy("doc_id").collect()
    assert [r["lang_pred"] for r in rows[:3]] == ["und"] * 3 and rows[8]["lang_pred"] == "und"
    assert [r["lang_pred"] for r in rows[9:]] == ["en", "fr"]
    assert rows[0]["score"] == 0.0 and 0 < rows[3]["score"] <= 1
    assert len(rows) == 11 and len(set(rows[0].asDict())) == 7


def test_scores_equal_brute_force():
    import pyarrow as pa

    rng = np.random.default_rng(1)
    weights = np.vstack([rng.normal(size=(language_id.BUCKETS, 3)), np.zeros((1, 3))])
    texts = ["", "a", "Ab  c1É", "nö " * 3000, None, "zz" * 100_000]
    together, n = language_id.scores(pa.array(texts), weights)
    for text, total, count in zip(texts, together, n):
        alone = language_id.scores(pa.array([text], pa.string()), weights)
        assert np.array_equal(total, alone[0][0]) and count == alone[1][0]
        letters = "".join(c.lower() if c.isalpha() else " " for c in text or "")
        grams = [letters[i : i + k] for k in language_id.LENGTHS for i in range(len(letters) - k + 1)]
        grams = [g for g in grams if g != " " and not g.startswith("  ")]
        expected = np.zeros(3)
        assert count == len(grams)
        for gram in grams if len(grams) < 20_000 else []:
            data = np.frombuffer(gram.encode(), np.uint8)
            rows, _ = language_id.bucket_numbers(data, np.array([0, len(data)]))
            expected += weights[rows[language_id.LENGTHS.index(len(gram))][0]]
        if len(grams) < 20_000:
            assert np.allclose(total, expected)


def test_nothing_to_learn_from(spark):
    docs = documents(spark, ["some text"])
    model = language_id.fit(docs.filter("false"))
    assert language_id.predict(docs, model).first()["lang_pred"] == "und"
    assert language_id.predict(docs.filter("false"), model).count() == 0


def test_texts_in_no_learned_language(spark):
    """An unlearned script, an unlearned language and random letters are told from learned texts of any length."""
    import random

    import corpus_pipeline

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rng = random.Random(2)
    strange = [
        "Это совсем другой язык, и никто его здесь не учил. " * 4,
        "這是另一種語言的文字沒有人學過它" * 6,
        " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(3, 9))) for _ in range(60)),
        " ".join("".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(7)) for _ in range(3000)),
        "123 456 !!!",
        None,
    ]
    added = documents(spark, strange, 10_000_000).withColumn("lang", F.lit(None).cast("string"))
    both = docs.select("doc_id", "text", "lang", "source", F.col("n_chars").cast("bigint").alias("n_chars")).unionAll(added)
    kept = {r[0] for r in corpus_pipeline.language(spark, both, FOLDER).select("doc_id").collect()}
    assert not [i for i in range(len(strange)) if 10_000_000 + i in kept]
    assert len(kept) >= 0.995 * docs.count()


def test_columns_that_differ_by_case(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(200)
    for name in ("Score", "__score", "found", "lettered", "Lang_Pred", "row", "typical"):
        docs = docs.withColumn(name, F.lit(7))
    model = language_id.fit(docs)
    found = language_id.predict(docs, model)
    assert found.columns == [c for c in docs.columns if c not in ("Score", "Lang_Pred")] + ["lang_pred", "score"]
    assert {(r["found"], r["__score"]) for r in found.collect()} == {(7, 7)}
    kept = corpus_pipeline.language(spark, docs, FOLDER)
    assert kept.columns == docs.columns and {(r["__score"], r["Score"], r["typical"]) for r in kept.collect()} == {(7, 7, 7)}
