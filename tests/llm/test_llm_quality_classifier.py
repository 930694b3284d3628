import zlib

import numpy as np
import pyarrow as pa
from fixtures_llm import ODD_TEXTS, documents, prose
from pyspark.sql import functions as F

from cyclograph.llm import quality_classifier as qc

FOLDER = "/root/testdata/sf0.01"


def random_network(seed=3):
    rng = np.random.default_rng(seed)
    tables = rng.normal(size=(qc.WIDTH, qc.PADDING + 1, qc.FILTERS)).astype(np.float32)
    return tables, rng.normal(size=qc.FILTERS) - 5, rng.normal(size=2 * qc.FILTERS) * 0.2, 0.3


def by_hand(text, network):
    """One text, position by position."""
    tables, bias, weights, offset = network
    data = list((text or "").encode())
    n = max(1, -(-len(data) // qc.BLOCK))
    chunks = [(c * qc.BLOCK, min(c + 2, n) * qc.BLOCK) for c in range(max(1, n - 1))]
    values = []
    for begin, end in chunks:
        best = np.full(qc.FILTERS, -np.inf)
        for p in range(begin, end):
            window = [data[p + j] if p + j < len(data) else qc.PADDING for j in range(qc.WIDTH)]
            best = np.maximum(best, sum(tables[j][b].astype(float) for j, b in enumerate(window)))
        values.append(np.maximum(best + bias, 0))
    features = np.concatenate([np.mean(values, axis=0), np.max(values, axis=0)])
    return 1 / (1 + np.exp(-(features @ weights + offset)))


def test_scores_equal_brute_force():
    network = random_network()
    texts = [*ODD_TEXTS, "b" * 128, "c" * 129, "d" * 256, " ".join(prose(1, 700)), "é" * 64, "z" * 127]
    scores = qc.probabilities(pa.array(texts), network)
    assert np.allclose(scores, [by_hand(t, network) for t in texts], atol=1e-5)
    alone = [qc.probabilities(pa.array([t], pa.string()), network)[0] for t in texts]
    assert np.array_equal(scores, alone)


def test_gradients_equal_differences(monkeypatch):
    rng = np.random.default_rng(1)
    state = {
        "bytes": rng.normal(size=(qc.PADDING + 1, qc.DIMENSIONS)),
        "filters": rng.normal(size=(qc.WIDTH, qc.DIMENSIONS, qc.FILTERS)),
        "bias": rng.normal(size=qc.FILTERS),
        "weights": rng.normal(size=2 * qc.FILTERS),
        "offset": np.array([0.1]),
    }
    monkeypatch.setattr(qc, "folded", lambda s: np.stack([s["bytes"] @ f for f in s["filters"]]))
    monkeypatch.setattr(np, "float32", np.float64)
    texts, labels = [], np.array([1.0, 0.0, 1.0])
    for k, n in enumerate((1, 2, 5)):
        data = rng.integers(97, 123, n * qc.BLOCK - 7 * k).astype(np.uint8)
        texts.append(qc.blocks_of(data, np.array([0, len(data)]))[0])
    _, slopes = qc.gradients(state, texts, labels)
    for key, slope in slopes.items():
        for at in map(tuple, np.argwhere(slope != 0)[:: max(1, np.count_nonzero(slope) // 6)]):
            moved = []
            for sign in (1, -1):
                other = {k: v.copy() for k, v in state.items()}
                other[key][at] += sign * 1e-6
                moved.append(qc.gradients(other, texts, labels)[0])
            assert abs((moved[0] - moved[1]) / 2e-6 - slope[at]) < 1e-5, (key, at)


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")
    network = qc.fit(docs, labels.filter(~qc.held_out(F.col("doc_id"))))
    judged = qc.predict(docs.withColumn("held_out", qc.held_out(F.col("doc_id"))), network).join(labels, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in judged)
    tested = [r for r in judged if r["held_out"] and r["quality"] is not None]
    assert np.mean([(r["score"] >= 0.3) == (r["quality"] == 1) for r in tested]) > 0.93
    assert all(0 <= r["score"] <= 1 for r in judged)


def test_odd_rows_and_clashing_columns(spark):
    docs = documents(spark, [*ODD_TEXTS, *ODD_TEXTS]).withColumn("Score", F.lit("mine")).withColumn("label", F.lit(7))
    scored = qc.predict(docs, random_network())
    rows = scored.orderBy("doc_id").collect()
    assert scored.columns == ["doc_id", "text", "lang", "source", "n_chars", "label", "score"]
    assert len(rows) == 16 and {r["label"] for r in rows} == {7}
    assert [r["score"] for r in rows[:8]] == [r["score"] for r in rows[8:]]
    assert rows[0]["score"] == rows[1]["score"]
    assert qc.predict(docs.filter("false"), random_network()).count() == 0


def test_few_labels(spark):
    docs = documents(spark, ["good words here", "bad"] * 4)
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert qc.predict(docs, qc.fit(docs, none)).first()["score"] == 0.5
    one = spark.createDataFrame([(i, 1) for i in range(8)] + [(None, 0), (1, None)], "doc_id bigint, quality int")
    assert qc.predict(docs, qc.fit(docs, one)).first()["score"] > 0.85
    both = spark.createDataFrame([(i, i % 2) for i in range(8)] * 2, "doc_id bigint, quality int")
    assert qc.predict(docs, qc.fit(docs, both, rows=3)).count() == 8
