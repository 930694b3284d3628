import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cyclograph.llm import whitening
from cyclograph.llm.queries import QUERIES

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def by_hand(vectors):
    """(x of each vector, fit list, mean, eigenvalues, eigenvectors) with numpy alone."""
    x = np.array([[math.floor(256 * float(c)) for c in v] for v in vectors], dtype=np.int64)
    fit = np.unique(x, axis=0)
    centred = fit - fit.mean(axis=0)
    values, directions = np.linalg.eigh(centred.T @ centred / len(fit))
    return x, fit, fit.mean(axis=0), values[::-1], directions[:, ::-1]


def same(rows, vectors, k=4):
    x, fit, mean, values, directions = by_hand([vectors[r["vec_id"]] for r in rows])
    n, sums = len(fit), fit.sum(axis=0)
    for r, own in zip(rows, x):
        assert r["n_fit"] == n and r["deviation"] == sum((n * int(a) - int(s)) ** 2 for a, s in zip(own, sums))
        assert len(r["whitened"]) == k
    found = np.array([r["whitened"] for r in rows])
    for i in range(k):
        wanted = (x - mean) @ directions[:, i] / np.sqrt(values[i])
        sign = np.sign(wanted[np.abs(wanted).argmax()] * found[np.abs(wanted).argmax(), i])
        assert np.allclose(found[:, i], sign * wanted, atol=1e-8)
    return values / values.sum()


def table(spark, vectors):
    return spark.createDataFrame([(i, v, i % 3) for i, v in enumerate(vectors)], SCHEMA).repartition(7)


def test_against_numpy_with_copies_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 8)
    monkeypatch.setattr(whitening, "BLOCK_COLUMNS", 4)
    monkeypatch.setattr(whitening, "BLOCKS_AT_ONCE", 2)
    rng = np.random.default_rng(4)
    vectors = np.float32(rng.normal(size=(120, 10)) * np.arange(1, 11) / 10 + 0.3).tolist()
    vectors += [vectors[0]] * 60 + vectors[5:9]
    found = whitening.whiten(table(spark, vectors))
    rows = found.rows.collect()
    assert len(rows) == len(vectors) and found.n == 120 and found.identity_error < 1e-9
    explained = same(rows, vectors)
    assert np.allclose(found.explained, explained[:4])


def test_unusable_vectors_and_clashing_columns(spark):
    rng = np.random.default_rng(5)
    good = np.float32(rng.normal(size=(30, 6))).tolist()
    bad = [None, [1.0, None, 1.0, 1.0, 1.0, 1.0], [float("nan")] * 6, [1.0, 2.0, 3.0, 4.0, 5.0, float("-inf")]]
    df = table(spark, good + bad).withColumn("Deviation", F.lit("mine")).withColumn("x", F.lit(3)).withColumn("id", F.lit(None).cast("int"))
    df = df.withColumn("index", F.lit(1)).withColumn("m", F.create_map(F.lit("a"), F.lit(1)))
    found = whitening.whiten(df)
    rows = found.rows.collect()
    assert found.rows.columns == ["vec_id", "embedding", "label", "x", "id", "index", "m", "n_fit", "deviation", "whitened"]
    assert sorted(r["vec_id"] for r in rows) == list(range(30)) and {(r["x"], r["index"]) for r in rows} == {(3, 1)}
    same(rows, good)


def test_little_rank(spark):
    one = whitening.whiten(table(spark, [[0.5, 0.25]] * 3))
    assert [r["whitened"] for r in one.rows.collect()] == [[]] * 3 and one.n == 1 and one.rows.first()["deviation"] == 0
    line = whitening.whiten(table(spark, [[0.5 * i, 0.25 * i, 0.0] for i in range(5)]))
    assert {len(r["whitened"]) for r in line.rows.collect()} == {1} and abs(line.explained[0] - 1) < 1e-12
    none = whitening.whiten(table(spark, [[0.5, 0.25]]).filter("false"))
    assert none.rows.count() == 0 and none.n == 0


def test_lengths_that_differ_raise(spark):
    with pytest.raises(ValueError, match="1 to 2"):
        whitening.whiten(table(spark, [[1.0], [1.0, 2.0]]))
    with pytest.raises(ValueError, match="0 to 0"):
        whitening.whiten(table(spark, [[], []]))
    with pytest.raises(ValueError, match="large"):
        whitening.whiten(table(spark, [[1e30], [1.0]]))


def test_query_on_the_smallest_table(spark):
    folder = "/root/testdata/sf0.001"
    table_ = spark.read.parquet(f"{folder}/embeddings.parquet")
    rows = QUERIES["op12_embedding_whitening"](spark, folder).collect()
    assert len(rows) == 4 * table_.count()
    vectors = {r["vec_id"]: r["embedding"] for r in table_.collect()}
    x, fit, mean, values, directions = by_hand([vectors[r["vec_id"]] for r in rows])
    for k in range(4):
        wanted = (x - mean) @ directions[:, k] / np.sqrt(values[k])
        part = [i for i, r in enumerate(rows) if r["component"] == k + 1]
        assert np.allclose(np.abs([rows[i]["whitened"] for i in part]), np.abs(wanted[part]), atol=1e-8)
        assert abs(rows[part[0]]["explained"] / (values[k] / values.sum()) - 1) < 1e-9
    assert rows[0]["identity_error"] < 1e-9 and {r["n"] for r in rows} == {len(fit)}
