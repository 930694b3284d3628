import re

from fixtures_llm import ODD_TEXTS, documents, prose
from pyspark.sql import functions as F

from cyclograph.llm import mixing


def brute_targets(sizes, weights=(5, 2, 1)):
    """Sizes by source in order; shares are dealt again until no source is above its most."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_ones, target = 1.5 * sum(sizes.values()), set(names), {}
    while open_ones:
        level = left / sum(weight[s] for s in open_ones)
        full = {s for s in open_ones if weight[s] * level > 2 * sizes[s]}
        if not full:
            target |= {s: weight[s] * level for s in open_ones}
            break
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ones -= full
    return target


def mixture(spark):
    texts = ODD_TEXTS + [" ".join(prose(i, 3 + i * 7 % 90)) for i in range(900)]
    docs = documents(spark, texts)
    names = F.when(F.col("doc_id") % 3 == 0, "big").when(F.col("doc_id") % 7 == 1, "é").when(F.col("doc_id") % 11 == 2, F.lit(None)).otherwise("Z")
    return docs.withColumn("source", names).withColumn("copies", F.lit("x"))


def test_mix(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK_ROWS", 100)
    docs = mixture(spark).withColumn("size", mixing.count_words("text"))
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    sizes, taken, target = {}, {}, {}
    for r in rows:
        assert r["size"] == len(re.findall("[^\x20\x09-\x0d]+", r["text"] or ""))
        assert 0 <= r["copies"] <= 2
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["copies"] * r["size"]
        target[r["source"]] = r["target"]
    expected = brute_targets(sizes)
    for s in sizes:
        assert abs(target[s] - expected[s]) < 1e-6 * expected[s]
        assert abs(taken[s] - target[s]) < 0.01 * target[s] + 10
    again = sorted((r["doc_id"], r["copies"]) for r in mixing.mix(docs.repartition(7)).collect())
    assert again == sorted((r["doc_id"], r["copies"]) for r in rows)


def test_targets_by_brute_force(spark):
    import random

    rng = random.Random(6)
    for _ in range(4):
        sizes = {f"s{i}": rng.randrange(0, 1000) ** rng.randrange(1, 3) for i in range(rng.randrange(1, 9))} | {None: 50}
        df = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, source_size bigint, n_rows bigint")
        found = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
        assert {s: round(x, 6) for s, x in found.items()} == {s: round(x, 6) for s, x in brute_targets(sizes).items()}


def test_odd_rows(spark):
    docs = documents(spark, [None, "", "a b", "a b"]).withColumn("size", F.lit(None).cast("int"))
    assert {r["copies"] for r in mixing.mix(docs).collect()} == {0}
    sized = docs.withColumn("size", mixing.count_words("text"))
    rows = mixing.mix(sized.unionAll(sized)).collect()
    assert len(rows) == 8 and all(r["copies"] == 0 for r in rows if not r["size"])
    assert mixing.mix(sized.limit(0)).count() == 0


def test_clashing_columns(spark):
    """Columns named like the working columns come back as they were, from the operator and from the stage."""
    import corpus_pipeline

    docs = documents(spark, [" ".join(prose(i, 5 + i)) for i in range(40)])
    state = ["source_id", "n_rows", "scale", "full", "tilt"]
    for c in state:
        docs = docs.withColumn(c, F.concat(F.lit(c), "doc_id"))
    rows = mixing.mix(docs.withColumn("size", mixing.count_words("text"))).collect()
    assert len(rows) == 40 and all(r[c] == f"{c}{r['doc_id']}" for r in rows for c in state)
    replaced = ["size", "source_size", "target", "Copies"]
    for c in replaced:
        docs = docs.withColumn(c, F.concat(F.lit(c), "doc_id"))
    out = dict(corpus_pipeline.STAGES)["mix"](spark, docs, "")
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    mixed = out.collect()
    assert mixed and all(r[c] == f"{c}{r['doc_id']}" for r in mixed for c in state + replaced)
