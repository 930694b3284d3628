import random
from collections import Counter

import numpy as np
import pytest
from fixtures_llm import ODD_TEXTS, documents, prose
from pyspark.sql import functions as F

from cyclograph.llm import jaccard_join as jj
from cyclograph.llm.components import components


def brute(texts):
    sets = []
    for t in texts:
        words = (t or "").split()
        k = min(5, len(words))
        sets.append({tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if k else set())
    links = {i: set() for i in range(len(texts))}
    for i in range(len(texts)):
        for j in range(i):
            common, whole = len(sets[i] & sets[j]), len(sets[i] | sets[j])
            if common and 5 * common >= 4 * whole:
                links[i].add(j)
                links[j].add(i)
    names = {}
    for i in range(len(texts)):
        if i not in names:
            stack = [i]
            while stack:
                x = stack.pop()
                if x not in names:
                    names[x] = i
                    stack.extend(links[x])
    return {i: (names[i], len(links[i])) for i in range(len(texts))}


def near_copies(seed, words, n, changes):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        copy = words.copy()
        for _ in range(rng.randrange(changes + 1)):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


def some_texts():
    texts = list(ODD_TEXTS) + ["same words here"] * 3
    for seed in range(25):
        texts += near_copies(seed, prose(seed, 200), 3, 6)
    texts += near_copies(77, prose(77, 400), 90, 6)  # more than a bucket holds
    shared = prose(99, 60)
    texts += [" ".join(shared + prose(1000 + i, 300)) for i in range(80)]
    texts += [" ".join(prose(5, 150))] * 70
    return texts


@pytest.fixture(scope="module")
def joined(spark):
    texts = some_texts()
    rows = jj.join_texts(documents(spark, texts)).collect()
    return texts, {r["doc_id"]: (r["class_id"], r["n_links"]) for r in rows}, len(rows)


def test_equals_brute_force(joined):
    texts, found, n = joined
    assert n == len(texts)
    assert found == brute(texts)


def test_large_groups_in_blocks(spark, joined, monkeypatch):
    texts, found, _ = joined
    for shingles in (8000, 150):  # down to blocks of one set, or of none
        monkeypatch.setattr(jj, "UNIT_SHINGLES", shingles)
        rows = jj.join_texts(documents(spark, texts)).collect()
        assert {r["doc_id"]: (r["class_id"], r["n_links"]) for r in rows} == found


def test_one_of_each(spark, joined):
    texts, found, _ = joined
    docs = documents(spark, texts)
    kept = [r["doc_id"] for r in jj.one_of_each(docs).collect()]
    assert sorted(kept) == sorted(i for i, (c, _) in found.items() if c == i)
    twice = docs.unionAll(docs).unionAll(documents(spark, ["no id"], 0).selectExpr("cast(null as bigint) doc_id", "text", "lang", "source", "n_chars"))
    again = Counter(r["doc_id"] for r in jj.one_of_each(twice).collect())
    empty = Counter(i for i, t in enumerate(texts) if not (t or "").split())
    assert again == Counter([*kept, None]) + empty  # rows without words are no copies


def test_one_of_each_keeps_rows_without_words(spark):
    """They are no copies: all of them stay, whatever their ids."""
    docs = documents(spark, [None, "", " \n", None, "a b", "a b"])
    for doc_id in (None, 7):
        same_id = docs.withColumn("doc_id", F.lit(doc_id).cast("bigint"))
        assert Counter(r["text"] for r in jj.one_of_each(same_id).collect()) == {None: 2, "": 1, " \n": 1, "a b": 1}


def test_clashing_columns_come_back_as_they_were(spark):
    docs = documents(spark, ["a b c", "a b c", "other words", None])
    for name in ("__key", "key", "text_key", "Node", "nth", "row", "m", "class_node"):
        docs = docs.withColumn(name, F.lit(7))
    docs = docs.withColumn("map", F.create_map(F.lit("k"), F.lit(1)))
    kept = jj.one_of_each(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert sorted(r["doc_id"] for r in rows) == [0, 2, 3] and {r["__key"] for r in rows} == {r["Node"] for r in rows} == {7}


@pytest.mark.parametrize("doc_id", [None, 5])
def test_null_and_repeated_ids_do_not_multiply(spark, doc_id, tmp_path, monkeypatch):
    """Rows into the exact join stay a small multiple of the rows; a pair each, and one text 300 times."""
    texts = [" ".join(prose(i // 2, 60)[: 60 - i % 2]) for i in range(600)] + [" ".join(prose(999, 40))] * 300 + [" ".join(prose(999, 40)[1:])]
    docs = documents(spark, texts).withColumn("doc_id", F.lit(doc_id).cast("bigint")).repartition(4)
    real, log = jj._once, str(tmp_path)

    def counted(batches):
        import uuid

        n = 0
        for batch in batches:
            n += batch.num_rows
            yield from real([batch])
        with open(f"{log}/{uuid.uuid4().hex}", "w") as out:
            out.write(str(n))

    monkeypatch.setattr(jj, "_once", counted)
    rows = jj.join_texts(docs).collect()
    assert Counter(r["n_links"] for r in rows) == {1: 600, 300: 301}
    assert 0 < sum(int(f.read_text()) for f in tmp_path.iterdir()) <= 2 * len(texts)
    assert jj.one_of_each(docs).count() == 301


def test_odd_rows(spark):
    docs = documents(spark, [None, None, "", "a b"]).unionAll(documents(spark, ["a b"], 3)).withColumnRenamed("source", "node")
    rows = sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in jj.join_texts(docs).collect())
    assert rows == [(0, 0, 0), (1, 1, 0), (2, 2, 0), (3, 3, 1), (3, 3, 1)]
    assert jj.join_texts(docs.limit(0)).count() == 0


def test_runs_reach_the_recall():
    """Chance of meeting at full depth, by simulation on pairs at the threshold."""
    rng = np.random.default_rng(3)
    runs = jj.runs_for(jj.RECALL)
    missed = 0
    for _ in range(3000):
        agree = rng.random(jj.COORDINATES) < 0.8
        roots = jj.mixed(rng.integers(0, 2**63, runs, dtype=np.uint64))
        paths = roots
        for _ in range(jj.DEPTH):
            one, two = jj._sampled(paths)
            more = two >= 0
            coordinates = np.concatenate([one, two[more]])
            paths = jj._child(np.concatenate([paths, paths[more]]), coordinates, np.zeros(len(coordinates), np.uint64))[agree[coordinates]]
        missed += not len(paths)
    assert missed / 3000 < 0.01


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1200)] + [(7, 7)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    found = dict(map(tuple, components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()))
    assert found == {x: root(x) for a, b in edges if a != b for x in (a, b)}
