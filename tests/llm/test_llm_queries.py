"""Every registered query of the package on the smallest tables, against SQL where there is a twin."""

from collections import Counter

import pytest

import corpus_pipeline
from cyclograph.llm.queries import QUERIES, SQL
from oracle import connect, differences

FOLDER = "/root/testdata/sf0.001"

COLUMNS = {
    "op1": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    "op2": "doc_id held_out lang_pred score",
    "op3": "doc_id class_id n_links",
    "op4": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op5": "doc_id n_words n_removed kept_sha256",
    "op6": "doc_id size text_crc32 law shard slot grown_shard",
    "op7": "page_id host path rule verdict",
    "op8": "doc_id size source_size target taken",
    "op9": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op10": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op11": "doc_id held_out score predicted",
    "op12": "vec_id component n deviation whitened explained identity_error",
    "op13": "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256",
}


def test_each_operator_has_one_query():
    assert sorted(QUERIES) == sorted([*QUERIES.keys() - {"pipeline"}, "pipeline"])
    assert {name.split("_")[0] for name in QUERIES} == {*COLUMNS, "pipeline"}


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - {"pipeline"}))
def test_columns_and_rows(spark, name):
    df = QUERIES[name](spark, FOLDER)
    wanted = COLUMNS[name.split("_")[0]].split()
    assert df.columns[: len(wanted)] == wanted
    table = {"op1": "conversations", "op7": "pages", "op12": "embeddings"}.get(name.split("_")[0], "documents")
    rows = spark.read.parquet(f"{FOLDER}/{table}.parquet")
    expected = rows.select("conv_id").distinct().count() + 1 if table == "conversations" else rows.count() * (4 if table == "embeddings" else 1)
    assert df.count() == expected


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, name):
    problem, _ = differences(spark, connect(FOLDER), FOLDER, QUERIES[name], SQL[name])
    assert problem is None, problem


def test_stages_keep_columns_and_clean_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, FOLDER)
        assert after.columns == docs.columns and after.dtypes == docs.dtypes, name
        if name != "mix":
            assert not Counter(after.collect()) - Counter(docs.collect()), name
        docs = after
    assert {"doc_id", "text", "shard"} <= set(corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).columns)


def test_pipeline_equals_brute_force(spark):
    """Each stage after the trained one against brute force on the rows it was given."""
    import re

    from test_llm_decontamination import brute as contaminated
    from test_llm_jaccard_join import brute as classes
    from test_llm_mixing import brute_targets

    stages = dict(corpus_pipeline.STAGES)
    docs = stages["language"](spark, spark.read.parquet(f"{FOLDER}/documents.parquet"), FOLDER)
    rows = sorted(docs.collect(), key=lambda r: r["doc_id"])
    assert all(r["lang"] in ("en", "fr", "de", "es") for r in rows) and len(rows) == docs.count()

    found = classes([r["text"] for r in rows])
    rows = [r for i, r in enumerate(rows) if found[i][0] == i]
    docs = stages["near_copies"](spark, docs, FOLDER)
    assert sorted(r["doc_id"] for r in docs.collect()) == [r["doc_id"] for r in rows]

    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    rows = [r for r, (n, hit, _) in zip(rows, contaminated([r["text"] for r in rows], items)) if not (hit and 20 * hit >= n)]
    docs = stages["benchmark_passages"](spark, docs, FOLDER)
    assert sorted(r["doc_id"] for r in docs.collect()) == [r["doc_id"] for r in rows]

    size = {r["doc_id"]: len(re.findall("[^\x20\x09-\x0d]+", r["text"] or "")) for r in rows}
    source = {r["doc_id"]: r["source"] for r in rows}
    sizes, taken = Counter(), Counter()
    for i, n in size.items():
        sizes[source[i]] += n
    docs = stages["mix"](spark, docs, FOLDER)
    copies = Counter(r["doc_id"] for r in docs.collect())
    for i, n in copies.items():
        assert n <= 2
        taken[source[i]] += n * size[i]
    for s, target in brute_targets(dict(sizes)).items():
        assert abs(taken[s] - target) <= 0.02 * target + 20, s

    placed = stages["shards"](spark, docs, FOLDER).collect()
    assert Counter(r["doc_id"] for r in placed) == copies
    loads = Counter()
    for r in placed:
        loads[r["shard"]] += len(r["text"].encode()) + 1
    assert set(loads) == set(range(8))

    ran = corpus_pipeline.run(spark, FOLDER).select("doc_id", "shard").collect()
    assert Counter(map(tuple, ran)) == Counter((r["doc_id"], r["shard"]) for r in placed)


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, FOLDER).count() == 0, name
