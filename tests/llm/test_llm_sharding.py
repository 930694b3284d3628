import zlib

from fixtures_llm import ODD_TEXTS, documents, prose
from pyspark.sql import functions as F

from cyclograph.llm import sharding
from cyclograph.session import new_folder


def test_sizes_places_and_balance(spark):
    texts = ODD_TEXTS + [" ".join(prose(i, 5 + i % 40)) for i in range(600)]
    docs = documents(spark, texts).withColumn("shard", F.lit("mine")).withColumn("size", F.lit(1))
    rows = sharding.shard(docs.unionAll(docs.limit(3)), 8).collect()
    assert len(rows) == len(texts) + 3
    loads, places = [0] * 8, {}
    for r in rows:
        text = texts[r["doc_id"]]
        assert r["size"] == len((text or "").encode()) + 1
        assert r["text_crc32"] == (None if text is None else zlib.crc32(text.encode()))
        loads[r["shard"]] += r["size"]
        places.setdefault(r["shard"], []).append(r["slot"])
    assert max(loads) - min(loads) <= 5001
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    again = {(r["doc_id"], r["shard"], r["slot"]) for r in sharding.shard(docs.unionAll(docs.limit(3)), 8).collect()}
    assert again == {(r["doc_id"], r["shard"], r["slot"]) for r in rows}


def test_rebalancing_edits_the_map(spark):
    records = sharding.sized(documents(spark, [" ".join(prose(i, 20)) for i in range(3000)]))
    folder = new_folder(spark, "maps")
    first = sharding.save_map(sharding.assign(sharding.slot_sizes(records), 8), folder, 1)
    second = sharding.save_map(sharding.assign(sharding.slot_sizes(records), 9, first), folder, 2)
    moved = first.alias("a").join(second.alias("b"), "virtual_slot").filter("a.shard <> b.shard").select("b.shard", "b.bytes").collect()
    total = first.agg(F.sum("bytes")).first()[0]
    assert {r["shard"] for r in moved} == {8}
    assert sum(r["bytes"] for r in moved) < 1.1 * total / 9
    loads = [r["b"] for r in second.groupBy("shard").agg(F.sum("bytes").alias("b")).collect()]
    assert len(loads) == 9 and max(loads) < 1.02 * total / 9
    assert sharding.load_map(spark, folder, 1).count() == first.count()


def test_odd_rows(spark):
    docs = documents(spark, ["a", None]).selectExpr("cast(null as bigint) doc_id", "text", "lang", "source", "n_chars")
    assert sharding.shard(docs.unionAll(docs), 8).count() == 4
    assert sharding.shard(docs.limit(0), 8).count() == 0
    assert sharding.with_shard(docs, 3).count() == 2


def test_no_python_in_the_plan(spark):
    plan = sharding.shard(documents(spark, ["a"]), 8)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
