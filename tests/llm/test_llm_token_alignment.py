import hashlib
from collections import Counter

import numpy as np
from fixtures_llm import ODD_TEXTS, documents, prose
from pyspark.sql import functions as F

from cyclograph.llm import perfect_hash, token_alignment
from cyclograph.llm.queries import QUERIES

FIRST, SECOND = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"


def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(FIRST)
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=SECOND)


def by_hand(texts):
    """Counts and groups of each text, token by token, with the tokenizers' own libraries."""
    first, second = tokenizers()
    symbols = token_alignment._byte_of_symbol()
    aligned = []
    for text in texts:
        whole = f" {text}".encode()
        a = first.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        bytes_a = [bytes(symbols[c] for c in first.id_to_token(i)) for i in a]
        pieces = [second.id_to_piece(i) for i in b]
        bytes_b = [bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)]
        if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            aligned.append(([], [], [], []))
            continue
        ends_a, ends_b = np.cumsum([len(t) for t in bytes_a]).tolist(), np.cumsum([len(t) for t in bytes_b]).tolist()
        links = [(i, j) for i, x in zip(a, ends_a) for j, y in zip(b, ends_b) if x == y] if len(a) < 400 else None
        if links is None:
            at = dict(zip(ends_b, b))
            links = [(i, at[x]) for i, x in zip(a, ends_a) if x in at]
        cuts = sorted(set(ends_a) & set(ends_b))
        groups = []
        for low, high in zip([0, *cuts], cuts):
            side = [",".join(str(i) for i, x in zip(ids, ends) if low < x <= high) for ids, ends in ((a, ends_a), (b, ends_b))] if len(a) < 400 else None
            groups.append("|".join(side) if side else None)
        aligned.append((a, b, links, groups))
    counts = Counter(link for _, _, links, _ in aligned for link in links)
    best = Counter()
    for (_, j), n in counts.items():
        best[j] = max(best[j], n)
    for a, b, links, groups in aligned:
        n_best = sum(counts[link] == best[link[1]] for link in links)
        text = None if None in groups else ";".join(groups)
        yield len(a), len(b), len(groups), len(links), n_best, sum(counts[link] for link in links), text


def same(rows, texts):
    for row, expected in zip(rows, by_hand(texts), strict=True):
        found = tuple(row[c] for c in token_alignment.ADDED)
        assert found[:-1] == expected[:-1]
        assert expected[-1] is None or found[-1] == expected[-1]


TEXTS = [
    *ODD_TEXTS,
    " two  spaces and\ttabs\r\n ",
    "<|endoftext|> <s>x</s><unk> <0x41>",
    "▁a",
    "naïve café 日本語 😀 1234567",
    " ".join(prose(3, 60)),
    "unbelievably counterintuitive tokenisation",
    "</s>",
    "The cat, the dog; the end.",
] + ["The cat, the dog; the end."] * 6


def test_against_the_tokenizers_libraries(spark):
    found = token_alignment.align(documents(spark, TEXTS).repartition(3), FIRST, SECOND)
    assert found.columns == ["doc_id", "lang", "source", "n_chars", *token_alignment.ADDED]
    same(found.orderBy("doc_id").collect(), TEXTS)


def test_many_blocks_of_pairs(spark, monkeypatch):
    for name, value in (("SHARD_PAIRS", 16), ("BLOCK_PAIRS", 40), ("SEGMENT", 7), ("MERGED_IDS", 20), ("SLICE_TOKENS", 50), ("CHUNK_CHARS", 60)):
        monkeypatch.setattr(token_alignment, name, value)
    found = token_alignment.align(documents(spark, TEXTS).repartition(5), FIRST, SECOND)
    same(found.orderBy("doc_id").collect(), TEXTS)


def test_repeated_null_and_clashing_columns(spark):
    docs = documents(spark, ["a b c", None, "a b c"]).withColumn("doc_id", F.lit(None).cast("bigint"))
    docs = docs.withColumn("N_A", F.lit("old")).withColumn("id", F.lit(3)).withColumn("row", F.lit(4)).withColumn("odd name.", F.lit(5))
    rows = token_alignment.align(docs, FIRST, SECOND).collect()
    assert len(rows) == 3 and {(r["id"], r["row"], r["odd name."], r["doc_id"]) for r in rows} == {(3, 4, 5, None)}
    assert sorted(r["n_a"] for r in rows) == [0, 3, 3] and sorted(r["count_sum"] for r in rows) == [0, 6, 6]
    assert token_alignment.align(docs.filter("false"), FIRST, SECOND).count() == 0
    only = token_alignment.align(docs.select("text"), FIRST, SECOND)
    assert only.columns == list(token_alignment.ADDED) and only.count() == 3


def test_every_character_and_long_runs():
    with open(FIRST, "rb") as one, open(SECOND, "rb") as two:
        pair = token_alignment.Pair(one.read(), two.read())
    first, _ = tokenizers()
    letters = [chr(p) for p in range(0x110000) if not 0xD800 <= p < 0xE000]
    runs = [" a" + "a ".join(letters[i : i + 64]) for i in range(0, 0x30000, 64)]
    slow = [e.ids for e in first.encode_batch(runs, add_special_tokens=False)]
    assert [pair.first_ids(t) for t in runs] == slow
    long = "x" * 300_000 + " " * 1_200_000 + "7" * 300_000
    a, b = next(pair.tokens([long]))
    assert b"".join(pair.first_bytes[i] for i in a) == b"".join(pair.second_bytes[i] for i in b) == f" {long}".encode()


def test_perfect_hash():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 1000, 50_000):
        keys = np.unique(rng.integers(0, 2**62, n).astype(np.uint64))
        levels, ordered = perfect_hash.build(keys)
        at = perfect_hash.find(levels, ordered, keys)
        assert np.array_equal(np.sort(at), np.arange(len(keys))) and np.array_equal(ordered[at], keys)
        assert (perfect_hash.find(levels, ordered, keys + np.uint64(2**62)) == -1).all()


def test_query_on_the_smallest_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    rows = sorted(QUERIES["op13_token_alignment"](spark, folder).collect(), key=lambda r: r["doc_id"])
    for row, expected in zip(rows, by_hand([docs[r["doc_id"]] for r in rows]), strict=True):
        assert (row["n_a"], row["n_b"], row["n_groups"], row["n_links"], row["n_best"], row["count_sum"]) == expected[:-1]
        if expected[-1] is not None:
            assert row["groups_sha256"] == (hashlib.sha256(expected[-1].encode()).hexdigest() if expected[-1] else "")
