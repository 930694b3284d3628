import random
import re

import numpy as np
from fixtures_llm import ODD_TEXTS, documents, prose
from pyspark.sql import functions as F

from cyclograph.llm import decontamination as dc


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)


def brute(texts, items):
    windows = {}
    for name, text in items:
        w = words(text)
        k = min(13, len(w))
        for i in range(len(w) - k + 1) if k else ():
            windows.setdefault(tuple(w[i : i + k]), set()).add("" if name is None else str(name))
    sizes = {len(w) for w in windows}
    out = []
    for text in texts:
        w, hit, names = words(text), set(), set()
        for k in sizes:
            for i in range(len(w) - k + 1):
                if found := windows.get(tuple(w[i : i + k])):
                    hit.update(range(i, i + k))
                    names |= found
        out.append((len(w), len(hit), sorted(names)))
    return out


ITEMS = [
    (1, " ".join(prose(1, 40))), (10, " ".join(prose(2, 13))), (2, " ".join(prose(3, 12))), (3, "Rare-Word"), (4, None), (5, "!?"),
    (None, "only here"), (1, " ".join(prose(4, 15))), (7, " ".join(prose(1, 40)[:20])), (8, "la la la " * 6),
]


def some_texts():
    rng = random.Random(4)
    texts = list(ODD_TEXTS) + ["rare word RARE_WORD", "Only, here", "la " * 30]
    for i in range(60):
        w = prose(100 + i, 80)
        source = prose(rng.randrange(1, 5), 40)
        a = rng.randrange(25)
        w[20:20] = [x.upper() + "," for x in source[a : a + rng.randrange(8, 30)]]
        texts.append(" ".join(w))
    return texts


def found(spark, texts):
    benchmark = spark.createDataFrame(ITEMS, "item_id bigint, text string").selectExpr("*", "1 as doc_id")
    rows = dc.contamination(documents(spark, texts), benchmark).collect()
    rows.sort(key=lambda r: int(r["doc_id"]))
    return [(r["n_words"], len(r["hit_words"]), r["items"]) for r in rows]


def test_equals_brute_force(spark):
    texts = some_texts()
    assert found(spark, texts) == brute(texts, ITEMS)


def test_blocks_of_the_benchmark(spark, monkeypatch):
    monkeypatch.setattr(dc, "BLOCK_BYTES", 150)
    texts = some_texts()
    assert found(spark, texts) == brute(texts, ITEMS)


def test_pieces_and_candidates_in_parts(spark, monkeypatch):
    monkeypatch.setattr(dc, "PIECE_WORDS", 5)
    monkeypatch.setattr(dc, "CANDIDATES", 3)
    monkeypatch.setattr(dc, "SEGMENT_BYTES", 2000)
    texts = some_texts()
    assert found(spark, texts) == brute(texts, ITEMS)


def test_a_filter_that_lets_other_terms_pass(spark, monkeypatch):
    texts = some_texts()
    for bits in (6, 9):
        monkeypatch.setattr(dc, "FILTER_BITS", bits)
        assert found(spark, texts) == brute(texts, ITEMS)


def test_anchors_are_the_rarest_words_of_all_documents():
    """Runs that share their rarest word are one group; the same runs of several items too."""
    count = {"a": 9, "b": 8, "c": 1, "d": 7, "e": 0}
    hashes = {w: np.uint64(i) for i, w in enumerate("abcde")}

    def compiled(*texts):
        pieces = [(str(i), np.array([hashes[w] for w in t.split()], np.uint64)) for i, t in enumerate(texts)]
        return dc.compile_passages(pieces, lambda terms: np.array([count["abcde"[int(t)]] for t in terms]), window=3)

    p = compiled("a b c d a b", "a b c d a b", "b c", "a b e a")
    runs = sorted(
        (" ".join("abcde"[p.words[i]] for i in range(p.low[g], p.high[g] + p.length[g])), "abcde"[p.words[p.anchor[g]]], p.owners[p.starts[g] : p.starts[g + 1]].tolist())
        for g in range(len(p.anchor))
    )
    assert runs == [("a b c d a", "c", [0, 1]), ("b c", "c", [2]), ("d a b", "d", [0, 1])]
    assert len(compiled("e e e").anchor) == 0


def near_by_hand(text, items, slop):
    """(item, place) of each word of the document from which all words of one of the item's runs stand
    within ``slop`` of their places; the word is the run's rarest term in all documents (here: any)."""
    w = words(text)
    out = {}
    for name, item in items:
        run = words(item)
        for j, anchor in enumerate(run):
            for p, word in enumerate(w):
                if word == anchor and all(
                    any(w[q] == x for q in range(max(0, p - j + i - slop), min(len(w), p - j + i + slop + 1))) for i, x in enumerate(run)
                ):
                    out.setdefault(str(name), set()).add((j, p))
    return out


def test_proximity_equals_brute_force(spark):
    """Passages of distinct words, so that each run has one anchor; transposed words at either end of
    documents, and passages that would reach into the next document."""
    items = [(1, "alpha beta gamma delta"), (2, "p q r"), (3, "one two three four five six seven")]
    texts = [
        "alpha beta gamma delta", "alpha beta x gamma delta", "alpha q q q q beta gamma delta", "x y z a b c p", "r p q p q s", "q r p",
        "p", "q r", "beta alpha delta gamma", "seven one two three four six five", "seven six five four three two one", None, "", "r q p r q p",
    ]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    for slop in (0, 1, 2, 3):
        rows = sorted(dc.contamination(documents(spark, texts).coalesce(1), benchmark, slop=slop).collect(), key=lambda r: int(r["doc_id"]))
        for row, text in zip(rows, texts):
            by_anchor = near_by_hand(text, items, slop)
            found = {n["item"]: set(n["words"]) for n in row["near"]}
            if not slop:
                assert not found
                continue
            assert found.keys() <= by_anchor.keys()
            for item, places in found.items():  # the anchor is one of the run's words
                assert any(places == {p for k, p in by_anchor[item] if k == j} for j in {k for k, _ in by_anchor[item]})
            sure = {i for i, found_at in by_anchor.items() if len({j for j, _ in found_at}) == len(words(dict((str(a), b) for a, b in items)[i]))}
            assert sure <= found.keys()
        assert [len(r["hit_words"]) for r in rows][:2] == [4, 0]


def test_clashing_columns_come_back_as_they_were(spark):
    benchmark = spark.createDataFrame([(1, "some words")], "item_id bigint, text string")
    docs = documents(spark, ["some words", "others", None])
    for name in ("__id", "__key", "id", "key", "row", "Items", "own_id"):
        docs = docs.withColumn(name, F.lit(7))
    kept = dc.remove_contaminated(docs, benchmark)
    assert kept.columns == docs.columns and sorted((r["doc_id"], r["__id"], r["Items"]) for r in kept.collect()) == [(1, 7, 7), (2, 7, 7)]


def test_removal(spark):
    texts = some_texts()
    benchmark = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    docs = documents(spark, texts)
    nameless = docs.filter("doc_id >= 20").selectExpr("cast(null as bigint) doc_id", "text", "lang", "source", "n_chars")
    kept = [r["doc_id"] for r in dc.remove_contaminated(docs.unionAll(docs.limit(5)), benchmark).collect()]
    bad = [h > 0 and 20 * h >= n for n, h, _ in brute(texts, ITEMS)]
    clean = [i for i, b in enumerate(bad) if not b]
    assert sorted(kept) == sorted(clean + [i for i in clean if i < 5])
    assert dc.remove_contaminated(nameless, benchmark).count() == sum(i >= 20 for i in clean)


def test_empty_tables(spark):
    benchmark = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    docs = documents(spark, ["some text"])
    assert dc.contamination(docs.limit(0), benchmark).count() == 0
    rows = dc.contamination(docs, benchmark.limit(0)).collect()
    assert [(r["n_words"], r["hit_words"], r["items"]) for r in rows] == [(2, [], [])]
