import random
from collections import Counter

import pytest
from fixtures_llm import ODD_TEXTS, documents, prose
from pyspark.sql import functions as F

from cyclograph.llm import substring_dedup as sd


def brute(texts):
    split = [[w for w in (t or "").encode().split()] for t in texts]
    seen = Counter(tuple(w[i : i + 35]) for w in split for i in range(len(w) - 34))
    out = []
    for words in split:
        gone = set()
        for i in range(len(words) - 34):
            if seen[tuple(words[i : i + 35])] > 1:
                gone.update(range(i, i + 35))
        out.append((len(words), len(gone), b" ".join(w for i, w in enumerate(words) if i not in gone).decode()))
    return out


def some_texts():
    rng = random.Random(11)
    passages = [prose(500 + i, n) for i, n in enumerate((34, 35, 36, 50, 120, 300))]
    texts = list(ODD_TEXTS)
    for i in range(60):
        words = prose(i, rng.randrange(0, 200))
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(words) + 1)
            passage = rng.choice(passages)
            begin = rng.randrange(len(passage) // 2)
            words[at:at] = passage[begin:]
        texts.append(" ".join(words))
    texts += [" ".join(prose(3, 90))] * 4
    texts += ["ho " * 120, "a b " * 50, "\n".join(["one line of words that comes again"] * 12)]
    common = " ".join(prose(888, 45))
    texts += [" ".join(prose(2000 + i, 20)) + " " + common + " " + " ".join(prose(3000 + i, 20)) for i in range(40)]
    return texts


def found(spark, texts):
    cleaned = sd.remove_repeats(documents(spark, texts)).orderBy("doc_id").collect()
    return [(r["n_words"], sum(s["end"] - s["start"] for s in r["removed"]), r["kept"]) for r in cleaned]


def test_equals_brute_force(spark):
    texts = some_texts()
    assert found(spark, texts) == brute(texts)


@pytest.mark.parametrize("segments, windows", [(3, 500), (3, 2), (0, 5)])
def test_large_shards_are_split(spark, monkeypatch, segments, windows):
    monkeypatch.setattr(sd, "SHARD_SEGMENTS", segments)
    monkeypatch.setattr(sd, "SHARD_WINDOWS", windows)
    texts = some_texts()
    assert found(spark, texts) == brute(texts)


@pytest.mark.parametrize("segments", [0, 3, 500])
def test_all_comes_through_automata(spark, monkeypatch, segments):
    monkeypatch.setattr(sd, "SHARD_SEGMENTS", segments)
    monkeypatch.setattr(sd, "_shard_masks", lambda batches: (b for b in batches if False))
    assert {n for _, n, _ in found(spark, some_texts())} == {0}


def test_automaton_statistics():
    rng = random.Random(2)
    for _ in range(200):
        sequences = [[rng.randrange(3) for _ in range(rng.randrange(1, 12))] for _ in range(rng.randrange(1, 5))]
        times = [rng.randrange(1, 3) for _ in sequences]
        automaton = sd.SuffixAutomaton()
        for s, n in zip(sequences, times):
            automaton.add(s, n)
        automaton.close()
        runs = Counter()
        for s, n in zip(sequences, times):
            for a in range(len(s)):
                for b in range(a + 1, len(s) + 1):
                    runs[tuple(s[a:b])] += n
        for s in sequences + [[rng.randrange(4) for _ in range(10)]]:
            expected = [max([n for n in range(1, e + 1) if runs[tuple(s[e - n : e])] >= 2], default=0) for e in range(1, len(s) + 1)]
            assert list(automaton.statistics(s)) == expected


def test_rows_and_columns(spark):
    docs = documents(spark, [None, "", "w " * 40]).withColumn("kept", F.lit(1)).withColumn("key", F.lit(2))
    rows = sd.remove_repeats(docs.unionAll(docs)).collect()
    assert len(rows) == 6 and rows[0]["key"] == 2
    assert sorted(r["n_words"] for r in rows) == [0, 0, 0, 0, 40, 40] and {r["kept"] for r in rows} == {""}
    assert sd.remove_repeats(docs.limit(0)).count() == 0


@pytest.mark.parametrize("n", [34, 35, 36, 63, 200])
def test_edges_of_one_text(spark, n):
    texts = [" ".join(prose(n, n)), " ".join(["x", *prose(n, n), "y"])]
    assert found(spark, texts) == brute(texts)
