"""Quality rules with risk-controlled thresholds.

Every rule rejects documents whose statistic reaches a cutoff. On labelled documents, each
stratum gets the strictest cutoffs whose joint false rejection rate is proven low: going from
lenient to strict, rule after rule, a cutoff is added while the exact binomial probability of so
few good documents rejected by any rule so far, were the true rate RISK, stays under the error
allowed. Fixed-sequence testing along this path needs no division of the error, as long as the
path doesn't depend on the good documents it is tested on. So the order of the rules, and where
each one stops, come from the bad documents and from other good ones: a part set aside, or those
of the other strata where a stratum has too few. The error is divided among strata (Bonferroni).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from cyclograph.llm.columns import free_name, named, others
from cyclograph.llm.words import NOT_BLANK, byte_class, mixed, text_chunks, words_of
from cyclograph.session import materialize

REPEAT_WINDOW = 8
SYMBOLS = byte_class(lambda b: chr(b) in "#*$%&|<>")
CAPITAL = byte_class(lambda b: 0x41 <= b <= 0x5A)
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals")

RISK = 0.01
"""Share of a stratum's good documents that all rules together may reject by mistake."""
ERROR = 0.05
"""Chance that any of the guarantees fails to hold."""
LIFT = 4.0
"""A cutoff must reject bad documents at this many times the rate of good ones, else it stays unused."""
PILOT = 5
"""One in so many good documents is set aside to find the path ..."""
PILOT_FROM = 1000
"""... in strata of so many good documents."""
BINS = 200

# name -> (statistic, units per bin): a document is rejected from a bin on.
RULES: dict[str, tuple[str, float]] = {
    "symbols": ("100.0 * n_symbols / word_chars", 0.5),
    "repeated lines": ("100.0 * n_dup_lines / n_lines", 0.5),
    "repeated words": ("100.0 * n_repeat_words / n_words", 0.5),
    "long words": ("1.0 * word_chars / n_words", 0.1),
    "capitals": ("100.0 * n_capitals / word_chars", 0.5),
}
BANDS = (100, 400)
"""Strata by number of words: below, between and from these numbers on."""


def _dup_lines(text: bytes) -> tuple[int, int]:
    if b"\n" not in text:
        return (1 if text.strip() else 0), 0
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines), len(lines) - len(set(lines))


def features_of(column: pa.Array) -> dict[str, np.ndarray]:
    """Counts of each whole text; null and empty texts count 0 everywhere."""
    out = {name: np.zeros(len(column), np.int64) for name in FEATURES}
    for row, data, offsets in text_chunks(column):
        n = len(offsets) - 1
        words = words_of(data, offsets)
        part = slice(row, row + n)

        def per_text(flags: np.ndarray, at=offsets) -> np.ndarray:
            return np.diff(np.concatenate([[0], np.cumsum(flags)])[at])

        out["n_words"][part] = words.counts()
        out["word_chars"][part] = per_text(NOT_BLANK[data] & ((data & 0xC0) != 0x80))
        out["n_symbols"][part] = per_text(SYMBOLS[data])
        out["n_capitals"][part] = per_text(CAPITAL[data])
        at, h = words.windows(REPEAT_WINDOW)
        if len(at):
            h = mixed(h + (words.text_of_word()[at] + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            order = np.argsort(h, kind="stable")
            same = h[order[1:]] == h[order[:-1]]
            twice = np.concatenate([same, [False]]) | np.concatenate([[False], same])
            begin = at[order[twice]]
            covered = np.zeros(len(words.hashes) + REPEAT_WINDOW + 1, np.int32)
            np.add.at(covered, begin, 1)
            np.add.at(covered, begin + REPEAT_WINDOW, -1)
            out["n_repeat_words"][part] = per_text(np.cumsum(covered)[: len(words.hashes)] > 0, words.first)
        raw = data.tobytes()
        for i in range(n):
            out["n_lines"][row + i], out["n_dup_lines"][row + i] = _dup_lines(raw[offsets[i] : offsets[i + 1]])
    return out


def with_features(documents: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts in FEATURES and base_failed; columns of these names, whatever their case, are replaced."""

    @arrow_udf("struct<" + ", ".join(f"{name}: bigint" for name in FEATURES) + ">")
    def counted(texts: pa.Array) -> pa.Array:
        found = features_of(texts)
        return pa.StructArray.from_arrays([pa.array(found[name]) for name in FEATURES], list(FEATURES))

    kept, found = others(documents, (*FEATURES, "base_failed")), free_name(documents, "features")
    rows = documents.select(*kept, counted(named(text)).alias(found))
    rows = rows.select(*kept, *[named(found)[name].alias(name) for name in FEATURES])
    return rows.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def length_band() -> Column:
    band = F.lit(len(BANDS))
    for i in reversed(range(len(BANDS))):
        band = F.when(F.col("n_words") < BANDS[i], i).otherwise(band)
    return band.cast("string")


def _bin(rule: str) -> Column:
    statistic, unit = RULES[rule]
    return F.least(F.floor(F.coalesce(F.expr(f"try_divide({statistic.replace(' / ', ', ')})"), F.lit(0.0)) / unit), F.lit(BINS)).cast("int")


def binomial_at_most(k: int, n: int, p: float) -> float:
    """Exact probability of at most k successes among n."""
    if k >= n:
        return 1.0
    logs = [
        math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
        for i in range(k + 1)
    ]
    top = max(logs)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in logs))


def strictest(good: np.ndarray, bad: np.ndarray, risk: float, error: float) -> int | None:
    """The lowest bin from which on documents may be rejected; None if no cutoff is proven.

    ``good`` and ``bad`` count labelled documents by bin, or by level of a path.
    """
    n_good, n_bad = int(good.sum()), int(bad.sum())
    rejected_good, rejected_bad, best = 0, 0, None
    for cutoff in range(len(good) - 1, 0, -1):
        rejected_good, rejected_bad = rejected_good + int(good[cutoff]), rejected_bad + int(bad[cutoff])
        if not n_good or binomial_at_most(rejected_good, n_good, risk) > error:
            break
        if rejected_bad and rejected_bad * n_good >= LIFT * rejected_good * n_bad:
            best = cutoff
    return best


def error_shares(n_good: dict[str, int], risk: float = RISK, error: float = ERROR) -> dict[str, float]:
    """The error each stratum may spend, by numbers of good labels alone: strata with fewer need more,
    so it is divided in inverse proportion. Strata that could prove nothing with their share get none."""
    able = sorted((s for s in n_good if n_good[s] > 0), key=lambda s: (-n_good[s], s))
    while able:
        total = sum(1 / n_good[s] for s in able)
        share = {s: error / n_good[s] / total for s in able}
        if (1 - risk) ** n_good[able[-1]] <= share[able[-1]]:
            return share
        able.pop()
    return {}


def most_rejected(n: int, risk: float, error: float) -> int:
    """The most good documents of ``n`` that may be rejected while the risk counts as proven; -1 if none may."""
    low, high = -1, n
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if binomial_at_most(middle, n, risk) <= error else (low, middle)
    return low


def lowest_cutoffs(bad: dict[str, np.ndarray], reference: dict[str, np.ndarray] | None, budget: float) -> list[tuple[str, int]]:
    """(rule, lowest cutoff to try) in the order of trying.

    With ``reference``, counts of other good documents by bin, a rule stops where it would reject over
    ``budget`` of those or lose its LIFT, and rules that reject more bad documents come first. Without
    it the rules come in order and go all the way.
    """
    found = []
    for rule in RULES:
        if reference is None:
            found.append((0, rule, 1))
            continue
        n_bad, n_reference = bad[rule].sum(), reference[rule].sum()
        caught, spoiled = np.cumsum(bad[rule][::-1])[::-1], np.cumsum(reference[rule][::-1])[::-1]
        fits = (caught > 0) & (caught * n_reference >= LIFT * spoiled * n_bad) & (spoiled <= budget * n_reference)
        fits[0] = False
        if fits.any():
            cut = int(np.argmax(fits))
            found.append((-int(caught[cut]), rule, cut))
    return [(rule, cut) for _, rule, cut in sorted(found, key=lambda x: x[0])]


def levels(path: list[tuple[str, int]]) -> list[tuple[str, int, int]]:
    """(rule, lowest cutoff, its level): levels fall along the path, by one for each step of a cutoff, down to 1."""
    out, level = [], 1
    for rule, cut in reversed(path):
        out.append((rule, cut, level))
        level += BINS + 1 - cut
    return out[::-1]


def proven(path: list[tuple[str, int]], good: np.ndarray, bad: np.ndarray, risk: float, error: float) -> dict[str, int]:
    """Cutoffs of rules whose joint false rejection is proven to be at most ``risk``.

    ``good`` and ``bad`` count documents by the highest level at which a rule rejects them, 0 if none
    does. Any rule may stay above what is proven, and does where it rejects no bad documents of its own.
    """
    end = strictest(good, bad, risk, error)
    out: dict[str, int] = {}
    for rule, cut, lowest in levels(path) if end is not None else ():
        rejected_good = rejected_bad = 0
        for level in range(lowest + BINS - cut, max(end, lowest) - 1, -1):
            rejected_good, rejected_bad = rejected_good + int(good[level]), rejected_bad + int(bad[level])
            if rejected_bad and rejected_bad * good.sum() >= LIFT * rejected_good * bad.sum():
                out[rule] = cut + level - lowest
    return out


def thresholds(rows: DataFrame, labels: DataFrame, stratum: Column | None = None, max_strata: int = 1000) -> dict[str, dict[str, int]]:
    """Cutoff bins by stratum and rule, learned from all rows that have a label (quality 0 or 1).

    A document labelled more than once counts once, as bad if any label says so; null labels
    and labels of unknown documents count nothing. Strata are few: more than ``max_strata`` raise.
    """
    stratum = length_band() if stratum is None else stratum
    quality = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("__quality"))
    known = materialize(
        rows.filter("NOT base_failed").join(quality, "doc_id").select(
            F.coalesce(stratum, F.lit("")).alias("stratum"),
            F.when(F.col("__quality") != 1, "bad").when(F.pmod(F.xxhash64("doc_id"), F.lit(PILOT)) == 0, "pilot").otherwise("good").alias("part"),
            *[_bin(r).alias(r) for r in RULES],
        ),
        "quality-known",
    )
    bins = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"`{r}`").alias("bin")) for r in RULES]))
    counts = (
        known.select("stratum", "part", bins.alias("b"))
        .groupBy("stratum", "part", "b.rule", "b.bin")
        .count()
        .limit(3 * max_strata * len(RULES) * (BINS + 1) + 1)
        .collect()
    )
    table: dict[str, dict[str, dict[str, np.ndarray]]] = {}
    for r in counts:
        parts = table.setdefault(r["stratum"], {p: {x: np.zeros(BINS + 1, int) for x in RULES} for p in ("good", "pilot", "bad")})
        parts[r["part"]][r["rule"]][r["bin"]] = r["count"]
    if len(table) > max_strata:
        raise ValueError(f"over {max_strata} strata")

    one = next(iter(RULES))
    every_good = {s: {x: parts["good"][x] + parts["pilot"][x] for x in RULES} for s, parts in table.items()}
    all_good = {x: sum((g[x] for g in every_good.values()), np.zeros(BINS + 1, int)) for x in RULES}
    piloted = {s for s, g in every_good.items() if g[one].sum() >= PILOT_FROM}
    n_good = {s: int((table[s]["good"] if s in piloted else every_good[s])[one].sum()) for s in table}
    paths: dict[str, list[tuple[str, int]]] = {}
    shares = error_shares(n_good)
    for s in sorted(shares):
        others = {x: all_good[x] - every_good[s][x] for x in RULES}
        reference = table[s]["pilot"] if s in piloted else others if others[one].any() else None
        budget = most_rejected(n_good[s], RISK, shares[s]) / n_good[s] / len(RULES)
        if table[s]["bad"][one].any() and (path := lowest_cutoffs(table[s]["bad"], reference, budget)):
            paths[s] = path
    if not paths:
        return {s: {} for s in sorted(table)}

    level = F.lit(None).cast("int")
    for s, path in paths.items():
        reached = [F.when(F.col(f"`{rule}`") >= cut, F.col(f"`{rule}`") - cut + lowest).otherwise(0) for rule, cut, lowest in levels(path)]
        level = F.when(F.col("stratum") == s, F.greatest(*reached, F.lit(0))).otherwise(level)
    tested = {s: {p: np.zeros(levels(path)[0][2] + BINS - path[0][1] + 1, int) for p in ("good", "bad")} for s, path in paths.items()}
    for r in known.select("stratum", "part", level.alias("level")).filter("level IS NOT NULL").groupBy("stratum", "part", "level").count().collect():
        if r["part"] != "pilot" or r["stratum"] not in piloted:
            tested[r["stratum"]]["bad" if r["part"] == "bad" else "good"][r["level"]] += r["count"]
    return {
        s: proven(paths[s], tested[s]["good"], tested[s]["bad"], RISK, shares[s]) if s in paths else {} for s in sorted(table)
    }


def judge(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The features of every row of ``documents`` (doc_id, text), base_failed, stratum, the rules it
    broke, and kept: not failed and no rule broken. Without labels no rule is proven, so none rejects."""
    rows = materialize(with_features(documents.select("doc_id", "text")).drop("text"), "quality-features")
    cutoffs = thresholds(rows, labels)
    broken = [
        F.when((F.col("stratum") == s) & (_bin(rule) >= cut), F.lit(rule)) for s, by_rule in cutoffs.items() for rule, cut in by_rule.items()
    ]
    rows = rows.withColumn("stratum", length_band())
    rows = rows.withColumn("broken", F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>"))
    return rows.withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))
