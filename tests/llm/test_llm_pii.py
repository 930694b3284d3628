import hashlib
import re

from fixtures_llm import ODD_TEXTS, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cyclograph.llm import pii

PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def base(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), kind, m.end()))
    return sorted(out, key=lambda s: (s[0], list(PLAIN).index(s[1])))


PARTS = ["a", "b.c", "@", ".", "-", "_", "é", " ", "+", "1", "25", "256", "4111 1111-1111 1111", "+49 (30) 123-456", "(", "192.168.0.1", "\n", "x@y.z"]


@settings(max_examples=1000, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=25).map("".join))
def test_base_spans_equal_the_plain_patterns(text):
    found = [(s.start, s.kind, s.end) for s in pii.find_spans(text) if s.kind in pii.BASE_KINDS]
    assert found == base(text)


def test_checksums():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("DE89370400440532013000") and not pii.mod97("DE89370400440532013001")


def test_context_decides_unchecked_kinds():
    kinds = lambda text: [s.kind for s in pii.find_spans(text)]
    assert kinds("number 078-05-1120") == [] and kinds("SSN: 078-05-1120") == ["ssn"]
    assert "iban" in kinds("DE89 3704 0044 0532 0130 00") and "iban" not in kinds("DE89 3704 0044 0532 0130 01")
    near, far = pii.find_spans("call +49 30 1234567")[0], pii.find_spans("see +49 30 1234567")[0]
    assert near.score > far.score


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1.1." * 50_000, "+1" + "." * 200_000, "a@" * 100_000, "9" * 5000 + ".1.1.1"):
        pii.find_spans(text)


def test_digest(spark):
    texts = [*ODD_TEXTS, "mail é@b.cd x@y.zz", "card 4111 1111 1111 1111 ip 10.0.0.1"]
    docs = documents(spark, texts).withColumn("pii", F.lit(1)).unionAll(documents(spark, ["x@y.zz"], 99).withColumn("pii", F.lit(1)))
    rows = {r["doc_id"]: r for r in pii.digest(pii.with_spans(docs)).collect()}
    assert len(rows) == len(texts) + 1
    for i, text in enumerate(texts):
        spans = base(text or "")
        told = ",".join(f"{k}:{a}:{b}" for a, k, b in spans)
        assert rows[i]["base_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        assert [rows[i][f"n_{k}"] for k in PLAIN] == [sum(s[1] == k for s in spans) for k in PLAIN]
    assert pii.digest(pii.with_spans(docs.limit(0))).count() == 0
