import os
import random

from cyclograph import session
from cyclograph.llm import url_filter as uf

RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.partition("://")[2]
    ends = [i for i in (rest.find(c) for c in "/?#") if i >= 0]
    cut = min(ends, default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    path = rest[: min([i for i in (rest.find(c) for c in "?#") if i >= 0], default=len(rest))]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def brute(url, rules):
    host, path = parts(url)
    best = None
    for rule, verdict in rules:
        rule_host, _, rest = rule.partition("/")
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith("/" + rest):
            if best is None or (-len(rule), rule) < (-len(best[0]), best[0]):
                best = (rule, verdict)
    return (host, path, best and best[0], best[1] if best else "allow")


def urls():
    rng = random.Random(9)
    out = [None, "", "no scheme", "http://", "://net/", "a://b://net/x", "http://NET", "http://net/", "http://net?x=/", "HTTP://É.Net/#", "x\ny://a.net/"]
    for _ in range(400):
        host = ".".join(rng.choice(["www", "example", "Example", "net", "com", "org", "", "é"]) for _ in range(rng.randrange(1, 5)))
        path = "".join(rng.choice(["/", "en", "de", "fr", "/en/", "/de/", "?", "#", "x"]) for _ in range(rng.randrange(5)))
        out.append(f"{rng.choice(['http', 'https', ''])}://{host}{path}")
    return out + ["http://" + "a." * 20_000 + "net/" + "x" * 20_000]


def test_equals_brute_force(spark):
    rows = [(i, u, "mine") for i, u in enumerate(urls())]
    df = spark.createDataFrame(rows, "page_id bigint, url string, rule string")
    for rules in (RULES, [], [*RULES, ("example.net/e", "block"), ("www.example.net/en/", "block"), ("net/", "allow")]):
        merged = list({r: "block" if (r, "block") in rules else v for r, v in rules}.items())
        found = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in uf.judge(df, rules).collect()}
        assert found == {i: brute(u, merged) for i, u, _ in rows}
    assert uf.judge(df.limit(0), RULES).count() == 0


def test_collisions_are_confirmed(tmp_path):
    """With a key that collides all the time, the stored strings still decide."""
    key = lambda text: len(text) % 3
    path = tmp_path / "rules"
    path.write_bytes(uf.index_bytes(RULES, key))
    array = uf.DigestArray(str(path), key)
    known = [u for u in urls() if u is not None]
    hosts, paths = zip(*map(parts, known))
    hits = array.longest(list(hosts), list(paths))
    assert [h and tuple(h) for h in hits] == [brute(u, RULES)[2:] if brute(u, RULES)[2] else None for u in known]


def many_rules():
    rng = random.Random(4)
    hosts = ["net", "example.net", "www.example.com", "org", "é", "", "x.é.org"]
    paths = ["", "en", "en/", "de/fr/", "é/", "/", "x" * 300]
    rules = {rng.choice(hosts) + "/" + rng.choice(paths) + rng.choice(["", "x", "/en"]): rng.choice(["allow", "block"]) for _ in range(300)}
    rules.update({f"h{i}.example{i % 97}.com/{'p' * (i % 50)}": "block" for i in range(4_000)})
    return list(rules.items())


def test_many_rules_equal_brute_force(tmp_path):
    rules = many_rules()
    path = tmp_path / "rules"
    path.write_bytes(uf.index_bytes(rules))
    known = [u for u in urls() if u is not None]
    known += [f"https://www.h{i}.example{i % 97}.com/{'p' * (i % 60)}" for i in range(0, 8_000, 37)]
    hosts, paths = zip(*map(parts, known))
    hits = uf.DigestArray(str(path)).longest(list(hosts), list(paths))
    assert [(h.rule, h.verdict) if h else (None, "allow") for h in hits] == [brute(u, rules)[2:] for u in known]


def test_work_depends_on_the_hosts_not_on_the_number_of_rules(tmp_path, monkeypatch):
    path = tmp_path / "rules"
    path.write_bytes(uf.index_bytes(many_rules()))
    read, hashed = [], []
    rule = uf.DigestArray.rule
    monkeypatch.setattr(uf.DigestArray, "rule", lambda self, i: read.append(i) or rule(self, i))
    array = uf.DigestArray(str(path), lambda text: hashed.append(text) or uf._key(text))
    assert read == []
    assert array.longest(["www.example.edu"] * 1_000, ["/" + "p" * 100] * 1_000) == [None] * 1_000
    assert read == [] and len(hashed) <= len(array.labels)


def test_the_file_goes_with_the_work_folders(spark):
    df = spark.createDataFrame([(1, "http://a.net/")], "page_id bigint, url string")
    with session.work(spark):
        assert uf.judge(df, RULES).first()["verdict"] == "block"
        (folder,) = [f for f in session._FOLDERS if "url-rules" in f][-1:]
        local = folder.removeprefix("file:")
        assert os.path.isdir(local)
    assert not os.path.exists(local)
