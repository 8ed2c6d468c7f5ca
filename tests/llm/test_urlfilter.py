import random

from blockfuse.llm import urlfilter as uf


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = rest[:cut], rest[cut:]
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    return low, path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]


def rule_of(host, path):
    fits = [r for r in uf.RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    return max(fits, key=lambda r: len(r[0] + r[1]), default=None)


def corpus():
    rnd = random.Random(3)
    rows = []
    for i in range(400):
        host = rnd.choice(["www.", "m.", "", "WWW."]) + rnd.choice(["example", "news", "a-b"]) + rnd.choice([".com", ".net", ".org", ".COM"])
        rows.append((i, f"http://{host}/{rnd.choice(['en', 'fr', 'es', 'de'])}/{rnd.randint(1, 99999)}{rnd.choice(['', '?a=1&b=2', '#x', '.html'])}"))
    odd = [None, "", "no scheme", "http://", "http://com/", "x://net/es/y", "http://example.com", "http://a.com?x=/en/", "HTTP://É.com/en/", "a://b://c.com/", "http://com/\n/x"]
    return rows + [(1000 + k, u) for k, u in enumerate(odd)] + [(5, rows[5][1])]


def test_rules_hosts_and_paths(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "1 as host", "'x' as label")
    out = uf.classify(df).collect()
    assert len(out) == len(rows)
    url = dict(rows)
    for r in out:
        host, path = parts(url[r.page_id])
        assert (r.host, r.path) == (host, path), url[r.page_id]
        rule = rule_of(host, path)
        assert r.rule == (rule[0] + rule[1] if rule else None)
        assert r.verdict == rule[2] if rule else r.verdict in ("allow", "block")


def test_trees_learn_given_labels(spark):
    rnd = random.Random(6)
    rows = [(i, f"http://{'x' * rnd.randint(3, 5)}.org/{'a/' * (1 + 6 * (i % 2))}{rnd.randint(0, 999)}") for i in range(600)]
    df = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(u, i % 2) for i, u in rows if i < 400], "url string, label int")
    out = {r.page_id: r.verdict for r in uf.classify(df, rules=(), labels=labels).collect()} if uf.RULES else {}
    right = sum((out[i] == "block") == (i % 2 == 1) for i, _ in rows if i >= 400)
    assert right / 200 > 0.95


def test_empty(spark):
    assert uf.classify(spark.createDataFrame([], "page_id long, url string")).count() == 0
