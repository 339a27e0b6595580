import random

import pytest

from martcraft.llm import op6_urls as o


def brute(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = rest[:cut], rest[cut:]
        for c in "?#":
            path = path.split(c, 1)[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for h, p, v in rules:
        if host and (host == h or host.endswith("." + h) or h == "") and path.startswith(p):
            best = max(best or (len(h + p), h + p, v), (len(h + p), h + p, v))
    return host, path, best and best[1], best[2] if best else "allow"


def test_random_rules_match_brute_force(spark):
    rng = random.Random(4)
    name = lambda: ".".join(rng.choice(["a", "b", "net", "x-y"]) for _ in range(rng.randint(1, 4)))
    path = lambda: rng.choice(["", "/", "/en/", "/en/x", "/de"])
    rules = list({(h, p): (h, p, rng.choice(["allow", "block"])) for h, p in ((name(), path()) for _ in range(40))}.values())
    urls = [None, "", "nothing", "://", "http://", "http:///en/", "HTTP://A.NET/EN/", "http://a.net?q", "x://a.b#z/://", "http://a.net:80/en/"]
    urls += [f"http://{name()}{path()}{rng.choice(['', '?a=/en/', '#f'])}" for _ in range(600)]
    urls += ["http://a.net/en/hot"] * 400
    pages = spark.createDataFrame([(i, u, "h", "p", 1) for i, u in enumerate(urls)],
                                  "page_id long, url string, host string, path string, part int").repartition(5)
    got = {r.page_id: tuple(r)[1:] for r in o.judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()}
    assert got == {i: brute(u, rules) for i, u in enumerate(urls)}


@pytest.mark.parametrize("n_pages, n_rules", [(0, 0), (0, 2), (3, 0)])
def test_empty_tables(spark, n_pages, n_rules):
    pages = spark.createDataFrame([(i, "http://a.net/") for i in range(n_pages)], "page_id long, url string")
    rules = spark.createDataFrame([("net", "/", "block"), ("net", "/", "allow")][:n_rules], "host string, path string, verdict string")
    got = o.judge(pages, rules).collect()
    assert len(got) == n_pages and all(r.verdict == "allow" and r.rule is None for r in got)


def test_equal_rules_block_and_no_python_in_the_plan(spark):
    pages = spark.createDataFrame([(1, "http://a.net/"), (1, "http://a.net/")], "page_id long, url string")
    rules = spark.createDataFrame([("net", "/", "block"), ("net", "/", "allow")], "host string, path string, verdict string")
    df = o.judge(pages, rules)
    assert [r.verdict for r in df.collect()] == ["block", "block"]
    plan = df._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
