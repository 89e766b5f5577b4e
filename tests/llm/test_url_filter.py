import random

import duckdb
from helpers import frame

from capset.llm.queries import ORACLES, URL_RULES
from capset.llm.url_filter import judge_urls

RULES = "host string, path string, verdict string"
PAGE = "page_id long, url string"


def fits(rule, host, path):
    h, p, _ = rule
    return (host == h or host.endswith("." + h)) and path.startswith(p)


def parse(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    return host, path[:min((path.index(c) for c in "?#" if c in path), default=len(path))]


def brute(pages, rules):
    out = []
    for i, url in pages:
        host, path = parse(url)
        best = max((r for r in rules if fits(r, host, path)), key=lambda r: (len(r[0] + r[1]), r[0] + r[1], r[2]), default=None)
        out.append((i, host, path, best and best[0] + best[1], best[2] if best else "allow"))
    return sorted(out, key=str)


def collected(spark, pages, rules):
    got = judge_urls(frame(spark, pages, PAGE), spark.createDataFrame(rules, RULES))
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    return sorted(map(tuple, got.collect()), key=str)


AWKWARD = [None, "", "://", "http://", "no url", "http://com", "http://COM/", "http://a.com/x?y#z", "http://xcom/", "http://net/es/",
           "https://WWW.Example.com/en/1?q", "http://www.example.com/en", "http://m.example.com/en/", "http://m.www.example.com/en/#a",
           "http://example.com?/en/", "a://b://c.com/", "http://ü.net/fr/ö", "http://.com/", "http://a..com/", "http://a.com./",
           "http://example.com/en/\nx", "http://a.net/fr/" + "y" * 50_000]


def test_contract_rules(spark):
    pages = [(i, u) for i, u in enumerate(AWKWARD * 3)] + [(None, "http://a.com/"), (5, "http://a.com/"), (2**60 + 1, "http://net/es/")]
    assert collected(spark, pages, URL_RULES) == brute(pages, URL_RULES)


def test_many_nested_rules_against_brute_force(spark):
    rng = random.Random(1)
    labels, paths = ["a", "b", "ab", "com"], ["", "/", "/x", "/x/", "/xy"]
    host = lambda: ".".join(rng.choice(labels) for _ in range(rng.randint(1, 4)))
    rules = [(host(), rng.choice(paths), rng.choice(["allow", "block"])) for _ in range(60)]
    # one host holds most pages
    pages = [(i, f"http://{host() if i % 3 else 'a.b.com'}{rng.choice(paths)}{rng.choice(['', '?q', '#f'])}") for i in range(900)]
    assert collected(spark, pages, rules + rules[:5]) == brute(pages, rules)


def test_empty_tables(spark):
    assert collected(spark, [], URL_RULES) == []
    assert collected(spark, [(1, "http://a.com/")], []) == [(1, "a.com", "/", None, "allow")]


def test_oracle_reads_urls_alike(spark):
    pages = [(i, u) for i, u in enumerate(AWKWARD)]
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", pages)
    assert sorted(con.execute(ORACLES["op6_url_filter"]).fetchall(), key=str) == brute(pages, URL_RULES)


def test_more_rules_than_a_batch_and_rules_only(spark):
    # batches of rules alone before, between and behind pages
    rules = [(f"h{i}.com", "/", "block") for i in range(6000)] + [("com", "/", "allow")]
    pages = [(i, f"http://x.h{i * 37}.com/") for i in range(160)]
    assert collected(spark, pages, rules) == brute(pages, rules)
    assert collected(spark, [], rules) == []
