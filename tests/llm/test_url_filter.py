import random

import pytest
from stillwell.llm.url_filter import cascade, hashed, parted, url_filter

RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/")]


def judged(url, rules):
    host, path = parted(url)
    fits = []
    for verdict, rule in rules:
        h, slash, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith(slash + p):
            fits.append((len(rule), verdict == "block", rule, verdict))
    return (host, path, *(max(fits)[2:] if fits else (None, "allow")))


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "<p>", "x", True) for i, u in enumerate(urls)],
                                 "page_id long, url string, html string, rule string, block boolean")


URLS = [None, "", "no scheme", "://", "http://", "http://com", "http://com/", "HTTP://WWW.Example.COM/en/",
        "http://example.com/en", "http://example.com/en/x?y#z", "http://a.example.com/en/",
        "http://www.example.com/en/a", "http://b.www.example.com/en/", "http://xcom/", "x://a.net/es/",
        "x://a.net?/es/", "x://net#/es/", "x://a.net/fr/://b.com/", "x://É.Com/Ü", "x://a.com:80/",
        "x://user@a.net/fr/", "x://.net/es/", "x://a..com/", "x://long.com/" + "a/" * 20000]


def test_verdicts(spark):
    rng = random.Random(1)
    more = ["http://" + ".".join(rng.choices(["www", "example", "a", "com", "net"], k=rng.randint(1, 4)))
            + rng.choice(["", "/", "/en/", "/es/x", "/fr/", "?q", "/en"]) for _ in range(300)]
    urls = URLS + more
    made = {r["page_id"]: tuple(r)[1:] for r in url_filter(pages(spark, urls), RULES).collect()}
    assert made == {i: judged(u, RULES) for i, u in enumerate(urls)}


@pytest.mark.parametrize("rules", [[], [("block", "com/"), ("allow", "com/")], [("block", "com")]])
def test_other_rules(spark, rules):
    made = [tuple(r)[1:] for r in url_filter(pages(spark, URLS), rules).collect()]
    assert sorted(made, key=str) == sorted((judged(u, rules) for u in URLS), key=str)


def test_empty_table(spark):
    assert url_filter(pages(spark, []), RULES).collect() == []


def test_cascade_is_exact(spark):
    keys = hashed([f"key {i}" for i in range(6000)]).view("int64")
    rows = [(int(k), i % 7 == 0) for i, k in enumerate(keys)]
    made = cascade(spark.createDataFrame(rows, "hash long, listed boolean"), "listed")
    assert len(made.levels) > 1
    assert made.holds(keys.view("uint64")).tolist() == [b for _, b in rows]
