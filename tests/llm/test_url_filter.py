import random

import numpy as np
import pytest

from faultline.llm import url_filter as uf
from faultline.llm.queries import URL_RULES


def _brute(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, tail = rest[:cut], rest[cut:]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    best = None
    for r in rules:
        fits = (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
        if fits and (best is None or len(r.rule) > len(best.rule)):
            best = r
    return host, path, best.rule if best else None, best.verdict if best else "allow"


def _urls():
    r = random.Random(5)
    hosts = ["example.com", "www.example.com", "WWW.Example.COM", "a.b.net", "net", "com", ".com", "example.org", "xexample.com", "", "a..com", "é.com", "com:80"]
    paths = ["", "/", "/en/", "/en", "/en/x?y=/es/", "/es/1#/en/", "/fr/", "?q=/", "#f", "/EN/", "//en/"]
    out = [r.choice(["http", "https", ""]) + "://" + h + p for h in hosts for p in paths]
    return out + [None, "", "no-scheme.com/en/", "http:/x.com/", "http://", "a://b://c.com/", "x" * 20_000 + "://com/"]


def test_verdicts_match_brute_force(spark):
    rows = [(i, u, "h", "k", "r") for i, u in enumerate(_urls())]
    rows += [(None, "http://a.com/", "", "", ""), (0, rows[0][1], "", "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, keys string, rule string")
    got = sorted((tuple(r) for r in uf.judge_urls(pages, URL_RULES).collect()), key=repr)
    assert got == sorted(((i, *_brute(u, URL_RULES)) for i, u, *_ in rows), key=repr)


def test_many_rules(spark):
    r = random.Random(9)
    rules = {}
    for _ in range(300):
        rules[f"{r.choice('abcdefgh')}{r.randrange(40)}.{r.choice(['com', 'net'])}/{r.choice(['', 'en/', 'x'])}"] = r.choice(["allow", "block"])
    rules = [uf.Rule(v, k) for k, v in rules.items()]
    urls = [f"http://{r.choice(['', 'w.', 'v.w.'])}{r.choice('abcdefghij')}{r.randrange(40)}.{r.choice(['com', 'net'])}/{r.choice(['', 'en/1', 'xy', 'z'])}" for _ in range(3000)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = sorted(tuple(x) for x in uf.judge_urls(pages, rules).collect())
    assert got == sorted((i, *_brute(u, rules)) for i, u in enumerate(urls))


def test_cascade_is_exact_over_its_universe(spark):
    keys = [f"key{i}" for i in range(3000)]
    universe = spark.createDataFrame([(k,) for k in keys], "key string")
    members = universe.filter("key like '%7'")
    levels = uf.build_cascade(members, universe)
    assert len(levels) >= 2  # level 0 passes some unlisted keys wrongly
    rows = uf._with_hashes(universe).collect()
    h1, h2 = (np.array([r[c] for r in rows], dtype=np.int64).view(np.uint64) for c in ("h1", "h2"))
    assert uf.listed(levels, h1, h2).tolist() == [r.key.endswith("7") for r in rows]


def test_empty_inputs_and_conflicting_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert uf.judge_urls(pages.limit(0), URL_RULES).count() == 0
    assert [tuple(r) for r in uf.judge_urls(pages, []).collect()] == [(1, "a.com", "/", None, "allow")]
    assert uf.build_cascade(pages.select("url").limit(0).toDF("key"), pages.select("url").toDF("key")) == []
    with pytest.raises(ValueError):
        uf.judge_urls(pages, [uf.Rule("allow", "com/"), uf.Rule("block", "com/")])
