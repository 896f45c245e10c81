import random
import re

import pytest

from foliomart.llm import urlrules
from foliomart.llm.urlrules import Rule, site_rule

URLS = [
    "http://example.com/en/1", "https://www.EXAMPLE.com/en/?q", "https://a.www.example.com/en/x#y", "http://example.com", "http://com/", "x",
    None, "", "http://xexample.com/en/", "http://a.net/es/1", "http://a.net/ES/1", "http://net/fr/", "ftp://user@a.net:80/fr/", "a://b://com/",
    "http://blog.cheap-pills.example.net/en/2", "http://cheap-pillsx.net/", "http://shop.org/cart", "http://shop.org/cartoon", "http:///com/",
    "http://ads.example.org/1", "http://x.org/\nlogin", "http://example.com/en", "http://.com/", "http://ünï.com/ä?é",
]


def plain(url):
    if url is None or "://" not in url:
        host, path = "", ""
    else:
        rest = url[url.index("://") + 3 :]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for r in urlrules.SITES:
        h, _, p = r.name.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(r.name) > len(best.name)):
            best = r
    if best:
        return host, path, best.name, best.verdict
    # a page rule fits if some place fits its pattern read letter by letter
    fits = (host or path) and any(re.search(urlrules.expression(r.pattern), host + path, re.DOTALL) for r in urlrules.PAGES)
    return host, path, None, "block" if fits else "allow"


def test_every_url(spark):
    rows = [(i if i % 5 else None, u, "k", 1, True) for i, u in enumerate(URLS * 2)]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, _length int, extra boolean")
    found = urlrules.judged(df).collect()
    assert sorted(((r["page_id"], r["url"], r["host"], r["path"], r["rule"], r["verdict"]) for r in found), key=repr) == sorted(
        ((i, u, *plain(u)) for i, u, *_ in rows), key=repr
    )
    verdicts = {r["url"]: r["verdict"] for r in found}
    assert verdicts["http://shop.org/cart"] == "block" and verdicts["http://shop.org/cartoon"] == "allow"
    assert verdicts["http://blog.cheap-pills.example.net/en/2"] == "block" and verdicts["http://ads.example.org/1"] == "block"


def test_index_finds_what_trying_all_rules_finds():
    rnd = random.Random(1)
    names = ["a", "bb", "shop", "news", "x1"]
    rules = [site_rule(".".join(rnd.choices(names, k=rnd.randint(1, 3))) + "/" + rnd.choice(["", "a/", "bb", "x1/shop"]), rnd.choice(["allow", "block"])) for _ in range(80)]
    rules += [Rule(p, "block", p, site=False) for p in ("^shop*news^", "*bb.a", "^x1^", "a-*")]
    index = urlrules.Index(rules, {"a": 100, "bb": 3})
    for _ in range(3000):
        text = ".".join(rnd.choices(names, k=rnd.randint(1, 4))) + "/" + "/".join(rnd.choices([*names, "a-b", ""], k=rnd.randint(0, 3)))
        fits = [r for r in rules if re.search(urlrules.expression(r.pattern), text)]
        best = max(((r.length, r.verdict == "block", r.name) for r in fits if r.site), default=None)
        assert index.judge(text) == (best, any(not r.site for r in fits))


def test_rules_are_filed_under_their_rarest_token():
    index = urlrules.Index([site_rule("example.com/en/", "block")], {"example": 5, "com": 9, "en": 2})
    assert list(index.by_token) == ["en"]
    assert urlrules.tokens_of("||example.com/eng") == ["example", "com"]
    assert urlrules.tokens_of("*cat^dog*") == []


@pytest.mark.parametrize("size", [1, 2, 5])
def test_slices_of_rules_change_nothing(spark, monkeypatch, size):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    whole = sorted(map(tuple, urlrules.judged(df).collect()), key=repr)
    monkeypatch.setattr(urlrules, "SLICE", size)
    assert sorted(map(tuple, urlrules.judged(df).collect()), key=repr) == whole


def test_no_rules_and_no_rows(spark):
    df = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert [tuple(r) for r in urlrules.judged(df, []).collect()] == [(1, "http://a.com/", "a.com", "/", None, "allow")]
    assert urlrules.judged(df.limit(0)).count() == 0
