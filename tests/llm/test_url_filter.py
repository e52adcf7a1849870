from collections import Counter

from sievework.llm import url_filter
from sievework.llm.url_filter import RULES, claimed_twice, filter_urls

URLS = [None, "", "no scheme", "http://", "http://Example.ORG", "http://example.org/", "HTTP://EN.example.org/en/12?x#y", "http://example.org/es/a", "http://notexample.org/es/",
        "http://example.org/x", "https://a.com/fr/1", "https://a.com/de/1", "https://com/de/", "https://a.net/p?utm_source=f", "http://www.a.net:80/p/", "http://u@a.net/p#z",
        "http://b.net/q?b=2&a=1", "http://b.net/q?a=1&b=2&ref=3", "http://b.net/q?a=1", "x://y://z/?", "http://c.net/p\nq", "http://c.net/p\nq", "http://d.net/refx?reference=1"]
SCHEMA = "page_id long, url string, host string, path string, canonical string, bits string, block string, listed string, maybe string, says string"


def slow(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    path = rest[cut:].split("#")[0].split("?")[0]
    fits = [r for r in RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    rule = max(fits, key=lambda r: len(r[1] + r[2]), default=None)
    query = rest[cut:].split("#")[0].partition("?")[2]
    kept = sorted(p for p in query.split("&") if p and not p.startswith("utm_") and p.split("=")[0] not in ("ref", "fbclid", "gclid"))
    name = host.split("@", 1)[-1].removesuffix(":80").removesuffix(":443").removeprefix("www.")
    return host, path, rule, name + path.rstrip("/") + ("?" + "&".join(kept) if kept else "") if name else None


def frame(spark, urls):
    return spark.createDataFrame([(i, u, *["clash"] * 8) for i, u in enumerate(urls)], SCHEMA)


def test_equals_brute_force(spark):
    urls = URLS + [f"http://e.net/{i}" for i in range(300)] + ["http://e.net/7?utm_x=1", None]
    forms = [slow(u) for u in urls]
    times = Counter(f[3] for f in forms)
    df = frame(spark, urls)
    for size in (32 << 20, 32):  # a filter of one block passes nearly all
        got = {r["page_id"]: r for r in filter_urls(df, claimed_twice(df), filter_bytes=size).collect()}
        for i, (host, path, rule, canonical) in enumerate(forms):
            listed = canonical is not None and times[canonical] > 1
            want = (host, path, rule[1] + rule[2] if rule else None, rule[0] if rule else "block" if listed else "allow", listed)
            assert tuple(got[i])[1:] == want, urls[i]


def test_empty_list_and_table(spark):
    df = frame(spark, URLS)
    none = spark.createDataFrame([(None,)], "url string")
    assert filter_urls(df, none).filter("listed").count() == 0
    assert filter_urls(frame(spark, URLS).filter("false"), claimed_twice(df)).count() == 0


def test_main_path_has_no_python(spark, capsys):
    df = frame(spark, URLS)
    filter_urls(df, claimed_twice(df)).explain("formatted")
    assert not any(w in capsys.readouterr().out for w in ("Python", "Pandas", "Arrow"))
    assert not any(hasattr(url_filter, m) for m in ("pa", "pd", "np"))
