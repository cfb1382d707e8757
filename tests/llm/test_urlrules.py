"""URL rules: written ones against plain Python, mined ones against counted itemsets."""
import re
from itertools import combinations

from pulsehouse.llm import queries, urlrules

ODD = ["http://a.com", "https://A.Example.COM/en/x", "http://www.example.com/en/", "https://b.www.example.com/en/1?x=1",
       "http://x.net/es/", "x.net/es/", "", None, "://net/es/a", "http://net/fr/#/es/", "http://net?/fr/", "ftp://q.net/frx",
       "http://notexample.com/en/", "http://example.com.org/en/", "http://é.com/ñ?ü#z", "a://b://c.com/en/", "http://com/\nx",
       "HTTP://U:P@X.NET:80/fr/a", "http:///es/"]


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def said(host, path):
    fits = [(len(h + p), h + p, v) for h, p, v in urlrules.RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else None


def check(rows, urls):
    for r in rows:
        host, path = parts(urls[r.page_id])
        assert (r.host, r.path) == (host, path), urls[r.page_id]
        rule = said(host, path)
        assert r.rule == (rule and rule[0]) and r.verdict in ("allow", "block")
        if rule:
            assert r.verdict == rule[1]


def test_edge_rows(spark):
    urls = dict(enumerate(ODD))
    df = spark.createDataFrame([(i, u, "h", "clash", 1) for i, u in urls.items()],
                               "page_id long, url string, html string, host string, rule int")
    rows = urlrules.judge(df).collect()
    assert len(rows) == len(ODD)
    check(rows, urls)
    both = urlrules.judge(df.unionAll(df)).count()
    assert both == 2 * len(ODD)
    assert urlrules.judge(df.limit(0)).count() == 0
    null = spark.createDataFrame([(None, None), (None, "http://a.com/")], "page_id long, url string")
    assert urlrules.judge(null).count() == 2
    none = spark.createDataFrame([], "page_id long, label string")
    assert urlrules.judge(df, none).count() == len(ODD)


def test_mined_rules_and_matches(spark):
    urls = {}
    for i in range(120):
        bad = i % 3 == 0
        host = "casino.org" if bad else ("good.org" if i % 2 else "mixed.org")
        urls[i] = f"http://{host}/de/{'win/' if bad else ''}{i}" + ("?ad=1" if i % 5 == 0 else "")
    label = {i: "block" if i % 3 == 0 else "allow" for i in urls if i < 90}
    pages = spark.createDataFrame(list(urls.items()), "page_id long, url string")
    marks = spark.createDataFrame([*label.items(), (None, "block"), (5000, "allow"), (95, None)], "page_id long, label string")
    tokens = {r.page_id: r.tokens for r in pages.select("page_id", urlrules.tokens_of().alias("tokens")).collect()}
    some = [(frozenset(tokens[i]), label[i]) for i in label]
    least = 10 / len(some)
    counted = {}
    for items, of in some:
        for n in range(1, len(items) + 1):
            for c in combinations(sorted(items), n):
                counted.setdefault(c, []).append(of)
    rules = {}
    for c, got in counted.items():
        for of in ("allow", "block"):
            n = got.count(of)
            if n / len(some) >= least - 1e-12 and n / len(got) >= 0.5:
                rules[c, of] = n / len(got)
    kept = {k: v for k, v in rules.items()
            if not any(o == k[1] and set(c) < set(k[0]) and v <= s for (c, o), s in rules.items())}
    mined = urlrules.mine(pages.join(marks, "page_id").select(
        pages.page_id.alias("id"), urlrules.tokens_of().alias("tokens"), "label"))
    assert {(tuple(r.tokens), r.label): round(r.confidence, 9) for r in mined.collect()} == {
        k: round(v, 9) for k, v in kept.items()}
    verdict = {r.page_id: r.verdict for r in urlrules.judge(pages, marks).collect()}
    for i, u in urls.items():
        hits = [(v, of == "block") for (c, of), v in kept.items() if set(c) <= set(tokens[i])]
        assert verdict[i] == ("block" if hits and max(hits)[1] else "allow")
    assert verdict[99] == "block" and verdict[91] == "allow"


def test_all_labelled_urls_are_mined(spark):
    n = 24_000
    labelled = spark.range(n).selectExpr(
        "id", "if(id % 200 = 7, array('s:http', 'h:rare'), array('s:http', 'h:often')) as tokens",
        "if(id % 400 = 7 or id % 3 = 0, 'block', 'allow') as label")
    bad = {i for i in range(n) if i % 400 == 7 or i % 3 == 0}
    rare = {i for i in range(n) if i % 200 == 7}
    rules = {(tuple(r.tokens), r.label): r for r in urlrules.mine(labelled).collect()}
    hit = rules[("h:rare",), "block"]
    assert round(hit.support * n, 6) == len(rare & bad) and round(hit.confidence, 9) == round(len(rare & bad) / len(rare), 9)
    rest = rules[("s:http",), "allow"]
    assert round(rest.support * n, 6) == n - len(bad)
    part = {tuple(r.tokens): r for r in urlrules.mine(labelled, rows=1_000).collect()}
    assert round(part["s:http",].support * 1_000, 6) % 1 == 0


def test_whole_table(spark):
    d = "/root/testdata/sf0.01"
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{d}/pages.parquet").collect()}
    rows = queries.op9_url_rules(spark, d).collect()
    assert len(rows) == len(urls)
    check(rows, urls)
