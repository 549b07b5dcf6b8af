from compare import compare, duck
from logwarden.llm import url_rules as ur
from logwarden.llm.queries import URL_RULES, oracle_sql, queries


def brute(url, rules, default="allow"):
    url = url or ""
    host = path = ""
    if "://" in url:
        rest = url.split("://", 1)[1]
        end = min([i for c in "/?#" if (i := rest.find(c)) >= 0], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:]
        path = path[: min([i for c in "?#" if (i := path.find(c)) >= 0], default=len(path))]
    fits = [
        (len(h.split(".")) if h else 0, len(p), v == "block", h + p, v) for v, h, p in rules
        if (not h or host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=None)
    return host, path, best[3] if best else None, best[4] if best else default


URLS = [
    None, "", "example.org/es/", "http://EXAMPLE.org/es/1", "http://a.b.example.org/en/123?x#y", "x://org/", "x://org",
    "x://org.", "x://.org/", "x://notexample.org/es/", "x://é.COM/de/ü", "x://example.com/de", "x://example.com/fr/#a",
    "a://b://c.org/es/", "x://u:p@example.org:80/es/", "x://example.org//es/", "x://example.org/?/es/", "://example.org/es/",
    "x://" + "a." * 5000 + "com/de/" + "b/" * 5000, "x://example.net/a\nb",
]


def test_query_against_sql_and_brute_force(spark, sf_dir, table):
    df = queries()["op10_judge_urls"](spark, sf_dir)
    assert compare(df, duck(sf_dir), oracle_sql()["op10_judge_urls"]) is None
    want = sorted((i, *brute(u, URL_RULES)) for i, u in table("pages", "page_id, url"))
    assert sorted(map(tuple, df.collect())) == want


RULES = [*URL_RULES, ("allow", "example.org", "/es/1"), ("block", "", "/fr"), ("block", "b.example.org", ""),
         ("allow", "com", "/de/"), ("allow", "", ""), ("block", "Com", "/de/x/y")]


def test_trie_and_join_agree(spark):
    rows = [(i, u, "clash", "clash") for i, u in enumerate(URLS)] + [(3, URLS[3], "a", "b"), (None, URLS[4], "c", "d")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule string")
    table = spark.createDataFrame(RULES, "verdict string, host string, path string")
    want = sorted(((i, *brute(u, [(v, h.lower(), p) for v, h, p in RULES])) for i, u, *_ in rows), key=str)
    for got in (ur.judge_urls(pages, RULES), ur.judge_urls(pages, table), ur.judge_urls(pages, table, trie_rules=3)):
        assert sorted(map(tuple, got.collect()), key=str) == want
    assert ur.judge_urls(pages.limit(0), RULES).collect() == []
    assert {r.verdict for r in ur.judge_urls(pages, [], default="block").collect()} == {"block"}
