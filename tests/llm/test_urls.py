import random

from tessera.llm import urls


def place(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = rest[:end], rest[end:]
    stop = min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), tail[:stop]


def brute(url, rules):
    host, path = place(url)
    fits = [
        (len(h) + len(p), len(h), says == "block", h + p, says)
        for says, h, p in rules
        if h is not None and p is not None and (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)
    ]
    best = max(fits, default=None)
    return host, path, best[3] if best else None, best[4] if best else "allow"


RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
    ("block", "COM", "/de/"),
    ("block", "a.b.com", ""),
    ("allow", None, "/"),
    ("block", "net", None),
    ("allow", "tie.com", "/x"),
    ("block", "tie.com", "/x"),
]


def cases():
    rnd = random.Random(2)
    out = [None, "", "nothing", "http://", "http://ORG", "http://org/", "://org/x", "http://x.org?/es/", "http://a://b.org/", "http://tie.com/xyz", "http://" + "s." * 500 + "com/de/" + "p" * 20_000]
    for _ in range(300):
        host = ".".join(rnd.choice(["a", "b", "example", "Example", "tie", "com", "org", "net", ""]) for _ in range(rnd.randint(1, 4)))
        path = rnd.choice(["", "/", "/es/", "/en/1", "/en/12?x", "/fr/#f", "/de/1/2", "/x"])
        out.append(f"{rnd.choice(['http', 'https'])}://{host}{path}")
    return out + ["http://hot.example.org/es/1"] * 200


def test_matches_brute_force_by_broadcast_and_by_shuffle(spark):
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(cases())], "page_id long, url string, verdict string")
    rules = spark.createDataFrame(RULES, urls.RULE_SCHEMA)
    for bound in (100_000, 1):
        got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.filter_urls(pages, rules, max_broadcast_rules=bound).collect()}
        assert len(got) == len(cases())
        for i, u in enumerate(cases()):
            assert got[i] == brute(u, RULES), (bound, u)


def test_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://x.org/")], "page_id long, url string")
    none = spark.createDataFrame([], urls.RULE_SCHEMA)
    assert [(r["rule"], r["verdict"]) for r in urls.filter_urls(pages, none, default="block").collect()] == [(None, "block")]
    assert urls.filter_urls(pages.limit(0), spark.createDataFrame(RULES, urls.RULE_SCHEMA)).count() == 0
