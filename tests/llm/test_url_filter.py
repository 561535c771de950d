import random
import re

from geolake.llm.url_filter import judge_urls


def brute(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in re.match(r"[^/?#]*", rest).group())
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    fits = [(len(h + p), len(h), h + p, a) for a, h, p in rules
            if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
    if not fits:
        return host, path, None, default
    best = max(f[:2] for f in fits)
    actions = {f[3] for f in fits if f[:2] == best}
    return host, path, next(f[2] for f in fits if f[:2] == best), "block" if "block" in actions else "allow"


def run(spark, urls, rules, parts="4"):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        pages = spark.createDataFrame([(i, u, "x") for i, u in urls], "page_id long, url string, rule string")
        df = judge_urls(pages, spark.createDataFrame(rules, "action string, host string, path string"))
        return sorted(map(tuple, df.collect()), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"),
         ("block", "a.b.example.net", "/en/x/"), ("allow", "b.example.net", ""), ("block", "com", "/a/very/long/path/of/a/rule/"),
         ("block", "", "/"), ("allow", "dup.org", "/x"), ("block", "dup.org", "/x"), ("block", "b.example.net", "/en/"),
         ("block", "exa", "/")]


def test_against_brute_force(spark):
    rnd = random.Random(5)
    hosts = ["example.net", "a.b.example.net", "b.example.net", "EXAMPLE.com", "x.example.com", "org", "dup.org", "y.dup.org",
             "notexample.net", "net", "", "exa", "exa.", "é.org", "É.ORG", "a..net", "host.net:80", "z.com"]
    paths = ["", "/", "/en/", "/en/x/1", "/de/", "/fr/a?x=/de/", "?q", "#f", "/x#y", "/a/very/long/path/of/a/rule/1", "/EN/"]
    urls = [(i, rnd.choice(["http://", "https://", "", "ftp://"]) + rnd.choice(hosts) + rnd.choice(paths)) for i in range(1500)]
    urls += [(9000, None), (9001, ""), (9002, "://"), (None, "http://example.net/"), (9003, "http://x.net/" + "a/" * 40000),
             (9004, "http://a\n.net/x\ny"), (9005, "a://b://c.net/")]
    urls += [(5000 + i, "http://hot.example.net/en/1") for i in range(800)] + [(3, urls[3][1])]
    got = run(spark, urls, RULES)
    assert got == sorted(((i, *brute(u, RULES)) for i, u in urls), key=str)
    assert run(spark, urls, RULES, "13") == got


def test_empty_sides(spark):
    assert run(spark, [], RULES) == []
    assert run(spark, [(1, "http://x.net/")], []) == [(1, "x.net", "/", None, "allow")]
