import random
import re

from supplylake.llm.queries import RULES
from supplylake.llm.url_rules import Automaton, Rule, judge_urls


def brute(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        raw = re.match(r"[^/?#]*", rest).group()
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in raw)
        path = re.match(r"[^?#]*", rest[len(raw):]).group()
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.name), default=None)
    return host, path, best and best.name, best.action if best else default


def test_random_urls_against_brute_force(spark):
    rng = random.Random(2)
    hosts = ["com", "example.com", "www.example.com", "a.www.EXAMPLE.com", "net", "x.net", "netx", "notexample.com", "é.com", ""]
    paths = ["", "/", "/en", "/en/", "/en/x", "/es/1", "/fr/", "?q=/en/", "#/en/", "/a/.net/es/", "/com/", "/" + "p" * 300]
    urls = [f"{rng.choice(['http://', 'https://', '', '://'])}{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '?a=1', '#x'])}"
            for _ in range(600)] + [None, "", "://", "http://com\n/en/", "a://b://c.net/es/"]
    urls += urls[:50]
    pages = spark.createDataFrame([(i, u, "old", "old") for i, u in enumerate(urls)],
                                  "page_id long, url string, verdict string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(pages, RULES).collect()}
    for i, u in enumerate(urls):
        assert got[i] == brute(u, RULES), u


def test_many_rules_cross_word_borders(spark):
    rng = random.Random(3)
    rules = [Rule(rng.choice(["allow", "block"]), f"h{i}{'x' * rng.randint(0, 40)}.org", "/" + "d/" * rng.randint(0, 20)) for i in range(80)]
    urls = [f"http://{rng.choice(['', 's.'])}{r.host}{r.path}{rng.choice(['', 'end'])}" for r in rules]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(pages, rules).collect()}
    assert all(got[i] == brute(u, rules) for i, u in enumerate(urls))


def test_no_rules_and_no_rows(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert [tuple(r)[-2:] for r in judge_urls(pages, [], "block").collect()] == [(None, "block")]
    assert judge_urls(pages.limit(0), RULES).count() == 0


def test_star_does_not_cross_a_slash():
    hits = Automaton(["*.net/es/>", "a*c"]).matches([b"x.net/es/", b"evil.com/x.net/es/", b"abbc", b"a/c", b""])
    assert hits.tolist() == [[True, False], [False, False], [False, True], [False, False], [False, False]]
