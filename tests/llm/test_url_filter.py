import random
import re

import pyarrow as pa

from chatterscope.llm.arrow_text import text_bytes
from chatterscope.llm.url_filter import RULES, ShiftAnd, judge


def test_automaton_equals_regular_expressions():
    rng = random.Random(2)
    globs = ["*", "a"][1:] + ["".join(rng.choices("ab.*", k=rng.randrange(1, 30))) for _ in range(60)]
    globs = [g for g in globs if g.strip("*")] + ["é*", "a" * 100 + "*b"]
    texts = ["".join(rng.choices("ab.", k=rng.randrange(12))) for _ in range(300)] + ["", "éb", "a" * 150 + "b"]
    got = ShiftAnd(globs).matches(*text_bytes(pa.array(texts)))
    for k, g in enumerate(globs):
        pattern = re.compile(".*".join(map(re.escape, re.sub(r"\*+", "*", g).split("*"))), re.S)
        assert got[:, k].tolist() == [pattern.fullmatch(t) is not None for t in texts], g


def brute(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.name), default=None)
    return host, path, best and best.name, best and best.verdict


def test_rules_equal_brute_force(spark):
    urls = [
        "https://Example.ORG/es/1", "http://a.example.org/en/17", "http://example.org/en/2", "http://notexample.org/es/1", "http://x.com/fr/", "http://x.com/de/1?q=/fr/",
        "http://org/", "http://org", "org/", None, "", "ftp://a.com#/de/", "http://u:p@x.org:80/es/", "://y.net/de/", "http://example.com/DE/", "a://b://c.org/", "http://x.net/a.exe",
        "http://ads.x.net/", "http://x.net/" + "p" * 5000, "http://a.com/fr/\n.exe", "http://x.net/a.org/b", "http://x.net/.example.org/es/",
    ]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("*", "'x' host", "'y' rule")
    rows = {r.page_id: r for r in judge(pages.repartition(2)).collect()}
    for k, url in enumerate(urls):
        host, path, rule, verdict = brute(url)
        assert (rows[k].host, rows[k].path, rows[k].rule) == (host, path, rule)
        if verdict:
            assert rows[k].verdict == verdict
    assert (rows[16].verdict, rows[17].verdict, rows[18].verdict, rows[9].verdict) == ("block", "block", "allow", "allow")
    assert judge(pages.where("false")).collect() == []
    assert judge(pages, rules=[], blocked=[]).where("verdict = 'block'").count() == 0
