"""URL filters against brute force."""

import random
import re

from signalloom.llm import url_rules

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def judged(url, rules):
    m = re.search(r"\A.*?://([^/?#]*)([^?#]*)", url or "", re.S)
    host, path = (m[1].translate(UP), m[2]) if m else ("", "")
    fits = [(len(h) + len(p), len(h), v, h + p) for h, p, v in
            ((h.translate(UP), p, v) for h, p, v in rules if h and p is not None and v)
            if (host == h or host.endswith("." + h)) and path.startswith(p) and (p == "" or p[0] == "/")]
    best = max(fits, default=None)
    return host, path, best[3] if best else None, best[2] if best else "allow"


def test_brute_force(spark):
    rng = random.Random(2)
    names, parts = ["a", "b", "example", "org", "com", "Ä", ""], ["x", "en", "1", "12", ""]

    def host():
        return ".".join(rng.choice(names) for _ in range(rng.randrange(1, 5)))

    def path():
        return "".join("/" + rng.choice(parts) for _ in range(rng.randrange(4)))

    rules = [(host(), path(), rng.choice(["allow", "block"])) for _ in range(40)]
    rules += [rules[0], rules[1][:2] + ("block",), rules[1][:2] + ("allow",), ("ORG", "/en/1", "block"), ("org", "x", "block"),
              (None, "/", "block"), ("com", None, "block"), ("a", "/", None), ("", "/", "block"), ("é.org", "/ü", "block")]
    urls = [f"{rng.choice(['http', 'HTTPS', 'ftp'])}://{host()}{path()}{rng.choice(['', '?q=/x', '#a/b', '/?#'])}"
            for _ in range(500)]
    urls += [None, "", "no scheme/x", "://", ":///en/1", "http://org", "http://ORG/en/12\n?x", "x\ny://www.org/en/1",
             "http://a://b/en", "http://org:80/en/1", "http://user@org/en/1", "http://É.org/ü/", "http://é.org/üx",
             "http://org." + "/x" * 50_000, "http://" + "a." * 20_000 + "org/en/1", "http://org/en/1", "http://org/en/1"]
    frame = spark.createDataFrame([(k if k % 9 else None, u, "h", "r", "v", "s", "d") for k, u in enumerate(urls)],
                                  "page_id long, url string, host string, rule string, _host string, short string, digest string")
    table = spark.createDataFrame(rules, url_rules.RULE_SCHEMA)
    got = url_rules.judge(frame, table)
    assert {"page_id", "url", "_host", "short", "digest"} < set(got.columns)
    rows = [tuple(r) for r in got.select("page_id", "url", "host", "path", "rule", "verdict").collect()]
    want = [(k if k % 9 else None, u, *judged(u, [r if r[0] is not None else ("", *r[1:]) for r in rules]))
            for k, u in enumerate(urls)]
    assert sorted(map(repr, rows)) == sorted(map(repr, want))
    assert sum(r[4] is not None for r in rows) > 100
    none = url_rules.judge(frame, table.limit(0), default="block").select("rule", "verdict").distinct().collect()
    assert [tuple(r) for r in none] == [(None, "block")]
    assert url_rules.judge(frame.limit(0), table).collect() == []
