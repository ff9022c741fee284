import random
import re

import numpy as np
from llm_helpers import importable, ordered
from pyspark.sql import functions as F

from weekwise.llm.bloom import BlockedBloom
from weekwise.llm.queries import URL_RULES
from weekwise.llm.url_filter import _key_hash, judge, listed_entries

RULES = "host string, path string, verdict string"


def brute(rows, rules, otherwise="allow"):
    out = []
    for page, url in rows:
        rest = url[url.index("://") + 3:] if url and "://" in url else ""
        raw = re.match("[^/?#]*", rest)[0]
        path = re.match("[^?#]*", rest[len(raw):])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), raw)
        fits = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules if h is not None and p is not None
                and ("." + host).endswith("." + re.sub("[A-Z]", lambda m: m[0].lower(), h)) and path.startswith(p)]
        best = max(fits, default=None)
        out.append((page, host, path, best and best[2].lower() if best else None, best[3] if best else otherwise))
    return ordered(out)


def urls():
    r = random.Random(1)
    out = [None, "", "no scheme.com/en/", "http://", "https://Example.COM/en/x", "http://www.example.com/en/?q=/es/",
           "http://a.www.example.com/EN/", "ftp://user@b.net:80/es/", "x://b.net/es/#f", "x://net/fr/a\nb", "x://net",
           "x://notexample.com/en/1", "x://.com/", "x://com./", "x://example.com?/en/", "a://b://c.com/en/", "x://ü.net/fr/é"]
    for _ in range(300):
        host = ".".join(r.choice(["www", "example", "m", "com", "net", "org"]) for _ in range(r.randint(1, 4)))
        out.append(f"http{r.choice(['', 's'])}://{host}{r.choice(['/en/', '/es/', '/fr/', '/', '', '/e'])}"
                   f"{r.choice(['', '1', '?a=b', '#/en/'])}")
    out += ["http://hot.com/" + "a" * 30_000, "http://" + "a." * 3000 + "com/en/"] + ["http://hot.com/x"] * 200
    return [(k if k % 9 else None, u) for k, u in enumerate(out)] + [(5, "http://hot.com/x")] * 2


def result(spark, rows, rules, **options):
    df = importable(spark).createDataFrame(rows, "page_id long, url string").select(
        "*", *[F.lit("x").alias(c) for c in ("id", "host", "path", "hits", "hashes", "verdict", "rule", "l_host")])
    return ordered(judge(df, spark.createDataFrame(rules, RULES), **options).collect())


def test_equals_brute_force(spark):
    assert result(spark, urls(), URL_RULES) == brute(urls(), URL_RULES)


def test_a_full_filter_changes_nothing(spark):
    """Many entries in one block: nearly everything passes the filter, and the join decides."""
    r = random.Random(3)
    rules = URL_RULES + [(f"h{k}.{r.choice(['com', 'org'])}", f"/{k}/", "block") for k in range(400)]
    rules += [("www.org", "", "block"), ("m.org", "/e", "allow"), ("com", "/", "allow"), ("Com", "/", "block"),
              (None, "/", "block"), ("org", None, "block")]
    expected = brute(urls(), [x for x in rules if x[:2] != ("com", "/")], "block")
    assert result(spark, urls(), rules, otherwise="block", filter_bytes=32) == expected
    assert result(spark, urls(), rules, otherwise="block") == expected


def test_empty(spark):
    assert result(spark, [], URL_RULES) == []
    assert result(spark, [(1, "http://a.com/")], []) == [(1, "a.com", "/", None, "allow")]


def test_filter_holds_all_entries_and_few_others(spark):
    listed = listed_entries(spark.range(5000).select(
        F.concat(F.lit("h"), "id", F.lit(".org")).alias("host"), F.lit("/").alias("path"), F.lit("block").alias("verdict")))
    keys = listed.select(_key_hash(F.col("l_host"), F.col("l_path")).alias("h"))
    held = BlockedBloom.build(keys)

    def hashes(df):
        return np.array([r[0] for r in df.collect()], dtype=np.int64)
    assert held.may_hold(hashes(keys)).all()
    others = hashes(spark.range(20_000).select(_key_hash(F.concat(F.lit("o"), "id"), F.lit("/"))))
    assert held.may_hold(others).mean() < 0.02
