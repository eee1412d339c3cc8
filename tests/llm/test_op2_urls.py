import random
import re
from collections import Counter

import oracle
import pytest

from sparkmart.llm import queries, url_rules


def test_sql(spark, sf_dir):
    con, sql = oracle.connect(sf_dir), queries.ORACLES["op2_url_filters"]
    df = queries.op2_url_filters(spark, sf_dir)
    assert oracle.spark_rows(df) == oracle.sql_rows(con, sql)
    assert not oracle.types_differ(df, con, sql)


def brute(url, rules):
    host = path = ""
    if url and "://" in url:
        host, path = re.match(r"(?s)([^/?#]*)([^?#]*)", url[url.index("://") + 3 :]).groups()
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fit = [
        (len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return (host, path) + (max(fit)[2:] if fit else (None, "allow"))


@pytest.mark.parametrize("seed", [1, 2])
def test_nested_rules(spark, seed):
    rng = random.Random(seed)
    hosts = ["a", "org", "com", "x.org", "y.x.org", "z.y.x.org", "a.com", "b.a.com", "", ".", "a..b"]
    paths = ["", "/", "/a", "/a/", "/a/b", "/ab", "/b", "/é/ß"]
    rules = [(h, p, rng.choice(["allow", "block"])) for h in hosts for p in paths if rng.random() < 0.4]
    urls = [
        rng.choice(["http://", "x://", "", "://"]) + rng.choice([*hosts, "ORG", "c.A.com"]) + rng.choice(paths) + rng.choice(["", "?q", "#z/", "/x\ny"])
        for _ in range(200)
    ]
    pages = [(i, u) for i, u in enumerate(urls)] + [(None, None), (3, ""), (3, "")]
    got = url_rules.judge(
        spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, host string"),
        spark.createDataFrame(rules, "host string, path string, verdict string"),
    )
    assert Counter(tuple(r) for r in got.collect()) == Counter((i, *brute(u, rules)) for i, u in pages)


def test_no_rules_no_pages_and_conflicts(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string")
    rules = spark.createDataFrame([("org", "/", "allow"), ("org", "/", "block")], "host string, path string, verdict string")
    assert url_rules.judge(pages, rules).first()["verdict"] == "block"
    assert url_rules.judge(pages, rules.limit(0), "block").first()["verdict"] == "block"
    assert url_rules.judge(pages.limit(0), rules).count() == 0
