"""Levels of hosts, and who decides: host, domain or suffix; against a plain version."""

import math
from collections import defaultdict

import pytest

from fleetgauge.llm import url_reputation as ur

PAGES = "page_id long, url string"


def outcomes_of(spark, counts):
    """Rows of host and bad from (host, pages, bad pages)."""
    rows = [(h, i < bad) for h, n, bad in counts for i in range(n)]
    return spark.createDataFrame(rows, "host string, bad boolean")


#: Bad hosts on a good domain, a bad domain, a bad suffix, and many good ones.
COUNTS = (
    [("bad.shop.com", 200, 190), ("good.shop.com", 200, 4)]
    + [(f"h{i}.rotten.com", 50, 48) for i in range(5)]
    + [(f"w{i}.site{i}.xyz", 60, 55) for i in range(12)]
    + [(f"w{i}.site{i}.com", 60, 3) for i in range(40)]
    + [(f"w{i}.home{i}.co.uk", 60, 2) for i in range(20)]
    + [("one.com", 1, 1)]
)


def plain_verdicts(counts, hosts):
    """The same posterior means, level by level, in Python."""
    split = lambda h: (h, ".".join(h.split(".")[-3 if h.endswith("co.uk") else -2 :]), ".".join(h.split(".")[-2 if h.endswith("co.uk") else -1 :]))
    n, bad = defaultdict(int), defaultdict(int)
    parents = {}
    for h, k, b in counts:
        name, domain, suffix = split(h)
        parents |= {("h", name): ("d", domain), ("d", domain): ("s", suffix), ("s", suffix): "all"}
        for key in (("h", name), ("d", domain), ("s", suffix), "all"):
            n[key] += k
            bad[key] += b
    rate, weight = {"all": (bad["all"] + 1) / (n["all"] + 2)}, {}
    for level in "sdh":
        keys = [k for k in n if k != "all" and k[0] == level]
        p = {k: rate[parents[k]] for k in keys}
        many = [k for k in keys if n[k] > 1]
        beyond = sum(n[k] * (bad[k] / n[k] - p[k]) ** 2 - p[k] * (1 - p[k]) for k in many)
        within = sum((n[k] - 1) * p[k] * (1 - p[k]) for k in many)
        rho = beyond / within if within else 0
        strength = min(max(1 / rho - 1, ur.STRENGTHS[0]), ur.STRENGTHS[1]) if rho > 0 else ur.STRENGTHS[1]
        for k in keys:
            rate[k], weight[k] = (bad[k] + strength * p[k]) / (n[k] + strength), n[k] + strength
    limit = min(ur.EXCESS * rate["all"], (1 + rate["all"]) / 2)
    out = {}
    for h in hosts:
        name, domain, suffix = split(h)
        key = next((k for k in (("h", name), ("d", domain), ("s", suffix)) if k in weight), None)
        bound = rate[key] - ur.DEVIATIONS * math.sqrt(rate[key] * (1 - rate[key]) / (weight[key] + 1)) if key else 0
        out[h] = "block" if bound > limit else "allow"
    return out


def test_each_level_decides_and_equals_the_plain_version(spark):
    hosts = [h for h, *_ in COUNTS] + ["new.shop.com", "new.rotten.com", "a.unseen.xyz", "a.unseen.com", "a.unseen.co.uk", "a.b.dev"]
    pages = spark.createDataFrame([(i, f"https://{h}/p") for i, h in enumerate(hosts)], PAGES)
    got = {r.host: r.verdict for r in ur.judge_urls(pages, outcomes_of(spark, COUNTS)).collect()}
    assert got == plain_verdicts(COUNTS, hosts)
    assert got["bad.shop.com"] == got["new.rotten.com"] == got["a.unseen.xyz"] == "block"
    assert got["good.shop.com"] == got["a.unseen.com"] == got["a.unseen.co.uk"] == got["a.b.dev"] == "allow"


def test_nothing_is_blocked_where_hosts_differ_by_chance(spark):
    counts = [(f"h{i}.d{i % 7}.com", 20, 5 + i % 3 - 1) for i in range(40)]
    pages = spark.createDataFrame([(i, f"http://{h}/") for i, (h, *_) in enumerate(counts)], PAGES)
    assert {r.verdict for r in ur.judge_urls(pages, outcomes_of(spark, counts)).collect()} == {"allow"}


@pytest.mark.parametrize(
    "host, name, domain, suffix",
    [
        ("a.b.example.com", "a.b.example.com", "example.com", "com"),
        ("a.example.co.uk", "a.example.co.uk", "example.co.uk", "co.uk"),
        ("co.uk", "co.uk", "co.uk", "co.uk"),
        ("user@example.com:8080", "example.com", "example.com", "com"),
        ("example.com.", "example.com", "example.com", "com"),
        ("10.1.2.3:80", "10.1.2.3", "10.1.2.3", "address"),
        ("", "", "", ""),
    ],
)
def test_levels(spark, host, name, domain, suffix):
    row = ur._levels(spark.createDataFrame([(host,)], "host string")).first()
    assert (row["name"], row.domain, row.suffix) == (name, domain, suffix)


def test_empty_tables_repeats_and_other_columns(spark):
    none = spark.createDataFrame([], "host string, bad boolean")
    rows = [(1, None, "n", 1, "x"), (1, None, "n", 1, "x"), (2, "http://U@h.net:1/A?b", "n", 1, "x")]
    pages = spark.createDataFrame(rows, PAGES + ", name string, rate int, _method string")
    got = sorted(map(tuple, ur.judge_urls(pages, none).collect()))
    assert got == [(1, "", "", None, "allow")] * 2 + [(2, "u@h.net:1", "/A", None, "allow")]
    assert ur.judge_urls(pages.limit(0), none).count() == 0
