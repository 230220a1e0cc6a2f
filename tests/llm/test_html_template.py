"""Template deduction against a plain version, and pages that lost text."""

import time
from collections import Counter, defaultdict

import pytest

from fleetgauge.llm import html_template as ht

PAGES = "page_id long, url string, html string"


def story(i: int, swap: bool = False) -> str:
    """A page without a named article: two parts vary, two are the same everywhere."""
    middle = [f"<div class='lead'><p>Told {i} times</p></div>", f"<div class='more'><p>And {i} again</p><p>Same line</p></div>"]
    if swap:
        middle.reverse()
    return "<html><body><div class='name'><p>Our paper</p></div>" + "".join(middle) + "<div class='legal'><p>All rights reserved by the site</p></div></body></html>"


def found(spark, rows):
    return {r.page_id: r.text for r in ht.extract(spark.createDataFrame(rows, PAGES)).collect()}


def test_slots_that_vary_are_kept_and_boilerplate_goes(spark):
    rows = [(i, f"http://a.example.org/{i}", story(i)) for i in range(8)]
    rows += [(100 + i, "http://b.example.org/", story(0)) for i in range(5)]  # copies are one page
    got = found(spark, rows + rows[:1])
    assert got[3] == "Told 3 times\nAnd 3 again"
    assert got[102] == "Our paper\nTold 0 times\nAnd 0 again\nSame line\nAll rights reserved by the site"
    assert len(got) == 13


def test_a_class_without_one_order_is_no_template(spark):
    """The two middle parts change places, so their class is dropped, and with it all of its texts."""
    rows = [(i, "http://a.example.org/", story(i, swap=i % 2 == 1)) for i in range(6)]
    assert "Same line" in found(spark, rows)[2]


@pytest.mark.parametrize("swap", [False, True])
def test_templates_match_plain_grouping(spark, swap):
    pages = [story(i, swap and i == 3) + ("<div><ul><li>x</li></ul></div>" * (i % 3)) for i in range(9)]
    counts, paths, spots = defaultdict(Counter), {}, []
    for i, page in enumerate(pages):
        tokens = ht.page_tokens(page)
        spots.append(tokens)
        for t in tokens:
            counts[t["token"]][i] = t["n"]
            paths[t["token"]] = t["path"]
    classes = defaultdict(list)
    for token, vector in counts.items():
        if len(vector) >= ht.LEAST_PAGES and 2 * len(vector) >= len(pages):
            classes[tuple(sorted(vector.items()))].append(token)
    names = {t: n for n, (_, ts) in enumerate(sorted(classes.items())) if len(ts) >= ht.LEAST_TOKENS for t in ts}
    facts = defaultdict(set)
    for tokens in spots:
        sequence = sorted((t["first"], t["last"], t["token"]) for t in tokens if t["token"] in names)
        span = {}
        for a, b, t in sequence:
            low, high = span.get(names[t], (a, b))
            span[names[t]] = (min(low, a), max(high, b))
        for c, (low, high) in span.items():
            order = tuple(t for *_, t in sequence if names[t] == c)
            outer = [(lo, o) for o, (lo, hi) in span.items() if o != c and lo < low and hi >= low]
            crosses = any(span[o][1] < high for _, o in outer) or any(
                len({sum(x < e for x, _, t in sequence if names[t] == o) for e, _, t in sequence if names[t] == c}) > 1
                for _, o in outer
            )
            around = max(outer, default=(0, None))[1]
            gap = sum(a < low for a, _, t in sequence if names[t] == around)
            facts[c].add((order, around, gap, crosses))
    valid = {c for c, seen in facts.items() if len(seen) == 1 and not any(x[3] for x in seen)}
    expected = {t for t, c in names.items() if c in valid and paths[t] is None}
    rows = [(i, "http://a.example.org/", p) for i, p in enumerate(pages)]
    df = ht.split_url(spark.createDataFrame(rows, PAGES)).selectExpr("*", "xxhash64(html) AS key")
    result = ht.templates(df).collect()
    assert {t for r in result for t in r.shared} == expected
    # The appended lists are a class of their own; the page's frame is one only without the swap.
    assert (ht.text_token("/html/body/div.legal", "All rights reserved by the site") in expected) != swap
    assert ht.text_token("/div/ul", "x") in expected


def test_names_that_hold_a_word_do_not_hide_the_article():
    text = lambda page: ht.main_text(page, None, None)
    assert text("<body class='has-sidebar'><div class='content no-comments'>A</div></body>") == "A"
    assert text("<article class='post social'>A</article>") == "A"
    assert text("<div class='related-work'>A</div>") == "A"
    assert text("<p>A<div class='cookie-banner'>B</div><div id='comments'>C</div><div class='site-footer'>D</div>") == "A"
    assert text("<article>A<article class='comment'>B</article></article>") == "A"


def test_unclosed_and_self_closed_elements_lose_nothing():
    text = lambda page: ht.main_text(page, None, None)
    assert text("<svg class='i'/><p>A</p>") == "A"
    assert text("<p><iframe src=x><p>A") == "A"
    assert text("<p>A <svg><text>no</text></svg> B</p><noscript>no</noscript>") == "A B"
    assert text("<p>1 < 2 &amp; a<b>c</b>") == "1 < 2 & ac"
    assert text("<a href='x>A</a><p>B</p>") == "A\nB"


@pytest.mark.parametrize("page", ["<a '" * 50_000, "<p>x</p><div>" * 20_000, "<!" * 100_000, "<p><b>" * 20_000, "<" * 200_000, "x " * 500_000])
def test_time_grows_with_the_length_alone(page):
    start = time.monotonic()
    ht.main_text(page, None, None)
    ht.page_tokens(page)
    assert time.monotonic() - start < 15


def test_nulls_empty_tables_and_other_columns(spark):
    assert found(spark, [(1, None, None), (2, "http://a/", ""), (None, "x", "<p>A")]) == {1: "", 2: "", None: "A"}
    assert found(spark, []) == {}
    clashing = spark.createDataFrame([(1, "http://a/", "<p>A", 3, "h", 4)], PAGES + ", host int, key string, salt int")
    row = ht.extract(clashing).first()
    assert (row.page_id, row.url, row.text, row.n_chars) == (1, "http://a/", "A", 1)
