"""The tree of path templates against a plain version, on the sample urls and on made trees."""

import random
import re
from collections import Counter, defaultdict
from math import sqrt

import pytest

from tests.helpers import plan
from tests.llm.conftest import SF
from tests.llm.test_more import plain_url
from tidemark.llm.url_filter import APART, LIMIT, PRIOR, SHARE, STRICT, SUPPORT, judge_urls


def plain_tree(urls):
    """Verdicts of the urls that no rule fits, and of how many the method had labels of their own."""
    rows = []
    for url in urls:
        host, path, _, ruled = plain_url(url)
        parts = re.sub("^/", "", path).split("/")
        rows.append((host, ["*" if re.search("^[0-9]+([.][a-z0-9]{1,5})?$|^[0-9a-f-]{16,}$", part) else part for part in parts], ruled))
    marks = [{"block": 1, "allow": 0}.get(ruled) for _, _, ruled in rows]

    def sums(chosen):
        known = [marks[k] for k in chosen if marks[k] is not None]
        return sum(known), len(known)

    b, n = sums(range(len(rows)))
    everywhere, result = (b + 1) / (n + 2), [None] * len(rows)

    def grow(chosen, depth, above, decides):
        b, n = sums(chosen)
        impurity, own = (b + PRIOR * above) / (n + PRIOR), n >= SUPPORT
        decides = impurity if own else decides
        going = [k for k in chosen if own and len(rows[k][1]) > depth]
        for k in set(chosen) - set(going):
            result[k] = "block" if decides > (LIMIT if own else STRICT) else "allow"
        branches = defaultdict(list)
        often = Counter(rows[k][1][depth] for k in going)
        for k in going:
            here = rows[k][1][depth]
            branches[here if here == "" or (often[here] >= SUPPORT and often[here] >= SHARE * len(going)) else "*"].append(k)
        wb, wn = sums(going)
        merged = defaultdict(list)
        for name, members in branches.items():
            b, n = sums(members)
            p, q, pooled = (b + 1) / (n + 2), (wb - b + 1) / (wn - n + 2), (wb + 2) / (wn + 4)
            z = abs(p - q) / sqrt(pooled * (1 - pooled) * (1 / (n + 2) + 1 / (wn - n + 2)))
            merged[name if z > APART or n == 0 or name == "" else "*"] += members
        for members in merged.values():
            grow(members, depth + 1, impurity, decides)

    hosts = defaultdict(list)
    for k, (host, _, _) in enumerate(rows):
        hosts[host].append(k)
    for members in hosts.values():
        grow(members, 0, everywhere, everywhere)
    return [ruled or found for (_, _, ruled), found in zip(rows, result)]


def same(spark, urls):
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r for r in judge_urls(frame).collect()}
    assert [got[k].verdict for k in range(len(urls))] == plain_tree(urls)
    return got


def test_sample_urls(spark):
    same(spark, [r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()])


@pytest.mark.parametrize("seed", [1, 2])
def test_made_trees(spark, seed):
    rng = random.Random(seed)
    hosts = ["a.example.com", "b.example.net", "c.test.org", "none.test"]
    urls = []
    for _ in range(1200):
        parts = [rng.choice(["de", "en", "fr"]), *(rng.choice(["x", "y", str(rng.randint(1, 99)), f"s{rng.randint(1, 60)}"]) for _ in range(rng.randint(0, 5)))]
        urls.append(f"http://{rng.choice(hosts)}/" + "/".join(parts) + rng.choice(["", "/", "?q"]))
    verdicts = [r for r in same(spark, [*urls, None, "x"]).values() if r.rule is None]
    assert {r.verdict for r in verdicts} == {"block", "allow"} and any(r.own for r in verdicts)


def test_what_differs_at_the_sixth_segment_is_told_apart(spark):
    from tidemark.llm.url_filter import RULES

    rules = [("block", "shop.test/a/b/c/d/e/bad/1"), ("allow", "shop.test/a/b/c/d/e/good/1")]
    urls = [f"http://shop.test/a/b/c/d/e/{kind}/{n}{k}" for kind in ("bad", "good") for n in (1, 2) for k in range(10, 40)]
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = judge_urls(frame, rules).collect()
    assert len(RULES) == 4 and {(r.path.split("/")[6], r.rule is None, r.verdict) for r in got} == {
        ("bad", False, "block"), ("bad", True, "block"), ("good", False, "allow"), ("good", True, "allow"),
    }


def test_the_plan_does_not_double(spark):
    frame = spark.read.parquet(f"{SF}/pages.parquet")
    text = plan(judge_urls(frame))
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", text) and text.count("Exchange") <= 4
