"""URL filters: explicit rules, and a tree of path templates for what no rule fits.

A url is cut into host and path; the longest rule whose host and path prefix fit decides. Urls that
rules judge are the labels of the method: per host, the segments of paths make a tree, as deep as the paths. At
each depth a node's segments stay as they are when they are frequent there and become a wildcard otherwise
(numbers always do). Branches whose share of bad labels is not told apart from their siblings' by a test of
proportions are merged into one. A template's impurity is smoothed towards that of the template above
it, and up to the host and all hosts. Of a url's templates the deepest one with enough labels decides: urls of a
mostly bad one are blocked, and urls whose own template has too few labels only where the one above is
bad nearly throughout.

Everything is joins and aggregates on counts of different paths, level by level; a level's counts and rows are
stored, so plans do not grow. Where a template has too few labels nothing below it can decide, and the tree ends.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import query, stored, table

# The rules of the query, as (verdict, rule).
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A segment stays literal with this many urls and this share of its node.
SUPPORT, SHARE = 5, 0.05
# Weight of the template above, in labels; the impurity that blocks, and that of a template above that does.
PRIOR, LIMIT, STRICT = 4.0, 0.5, 0.8
# Deviations that tell a branch from its siblings.
APART = 1.96
WILD = "*"


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host (ASCII letters in lower case) and path of a url column; both empty without ``://``."""
    column = F.col(url)
    rest = F.expr(f"substr(`{url}`, position('://', `{url}`) + 3)")
    present = F.coalesce(column.contains("://"), F.lit(False))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.when(present, host).otherwise(""), F.when(present, path).otherwise("")


def rule_column(rules: Sequence[tuple[str, str]]) -> Column:
    """The longest fitting rule as ``(verdict, rule)``, or nothing. Of rules of one text the first counts."""
    chain = None
    verdicts = {rule: verdict for verdict, rule in reversed(rules)}
    for rule, verdict in sorted(verdicts.items(), key=lambda item: (-len(item[0]), item[0])):
        host, slash, path = rule.partition("/")
        fits = (F.col("host") == host) | F.col("host").endswith(f".{host}")
        fits = fits & F.col("path").startswith(slash + path)
        found = F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))
        chain = F.when(fits, found) if chain is None else chain.when(fits, found)
    return F.lit(None).cast("struct<verdict:string,rule:string>") if chain is None else chain


def segments(path: str) -> Column:
    """A path's segments; numbers, also with an extension, are wild at once. An end in ``/`` is an empty one."""
    parts = F.split(F.regexp_replace(path, "^/", ""), "/", -1)
    return F.transform(parts, lambda part: F.when(part.rlike("^[0-9]+([.][a-z0-9]{1,5})?$|^[0-9a-f-]{16,}$"), WILD).otherwise(part))


def _branches(rows: DataFrame) -> DataFrame:
    """What becomes of each segment of each open node: ``node, here, goes, b, n``, the labels being those of the
    branch it goes to. ``rows`` has ``node, here, urls, labels, bad``."""
    own = rows.groupBy("node", "here").agg(F.sum("urls").alias("urls"), F.sum("labels").alias("labels"), F.sum("bad").alias("bad"))
    own = stored(own, "segments")
    whole = own.groupBy("node").agg(F.sum("urls").alias("all"), F.sum("labels").alias("wn"), F.sum("bad").alias("wb"))
    often = (F.col("urls") >= SUPPORT) & (F.col("urls") >= SHARE * F.col("all"))
    named = own.join(stored(whole, "nodes"), "node").withColumn("named", F.when(often | (F.col("here") == ""), F.col("here")).otherwise(WILD))
    named = stored(named, "named")
    groups = named.groupBy("node", "named").agg(F.sum("labels").alias("n"), F.sum("bad").alias("b"), F.first("wn").alias("wn"), F.first("wb").alias("wb"))
    rest_b, rest_n = F.col("wb") - F.col("b"), F.col("wn") - F.col("n")
    # Two proportions with one more good and bad each, so that few labels tell little apart.
    p, q = (F.col("b") + 1) / (F.col("n") + 2), (rest_b + 1) / (rest_n + 2)
    pooled = (F.col("wb") + 2) / (F.col("wn") + 4)
    z = F.abs(p - q) / F.sqrt(pooled * (1 - pooled) * (1 / (F.col("n") + 2) + 1 / (rest_n + 2)))
    # Of a branch without labels nothing says that it is like the others.
    stays = (z > APART) | (F.col("n") == 0) | (F.col("named") == "")
    merged = stored(groups.select("node", "named", F.when(stays, F.col("named")).otherwise(WILD).alias("goes"), "b", "n"), "merged")
    sums = stored(merged.groupBy("node", "goes").agg(F.sum("b").alias("b"), F.sum("n").alias("n")), "branches")
    goes = merged.select("node", "named", "goes").join(sums, ["node", "goes"])
    return stored(named.select("node", "here", "named").join(goes, ["node", "named"]).drop("named"), "goes")


def _smoothed(above: Column) -> Column:
    return (F.col("b") + PRIOR * above) / (F.col("n") + PRIOR)


def template_verdicts(labelled: DataFrame) -> DataFrame:
    """Templates of labelled urls. ``labelled`` has ``host, segments, bad`` (missing: no label). One row for each
    host and path of segments: ``host, segments, template, impurity, own, verdict``; ``own`` tells that the
    template itself has enough labels to decide."""
    counts = labelled.groupBy("host", "segments").agg(
        F.count(F.lit(1)).alias("urls"), F.count("bad").alias("labels"), F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("bad")
    )
    counts = stored(counts, "paths")
    total = counts.agg(((F.coalesce(F.sum("bad"), F.lit(0)) + 1) / (F.coalesce(F.sum("labels"), F.lit(0)) + 2))).first()[0]
    hosts = stored(counts.groupBy("host").agg(F.sum("bad").alias("b"), F.sum("labels").alias("n")), "hosts")
    everywhere = F.lit(total)
    rows = counts.join(hosts, "host").withColumn("impurity", _smoothed(everywhere))
    rows = rows.withColumns({"decides": F.when(F.col("n") >= SUPPORT, F.col("impurity")).otherwise(everywhere), "node": F.col("host"), "template": F.lit("")})
    rows = stored(rows.withColumn("own", F.col("n") >= SUPPORT).drop("b", "n"), "rows")
    done, depth = None, 0
    while True:
        going = F.col("own") & (F.size("segments") > depth)
        ended = rows.where(~going)
        done = ended if done is None else done.unionByName(ended)
        rows = rows.where(going).withColumn("here", F.get("segments", F.lit(depth)))
        if rows.isEmpty():
            break
        rows = rows.join(_branches(rows), ["node", "here"])
        rows = rows.withColumns(
            {
                "impurity": _smoothed(F.col("impurity")), "own": F.col("n") >= SUPPORT, "node": F.concat_ws("/", "node", "goes"),
                "template": F.concat_ws("/", "template", "goes"),
            }
        )
        rows = rows.withColumn("decides", F.when(F.col("own"), F.col("impurity")).otherwise(F.col("decides")))
        rows, depth = stored(rows.drop("here", "goes", "b", "n"), "rows"), depth + 1
    blocks = F.col("decides") > F.when(F.col("own"), LIMIT).otherwise(STRICT)
    template = F.when(F.col("template") == "", "/").otherwise(F.col("template"))
    return done.select("host", "segments", template.alias("template"), "impurity", "own", F.when(blocks, "block").otherwise("allow").alias("verdict"))


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict, template, impurity, own``.

    A missing url, or one without ``://``, has an empty host and path. Urls that no rule fits are judged by
    the deepest of their templates that has ``SUPPORT`` labels, whatever their depth; where not even the host has, by
    all hosts. Missing ids and repeated rows stay; an empty table gives an empty result; other columns
    are not read.
    """
    rows = pages.select(pages[f"`{id_column}`"].alias("page_id"), pages[f"`{url_column}`"].alias("url"))
    host, path = host_and_path("url")
    rows = rows.select("page_id", host.alias("host"), path.alias("path"))
    rows = rows.withColumns({"r": rule_column(rules), "segments": segments("path")})
    rows = stored(rows.select("page_id", "host", "path", "segments", "r.rule", F.col("r.verdict").alias("ruled")), "urls")
    bad = F.when(F.col("ruled") == "block", 1).when(F.col("ruled") == "allow", 0)
    verdicts = stored(template_verdicts(rows.select("host", "segments", bad.alias("bad"))), "templates")
    joined = rows.join(verdicts, ["host", "segments"])
    return joined.select("page_id", "host", "path", "rule", F.coalesce("ruled", "verdict").alias("verdict"), "template", "impurity", "own")


@query()
def op1_url_filter(spark, sf_dir):
    """Verdict of rules or path templates for the url of every page."""
    return judge_urls(table(spark, sf_dir, "pages"))
