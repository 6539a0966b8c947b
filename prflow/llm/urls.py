"""URL filters: rules first, then a tree of path templates per host.

The tree is built level by level. Below a host and the template of the path so
far, segments of one shape become a wildcard when they vary; sibling templates
whose labelled share of bad pages does not differ significantly are merged;
and a template is rejected when its smoothed share of bad labels is too high.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prflow.llm.common import written

LEVELS = 8  # the path behind the eighth segment counts as one segment
VARIES_FROM = 3  # different segments of one shape
VARIES_SHARE = 0.5  # different segments per page
SMOOTHING = 5.0  # labelled pages that the estimate above weighs
REJECT_FROM = 0.5
SIGNIFICANT = 1.96

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"^(?s).*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def rule_for(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """A struct (rule, verdict) of the longest fitting rule, or null.

    ``rules`` has (verdict, host, path). The list is configuration: it becomes
    one expression, longest rule first."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1:])):
        fits = (host == rule_host) | F.endswith(host, F.lit("." + rule_host))
        fits = fits & F.startswith(path, F.lit(rule_path))
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _segments(path: Column) -> Column:
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    deep = F.concat(
        F.slice(parts, 1, LEVELS - 1), F.array(F.array_join(F.slice(parts, LEVELS, F.greatest(F.size(parts), F.lit(1))), "/"))
    )
    return F.when(F.size(parts) > LEVELS, deep).otherwise(parts)


def _shape(segment: Column) -> Column:
    """Digits as #, letters as a; a file ending stays."""
    ending = F.regexp_extract(segment, r"(\.[A-Za-z]{1,5})$", 1)
    stem = F.regexp_replace(segment, r"\.[A-Za-z]{1,5}$", "")
    stem = F.regexp_replace(F.regexp_replace(stem, r"\p{L}+", "a"), r"\p{N}+", "#")
    return F.concat(stem, ending)


def templates(pages: DataFrame) -> DataFrame:
    """``pages`` (host, path, ...) with ``template`` and its ``parent``.

    Per level: pages are counted by (host, template so far, segment), then by
    shape. Counts are partial aggregates. The variable shapes are joined back;
    a host with a third of all pages is a hot key that the skew join splits.
    """
    now = pages.withColumn("segments", _segments(F.col("path")))
    now = written(now.withColumn("template", F.lit("")).withColumn("parent", F.lit(None).cast("string")), "level")
    depth = now.agg(F.max(F.size("segments"))).first()[0] or 0
    for level in range(depth):
        segment = F.get("segments", F.lit(level))
        here = now.withColumn("segment", segment).withColumn("shape", F.when(segment.isNotNull(), _shape(segment)))
        counted = here.filter("segment is not null").groupBy("host", "template", "shape", "segment").agg(F.count("*").alias("n"))
        shapes = counted.groupBy("host", "template", "shape").agg(F.sum("n").alias("n"), F.count("*").alias("different"))
        varied = shapes.filter(
            (F.col("different") >= VARIES_FROM) & (F.col("different") >= VARIES_SHARE * F.col("n"))
        ).select(F.col("host").alias("h"), F.col("template").alias("t"), F.col("shape").alias("s"), F.lit(True).alias("varies"))
        joined = here.join(
            varied, (F.col("host") == F.col("h")) & (F.col("template") == F.col("t")) & (F.col("shape") == F.col("s")), "left"
        )
        named = F.when(F.col("varies"), F.concat(F.lit("{"), "shape", F.lit("}"))).otherwise(F.col("segment"))
        grown = F.concat("template", F.lit("/"), named)
        now = written(
            joined.withColumn("parent", F.when(F.col("segment").isNotNull(), F.col("template")).otherwise(F.col("parent")))
            .withColumn("template", F.when(F.col("segment").isNotNull(), grown).otherwise(F.col("template")))
            .drop("segment", "shape", "h", "t", "s", "varies"),
            "level",
        )
    return now.drop("segments")


def _two(bad: Column, n: Column, prior: Column) -> Column:
    return (bad + SMOOTHING * prior) / (n + SMOOTHING)


def judged_templates(labelled: DataFrame) -> DataFrame:
    """``(host, template, merged, purity)``: purity is the smoothed share of
    good labels. The template leans on its host, the host on all pages."""
    leaf = labelled.groupBy("host", "parent", "template").agg(
        F.count("bad").alias("n"), F.sum(F.coalesce(F.col("bad").cast("long"), F.lit(0))).alias("bad")
    )
    leaf = written(leaf, "leaves")
    around = leaf.groupBy("host", "parent").agg(F.sum("n").alias("all_n"), F.sum("bad").alias("all_bad"))
    hosts = leaf.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("bad").alias("host_bad"))
    total = leaf.agg(F.sum("n"), F.sum("bad")).first()
    prior = (total[1] or 0) / total[0] if total[0] else 0.0
    near = leaf.alias("x").join(
        around.alias("y"), (F.col("x.host") == F.col("y.host")) & F.col("x.parent").eqNullSafe(F.col("y.parent"))
    ).select("x.*", "all_n", "all_bad")
    rest_n, rest_bad = F.col("all_n") - F.col("n"), F.col("all_bad") - F.col("bad")
    share = F.try_divide(F.col("bad"), F.col("n"))
    rest = F.try_divide(rest_bad, rest_n)
    pooled = F.try_divide(F.col("all_bad"), F.col("all_n"))
    error = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1.0), F.col("n")) + F.try_divide(F.lit(1.0), rest_n)))
    differs = F.coalesce(F.abs(share - rest) > SIGNIFICANT * error, F.lit(False))
    near = near.withColumn("differs", differs).withColumn(
        "merged", F.when(differs, F.col("template")).otherwise(F.concat(F.coalesce("parent", F.lit("")), F.lit("/*")))
    )
    merged = near.groupBy("host", "merged").agg(F.sum("n").alias("m_n"), F.sum("bad").alias("m_bad"))
    out = near.select("host", "template", "merged").join(merged, ["host", "merged"]).join(hosts, "host")
    host_share = _two(F.col("host_bad"), F.col("host_n"), F.lit(prior))
    return out.select("host", "template", "merged", (1 - _two(F.col("m_bad"), F.col("m_n"), host_share)).alias("purity"))


def judge_urls(
    pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str, str]], url: str = "url", page_id: str = "page_id"
) -> DataFrame:
    """``page_id, host, path, rule, verdict, template, purity`` for every row.

    ``labels`` (label_key, bad boolean) gives labels to pages by the key that
    ``pages`` carries in a column ``label_key``; several labels of a key count
    as bad if one is bad, null keys have none. A fitting rule decides (the
    longest); else the page is blocked if the purity of its merged template is
    REJECT_FROM or less. Without any label everything is allowed.

    Null urls and urls without ``://`` have empty host and path and share one
    template. Repeated rows are judged alike and returned each. Empty tables
    give an empty result. Other columns are not looked at.
    """
    base = pages.select(
        F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"),
        F.col("label_key").alias("label_key"),
    )
    one = labels.filter("label_key is not null").groupBy(F.col("label_key").alias("k")).agg(F.max("bad").alias("bad"))
    base = base.join(one, F.col("label_key") == F.col("k"), "left").select("page_id", "host", "path", "bad")
    tree = templates(base)
    judged = judged_templates(tree).select(
        F.col("host").alias("h"), F.col("template").alias("t"), "merged", "purity"
    )
    known = tree.join(judged, (F.col("host") == F.col("h")) & (F.col("template") == F.col("t")))
    rule = rule_for(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("purity") <= 1 - REJECT_FROM, "block").otherwise("allow")
    return known.withColumn("found", rule).select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce(F.col("found.verdict"), own).alias("verdict"), F.col("merged").alias("template"), "purity",
    )
