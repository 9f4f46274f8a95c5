"""URL filter: explicit rules, then a tree of path templates per host.

A rule names a host (with its subdomains) and the start of a path; of the rules
that fit a URL the longest decides.  The URLs that rules decide are the
labelled examples of the method, which judges all others:

1. paths are counted per host with runs of digits and long hexadecimal ids
   already generalised, so a hot host is a few rows before anything is joined;
2. level by level a segment becomes the wildcard ``*`` where its labelled block
   rate does not differ from that of all its siblings (two-proportion test), or
   where it is one of many rare siblings and has too few labels to tell: such
   branches merge;
3. a template's block rate is smoothed towards its host's, and that towards
   the rate of all labelled URLs; templates at or above ``REJECT`` are blocked.

Defined cases: a null URL, or one without ``://``, has an empty host and path,
no rule, and the verdict of the empty template; segments beyond ``DEPTH`` count
as one; repeated rows are judged each and weigh in the counts; an empty table
gives an empty result.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerocorr.llm.common import written

# fixed values: (verdict, host, start of the path)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
DEPTH = 8
MANY = 8  # siblings from which rare segments are variable
RARE = 0.2  # share of the siblings' URLs below which a segment is rare
Z = 2.0  # merge branches whose block rates differ by less standard errors
FEW = 20  # URLs below which a segment is rare in itself
TELLING = 5  # labelled URLs from which a segment's own rate counts
WEIGHT = 5.0  # of the rate smoothed towards, in labelled URLs
REJECT = 0.6


def parsed(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lowered, and path; both empty without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, pattern, 1), string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, pattern, 2), F.lit(""))


def longest_rule(host: Column, path: Column, rules=RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, or null."""
    fit = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        fit = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(fit)
    return fit


def shaped(path: Column) -> Column:
    """Segments with ids generalised: long hexadecimal runs and digits."""
    plain = F.regexp_replace(F.regexp_replace(path, r"[0-9a-fA-F]{8,}(-[0-9a-fA-F]{4,})*", "#"), "[0-9]+", "#")
    parts = F.filter(F.split(plain, "/"), lambda s: s != "")
    return F.when(F.size(parts) <= DEPTH, parts).otherwise(
        F.concat(F.slice(parts, 1, DEPTH - 1),
                 F.array(F.array_join(F.slice(parts, DEPTH, F.size(parts)), "/"))))


def templates(spark: SparkSession, counted: DataFrame) -> DataFrame:
    """host, segments -> template, from (host, segments, n, labelled, bad)."""
    depth = counted.agg(F.max(F.size("segments"))).first()[0] or 0
    state = counted.withColumn("template", F.lit(""))
    for d in range(depth):
        here = state.withColumn("seg", F.get("segments", F.lit(d)))
        sums = [F.sum(c).alias(c) for c in ("n", "labelled", "bad")]
        kids = here.where("seg is not null").groupBy("host", "template", "seg").agg(*sums)
        node = kids.groupBy("host", "template").agg(
            F.count(F.lit(1)).alias("kids"), *[F.sum(c).alias(f"all_{c}") for c in ("n", "labelled", "bad")])
        rate = (F.col("bad") + 1) / (F.col("labelled") + 2)
        pool = (F.col("all_bad") + 1) / (F.col("all_labelled") + 2)
        error = F.sqrt(pool * (1 - pool) * (1 / (F.col("labelled") + 2) + 1 / (F.col("all_labelled") + 2)))
        variable = ((F.col("kids") >= MANY) & (F.col("n") < RARE * F.col("all_n"))
                    & (F.col("n") < FEW) & (F.col("labelled") < TELLING))
        alike = (F.col("kids") > 1) & (F.abs(rate - pool) <= Z * error)
        step = kids.join(node, ["host", "template"]).select(
            "host", "template", "seg",
            F.when(variable | alike, F.lit("*")).otherwise(F.col("seg")).alias("to"))
        state = written(spark, here.join(step, ["host", "template", "seg"], "left").select(
            "host", "segments", "n", "labelled", "bad",
            F.when(F.col("to").isNull(), F.col("template"))
            .otherwise(F.concat("template", F.lit("/"), "to")).alias("template")), "templates")
    return state


def judge_urls(spark: SparkSession, pages: DataFrame, rules=RULES) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict,
    template, block_rate."""
    host, path = parsed(F.col("url"))
    rows = (pages.select("page_id", host.alias("host"), path.alias("path"))
            .withColumn("fit", longest_rule(F.col("host"), F.col("path"), rules))
            .withColumn("segments", shaped(F.col("path"))))
    counted = written(spark, rows.groupBy("host", "segments").agg(
        F.count(F.lit(1)).alias("n"), F.count("fit.verdict").alias("labelled"),
        F.count_if(F.col("fit.verdict") == "block").alias("bad")), "paths")
    tree = templates(spark, counted)
    total = counted.agg(F.sum("bad"), F.sum("labelled")).first()
    overall = ((total[0] or 0) + 1) / ((total[1] or 0) + 2)
    of_host = counted.groupBy("host").agg(
        ((F.sum("bad") + WEIGHT * overall) / (F.sum("labelled") + WEIGHT)).alias("host_rate"))
    rates = (tree.groupBy("host", "template").agg(F.sum("bad").alias("bad"), F.sum("labelled").alias("labelled"))
             .join(of_host, "host").select("host", "template", (
                 (F.col("bad") + WEIGHT * F.col("host_rate")) / (F.col("labelled") + WEIGHT)).alias("block_rate")))
    known = tree.select("host", "segments", "template").join(rates, ["host", "template"])
    method = F.when(F.col("block_rate") >= REJECT, F.lit("block")).otherwise(F.lit("allow"))
    return rows.join(known, ["host", "segments"]).select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", method).alias("verdict"), "template", "block_rate")
