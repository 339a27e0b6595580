"""Operator 6: URL filter rules as a sort-merge range join (DataFrame functions only).

A host is written with its labels reversed and a closing dot ("net.example."), so a
rule's host and all its subdomains are one interval of keys [key, key + U+10FFFF),
and the intervals of different rules nest or are apart.  The interval ends cut the
key line into stretches; each end carries the stack of rules active after it.  Pages
and ends are sorted together once by range partitions; a page takes the stack of the
last end at or before its key, and the rule on that stack with the longest text
whose path starts the page's path.

Ranges are cut on (key, page), so one host with a third of all pages spreads over
many partitions; the last end before each partition is carried in from a table of one
row per partition.  Stacks are as deep as rules nest (labels of a host).

Nulls and edge cases: a null url, or one without "://", has an empty host and path and
no rule but the method's verdict; equal rules count once, and where one text has both
verdicts, block wins; a rule with an empty host fits every page that has a host, by its path; repeated
pages are judged alike; an empty table of pages or rules is fine; other columns of the
pages are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from martcraft.session import materialize

TOP = "\U0010ffff"


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without "://"."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    return (lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1)),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def reversed_host(host: Column) -> Column:
    """"www.example.net" -> "net.example.www."; empty stays empty."""
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def _ends(rules: DataFrame) -> DataFrame:
    """(key, stack): every interval end with the rules active from there on.

    A rule is active at an end if the end lies in its interval, which is a question of
    the end's own key prefixes: an equality join on them, no pairs of rules."""
    hosts = rules.groupBy("rkey").agg(F.collect_set(F.struct("text", "path", "verdict")).alias("here"))
    points = hosts.select(F.col("rkey").alias("key"), F.col("rkey").alias("inside")).union(
        # after the interval, what holds is what held around it
        hosts.where("rkey <> ''").select(
            F.concat("rkey", F.lit(TOP)).alias("key"),
            F.regexp_extract("rkey", r"^(.*\.)?[^.]*\.$", 1).alias("inside")))
    labels = F.split("inside", r"\.")
    prefix = F.explode(F.concat(F.array(F.lit("")), F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
        lambda i: F.concat(F.array_join(F.slice(labels, 1, i), "."), F.lit(".")))))
    held = points.select("key", prefix.alias("rkey")).distinct().join(hosts, "rkey", "left")
    return held.groupBy("key").agg(F.flatten(F.collect_list("here")).alias("stack"))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id",
          url_col: str = "url") -> DataFrame:
    """Per page: id, host, path, rule (null if none fits), verdict.

    ``rules``: host, path, verdict ("allow" or "block")."""
    spark = pages.sparkSession
    host, path = host_path(F.col("url"))
    pages = (pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
             .select("id", host.alias("host"), path.alias("path"))
             .withColumn("key", reversed_host(F.col("host"))))
    rules = (rules.select(lower_ascii(F.coalesce("host", F.lit(""))).alias("host"),
                          F.coalesce("path", F.lit("")).alias("path"), "verdict")
             .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
             .select(reversed_host(F.col("host")).alias("rkey"), F.concat("host", "path").alias("text"), "path", "verdict"))
    ends = _ends(rules)
    line = pages.select("key", F.lit(1).alias("kind"), "id", "host", "path",
                        F.lit(None).cast(ends.schema["stack"].dataType).alias("stack")).union(
        ends.select("key", F.lit(0), F.lit(None).cast(pages.schema["id"].dataType), F.lit(None).cast("string"),
                    F.lit(None).cast("string"), "stack"))
    # written once: the ranges must be the same ones for both uses below
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    swept = materialize(line.repartitionByRange(n, "key", "kind", "id")
                        .withColumn("part", F.spark_partition_id()))
    last = swept.where("kind = 0").groupBy("part").agg(F.max_by("stack", "key").alias("stack"))
    parts = swept.groupBy("part").agg(F.count(F.lit(1)).alias("n")).join(last, "part", "left")
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)     # one row per partition
    carried = parts.select("part", F.last("stack", ignorenulls=True).over(before).alias("carried"))
    sweep = W.partitionBy("part").orderBy("key", "kind").rowsBetween(W.unboundedPreceding, 0)
    active = (swept.withColumn("own", F.last("stack", ignorenulls=True).over(sweep)).where("kind = 1")
              .join(carried, "part")
              .withColumn("stack", F.coalesce("own", "carried")))
    fits = F.filter("stack", lambda r: F.startswith(F.col("path"), r["path"]) & (F.col("key") != ""))
    best = F.array_max(F.transform(fits, lambda r: F.struct(F.length(r["text"]).alias("n"), r["text"].alias("text"),
                                                            r["verdict"].alias("verdict"))))
    return active.withColumn("best", best).select(
        F.col("id").alias(id_col), "host", "path", F.col("best.text").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
