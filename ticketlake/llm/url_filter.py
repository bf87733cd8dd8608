"""URL filter: host-suffix and path-prefix expressions joined with rules on short hash prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Hex digits of a digest that the equi-join compares; the full digest is confirmed afterwards.
PREFIX_DIGITS = 8


def host_of(url: Column) -> Column:
    """What stands after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; empty for null or without `://`."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def digest(host: Column, path: Column) -> Column:
    """Digest of one expression. A host holds no `/`, and a path is empty or starts with one."""
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def prepared_rules(rules: DataFrame) -> DataFrame:
    """Rules `(action, host, path)` with digest, prefix and precedence.

    Rules with a null part never fit and are left out. The same rule given twice counts once; if it
    is both allowed and blocked, it blocks. Longest rule wins; of equal length, the longer host.
    """
    return (
        rules.select("action", F.translate("host", UPPER, LOWER).alias("host"), "path")
        .dropna()
        .groupBy("host", "path").agg(F.max("action").alias("action"))
        .withColumn("digest", digest(F.col("host"), F.col("path")))
        .select(
            F.substring("digest", 1, PREFIX_DIGITS).alias("prefix"), "digest", "action",
            F.concat("host", "path").alias("rule"),
            F.struct(F.length("host") + F.length("path"), F.length("host"), F.col("action")).alias("rank"),
            F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("path_chars"),
        )
    )


def expressions(urls: DataFrame, prepared: DataFrame) -> DataFrame:
    """Every `(host suffix, path prefix)` of a distinct `(host, path)` that some rule could equal.

    Only host label counts and path lengths that occur among the rules are expanded; they come back
    as scalar subqueries, so a long path gives as many prefixes as there are rule lengths.
    """
    labels = F.split("host", r"\.")
    suffix = F.array_join(F.slice(labels, F.size(labels) - F.col("n") + 1, F.col("n")), ".")
    occurring = {
        "n": prepared.agg(F.collect_set("labels")).scalar(),
        "c": prepared.agg(F.collect_set("path_chars")).scalar(),
    }
    return (
        urls.withColumn("n", F.explode(occurring["n"])).filter(F.col("n") <= F.size(labels))
        .withColumn("c", F.explode(occurring["c"])).filter(F.col("c") <= F.length("path"))
        .select("host", "path", digest(suffix, F.substring(F.col("path"), F.lit(1), F.col("c"))).alias("digest"))
    )


def filter_urls(
    pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow",
) -> DataFrame:
    """`pages` with `host`, `path`, `rule` and `verdict`.

    A rule fits its host and all subdomains where the url's path starts with the rule's path; the
    longest rule wins. `rule` is null and `verdict` is `default` where none fits.

    A null url, or one without `://`, has empty host and path. Empty tables give empty results, no
    rules give `default` everywhere. Repeated pages stay repeated, and columns of `pages` that have
    one of the four names are replaced. Each distinct `(host, path)` is judged once, so a host with
    a third of all pages costs no more than its distinct paths, and no row key is needed.
    """
    known = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    known = known.drop("rule", "verdict")
    prepared = prepared_rules(rules)
    looked_up = expressions(known.select("host", "path").distinct(), prepared)
    hits = (
        looked_up.withColumn("prefix", F.substring("digest", 1, PREFIX_DIGITS)).alias("u")
        .join(prepared.alias("r"), "prefix")
        .filter(F.col("u.digest") == F.col("r.digest"))
        .groupBy("u.host", "u.path")
        .agg(F.max(F.struct("r.rank", "r.rule", "r.action")).alias("best"))
        .select("host", "path", F.col("best.rule").alias("rule"), F.col("best.action").alias("verdict"))
    )
    return known.join(hits, ["host", "path"], "left").withColumn("verdict", F.coalesce("verdict", F.lit(default))).select(
        *known.columns, "rule", "verdict")
