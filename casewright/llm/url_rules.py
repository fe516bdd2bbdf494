"""URL filters by host-suffix and path-prefix expressions (operator 4).

Each URL is expanded into host suffixes (cut at dots) and path prefixes (cut
after slashes); each rule is filed under its host and the part of its path up
to the last slash. URL expressions meet rules in an equi-join on a short hash
prefix; the full digest, the exact path prefix and then precedence decide.
Only DataFrame functions are used.

No URL expression is made that no rule could meet: suffixes have at most as
many labels, and prefixes at most as many slashes, as the rules' own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewright.llm.common import ascii_lower

# Hex digits of the digest that are joined on.
SHORT = 8


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; else empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), F.lit("")))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def _up_to_last_slash(path: Column) -> Column:
    return F.regexp_extract(path, r"(?s)^.*/", 0)


def _suffixes(host: Column, labels: Column) -> Column:
    parts = F.split(host, "[.]", -1)
    n = F.size(parts)
    kept = F.slice(parts, F.greatest(n - labels, F.lit(0)) + 1, labels)
    m = F.size(kept)
    return F.transform(
        F.sequence(F.lit(1), m), lambda i: F.array_join(F.slice(kept, i, m - i + 1), ".")
    )


def _prefixes(path: Column, slashes: Column) -> Column:
    """The empty prefix and those that end in a slash, at most ``slashes`` of them."""
    ends = F.regexp_extract_all(path, F.lit(r"(?s)[^/]*/"), F.lit(0))
    n = F.least(F.size(ends), slashes)
    return F.transform(F.sequence(F.lit(0), n), lambda i: F.array_join(F.slice(ends, 1, i), ""))


def url_verdicts(
    pages: DataFrame,
    rules: DataFrame,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
) -> DataFrame:
    """``(id, host, path, rule, verdict)``, one row per row of ``pages``.

    ``rules``: ``host``, ``path``, ``verdict``. A rule fits its host and all
    subdomains where the URL's path starts with the rule's. The rule with the
    longest host and path together wins; of equally long ones that with the
    longer host, then ``block``. Without a rule: null and ``default``. A null
    URL or one without ``://`` has an empty host and path. Repeated rows give
    repeated results; null ids are kept. Rules with a null host or path are void.
    """
    rules = rules.where("host is not null and path is not null").select(
        ascii_lower(F.col("host")).alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict").alias("rule_verdict")
    )
    filed = rules.withColumn("digest", _digest(F.col("rule_host"), _up_to_last_slash(F.col("rule_path"))))
    filed = filed.withColumn("short", F.substring("digest", 1, SHORT))
    deep = rules.agg(
        F.coalesce(F.max(F.size(F.split("rule_host", "[.]", -1))), F.lit(0)),
        F.coalesce(F.max(F.length("rule_path") - F.length(F.replace("rule_path", F.lit("/"), F.lit("")))), F.lit(0)),
    ).first()
    labels, slashes = (F.lit(int(x)) for x in deep)

    # Rows are expanded and joined where they are read; what meets again are one row's candidates.
    cut = pages.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col(id_col).alias("id"),
        url_host(F.col(url_col)).alias("host"),
        url_path(F.col(url_col)).alias("path"),
    )
    if deep[0] == 0:
        found = cut.withColumn("best", F.lit(None).cast("struct<size:int,hosts:int,block:int,rule:string,verdict:string>"))
    else:
        each = cut.withColumn("suffix", F.explode(_suffixes(F.col("host"), labels)))
        each = each.withColumn("prefix", F.explode(_prefixes(F.col("path"), slashes)))
        each = each.withColumn("url_digest", _digest(F.col("suffix"), F.col("prefix")))
        each = each.withColumn("short", F.substring("url_digest", 1, SHORT))
        met = each.join(filed, "short", "left")
        fits = (
            (F.col("digest") == F.col("url_digest"))
            & (F.col("rule_host") == F.col("suffix"))
            & F.col("path").startswith(F.col("rule_path"))
        )
        rule = F.struct(
            (F.length("rule_host") + F.length("rule_path")).alias("size"),
            F.length("rule_host").alias("hosts"),
            (F.col("rule_verdict") == "block").cast("int").alias("block"),
            F.concat("rule_host", "rule_path").alias("rule"),
            F.col("rule_verdict").alias("verdict"),
        )
        found = met.groupBy("_row", "id", "host", "path").agg(F.max(F.when(fits, rule)).alias("best"))
    return found.select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict"),
    )
