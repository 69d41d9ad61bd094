"""Allow and block rules for URLs, matched by hashes of host-suffix and path-prefix expressions."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import column

#: Rules are broadcast up to this many characters in all; beyond it the join shuffles them.
BROADCAST_CHARACTERS = 4_000_000
PREFIX = 8  # hexadecimal digits of the digest that the join compares: 32 bits


def ascii_lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host after the first ``://`` (A-Z lower-cased), and what follows it up to ``?`` or ``#``.
    Both are empty without ``://`` and for null."""
    known = F.coalesce(F.contains(url, F.lit("://")), F.lit(False))
    rest = F.when(known, F.substr(url, F.locate("://", url) + 3)).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    return ascii_lower(host), F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)


def parse_rules(rules: DataFrame, verdict: str = "verdict", rule: str = "rule") -> DataFrame:
    """Rules as host and path. A rule is written ``host/path``, and ``host`` alone means ``host/``; rows with a null or
    a verdict other than ``allow`` and ``block`` are no rules. Of equal rules that disagree, block stands."""
    text = F.regexp_replace(column(rules, rule), r"^([^/]+)$", "$1/")
    host = ascii_lower(F.substring_index(text, "/", 1))
    return (
        rules.where(column(rules, verdict).isin("allow", "block") & column(rules, rule).contains(""))
        .select(host.alias("host"), F.substr(text, F.length(host) + 1).alias("path"), column(rules, verdict).alias("verdict"))
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .where("host <> ''")
    )


def judge_urls(
    pages: DataFrame, rules: DataFrame, default: str = "allow", page_id: str = "page_id", url: str = "url"
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    A rule fits its host and all subdomains of it if the path starts with the rule's. The longest rule wins (of
    equally long ones the one with more host labels). Pages that no rule fits have a null ``rule`` and the verdict
    ``default``; so have null urls and urls without ``://``. Repeated pages are judged one by one; an empty table or
    no rules at all are fine.

    Each url is expanded into the host suffixes and path prefixes whose numbers of labels and characters occur
    among the rules: at most one expression for each such pair, however long the url. Expressions meet the rules
    on 32 bits of their SHA-256; the whole digests then confirm, so a shared prefix does no harm. What won is kept
    as one number per page, aggregated before anything is shuffled: no host is a key, so a frequent one does not
    matter. Rules beyond ``BROADCAST_CHARACTERS`` are shuffled instead, where adaptive execution splits frequent
    expressions.
    """
    parsed = parse_rules(rules)
    shape = parsed.select(
        F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("length"),
        (F.length("host") + F.length("path") + 64).alias("characters"),
    )
    # Distinct pairs of label count and path length: a few numbers, whatever the number of rules.
    pairs, characters = shape.agg(F.sort_array(F.collect_set(F.struct("labels", "length"))), F.sum("characters")).first()

    digests = parsed.withColumn("digest", F.sha2(F.concat("host", "path"), 256)).select(
        F.left("digest", F.lit(PREFIX)).alias("short"),
        F.col("digest").alias("rule_digest"),
        # Precedence in one number: characters, host labels, verdict.
        ((F.length("host") + F.length("path")).cast("long") * 65536 + F.size(F.split("host", r"\.")) * 2
         + (F.col("verdict") == "block").cast("int")).alias("precedence"),
    )
    if (characters or 0) <= BROADCAST_CHARACTERS:
        digests = F.broadcast(digests)

    host, path = host_and_path(column(pages, url))
    rows = pages.select(
        F.monotonically_increasing_id().alias("row"),
        column(pages, page_id).alias("page_id"),
        host.alias("host"),
        path.alias("path"),
    )
    count = F.size(F.split("host", r"\."))
    shapes = F.array(*[F.struct(F.lit(p["labels"]).alias("labels"), F.lit(p["length"]).alias("length")) for p in pairs])
    shapes = shapes.cast("array<struct<labels: int, length: int>>")
    labels = F.split("host", r"\.")
    expressions = F.transform(
        F.filter(shapes, lambda p: (p["labels"] <= count) & (p["length"] <= F.length("path"))),
        lambda p: F.concat(
            F.array_join(F.slice(labels, count - p["labels"] + 1, p["labels"]), "."), F.substr(F.col("path"), F.lit(1), p["length"])
        ),
    )
    keys = ["row", "page_id", "host", "path"]
    won = (
        rows.select(*keys, F.explode_outer(expressions).alias("expression"))
        .withColumn("digest", F.sha2("expression", 256))
        .withColumn("short", F.left("digest", F.lit(PREFIX)))
        .join(digests, "short", "left")
        .groupBy(*keys)
        .agg(F.max(F.when(F.col("digest") == F.col("rule_digest"), F.col("precedence"))).alias("won"))
    )
    n = F.shiftright(F.col("won").bitwiseAND(65535), 1).cast("int")
    suffix = F.array_join(F.slice(F.split("host", r"\."), count - n + 1, n), ".")
    rule = F.concat(suffix, F.substr("path", F.lit(1), F.shiftright("won", 16).cast("int") - F.length(suffix)))
    return won.select(
        "page_id", "host", "path",
        F.when(F.col("won").isNotNull(), rule).alias("rule"),
        F.when(F.col("won").isNull(), default)
        .when(F.col("won").bitwiseAND(1) == 1, "block").otherwise("allow").alias("verdict"),
    )
