"""Not-modified captures of web pages, resolved to the full responses they stand for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import column
from plumbline.llm.url_filters import host_and_path

#: Headers that a not-modified response does not update (RFC 9110 and RFC 9111), in lower case. Fixed values.
NOT_MERGED = [
    "connection", "content-encoding", "content-length", "content-range", "keep-alive", "proxy-authenticate",
    "proxy-authentication-info", "proxy-authorization", "te", "trailer", "transfer-encoding", "upgrade",
]
TRACKING = r"^(utm_[^=]*|gclid|fbclid)(=|$)"


def canonical_url(url: Column) -> Column:
    """Host and path without scheme, ``www.``, default port, fragment and closing slash, and the query without
    tracking parameters, in order. Null for null and for what is no absolute url."""
    host, path = host_and_path(url)
    query = F.regexp_extract(F.substring_index(url, "#", 1), r"\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda x: (x != "") & ~F.rlike(x, F.lit(TRACKING))))
    return F.when(
        host != "",
        F.concat(
            F.regexp_replace(host, r"^www\.|:(80|443)$", ""),
            F.regexp_replace(path, r"/+$", ""),
            F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""),
        ),
    )


def lower_keys(headers: Column) -> Column:
    """Headers as pairs in the order of their lower-cased names, one pair a name. Several values of a name are one list, in
    order, as RFC 9110 writes it; cookies, which hold commas, are set apart by line ends."""
    pairs = F.transform(
        F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>"))),
        lambda x: F.struct(F.lower(x["key"]).alias("key"), x["value"].alias("value")),
    )
    order = F.array_sort(pairs)

    def together(name: Column) -> Column:
        values = F.array_compact(F.transform(F.filter(order, lambda x: x["key"] == name), lambda x: x["value"]))
        joined = F.when(name == "set-cookie", F.array_join(values, "\n")).otherwise(F.array_join(values, ", "))
        return F.struct(name.alias("key"), F.when(F.size(values) > 0, joined).alias("value"))

    names = F.array_distinct(F.transform(order, lambda x: x["key"]))
    return F.when(F.size(names) == F.size(order), order).otherwise(F.transform(names, together))


def resolve_revisits(
    captures: DataFrame,
    record_id: str = "record_id",
    url: str = "url",
    captured_at: str = "captured_at",
    status: str = "status",
    headers: str = "headers",
    digest: str = "digest",
    chunk: int = 86_400,
) -> DataFrame:
    """One row per capture: record_id, canonical_url, captured_at, status, outcome, refers_to, headers.

    A capture with status 304 is a revisit. It is joined as of its time with the latest full response (status 200)
    of the same canonical url at a strictly earlier time; of several at that time with the largest record_id.
    ``outcome`` is ``resolved`` if they agree on every validator that both have (etag, weak or strong alike;
    last-modified; payload digest) and have one in common, ``unverified`` if they have none in common, ``mismatch`` if they
    disagree, ``no_response`` if there is no earlier response, and ``full`` or ``other`` for captures that are no
    revisits. Resolved and unverified revisits refer to their response and get its status and headers, updated by their own but
    for those that say how that message was sent (``NOT_MERGED``, and what a Connection header names). All others keep their
    own and refer to nothing. Repeated rows are captures of their own, with the same answer. An empty table gives no rows.
    Null urls, or urls that are not absolute, meet no response; a null time is before all others and has none before it.

    ``captured_at`` is a whole number (seconds). Captures are dealt out by url and ``chunk`` of time, so a url with a large
    share of all captures is spread; the latest response of each chunk is carried over to later chunks. Bodies are not
    moved: ``refers_to`` says whose body a revisit has.
    """
    own = lower_keys(column(captures, headers))
    value = lambda name: F.get(F.filter(own, lambda x: x["key"] == name), F.lit(0))["value"]
    canonical = canonical_url(column(captures, url))
    rows = captures.select(
        column(captures, record_id).cast("long").alias("record_id"),
        canonical.alias("canonical_url"),
        canonical.alias("key"),
        column(captures, captured_at).cast("long").alias("captured_at"),
        column(captures, status).cast("int").alias("status"),
        own.alias("own"),
        F.regexp_replace(value("etag"), "^W/", "").alias("etag"),
        value("last-modified").alias("modified"),
        column(captures, digest).cast("string").alias("digest"),
    ).withColumns({
        "time": F.coalesce("captured_at", F.lit(-(1 << 62))),
        "chunk": F.floor(F.coalesce("captured_at", F.lit(-(1 << 62))) / F.lit(chunk)).cast("long"),
    })
    full = (F.col("status") == 200) & F.col("canonical_url").isNotNull()
    response = F.when(full, F.struct("time", "record_id", "etag", "modified", "digest", "own"))
    earlier = (Window.unboundedPreceding, -1)
    within = Window.partitionBy("key", "chunk").orderBy("time").rangeBetween(*earlier)
    before = Window.partitionBy("key").orderBy("chunk").rangeBetween(*earlier)
    known = rows.where(F.col("key").isNotNull())
    carried = (
        known.groupBy("key", "chunk").agg(F.max(response).alias("last"))
        .select("key", "chunk", F.max("last").over(before).alias("carried"))
    )
    found = known.withColumn("near", F.max(response).over(within)).join(carried, ["key", "chunk"])
    found = found.withColumn("r", F.coalesce("near", "carried")).unionByName(
        rows.where(F.col("key").isNull()), allowMissingColumns=True
    )
    agree = [F.col(name) == F.col(f"r.{name}") for name in ("etag", "modified", "digest")]
    outcome = (
        F.when(F.col("status") == 200, "full")
        .when(F.coalesce(F.col("status") != 304, F.lit(True)), "other")
        .when(F.col("r").isNull(), "no_response")
        .when(F.coalesce(F.forall(F.array(*agree), lambda x: F.coalesce(x, F.lit(True))) == False, F.lit(False)), "mismatch")  # noqa: E712
        .when(F.coalesce(*agree).isNull(), "unverified")
        .otherwise("resolved")
    )
    # A Connection header names further fields that are about the message alone (RFC 9111, 3.1).
    listed = F.get(F.filter("own", lambda x: x["key"] == "connection"), F.lit(0))["value"]
    hop = F.transform(F.split(F.lower(F.coalesce(listed, F.lit(""))), ","), lambda x: F.trim(x))
    news = F.filter("own", lambda x: ~x["key"].isin(NOT_MERGED) & ~F.array_contains(hop, x["key"]))
    names = F.transform(news, lambda x: x["key"])
    merged = F.array_sort(F.concat(news, F.filter("r.own", lambda x: ~F.array_contains(names, x["key"]))))
    taken = F.col("outcome").isin("resolved", "unverified")
    return found.withColumn("outcome", outcome).select(
        "record_id", "canonical_url", "captured_at",
        F.when(taken, 200).otherwise(F.col("status")).alias("status"),
        "outcome",
        F.when(taken, F.col("r.record_id")).alias("refers_to"),
        F.map_from_entries(F.when(taken, merged).otherwise(F.col("own"))).alias("headers"),
    )
