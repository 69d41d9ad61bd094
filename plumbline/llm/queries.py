"""Each operator as a query over the driver's tables, and the same question in SQL where SQL has it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import (
    conversations, digests, embeddings, language, licenses, mixing, packing, prefix_tree, quality, repeats, revisits, simhash, token_output, url_filters,
)

Query = Callable[[SparkSession, str], DataFrame]

#: Where the tokenizer's file is; a parameter of the operators, not part of this repository.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_token_output(spark: SparkSession, folder: str) -> DataFrame:
    return token_output.token_matrices(table(spark, folder, "documents"), TOKENIZER)


#: The rules of the query, longest last; fixed values.
URL_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


def op2_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.sql(
        "SELECT * FROM VALUES " + ", ".join(f"('{verdict}', '{rule}')" for verdict, rule in URL_RULES) + " AS t(verdict, rule)"
    )
    return url_filters.judge_urls(table(spark, folder, "pages"), rules)


def page_captures(pages: DataFrame) -> DataFrame:
    """Two captures of each page, its id being the time in minutes: the page itself, and a revisit up to 1,000 minutes
    later. Where the url's checksum is divisible by 7, the server says that another version has not been modified."""
    version, minute = F.md5("html"), F.col("page_id") * 60
    checksum = F.conv(F.left(F.md5("url"), F.lit(4)), 16, 10).cast("long")
    full = pages.select(
        (F.col("page_id") * 2).alias("record_id"), "url", minute.alias("captured_at"), F.lit(200).alias("status"),
        F.create_map(
            F.lit("ETag"), version, F.lit("Content-Length"), F.length("html").cast("string"),
            F.lit("Server"), F.concat(F.lit("s"), F.col("page_id") % 5), F.lit("Cache-Control"), F.lit("max-age=60"),
        ).alias("headers"),
        F.lit(None).cast("string").alias("digest"),
    )
    revisit = pages.select(
        (F.col("page_id") * 2 + 1).alias("record_id"), "url", (minute + 60 + checksum % 1000 * 60).alias("captured_at"),
        F.lit(304).alias("status"),
        F.create_map(
            F.lit("etag"), F.when(checksum % 7 == 0, "other").otherwise(F.concat(F.lit("W/"), version)),
            F.lit("content-length"), F.lit("0"), F.lit("cache-control"), F.lit("max-age=300"),
        ).alias("headers"),
        F.lit(None).cast("string").alias("digest"),
    )
    return full.unionByName(revisit)


def op9_revisits(spark: SparkSession, folder: str) -> DataFrame:
    found = revisits.resolve_revisits(page_captures(table(spark, folder, "pages")))
    line = F.transform(F.map_entries("headers"), lambda x: F.concat(x["key"], F.lit("="), x["value"]))
    return found.select(
        "record_id", "canonical_url", "captured_at", "status", "outcome", "refers_to",
        F.array_join(F.array_sort(line), ";").alias("headers"),
    )


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge_quality(table(spark, folder, "documents")).drop("key")


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    taken = mixing.taken_words(mixing.mix_sources(table(spark, folder, "documents")))
    return taken.select("doc_id", "size", "source_size", "target", "taken", "source")


def op6_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, folder, "embeddings"))


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    part = lambda name: F.coalesce(F.crc32(F.col(name).cast("string").cast("binary")) % 4, F.lit(0))
    filters = language.learn_filters(docs, part("doc_id") != 2)
    found = language.predict_language(docs, filters)
    return found.select("doc_id", (part("doc_id") == 2).alias("held_out"), "lang_pred", "score")


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, folder, "documents"), TOKENIZER)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op10_repeats(spark: SparkSession, folder: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, folder, "documents"), keep_first=False)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["begin"])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


#: Templates of license notices: label, phrase, exact. The first three are the base phrases; fixed values.
LICENSE_TEMPLATES = [
    ("mit", "mit license", True),
    ("apache", "apache license", True),
    ("gpl", "general public license", True),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction", False),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at", False),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is "
     "distributed on an as is basis without warranties or conditions of any kind either express or implied", False),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
     "public license as published by the free software foundation", False),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation", False),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
     "the following conditions are met", False),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", False),
    ("unlicense", "this is free and unencumbered software released into the public domain", False),
    ("cc-by-nc", "licensed under cc by nc 4 0", False),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license", False),
    ("cc-by-sa", "licensed under cc by sa 4 0", False),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license", False),
    ("cc-by", "licensed under cc by 4 0", False),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", False),
]


def license_templates(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{label}', '{phrase}', {exact})" for label, phrase, exact in LICENSE_TEMPLATES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(label, phrase, exact)")


def op12_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.label_documents(table(spark, folder, "documents"), license_templates(spark))


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults, chosen by a checksum of conversation and turn: rows dropped, emptied, without the marks that end a
    sentence, repeated, or said by the user. Nulls are written as one space."""
    space = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.translate(space("text"), ".!?", "")).otherwise(space("text"))
    times = F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1)
    return rows.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(space("role")).alias("role"), text.alias("text"),
        F.explode(F.array_repeat(F.lit(0), times)).alias("copy"),
    ).drop("copy")


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    summary, turns = conversations.repair_conversations(damaged(rows))
    key = lambda: F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    turns = turns.where("size(turns) > 0").select(key().alias("key"), F.col("piece").alias("place"), "last", lines.alias("text"))
    one = turns.where("last").select("key", F.sha2("text", 256).alias("sha256"))
    hashes = one.unionByName(digests.joined_digests(turns.where("NOT last"), "\n"))
    sums = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    ids = rows.select("conv_id").distinct().select("conv_id", key().alias("key"))
    found = ids.join(summary.select(key().alias("key"), *sums, "audit"), "key", "left").join(hashes, "key", "left")
    return found.select(
        "conv_id", *[F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in sums],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.lit(digests.EMPTY)).alias("repaired_sha256"),
    )


def op13_prefix_tree(spark: SparkSession, folder: str) -> DataFrame:
    turns = prefix_tree.numbered_turns(table(spark, folder, "conversations"))
    borrowed = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).alias("wanted")
    source = F.col("conv_id") - F.col("conv_id") % 20
    nodes, ends = prefix_tree.prefix_tree(*prefix_tree.with_beginnings(turns, borrowed, source, most=3))
    key = F.concat_ws(":", *prefix_tree.KEY).alias("key")
    ids = ends.select(key, F.col("conv_id").alias("place"), F.col("conv_id").cast("string").alias("text"))
    hashes = digests.joined_digests(digests.joined_runs(ids, ","), ",")
    return nodes.withColumn("key", key).join(hashes, "key", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("sha256", F.lit(digests.EMPTY)).alias("ends_sha256"),
    )


def queries() -> dict[str, Query]:
    return {
        "op1_token_output": op1_token_output,
        "op2_url_filters": op2_url_filters,
        "op3_simhash": op3_simhash,
        "op4_quality": op4_quality,
        "op5_mixing": op5_mixing,
        "op6_embeddings": op6_embeddings,
        "op7_language": op7_language,
        "op8_packing": op8_packing,
        "op9_revisits": op9_revisits,
        "op10_repeats": op10_repeats,
        "op11_conversation_repair": op11_conversation_repair,
        "op12_licenses": op12_licenses,
        "op13_prefix_tree": op13_prefix_tree,
    }


HOST_PATH_SQL = """
    SELECT *, regexp_extract(rest, '^[^/?#]*') AS own_host,
           translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
    FROM (SELECT *, CASE WHEN contains(url, '://') THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages)
"""

ORACLES: dict[str, str] = {
    "op2_url_filters": f"""
WITH rules(verdict, rule_host, rule_path) AS (VALUES
    ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
    ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
urls AS (SELECT row_number() OVER () AS n, page_id, host, path FROM ({HOST_PATH_SQL})),
fits AS (
    SELECT n, rule_host || rule_path AS rule, verdict,
           row_number() OVER (PARTITION BY n ORDER BY length(rule_host || rule_path) DESC) AS place
    FROM urls JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM urls LEFT JOIN (SELECT * FROM fits WHERE place = 1) USING (n)
""",
    "op9_revisits": f"""
WITH parts AS (
    SELECT page_id, url, html, host, path,
           list_sort(list_filter(string_split(regexp_extract(split_part(url, '#', 1), '\\?(.*)$', 1), '&'),
               lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|gclid|fbclid)(=|$)'))) AS q
    FROM ({HOST_PATH_SQL})),
named AS (
    SELECT page_id, html,
           CASE WHEN host <> '' THEN regexp_replace(host, '^www\\.|:(80|443)$', '', 'g') || regexp_replace(path, '/+$', '')
               || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END END AS canonical_url,
           ('0x' || substr(md5(url), 1, 4))::BIGINT AS checksum
    FROM parts),
captures AS (
    SELECT page_id * 2 AS record_id, canonical_url, page_id * 60 AS captured_at, 200 AS status, md5(html) AS etag,
           length(html)::VARCHAR AS size, 's' || (page_id % 5) AS server, 60 AS age, checksum FROM named
    UNION ALL
    SELECT page_id * 2 + 1, canonical_url, page_id * 60 + 60 + checksum % 1000 * 60, 304,
           CASE WHEN checksum % 7 = 0 THEN 'other' ELSE md5(html) END, '0', NULL, 300, checksum FROM named),
met AS (
    SELECT c.*, r.record_id AS found, r.etag AS old_etag, r.size AS old_size, r.server AS old_server,
           row_number() OVER (PARTITION BY c.record_id ORDER BY r.captured_at DESC, r.record_id DESC) AS place
    FROM captures c LEFT JOIN captures r
      ON c.status = 304 AND r.status = 200 AND c.canonical_url = r.canonical_url AND r.captured_at < c.captured_at),
judged AS (
    SELECT *, CASE WHEN status = 200 THEN 'full' WHEN found IS NULL THEN 'no_response'
                   WHEN etag <> old_etag THEN 'mismatch' ELSE 'resolved' END AS outcome,
           CASE WHEN status = 304 AND etag <> 'other' THEN 'W/' ELSE '' END || etag AS written
    FROM met WHERE place = 1)
SELECT record_id, canonical_url, captured_at, CASE WHEN outcome = 'resolved' THEN 200 ELSE status END AS status, outcome,
       CASE WHEN outcome = 'resolved' THEN found END AS refers_to,
       'cache-control=max-age=' || age || ';content-length=' || CASE WHEN outcome = 'resolved' THEN old_size ELSE size END
       || ';etag=' || written
       || coalesce(';server=' || CASE WHEN outcome = 'resolved' THEN old_server ELSE server END, '') AS headers
FROM judged
""",
    "op12_licenses": f"""
WITH templates(label, phrase, exact) AS (VALUES
    {", ".join(f"('{label}', '{phrase}', {exact})" for label, phrase, exact in LICENSE_TEMPLATES)}),
places AS (
    SELECT label, exact, phrase, string_split(phrase, ' ') AS t, len(t) AS length, least(len(t), 3) AS width,
           unnest(range(len(t) - least(len(t), 3) + 1)) AS spot FROM templates),
texts AS (
    SELECT row_number() OVER () AS n, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
grams AS (
    SELECT n, unnest(words) AS w0, unnest(words[2:] || [NULL]) AS w1, unnest(words[3:] || [NULL, NULL]) AS w2,
           unnest(range(len(words))) AS place FROM texts),
votes AS (
    SELECT n, label, exact, phrase, length, width, spot, place - spot AS diagonal FROM grams JOIN places
      ON w0 = t[spot + 1] AND w1 = t[spot + 2] AND (width = 2 OR w2 = t[spot + 3])),
islands AS (
    SELECT *, sum(starts) OVER (PARTITION BY n, label, phrase ORDER BY diagonal, spot) AS span FROM (
        SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY n, label, phrase ORDER BY diagonal, spot)
                          <= CASE WHEN exact THEN 0 ELSE length // 10 END THEN 0 ELSE 1 END AS starts FROM votes)),
spans AS (
    SELECT n, label, exact, length, sum(covers) AS covered, min(diagonal + spot) AS first, max(diagonal + spot + width) AS final
    FROM (SELECT *, least(width, coalesce(lead(spot) OVER (PARTITION BY n, label, phrase, span ORDER BY spot, diagonal) - spot, width))
              AS covers FROM islands)
    GROUP BY n, label, exact, phrase, length, span),
judged AS (
    SELECT *, covered >= CASE WHEN exact THEN length ELSE ceil(length * 0.8) END
              AND final - first <= length + CASE WHEN exact THEN 0 ELSE length // 10 * 2 END AS found FROM spans),
named AS (
    SELECT n, count(*) FILTER (found AND exact) AS n_base, min(first) FILTER (found AND exact) AS first_word,
           max(first) FILTER (found AND exact) AS last_word,
           string_agg(DISTINCT label, ',' ORDER BY label) FILTER (found AND exact) AS base_labels,
           string_agg(DISTINCT label, ',' ORDER BY label) FILTER (found) AS labels,
           max(least(1.0, covered::DOUBLE / length::DOUBLE)) AS score
    FROM judged GROUP BY n)
SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
       coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM texts LEFT JOIN named USING (n)
""",
}


def oracle_sql() -> dict[str, str]:
    return ORACLES
