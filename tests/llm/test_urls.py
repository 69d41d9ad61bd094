import re
import string

import pyarrow as pa
from plumbline.llm import revisits, url_filters
from plumbline.llm.queries import URL_RULES

URLS = [
    None, "", "no scheme", "://", "http://", "http://ORG/", "https://a.example.org/es/x?y#z", "https://example.org/es", "http://example.org/en/12",
    "http://x.y.example.org/en/2", "http://fr.com/fr/a", "http://Z.COM/fr/?q", "http://z.com/de/", "http://z.com#/de/", "ftp://example.organic/es/",
    "http://xexample.org/es/", "http://example.org./es/", "http://a..org/", "http://É.org/es/", "https://" + "a." * 3000 + "org/x", "x://y://z.org/",
    "http://user@example.org/es/", "http://example.org:80/es/", "http://com/de/" + "p" * 5000, "http://example.org/es/\n/x",
]


def split(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    lower = host.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))
    return lower, re.match(r"[^?#]*", rest[len(host) :])[0]


def judged(url, rules, default="allow"):
    host, path = split(url)
    best = None
    for verdict, rule in rules:
        rule_host, slash, tail = rule.partition("/")
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith("/" + tail):
            size = (len(rule_host) + 1 + len(tail), rule_host.count("."), verdict)
            one = (size, f"{rule_host}/{tail}", verdict)
            best = max(best or one, one)
    return (host, path, *(best[1:] if best else (None, default)))


def pages(spark, urls):
    table = {"page_id": pa.array(range(len(urls)), pa.int64()), "url": pa.array(urls, pa.string())}
    table |= {name: pa.array(["?"] * len(urls), pa.string()) for name in ("host", "path", "rule", "row", "short", "digest", "won")}
    return spark.createDataFrame(pa.table(table))


def rule_frame(spark, rules):
    names = ("verdict", "rule")
    return spark.createDataFrame(pa.table({n: pa.array([r[i] for r in rules], pa.string()) for i, n in enumerate(names)}))


def compare(spark, rules, monkeypatch=None):
    urls = URLS + ["http://m.example.org/es/1"] * 30
    found = url_filters.judge_urls(pages(spark, urls), rule_frame(spark, rules)).collect()
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in found}
    kept = [r for r in rules if r[0] in ("allow", "block") and r[1]]
    assert len(found) == len(urls)
    assert got == {i: judged(url, kept) for i, url in enumerate(urls)}


def test_rules(spark):
    compare(spark, URL_RULES)


def test_ties_nulls_and_disagreement(spark):
    compare(spark, [*URL_RULES, ("block", "org/"), (None, "com/"), ("allow", None), ("odd", "com/"), ("block", "a.example.org/es/x")])


def test_shuffled_rules(spark, monkeypatch):
    monkeypatch.setattr(url_filters, "BROADCAST_CHARACTERS", 0)
    compare(spark, URL_RULES)


def test_no_rules_and_no_pages(spark):
    compare(spark, [])
    assert url_filters.judge_urls(pages(spark, []), rule_frame(spark, URL_RULES)).count() == 0


def captures(frame, rows):
    schema = "record_id long, url string, captured_at long, status int, etag string, size string, digest string, key string, chunk string"
    df = frame(schema, [(*r, "?", "?") for r in rows])
    headers = "map('ETag', etag, 'Content-Length', size, 'X-' || record_id, 'own')"
    return df.selectExpr("*", f"CASE WHEN etag IS NOT NULL OR size IS NOT NULL THEN {headers} END AS headers")


def test_revisits_by_brute_force(frame):
    rows = []
    for i in range(240):
        url = [None, "http://a.org/x", "https://www.a.org/x/#top", "http://b.org/?b=2&a=1", "https://b.org?a=1&utm_source=q&b=2", "c"][i % 6]
        status = [200, 304, 304, 404, None][i * 7 % 5]
        rows.append((i, url, None if i % 41 == 0 else (i * 37 % 50) * 1000, status, [None, "v1", "W/v1", "v2"][i * 3 % 4], str(i % 3), [None, "d"][i % 2]))
    found = {r.record_id: r for r in revisits.resolve_revisits(captures(frame, rows), chunk=7000).collect()}
    assert len(found) == len(rows)
    name = {None: None, "http://a.org/x": "a.org/x", "https://www.a.org/x/#top": "a.org/x", "c": None}
    plain = lambda etag: etag.removeprefix("W/") if etag else None
    for i, url, at, status, etag, size, digest in rows:
        r, own = found[i], name.get(url, "b.org?a=1&b=2")
        assert r.canonical_url == own
        time = -(1 << 62) if at is None else at
        earlier = [
            (-(1 << 62) if x[2] is None else x[2], x[0], x) for x in rows
            if x[3] == 200 and own and name.get(x[1], "b.org?a=1&b=2") == own and (-(1 << 62) if x[2] is None else x[2]) < time
        ]
        if status != 304:
            assert (r.outcome, r.refers_to, r.status) == ("full" if status == 200 else "other", None, status)
        elif not earlier:
            assert (r.outcome, r.refers_to, r.status) == ("no_response", None, 304)
        else:
            last = max(earlier)[2]
            pairs = [(plain(etag), plain(last[4])), (digest, last[6])]
            both = [a == b for a, b in pairs if a and b]
            outcome = "mismatch" if not all(both) else "resolved" if both else "unverified"
            assert r.outcome == outcome
            assert r.refers_to == (None if outcome == "mismatch" else last[0])
            if outcome != "mismatch" and r.headers and last[5] is not None:
                assert r.headers.get("content-length") == last[5]  # how the revisit was sent is not merged
                assert r.headers.get(f"x-{i}") == "own" and r.headers.get(f"x-{last[0]}") == "own"


def test_no_captures(frame):
    assert revisits.resolve_revisits(captures(frame, [])).count() == 0


def test_all_values_of_a_header_stay_and_connection_fields_are_not_merged(spark):
    """Names in several cases, cookies, a null value, and fields that a Connection header names; a repeated row, a long url."""
    url = "http://example.org/" + "a" * 100_000
    captures = spark.sql(
        "SELECT * FROM VALUES (1L, 10L, 200, map('Set-Cookie', 'b, c', 'set-cookie', 'a', 'VIA', 'y', 'Via', 'x', 'Age', '1', 'N', NULL)), "
        "(2L, 20L, 304, map('Connection', 'close, X-Hop', 'x-hop', '1', 'age', '7', 'x-own', '2')) AS t(record_id, captured_at, status, headers)"
    ).selectExpr("*", f"'{url}' AS url", "CAST(NULL AS STRING) AS digest")
    found = revisits.resolve_revisits(captures.union(captures.where("record_id = 2"))).collect()
    own = {"set-cookie": "a\nb, c", "via": "x, y", "age": "1", "n": None}
    assert sorted((r.record_id, r.outcome, r.refers_to) for r in found if r.record_id == 2) == [(2, "unverified", 1)] * 2
    for r in found:
        assert r.headers == (own if r.record_id == 1 else own | {"age": "7", "x-own": "2"})
    assert revisits.resolve_revisits(captures.limit(0)).count() == 0


def test_only_shapes_that_occur_are_expanded(spark):
    """Ten label counts and two hundred path lengths, but two hundred pairs of them; and no rules at all."""
    rows = [("block", ".".join("abcdefghij"[-(1 + i % 10) :]) + "/" + "x" * i) for i in range(200)]
    rules = spark.createDataFrame(pa.table({"verdict": [r[0] for r in rows], "rule": [r[1] for r in rows]}))
    host = "www." + ".".join("abcdefghij")
    pages = spark.createDataFrame(pa.table({"page_id": [1], "url": ["http://" + host + "/" + "x" * 300]}))
    (row,) = url_filters.judge_urls(pages, rules).collect()
    best = max((r for _, r in rows if ("." + host).endswith("." + r.split("/")[0])), key=len)
    assert (row.verdict, row.rule) == ("block", best)
    assert [r.verdict for r in url_filters.judge_urls(pages, rules.limit(0)).collect()] == ["allow"]
