"""DuckDB twins of the queries that SQL expresses over whole tables.

op1, op2, op3, op5, op6, op8, op9, op10 and op13 have none: models, tokenizers, sampling and
fingerprints are not SQL, and quadratic comparisons are too slow there.  Their tests
compare with brute force, exact round trips or held-out labels.
"""

#: DuckDB has no CRC-32: its table of 256 entries by the rule of the polynomial, and a fold
#: of a word's UTF-8 bytes over it.
CRC_TABLE = """(SELECT list_transform(range(256), lambda n: list_reduce([0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END, n::BIGINT)))"""


def crc(text: str, table: str = "crc") -> str:
    """CRC-32 of a text column, given the table as a list column."""
    code = f"hex(encode({text}))"
    of_bytes = f"list_transform(range(1, length({code}), 2), lambda i: ('0x' || substr({code}, i, 2))::BIGINT)"
    return f"xor(4294967295::BIGINT, list_reduce({of_bytes}, lambda c, b: xor(c >> 8, {table}[xor(c & 255, b) + 1]), 4294967295::BIGINT))"


ORACLE = {
    "op4_block_naming": r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm FROM documents),
r AS (SELECT *, count(*) OVER (PARTITION BY norm) AS group_size,
             first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id) AS keep_id FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM r""",
    "op7_rare_tokens": r"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
s AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(action, h, p) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
f AS (SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(action, length(h || p)) AS action
      FROM s JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT s.page_id, host, path, f.rule, coalesce(f.action, 'allow') AS verdict FROM s LEFT JOIN f USING (page_id)""",
    "op11_overlapped_ngrams": rf"""
WITH lowered AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
d AS (SELECT doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM lowered),
b AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
f AS (SELECT doc_id, unnest(w) AS w FROM d),
x AS (SELECT {CRC_TABLE} AS crc),
buckets AS (SELECT w, {crc("w")} % 10000 AS k FROM (SELECT w FROM f UNION SELECT w FROM b), x),
s AS (SELECT k, count(*) AS s FROM f JOIN buckets USING (w) GROUP BY k),
t AS (SELECT k, count(*) AS t FROM b JOIN buckets USING (w) GROUP BY k),
n AS (SELECT (SELECT count(*) FROM f) AS s_all, (SELECT count(*) FROM b) AS t_all),
g AS (SELECT s.k, floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * (s_all + 10000) / ((s + 1.0::DOUBLE) * (t_all + 10000))))::BIGINT AS gain
      FROM s LEFT JOIN t USING (k), n),
weights AS (SELECT doc_id, sum(gain)::BIGINT AS weight FROM f JOIN buckets USING (w) JOIN g USING (k) GROUP BY doc_id),
h AS (SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
             ('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT AS h FROM d LEFT JOIN weights USING (doc_id)),
scores AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score, n_features >= 20 AS fit FROM h),
ranks AS (SELECT *, row_number() OVER (PARTITION BY fit ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY fit) AS n FROM scores)
SELECT doc_id, n_features, weight, score, CASE WHEN fit AND place <= 10 * n // 100 THEN place END AS rank FROM ranks""",
    "op12_sharded_warc": """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
r AS (SELECT *, row_number() OVER (PARTITION BY payload_digest ORDER BY page_id) AS n,
             first_value(page_id) OVER (PARTITION BY payload_digest ORDER BY page_id) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 100 AND n > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND n > 1 THEN first END AS refers_to FROM r""",
}
