"""One query per operator, over its whole table, and the SQL it must agree with where SQL can say it."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobstrata.llm import (
    alignment, bpe, exact_dedup, fingerprints, language_id, line_dedup, merkle, packing, pii, quality, simhash_dedup, url_filter,
    warc,
)
from jobstrata.llm.common import crc_rest, documents, table

Run = Callable[[SparkSession, str], DataFrame]


def vocabulary() -> str:
    """The public vocabulary that the contracts name."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _digests(own: bpe.Encoder, ids: np.ndarray) -> tuple[int, str, str]:
    numbers, text = hashlib.sha256(), hashlib.sha256()
    for part in own.joined(ids, decoded=False):
        numbers.update(part)
    for part in own.joined(ids, decoded=True):
        text.update(part)
    return len(ids), numbers.hexdigest(), text.hexdigest()


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(crc_rest("doc_id", 4) == 2, F.lit(False))
    model = language_id.learn(docs.filter(~held_out))
    return language_id.predict(docs, model, ["doc_id", held_out.alias("held_out")])


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(documents(spark, sf_dir))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_edited(documents(spark, sf_dir), every=100)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(crc_rest("doc_id", 5) == 0, F.lit(False))
    return quality.classify(documents(spark, sf_dir), table(spark, sf_dir, "labels"), held_out)


# Fixed values of the contract.
URL_RULES = [
    url_filter.Rule("allow", "com/"),
    url_filter.Rule("block", "example.com/en/"),
    url_filter.Rule("allow", "www.example.com/en/"),
    url_filter.Rule("block", "net/es/"),
    url_filter.Rule("block", "net/fr/"),
]


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    names, types = ["n_tokens", "ids_sha256", "decoded_sha256"], ["long", "string", "string"]
    return bpe.map_ids(documents(spark, sf_dir), vocabulary(), _digests, names, types)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a response record, and its two derived records with what links them."""
    source = warc.responses(table(spark, sf_dir, "pages"), "2024-01-01T00:00:00Z", ["page_id"])
    rows = warc.derive(source, ["page_id"])
    return rows.select(
        "page_id", "warc_type", "record_id", "target_uri", "warc_date", "content_type",
        F.col("headers")["WARC-Refers-To"].alias("refers_to"),
        F.col("headers")["Source-Payload-Digest"].alias("source_payload_digest"),
        F.col("headers")["WARC-Block-Digest"].alias("block_digest"),
        F.length("block").cast("long").alias("block_bytes"),
        F.decode("block", "UTF-8").alias("content"),
    )


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.deduplicate(documents(spark, sf_dir))


# The same rule on the tokens themselves, without hashes.
OP8_SQL = r"""
WITH l AS (
  SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS pos, unnest(string_split(text, chr(10))) AS line
  FROM documents WHERE text IS NOT NULL),
t AS (
  SELECT doc_id, pos, line, list_filter(regexp_split_to_array(regexp_replace(line, '[^ 	-
]*[0-9][^ 	-
]*', '<*>', 'g'), '[ 	-
]+'), lambda x: x <> '') AS t
  FROM l),
n AS (SELECT *, len(t) AS n, len(t) - 2 AS r FROM t WHERE len(t) >= 5),
k AS (
  SELECT doc_id, pos, -1 AS span, n, t AS key FROM n
  UNION ALL
  SELECT doc_id, pos, s AS span, n, list_concat(t[1:2 + (r * s) // 4], t[3 + (r * (s + 1)) // 4:n]) AS key
  FROM n, (VALUES (0), (1), (2), (3)) v(s) WHERE n >= 8),
f AS (SELECT span, n, key, min(doc_id) AS first FROM k GROUP BY ALL),
gone AS (SELECT DISTINCT doc_id, pos FROM k JOIN f USING (span, n, key) WHERE k.doc_id > f.first),
o AS (
  SELECT l.doc_id, string_agg(CASE WHEN g.pos IS NULL THEN line END, chr(10) ORDER BY l.pos) AS text, count(*) AS n_lines, count(g.pos) AS n_dropped
  FROM l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.pos = g.pos GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(o.text, '') END AS text, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped
FROM documents d LEFT JOIN o USING (doc_id)
"""


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), vocabulary())


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.find_duplicates(documents(spark, sf_dir))


OP10_SQL = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t FROM documents),
r AS (SELECT doc_id, t, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size
      FROM d WINDOW w AS (PARTITION BY t ORDER BY n DESC, doc_id))
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM r
"""


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(documents(spark, sf_dir))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    a, b = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.compare(documents(spark, sf_dir), a, b)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(documents(spark, sf_dir), merkle.third_of_ids())


# Trees level by level; crc32 bit by bit, as there is no function for it.
OP13_SQL = r"""
WITH RECURSIVE d AS (
  SELECT *, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
    lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda y, i: xor(y >> 1, 3988292384::BIGINT * (y & 1)))) AS crc
  FROM documents),
v AS (
  SELECT doc_id, lang, coalesce(xor(crc, 4294967295) % 3 = 0, false) AS hit, text,
    coalesce(octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-')
    || coalesce(octet_length(encode(lang)) || ':' || lang, '-') || coalesce(octet_length(encode(n_chars::VARCHAR)) || ':' || n_chars, '-') AS head
  FROM d),
l AS (
  SELECT doc_id, lang, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
    CASE WHEN hit THEN sha256(head || coalesce(octet_length(encode(text)) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS altered
  FROM v),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM l),
t AS (
  SELECT 0 AS level, lang, pos, leaf AS node, count(*) OVER (PARTITION BY lang) AS n FROM r
  UNION ALL
  SELECT level + 1, lang, pos // 8, sha256(string_agg(node, '' ORDER BY pos)), (any_value(n) + 7) // 8 FROM t WHERE n > 1 GROUP BY level, lang, pos // 8),
s AS (SELECT lang, level AS height, node AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (
  SELECT 0 AS level, place AS pos, subroot AS node, n FROM s
  UNION ALL
  SELECT level + 1, pos // 8, sha256(string_agg(node, '' ORDER BY pos)), (any_value(n) + 7) // 8 FROM u WHERE n > 1 GROUP BY level, pos // 8),
nodes AS (
  SELECT lang, level, pos // 8 AS run, pos % 8 AS digit, node FROM t WHERE n > 1
  UNION ALL
  SELECT s.lang, s.height + u.level, u.pos // 8, u.pos % 8, u.node FROM s JOIN u ON u.n > 1),
runs AS (SELECT lang, level, run, list(node ORDER BY digit) AS sib FROM nodes GROUP BY lang, level, run),
f AS (
  SELECT doc_id, r.lang, leaf, coalesce(altered, leaf) AS node, 0 AS level, pos, '' AS proof FROM r
  UNION ALL
  SELECT doc_id, f.lang, leaf,
    sha256(array_to_string(list_concat(list_slice(sib, 1, own), [f.node], list_slice(sib, own + 2, 8)), '')), f.level + 1, up,
    proof || array_to_string(list_concat(list_slice(sib, 1, own), list_slice(sib, own + 2, 8)), '')
  FROM (
    SELECT f.*, s.height, s.place, CASE WHEN f.level = s.height THEN s.place ELSE f.pos END AS here, here % 8 AS own, here // 8 AS up
    FROM f JOIN s ON f.lang IS NOT DISTINCT FROM s.lang) f
  JOIN runs ON f.lang IS NOT DISTINCT FROM runs.lang AND f.level = runs.level AND f.here // 8 = runs.run)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, f.node AS folded_root, f.node = root AS verified
FROM f JOIN s ON f.lang IS NOT DISTINCT FROM s.lang, (SELECT node AS root, level AS top FROM u WHERE n = 1)
WHERE f.level = s.height + top
"""


def queries() -> dict[str, Run]:
    return {
        "op1_language_id": op1_language_id,
        "op2_simhash_dedup": op2_simhash_dedup,
        "op3_fingerprints": op3_fingerprints,
        "op4_quality": op4_quality,
        "op5_url_filter": op5_url_filter,
        "op6_bpe": op6_bpe,
        "op7_warc": op7_warc,
        "op8_line_dedup": op8_line_dedup,
        "op9_packing": op9_packing,
        "op10_exact_dedup": op10_exact_dedup,
        "op11_pii": op11_pii,
        "op12_token_alignment": op12_token_alignment,
        "op13_merkle_manifest": op13_merkle_manifest,
    }


def oracle_sql() -> dict[str, str]:
    return {"op8_line_dedup": OP8_SQL, "op10_exact_dedup": OP10_SQL, "op13_merkle_manifest": OP13_SQL}
