"""One query per operator over its whole table, and SQL statements where SQL can say the same."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from storeloom.llm import (audit, bpe, fingerprints, langid, lines, merkle, neardup, packing, quality, repeats, tokenstore,
                           topk, urlfilter)
from storeloom.llm.common import shared_folder, table

URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/")]


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_edited(table(spark, sf_dir, "documents"))


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.filter("vec_id % 50 = 0"), k=5)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = urlfilter.rule_table(spark, URL_RULES)
    return urlfilter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode(table(spark, sf_dir, "documents"), ranks)
    return bpe.decode(encoded, ranks).select(
        "doc_id", F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.repeated_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", F.size("removed").alias("n_removed"), "removed")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), length=50)
    return cut.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                      F.shiftright(F.size("spans"), 1).cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return packed.select("doc_id", "start", F.floor(F.octet_length("ids") / 4).alias("length"),
                         F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = tokenstore.write(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                             f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}")
    read = store.read_all().select("part", "shard", "doc_id", "at", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    return read.join(store.starts(), ["part", "shard"]).select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "lang", "bits", "bound", "rejected")


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict(table(spark, sf_dir, "documents"), folds=5)


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify_tampered(table(spark, sf_dir, "documents"), every=7)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_fingerprints, op2_topk, op3_url_filter, op4_bpe, op5_line_dedup,
                                   op6_suffix_dedup, op7_packing, op8_token_store, op9_quality, op10_minhash,
                                   op11_filter_audit, op12_language_id, op13_merkle)}


SQL_TOPK = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS parts
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, v.vec_id,
         CAST(list_sum(list_transform(list_zip(q.parts, v.parts), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM usable q JOIN usable v ON q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
"""

SQL_URL_FILTER = """
WITH rules(verdict, host, path) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
         ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
split AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS host, rest FROM cut),
parts AS (
  SELECT page_id, translate(host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(host) + 1), '^[^?#]*') AS path
  FROM split),
best AS (
  SELECT p.page_id, arg_max(struct_pack(rule := r.host || r.path, verdict := r.verdict),
                            length(r.host) + length(r.path)) AS won
  FROM parts p JOIN rules r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  GROUP BY p.page_id)
SELECT p.page_id, p.host, p.path, won.rule AS rule, coalesce(won.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN best b USING (page_id)
"""


# Every window of 50 bytes as 100 hex digits, against the smallest document that has it.
SQL_SUFFIX_DEDUP = """
WITH docs AS (
  SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS digits FROM documents),
sized AS (
  SELECT doc_id, digits, CAST(length(digits) / 2 AS BIGINT) AS n_bytes FROM docs),
windows AS (
  SELECT doc_id, pos, substr(digits, 2 * pos + 1, 100) AS w
  FROM (SELECT doc_id, digits, unnest(range(n_bytes - 49)) AS pos FROM sized WHERE n_bytes >= 50)),
hits AS (
  SELECT doc_id, pos FROM (SELECT doc_id, pos, min(doc_id) OVER (PARTITION BY w) AS least FROM windows)
  WHERE least < doc_id),
bytes AS (
  SELECT doc_id, unnest(range(n_bytes)) AS pos FROM sized),
cover AS (
  SELECT b.doc_id, b.pos, b.pos - h.pos < 50 AND h.pos IS NOT NULL AS gone
  FROM bytes b ASOF LEFT JOIN hits h ON b.doc_id = h.doc_id AND b.pos >= h.pos),
edges AS (
  SELECT *, gone AND NOT lag(gone, 1, false) OVER (PARTITION BY doc_id ORDER BY pos) AS starts FROM cover),
counted AS (
  SELECT e.doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (starts) AS n_spans,
         coalesce(string_agg(substr(s.digits, 2 * e.pos + 1, 2), '' ORDER BY e.pos) FILTER (NOT gone), '') AS kept
  FROM edges e JOIN sized s USING (doc_id) GROUP BY e.doc_id)
SELECT s.doc_id, s.n_bytes, coalesce(c.n_removed, 0) AS n_removed, coalesce(c.n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(c.kept, ''))) AS kept_sha256
FROM sized s LEFT JOIN counted c USING (doc_id)
"""

# All pairs that share a shingle, and their transitive closure.
SQL_MINHASH = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 3),
           lambda i: array_to_string(list_slice(words, i, i + 4), ' '))) END AS shingles
  FROM split),
rows AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS s FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM rows a JOIN rows b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (
  SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
least AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT s.doc_id, CAST(len(s.shingles) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(l.y, s.doc_id)) AS component_id,
       s.doc_id <= coalesce(l.y, s.doc_id) AS kept
FROM sets s LEFT JOIN least l ON s.doc_id = l.x
"""


# Every order applied step by step to each document's failures.
SQL_FILTER_AUDIT = r"""
WITH split AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
fails AS (
  SELECT doc_id, part,
         [f FOR f IN [CASE WHEN len(words) < 200 THEN 'A' END,
           CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' END,
           CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 2 * length(text) THEN 'C' END,
           CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' END,
           CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' END] IF f IS NOT NULL] AS failed
  FROM split),
marks AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
  FROM labels GROUP BY doc_id),
marked AS (
  SELECT f.part, f.failed, coalesce(m.good, false) AS good, coalesce(m.toxic, false) AS toxic
  FROM fails f LEFT JOIN marks m USING (doc_id)),
letters(l) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
steps AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, substr(filter_order, step, 1) AS own,
         string_split(substr(filter_order, 1, step - 1), '') AS before
  FROM orders, range(1, 6) r(step)),
grouped AS (
  SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM marked GROUP BY part, failed),
results AS (
  SELECT part, filter_order, step, own,
         coalesce(sum(n) FILTER (NOT list_has_any(failed, before) AND NOT list_contains(failed, own)), 0) AS kept,
         coalesce(sum(n) FILTER (NOT list_has_any(failed, before) AND list_contains(failed, own)), 0) AS removed,
         coalesce(sum(n) FILTER (list_has_any(failed, before) AND list_contains(failed, own)), 0) AS redundant,
         coalesce(sum(n) FILTER (failed = [own]), 0) AS unique_fails,
         coalesce(sum(good) FILTER (NOT list_has_any(failed, before) AND list_contains(failed, own)), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (NOT list_has_any(failed, before) AND list_contains(failed, own)), 0) AS toxic_lost
  FROM grouped, steps GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM results
"""

# Level by level from the leaves; CRC-32 bit by bit, as there is no such function.
SQL_MERKLE = """
WITH RECURSIVE fields AS (
  SELECT doc_id, lang, n_chars,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') AS before,
         coalesce(strlen(text) || ':' || text, '-') AS after,
         list_concat([[ord(c), -1, -1, -1, -1, -1, -1, -1, -1] FOR c IN string_split(CAST(doc_id AS VARCHAR), '')]) AS bytes
  FROM documents),
leaves AS (
  SELECT doc_id, lang,
         sha256(before || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || after) AS leaf,
         sha256(before || coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') || after) AS changed,
         xor(4294967295, list_reduce(flatten(bytes), lambda c, b: CASE WHEN b >= 0 THEN xor(c, CAST(b AS BIGINT))
           ELSE xor(c >> 1, 3988292384 * (c & 1)) END, 4294967295)) % 7 = 0 AS struck,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
  FROM fields),
tree AS (
  SELECT 0 AS level, lang, pos, n, leaf AS digest FROM leaves
  UNION ALL
  SELECT level + 1, lang, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos))
  FROM tree WHERE n > 1 GROUP BY level, lang, pos // 2, n),
subroots AS (
  SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM tree WHERE n = 1),
upper AS (
  SELECT 0 AS level, pos, n, subroot AS digest FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos))
  FROM upper WHERE n > 1 GROUP BY level, pos // 2, n),
walk AS (
  SELECT doc_id, lang, 0 AS level, pos, n, '' AS siblings, CASE WHEN struck THEN changed ELSE leaf END AS folded
  FROM leaves
  UNION ALL
  SELECT w.doc_id, w.lang, w.level + 1, w.pos // 2, (w.n + 1) // 2, w.siblings || coalesce(t.digest, ''),
         sha256(CASE WHEN t.pos < w.pos THEN t.digest || w.folded ELSE w.folded || coalesce(t.digest, '') END)
  FROM walk w LEFT JOIN tree t ON t.lang IS NOT DISTINCT FROM w.lang AND t.level = w.level AND t.pos = xor(w.pos, 1)
  WHERE w.n > 1),
climb AS (
  SELECT w.doc_id, 0 AS level, s.pos, s.n, w.siblings, w.folded
  FROM walk w JOIN subroots s ON s.lang IS NOT DISTINCT FROM w.lang WHERE w.n = 1
  UNION ALL
  SELECT c.doc_id, c.level + 1, c.pos // 2, (c.n + 1) // 2, c.siblings || coalesce(t.digest, ''),
         sha256(CASE WHEN t.pos < c.pos THEN t.digest || c.folded ELSE c.folded || coalesce(t.digest, '') END)
  FROM climb c LEFT JOIN upper t ON t.level = c.level AND t.pos = xor(c.pos, 1) WHERE c.n > 1),
whole AS (SELECT digest AS root FROM upper WHERE n = 1)
SELECT l.doc_id, l.leaf, s.subroot, w.root, sha256(c.siblings) AS proof_sha256, c.folded AS folded_root,
       c.folded = w.root AS verified
FROM leaves l JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang
JOIN climb c ON c.doc_id = l.doc_id AND c.n = 1 CROSS JOIN whole w
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_topk": SQL_TOPK, "op3_url_filter": SQL_URL_FILTER, "op6_suffix_dedup": SQL_SUFFIX_DEDUP,
            "op10_minhash": SQL_MINHASH,
            "op11_filter_audit": SQL_FILTER_AUDIT, "op13_merkle": SQL_MERKLE}
