"""Thin registered queries: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martcraft.llm import (
    op1_html,
    op2_minhash,
    op3_packing,
    op4_sentencepiece,
    op5_suffix,
    op6_urls,
    op7_quality,
    op8_toxicity,
    op9_imatch,
    op10_lines,
    op11_linededup,
    op12_search,
    op13_merkle,
)
from martcraft.llm.sampling import held_out

WORD_BPE = "word_bpe_49k.json"
PIECE_BPE = "piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1_html.extract(table(spark, sf_dir, "pages"))


def op2_minhash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=2, percent=80)


def op3_packing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op4_sentencepiece_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_sentencepiece.encode_digest(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_BPE))


def op5_suffix_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_suffix.digest(table(spark, sf_dir, "documents"), min_len=200)


URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
             ("org", "/fr/", "allow")]


def op6_urls_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return op6_urls.judge(table(spark, sf_dir, "pages"), rules)


def op7_quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = op7_quality.train(docs, table(spark, sf_dir, "labels"), "crc32(cast(id as string)) % 5 != 0")
    return op7_quality.score(docs, model).select(
        "doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score",
        (F.col("score") >= op7_quality.CUT).cast("int").alias("predicted"))


def op8_toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = op8_toxicity.train(docs, table(spark, sf_dir, "labels"), "crc32(cast(id as string)) % 4 != 2")
    return op8_toxicity.score(docs, model).select(
        "doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score",
        (F.col("score") >= op8_toxicity.CUT).cast("int").alias("predicted"))


def op9_imatch_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return op9_imatch.compare_with_edits(docs, op9_imatch.lexicon(docs))


def op10_lines_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return op10_lines.judge(docs, op10_lines.train(docs, table(spark, sf_dir, "labels")))


def op11_linededup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_linededup.digest(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)


def op12_search_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op13_merkle_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_merkle.verify(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_html": op1_html_query,
    "op2_minhash": op2_minhash_query,
    "op3_packing": op3_packing_query,
    "op4_sentencepiece": op4_sentencepiece_query,
    "op5_suffix": op5_suffix_query,
    "op6_urls": op6_urls_query,
    "op7_quality": op7_quality_query,
    "op8_toxicity": op8_toxicity_query,
    "op9_imatch": op9_imatch_query,
    "op10_lines": op10_lines_query,
    "op11_linededup": op11_linededup_query,
    "op12_search": op12_search_query,
    "op13_merkle": op13_merkle_query,
}

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

ORACLES: dict[str, str] = {
    "op6_urls": f"""
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), part AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), {_AZ}) AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), rules (rhost, rpath, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), hit AS (
  SELECT page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
         arg_max(verdict, length(rhost || rpath)) AS verdict
  FROM part JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY page_id
)
SELECT page_id, host, path, hit.rule AS rule, coalesce(hit.verdict, 'allow') AS verdict
FROM part LEFT JOIN hit USING (page_id)
""",
    "op11_linededup": r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT doc_id, line, pos, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), shared AS (
  SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
), judged AS (
  SELECT doc_id, line, pos, key IN (SELECT key FROM shared) AS gone FROM keyed
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
""",
    "op12_search": r"""
WITH words AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM documents
), wanted AS (
  SELECT DISTINCT item_id, translate(unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM benchmark
), sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS all_terms FROM sizes),
tfs AS (
  SELECT doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM wanted) GROUP BY doc_id, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tfs CROSS JOIN totals GROUP BY term, docs
), adds AS (
  SELECT tfs.doc_id, tfs.term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // all_terms))) AS part
  FROM tfs JOIN sizes ON sizes.doc_id = tfs.doc_id JOIN weights ON weights.term = tfs.term CROSS JOIN totals
), scored AS (
  SELECT item_id, doc_id, sum(part)::BIGINT AS score FROM wanted JOIN adds ON adds.term = wanted.term GROUP BY item_id, doc_id
)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
""",
    "op13_merkle": r"""
WITH RECURSIVE bits AS MATERIALIZED (
  -- crc32 of the decimal id, odd or even, byte by byte and bit by bit
  SELECT doc_id, list_reduce(
      list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ord(ch)::UBIGINT)),
      lambda crc, b: list_reduce(list_prepend(xor(crc, b), list_transform(range(8), lambda i: i::UBIGINT)),
          lambda v, i: xor(v >> 1, (v & 1) * 3988292384::UBIGINT))) & 1 AS low
  FROM documents
), fields AS (
  SELECT doc_id, source, text, low,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head
  FROM documents JOIN bits USING (doc_id)
), leaves AS MATERIALIZED (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN low = 1 THEN sha256(head || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-'))
         ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS now
  FROM fields
), placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS grp FROM leaves
), nodes AS (
  SELECT grp, 0 AS lvl, pos // 3 AS run, list(leaf ORDER BY pos) AS kids, count(*) OVER (PARTITION BY grp) AS runs
  FROM placed GROUP BY grp, pos // 3
  UNION ALL
  SELECT grp, lvl + 1, run // 3, list(sha256(array_to_string(kids, '')) ORDER BY run), count(*) OVER (PARTITION BY grp)
  FROM nodes WHERE runs > 1 GROUP BY grp, lvl, run // 3
), held AS MATERIALIZED (SELECT * FROM nodes),
subroots AS MATERIALIZED (
  SELECT grp, CASE WHEN len(kids) = 1 AND lvl = 0 THEN kids[1] ELSE sha256(array_to_string(kids, '')) END AS subroot
  FROM held WHERE runs = 1
), tops AS (
  SELECT 0 AS lvl, grp // 3 AS run, list(subroot ORDER BY grp) AS kids, count(*) OVER () AS runs FROM subroots GROUP BY grp // 3
  UNION ALL
  SELECT lvl + 1, run // 3, list(sha256(array_to_string(kids, '')) ORDER BY run), count(*) OVER ()
  FROM tops WHERE runs > 1 GROUP BY lvl, run // 3
), upper AS MATERIALIZED (SELECT * FROM tops),
top AS (
  SELECT CASE WHEN len(kids) = 1 AND lvl = 0 THEN kids[1] ELSE sha256(array_to_string(kids, '')) END AS root FROM upper WHERE runs = 1
), climb AS (
  SELECT doc_id, leaf, grp, pos, now, '' AS proof, 0 AS lvl FROM placed
  UNION ALL
  SELECT doc_id, leaf, c.grp, pos // 3,
    sha256(array_to_string(kids[:pos % 3], '') || now || array_to_string(kids[pos % 3 + 2:], '')),
    proof || array_to_string(kids[:pos % 3], '') || array_to_string(kids[pos % 3 + 2:], ''), c.lvl + 1
  FROM climb c JOIN held n ON n.grp = c.grp AND n.lvl = c.lvl AND n.run = c.pos // 3
  WHERE NOT (n.lvl = 0 AND n.runs = 1 AND len(kids) = 1)
), over AS (
  SELECT doc_id, leaf, grp, grp AS pos, now, proof, 0 AS lvl FROM climb QUALIFY row_number() OVER (PARTITION BY doc_id, leaf ORDER BY lvl DESC) = 1
  UNION ALL
  SELECT doc_id, leaf, grp, pos // 3,
    sha256(array_to_string(kids[:pos % 3], '') || now || array_to_string(kids[pos % 3 + 2:], '')),
    proof || array_to_string(kids[:pos % 3], '') || array_to_string(kids[pos % 3 + 2:], ''), c.lvl + 1
  FROM over c JOIN upper n ON n.lvl = c.lvl AND n.run = c.pos // 3
  WHERE NOT (n.lvl = 0 AND n.runs = 1 AND len(kids) = 1)
)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, now AS folded_root, now = root AS verified
FROM (SELECT * FROM over QUALIFY row_number() OVER (PARTITION BY doc_id, leaf ORDER BY lvl DESC) = 1)
JOIN subroots USING (grp) CROSS JOIN top
""",
}
