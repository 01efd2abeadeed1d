"""The operators' queries over the driver's tables, and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from samplewright.llm import fertility, forest, licenses, linededup, mixing, neardup, neighbours, sharding, spm, urltrie

TOKENIZERS = "/opt/tokenizers"
PIECE_MODEL = f"{TOKENIZERS}/piece_bpe_32k.model"
MULTI_RANKS = f"{TOKENIZERS}/byte_bpe_multi_50k.tiktoken"

#: The rules of the url query: host, path, verdict.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
SHARDS = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"), licenses.common_templates(), licenses.Scan(bare=True))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spm.encode_texts(table(spark, sf_dir, "documents"), PIECE_MODEL)


def op3_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return forest.nearest(rows, rows.where("vec_id % 20 = 0"))


def op4_winnow_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def held_out(key: str = "doc_id") -> Column:
    """Rows whose labels aren't learned from."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))


def quality_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").where(~held_out()).select("doc_id", F.col("quality").alias("label"))


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = neighbours.score_texts(table(spark, sf_dir, "documents"), quality_labels(spark, sf_dir))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op6_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.judge_texts(table(spark, sf_dir, "documents"), PIECE_MODEL, more={MULTI_RANKS: fertility.MULTI_BANDS})


def op7_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, sf_dir, "documents"), neardup.Near(shingle=2))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op8_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_table(table(spark, sf_dir, "documents"), SHARDS).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op9_url_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urltrie.judge_urls(table(spark, sf_dir, "pages"), rules)


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_prefix_forest": op3_prefix_forest,
    "op4_winnow_lines": op4_winnow_lines,
    "op5_neighbours": op5_neighbours,
    "op6_fertility": op6_fertility,
    "op7_neardup": op7_neardup,
    "op8_jump_shards": op8_jump_shards,
    "op9_url_trie": op9_url_trie,
    "op10_mix": op10_mix,
}


def _jump_sql() -> str:
    """op8: the jump hash as one CTE for each step, CRC-32 byte by byte."""

    def crc(byte: int) -> int:
        for _ in range(8):
            byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)
        return byte

    table_sql = "[" + ", ".join(str(crc(b)) for b in range(256)) + "]"
    steps, last = [], "start"
    for n, out in ((SHARDS, "shard"), (SHARDS + 1, "grown")):
        steps.append(f"{out}0 AS (SELECT *, h::HUGEINT AS k, -1::BIGINT AS b, 0::BIGINT AS j FROM {last})")
        for i in range(n):
            grown = f"((k * {sharding.LCG} + 1) % 18446744073709551616)"
            steps.append(f"{out}{i + 1}a AS (SELECT * EXCLUDE (k), CASE WHEN j < {n} THEN {grown} ELSE k END AS k, j < {n} AS go FROM {out}{i})")
            steps.append(f"{out}{i + 1} AS (SELECT * EXCLUDE (b, j, go), CASE WHEN go THEN j ELSE b END AS b, CASE WHEN go THEN floor((j + 1)::DOUBLE * (2147483648::DOUBLE / ((k // 8589934592) + 1)::DOUBLE))::BIGINT ELSE j END AS j FROM {out}{i + 1}a)")
        steps.append(f"{out}_done AS (SELECT * EXCLUDE (k, b, j), b::INTEGER AS {out} FROM {out}{n})")
        last = f"{out}_done"
    return f"""
WITH start AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size,
    xor(list_reduce([CAST('0x' || x AS BIGINT) for x in regexp_extract_all(hex(encode(coalesce(text, ''))), '..')],
      lambda c, x: xor(c >> 8, {table_sql}[(xor(c, x) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT) AS text_crc32,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM documents
), {", ".join(steps)}
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY h, doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, grown AS grown_shard
FROM {last}"""


_URL_SQL = (
    """
WITH parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_replace(rest, '^[^/]*', '') AS path
  FROM (SELECT page_id, CASE WHEN contains(coalesce(url, ''), '://')
    THEN regexp_extract(url, '(?s)^.*?://([^?#]*)', 1) ELSE '' END AS rest FROM pages)
), rules(r_host, r_path, r_verdict) AS (VALUES """
    + ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
    + """)
SELECT page_id, host, path, rule, coalesce(r_verdict, 'allow') AS verdict FROM (
  SELECT page_id, host, path, r_host || r_path AS rule, r_verdict,
    row_number() OVER (PARTITION BY page_id ORDER BY length(r_host) DESC, length(r_path) DESC) AS n
  FROM parts LEFT JOIN rules ON (host = r_host OR suffix(host, '.' || r_host)) AND starts_with(path, r_path)
) WHERE n = 1"""
)

_MIX_SQL = r"""
WITH rows AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')), 1, 15))::BIGINT AS rank
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM rows GROUP BY source
), levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0))::DOUBLE
    / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
  FROM sources
  WINDOW before AS (ORDER BY (3 * source_size)::DOUBLE / weight::DOUBLE, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), shares AS (
  SELECT source, source_size, least((3 * source_size)::DOUBLE, weight::DOUBLE * max(level) OVER ()) AS target FROM levels
), budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3) ELSE 0 END::BIGINT AS whole FROM shares
), hashes AS (
  SELECT r.source, r.rank, sum(r.size)::BIGINT AS size FROM rows r GROUP BY r.source, r.rank
), running AS (
  SELECT h.source, h.rank, b.target - b.whole * b.source_size AS budget, h.size,
    sum(h.size) OVER (PARTITION BY h.source ORDER BY h.rank)::BIGINT AS after
  FROM hashes h JOIN budgets b ON h.source IS NOT DISTINCT FROM b.source
), cuts AS (
  SELECT source, rank + CASE WHEN after - budget < budget - (after - size) THEN 1 ELSE 0 END AS cut
  FROM running WHERE budget > 0 AND after > budget AND after - size <= budget
)
SELECT r.doc_id, r.size, b.source_size, b.target,
  r.size * (b.whole + CASE WHEN r.rank < coalesce(c.cut, 0) THEN 1 ELSE 0 END) AS taken
FROM rows r JOIN budgets b ON r.source IS NOT DISTINCT FROM b.source
LEFT JOIN cuts c ON r.source IS NOT DISTINCT FROM c.source"""

_LINES_SQL = r"""
WITH parts AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS parts FROM documents
), lines AS (
  SELECT doc_id, (pos - 1)::INTEGER AS pos, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS w
  FROM (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM parts)
), sums AS (
  SELECT *, sum(w) OVER (PARTITION BY doc_id ORDER BY pos)::BIGINT AS upto, sum(w) OVER (PARTITION BY doc_id)::BIGINT AS total
  FROM lines WHERE w > 0
), windows AS (
  SELECT 1 AS kind, doc_id, pos AS low, max(pos) OVER ahead AS high, list(line) OVER ahead AS content, total - (upto - w) >= 50 AS whole
  FROM sums WINDOW ahead AS (PARTITION BY doc_id ORDER BY upto - w RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING)
  UNION ALL
  SELECT 2, doc_id, min(pos) OVER behind, pos, list(line) OVER behind, upto >= 50
  FROM sums WINDOW behind AS (PARTITION BY doc_id ORDER BY upto RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)
), ordered AS (
  SELECT *, first_value(doc_id) OVER place AS of, first_value(high) OVER place AS of_high, row_number() OVER place AS n
  FROM windows WHERE whole WINDOW place AS (PARTITION BY kind, content ORDER BY doc_id, low, high)
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(CASE WHEN doc_id = of THEN greatest(low, of_high + 1) ELSE low END, high + 1)) AS pos
  FROM ordered WHERE n > 1
), kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE g.pos IS NULL) AS text, count(g.pos) AS n
  FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.pos = g.pos GROUP BY l.doc_id
)
SELECT d.doc_id, CASE WHEN coalesce(k.n, 0) = 0 THEN d.text ELSE coalesce(k.text, '') END AS text, coalesce(k.n, 0)::INTEGER AS n_deleted
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id"""

_NEAR_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) > 1 THEN list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) ELSE w END AS s FROM words
), items AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n + b.n) AS both_n, count(*) AS common FROM items a
  JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT a, b FROM shared WHERE 100 * common >= 80 * (both_n - common)
), edges AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(root, doc_id) AS (
  SELECT doc_id, doc_id FROM sets UNION SELECT r.root, e.b FROM reach r JOIN edges e ON e.a = r.doc_id
)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, r.component_id, s.doc_id = r.component_id AS kept
FROM sets s JOIN (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id) r ON s.doc_id = r.doc_id"""

SQL: dict[str, str] = {"op4_winnow_lines": _LINES_SQL, "op7_neardup": _NEAR_SQL, "op8_jump_shards": _jump_sql(), "op9_url_trie": _URL_SQL, "op10_mix": _MIX_SQL}
