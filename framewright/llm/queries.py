"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TOKENIZER = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    from framewright.llm.token_store import read_store, write_store

    return read_store(write_store(_table(spark, sf_dir, "documents"), tokenizer(), end_id=1))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from framewright.llm.bpe import digests

    return digests(_table(spark, sf_dir, "documents"), tokenizer())


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from framewright.llm.repeats import report

    return report(_table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from framewright.llm.mixing import mix_report

    return mix_report(_table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from framewright.llm.toxicity import report

    return report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from framewright.llm.secrets import report

    return report(_table(spark, sf_dir, "documents"))


def op7_flac(spark: SparkSession, sf_dir: str) -> DataFrame:
    from framewright.llm.common import materialize
    from framewright.llm.flac import features, to_media

    # Large pages and a higher level let the writer see copies of a stream.
    stored = {"parquet.compression.codec.zstd.level": "9", "parquet.page.size": str(8 << 20)}
    return features(materialize(to_media(_table(spark, sf_dir, "documents")), "flac-media", **stored))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from framewright.llm.topk import quantize, search

    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", quantize(F.col("embedding")).alias("v"))
    return search(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from framewright.llm.near_dedup import report

    return report(_table(spark, sf_dir, "documents"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from framewright.llm.html_text import extract

    return extract(_table(spark, sf_dir, "pages"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from framewright.llm.whitening import report

    return report(_table(spark, sf_dir, "embeddings"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from framewright.llm.prefix_trie import report

    return report(_table(spark, sf_dir, "conversations"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from framewright.llm.warc import report

    return report(_table(spark, sf_dir, "pages"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_token_store": op1_token_store, "op2_bpe": op2_bpe, "op3_repeats": op3_repeats, "op4_mixing": op4_mixing, "op5_toxicity": op5_toxicity, "op6_secrets": op6_secrets, "op7_flac": op7_flac, "op8_topk": op8_topk, "op9_near_dedup": op9_near_dedup, "op10_html_text": op10_html_text, "op11_whitening": op11_whitening, "op12_prefix_trie": op12_prefix_trie, "op13_warc": op13_warc}


TOPK_SQL = """
WITH q AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND NOT list_bool_or(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)))
), pairs AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_dot_product(CAST(a.v AS DOUBLE[]), CAST(b.v AS DOUBLE[])) AS BIGINT) AS score
  FROM q a JOIN q b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM pairs QUALIFY rank <= 5
"""

MIXING_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    CAST(concat('0x', substr(md5(concat_ws(':', '20', coalesce(CAST(doc_id AS VARCHAR), '-'), coalesce(source, '-'), coalesce(text, '-'))), 1, 15)) AS BIGINT) AS key
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS words, CAST([5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS w FROM d GROUP BY source
), r AS (
  SELECT *, 1.5 * sum(words) OVER () AS total, row_number() OVER (ORDER BY words / w, source) AS n FROM s
), c AS (
  SELECT *, bool_and(2.0 * words < w * (total - 2.0 * before) / after) OVER (ORDER BY n) AS capped FROM (
    SELECT *, coalesce(sum(words) OVER (ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
      sum(w) OVER (ORDER BY n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS after FROM r)
), t AS (
  SELECT source, words, CASE WHEN capped THEN 2.0 * words ELSE
    w * (total - 2.0 * coalesce(sum(words) FILTER (capped) OVER (), 0)) / sum(w) FILTER (NOT capped) OVER () END AS target FROM c
), q AS (
  SELECT t.source, words, target, CASE WHEN words > 0 THEN CAST(floor(target / words) AS BIGINT) ELSE 0 END AS passes,
    greatest((docs + 255) // 256, least(docs, 64)) AS n_blocks, docs FROM t JOIN (SELECT source, count(*) AS docs FROM d GROUP BY source) n ON t.source IS NOT DISTINCT FROM n.source
), k AS (
  SELECT d.*, q.words, q.target, q.passes, q.target - q.passes * q.words AS rest, ((key >> 29) * n_blocks) >> 31 AS block, CAST(ceil(CAST(256 AS DOUBLE) * n_blocks / docs) AS BIGINT) AS zone
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source
), b AS (
  SELECT source, block, rest, w, sum(w) OVER (PARTITION BY source ORDER BY block) - w AS ahead FROM (SELECT source, block, rest, sum(size) AS w FROM k GROUP BY source, block, rest)
), e AS (
  SELECT source, block, CAST(floor(rest - ahead + 0.5) AS BIGINT) AS missing FROM b WHERE ahead <= rest AND ahead + w > rest
), x AS (
  SELECT source, key, words, row_number() OVER (PARTITION BY source ORDER BY words DESC, key) AS n FROM (
    SELECT k.source, k.key, sum(k.size) AS words FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source AND k.block >= e.block AND k.block < e.block + k.zone WHERE k.size > 0 GROUP BY k.source, k.key)
), g AS (
  SELECT source, CAST(0 AS BIGINT) AS n, missing AS room, CAST(NULL AS BIGINT) AS key, CAST(NULL AS BIGINT) AS over, CAST(NULL AS BIGINT) AS over_key FROM e
  UNION ALL
  SELECT g.source, x.n, CASE WHEN x.words <= room THEN CAST(room - x.words AS BIGINT) ELSE room END, CASE WHEN x.words <= room THEN x.key END,
    CASE WHEN x.words <= room THEN over ELSE CAST(x.words AS BIGINT) END, CASE WHEN x.words <= room THEN over_key ELSE x.key END
  FROM g JOIN x ON g.source IS NOT DISTINCT FROM x.source AND x.n = g.n + 1
), y AS (
  SELECT key FROM g WHERE key IS NOT NULL
  UNION ALL
  SELECT over_key FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC) AS back FROM g) WHERE back = 1 AND over < 2 * room
)
SELECT k.doc_id, k.size, k.words AS source_size, k.target,
  CAST(k.passes * k.size + CASE WHEN k.block < e.block OR k.key IN (SELECT key FROM y) THEN k.size ELSE 0 END AS BIGINT) AS taken
FROM k LEFT JOIN e ON k.source IS NOT DISTINCT FROM e.source
"""


def _spans_sql(pattern: str, kind: int, keep: str, values: str = "m") -> str:
    """SQL list of (start, kind, end) structs of a pattern's matches, from the lengths of matches and gaps."""
    return f"""list_filter(list_transform(range(1, len({values}) + 1), lambda i: struct_pack(
      start := CAST(coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT),
      kind := {kind}, stop := CAST(coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0) + list_sum(list_transform(m[1:i], lambda x: length(x))) AS BIGINT),
      v := {values}[i])), lambda s: {keep})"""


def _secrets_sql() -> str:
    from framewright.llm import secrets as S

    quote = lambda p: p.replace("'", "''")
    shaped = "regexp_full_match(s.v, '[A-Za-z0-9+/]{40}') AND regexp_matches(s.v, '[A-Z]') AND regexp_matches(s.v, '[a-z]') AND regexp_matches(s.v, '[0-9]')"
    kinds = [(S.ASSIGN, "length(s.v) >= 8", 2), (S.ACCESS, "true", 0), (S.HEX, "true", 0), (r"[A-Za-z0-9+/]{40,}", shaped, 0), (S.IDENT, "true", 0), (S.ENDPOINT, "true", 0)]
    parts = []
    for i, (pattern, keep, group) in enumerate(kinds):
        p = quote(pattern)
        found = _spans_sql(p, i, keep, "vs" if group else "m")
        values = f", regexp_extract_all(t, '{p}', {group}) AS vs" if group else ""
        parts.append(f"s{i} AS (SELECT n, {found} AS s{i} FROM (SELECT n, regexp_extract_all(t, '{p}') AS m, string_split_regex(t, '{p}') AS g{values} FROM d))")
    near = lambda a, others: f"len(list_filter({others}, lambda b: b.start <= {a}.stop + {S.SCOPE} AND b.stop >= {a}.start - {S.SCOPE} AND (b.stop <= {a}.start OR b.start >= {a}.stop))) > 0"
    shown = lambda spans: f"array_to_string(list_transform(list_sort({spans}), lambda x: concat([{', '.join(repr(k) for k in S.KINDS)}][x.kind + 1], ':', x.start, ':', x.stop)), ',')"
    return f"""WITH d AS (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS t FROM documents), {', '.join(parts)},
a AS (SELECT * FROM d JOIN s0 USING (n) JOIN s1 USING (n) JOIN s2 USING (n) JOIN s3 USING (n) JOIN s4 USING (n) JOIN s5 USING (n)),
l AS (SELECT doc_id, s0, s1, s2, list_concat(s0, list_concat(s1, s2)) AS base,
  list_concat(list_filter(s3, lambda a: {near("a", "list_concat(list_concat(s1, s4), s5)")}),
    list_concat(list_filter(s4, lambda a: {near("a", "list_concat(list_concat(s0, s2), s3)")}),
      list_filter(s5, lambda a: {near("a", "list_concat(list_concat(s0, s2), s3)")} AND {near("a", "list_concat(s1, s4)")}))) AS linked FROM a)
SELECT doc_id, len(s0) AS n_assign, len(s1) AS n_access, len(s2) AS n_hex, sha256({shown("base")}) AS base_sha256, {shown("list_concat(base, linked)")} AS spans FROM l"""


WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
g AS (SELECT *, CASE WHEN strlen(t) >= 1000 THEN max(page_id) OVER (PARTITION BY t) END AS keeper FROM p)
SELECT page_id, CAST(strlen(t) AS BIGINT) AS payload_bytes, sha1(t) AS payload_digest,
  CASE WHEN keeper IS NULL OR page_id IS NOT DISTINCT FROM keeper THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN keeper IS NOT NULL AND page_id IS DISTINCT FROM keeper THEN keeper END AS refers_to
FROM g
"""


#: The crc step of one byte, bit by bit.
TRIE_SQL = """
WITH t AS (
  SELECT conv_id, turn, md5(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS size
  FROM conversations WHERE conv_id IS NOT NULL
), o AS (
  SELECT conv_id, list(id ORDER BY turn NULLS FIRST, id) AS ids, list(size ORDER BY turn NULLS FIRST, id) AS sizes FROM t GROUP BY conv_id
), c AS (
  SELECT *, CAST(xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda a, b: list_reduce(list_prepend(xor(a, b), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])), lambda r, z: xor(r >> 1, 3988292384 * (r & 1)))), 4294967295) % 9 AS BIGINT) AS h FROM o
), r AS (
  SELECT c.conv_id, list_concat(coalesce(b.ids[1:h], CAST([] AS VARCHAR[])), c.ids[h + 1:]) AS ids, list_concat(coalesce(b.sizes[1:h], CAST([] AS BIGINT[])), c.sizes[h + 1:]) AS sizes
  FROM c LEFT JOIN o b ON b.conv_id = c.conv_id - c.conv_id % 5
), m AS (
  SELECT conv_id, d AS depth, md5(array_to_string(ids[1:d], '')) AS key, md5(array_to_string(ids[1:d - 1], '')) AS up, CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS size, len(ids) = d AS ends
  FROM (SELECT *, unnest(range(len(ids) + 1)) AS d FROM r)
), n AS (
  SELECT depth, key, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM m GROUP BY depth, key
), k AS (
  SELECT n.*, coalesce(x.kids, 0) AS n_children FROM n LEFT JOIN (SELECT depth - 1 AS depth, up AS key, count(*) AS kids FROM n WHERE depth > 0 GROUP BY depth, up) x USING (depth, key)
), s AS (
  SELECT a.depth, a.key, sum(CASE WHEN k.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((k.n_convs - 1) * k.size) AS saved_tokens
  FROM k JOIN m a ON a.conv_id = k.conv_id AND a.depth <= k.depth GROUP BY a.depth, a.key
)
SELECT k.conv_id, CAST(k.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(k.n_convs AS BIGINT) AS n_convs, CAST(k.n_children AS BIGINT) AS n_children,
  CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, k.ends_sha256
FROM k JOIN s USING (depth, key) LEFT JOIN n p ON p.depth = k.depth - 1 AND p.key = k.up AND k.depth > 0
"""


def oracle_sql() -> dict[str, str]:
    return {"op12_prefix_trie": TRIE_SQL, "op13_warc": WARC_SQL, "op4_mixing": MIXING_SQL, "op6_secrets": _secrets_sql(), "op8_topk": TOPK_SQL}
