"""Each operator over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import automaton, bpe, hashlr, jaccard, line_join, prefix_trie, quality_rules, secret_scan, sharding, site_quality, tiling, vptree, warc, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op10_ring_shards")
def op10_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law rows: capacities without slack leave counts at most one apart."""
    out = sharding.ring_shards(table(spark, sf_dir, "documents"), "doc_id", "text", shards=8)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "arc")


def byte_bpe() -> tuple[str, str]:
    """(rank file, pre-token pattern) of the installed public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@query("op6_byte_bpe")
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), "doc_id", "text", *byte_bpe())


WARC_SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS b FROM pages
), d AS (
  SELECT page_id, octet_length(b) AS n, sha1(b) AS h FROM p
), g AS (
  SELECT n, h, max(page_id) AS first FROM d WHERE n >= 1000 GROUP BY n, h
)
SELECT d.page_id, CAST(d.n AS BIGINT) AS payload_bytes, d.h AS payload_digest,
  CASE WHEN g.first <> d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN g.first <> d.page_id THEN g.first END AS refers_to
FROM d LEFT JOIN g USING (n, h)
"""


@query("op7_warc", WARC_SQL)
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables have no capture time, so page ids serve as seconds."""
    ts = F.date_format(F.timestamp_seconds(F.coalesce(F.col("page_id"), F.lit(0))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    out = warc.round_trip(table(spark, sf_dir, "pages"), ts=ts)
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


THRESHOLD = 0.5  # probability of a good row from which a document is kept


def quality_model(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None) -> hashlr.Model:
    """A labelled row is good when it is of quality and not toxic."""
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    """A labelled row is good when it is of quality and not toxic."""
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    return hashlr.train(table(spark, sf_dir, "documents") if docs is None else docs, table(spark, sf_dir, "labels"), "doc_id", "text", good)


@query("op4_quality_rules")
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.verdicts(table(spark, sf_dir, "documents"), quality_model(spark, sf_dir), "doc_id", "text", THRESHOLD)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good")


@query("op1_site_quality")
def op1_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table has no URLs: its source is the host, its language the path below."""
    docs = table(spark, sf_dir, "documents")
    out = site_quality.classify(docs, quality_model(spark, sf_dir), "text", "source", "lang", THRESHOLD, ["doc_id"])
    return out.select("row.doc_id", "kept", "p_good", "evidence", "host_share", "path_share")


@query("op5_secret_scan")
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(table(spark, sf_dir, "documents"), "doc_id", "text")


@query("op2_string_tiling")
def op2_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = tiling.contamination(table(spark, sf_dir, "documents"), ["doc_id"], "text", table(spark, sf_dir, "benchmark"), "item_id", "text")
    return out.withColumn("kept", ~F.col("contaminated"))


@query("op9_line_join")
def op9_line_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_join.removals(table(spark, sf_dir, "documents"), "doc_id", "text")


WORDS_SQL = r"regexp_extract_all(coalesce({t}, ''), '[^\x20\x09-\x0D]+')"
WINDOWS_SQL = rf"""
WITH w AS (SELECT doc_id, {WORDS_SQL.format(t='text')} AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM w WHERE len(w) >= 35),
h AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS k FROM p),
r AS (SELECT doc_id, i FROM h WHERE k IN (SELECT k FROM h GROUP BY k HAVING count(*) > 1)),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM r),
each AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n FROM each ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""
JACCARD_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, {WORDS_SQL.format(t="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents
), p AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS k FROM p),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM c JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 75 * (a.n + b.n - c)),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
reach AS (SELECT doc_id, doc_id AS other FROM w UNION SELECT reach.doc_id, e.y FROM reach JOIN e ON e.x = reach.other)
SELECT doc_id, coalesce(n, 0) AS n_shingles, min(other) AS component_id FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id, n
"""


@query("op3_ngram_jaccard", JACCARD_SQL)
def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = jaccard.classes(table(spark, sf_dir, "documents"), "doc_id", "text")
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


@query("op8_suffix_automaton", WINDOWS_SQL)
def op8_suffix_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return automaton.digests(table(spark, sf_dir, "documents"), "doc_id", "text")


@query("op11_whitening")
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", components=16)


NEAREST_SQL = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(c.e) = len(q.e)
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM r WHERE rank <= 5
"""


@query("op13_vantage_point", NEAREST_SQL)
def op13_vantage_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Factor 1: exact."""
    rows = vptree.index(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    out = vptree.neighbours(rows.filter(F.col("id") % 50 == 0), rows, k=5, factor=1.0)
    return out.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


TRIE_SQL = """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, encode(coalesce(role, '')) AS r, encode(coalesce(text, '')) AS x,
    turn FROM conversations WHERE conv_id IS NOT NULL
), p AS (
  SELECT conv_id, length(text) AS chars, sha256(concat(octet_length(r), ':', role, text)) AS d,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(concat(octet_length(r), ':', role, text))) AS pos
  FROM t
), b AS (
  SELECT DISTINCT conv_id, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ord(s) AS BIGINT))),
    lambda c, s: list_reduce(list_prepend(xor(c, s), range(8)), lambda y, i: CASE WHEN y % 2 = 1 THEN xor(y // 2, 3988292384) ELSE y // 2 END))) % 6 AS h
  FROM t
), q AS (
  SELECT b.conv_id, 0 AS part, pos, d, chars FROM b JOIN p s ON s.conv_id = b.conv_id - b.conv_id % 100 AND s.pos <= b.h
  UNION ALL SELECT conv_id, 1, pos, d, chars FROM p JOIN b USING (conv_id) WHERE pos > h
), o AS (
  SELECT conv_id, d, chars, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth,
    row_number() OVER (PARTITION BY conv_id ORDER BY part DESC, pos DESC) = 1 AS last FROM q
), l AS (
  SELECT a.conv_id, a.depth, any_value(a.chars) AS chars, any_value(a.last) AS last, string_agg(z.d, '' ORDER BY z.depth) AS k, any_value(a.d) AS d
  FROM o a JOIN o z ON z.conv_id = a.conv_id AND z.depth <= a.depth GROUP BY a.conv_id, a.depth
), s AS (
  SELECT conv_id, depth, chars, last, k, left(k, 64 * (depth - 1)) AS up FROM l
  UNION ALL SELECT conv_id, 0, 0, conv_id NOT IN (SELECT conv_id FROM o), '', NULL FROM b
), n AS (
  SELECT k, any_value(up) AS up, depth, any_value(chars) AS chars, count(*) AS n_convs, min(conv_id) AS conv_id,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE last), '')) AS ends_sha256
  FROM s GROUP BY k, depth
), c AS (SELECT up AS k, count(*) AS n_children FROM n WHERE up IS NOT NULL GROUP BY up),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN c USING (k)),
w AS (SELECT unnest(range(0, depth + 1)) AS pos, k, depth, (n_convs - 1) * chars AS w, n_children = 0 AS leaf FROM m),
g AS (SELECT left(k, 64 * pos) AS k, count(*) FILTER (WHERE leaf) AS n_leaves, sum(w) AS saved FROM w GROUP BY 1)
SELECT m.conv_id, CAST(m.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, m.n_convs, m.n_children, g.n_leaves, CAST(g.saved AS BIGINT) AS saved_tokens, m.ends_sha256
FROM m JOIN g USING (k) LEFT JOIN m u ON u.k = m.up
"""


@query("op12_prefix_trie", TRIE_SQL)
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))
