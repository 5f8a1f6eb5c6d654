"""Chunking and retrieval over the document tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from surveyloom.functions.text import SUFFIXES, stop_list
from surveyloom.operators import chunk as H
from surveyloom.operators import retrieval as R
from surveyloom.plans.index import build_index, load_index, question_side
from surveyloom.sources import codebook as B
from surveyloom.sources.tables import cut, scratch_path, spread

from .audit import CODEBOOK, codebook
from .registry import check
from .respondents import table

STOP = stop_list(["the", "and", "of", "in", "is", "it", "to", "for", "with", "that", "this", "by", "are", "was", "on", "as", "at",
                  "an", "der", "die", "und", "den", "von", "zu", "le", "la", "les", "des", "du", "et", "que", "un", "une"])
_STOP_SQL = "[" + ", ".join(f"'{w}'" for w in STOP) + "]"


def tok(text: str, stop: bool = True) -> str:
    words = f"""list_transform(regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}_]+'), lambda x:
      CASE WHEN regexp_matches(x, '\\p{{N}}') THEN x ELSE regexp_replace(x, '^(.{{3,}}?)(?:{'|'.join(SUFFIXES)})$', '\\1') END)"""
    return f"list_filter({words}, lambda x: NOT list_contains({_STOP_SQL}, x))" if stop else words


def terms(toks: str) -> str:
    return f"list_concat({toks}, list_transform(range(1, len({toks})), lambda i: {toks}[i] || ' ' || {toks}[i + 1]))"


STRIP = "regexp_replace({x}, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g')"


def strip(x: str) -> str:
    return STRIP.format(x=x)


# ---- chunks --------------------------------------------------------------------
@check("R1_codebook_chunks", f"""WITH {CODEBOOK},
  b AS (SELECT *, CASE WHEN regexp_matches(variable_name, '^.+_[0-9]{{1,2}}$') THEN regexp_extract(variable_name, '^(.+?)_([0-9]{{1,2}})$', 1) ELSE variable_name END AS base FROM cb),
  g AS (SELECT variable_label AS lab, value_labels AS vl, list(variable_name ORDER BY variable_name) AS v, min(stata_type) AS ty FROM b GROUP BY base, variable_label, value_labels),
  e AS (SELECT *, len(v) AS n, list_transform(json_keys(CASE WHEN vl = '' THEN '{{}}' ELSE vl END), lambda k: k || ' = ' || json_extract_string(vl, '$."' || k || '"')) AS items FROM g)
  SELECT 'codebook:' || v[1] AS id, 'codebook' AS source,
    CASE WHEN n = 1 THEN v[1] || ': ' || lab ELSE v[1] || ' ... ' || v[-1] || ': ' || lab END AS title,
    CASE WHEN n = 1 THEN 'Variable ' || v[1] ELSE 'Variables ' || array_to_string(v, ', ') || ' (the same question repeated ' || n || ' times, once per slot, e.g. per child or per birth)' END
      || '. Description (codebook label): ' || lab || '. Stata type: ' || ty || '. Value labels: '
      || CASE WHEN vl = '' THEN 'no value labels (the values are numbers or text)' ELSE array_to_string(items, '; ') END || '.' AS text,
    array_to_string(v, ',') AS variables FROM e""")
def r1(spark, sf):
    ordered = codebook(spark, sf).withColumn("row", F.col("variable_name"))
    return B.codebook_chunks(ordered, "row", 30).withColumn("variables", F.array_join("variables", ","))


@check("R2_format_labels", """
  SELECT c_mktsegment AS variable, array_to_string(list_transform(list_slice(l, 1, 30), lambda x: x || ' = ' || x), '; ')
    || CASE WHEN len(l) > 30 THEN '; ... (' || len(l) || ' codes in total)' ELSE '' END AS labels
  FROM (SELECT c_mktsegment, list(DISTINCT c_nationkey * 10 + c_custkey % 3 ORDER BY c_nationkey * 10 + c_custkey % 3) AS l FROM customer GROUP BY 1)""")
def r2(spark, sf):
    codes = table(spark, sf, "customer").select("c_mktsegment", (F.col("c_nationkey") * 10 + F.col("c_custkey") % 3).alias("c")).distinct()
    pairs = F.transform(F.array_sort(F.collect_list("c")), lambda c: F.format_string('"%d":"%d"', c, c))
    packed = codes.groupBy(F.col("c_mktsegment").alias("variable")).agg(pairs.alias("p"))
    text = F.concat(F.lit("{"), F.array_join("p", ","), F.lit("}"))
    return packed.select("variable", B.format_labels(text, 30).alias("labels"))


def page_docs(spark, sf):
    """Pages as markdown: heading tags become heading lines, other tags disappear."""
    md = F.regexp_replace("html", r"(?s)<h[1-4][^>]*>(.*?)</h[1-4]>", "\n### $1\n")
    plain = F.regexp_replace(md, r"<[^>]*>", " ")
    page = table(spark, sf, "pages")
    name = F.concat(F.lit("page"), F.col("page_id").cast("string"))
    return page.select("page_id", F.col("url").alias("file"), name.alias("name"), name.alias("stem"), F.lit("web").alias("source"), plain.alias("text"))


PAGES_SQL = r"""
  pg AS (SELECT page_id, url, 'page' || page_id AS stem,
    regexp_replace(regexp_replace(html, '(?s)<h[1-4][^>]*>(.*?)</h[1-4]>', chr(10) || '### \1' || chr(10), 'g'), '<[^>]*>', ' ', 'g') AS text FROM pages),
  ln AS (SELECT page_id, stem, unnest(string_split_regex(regexp_replace(text, '\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}]', chr(10), 'g'), '\n')) AS line,
    generate_subscripts(string_split_regex(regexp_replace(text, '\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}]', chr(10), 'g'), '\n'), 1) AS i FROM pg),
  sec AS (SELECT *, sum(CASE WHEN regexp_matches(line, '^#{1,4} ') THEN 1 ELSE 0 END) OVER (PARTITION BY page_id ORDER BY i) AS s FROM ln),
  bod AS (SELECT page_id, s, any_value(stem) AS stem, max(CASE WHEN regexp_matches(line, '^#{1,4} ') THEN line END) AS head,
    """ + strip("string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT regexp_matches(line, '^#{1,4} '))") + r""" AS body FROM sec GROUP BY page_id, s),
  sections AS (SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY s) - 1 AS number,
    CASE WHEN head IS NULL THEN stem ELSE """ + strip("ltrim(head, '#')") + """ END AS heading, body FROM bod WHERE body <> '')"""


@check("R3_heading_sections", f"WITH {PAGES_SQL} SELECT page_id, CAST(number AS INT) AS number, heading, body FROM sections")
def r3(spark, sf):
    docs = page_docs(spark, sf)
    return docs.select("page_id", F.posexplode(H.sections("text", "stem")).alias("number", "s")).select(
        "page_id", "number", "s.heading", "s.body")


# Greedy packing of lines, written as a recursive walk over the lines of each document.
R4_SQL = f"""WITH RECURSIVE
  p AS (SELECT doc_id, text, string_split(text, chr(10)) AS ps FROM documents WHERE length(text) > 1800),
  walk AS (SELECT doc_id, ps, 0 AS i, '' AS cur, CAST(NULL AS VARCHAR) AS done FROM p
    UNION ALL
    SELECT doc_id, ps, i + 1,
      CASE WHEN cur <> '' AND length(cur) + length(ps[i + 1]) > 1800 THEN ps[i + 1] || chr(10) ELSE cur || ps[i + 1] || chr(10) END,
      CASE WHEN cur <> '' AND length(cur) + length(ps[i + 1]) > 1800 THEN {strip('cur')} END
    FROM walk WHERE i < len(ps)),
  pieces AS (SELECT doc_id, i, done AS piece FROM walk WHERE done IS NOT NULL
    UNION ALL SELECT doc_id, i + 1, {strip('cur')} FROM walk WHERE i = len(ps) AND {strip('cur')} <> '')
  SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INT) AS part, piece FROM pieces
  UNION ALL SELECT doc_id, 0, text FROM documents WHERE length(text) <= 1800"""


@check("R4_split_long_sections", R4_SQL)
def r4(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", F.posexplode(H.split_long("text", separator="\n")).alias("part", "piece"))


IDS = r"\b([a-z]{2,4}\d{1,5}|\d{2,})\b"


@check("R5_identifiers", f"WITH {PAGES_SQL} " + r"""
  SELECT page_id, CAST(number AS INT) AS number, array_to_string(list_sort(list_distinct(regexp_extract_all(heading || ' ' || body, '\b([a-z]{2,4}[0-9]{1,5}|[0-9]{2,})\b', 1))), ',') AS variables
  FROM sections""")
def r5(spark, sf):
    docs = page_docs(spark, sf)
    s = docs.select("page_id", F.posexplode(H.sections("text", "stem")).alias("number", "s"))
    found = H.identifiers(F.concat("s.heading", F.lit(" "), "s.body"), IDS)
    return s.select("page_id", "number", F.array_join(found, ",").alias("variables"))


@check("R3_R4_R5_markdown_chunks")
def r345(spark, sf):
    return H.markdown_chunks(page_docs(spark, sf), IDS).drop("metadata").withColumn("variables", F.array_join("variables", ","))


@check("R10_title_boost", """
  SELECT doc_id, md5(source || '-' || lang || '. ' || source || '-' || lang || '. ' || text) AS digest FROM documents""")
def r10(spark, sf):
    docs = table(spark, sf, "documents").withColumn("title", F.concat_ws("-", "source", "lang"))
    return docs.select("doc_id", F.md5(H.text_to_embed()).alias("digest"))


# ---- terms -----------------------------------------------------------------------
@check("R7_tokens", f"""
  SELECT doc_id, len(t) AS n_tokens, len(list_distinct(t)) AS n_distinct, md5(array_to_string(t, ' ')) AS digest
  FROM (SELECT doc_id, {tok('text', stop=False)} AS t FROM documents)""")
def r7(spark, sf):
    from surveyloom.functions.text import tokens

    t = table(spark, sf, "documents").select("doc_id", tokens("text").alias("t"))
    return t.select("doc_id", F.size("t").cast("long").alias("n_tokens"), F.size(F.array_distinct("t")).cast("long").alias("n_distinct"),
                    F.md5(F.array_join("t", " ")).alias("digest"))


@check("R8_stop_words_and_pairs", f"""
  SELECT doc_id, len(t) AS n_kept, len({terms('t')}) AS n_terms, md5(array_to_string({terms('t')}, '|')) AS digest
  FROM (SELECT doc_id, {tok('text')} AS t FROM documents)""")
def r8(spark, sf):
    from surveyloom.functions.text import content_tokens
    from surveyloom.functions.text import terms as make_terms

    t = table(spark, sf, "documents").select("doc_id", content_tokens("text", STOP).alias("t")).withColumn("x", make_terms(F.col("t")))
    return t.select("doc_id", F.size("t").cast("long").alias("n_kept"), F.size("x").cast("long").alias("n_terms"),
                    F.md5(F.array_join("x", "|")).alias("digest"))


FEATURES = 50_000
DIGITS = 12  # both sides round scores before ranking, so summation order cannot decide ties; results show SHOWN
SHOWN = 6


def tfidf_sql(src: str, key: str, text: str, name: str, vocab: str) -> str:
    return f"""
  {name}_t AS (SELECT {key}, {tok(text)} AS t FROM {src}),
  {name}_c AS (SELECT {key}, term, count(*) AS n FROM (SELECT {key}, unnest({terms('t')}) AS term FROM {name}_t) GROUP BY {key}, term),
  {name}_w AS (SELECT {key}, term, (1 + ln(n)) * idf AS w FROM {name}_c JOIN {vocab} USING (term)),
  {name} AS (SELECT {key}, term, w / sqrt(sum(w * w) OVER (PARTITION BY {key})) AS weight FROM {name}_w)"""


def vocab_sql(src: str, name: str, features: int) -> str:
    return f"""
  {name}_v AS (SELECT term, corpus_count, df, ln((1.0::DOUBLE + nd) / (1 + df)) + 1 AS idf FROM (
      SELECT term, CAST(sum(n) AS BIGINT) AS corpus_count, count(*) AS df FROM {name}_c GROUP BY term ORDER BY 2 DESC, term LIMIT {features}),
    (SELECT count(*) AS nd FROM {src}))"""


def corpus_sql(src: str = "documents", features: int = FEATURES) -> str:
    body = tfidf_sql(src, "doc_id", "text", "d", "d_v")
    cut = body.index("d_w AS")
    return body[:cut] + vocab_sql(src, "d", features).strip() + ",\n  " + body[cut:]


@check("R9_vocabulary", f"WITH {corpus_sql()} SELECT term, corpus_count, df, round(idf, 6) AS idf FROM d_v")
def r9v(spark, sf):
    v = R.fit_vocabulary(spread(table(spark, sf, "documents")), "doc_id", "text", STOP, FEATURES)
    return v.withColumn("idf", F.round("idf", 6))


_STORED: dict[tuple[str, str], dict[str, str]] = {}


def new_index(spark, sf):
    """The index of all documents. Vectors are the embeddings, zero where there is none."""
    docs = spread(table(spark, sf, "documents").select("doc_id", "text", "source"))
    return build_index(docs, scratch_path(spark, "index"), vectors=with_vectors(spark, sf, docs, "doc_id").select("doc_id", "vec"),
                       stop=STOP, max_features=FEATURES, keep=["source"])


def stored_index(spark, sf):
    """Built once in a session: the tables never change."""
    at = (spark.sparkContext.applicationId, sf)
    if at not in _STORED:
        _STORED[at] = new_index(spark, sf)
    return _STORED[at]


def with_vectors(spark, sf, rows, key):
    emb = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").alias("vec"))
    vec = F.coalesce("vec", F.array_repeat(F.lit(0).cast("float"), emb.agg(F.max(F.size("vec"))).scalar()))
    return rows.join(emb, F.col(key) == F.col("vec_id"), "left").drop("vec_id").withColumn("vec", vec)


@check("R9_tfidf_documents", f"""WITH {corpus_sql()}
  SELECT doc_id, count(*) AS n_terms, round(max(weight), 6) AS largest, round(min(weight), 6) AS smallest, round(sum(weight), 5) AS total FROM d GROUP BY doc_id""")
def r9(spark, sf):
    w = load_index(spark, stored_index(spark, sf))[1].select("doc_id", F.explode("weights").alias("weight"))
    return w.groupBy("doc_id").agg(
        F.count("*").alias("n_terms"), F.round(F.max("weight"), 6).alias("largest"), F.round(F.min("weight"), 6).alias("smallest"),
        F.round(F.sum("weight"), 5).alias("total"))


SPARSE = f"""{corpus_sql()}, {tfidf_sql('benchmark', 'item_id', 'text', 'q', 'd_v')},
  top AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM (
    SELECT item_id, doc_id, round(sum(q.weight * d.weight), {DIGITS}) AS score FROM q JOIN d USING (term) GROUP BY item_id, doc_id))"""


def sparse_results(spark, sf, k):
    paths = stored_index(spark, sf)
    questions = question_side(table(spark, sf, "benchmark"), load_index(spark, paths)[0], "item_id", stop=STOP)
    return R.sparse_top_k(questions, spark.read.parquet(paths["blocks"]), "item_id", "doc_id", k, DIGITS)


@check("R13_sparse_top_k", f"WITH {SPARSE} SELECT item_id, doc_id, round(score, {SHOWN}) AS score, rank FROM top WHERE rank <= 10")
def r13(spark, sf):
    return sparse_results(spark, sf, 10).withColumn("score", F.round("score", SHOWN))


HITS = """
  SELECT count(*) AS n_queries, count(*) FILTER (WHERE hit) AS n_hits, CAST(count(*) FILTER (WHERE hit) AS DOUBLE) / count(*) AS hit_rate FROM (
    SELECT item_id, coalesce(max(contains(documents.text, benchmark.text)), FALSE) AS hit
    FROM benchmark LEFT JOIN (SELECT * FROM top WHERE rank <= 3) t USING (item_id) LEFT JOIN documents USING (doc_id) GROUP BY item_id)"""


def hits(spark, sf, results):
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("title"))
    expected = table(spark, sf, "benchmark").select("item_id", F.col("text").alias("expected"))
    return R.hit_rate(results.join(docs, "doc_id"), expected, "item_id", "title", 3)


@check("R17_hit_rate", f"WITH {SPARSE} {HITS}")
def r17(spark, sf):
    return hits(spark, sf, sparse_results(spark, sf, 3))


# ---- dense and fused ---------------------------------------------------------------
DOT = f"round(list_dot_product(CAST({{a}} AS DOUBLE[]), CAST({{b}} AS DOUBLE[])), {DIGITS})"


@check("R12_dense_top_k", f"""
  SELECT query_id, doc_id, round(score, {SHOWN}) AS score, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM (
      SELECT a.vec_id AS query_id, b.vec_id AS doc_id, {DOT.format(a='a.embedding', b='b.embedding')} AS score FROM embeddings a, embeddings b))
  WHERE rank <= 10""")
def r12f(spark, sf):
    e = table(spark, sf, "embeddings")
    return R.dense_top_k(
        e.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vec")),
        e.select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vec")), "query_id", "doc_id", 10, DIGITS).withColumn("score", F.round("score", SHOWN))


# Questions: every benchmark item, its text preceded by identifiers that name documents, with the
# vector of the same number. Documents and items without an embedding have a zero vector.
ZERO = "(SELECT list_transform(range(max(len(embedding))), lambda x: CAST(0 AS FLOAT)) FROM embeddings)"
FUSED = f"""idx AS (SELECT doc_id, text, source, coalesce(embedding, {ZERO}) AS vec FROM documents LEFT JOIN embeddings ON doc_id = vec_id), {corpus_sql('idx')},
  items AS (SELECT item_id, 'See doc' || (item_id * 7 + 3) || ', v999 and DOC' || (item_id * 3) || '. ' || benchmark.text AS text, coalesce(embedding, {ZERO}) AS vec
            FROM benchmark LEFT JOIN embeddings ON item_id = vec_id),
  {tfidf_sql('items', 'item_id', 'text', 'q', 'd_v')},
  sp AS (SELECT item_id, doc_id, sum(q.weight * d.weight) AS s FROM q JOIN d USING (term) GROUP BY item_id, doc_id),
  pairs AS (SELECT item_id, doc_id, idx.source, {DOT.format(a='items.vec', b='idx.vec')} AS dense_score, coalesce(round(s, {DIGITS}), 0) AS sparse_score
            FROM items CROSS JOIN idx LEFT JOIN sp USING (item_id, doc_id)),
  ranks AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY dense_score DESC, doc_id) AS dense_rank,
      row_number() OVER (PARTITION BY item_id ORDER BY sparse_score DESC, doc_id) AS sparse_rank FROM pairs),
  fused AS (SELECT *, 1 / CAST(60 + dense_rank AS DOUBLE) + 1 / CAST(60 + sparse_rank AS DOUBLE) AS score FROM ranks)"""


def fused_inputs(spark, sf):
    vocab, index = load_index(spark, stored_index(spark, sf))
    prefix = F.concat(F.lit("See doc"), (F.col("item_id") * 7 + 3).cast("string"), F.lit(", v999 and DOC"),
                      (F.col("item_id") * 3).cast("string"), F.lit(". "))
    items = with_vectors(spark, sf, table(spark, sf, "benchmark").select("item_id", F.concat(prefix, "text").alias("text")), "item_id")
    queries = cut(question_side(items, vocab, "item_id", stop=STOP), "questions")
    return queries, index, index.select(F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("name"), "doc_id")


@check("R14_rank_fusion", f"""WITH {FUSED}
  SELECT item_id, doc_id, round(dense_score, {SHOWN}) AS dense_score, round(sparse_score, {SHOWN}) AS sparse_score, dense_rank, sparse_rank, score, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM fused) WHERE rank <= 5""")
def r14w(spark, sf):
    queries, index, _ = fused_inputs(spark, sf)
    out = R.fused_top_k(queries, index, "item_id", "doc_id", 5, digits=DIGITS)
    return out.withColumns({c: F.round(c, SHOWN) for c in ("dense_score", "sparse_score")})


@check("R17_hit_rate_fused", f"""WITH {FUSED},
  top AS (SELECT item_id, doc_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM fused) {HITS}""")
def r17f(spark, sf):
    queries, index, _ = fused_inputs(spark, sf)
    return hits(spark, sf, R.fused_top_k(queries, index, "item_id", "doc_id", 3, digits=DIGITS).select("item_id", "doc_id", "rank"))


PINS = """
  men AS (SELECT item_id, lower(name) AS name, min(i) AS position FROM (
    SELECT item_id, unnest(m) AS name, generate_subscripts(m, 1) AS i FROM (
      SELECT item_id, regexp_extract_all(text, '(?i)\\b([a-z]{1,5}[0-9]{1,4}[a-z]?(?:_[0-9]{1,2})?|caseid|ssmod|sweight|sdist)\\b', 1) AS m FROM items)) GROUP BY 1, 2),
  pins AS (SELECT item_id, doc_id, position, source FROM men JOIN idx ON name = 'doc' || doc_id)"""


def pinned_sql(k: int, where: str) -> str:
    return f"""WITH {FUSED}, {PINS},
  res AS (SELECT item_id, doc_id, CAST(1 AS DOUBLE) AS score, 'exact variable name' AS match, 0 AS tier, CAST(position AS DOUBLE) AS place FROM pins WHERE {where}
    UNION ALL SELECT item_id, doc_id, score, 'similarity', 1, -score FROM fused WHERE {where} AND (item_id, doc_id) NOT IN (SELECT (item_id, doc_id) FROM pins))
  SELECT item_id, doc_id, score, match, rank FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY tier, place, doc_id) AS rank FROM res) WHERE rank <= {k}"""


@check("R15_pinned_retrieval", pinned_sql(5, "TRUE"))
def r15(spark, sf):
    queries, index, names = fused_inputs(spark, sf)
    return R.retrieve(queries, index, names, "item_id", "doc_id", 5, digits=DIGITS)


@check("R15_pinned_retrieval_by_source", pinned_sql(4, "source IN ('src1', 'src3', 'src6')"))
def r15s(spark, sf):
    queries, index, names = fused_inputs(spark, sf)
    return R.retrieve(queries, index, names, "item_id", "doc_id", 4, sources=["src1", "src3", "src6"], digits=DIGITS)


@check("R16_definition_lookup", f"""WITH {CODEBOOK},
  asked AS (SELECT DISTINCT ' ' || upper(p_type) || '_07 ' AS name FROM part UNION SELECT DISTINCT p_brand FROM part UNION SELECT r_name FROM region)
  SELECT name, variable_name IS NOT NULL AS found, 'Described: ' || variable_label AS dictionary_text
  FROM asked LEFT JOIN cb ON lower(trim(name)) = lower(variable_name)""")
def r16(spark, sf):
    part, region = table(spark, sf, "part"), table(spark, sf, "region")
    asked = (
        part.select(F.concat(F.lit(" "), F.upper("p_type"), F.lit("_07 ")).alias("name"))
        .union(part.select("p_brand")).union(region.select("r_name")).distinct()
    )
    book = codebook(spark, sf)
    chunks = B.codebook_chunks(book.withColumn("row", F.col("variable_name")), "row", 30)
    dictionary = book.select(F.col("variable_name").alias("variable"), F.concat(F.lit("Described: "), "variable_label").alias("text"))
    return B.lookup_variable(asked, chunks, dictionary).select("name", "found", "dictionary_text")


@check("R11_lsa_embedding", f"""WITH {corpus_sql()}
  SELECT doc_id, greatest(1, least(256, (SELECT count(*) FROM documents) - 1, (SELECT count(*) FROM d_v) - 1)) AS dimensions,
    CASE WHEN doc_id IN (SELECT doc_id FROM d) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS length FROM documents""")
def r11(spark, sf):
    """With the operator's defaults. What SQL can say of the vectors; tests compare their cosines with a dense decomposition."""
    docs = spread(table(spark, sf, "documents"))
    v = R.LsaModel.fit(docs, "doc_id", "text", stop=STOP).embed(docs, "doc_id", "text")
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))
    return v.select("doc_id", F.size("vec").cast("long").alias("dimensions"), F.round(norm, 3).alias("length"))
