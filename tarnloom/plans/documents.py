"""Queries over documents, labels, benchmark items and embeddings."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tarnloom.functions import text as X
from tarnloom.operators import ranking as R
from tarnloom.tables import table


def _docs(spark, d):
    return table(spark, d, "documents").where("text is not null")


def _chunks(spark, d):
    bare = F.regexp_replace("text", r"https?://\S+", "")
    return _docs(spark, d).select("doc_id", F.posexplode(X.chunks(bare)).alias("chunk_no", "chunk"))


def _slugs(spark, d):
    first = F.regexp_extract("text", r"([^\n]*)", 1)
    return _docs(spark, d).select("doc_id", X.slug(first).alias("slug"), X.preview(F.col("text")).alias("preview"), X.cut(first, 60).alias("title"), X.cut(F.regexp_replace("text", r"\s+", " "), 160).alias("description"), X.token_estimate(F.col("text")).alias("tokens"))


_SLUG = r"regexp_replace(regexp_replace(regexp_extract(text, '([^\n]*)', 1), '[^A-Za-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"
_SLUGS = rf"""WITH t AS (SELECT doc_id, text, regexp_extract(text, '([^\n]*)', 1) AS f, lower({_SLUG}) AS s, trim(regexp_replace(text, '\s+', ' ', 'g')) AS p, regexp_replace(text, '\s+', ' ', 'g') AS q FROM documents WHERE text IS NOT NULL)
SELECT doc_id, substring(CASE WHEN s = '' THEN 'task' ELSE s END, 1, 64) AS slug, CASE WHEN length(p) > 240 THEN substring(p, 1, 240) || '... (truncated)' ELSE p END AS preview,
CASE WHEN length(f) > 60 THEN substring(f, 1, 57) || '...' ELSE f END AS title, CASE WHEN length(q) > 160 THEN substring(q, 1, 157) || '...' ELSE q END AS description, (length(text) // 4)::BIGINT AS tokens FROM t"""


def _clean(spark, d):
    return _docs(spark, d).select("doc_id", F.md5(X.clean_external(F.col("text"))).alias("clean_md5"), F.length(X.clean_external(F.col("text"))).alias("n_chars"))


def _clean_sql():
    """The phases of the cleaner; RE2 takes the same patterns. The patterns themselves are tested on literals."""
    s = "text"
    for step in X.cleaning_steps():
        if step is None:
            for name, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&apos;", "''"), ("&ndash;", "–"), ("&mdash;", "—"), ("&hellip;", "…"), ("&amp;", "&")):
                s = f"replace({s}, '{name}', '{sign}')"
        else:
            s = f"regexp_replace({s}, '{step[0]}', '{step[1].replace('$1', chr(92) + '1')}', 'g')"
    return f"WITH c AS (SELECT doc_id, text, {s} AS s FROM documents WHERE text IS NOT NULL), e AS (SELECT doc_id, CASE WHEN length(s) < 50 THEN text ELSE s END AS s FROM c) SELECT doc_id, md5(s) AS clean_md5, length(s)::INT AS n_chars FROM e"


def _search(spark, d):
    body = F.lower(F.concat_ws("\n", "source", "text"))
    return table(spark, d, "documents").where(F.contains(body, F.lit("network")) | F.contains(body, F.lit("kitchens"))).select("doc_id", "source")


def _quality_gate(spark, d):
    """Documents with a good enough latest label, or none: a left join of the pre-aggregated side."""
    latest = table(spark, d, "labels").where("doc_id is not null").groupBy("doc_id").agg(F.max_by("quality", F.struct("labelled_at", "quality")).alias("quality"), F.max("toxic").alias("toxic"))
    j = _docs(spark, d).join(latest, "doc_id", "left")
    return j.where((F.length("text") >= 200) & (F.coalesce("quality", F.lit(3)) >= 3) & (F.coalesce("toxic", F.lit(0)) == 0)).select("doc_id", F.coalesce("quality", F.lit(0)).alias("quality"))


def _exact_copies(spark, d):
    """First document of each text, case folded, with the number of its copies."""
    return _docs(spark, d).groupBy(F.md5(F.lower("text")).alias("text_md5")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))


def _source_summary(spark, d):
    docs = table(spark, d, "documents")
    return docs.rollup("doc_kind", "lang").agg(F.count("*").alias("n"), F.count("text").alias("with_text"), F.sum(F.coalesce(F.length("text"), F.lit(0)).cast("bigint")).alias("chars")).select(F.coalesce("doc_kind", F.lit("*")).alias("doc_kind"), F.coalesce("lang", F.lit("*")).alias("lang"), "n", "with_text", "chars").groupBy("doc_kind", "lang").agg(F.max("n").alias("n"), F.max("with_text").alias("with_text"), F.max("chars").alias("chars"))


def _labelled_twice(spark, d):
    lab = table(spark, d, "labels").where("doc_id is not null and subject_code is not null")
    return lab.groupBy("doc_id").agg(F.count_distinct(F.lower(F.trim("subject_code"))).alias("codes"), F.array_join(F.array_sort(F.collect_set(F.lower(F.trim("subject_code")))), ",").alias("all_codes")).where("codes > 1")


def _names(spark, d):
    return table(spark, d, "subject_areas").select("subject_code", X.normal_name(F.col("subject_title")).alias("name"), X.word_slug(F.col("description")).alias("slug"))


def _unique_names(spark, d):
    parts = table(spark, d, "part").select("p_partkey", X.slug(F.col("p_name"), 48).alias("stem"))
    return R.suffixed_names(parts, "stem", ["p_partkey"])


def _long_tail(spark, d):
    """Entities: one row per name (the least viewed), of which the three least viewed of each brand."""
    p = table(spark, d, "part").select(F.lower(F.trim("p_name")).alias("name"), "p_brand", F.coalesce("p_retailprice", F.lit(0.0)).alias("views"), "p_partkey")
    w = Window.partitionBy("name").orderBy("views", "p_partkey")
    one = p.withColumn("n", F.row_number().over(w)).where("n = 1").drop("n")
    b = Window.partitionBy("p_brand").orderBy("views", "name")
    return one.withColumn("place", F.row_number().over(b)).where("place <= 3").select("p_brand", "place", "name")


def _vector_top(spark, d):
    e = table(spark, d, "embeddings")
    return R.vector_top_k(e, e.where("vec_id % 50 = 0"), 5).select("query_id", "vec_id", "rank", F.round("distance", 4).alias("distance"))


def _vector_cosine(spark, d):
    e = table(spark, d, "embeddings")
    q = e.orderBy("vec_id").limit(1).select(F.col("embedding").alias("q"))  # one row
    return e.crossJoin(F.broadcast(q)).select("vec_id", F.round(R.cosine(F.col("embedding"), F.col("q")), 6).alias("score"))


def _centroids(spark, d):
    e = table(spark, d, "embeddings").select("label", F.posexplode("embedding").alias("i", "x"))
    return e.groupBy("label", "i").agg(F.round(F.avg(F.col("x").cast("double")), 6).alias("mean"))


def _url_rank(spark, d):
    rows = table(spark, d, "documents").where("source_url is not null").select("doc_id", "source_url")
    return R.term_cosine(rows, F.col("source_url"), "shop wiki shop").where("score > 0").select("doc_id", F.round("score", 6).alias("score"))


def _nearest_items(spark, d):
    """Levenshtein similarity of each benchmark item's ASCII signs with the next item's (DuckDB's distance counts bytes); all signs: levenshtein_verdict."""
    b = table(spark, d, "benchmark").select("item_id", F.regexp_replace("text", r"[^\x20-\x7e]", "").alias("t"))
    w = Window.orderBy("item_id")  # a fixed table of 200 rows
    return b.select("item_id", F.round(X.levenshtein_similarity(F.col("t"), F.coalesce(F.lead("t").over(w), F.lit(""))), 6).alias("similarity"))


def _verdict(spark, d):
    """Whole text of each benchmark item against the three next items. No SQL: DuckDB's distance counts bytes, not signs."""
    w = Window.orderBy("item_id")  # a fixed table of 200 rows
    nexts = F.array(*(F.struct(F.lead("item_id", k).over(w).alias("id"), F.lead("text", k).over(w).alias("other")) for k in (1, 2, 3)))
    pairs = table(spark, d, "benchmark").select("item_id", F.col("text").alias("gold"), nexts.alias("n")).select("item_id", "gold", F.explode("n").alias("x")).where("x.id is not null")
    return R.similarity_verdict(pairs.select("item_id", "gold", "x.other"), "item_id")


QUERIES = {
    "doc_chunks": _chunks, "doc_slugs": _slugs, "doc_clean": _clean, "record_search": _search, "quality_gate": _quality_gate, "exact_copies": _exact_copies, "source_summary": _source_summary,
    "labelled_twice": _labelled_twice, "subject_names": _names, "unique_names": _unique_names, "entity_long_tail": _long_tail, "vector_topk_l2": _vector_top, "vector_cosine": _vector_cosine,
    "vector_centroids": _centroids, "term_cosine_rank": _url_rank, "levenshtein_neighbours": _nearest_items, "levenshtein_verdict": _verdict,
}
_DOT = "list_dot_product(a::DOUBLE[], b::DOUBLE[])"
SQL = {
    "doc_chunks": r"WITH t AS (SELECT doc_id, regexp_replace(text, 'https?://\S+', '', 'g') AS x FROM documents WHERE text IS NOT NULL), c AS (SELECT doc_id, x, unnest(range(0, length(x), 896)) AS i FROM t WHERE length(x) > 0) SELECT doc_id, (i // 896)::INT AS chunk_no, substring(x, i::BIGINT + 1, 1024) AS chunk FROM c",
    "doc_slugs": _SLUGS,
    "doc_clean": _clean_sql(),
    "record_search": r"SELECT doc_id, source FROM documents WHERE contains(lower(concat_ws(chr(10), source, text)), 'network') OR contains(lower(concat_ws(chr(10), source, text)), 'kitchens')",
    "quality_gate": "WITH l AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY doc_id ORDER BY labelled_at DESC NULLS LAST, quality DESC NULLS LAST) AS n, max(toxic) OVER (PARTITION BY doc_id) AS toxic FROM labels WHERE doc_id IS NOT NULL) SELECT d.doc_id, coalesce(quality, 0) AS quality FROM documents d LEFT JOIN l ON l.doc_id = d.doc_id AND l.n = 1 WHERE length(text) >= 200 AND coalesce(quality, 3) >= 3 AND coalesce(toxic, 0) = 0",
    "exact_copies": "SELECT md5(lower(text)) AS text_md5, min(doc_id) AS doc_id, count(*) AS copies FROM documents WHERE text IS NOT NULL GROUP BY 1",
    "source_summary": "WITH r AS (SELECT coalesce(doc_kind, '*') AS doc_kind, coalesce(lang, '*') AS lang, count(*) AS n, count(text) AS with_text, sum(coalesce(length(text), 0))::BIGINT AS chars FROM documents GROUP BY ROLLUP (documents.doc_kind, documents.lang)) SELECT doc_kind, lang, max(n) AS n, max(with_text) AS with_text, max(chars) AS chars FROM r GROUP BY doc_kind, lang",
    "labelled_twice": "SELECT doc_id, count(DISTINCT lower(trim(subject_code))) AS codes, array_to_string(list_sort(list_distinct(list(lower(trim(subject_code))))), ',') AS all_codes FROM labels WHERE doc_id IS NOT NULL AND subject_code IS NOT NULL GROUP BY doc_id HAVING count(DISTINCT lower(trim(subject_code))) > 1",
    "subject_names": r"SELECT subject_code, trim(regexp_replace(lower(subject_title), '[^\p{L}\p{N}]+', ' ', 'g')) AS name, regexp_replace(regexp_replace(trim(lower(description)), '[^\p{L}\p{N}_\s-]', '', 'g'), '[-\s]+', '-', 'g') AS slug FROM subject_areas",
    "unique_names": r"WITH s AS (SELECT p_partkey, lower(regexp_replace(regexp_replace(p_name, '[^A-Za-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')) AS x FROM part), t AS (SELECT p_partkey, substring(CASE WHEN x = '' THEN 'task' ELSE x END, 1, 48) AS stem FROM s), n AS (SELECT *, row_number() OVER (PARTITION BY stem ORDER BY p_partkey) AS n FROM t) SELECT p_partkey, stem, CASE WHEN n = 1 THEN stem WHEN n <= 999 THEN stem || '_' || n ELSE stem || '_x' END AS unique_name FROM n",
    "entity_long_tail": "WITH p AS (SELECT lower(trim(p_name)) AS name, p_brand, coalesce(p_retailprice, 0) AS views, p_partkey FROM part), o AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY views, p_partkey) AS n FROM p), b AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY views, name) AS place FROM o WHERE n = 1) SELECT p_brand, place::INT AS place, name FROM b WHERE place <= 3",
    "vector_topk_l2": "WITH p AS (SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.embedding::DOUBLE[], a.embedding::DOUBLE[]) + list_dot_product(b.embedding::DOUBLE[], b.embedding::DOUBLE[]) - 2 * list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS d FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(greatest(d, 0), 9), vec_id) AS rank FROM p) SELECT query_id, vec_id, rank::INT AS rank, round(greatest(d, 0), 4) AS distance FROM r WHERE rank <= 5",
    "vector_cosine": f"WITH q AS (SELECT embedding AS b FROM embeddings ORDER BY vec_id LIMIT 1), p AS (SELECT vec_id, embedding AS a, b FROM embeddings, q) SELECT vec_id, round({_DOT} / (sqrt(list_dot_product(a::DOUBLE[], a::DOUBLE[])) * sqrt(list_dot_product(b::DOUBLE[], b::DOUBLE[]))), 6) AS score FROM p",
    "vector_centroids": "WITH e AS (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings) SELECT label, i::INT AS i, round(avg(x::DOUBLE), 6) AS mean FROM e GROUP BY label, i",
    "term_cosine_rank": "WITH c AS (SELECT doc_id, len(string_split(lower(source_url), 'shop')) - 1.0 AS s, len(string_split(lower(source_url), 'wiki')) - 1.0 AS w FROM documents WHERE source_url IS NOT NULL) SELECT doc_id, round((2 * s + w) / (sqrt(s * s + w * w) * sqrt(5.0)), 6) AS score FROM c WHERE s + w > 0",
    "levenshtein_neighbours": r"WITH b AS (SELECT item_id, regexp_replace(text, '[^\x20-\x7e]', '', 'g') AS t FROM benchmark), n AS (SELECT item_id, t, coalesce(lead(t) OVER (ORDER BY item_id), '') AS u FROM b) SELECT item_id, round(CASE WHEN greatest(strlen(t), strlen(u)) = 0 THEN 1.0 ELSE 1 - levenshtein(t, u) / greatest(strlen(t), strlen(u)) END, 6) AS similarity FROM n",
}
