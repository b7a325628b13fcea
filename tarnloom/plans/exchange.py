"""Queries that write what a table holds in an exchange format and read it again, and streams run to their end."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarnloom.operators import links as L
from tarnloom.operators import tasks as T
from tarnloom.session import scratch
from tarnloom.sources import readers as R
from tarnloom.sources import writers as W
from tarnloom.streaming import queue as Q
from tarnloom.tables import table


def _docs(spark, d):
    return table(spark, d, "documents").where("doc_id is not null").select("doc_id", "text", "lang", "source", "source_url", "doc_kind")


def _jsonl(spark, d):
    path = scratch(spark, "jsonl")
    _docs(spark, d).write.json(path)
    return R.read_jsonl(spark, path, "doc_id bigint, text string, lang string").where("_corrupt is null").select("doc_id", F.md5("text").alias("text_md5"), "lang")


def _tree(spark, d):
    """Files of a tree of folders, those under `raw` apart."""
    path = scratch(spark, "tree")
    rows = _docs(spark, d).withColumn("part", F.when(F.col("doc_id") % 4 == 0, "raw").otherwise(F.concat(F.lit("p"), F.col("doc_id") % 3)))
    for part in ("raw", "p0", "p1", "p2"):
        rows.where(F.col("part") == part).select("doc_id", "doc_kind").write.json(f"{path}/{part}")
    return R.read_json_tree(spark, path, "doc_id bigint, doc_kind string").select("doc_id", "doc_kind")


def _packages(spark, d):
    path = scratch(spark, "packages")
    n = table(spark, d, "nation")
    p = n.select(F.concat(F.lit("region-"), F.col("n_regionkey")).alias("agent_type"), F.concat(F.lit("task-"), F.col("n_nationkey")).alias("task_id"), F.col("n_name").alias("title"))
    W.write_packages(p.coalesce(1), path)
    return spark.read.json(path).select("agent_type", "task_id", "title")


def _steps(spark, d):
    path = scratch(spark, "steps")
    e = table(spark, d, "events").where("user_id is not null").select(F.concat(F.lit("r"), F.col("user_id")).alias("run_id"), F.col("event_id").alias("seq"), "event_type", "ts")
    W.write_steps(e, path)
    read = spark.read.schema("seq bigint, event_type string, run_id string").json(path)
    return read.groupBy("run_id").agg(F.count("*").alias("n"), F.max_by("event_type", "seq").alias("last"))


def _appended(spark, d):
    path = scratch(spark, "appended")
    docs = _docs(spark, d).select("doc_id", "doc_kind")
    for k in range(3):
        W.append_rows(docs.where(F.col("doc_id") % 3 == k), path)
    return spark.read.parquet(path)


def _batches(spark, d):
    """Micro-batches of which one is delivered twice."""
    path = scratch(spark, "batches")
    write = W.idempotent_batches(path, "doc_id")
    docs = _docs(spark, d).select("doc_id", "doc_kind")
    for k in (0, 1, 1, 2):
        write(docs.where(F.col("doc_id") % 3 == k), k)
    return spark.read.parquet(path).select("doc_id", "doc_kind")


def _search_cache(spark, d):
    g = _docs(spark, d).where("source_url is not null").groupBy("doc_kind").agg(F.array_sort(F.collect_list(F.struct(F.col("source_url").alias("url"), F.coalesce("source", F.lit("-")).alias("title"), F.lit("s").alias("summary")))).alias("hits"))
    cache = g.where("doc_kind is not null").select(F.to_json(F.map_from_arrays(F.array("doc_kind"), F.array("hits"))).alias("value"))
    return R.search_cache(cache).select("query", "position", "url", "title")


def _records(spark, d):
    item = F.struct(F.col("source").alias("title"), F.col("source_url").alias("url"), F.col("doc_kind").alias("summary"))
    g = _docs(spark, d).groupBy((F.col("doc_id") % 7).alias("g")).agg(F.array_sort(F.collect_list(item)).alias("r"))
    text = F.when(F.col("g") % 2 == 0, F.to_json("r")).otherwise(F.to_json(F.struct(F.col("r").alias("records"))))
    return R.load_records(g.select(text.alias("value"))).groupBy("summary").agg(F.count("*").alias("n"), F.max("title").alias("title"), F.count("url").alias("urls"))


def _categories(spark, d):
    p = table(spark, d, "part").groupBy("p_brand").agg(F.array_sort(F.collect_set("p_type")).alias("t"))
    nested = F.to_json(F.struct(F.array(F.struct(F.transform("t", lambda x: F.struct(x.alias("scenario"))).alias("scenarios"))).alias("user_roles")))
    flat = F.to_json(F.struct(F.col("t").alias("domains")))
    return R.categories(p.select(F.when(F.length("p_brand") % 2 == 0, nested).otherwise(flat).alias("value")), start=1, n=2).groupBy("position", "category").agg(F.count("*").alias("n"))


def _site_maps(spark, d):
    """Site maps made of the pages' addresses: one index a status, one map a page's last digit."""
    p = table(spark, d, "pages").where("url is not null and page_id is not null").select((F.col("page_id") % 10).alias("k"), F.regexp_replace("url", "&", "&amp;").alias("u")).distinct()
    maps = p.groupBy("k").agg(F.array_join(F.array_sort(F.collect_list(F.concat(F.lit("<url><loc> "), F.col("u"), F.lit("</loc></url>")))), "").alias("body"))
    leaves = maps.select(F.concat(F.lit("https://e.example/m"), F.col("k"), F.lit(".xml")).alias("url"), F.concat(F.lit('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'), F.col("body"), F.lit("<url><loc>https://e.example/i.png</loc></url></urlset>")).alias("xml"))
    index = maps.where("k < 5").agg(F.array_join(F.array_sort(F.collect_list(F.concat(F.lit("<sitemap><loc>https://e.example/m"), F.col("k"), F.lit(".xml</loc></sitemap>")))), "").alias("body"))
    root = index.select(F.lit("https://e.example/sitemap.xml").alias("url"), F.concat(F.lit("<sitemapindex>"), F.col("body"), F.lit("</sitemapindex>")).alias("xml"))
    roots = spark.createDataFrame([("https://e.example/sitemap.xml",)], "url string")
    return L.sitemap_walk(root.unionAll(leaves), roots).select("map_url", "loc")


def _robots(spark, d):
    p = table(spark, d, "pages").where("url is not null").select(F.col("url").alias("link")).distinct()
    hosts = p.select(L.U.host(F.col("link")).alias("host")).where("host != ''").distinct()
    rules = L.parse_robots(hosts.select("host", F.lit("User-agent: x\nDisallow: /\n\nUser-agent: *\nDisallow: /*1\nAllow: /*21\n# end").alias("robots_txt")))
    return L.robots_allowed(p, rules).select("link", "allowed")


def _run(df, name, mode="append"):
    """A stream's result after all its input."""
    spark = df.sparkSession
    path, point = scratch(spark, name), scratch(spark, name + "-checkpoint")

    def keep(batch, n):
        batch.write.mode("overwrite").parquet(f"{path}/batch={n}")

    df.writeStream.outputMode(mode).option("checkpointLocation", point).trigger(availableNow=True).foreachBatch(keep).start().awaitTermination()
    return spark.read.parquet(path)


def _stream(spark, d, name):
    return spark.readStream.schema(table(spark, d, name).schema).option("pathGlobFilter", f"{name}.parquet").parquet(d)


def _visited(spark, d):
    return _run(Q.visited_once(_stream(spark, d, "events").select("user_id", "ts"), "user_id"), "visited").select("user_id")


def _frequency(spark, d):
    return _run(Q.running_frequency(_stream(spark, d, "events").select("event_type"), "event_type"), "frequency", "update").select("event_type", "frequency")


def _admitted(spark, d):
    rows = _run(Q.admitted(_stream(spark, d, "events").select(F.col("user_id").cast("string").alias("key"), "ts"), 3, 86400.0), "admitted")
    return rows.groupBy("key").agg(F.count("*").alias("n"), F.count_if("allowed").alias("allowed"))


def _assembled(spark, d):
    """Environments (brands) with their tools (types) and tasks (parts)."""
    p = table(spark, d, "part")
    env = p.select(F.col("p_brand").alias("env_id")).distinct()
    tools = p.select(F.col("p_brand").alias("env_id"), F.col("p_type").alias("name"), F.col("p_partkey").alias("seq"), F.col("p_name").alias("description"))
    tasks = p.select(F.col("p_brand").alias("env_id"), F.col("p_partkey").alias("seq"), F.col("p_name").alias("title"), F.lit("c").alias("content"), F.when(F.col("p_partkey") % 3 == 0, "x").otherwise("def verify(a): ...").alias("verification"), F.when(F.col("p_partkey") % 5 == 0, "e").alias("error"))
    doc = T.assembled(env, tools, tasks)
    at = lambda k: F.get_json_object("document", k)
    return doc.select("env_id", at("$.metadata.n_tools").cast("int").alias("n_tools"), at("$.metadata.n_tasks").cast("int").alias("n_tasks"), at("$.tools[0].name").alias("tool"), at("$.tasks[0].title").alias("task"))


def _annotated(spark, d):
    docs = _docs(spark, d).where("doc_kind = 'pr_problem'").select(F.col("doc_id").alias("instance_id"))
    lab = table(spark, d, "labels").where("doc_id is not null").select(F.col("doc_id").alias("instance_id"), "quality", (F.col("toxic") == 1).alias("flag"), F.struct(F.col("labelled_at"), F.col("quality"), F.col("toxic")).alias("seq"))
    return T.filtered_by_annotations(docs, lab, {"quality": (2, None), "flag": False}).select("instance_id")


QUERIES = {
    "jsonl_roundtrip": _jsonl, "json_tree": _tree, "package_files": _packages, "step_traces": _steps, "appended_rows": _appended, "idempotent_batches": _batches, "search_cache": _search_cache, "record_envelopes": _records,
    "category_slices": _categories, "site_map_walk": _site_maps, "robots_rules": _robots, "stream_visited": _visited, "stream_frequency": _frequency, "stream_admitted": _admitted, "assembled_documents": _assembled, "annotated_pulls": _annotated,
}

_D = "d AS (SELECT * FROM documents WHERE doc_id IS NOT NULL)"
SQL = {
    "jsonl_roundtrip": f"WITH {_D} SELECT doc_id, md5(text) AS text_md5, lang FROM d",
    "json_tree": f"WITH {_D} SELECT doc_id, doc_kind FROM d WHERE doc_id % 4 <> 0",
    "package_files": "SELECT 'region-' || n_regionkey AS agent_type, 'task-' || n_nationkey AS task_id, n_name AS title FROM nation",
    "step_traces": "SELECT 'r' || user_id AS run_id, count(*) AS n, last(event_type ORDER BY event_id) AS last FROM events WHERE user_id IS NOT NULL GROUP BY user_id",
    "appended_rows": f"WITH {_D} SELECT doc_id, doc_kind FROM d",
    "idempotent_batches": f"WITH {_D} SELECT doc_id, max(doc_kind) AS doc_kind FROM d GROUP BY doc_id",
    "search_cache": f"WITH {_D} SELECT doc_kind AS query, (row_number() OVER (PARTITION BY doc_kind ORDER BY source_url, coalesce(source, '-')) - 1)::INT AS position, source_url AS url, coalesce(source, '-') AS title FROM d WHERE source_url IS NOT NULL AND doc_kind IS NOT NULL",
    "record_envelopes": f"WITH {_D} SELECT doc_kind AS summary, count(*) AS n, max(source) AS title, count(source_url) AS urls FROM d GROUP BY doc_kind",
    "category_slices": "WITH t AS (SELECT DISTINCT p_brand, p_type FROM part), n AS (SELECT p_type, row_number() OVER (PARTITION BY p_brand ORDER BY p_type) AS r FROM t) SELECT (r - 2)::INT AS position, p_type AS category, count(*) AS n FROM n WHERE r IN (2, 3) GROUP BY ALL",
    "site_map_walk": r"WITH p AS (SELECT DISTINCT page_id % 10 AS k, url FROM pages WHERE url IS NOT NULL AND page_id IS NOT NULL) SELECT DISTINCT 'https://e.example/m' || k || '.xml' AS map_url, url AS loc FROM p WHERE k < 5",
    "robots_rules": r"WITH p AS (SELECT DISTINCT url FROM pages WHERE url IS NOT NULL), t AS (SELECT url, regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^#]*)', 1) AS t FROM p) SELECT url AS link, CASE WHEN regexp_matches(t, '^/.*21') THEN true WHEN regexp_matches(t, '^/.*1') THEN false ELSE true END AS allowed FROM t",
    "stream_visited": "SELECT DISTINCT user_id FROM events",
    "stream_frequency": "SELECT event_type, count(*) AS frequency FROM events GROUP BY event_type",
    "stream_admitted": """WITH RECURSIVE e AS (SELECT user_id, epoch_us(ts) AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events),
w AS (SELECT user_id, i, t AS start, 1 AS used, 1 AS allowed FROM e WHERE i = 1 UNION ALL
 SELECT w.user_id, e.i, CASE WHEN e.t - w.start >= 86400000000 THEN e.t ELSE w.start END, CASE WHEN e.t - w.start >= 86400000000 THEN 1 ELSE w.used + 1 END, w.allowed + CASE WHEN e.t - w.start >= 86400000000 OR w.used < 3 THEN 1 ELSE 0 END FROM w JOIN e ON e.user_id = w.user_id AND e.i = w.i + 1)
SELECT user_id::VARCHAR AS key, max(i) AS n, max(allowed)::BIGINT AS allowed FROM w GROUP BY user_id""",
    "assembled_documents": "WITH t AS (SELECT p_brand, count(DISTINCT p_type)::INT AS n_tools, arg_min(p_type, p_partkey) AS tool FROM part GROUP BY 1), k AS (SELECT p_brand, count(*)::INT AS n_tasks, arg_min(p_name, p_partkey) AS task FROM part WHERE p_partkey % 3 <> 0 AND p_partkey % 5 <> 0 GROUP BY 1) SELECT p_brand AS env_id, n_tools, coalesce(n_tasks, 0) AS n_tasks, tool, task FROM t LEFT JOIN k USING (p_brand)",
    "annotated_pulls": "WITH p AS (SELECT doc_id FROM documents WHERE doc_kind = 'pr_problem' AND doc_id IS NOT NULL), l AS (SELECT doc_id, quality, toxic, row_number() OVER (PARTITION BY doc_id ORDER BY labelled_at NULLS FIRST, quality NULLS FIRST, toxic NULLS FIRST) AS n FROM labels WHERE doc_id IS NOT NULL) SELECT p.doc_id AS instance_id FROM p LEFT JOIN l ON l.doc_id = p.doc_id AND n = 1 WHERE l.doc_id IS NULL OR (quality >= 2 AND toxic <> 1)",
}
