"""Queries of the text problems, and the SQL that states a result where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tarnloom.llm import languages, leaks, mainbody, neardup, packing, quality, residue, sitelines, subjects
from tarnloom.tables import table


def _areas(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [table(spark, sf_dir, n) for n in ("documents", "labels", "subject_areas", "benchmark")]


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": lambda s, d: quality.found(table(s, d, "pages")),
    "p1_page_quality": lambda s, d: quality.page_quality(table(s, d, "pages")),
    "p2_found": lambda s, d: mainbody.boilerplate_lines(table(s, d, "pages")),
    "p2_main_text": lambda s, d: mainbody.main_body_text(table(s, d, "pages")),
    "p3_found": lambda s, d: residue.found(table(s, d, "pages")),
    "p3_residue_pages": lambda s, d: residue.residue_pages(table(s, d, "pages")),
    "p4_found": lambda s, d: sitelines.frequent_lines(table(s, d, "pages")).select("site", "line"),
    "p4_clean_pages": lambda s, d: sitelines.without_frequent_lines(table(s, d, "pages")),
    "p5_found": lambda s, d: languages.found(table(s, d, "pages")),
    "p5_stretches": lambda s, d: languages.stretches(table(s, d, "pages")),
    "p5_page_languages": lambda s, d: languages.page_languages(table(s, d, "pages")),
    "p6_found": lambda s, d: neardup.found(table(s, d, "page_versions")),
    "p6_groups": lambda s, d: neardup.near_duplicate_groups(table(s, d, "page_versions")),
    "p8_pack": lambda s, d: packing.pack(table(s, d, "documents")),
    "p8_container_fill": lambda s, d: packing.container_fill(packing.pack(table(s, d, "documents"))),
    "p9_found": lambda s, d: leaks.found(table(s, d, "documents"), table(s, d, "benchmark")),
    "p9_leaks": lambda s, d: leaks.leaks(table(s, d, "documents"), table(s, d, "benchmark")),
    "p10_found": lambda s, d: subjects.found(*_areas(s, d)),
    "p10_document_subjects": lambda s, d: subjects.document_subjects(*_areas(s, d)),
    "p10_composition": lambda s, d: subjects.composition(*_areas(s, d)),
}

_SITE = r"nullif(regexp_replace(regexp_replace(lower(regexp_extract(regexp_replace(trim(meta_source_url), '^([A-Za-z][A-Za-z0-9+.\-]*:)?//', ''), '^(?:[^/?#@]*@)?([^/?#]*)', 1)), ':\d*$', ''), '^www\.', ''), '')"
_LINE = r"regexp_replace(lower(trim(regexp_replace(raw, '\s+', ' ', 'g'))), '[0-9]+', '0', 'g')"
_P4 = f"""
WITH o AS (SELECT page_id, {_SITE} AS site, markdown,
    row_number() OVER (PARTITION BY page_id ORDER BY scraped_at DESC NULLS LAST, markdown DESC NULLS LAST) AS r
  FROM pages WHERE page_id IS NOT NULL AND {_SITE} IS NOT NULL),
u AS (SELECT page_id, site, markdown FROM o WHERE r = 1),
raws AS (SELECT page_id, site, unnest(string_split(markdown, chr(10))) AS raw FROM u WHERE markdown IS NOT NULL),
l AS (SELECT DISTINCT page_id, site, {_LINE} AS line FROM raws),
c AS (SELECT site, line, count(*) AS n FROM l WHERE length(line) >= 10 GROUP BY site, line HAVING count(*) >= 5),
t AS (SELECT site, count(*) AS pages FROM u GROUP BY site)
"""

def _leaks_sql(columns: str) -> str:
    words = r"regexp_extract_all(lower(text), '[\p{L}\p{N}]+')"
    return f"""
WITH i AS (SELECT item_id, {words} AS w FROM benchmark WHERE text IS NOT NULL),
d AS (SELECT doc_id, {words} AS w FROM documents WHERE text IS NOT NULL),
ig AS (SELECT item_id, k, array_to_string(w[k:k + 11], ' ') AS g, len(w) - 11 AS n FROM (SELECT item_id, w, unnest(range(1, len(w) - 10)) AS k FROM i)),
dg AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + 11], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 10)) AS k FROM d))
SELECT item_id, doc_id{columns} FROM ig JOIN dg ON ig.g = dg.g GROUP BY item_id, doc_id"""


def _shingles_sql(k: int) -> str:
    """s: each row's distinct runs of k words."""
    return rf"""v AS (SELECT version_id, regexp_extract_all(lower(markdown), '[\p{{L}}\p{{N}}]+') AS w FROM page_versions WHERE version_id IS NOT NULL AND markdown IS NOT NULL),
s AS (SELECT DISTINCT version_id, array_to_string(w[k:k + {k - 1}], ' ') AS g FROM (SELECT version_id, w, unnest(range(1, len(w) - {k - 2})) AS k FROM v))"""


_P6_FOUND = f"""WITH RECURSIVE {_shingles_sql(3)},
n AS (SELECT version_id, count(*) AS n FROM s GROUP BY version_id),
c AS (SELECT x.version_id AS a, y.version_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.version_id <> y.version_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n x ON x.version_id = a JOIN n y ON y.version_id = b WHERE c >= 0.6 * (x.n + y.n - c) - 1e-9),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT a AS version_id_a, b AS version_id_b FROM r WHERE a < b"""
_P6_GROUPS = f"""WITH RECURSIVE {_shingles_sql(5)},
o AS (SELECT version_id, md5(string_agg(g, '|' ORDER BY g)) AS key, count(*) AS n FROM s GROUP BY version_id),
k AS (SELECT key, min(version_id) AS id, min(n) AS n FROM o GROUP BY key),
t AS (SELECT k.id, s.g FROM k JOIN s ON s.version_id = k.id),
c AS (SELECT x.id AS a, y.id AS b, count(*) AS c FROM t x JOIN t y ON x.g = y.g AND x.id <> y.id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN k x ON x.id = a JOIN k y ON y.id = b WHERE c >= 0.8 * (x.n + y.n - c) - 1e-9),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
m AS (SELECT a, min(b) AS b FROM r GROUP BY a), d AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT o.version_id, k.id AS class_id, least(k.id, coalesce(m.b, k.id)) AS group_id, coalesce(d.n, 0) AS n_links FROM o JOIN k USING (key) LEFT JOIN m ON m.a = k.id LEFT JOIN d ON d.a = k.id"""

SQL: dict[str, str] = {
    "p6_found": _P6_FOUND,
    "p6_groups": _P6_GROUPS,
    "p9_found": _leaks_sql(""),
    "p9_leaks": _leaks_sql(", count(DISTINCT k) AS n_windows, max(n) AS item_windows"),
    "p4_found": _P4 + "SELECT c.site, c.line FROM c JOIN t ON c.site = t.site WHERE c.n >= t.pages * 0.125",
    "p4_clean_pages": _P4
    + f""", f AS (SELECT c.site, c.line FROM c JOIN t ON c.site = t.site WHERE c.n >= t.pages * 0.125),
x AS (SELECT page_id, site, string_split(coalesce(markdown, ''), chr(10)) AS parts FROM u),
y AS (SELECT page_id, site, i, parts[i] AS raw FROM (SELECT page_id, site, parts, unnest(range(1, len(parts) + 1)) AS i FROM x)),
z AS (SELECT page_id, site, i, raw, {_LINE} AS line FROM y)
SELECT z.page_id, z.site, coalesce(string_agg(z.raw, chr(10) ORDER BY z.i) FILTER (WHERE f.line IS NULL), '') AS clean_markdown, count(f.line) AS n_removed
FROM z LEFT JOIN f ON z.site = f.site AND z.line = f.line GROUP BY z.page_id, z.site""",
}
