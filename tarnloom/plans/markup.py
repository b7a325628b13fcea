"""Queries over page html."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarnloom.functions import text as X
from tarnloom.operators import html as H
from tarnloom.tables import table


def _once(spark, d):
    """One delivery of each page: the latest with html."""
    p = table(spark, d, "pages").where("html is not null and page_id is not null")
    return p.groupBy("page_id").agg(F.max_by(F.struct("html", "url", "markdown"), F.struct("scraped_at", "html")).alias("v")).select("page_id", "v.*")


_O = "o AS (SELECT page_id, html, url, markdown FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY scraped_at DESC NULLS LAST, html DESC) AS r FROM pages WHERE html IS NOT NULL AND page_id IS NOT NULL) WHERE r = 1)"


def _titles(spark, d):
    m = H.page_metadata(_once(spark, d))
    return m.select("page_id", F.coalesce(m["metadata"]["title"][0], F.lit("")).alias("title"), F.coalesce(m["metadata"]["language"][0], F.lit("")).alias("language"))


_TITLES = rf"""WITH {_O} SELECT page_id, trim(replace(replace(replace(replace(replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', ''''), '&amp;', '&')) AS title,
regexp_extract(html, '<html\s+lang="([^"]*)"', 1) AS language FROM o WHERE contains(html, '<')"""


def _link_counts(spark, d):
    rows = H.page_attributes(_once(spark, d), "a", "href")
    return rows.select("page_id", F.size("values").alias("n_links")).where("n_links > 0")


def _markdown(spark, d):
    return H.page_markdown(_once(spark, d)).select("page_id", "markdown", F.length("clean_html").alias("html_chars"))


def _images(spark, d):
    return H.page_images(_once(spark, d)).select("page_id", F.explode("images").alias("image"))


def _no_embedded(spark, d):
    return table(spark, d, "pages").where("markdown is not null").groupBy("page_id").agg(F.max(F.md5(X.without_embedded_images(F.col("markdown")))).alias("md5"))


def _word_counts(spark, d):
    """Pages with enough words in their text, markup taken off by patterns."""
    bare = F.regexp_replace(F.regexp_replace("html", r"(?is)<(?:script|style)[^>]*>.*?</(?:script|style)>", " "), r"<[^>]+>", " ")
    return _once(spark, d).select("page_id", F.size(F.split(F.trim(F.regexp_replace(bare, r"\s+", " ")), " ")).alias("n_words")).where("n_words > 100")


QUERIES = {"page_titles": _titles, "page_link_counts": _link_counts, "page_markdown": _markdown, "page_images": _images, "markdown_without_images": _no_embedded, "page_word_counts": _word_counts}
SQL = {
    "page_titles": _TITLES,
    "page_link_counts": f"WITH {_O} SELECT page_id, len(regexp_extract_all(html, '<a href=\"[^\"]*\"'))::INT AS n_links FROM o WHERE contains(html, '<a href')",
    "markdown_without_images": r"SELECT page_id, max(md5(regexp_replace(markdown, '!\[([^\]]*)\]\(data:image/[^;()]+;base64,[^)]*\)', '![\1](<Base64-Image-Removed>)', 'g'))) AS md5 FROM pages WHERE markdown IS NOT NULL GROUP BY page_id",
    "page_word_counts": rf"WITH {_O}, b AS (SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(?:script|style)[^>]*>.*?</(?:script|style)>', ' ', 'g'), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) AS t FROM o) SELECT page_id, len(string_split(t, ' '))::INT AS n_words FROM b WHERE len(string_split(t, ' ')) > 100",
}
