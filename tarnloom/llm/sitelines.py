"""Problem 4: lines that come back on a large share of one site's pages.

1. Lines are normalised and hashed; distinct pages are counted per (site, hash), with partial aggregation before the
   shuffle, so only two numbers a line are moved.
2. Hashes on a large share of the site's pages are gathered per site: as a page has few lines, a site has at most
   1 / min_share times its lines per page of them.
3. They are joined back to the pages, and the lines they stand for are counted again by their text, so that lines of
   one hash are told apart. Pages are rebuilt in place, line by line, without exploding them.

A site may hold a third of all pages: its counts are summed before the shuffle, and where pages meet their site's lines
each site is spread over SALTS parts, which adaptive execution splits further.

Defined results: pages without meta_source_url or with a blank one have no site and are left out; NULL or blank
markdown counts as a page of the site without lines; repeated deliveries of a page_id count once (the latest
scraped_at, ties by content); NULL page_id rows are left out; a site with few pages has no case below MIN_PAGES.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_LENGTH, MIN_PAGES, MIN_SHARE = 10, 5, 0.125
SALTS = 16


def site_of(url: Column) -> Column:
    """Host in lower case without port, user part and one leading www.; NULL where there is none."""
    rest = F.regexp_replace(F.trim(url), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//", "")
    host = F.regexp_extract(rest, r"^(?:[^/?#@]*@)?([^/?#]*)", 1)
    host = F.regexp_replace(F.regexp_replace(F.lower(host), r":\d*$", ""), r"^www\.", "")
    return F.when(host != "", host)


def normal_line(line: Column) -> Column:
    """Trimmed, white space runs as one space, lower case, digit runs as 0."""
    spaced = F.trim(F.regexp_replace(line, r"(?U)\s+", " "))
    return F.regexp_replace(F.lower(spaced), r"[0-9]+", "0")


def once_per_page(pages: DataFrame) -> DataFrame:
    """page_id, site, markdown: one row per page that has a site."""
    rows = pages.where(F.col("page_id").isNotNull()).select("page_id", "scraped_at", site_of(F.col("meta_source_url")).alias("site"), "markdown").where(F.col("site").isNotNull())
    value = F.struct("site", "markdown")
    return rows.groupBy("page_id").agg(F.max_by(value, F.struct("scraped_at", "markdown")).alias("v")).select("page_id", "v.site", "v.markdown")


def normal_lines(markdown: Column) -> Column:
    return F.transform(F.split(markdown, "\n"), normal_line)


def _with_site(once: DataFrame, held: DataFrame, how: str) -> DataFrame:
    """Pages with what is held of their site (one row a site), each site spread over SALTS parts."""
    spread = held.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return once.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int")).join(spread, ["site", "salt"], how).drop("salt")


def frequent_lines(pages: DataFrame, min_length: int = MIN_LENGTH, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """site, line, n_pages, site_pages of every line repeated excessively within its site."""
    return _frequent(once_per_page(pages), min_length, min_pages, min_share)


def _frequent(once: DataFrame, min_length: int, min_pages: int, min_share: float) -> DataFrame:
    sizes = once.groupBy("site").agg(F.count("*").alias("site_pages")).where(F.col("site_pages") >= min_pages)
    long = F.filter(normal_lines(F.col("markdown")), lambda x: F.length(x) >= min_length)
    hashes = once.select("site", F.explode(F.array_distinct(F.transform(long, lambda x: F.xxhash64(x)))).alias("h"))
    often = hashes.groupBy("site", "h").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    held = often.join(sizes, "site").where(F.col("n") >= F.col("site_pages") * min_share).groupBy("site").agg(F.collect_list("h").alias("hashes"), F.max("site_pages").alias("site_pages"))
    met = _with_site(once, held, "inner").select("site", "site_pages", F.explode(F.array_distinct(F.filter(long, lambda x: F.array_contains("hashes", F.xxhash64(x))))).alias("line"))
    counted = met.groupBy("site", "line").agg(F.count("*").alias("n_pages"), F.max("site_pages").alias("site_pages"))
    return counted.where((F.col("n_pages") >= min_pages) & (F.col("n_pages") >= F.col("site_pages") * min_share))


def without_frequent_lines(pages: DataFrame, min_length: int = MIN_LENGTH, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """Each page of a site without its frequent lines: page_id, site, clean_markdown, n_removed."""
    once = once_per_page(pages)
    bad = _frequent(once, min_length, min_pages, min_share).groupBy("site").agg(F.collect_list("line").alias("bad"))
    parts = F.split(F.coalesce("markdown", F.lit("")), "\n")
    rows = _with_site(once, bad, "left").select("page_id", "site", parts.alias("parts"), F.coalesce("bad", F.array().cast("array<string>")).alias("bad"))
    kept = F.filter("parts", lambda x: ~F.array_contains("bad", normal_line(x)))
    return rows.select("page_id", "site", F.array_join(kept, "\n").alias("clean_markdown"), (F.size("parts") - F.size(kept)).cast("bigint").alias("n_removed"))
