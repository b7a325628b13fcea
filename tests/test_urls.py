import pytest
from pyspark.sql import functions as F

from tarnloom.functions import urls as U
from tarnloom.operators import links as L


def one(spark, fn, *urls):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, u string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("u"))).collect()]


def test_record_key(spark):
    assert one(spark, U.record_key, " HTTPS://Ex.com/A/ ", "//ex.com", "http://ex.com/", "http://ex.com/a?b#c", "", "ex") == [
        "https://ex.com/A", "https://ex.com", "http://ex.com/", "http://ex.com/a", "", "https://ex"]


def test_keys_are_idempotent(spark):
    urls = ["https://www.ex.com:443/a/index.html", "http://ex.com/#/r", "https://ex.com/?q=1", "http://WWW.ex.com"]
    for fn in (U.record_key, U.index_key, U.permutation_key, U.crawl_key):
        once = one(spark, fn, *urls)
        assert one(spark, fn, *once) == once


def test_index_key(spark):
    assert one(spark, U.index_key, "http://www.ex.com:80/a/index.php", "https://ex.com/#top", "https://ex.com/#/r", "https://ex.com/a/?x=1") == [
        "https://ex.com/a", "https://ex.com", "https://ex.com/#/r", "https://ex.com/a/?x=1"]


def test_permutations_close(spark):
    every = one(spark, U.permutations, "https://www.ex.com")[0]
    assert len(set(every)) == 16
    assert {frozenset(x) for x in one(spark, U.permutations, *every)} == {frozenset(every)}
    assert len(set(one(spark, U.permutation_key, *every))) == 1


def test_splits_and_domains(spark):
    assert one(spark, U.url_splits, "https://www.ex.com/a/b?x=1")[0] == ["https://ex.com", "https://ex.com/a", "https://ex.com/a/b", "https://ex.com/a/b?x=1"]
    assert one(spark, U.domain_splits, "a.b.ex.co.uk")[0] == ["ex.co.uk", "b.ex.co.uk", "a.b.ex.co.uk"]


def test_files_depth_and_links(spark):
    assert one(spark, lambda u: U.is_file(U.path(u)), "http://e.x/a.png", "http://e.x/a.PNG", "http://e.x/a") == [True, False, False]
    assert one(spark, U.depth, "http://e.x/a/b/index.html", "http://e.x/", "http://e.x") == [2, 0, 0]
    assert one(spark, lambda u: U.resolve(u, F.lit("https://e.x/d/p?q")), "/r", "s", "../t", "//o.x/u", "#a", "mailto:a@b", "http:/z.x/") == [
        "https://e.x/r", "https://e.x/d/s", "https://e.x/t", "https://o.x/u", "", "mailto:a@b", "http://z.x/"]


def test_export_url(spark):
    assert one(spark, U.export_url, "https://docs.google.com/document/d/abc/edit", "https://docs.google.com/document/d/e/abc/pub", "https://drive.google.com/file/d/q1/view", "https://e.x") == [
        "https://docs.google.com/document/d/abc/export?format=pdf", None, "https://drive.google.com/uc?export=download&id=q1", None]


def test_filter_links(spark):
    links = ["https://e.x/a", "https://e.x/b", "https://e.x/c.pdf.png", "https://e.x/p#s", "ftp://e.x", "https://sub.e.x/q", "https://o.x/", "https://o.x/deep", "https://twitter.com/e", None]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(links)], "seq int, link string")
    o = L.LinkOptions("https://e.x/", excludes=("^/b",), allow_subdomains=True, limit=1)
    got = {r["seq"]: r["denial_reason"] for r in L.filter_links(df, o).collect()}
    assert got[0] is None and got[1] == "EXCLUDE" and got[2] == "FILE" and got[3] == "SECTION" and got[4] == "PROTOCOL"
    assert got[5] == "LIMIT" and got[6] == "EXTERNAL" and got[7] == "EXTERNAL" and got[8] == "SOCIAL"


def test_robots(spark):
    text = "User-agent: other\nDisallow: /\n\nUser-agent: *\nDisallow: /private\nAllow: /private/open # yes\nDisallow: /*.tmp\n"
    rules = L.parse_robots(spark.createDataFrame([("e.x", text)], "host string, robots_txt string"))
    links = spark.createDataFrame([(f"https://e.x{p}",) for p in ("/", "/private/a", "/private/open/b", "/q.tmp")] + [("https://o.x/private",)], "link string")
    got = {r["link"]: r["allowed"] for r in L.robots_allowed(links, rules).collect()}
    assert got == {"https://e.x/": True, "https://e.x/private/a": False, "https://e.x/private/open/b": True, "https://e.x/q.tmp": False, "https://o.x/private": True}


def test_sitemaps(spark):
    ns = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'
    maps = spark.createDataFrame([
        ("https://e.x/sitemap.xml", f"<sitemapindex {ns}><sitemap><loc>https://e.x/a.xml</loc></sitemap><sitemap><loc>https://e.x/sitemap.xml</loc></sitemap></sitemapindex>"),
        ("https://e.x/a.xml", f"<urlset {ns}><url><loc> https://e.x/p </loc></url><url><loc>https://e.x/i.PNG</loc></url></urlset>")], "url string, xml string")
    roots = spark.createDataFrame([("https://e.x/sitemap.xml",)], "url string")
    assert [tuple(r) for r in L.sitemap_walk(maps, roots).collect()] == [("https://e.x/a.xml", "https://e.x/p")]


def test_frontier(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("x", "y")], "src string, dst string")
    got = {r["node"]: r["depth"] for r in L.crawl_frontier(e, spark.createDataFrame([("a",), (None,)], "node string"), 2).collect()}
    assert got == {"a": 0, "b": 1, "c": 2}


@pytest.mark.parametrize("url,want", [("ex.com/", "http://ex.com"), ("https://ex.com", "https://ex.com"), ("ftp://ex.com", None), ("nodot", None)])
def test_checked(spark, url, want):
    assert one(spark, U.checked, url) == [want]
