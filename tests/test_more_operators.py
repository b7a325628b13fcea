"""Operators without a result that SQL states: against plain Python, with empty and odd rows."""

import json
import random
import time
import uuid

import pytest
from pyspark.sql import functions as F

from tarnloom.functions import answers as A
from tarnloom.functions import text as X
from tarnloom.operators import history, leases, lookup, repos


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x")).alias("y")).first()["y"]


def test_name_uuid(spark):
    names = ["What is it?", "", "Ünïcode ✓", "a" * 5000]
    got = [one(spark, n, A.name_uuid) for n in names]
    assert got == [str(uuid.uuid5(uuid.NAMESPACE_DNS, n)) for n in names] and one(spark, None, A.name_uuid) is None


def test_compact_json(spark):
    long = json.dumps({"a": ["x" * 500] * 9, "b": {"c": "y" * 300}})
    f = A.compact_json(1500)
    got = json.loads(one(spark, long, f))
    assert len(got["a"]) == 6 and got["a"][0] == "x" * 200 + "..." or len(got["a"]) < 6
    assert one(spark, '{"k": "é"}', f) == '{"k": "é"}' and one(spark, None, f) == "{}" and one(spark, "no", f) == "{}"
    assert json.loads(one(spark, json.dumps({str(i): "z" * 100 for i in range(99)}), f)) == {"truncated": True}


def test_odd_answers(spark):
    assert one(spark, None, A.has_content) is False and one(spark, "not json", A.has_content) is True and one(spark, '{"answer": {"x": []}}', A.has_content) is True
    assert one(spark, None, A.expected_fields) == [] and one(spark, "", A.json_kind) is None
    assert one(spark, None, lambda c: A.verification(c)["verified"]) is None


def test_wiki_text_stops_at_the_first_closing_heading(spark):
    html = '<table class="infobox b">x</table>Born 1900.\nSee also\nmore\nReferences\nold'
    assert one(spark, html, X.wiki_text) == "Born 1900." and one(spark, "", X.wiki_text) == "" and one(spark, None, X.wiki_text) is None


def test_tool_prefix(spark):
    cases = {"data/debug-node-js-like-a-boss-t_content.json": "debug_node_js_content", "data/7 wonders.md": "data_7_wonders", "data/---": "data", "": "data", "x/y.tar.gz": "y_tar"}
    assert {k: one(spark, k, X.tool_prefix) for k in cases} == cases


@pytest.mark.parametrize("crossing", [False, True])
def test_take_while_without_a_key(spark, crossing):
    rng = random.Random(3)
    rows = [(i, rng.random() > 0.1) for i in range(60)]
    df = spark.createDataFrame(rows, "i int, ok boolean").repartition(5)
    want = []
    for i, ok in rows:
        if not ok:
            if crossing:
                want.append(i)
            break
        want.append(i)
    got = sorted(r["i"] for r in history.take_while(df, None, ["i"], F.col("ok"), crossing).collect())
    assert got == want
    assert history.take_while(df.where("ok"), None, ["i"], F.col("ok"), crossing).count() == sum(ok for _, ok in rows)
    assert history.take_while(df.limit(0), None, ["i"], F.col("ok"), crossing).count() == 0


def test_lease_events_against_a_plain_reading():
    rng = random.Random(1)
    events = sorted((rng.uniform(0, 300), rng.choice(["acquire", "beat", "release"]), rng.choice("abcdef")) for _ in range(400))
    held, out = leases.apply_lease_events({}, events, 3)
    live = {}
    for (at, kind, who), (*_, ok) in zip(events, out):
        live = {h: t for h, t in live.items() if t + 30 > at}
        assert ok == ((who in live or len(live) < 3) if kind == "acquire" else who in live)
        if ok and kind != "release":
            live[who] = at
        elif ok:
            del live[who]
        assert len(live) <= 3
    assert held == {h: t + 30 for h, t in live.items()}


def test_map_assembly_limits_and_titles(spark):
    rows = lambda *x: spark.createDataFrame(x, "position int, url string, title string")
    index = rows((1, "https://a.example/x?q=1", None), (2, "a.example/y/", None), (3, "nonsense", None), (4, None, None))
    search = rows((1, "https://a.example/x", "X"), (2, "https://b.a.example/z", "Z"), (3, "https://other.test/", "O"))
    empty = spark.createDataFrame([], "position int, url string, title string")
    got = [(r["url"], r["title"]) for r in lookup.map_assembly(index, empty, search, "https://a.example/").orderBy("place").collect()]
    assert got == [("https://a.example/x", "X"), ("http://a.example/y", None), ("https://b.a.example/z", "Z")]
    assert lookup.map_assembly(index, empty, search, "https://a.example/", limit=1).count() == 1
    assert [r["url"] for r in lookup.map_assembly(index, empty, search, "https://a.example/", subdomains=False, search_first=True).orderBy("place").collect()] == ["https://a.example/x", "http://a.example/y"]
    assert lookup.map_assembly(empty, empty, empty, "https://a.example/").count() == 0


def test_numbered_logs(spark):
    text = "\n".join(f"l{i}" for i in range(12))
    got = one(spark, text, lambda c: repos.numbered(c, 5)).split("\n")
    assert got == [" 1   l0", " 2   l1", "     [..., 7 lines omitted ...]", "10   l9", "11   l10", "12   l11"] and one(spark, "a", lambda c: repos.numbered(c, 5)) == "1   a"


def test_repo_rules_on_nulls(spark):
    r = spark.createDataFrame([("a/b", "b", None, None, None), ("a/c", None, "A Demo", ["X"], 90), ("A/D", "d", "d", ["web"], 4500)], "full_name string, name string, description string, topics array<string>, bytes bigint")
    keep = lambda **k: [x["full_name"] for x in repos.kept_repos(r, **k).orderBy("full_name").collect()]
    assert keep() == ["A/D", "a/b", "a/c"] and keep(exclude=["a/d"]) == ["a/b", "a/c"] and keep(keywords=["demo"]) == ["A/D", "a/b"] and keep(topics=["WEB"]) == ["a/b", "a/c"] and keep(least=50) == ["A/D", "a/b"]
    f = spark.createDataFrame([], "repo string, path string")
    assert repos.repo_shapes(f).count() == 0 and repos.snapshot_changes(f.withColumn("sha", F.lit("")), f.withColumn("sha", F.lit(""))).count() == 0


def test_clean_external_on_literals(spark):
    tail = " This sentence is long enough to stay where it is, and says a thing."
    cases = {
        "<script>x</script><nav class='a'>Home</nav><b>Bold</b> &amp; more." + tail: "Bold & more." + tail,
        "Skip to content\n\n\n\nRead more Image 3: [Word](http://a.example/x) www.b.example/y [1] {css} `code` ....." + tail: "Word ." + tail,
        "Facebook 12 and Share 3" + tail: "and" + tail,
        "short": "short",
        "<header>short</header>": "<header>short</header>",
    }
    assert {k: one(spark, k, X.clean_external) for k in cases} == cases and one(spark, None, X.clean_external) is None


def test_site_map_limit_is_of_the_crawl(spark):
    from tarnloom.operators import links as L

    index = lambda *u: "<sitemapindex>" + "".join(f"<sitemap><loc>{x}</loc></sitemap>" for x in u) + "</sitemapindex>"
    maps = [("https://e.x/r.xml", index(*(f"https://e.x/z{9 - k}.xml" for k in range(6))))] + [(f"https://e.x/z{k}.xml", f"<urlset><url><loc>https://e.x/p{k}</loc></url></urlset>") for k in range(10)]
    maps.append(("https://o.x/r.xml", index("https://e.x/z1.xml")))
    df = spark.createDataFrame(maps, "url string, xml string").coalesce(1)
    roots = spark.createDataFrame([("a", "https://e.x/r.xml"), ("b", "https://o.x/r.xml")], "crawl string, url string")
    got = sorted((r["crawl"], r["loc"]) for r in L.sitemap_walk(df, roots, limit=4).collect())
    assert got == [("a", "https://e.x/p7"), ("a", "https://e.x/p8"), ("a", "https://e.x/p9"), ("b", "https://e.x/p1")]


def test_resolve_climbs_any_number_of_folders(spark):
    from urllib.parse import urljoin

    from tarnloom.functions import urls as U

    base = "https://a.example/1/2/3/4/5/6/7/page?q=1#f"
    for href in ("../../../../../../x", "../../../../../../../../../y", "./z", "a/../b/./c?d=../e", "..", "?k=2", "/r", "//o.example/s"):
        assert one(spark, href, lambda c: U.resolve(c, F.lit(base))) == urljoin(base, href)


def test_registrable_domains(spark):
    from tarnloom.functions import urls as U

    cases = {"a.b.gov.uk": "b.gov.uk", "x.com.mx": "x.com.mx", "y.x.co.uk": "x.co.uk", "a.b.example": "b.example", "com.de": "com.de", "a.b.com": "b.com", "one": "one"}
    assert {k: one(spark, k, U.registrable_domain) for k in cases} == cases


def test_text_signatures(spark):
    rows = [(1, "ab c<iframe x>"), (2, " cb\na"), (3, "abcc"), (4, ""), (5, None), (6, "é𝄞"), (7, "𝄞é")]
    got = {r["i"]: r["s"] for r in spark.createDataFrame(rows, "i int, t string").select("i", history.text_signature("t").alias("s")).collect()}
    assert got[1] == got[2] != got[3] and got[5] is None and got[4] is not None and got[6] == got[7]


def test_links_of_pages_in_any_form(spark, tmp_path):
    from tarnloom.plans import web

    rows = [(1, '<base href="/d/"><A class=x HREF=\'one\'>1</A>', "https://a.example/p"), (2, '<a href="/two">2</a>', "https://a.example/p"), (3, None, "https://a.example/p"), (4, "<a>none</a>", "https://a.example/p")]
    spark.createDataFrame([(a, h, u, None) for a, h, u in rows], "page_id bigint, html string, url string, scraped_at timestamp").write.parquet(str(tmp_path / "pages.parquet"))
    assert sorted(tuple(r) for r in web._page_links(spark, str(tmp_path)).collect()) == [(1, "https://a.example/d/one"), (2, "https://a.example/two")]


@pytest.mark.parametrize("least", [1, 2, 3])
def test_files_of_tools_against_all_pairs(spark, least):
    rng = random.Random(least)
    name = lambda: "".join(rng.choice(["a", "b", "ab", "_", "_", "é"]) for _ in range(rng.randint(0, 7)))
    tools = [rng.choice(["get_", "list_", "put_"]) + name() for _ in range(60)] + [None, "get_a_b", "get_a_b", "get_"]
    files = [(f"data/{i}", name()) for i in range(60)] + [("x", None), (None, "a_b"), ("two", "a_b"), ("two", "a_b_a"), ("e", "")]
    alike = lambda a, b: (a in b or b in a) and len(set(a.split("_")) & set(b.split("_"))) >= least
    want = [(t, p) for t in set(tools) - {None} if t.startswith(("get_", "list_")) and (n := t.split("_", 1)[1]) for p, f in set(files) if f is not None and (n == f or alike(n, f))]
    got = repos.files_of_tools(spark.createDataFrame([(t,) for t in tools], "tool string"), spark.createDataFrame(files, "path string, prefix string"), least)
    order = lambda rows: sorted(rows, key=str)
    assert order(tuple(r) for r in got.collect()) == order(want) and len(want) > 5


def test_files_of_tools_that_share_common_tokens(spark):
    """9,000 names on 9,000 files, all with the same two tokens: 81 million pairs, of which 9,000 are meant."""
    files = spark.range(9000).select(F.concat(F.lit("page_"), F.col("id") + 10000, F.lit("_utm_feed")).alias("prefix")).withColumn("path", F.col("prefix"))
    at = time.monotonic()
    assert repos.files_of_tools(files.select(F.concat(F.lit("get_"), "prefix").alias("tool")), files).count() == 9000
    assert time.monotonic() - at < 90
