"""Problems 1 to 5 on small pages, with empty and odd ones."""

import datetime as dt

import numpy as np
import pytest

from tarnloom.llm import gru, languages, mainbody, quality, residue, sitelines, tagpaths

SCHEMA = "page_id bigint, url string, html string, markdown string, meta_source_url string, meta_language string, scraped_at timestamp, extra string"
T0 = dt.datetime(2024, 1, 1)
SENTENCES = ("The gardens near the river are open to all visitors in the morning.", "Nobody knows why the letters were kept in the old house by the sea.", "With some care the children counted the windows of the long street.", "There were many stories about the people who came from the hills.")


def page(i, body="", site="a.example", lang="en", html=True, nav="Home", extra="x"):
    prose = [f"{SENTENCES[(i + k) % 4]} Number {i * 7 + k} was told again, and the answer is {i + k} for the village." for k in range(4)]
    lines = [body] if body else prose
    md = f"{nav}\n\n# Title {i}\n\n" + "\n\n".join(lines) + f"\n\nShare this page with your friends\n\n© {i} A Digest. All rights reserved."
    h = f"<html><body><nav><ul><li><a href='/h'>{nav}</a></li></ul></nav><main><h1>Title {i}</h1>" + "".join(f"<p>{x}</p>" for x in lines) + f"<div class='share'>Share this page with your friends</div></main><footer><p>© {i} A Digest. All rights reserved.</p></footer></body></html>"
    return (i, f"https://{site}/p{i}", h if html else None, md, f"https://www.{site.upper()}:443/p{i}?x=1", lang, T0, extra)


@pytest.fixture(scope="module")
def pages(spark):
    rows = [page(i, site="ab"[i % 2] + ".example") for i in range(30)]
    rows += [rows[0][:6] + (T0 + dt.timedelta(1), "again"), (900, None, None, None, None, None, None, None), (901, "", "", "  ", "", "", T0, None), (None, "u", "<p>x</p>", "x", "https://a.example", "en", T0, None)]
    return spark.createDataFrame(rows, SCHEMA).cache()


def test_tag_paths():
    nodes = tagpaths.text_nodes("<div class='b a'><p>one<p>two <b>bold</b></div><script>no</script><table><tr><td>1<td>2</table>")
    assert [n.text for n in nodes] == ["one", "two bold", "1", "2"] and nodes[0].path.marks == ("div.a b", "p")
    assert tagpaths.text_nodes("") == [] and tagpaths.text_nodes("<<<>") is not None
    assert [x.content for x in tagpaths.page_lines(None, "a\n\nb")] == [-1, -1] and tagpaths.page_lines("<p>x</p>", " \n ") == []


def test_main_body(pages):
    got = {r["page_id"]: r for r in mainbody.main_body(pages, ["extra"]).collect()}
    assert set(got) == set(range(30)) and got[0]["extra"] == "again"
    for r in got.values():
        assert not any(t.startswith(("Share", "©", "Home")) for t in r["body"]) and any(t.startswith("# Title") for t in r["body"]) and len(r["body"]) == 5
    lines = mainbody.boilerplate_lines(pages)
    assert lines.dtypes == [("page_id", "bigint"), ("line_no", "bigint")] and lines.where("page_id = 3").count() == 3
    assert mainbody.main_body_text(pages.limit(0)).count() == 0


def test_frequent_lines_against_brute_force(spark, pages):
    import re
    from collections import Counter, defaultdict

    seen, sizes = defaultdict(set), Counter()
    for r in pages.dropDuplicates(["page_id"]).collect():
        if r["page_id"] is None or not r["meta_source_url"]:
            continue
        site = re.sub(r"^www\.", "", r["meta_source_url"].lower().split("//")[1].split("/")[0].split(":")[0])
        sizes[site] += 1
        for x in (r["markdown"] or "").split("\n"):
            k = re.sub(r"[0-9]+", "0", re.sub(r"\s+", " ", x).strip().lower())
            if len(k) >= 10:
                seen[site, k].add(r["page_id"])
    want = {k for k, v in seen.items() if len(v) >= 5 and len(v) >= sizes[k[0]] / 8}
    assert {tuple(r) for r in sitelines.frequent_lines(pages).select("site", "line").collect()} == want and want
    clean = {r["page_id"]: r for r in sitelines.without_frequent_lines(pages).collect()}
    assert "Share this" not in clean[3]["clean_markdown"] and clean[3]["n_removed"] == 6
    assert sitelines.frequent_lines(pages.limit(0)).count() == 0


def test_site_of(spark):
    from pyspark.sql import functions as F

    urls = ["HTTPS://www.A.example:80/x", "//b.example?x", "c.example/p", "", None, "http://u@www.d.example"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, u string")
    assert [r[0] for r in df.orderBy("i").select(sitelines.site_of(F.col("u"))).collect()] == ["a.example", "b.example", "c.example", None, None, "d.example"]


def test_forms():
    assert quality.kinds_of(["- a", "- b", "- c"]) == ["list"] * 3 and quality.kinds_of(["a;1;2", "b;3;4", "c;5;6"]) == ["table"] * 3
    assert quality.kinds_of(["| a | b |", "| --- | --- |", "| 1 | 2 |"]) == ["table"] * 3 and quality.kinds_of([SENTENCES[0]]) == ["text"]
    assert quality.kinds_of(["Kinder, Gäste", "Listen Rom", "Fenster – Bonn"]) == ["list"] * 3


def test_exact_tails_against_brute_force(spark):
    rng = np.random.default_rng(0)
    rows = [(str(g), float(v)) for g, v in zip(rng.integers(0, 3, 500), rng.integers(0, 12, 500))]
    got = quality.exact_tails(spark.createDataFrame(rows, "g string, value double"), ["g"]).collect()
    for r in got:
        own = [v for g, v in rows if g == r["g"]]
        assert r["rank"] == sum(v < r["value"] for v in own) + 1
        assert r["left_tail"] == pytest.approx(sum(v <= r["value"] for v in own) / len(own)) and r["right_tail"] == pytest.approx(sum(v >= r["value"] for v in own) / len(own))


def test_quality(spark, pages):
    rng = np.random.default_rng(1)
    noise = "\n".join("".join(rng.choice(list("bcdfgkq zx"), 60)) for _ in range(8))
    items = "\n".join(f"- Item {k} of it" for k in range(20))
    rows = "| a | b |\n| --- | --- |\n" + "\n".join(f"| x{k} | {k} |" for k in range(20))
    odd = spark.createDataFrame([page(100, noise), page(101, items), page(102, rows), page(103, "the list " * 60)], SCHEMA)
    got = {r["page_id"]: r["text_class"] for r in quality.found(pages.unionByName(odd)).collect()}
    assert got == {100: "junk", 101: "list", 102: "table", 103: "junk"}
    assert quality.found(pages.limit(0)).count() == 0


def test_junk_that_is_common_or_in_a_small_group(spark, pages):
    rng = np.random.default_rng(2)
    noise = lambda: "\n".join("".join(rng.choice(list("bcdfgkq zx"), 60)) + "." for _ in range(8))
    one = noise()
    odd = [page(400 + k, one, site=f"s{k}.example") for k in range(15)] + [page(450, noise(), lang="it"), page(451, noise(), lang=None)]
    odd += [page(460, "\n\n".join(GERMAN), lang="de"), page(461, "\n\n".join(GERMAN[::-1]), lang=None)]  # prose of a rare language stays prose
    got = {r["page_id"]: r["text_class"] for r in quality.found(pages.unionByName(spark.createDataFrame(odd, SCHEMA))).collect()}
    assert got == {k: "junk" for k in (*range(400, 415), 450, 451)}
    alone = spark.createDataFrame([page(460, "\n\n".join(GERMAN), lang="de"), page(450, one, lang="it")], SCHEMA)
    assert [tuple(r) for r in quality.found(alone).collect()] == [(450, "junk")]


def test_residue(spark, pages):
    bad = ["Welcome to {{name}}, the home of {{title}}.", "Order %%price%% today for only __author__.", "Lorem ipsum dolor sit amet consectetur adipiscing elit sed eiusmod tempor."]
    odd = [page(200 + k, b) for k, b in enumerate(bad)] + [page(300 + k, "We could not find the page you asked for.", site=f"s{k}.example") for k in range(6)]
    got = {r["page_id"] for r in residue.found(pages.unionByName(spark.createDataFrame(odd, SCHEMA))).collect()}
    assert got == {200, 201, 202, *range(300, 306)}
    assert residue.found(pages.limit(0)).count() == 0
    assert residue.is_filler("Lorem ipsum dolor sit amet") and not residue.is_filler("A no de la") and residue.has_residue("<%= x %>") and not residue.has_residue("null pointers")


def test_network_learns_and_its_two_forwards_agree():
    rng = np.random.default_rng(0)
    data = np.where(rng.random((200, 64)) < 0.5, rng.integers(97, 103, (200, 64)), 0).astype(np.uint8)
    label = np.arange(200) % 2
    data[label == 1] = np.where(data[label == 1] > 0, data[label == 1] + 10, 0)
    net = gru.ByteGRU(2, 6)
    mask = data > 0
    losses = net.train(data, label, mask, steps=40, batch=32)
    assert losses[-1] < 0.2 * losses[0]
    p = net.probabilities(data, mask)
    assert (p.argmax(1) == label)[mask.any(1)].all()
    s = net.states(data)
    e = np.exp(s @ net.v + net.c)
    assert np.allclose((e / e.sum(-1, keepdims=True) * mask.T[:, :, None]).sum(0), p, atol=1e-3)


def test_gradients_against_differences():
    rng = np.random.default_rng(1)
    data, label, mask = rng.integers(1, 5, (3, 6)).astype(np.uint8), np.array([0, 1, 1]), rng.random((3, 6)) < 0.7
    net = gru.ByteGRU(2, 3)
    for p in net.parts:
        assert p.dtype == np.float32
    _, grads = net.gradients(data, label, mask)
    for p, g in zip(net.parts, grads):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, d = p[at], 1e-2
        p[at] = old + d
        up = net.gradients(data, label, mask)[0]
        p[at] = old - d
        down = net.gradients(data, label, mask)[0]
        p[at] = old
        assert (up - down) / (2 * d) == pytest.approx(g[at], rel=0.05, abs=1e-3)


def test_windows_count_every_byte_once():
    texts = [bytes(range(1, 201)) + b"z" * 100, b"", b"b" * 128, b"abc"]
    data, owner, mask = gru.windows(texts)
    assert owner.tolist() == [0, 0, 0, 1, 2, 3] and data.shape == mask.shape == (6, 128)
    for k, t in enumerate(texts):
        assert data[owner == k][mask[owner == k]].tobytes() == t


GERMAN = ("Niemand weiß, warum die Briefe in dem alten Haus am Meer geblieben sind.", "Die Kinder haben mit einiger Sorgfalt die Fenster der langen Straße gezählt.", "Es gibt viele Geschichten über die Leute, die aus den Bergen kamen.")


def test_languages_on_held_out_pages(spark):
    rows = [page(i) for i in range(40)]
    for i in range(40, 80):
        rows.append(page(i, "\n\n".join(f"{GERMAN[(i + k) % 3]} Nummer {i} wurde dann noch {k} mal erzählt." for k in range(4)), lang="de-AT"))
    for i, lang in ((500, None), (503, "en")):  # no label, and a wrong one
        rows.append(page(i, "\n\n".join(f"{GERMAN[(i + k) % 3]} Nummer {i} wurde dann noch {k} mal erzählt." for k in range(4)), lang=lang))
    rows.append(page(501, "\n\n".join(SENTENCES[k] + " " + SENTENCES[k + 1] + " " + SENTENCES[0] for k in range(3)), lang="unknown"))
    rows.append(page(502, SENTENCES[0], lang=None))
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r["page_id"], r["lang_code"]) for r in languages.found(df).collect()}
    assert {(500, "de"), (503, "de"), (501, "en")} <= got and len(got) <= 5 and 502 not in {p for p, _ in got}
    assert languages.found(df.limit(0)).count() == 0


def test_whole_paragraphs_in_different_languages(spark):
    rows = [page(i) for i in range(40)]
    for i in range(40, 80):
        rows.append(page(i, "\n\n".join(f"{GERMAN[(i + k) % 3]} Nummer {i} wurde dann noch {k} mal erzählt." for k in range(4)), lang="de-AT"))
    rows.append(page(500, "\n\n".join((SENTENCES[0] + " " + SENTENCES[1], SENTENCES[2] + " " + SENTENCES[3], GERMAN[0] + " " + GERMAN[2] + " " + GERMAN[1])), lang="en"))
    rows.append(page(501, "\n\n".join(SENTENCES[k] + " " + SENTENCES[k + 1] + " " + SENTENCES[0] for k in range(3)), lang="unknown"))
    rows.append(page(502, SENTENCES[0], lang=None))
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r["page_id"], r["lang_code"]) for r in languages.found(df).collect()}
    assert {(500, "en"), (500, "de"), (501, "en")} <= got and len(got) <= 5 and 502 not in {p for p, _ in got}
    assert languages.found(df.limit(0)).count() == 0


MORE = ("Im Winter liegt der Schnee bis in den März auf den Dächern der Stadt.", "Wer das Brot gebacken hat, weiß auch heute noch niemand.", "Der Weg durch den Wald ist länger, als er auf der Karte aussieht.")


def test_stretches_and_pooled_languages(spark):
    rows = [page(i) for i in range(40)]
    german = GERMAN + MORE
    for i in range(40, 80):
        rows.append(page(i, "\n\n".join(f"{german[(i + k) % 6]} {german[(2 * i + 3 * k + 1) % 6]}" for k in range(4)), lang="de-AT"))
    rows.append(page(500, SENTENCES[0] + " " + SENTENCES[1] + " " + " ".join(GERMAN) + "\n\n" + " ".join(GERMAN), lang=None))  # the change lies within a paragraph
    rows.append(page(501, "- Gardens near the river\n- Windows of the long street\n- Letters of the old house", lang=None))  # no running paragraph
    rows.append(page(502, "\n\n".join([" ".join(GERMAN)] * 2 + [SENTENCES[0]]), lang="no-label"))
    df = spark.createDataFrame(rows, SCHEMA)
    cut = {}
    for r in languages.stretches(df).where("page_id >= 500").orderBy("page_id", "stretch_no").collect():
        cut.setdefault(r["page_id"], []).append((r["lang_code"], r["first_paragraph"], r["first_sentence"], r["n_sentences"]))
    assert cut[500] == [("en", 0, 0, 2), ("de", 0, 2, 6)] and [x[0] for x in cut[502]] == ["de", "en"] and len(cut[501]) == 1
    whole = {r["page_id"]: r for r in languages.page_languages(df).collect()}
    assert set(whole) == {r[0] for r in rows} and whole[502]["lang_code"] == "de" and whole[502]["confidence"] < whole[45]["confidence"] and whole[502]["n_languages"] == 2
    assert languages.stretches(df.limit(0)).count() == 0 and languages.page_languages(df.limit(0)).count() == 0


def test_sentences_and_paths():
    text = 'One is here. Two "was there!" And three? four'
    assert "".join(languages.sentences(text)) == text and len(languages.sentences(text)) == 4 and languages.sentences("") == []
    p = np.array([[0.9, 0.1], [0.45, 0.55], [0.9, 0.1], [0.05, 0.95], [0.05, 0.95]])
    assert languages.likely_path(p, np.full(5, 3.0)).tolist() == [0, 0, 0, 1, 1]


def test_the_score_decides_what_is_found(spark, pages, monkeypatch):
    items = "\n".join(f"- Item {k} of it" for k in range(20))
    odd = pages.unionByName(spark.createDataFrame([page(101, items)], SCHEMA))
    stats = quality.page_statistics(quality.labelled_body(odd))
    assert quality.judged(stats).where("text_class = 'list'").count() == 1
    same = stats.select(*(quality.F.lit(0.0).alias(c) if c in quality.STATS and c != "list_share" else c for c in stats.columns))
    monkeypatch.setattr(quality, "STATS", tuple(s for s in quality.STATS if s != "list_share"))
    assert quality.judged(same).where("text_class != 'prose'").count() == 0  # all scores alike: no page stands out


def test_long_templates_are_aligned(spark, pages):
    words = [f"{a}{b}" for a in ("alpha", "beta", "gamma", "delta", "kappa") for b in ("one", "two", "three", "four", "five", "six")]
    # the constants: short units on many sites
    short = [page(600 + k, " ".join(words[j : j + 10]) + f" x{k}{j}.", site=f"t{k}.example") for k in range(4) for j in (0,)]
    short += [page(620 + 10 * j + k, " ".join(words[j : j + 10]) + ".", site=f"t{k}.example") for k in range(4) for j in (10, 20)]
    long = [page(700 + k, " ".join(words * 2) + f" of {{{{name}}}} and {k} " + " ".join(words) + ".", site=f"t{k}.example") for k in range(4)]
    assert all(len(r[3]) > 600 for r in long)
    got = {r["page_id"] for r in residue.found(pages.unionByName(spark.createDataFrame(short + long, SCHEMA))).collect()}
    assert {r[0] for r in long} <= got
    lone = residue.found(pages.unionByName(spark.createDataFrame(short + long[:1], SCHEMA)))  # a long text that quotes a variable once, and no record like it
    assert 700 not in {r["page_id"] for r in lone.collect()}


def test_skeletons_against_a_plain_loop():
    rng = np.random.default_rng(3)
    constant = rng.random(51) < 0.4
    constant[-1] = False
    units = [rng.integers(-1, 50, rng.integers(0, 9)) for _ in range(300)]
    key, n = residue.skeletons(np.cumsum([0, *map(len, units)]), np.concatenate(units), constant)

    def plain(u):
        out = []
        for w in u.tolist():
            if w >= 0 and constant[w]:
                out.append(w)
            elif not out or out[-1] != -1:
                out.append(-1)
        return tuple(out)

    want = [plain(u) for u in units]
    assert n.tolist() == [sum(w >= 0 for w in p) for p in want]
    assert len(set(zip(key.tolist(), want))) == len(set(want)) == len(set(key.tolist()))


def test_templates_that_are_too_many_to_broadcast(spark, pages, monkeypatch):
    odd = [page(200, "Welcome to {{name}}, the home of {{title}}.")] + [page(300 + k, "We could not find the page you asked for.", site=f"s{k}.example") for k in range(6)]
    df = pages.unionByName(spark.createDataFrame(odd, SCHEMA))
    want = sorted(map(tuple, residue.residue_pages(df).collect()))
    monkeypatch.setattr(residue, "MAX_TEMPLATES", 0)
    assert sorted(map(tuple, residue.residue_pages(df).collect())) == want and any(r[-1] for r in want)


def test_feature_rows():
    unit, feature = residue.feature_rows(np.array([3, 0, 2]), np.array([5, 5, -1, 7, 5]))
    pair = lambda a, b: (a * 31 + b * 7 + 1) % (1 << residue.BITS) + (1 << residue.BITS)
    assert set(zip(unit.tolist(), feature.tolist())) == {(0, 5), (0, pair(5, 5)), (0, pair(5, -1)), (2, 7), (2, 5), (2, pair(7, 5))}


def test_text_over_two_sibling_containers():
    left, right = [f"{SENTENCES[k % 4]} {SENTENCES[(k + 1) % 4]} Part {k} of it." for k in range(6)], [f"{SENTENCES[(k + 2) % 4]} {SENTENCES[k % 4]} Column {k} of it." for k in range(6)]
    box = "".join(f"<p>{x}</p>" for x in ("Cookies help us.", "See our offers."))
    html = "<body><nav><a href='/h'>Home</a></nav><div class='row'>" + "".join(f"<div class='{c}'>" + "".join(f"<p>{x}</p>" for x in ps) + "</div>" for c, ps in (("left", left), ("right", right))) + f"<div class='box'>{box}</div></div></body>"
    lines = {x.text: x.content for x in tagpaths.page_lines(html, "\n\n".join(["Home", *left, *right, "Cookies help us.", "See our offers."]))}
    assert all(lines[x] == 1 for x in left + right) and lines["Home"] == lines["Cookies help us."] == lines["See our offers."] == 0


def test_a_site_that_holds_half_of_all_pages(spark):
    rows = [page(i, site="big.example" if i % 2 else f"s{i % 5}.example", nav="Menu of the whole site") for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {tuple(r) for r in sitelines.frequent_lines(df).select("site", "line").collect()}
    assert ("big.example", "menu of the whole site") in got and ("big.example", "share this page with your friends") in got
    clean = {r["page_id"]: r for r in sitelines.without_frequent_lines(df).collect()}
    assert len(clean) == 60 and all("Menu of" not in r["clean_markdown"] for r in clean.values())
