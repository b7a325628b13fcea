"""Problems 6, 8, 9 and 10 against brute force, with empty and odd rows."""

import random
import re
import tracemalloc
from hashlib import blake2b

import numpy as np
import pytest

from tarnloom.llm import leaks, neardup, packing, subjects

WORDS = [f"w{i}" for i in range(60)]


def brute_groups(rows, k, t):
    sets = {}
    for i, text in rows:
        w = re.findall(r"[^\W_]+", (text or "").lower())
        s = frozenset(zip(*(w[j:] for j in range(k))))
        if i is not None and s:
            sets[i] = s
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            c = len(sets[a] & sets[b])
            if c >= t * (len(sets[a]) + len(sets[b]) - c):
                parent[find(b)] = find(a)
    return {(a, b) for a in ids for b in ids if a < b and find(a) == find(b)}


@pytest.mark.parametrize("hot", [neardup.HOT, 1])
def test_near_duplicates_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(neardup, "HOT", hot)
    monkeypatch.setattr(neardup, "BLOCK", 3)
    rng = random.Random(hot)
    rows, i = [], 0
    for _ in range(25):
        base = [rng.choice(WORDS) for _ in range(rng.randint(3, 60))]
        for _ in range(rng.randint(1, 4)):
            w = [x if rng.random() > 0.04 else rng.choice(WORDS) for x in base]
            rows.append((i, " ".join(w) + rng.choice(["", "!", " Extra."])))
            i += 1
    rows += [(1000, None), (1001, ""), (1002, "one two"), (1003, rows[0][1]), (1003, rows[0][1]), (1004, rows[0][1].upper()), (None, rows[0][1])]
    df = spark.createDataFrame([(a, b, 1) for a, b in rows], "version_id bigint, markdown string, key int")
    got = [tuple(r) for r in neardup.found(df).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_groups(rows, 3, 0.6)


@pytest.mark.parametrize("hot", [neardup.HOT, 1])
def test_links_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(neardup, "HOT", hot)
    monkeypatch.setattr(neardup, "BLOCK", 3)
    rng = random.Random(7)
    base = [rng.choice(WORDS) for _ in range(40)]  # a crowd of near copies, and other records
    rows = [(i, " ".join(x if rng.random() > 0.03 else rng.choice(WORDS) for x in base)) for i in range(20)]
    rows += [(100 + i, " ".join(rng.choice(WORDS) for _ in range(30))) for i in range(10)] + [(200, rows[0][1]), (201, None)]
    sets = {}
    for i, text in rows:
        w = (text or "").split()
        if s := frozenset(zip(*(w[j:] for j in range(3)))):
            sets[i] = s
    alike = lambda a, b: len(a & b) >= 0.6 * len(a | b) - 1e-9
    want = {i: sum(alike(s, o) for o in set(sets.values()) - {s}) for i, s in sets.items()}
    df = spark.createDataFrame(rows, "version_id bigint, markdown string")
    assert {r["version_id"]: r["n_links"] for r in neardup.near_duplicate_groups(df, 3, 0.6).collect()} == want and max(want.values()) > 10


def test_near_duplicates_of_nothing(spark):
    df = spark.createDataFrame([], "version_id bigint, markdown string")
    assert neardup.found(df).count() == 0 and neardup.near_duplicate_groups(df).count() == 0


def test_least_shared_is_a_bound():
    rng = np.random.default_rng(0)
    for _ in range(300):
        x = set(rng.choice(400, rng.integers(3, 80), replace=False).tolist())
        y = {v for v in x if rng.random() < 0.85} | set(rng.choice(400, rng.integers(0, 12), replace=False).tolist())
        if not y or len(x & y) < 0.6 * len(x | y):
            continue
        px, py = (set(sorted(s)[: neardup.prefix_length(len(s), 0.6)]) for s in (x, y))
        assert len(px & py) >= neardup.least_shared(np.array([min(len(x), len(y))]), np.array([max(len(x), len(y))]), 0.6)[0]


def test_packing(spark):
    texts = ["word " * n for n in (1, 5, 700, 900, 1500, 2047, 2048, 2049, 5000)] + [None, ""] + ["a few words here"] * 50
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)] + [(3, texts[3], 0), (None, "x", 0)], "doc_id bigint, text string, container_id int")
    sizes = packing.token_sizes(df).toPandas()
    got = packing.pack(df).toPandas()
    assert got.n_tokens.sum() == sizes.n_tokens.sum() and got.groupby("container_id").n_tokens.sum().max() <= 2048
    pieces = got[got.doc_id.notna()].groupby("doc_id").size()
    big = set(sizes[sizes.n_tokens > 2048].doc_id)
    assert all((pieces[d] > 1) == (d in big) for d in pieces.index if d != 3) and pieces[3] == 2 and {9, 10} <= set(got.doc_id)
    assert got.container_id.nunique() <= -(-int(sizes.n_tokens.sum()) // 2048) + 2
    assert packing.pack(df.limit(0)).count() == 0


def test_bucket_bounds_are_optimal():
    from itertools import combinations

    rng = random.Random(0)
    for _ in range(20):
        h = {s: rng.randint(1, 9) for s in rng.sample(range(1, 60), 8)}
        pad = lambda bounds: sum(n * (min(b for b in bounds if b >= s) - s) for s, n in h.items())
        best = min(pad((*c, max(h))) for c in combinations(sorted(h), 2))
        assert pad(packing.bucket_bounds(h, 3)) == best
    assert packing.bucket_bounds({}, 3) == [] and packing.container_plan([], [], 8) == []


@pytest.mark.parametrize("block_words", [40, leaks.BLOCK_WORDS])
def test_leaks_against_brute_force(spark, block_words):
    rng = random.Random(5)
    items = [(i, " ".join(rng.choice(WORDS) for _ in range(rng.randint(5, 40)))) for i in range(12)] + [(12, None), (None, "a b"), (3, "short one")]
    docs = []
    for d in range(60):
        w = [rng.choice(WORDS + ["zzz"]) for _ in range(rng.randint(0, 50))]
        i, text = rng.choice(items[:12])
        x = text.split()
        a = rng.randint(0, max(0, len(x) - 8))
        w[len(w) // 2 : len(w) // 2] = [v.upper() + rng.choice(["", ",", "\n", "*"]) for v in x[a : a + rng.randint(8, 20)]]
        docs.append((d, " ".join(w)))
    docs += [(100, None), (101, ""), (None, items[0][1]), (0, docs[0][1])]
    grams = lambda t: {tuple(w[k : k + 12]) for w in [re.findall(r"[^\W_]+", (t or "").lower())] for k in range(len(w) - 11)}
    want = {(i, d) for i, t in items if i is not None for d, u in docs if d is not None and grams(t) & grams(u)}
    ds = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id bigint, text string, item_id int")
    it = spark.createDataFrame(items, "item_id bigint, text string")
    got = [(r["item_id"], r["doc_id"]) for r in leaks.leaks(ds, it, block_words=block_words).collect()]
    assert len(got) == len(set(got)) and set(got) == want and want
    assert leaks.found(ds.limit(0), it).count() == 0 and leaks.found(ds, it.limit(0)).count() == 0


def test_paragraphs():
    text = "# Head\n\nOne two three four five six.\r\n\r\n- item one two three four five.\n\n```\ncode one two three four five six.\n```\nWrapped words that go on and\non to the end of it. Yes.\n\nshort one.\n\nEach line is a sentence here now.\nAnd so is this one, all the way."
    assert [p[:9] for p in subjects.paragraphs(text)] == ["One two t", "Wrapped w", "Each line", "And so is"]
    assert subjects.paragraphs("") == []


def test_subjects_on_held_out_documents(spark):
    rng = random.Random(2)
    own = {"law": ["judge", "court", "statute", "lawsuit", "verdict"], "food": ["bread", "soup", "oven", "recipe", "flour"]}
    common = ["the", "people", "of", "town", "saw", "a", "long", "street", "with", "many", "windows"]

    def paragraph(subject):
        return " ".join(rng.choice(own[subject]) if subject and rng.random() < 0.35 else rng.choice(common) for _ in range(30)) + "."

    docs, labels, truth = [], [], set()
    for d in range(240):
        kinds = [rng.choice(["law", "food", None])] * 4 if d % 6 else ["law", None, None, None, "food", "food"]
        docs.append((d, "# T\n\n" + "\n\n".join(paragraph(k) for k in kinds)))
        for k in set(kinds) - {None}:
            if kinds.count(k) / len(kinds) >= 0.25:
                truth.add((d, k))
        if d < 120 and d % 6:
            labels.append((d, (kinds[0] or "none").upper() + " ", None))
    docs += [(900, None), (901, ""), (902, "# only a heading")]
    ds = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id bigint, text string, subject_code string")
    ls = spark.createDataFrame(labels + [(5, "bogus", None), (None, "law", None)], "doc_id bigint, subject_code string, labelled_at timestamp")
    areas = spark.createDataFrame([("law",), ("food",)], "subject_code string")
    got = {(r["doc_id"], r["subject_code"]) for r in subjects.found(ds, ls, areas).collect()}
    held = {x for x in truth if x[0] >= 120}
    assert len(held & got) >= 0.95 * len(held) and len(got - truth) <= 0.05 * len(truth)
    assert subjects.found(ds.limit(0), ls, areas).count() == 0 and subjects.found(ds, ls.limit(0), areas).count() == 0


def test_only_paragraphs_with_a_passage_are_cut():
    item = " ".join(f"word{i}" for i in range(20))
    own = "This paragraph has words of its own, seventeen of them, and it is no passage of anything at all."
    text = f"# Head\n\n{own}\n\nBefore it: {item.upper()}, and so the passage ended here. More was said of it, and of many other things that nobody had asked about at all that year.\r\n\r\n{item}. End."
    words = re.findall(r"[^\W_]+", text.lower())
    places = [k for k in range(len(words) - 11) if " ".join(words[k : k + 12]) in item]
    got = subjects.paragraphs(subjects.without_passages(text, places))
    assert len(got) == 2 and got[0] == own.lower() and "word" not in got[1].replace("words", "") and "many other things" in got[1]
    assert subjects.without_passages("Ab c", []) == "ab c" and subjects.without_passages("", [3]) == ""


def test_a_large_benchmark_drops_no_ordinary_paragraph(spark):
    rng = random.Random(9)
    docs = [(i, " ".join(rng.choice(WORDS) for _ in range(40)) + ".") for i in range(30)]
    items = [(k, " ".join(rng.choice(WORDS) for _ in range(60))) for k in range(40)]  # their words are all of the documents' words
    docs.append((99, " ".join(items[0][1].split()[5:35]) + "."))
    ds, it = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    kept = {r["doc_id"] for r in subjects.paragraph_words(ds, it).collect()}
    assert kept == set(range(30))
    assert [(r["doc_id"], sorted(r["places"])) for r in leaks.passages(ds, it).collect()] == [(99, list(range(19)))]
    assert leaks.passages(ds, it.limit(0)).count() == 0


def test_two_subjects_in_one_paragraph(spark):
    rng = random.Random(4)
    own = {"law": ["judge", "court", "statute", "lawsuit", "verdict"], "food": ["bread", "soup", "oven", "recipe", "flour"]}
    common = ["the", "people", "of", "town", "saw", "a", "long", "street", "with", "many", "windows"]
    say = lambda *s: " ".join(rng.choice(own[rng.choice(s)]) if s and rng.random() < 0.4 else rng.choice(common) for _ in range(40)) + "."
    docs = [(d, "\n\n".join(say(*([("law",), ("food",), ()][d % 3])) for _ in range(3))) for d in range(150)]
    docs += [(900 + d, say("law", "food")) for d in range(10)]
    labels = [(d, ["law", "food", "none"][d % 3], None) for d in range(120)]
    ds, ls = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, subject_code string, labelled_at timestamp")
    got = subjects.found(ds, ls, spark.createDataFrame([("law",), ("food",)], "subject_code string")).where("doc_id >= 900")
    assert got.count() >= 18


def test_pairs_of_a_bucket_in_bounded_memory(monkeypatch):
    """A bucket's memory follows its postings, not its pairs: 1,500 records of 20 common shingles are 1,124,250 pairs met 20 times each."""
    records, shared = 1500, 20
    own = np.repeat(np.arange(records, dtype="<u4"), shared)
    block = (np.tile(np.arange(shared, dtype="<u4"), records), own, np.arange(records, dtype="<i8") * 7 - 50, np.full(records, 40, "<u4"))
    monkeypatch.setattr(neardup, "PAIRS", 100_000)
    tracemalloc.start()
    found, counts = 0, set()
    for p, hot in neardup._pairs_of_bucket([block, block], 0.6, 1, neardup.HOT):
        assert not hot and len(p["a"]) <= 100_000
        found += len(p["a"])
        counts |= set(p["n"].tolist())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == records * (records - 1) // 2 and counts == {shared} and peak < 40e6
    monkeypatch.setattr(neardup, "PAIRS", 5000)  # less than one record's: its partners are counted in turns
    again = [p for p, _ in neardup._pairs_of_bucket([block], 0.6, 1, neardup.HOT)]
    assert sum(len(p["a"]) for p in again) == found and {x for p in again for x in p["n"].tolist()} == {shared}


def test_buckets_follow_the_postings_not_the_partitions():
    assert neardup.bucket_count(100, 8) == 8 and neardup.bucket_count(100, 200) == neardup.LEAST_BUCKETS
    assert neardup.bucket_count(800e6, 12) * neardup.POSTINGS >= 800e6


def test_words_are_cut_as_the_pattern_cuts_them():
    texts = ["Ab-c_d 1é2 “Ünï” – a…b c x’y ΑΣ ΟΔΟΣ. ١٢ ½ éf", "plain ascii_text, 3.5!", "", " – ", "日本語、テスト。", "\x00a\x1fb\x7fc d"]
    table = neardup.WordHash()
    for text in texts + ["".join(chr(c) + "a" for c in range(1, 0x3000))]:
        words, hashes = neardup.split_words(text, table)
        assert [w.decode() for w in words] == re.findall(r"[^\W_]+", text.lower()) and len(hashes) == len(words)
        assert hashes.tolist() == [int.from_bytes(blake2b(w, digest_size=8).digest(), "little") for w in words]
