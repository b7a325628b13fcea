"""Problem 5: the language of each page and of each stretch of one language, with a confidence.

1. Paragraphs of running sentences are taken from the main body (blocks between blank lines; lists, tables, headings
   and code apart). A page without any has its other text, else all of it, as its paragraphs.
2. A bidirectional gated recurrent network over bytes is trained in numpy on windows of at most TRAIN_PAGES pages whose
   label names a language (those with the least hash of page_id), at most PAGE_WINDOWS of each; paragraphs that it then
   places elsewhere with confidence are taken as mislabelled, and it is trained once more on the rest.
3. It labels every byte of every paragraph. The probabilities of all bytes of a page are pooled to the page's language
   and confidence, those of a paragraph to the paragraph's. Stretches are cut from the positions: the bytes of each
   sentence are pooled, and the most likely path over a page's sentences pays SWITCH for each change of language.

p5_found asks for the language of most paragraphs, so it counts the paragraphs' languages. Pages of p1_found and
p3_found and those with fewer than MIN_PARAGRAPHS paragraphs are no cases and are left out before the network.

Defined results: pages with NULL or blank markdown have no language; NULL or unknown labels are no labels; ties go to
the first of en, de, fr, es, it; without any label to train on the result is empty; repeated deliveries count once;
texts are read whole, in windows of at most CHUNK bytes.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnloom.llm import quality, residue
from tarnloom.llm.arrow import map_rows
from tarnloom.llm.gru import CHUNK, ByteGRU, windows
from tarnloom.llm.labels import LANGS, language_code
from tarnloom.llm.mainbody import main_body
from tarnloom.llm.quality import Measures, blocks_of
from tarnloom.llm.sitelines import site_of
from tarnloom.session import materialize

TRAIN_PAGES, PAGE_WINDOWS = 1500, 64
HIDDEN, STEPS, BATCH = 16, 260, 512
MIN_PARAGRAPHS = 3
SWITCH = 4.0  # log-odds that a change of language costs a stretch
SENTENCE_BREAK = re.compile(r"(?<=[.!?…])[\"'”’»)\]*_]*\s+")


def page_texts(no: list[int], lines: list[str]) -> list[str]:
    """A page's running paragraphs; without any, its other text, else all of it."""
    m = Measures(no, lines)
    return m.paragraphs or m.text or [" ".join(x) for x in blocks_of(no, lines)] or [" ".join(lines)]


def as_bytes(text: str) -> bytes:
    """UTF-8 of the lower-cased text; digits say nothing of a language and count as one sign."""
    return re.sub(r"[0-9]+", "0", text.lower()).encode("utf-8", "ignore").replace(b"\0", b" ")


def train_network(data: np.ndarray, label: np.ndarray, mask: np.ndarray, seed: int = 0) -> ByteGRU | None:
    """A network from windows (see `gru.windows`) and the language number of each."""
    if len(np.unique(label)) < 2:
        return None
    first = ByteGRU(len(LANGS), HIDDEN, seed)
    first.train(data, label, mask, steps=STEPS // 2, seed=seed)  # too few to learn wrong labels by heart
    p = np.concatenate([first.probabilities(data[i : i + BATCH], mask[i : i + BATCH]) for i in range(0, len(data), BATCH)])
    p /= np.maximum(1e-9, p.sum(1, keepdims=True))
    keep = p[np.arange(len(label)), label] >= 0.5
    if len(np.unique(label[keep])) == len(np.unique(label)):
        data, label, mask = data[keep], label[keep], mask[keep]
    first.train(data, label, mask, steps=STEPS - STEPS // 2, rate=0.01, seed=seed + 1)
    return first


def network_of(texts: DataFrame, train_pages: int = TRAIN_PAGES) -> ByteGRU | None:
    """Trained on windows of at most train_pages pages of texts (page_id, label, paragraphs) that have a label."""
    labelled = texts.where("label is not null and size(paragraphs) > 0")
    n = labelled.count()
    place = F.pmod(F.xxhash64("page_id"), F.lit(1 << 40))
    # twice the pages asked for, by hash, so that no task sends many rows to the driver; the least hashes of them are taken
    near = labelled.where(place < int((1 << 40) * min(1.0, 2.0 * train_pages / max(1, n)))) if n > 4 * train_pages else labelled

    def cut(c: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"page_id": c["page_id"], "place": c["place"], "label": c["label"], "data": [], "mask": []}
        for paragraphs in c["paragraphs"]:
            data, _, mask = windows([as_bytes(p) for p in paragraphs])
            if len(data) > PAGE_WINDOWS:
                at = np.linspace(0, len(data) - 1, PAGE_WINDOWS).astype(int)
                data, mask = data[at], mask[at]
            out["data"].append(data.tobytes())
            out["mask"].append(np.packbits(mask, axis=1).tobytes())
        return out

    rows = map_rows(near.select("page_id", place.alias("place"), "label", "paragraphs"), cut, "page_id bigint, place bigint, label string, data binary, mask binary")
    rows = rows.orderBy("place", "page_id").limit(train_pages).collect()
    if not rows:
        return None
    data = np.concatenate([np.frombuffer(r["data"], np.uint8) for r in rows]).reshape(-1, CHUNK)
    mask = np.unpackbits(np.concatenate([np.frombuffer(r["mask"], np.uint8) for r in rows]).reshape(-1, CHUNK // 8), axis=1).astype(bool)
    label = np.repeat([LANGS.index(r["label"]) for r in rows], [len(r["data"]) // CHUNK for r in rows])
    return train_network(data, label, mask)


LABELLED = "page_id bigint, label string, langs array<string>, confidences array<double>, pooled array<double>"


def paragraph_languages(texts: DataFrame, network: ByteGRU) -> DataFrame:
    """page_id, label, langs, confidences (of its paragraphs in order), pooled (probability of each of LANGS over all bytes)."""
    shared = texts.sparkSession.sparkContext.broadcast(network)

    def label(c: dict[str, list]) -> dict[str, list]:
        flat = [as_bytes(p) for ps in c["paragraphs"] for p in ps]
        data, owner, mask = windows(flat)
        sums = np.zeros((len(flat), len(LANGS)))
        for i in range(0, len(data), BATCH):
            np.add.at(sums, owner[i : i + BATCH], shared.value.probabilities(data[i : i + BATCH], mask[i : i + BATCH]))
        out: dict[str, list] = {"page_id": c["page_id"], "label": c["label"], "langs": [], "confidences": [], "pooled": []}
        at = 0
        for ps in c["paragraphs"]:
            q = sums[at : at + len(ps)]
            at += len(ps)
            whole = q.sum(0)
            q = q / np.maximum(1e-9, q.sum(1, keepdims=True))
            out["langs"].append([LANGS[k] for k in q.argmax(1)])
            out["confidences"].append([round(float(x), 4) for x in q.max(1)])
            out["pooled"].append((whole / max(1e-9, whole.sum())).tolist())
        return out

    return map_rows(texts.select("page_id", "label", "paragraphs"), label, LABELLED)


def sentences(paragraph: str) -> list[str]:
    """The paragraph cut behind its sentence ends; nothing is lost."""
    out, begin = [], 0
    for m in SENTENCE_BREAK.finditer(paragraph):
        out.append(paragraph[begin : m.end()])
        begin = m.end()
    if begin < len(paragraph):
        out.append(paragraph[begin:])
    return out


def likely_path(p: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The most likely sequence of classes: rows of probabilities count by weight, each change costs SWITCH."""
    gain = np.log(p + 1e-6) * weight[:, None]
    best, back = gain[0], []
    for g in gain[1:]:
        top = int(best.argmax())
        moved = best[top] - SWITCH
        back.append(np.where(best >= moved, np.arange(len(best)), top))
        best = np.maximum(best, moved) + g
    path = [int(best.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return np.array(path[::-1])


STRETCH = "page_id bigint, stretch_no int, first_paragraph int, first_sentence int, n_sentences int, n_bytes bigint, lang_code string, confidence double"


def text_stretches(texts: DataFrame, network: ByteGRU) -> DataFrame:
    """One row for each stretch of one language of texts (page_id, paragraphs)."""
    shared = texts.sparkSession.sparkContext.broadcast(network)

    def cut(c: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {k.split()[0]: [] for k in STRETCH.split(", ")}
        for page, paragraphs in zip(c["page_id"], c["paragraphs"]):
            parts = [(k, j, as_bytes(x)) for k, p in enumerate(paragraphs) for j, x in enumerate(sentences(p))]
            parts = [x for x in parts if x[2]]
            if not parts:
                continue
            joined = [b"".join(x for k, _, x in parts if k == own) for own in sorted({k for k, _, _ in parts})]
            data, _, mask = windows(joined)
            pos = [shared.value.positions(data[i : i + BATCH]).transpose(1, 0, 2)[mask[i : i + BATCH]] for i in range(0, len(data), BATCH)]
            lengths = np.array([len(x) for _, _, x in parts])
            starts = np.cumsum(lengths) - lengths
            p = np.add.reduceat(np.concatenate(pos), starts, axis=0, dtype=np.float64) / lengths[:, None]
            path = likely_path(p, np.minimum(lengths, 200) / 20)
            edges = np.concatenate(([0], np.flatnonzero(np.diff(path)) + 1, [len(path)]))
            for no, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
                n = int(lengths[a:b].sum())
                row = (page, no, parts[a][0], parts[a][1], int(b - a), n, LANGS[path[a]], round(float((p[a:b, path[a]] * lengths[a:b]).sum() / n), 4))
                for k, v in zip(out, row):
                    out[k].append(v)
        return out

    return map_rows(texts.select("page_id", "paragraphs"), cut, STRETCH)


def labelled_main_body(pages: DataFrame) -> DataFrame:
    label = language_code(F.col("meta_language"))
    named = pages.withColumn("label", label).withColumn("lang", F.coalesce(label, F.lit("und"))).withColumn("site", site_of(F.col("meta_source_url")))
    return materialize(main_body(named, ["label", "lang", "site"]), "body")


def labelled_texts(pages: DataFrame) -> DataFrame:
    """page_id, label, paragraphs of every page that has text."""

    def cut(c: dict[str, list]) -> dict[str, list]:
        return {"page_id": c["page_id"], "label": c["label"], "paragraphs": [page_texts(no, lines) for no, lines in zip(c["body_no"], c["body"])]}

    body = main_body(pages.withColumn("label", language_code(F.col("meta_language"))), ["label"]).where(F.size("body") > 0)
    return materialize(map_rows(body.select("page_id", "label", "body_no", "body"), cut, "page_id bigint, label string, paragraphs array<string>"), "texts")


def stretches(pages: DataFrame) -> DataFrame:
    """page_id, stretch_no, first_paragraph, first_sentence, n_sentences, n_bytes, lang_code, confidence: each stretch of one language."""
    texts = labelled_texts(pages)
    network = network_of(texts)
    return pages.sparkSession.createDataFrame([], STRETCH) if network is None else text_stretches(texts, network)


def page_languages(pages: DataFrame) -> DataFrame:
    """page_id, label, lang_code and confidence (pooled over all bytes), n_paragraphs, n_languages (of its paragraphs)."""
    texts = labelled_texts(pages)
    network = network_of(texts)
    p = pages.sparkSession.createDataFrame([], LABELLED) if network is None else paragraph_languages(texts, network)
    best = F.array_max(F.transform("pooled", lambda x, i: F.struct(x.alias("p"), (-i).alias("i"))))
    code = F.element_at(F.array(*map(F.lit, LANGS)), F.lit(1) - best["i"])
    return p.select("page_id", "label", code.alias("lang_code"), F.round(best["p"], 4).alias("confidence"), F.size("langs").alias("n_paragraphs"), F.size(F.array_distinct("langs")).alias("n_languages"))


def found(pages: DataFrame) -> DataFrame:
    """p5_found: page_id, lang_code."""
    body = labelled_main_body(pages)
    measured = quality.page_statistics(body, ["label"], paragraphs=True)
    network = network_of(measured)
    if network is None:
        return pages.sparkSession.createDataFrame([], "page_id bigint, lang_code string")
    other = quality.judged(measured.drop("paragraphs", "label")).where("text_class != 'prose'").select("page_id")
    other = materialize(other.unionAll(residue.residue_pages(pages, body).where("excluded").select("page_id")), "other")
    asked = measured.where(F.size("paragraphs") >= MIN_PARAGRAPHS).select("page_id", "label", "paragraphs").join(other, "page_id", "left_anti")
    p = paragraph_languages(asked, network)
    count = lambda code: F.size(F.filter("langs", lambda x: x == F.lit(code)))
    best = F.array_max(F.array(*(F.struct(count(c).alias("n"), F.lit(-i).alias("i"), F.lit(c).alias("code")) for i, c in enumerate(LANGS))))["code"]
    case = F.col("label").isNull() | (F.col("label") != best) | (F.size(F.array_distinct("langs")) > 1)
    return p.where(case).select("page_id", F.explode(F.array_distinct("langs")).alias("lang_code"))
