"""Problem 10: subject areas of each document.

1. One pass cuts every document into paragraphs of running text (headings, lists, tables, code and signatures apart)
   and keeps their hashed words. Passages of held-out items are found as problem 9 finds them, window by window, and
   cut out; a paragraph that is mostly such a passage is left out.
2. Complement naive Bayes is trained from labelled documents: the weight of a word for a subject is the log of its
   frequency in all text over its frequency outside the subject. Only words that stand mostly with one subject take
   part, so that the common words of a language with few labels favour no subject. `none` belongs to every complement
   and to no subject.
3. Expectation-maximization: the paragraphs of all documents are shared out to subjects and none by the model's own
   posteriors, in which a document's label stays as evidence (LABEL), and the counts are made again, until less than
   SETTLED of them moves or ROUNDS rounds are over. Labels are not binding: some are wrong, and most documents have
   paragraphs on other matters.
4. Per subject, a logistic curve maps what is left of its margin after part of the strongest other's to a posterior of
   its own, fitted on labelled documents of the subject and of none that no model was trained on (one in HELD_OUT, by
   hash). A paragraph on two subjects has two high posteriors.
5. A document has every subject that at least a quarter of its paragraphs are about; its posterior is that of the
   paragraph a quarter down from the top.

Classifiers are fitted on at most MAX_LABELS labelled documents (those with the least hash of doc_id); counts, EM and
results cover all documents. Tables are of fixed size: (subjects + 1) × 2**BITS.

Defined results: NULL, blank or paragraph-less texts have no subject; repeated doc_id rows are documents of their own
and give one row per (doc_id, subject_code) with the largest posterior; labels with unknown codes are left out; of
several labels the latest counts (ties by code); without labels or documents the result is empty.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnloom.llm import leaks
from tarnloom.llm.arrow import Hashed, map_rows
from tarnloom.session import materialize

BITS = 17
MAX_LABELS = 50_000
ROUNDS, SETTLED = 3, 0.02
BESIDE = 0.5  # part of the strongest other subject's margin that counts against one: stray words are no second subject, two subjects are two
LABEL = 1.0  # log-odds that a label adds for its subject
NONE = 2.0  # margin that a subject must have to take as much of a paragraph as none
HELD_OUT = 5  # one of so many labelled documents only calibrates
SMOOTH, CONCENTRATION = 2.0, 0.5
SHARE = 0.25
BINS, TOP = 64, 8.0  # of log1p(margin), for calibration

WORD = re.compile(r"[^\W\d_]+")
LINE_END = re.compile(r"[.!?…][\"'”’»)\]*_]*$")
SENTENCE = re.compile(r"[.!?…](?:\s|$|[\"'”’»)*_])")
ITEM = re.compile(r"\s*(?:[-*•+>|–]\s|\d+[.)]\s|#)")
BLANK = re.compile(r"\n[ \t]*\n")


def paragraphs(text: str) -> list[str]:
    """Running text: blocks with at least one sentence of six words; lines that all end as sentences stand alone."""
    groups: list[list[str]] = []
    code = False
    for block in BLANK.split(text.replace("\r\n", "\n").replace("\r", "\n")):
        lines: list[str] = []
        for line in block.split("\n"):
            s = line.strip()
            if s.startswith("```"):
                code = not code
                continue
            if code or not s or ITEM.match(line):
                if lines:
                    groups.append(lines)
                    lines = []
                continue
            lines.append(s)
        if lines:
            groups.append(lines)
    out: list[str] = []
    for lines in groups:
        out += lines if all(LINE_END.search(x) for x in lines) else [" ".join(lines)]
    return [p for p in out if SENTENCE.search(p) and len(WORD.findall(p)) >= 6]


def without_passages(text: str, places: list[int]) -> str:
    """The lower-cased text without the windows of leaks.WINDOW words that begin at the given words.

    In a paragraph, a passage's words go; if they are the most of it, all of it goes.
    """
    text = text.lower()
    words = [m.span() for m in leaks.WORD.finditer(text)]
    inside = np.zeros(len(words), bool)
    for p in places:
        inside[p : p + leaks.WINDOW] = True
    starts = np.array([a for a, _ in words])
    out, at = [], 0
    for k in np.flatnonzero(inside):  # signs of passage words become blanks of the same length
        a, b = words[k]
        out += [text[at:a], " " * (b - a)]
        at = b
    cut = "".join(out) + text[at:]
    for a, b in _blocks_at(text):
        i, j = np.searchsorted(starts, (a, b))
        if inside[i:j].sum() * 2 > j - i:
            cut = cut[:a] + "".join("\n" if x == "\n" else " " for x in cut[a:b]) + cut[b:]
    return cut


def _blocks_at(text: str) -> list[tuple[int, int]]:
    """Where the blocks between blank lines begin and end."""
    out, begin = [], 0
    for m in re.finditer(r"\r?\n[ \t]*\r?\n", text):
        out.append((begin, m.start()))
        begin = m.end()
    return [*out, (begin, len(text))]


def paragraph_words(documents: DataFrame, benchmark: DataFrame | None) -> DataFrame:
    """doc_id, sizes (words per paragraph) and ids (all hashed words in order)."""
    source = documents.where("doc_id is not null and text is not null").select("doc_id", "text")
    if benchmark is None:
        source = source.withColumn("places", F.lit(None).cast("array<int>"))
    else:  # few documents hold a passage: Spark broadcasts their places while they are small
        source = source.join(materialize(leaks.passages(source, benchmark), "passages"), "doc_id", "left")

    def cut(c: dict[str, list], table: Hashed) -> dict[str, list]:
        out: dict[str, list] = {"doc_id": [], "sizes": [], "ids": []}
        for doc, text, places in zip(c["doc_id"], c["text"], c["places"]):
            if places:
                text = without_passages(text, [p for p in places if p is not None])
            sizes, ids = [], []
            for p in paragraphs(text):
                words = WORD.findall(p.lower())
                sizes.append(len(words))
                ids += map(table.__getitem__, words)
            if sizes:
                out["doc_id"].append(doc)
                out["sizes"].append(sizes)
                out["ids"].append(ids)
        return out

    return materialize(map_rows(source, cut, "doc_id bigint, sizes array<int>, ids array<int>", setup=lambda: Hashed(BITS)), "paragraph-words")


def held_out(doc: int) -> bool:
    return zlib.crc32(str(doc).encode()) % HELD_OUT == 0


def label_sample(labels: DataFrame, codes: list[str], limit: int = MAX_LABELS) -> dict[int, int]:
    """doc_id → class of at most `limit` labelled documents; len(codes) stands for none."""
    code = F.lower(F.trim("subject_code"))
    known = labels.where(F.col("doc_id").isNotNull() & code.isin(*codes, "none")).select("doc_id", code.alias("code"), "labelled_at")
    latest = known.groupBy("doc_id").agg(F.max_by("code", F.struct("labelled_at", "code")).alias("code"))
    rows = latest.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit).collect()
    place = {c: i for i, c in enumerate([*codes, "none"])}
    return {r["doc_id"]: place[r["code"]] for r in rows}


class Model:
    """Sparse weights: for informative words only, one weight per subject; and the curves of the posteriors."""

    def __init__(self, counts: np.ndarray, curve: np.ndarray | None = None):
        total, prior = counts.sum(0), counts.sum(1) / max(1.0, counts.sum())
        share = (counts + SMOOTH * prior[:, None]) / (total + SMOOTH)
        keep = np.flatnonzero((share[:-1].max(0) >= CONCENTRATION) & (total > 0))
        complement = total[keep] - counts[:-1, keep]
        mass = counts.sum() - counts[:-1].sum(1, keepdims=True)
        size = float(1 << BITS)
        self.place = np.full(1 << BITS, -1, np.int32)
        self.place[keep] = np.arange(len(keep))
        everywhere = np.log((total[keep] + 1.0) / (counts.sum() + size))
        self.weights = (everywhere - np.log((complement + 1.0) / (mass + size))).T.astype(np.float32)
        self.curve = curve

    def margins(self, sizes: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Per paragraph and subject: how much its words are rarer outside the subject than in all text (summed logs)."""
        place = self.place[ids]
        at = np.flatnonzero(place >= 0)
        owner = np.repeat(np.arange(len(sizes)), sizes)[at]
        rows = self.weights[place[at]]
        return np.stack([np.bincount(owner, weights=rows[:, k], minlength=len(sizes)) for k in range(rows.shape[1])], 1)

    def shares(self, sizes: np.ndarray, ids: np.ndarray, cls: np.ndarray) -> np.ndarray:
        """Per paragraph, how it is shared out to the subjects and, last, none; cls is its document's label (-1 for none known)."""
        m = self.margins(sizes, ids)
        m = np.concatenate((m, np.full((len(m), 1), NONE)), 1)
        known = np.flatnonzero(cls >= 0)
        m[known, cls[known]] += LABEL
        p = np.exp(m - m.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)

    def evidence(self, sizes: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Per paragraph and subject: log1p of its margin less part of the strongest other's."""
        m = self.margins(sizes, ids)
        if m.shape[1] > 1:
            order = np.sort(m, axis=1)
            m = m - BESIDE * np.where(m == order[:, -1:], order[:, -2:-1], order[:, -1:])
        return np.log1p(np.maximum(m, 0))

    def posteriors(self, sizes: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Per paragraph and subject, each by its own curve."""
        x = self.evidence(sizes, ids)
        return 1 / (1 + np.exp(-np.clip(x * self.curve[:, 0] + self.curve[:, 1], -30, 30)))


def _batches(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        if batch.num_rows:
            sizes, ids = batch.column(1), batch.column(2)
            per = np.diff(sizes.offsets.to_numpy())
            yield batch.column(0).to_pylist(), per, sizes.flatten().to_numpy(), ids.flatten().to_numpy()


def _add_tables(rows: DataFrame, shape: tuple[int, int]) -> np.ndarray:
    """Sum of compressed float tables, row by row (shape[0] rows of fixed size)."""

    def add(t: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(zlib.decompress(x), "<f8") for x in t.column("v").to_pylist())
        return pa.table({"k": t.column("k").slice(0, 1), "v": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})

    out = np.zeros(shape)
    for r in rows.groupBy("k").applyInArrow(add, "k int, v binary").collect():
        out[r["k"]] = np.frombuffer(zlib.decompress(bytes(r["v"])), "<f8")
    return out


def _table_rows(table: np.ndarray) -> pa.RecordBatch:
    at = [k for k in range(len(table)) if table[k].any()]
    return pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array([zlib.compress(table[k].astype("<f8").tobytes(), 1) for k in at], pa.binary())], ["k", "v"])


def labelled_counts(words: DataFrame, classes: int, labels) -> np.ndarray:
    """Word counts per class of the labelled documents that a model is trained on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((classes, 1 << BITS))
        for docs, per, sizes, ids in _batches(batches):
            own = np.repeat(np.repeat(taught_class(docs, labels.value), per), sizes)
            for k in np.unique(own[own >= 0]):
                table[k] += np.bincount(ids[own == k], minlength=1 << BITS)
        yield _table_rows(table)

    return _add_tables(words.select("doc_id", "sizes", "ids").mapInArrow(run, "k int, v binary"), (classes, 1 << BITS))


def taught_class(docs: list[int], labels: dict[int, int]) -> np.ndarray:
    """Per document the class of its label, -1 without one or where it is held out."""
    return np.array([-1 if held_out(d) else labels.get(d, -1) for d in docs], np.int32)


def expected_counts(words: DataFrame, classes: int, labels, model) -> np.ndarray:
    """Word counts per class of all documents, by the model's shares."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((classes, 1 << BITS))
        for docs, per, sizes, ids in _batches(batches):
            q = model.value.shares(sizes, ids, np.repeat(taught_class(docs, labels.value), per))
            for k in range(classes):
                some = q[:, k] > 0.005
                if some.any():
                    table[k] += np.bincount(ids[np.repeat(some, sizes)], weights=np.repeat(q[some, k], sizes[some]), minlength=1 << BITS)
        yield _table_rows(table)

    return _add_tables(words.select("doc_id", "sizes", "ids").mapInArrow(run, "k int, v binary"), (classes, 1 << BITS))


def calibration(words: DataFrame, subjects: int, labels, model) -> np.ndarray:
    """Per subject (slope, offset) of the posterior over its evidence, from labelled documents that no model was trained on.

    Documents of none tell against a subject. Those of other subjects do not: they may have paragraphs on it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((subjects, 2 * BINS))
        for docs, per, sizes, ids in _batches(batches):
            cls = np.repeat(np.array([labels.value.get(d, -1) if held_out(d) else -1 for d in docs], np.int32), per)
            b = np.minimum(BINS - 1, model.value.evidence(sizes, ids) * (BINS / TOP)).astype(np.int64)
            for k in range(subjects):
                table[k] += np.bincount(b[cls == k, k] + BINS, minlength=2 * BINS) + np.bincount(b[cls == subjects, k], minlength=2 * BINS)
        yield _table_rows(table)

    table = _add_tables(words.select("doc_id", "sizes", "ids").mapInArrow(run, "k int, v binary"), (subjects, 2 * BINS))
    x = (np.arange(BINS) + 0.5) * TOP / BINS
    return np.array([_logistic(x, table[k, BINS:], table[k, :BINS]) for k in range(subjects)])


def _logistic(x: np.ndarray, yes: np.ndarray, no: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton steps, held near (4, -4) where data say little."""
    a, b = 4.0, -4.0
    n = yes + no
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = n * p - yes
        w = n * p * (1 - p)
        grad = np.array([(g * x).sum() + (a - 4), g.sum() + (b + 4)])
        hess = np.array([[(w * x * x).sum() + 1, (w * x).sum()], [(w * x).sum(), w.sum() + 1]])
        step = np.linalg.solve(hess, grad)
        step *= min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-7:
            break
    return max(a, 0.5), b


def document_subjects(documents: DataFrame, labels: DataFrame, subject_areas: DataFrame, benchmark: DataFrame | None = None, max_labels: int = MAX_LABELS) -> DataFrame:
    """doc_id, subject_code, share (of paragraphs about it), posterior: one row per subject that a paragraph is about."""
    spark = documents.sparkSession
    codes = sorted({r["code"] for r in subject_areas.select(F.lower(F.trim("subject_code")).alias("code")).distinct().collect() if r["code"] and r["code"] != "none"})  # a fixed list of areas
    sample = label_sample(labels, codes, max_labels) if codes else {}
    if not sample:
        return spark.createDataFrame([], "doc_id bigint, subject_code string, share double, posterior double")
    known = spark.sparkContext.broadcast(sample)
    words = paragraph_words(documents, benchmark)
    taught = materialize(words.join(F.broadcast(spark.createDataFrame([(d,) for d in sample], "doc_id bigint")), "doc_id"), "labelled-words")  # at most max_labels documents
    counts = labelled_counts(taught, len(codes) + 1, known)
    for _ in range(ROUNDS):
        before, counts = counts, expected_counts(words, len(codes) + 1, known, spark.sparkContext.broadcast(Model(counts)))
        if np.abs(counts - before).sum() < SETTLED * counts.sum():
            break
    fitted = Model(counts)
    fitted.curve = calibration(taught, len(codes), known, spark.sparkContext.broadcast(fitted))
    model = spark.sparkContext.broadcast(fitted)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for docs, per, sizes, ids in _batches(batches):
            p = model.value.posteriors(sizes, ids)
            out: list[tuple] = []
            begin = 0
            for doc, n in zip(docs, per):
                q = p[begin : begin + n]
                begin += n
                share = (q >= 0.5).mean(0)
                quarter = np.sort(q, axis=0)[::-1][int(np.ceil(n * SHARE)) - 1]
                out += [(doc, codes[k], float(share[k]), float(quarter[k])) for k in np.flatnonzero(share > 0)]
            columns = list(zip(*out)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.float64(), pa.float64()))], ["doc_id", "subject_code", "share", "posterior"])

    rows = words.mapInArrow(label, "doc_id bigint, subject_code string, share double, posterior double")
    return rows.groupBy("doc_id", "subject_code").agg(F.round(F.max("share"), 6).alias("share"), F.round(F.max("posterior"), 6).alias("posterior"))


def found(documents: DataFrame, labels: DataFrame, subject_areas: DataFrame, benchmark: DataFrame | None = None) -> DataFrame:
    """p10_found: doc_id, subject_code."""
    return document_subjects(documents, labels, subject_areas, benchmark).where(F.col("share") >= SHARE).select("doc_id", "subject_code")


def composition(documents: DataFrame, labels: DataFrame, subject_areas: DataFrame, benchmark: DataFrame | None = None) -> DataFrame:
    """subject_code, n_docs, share of all documents; `none` for those without a subject."""
    f = materialize(found(documents, labels, subject_areas, benchmark), "subjects")
    total = documents.where("doc_id is not null").agg(F.count_distinct("doc_id").alias("total"))
    per = f.groupBy("subject_code").agg(F.count("*").alias("n_docs"))
    some = f.agg(F.count_distinct("doc_id").alias("some"))
    none = total.crossJoin(some).select(F.lit("none").alias("subject_code"), (F.col("total") - F.col("some")).alias("n_docs"))  # one row each
    return per.unionByName(none).crossJoin(total).select("subject_code", "n_docs", F.round(F.col("n_docs") / F.col("total"), 6).alias("share"))
