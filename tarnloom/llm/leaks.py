"""Problem 9: held-out items whose passages stand in corpus documents.

Prefix-filtered set join on word shingles, with windows of WINDOW words of an item as the records searched for:
1. One pass over all documents keeps, of each, the runs of at least WINDOW consecutive words that all occur in some
   item (no window can lie elsewhere); other documents leave nothing behind.
2. Shingles of items are ordered by rarity, counted over those runs.
3. A window occurs only where all its shingles do, so its necessary prefix is one shingle, the rarest. Only prefix
   shingles are joined; the place of the shingle in its window must leave room for the window in the run (length and
   position bounds); then the window's words are compared one by one.

Items are a stated query set: they are taken in blocks of at most BLOCK_WORDS words, so what is broadcast is bounded
whatever the benchmark. Words are the runs of letters or digits of the lower-cased text.

Defined results: NULL or short texts on either side give no row; repeated item or document rows give one row per
(item_id, doc_id); NULL ids are left out; empty tables give an empty result; texts are read whole.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnloom.llm.arrow import map_rows
from tarnloom.session import materialize

WORD = re.compile(r"[^\W_]+")
WINDOW, SHINGLE = 12, 4
BLOCK_WORDS = 2_000_000


def runs_of(text: str, vocabulary: dict[str, int], window: int) -> list[tuple[int, list[int]]]:
    """(start, word ids) of each run of at least `window` consecutive words of the vocabulary."""
    words = WORD.findall(text.lower())
    if len(words) < window:
        return []
    ids = [vocabulary.get(w, 0) for w in words]
    known = np.array(ids, np.int32)
    gaps = np.flatnonzero(known == 0)
    edges = np.concatenate(([-1], gaps, [len(ids)]))
    long = np.flatnonzero(np.diff(edges) > window)
    return [(int(edges[k]) + 1, ids[edges[k] + 1 : edges[k + 1]]) for k in long]


def _blocks(benchmark: DataFrame, limit: int):
    """Items as (item_id, words), in blocks of bounded size, streamed to the driver."""
    block, size = [], 0
    for row in benchmark.where("item_id is not null and text is not null").select("item_id", "text").distinct().toLocalIterator():
        words = WORD.findall(row["text"].lower())
        if block and size + len(words) > limit:
            yield block
            block, size = [], 0
        block.append((row["item_id"], words))
        size += len(words)
    if block:
        yield block


HITS = "item_id bigint, doc_id bigint, at int, item_windows bigint, place int"


def _hits(documents: DataFrame, benchmark: DataFrame, window: int, shingle: int, block_words: int) -> DataFrame:
    """One row for each window of an item and each place where it stands in a document."""
    parts = [_block_hits(documents, block, window, shingle) for block in _blocks(benchmark, block_words)]
    if not parts:
        return documents.sparkSession.createDataFrame([], HITS)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def leaks(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """item_id, doc_id, n_windows (distinct windows of the item found there), item_windows."""
    hits = _hits(documents, benchmark, window, shingle, block_words)
    return hits.groupBy("item_id", "doc_id").agg(F.count_distinct("at").alias("n_windows"), F.max("item_windows").alias("item_windows"))


def passages(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, places: the first words (counted from 0) of all windows of the document that stand in some item."""
    hits = _hits(documents, benchmark, window, shingle, block_words)
    return hits.groupBy("doc_id").agg(F.collect_set("place").alias("places"))


def _block_hits(documents: DataFrame, block: list[tuple[int, list[str]]], window: int, shingle: int) -> DataFrame:
    sc = documents.sparkSession.sparkContext
    vocabulary: dict[str, int] = {}
    items = [(item, [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words]) for item, words in block]
    words = sc.broadcast(vocabulary)

    def keep(c: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"doc_id": [], "start": [], "ids": []}
        for doc, text in zip(c["doc_id"], c["text"]):
            for start, ids in runs_of(text, words.value, window):
                out["doc_id"].append(doc)
                out["start"].append(start)
                out["ids"].append(ids)
        return out

    source = documents.where("doc_id is not null and text is not null").select("doc_id", "text")
    runs = materialize(map_rows(source, keep, "doc_id bigint, start int, ids array<int>"), "runs")

    # Rarity of the items' shingles over the runs: at most as many rows as the block has words.
    wanted = sc.broadcast({tuple(ids[k : k + shingle]) for _, ids in items for k in range(len(ids) - shingle + 1)})

    def count(c: dict[str, list]) -> dict[str, list]:
        n: dict[tuple[int, ...], int] = defaultdict(int)
        for ids in c["ids"]:
            for s in {tuple(ids[k : k + shingle]) for k in range(len(ids) - shingle + 1)} & wanted.value:
                n[s] += 1
        return {"s": [list(s) for s in n], "n": list(n.values())}

    counted = map_rows(runs.select("ids"), count, "s array<int>, n bigint").groupBy("s").agg(F.sum("n").alias("n"))
    rarity = {tuple(r["s"]): r["n"] for r in counted.collect()}

    prefix: dict[tuple[int, ...], list[tuple[int, int, int]]] = defaultdict(list)
    for number, (_, ids) in enumerate(items):
        for at in range(len(ids) - window + 1):
            offsets = range(window - shingle + 1)
            shingles = [tuple(ids[at + o : at + o + shingle]) for o in offsets]
            if any(s not in rarity for s in shingles):
                continue  # a shingle that stands nowhere: neither does the window
            best = min(offsets, key=lambda o: (rarity[shingles[o]], shingles[o]))
            prefix[shingles[best]].append((number, at, best))
    shared = sc.broadcast((items, dict(prefix)))

    def verify(c: dict[str, list]) -> dict[str, list]:
        records, joined = shared.value
        out: dict[str, list] = {"item_id": [], "doc_id": [], "at": [], "item_windows": [], "place": []}
        for doc, start, ids in zip(c["doc_id"], c["start"], c["ids"]):
            found = set()
            for k in range(len(ids) - shingle + 1):
                for number, at, offset in joined.get(tuple(ids[k : k + shingle]), ()):
                    begin = k - offset
                    if begin >= 0 and begin + window <= len(ids) and ids[begin : begin + window] == records[number][1][at : at + window]:
                        found.add((number, at, begin))
            for number, at, begin in sorted(found):
                out["item_id"].append(records[number][0])
                out["doc_id"].append(doc)
                out["at"].append(at)
                out["item_windows"].append(len(records[number][1]) - window + 1)
                out["place"].append(start + begin)
        return out

    return map_rows(runs, verify, HITS)


def found(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """p9_found: item_id, doc_id."""
    return leaks(documents, benchmark).select("item_id", "doc_id")
