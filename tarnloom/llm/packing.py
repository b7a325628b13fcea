"""Problem 8: documents into containers of fixed capacity, sized in tokens of a public tokenizer.

1. Every whole text is tokenized once; only the sizes are kept. A document larger than the capacity fills containers
   of its own and leaves a rest; no other document is split.
2. The global histogram of sizes (at most `capacity` rows) goes to the driver, where dynamic programming picks the
   bucket boundaries with the least padding.
3. Token-budget batches form inside each bucket: as many of its documents as fit a container. What a batch leaves
   free is filled with documents of smaller buckets. The plan is a short list of patterns (documents per bucket) with
   the number of containers of each; every pattern uses some bucket up, so there are at most twice as many patterns
   as buckets.
4. Each document's exact place in its bucket (a row number within (bucket, salt) plus the counts of the salts before)
   picks its pattern and container. No bucket is gathered in one task.

Defined results: NULL and empty texts have size 0 and go to some container, which they do not fill; repeated rows are
items of their own; NULL doc_id is kept as an item; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnloom.session import materialize

CAPACITY, BUCKETS = 2048, 128
SALT_ROWS = 200_000
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The split pattern that goes with the rank file (fixed value of that vocabulary).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def load_tokenizer(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("sizes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_sizes(documents: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, n_tokens of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = load_tokenizer(tokenizer).encode_ordinary
        for batch in batches:
            sizes = [len(encode(t)) if t else 0 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], ["doc_id", "n_tokens"])

    return documents.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, n_tokens bigint")


def bucket_bounds(histogram: dict[int, int], buckets: int) -> list[int]:
    """Upper bounds of the buckets that minimise the padding of all sizes to their bucket's bound."""
    sizes = np.array(sorted(s for s, n in histogram.items() if s > 0 and n > 0), np.int64)
    if len(sizes) <= buckets:
        return sizes.tolist()
    n = np.array([histogram[int(s)] for s in sizes], np.float64)
    count, mass = np.concatenate(([0], np.cumsum(n))), np.concatenate(([0], np.cumsum(n * sizes)))
    # cost[a, b]: padding of sizes a..b-1 raised to sizes[b-1]
    cost = sizes[None, :] * (count[None, 1:] - count[:-1, None]) - (mass[None, 1:] - mass[:-1, None])
    cost[np.tril_indices(len(sizes), -1)] = np.inf
    best, back = cost[0], []
    for _ in range(buckets - 1):
        # a bucket before ends at size a-1, this one begins at a
        total = np.concatenate(([np.inf], best[:-1]))[:, None] + cost
        choice = total.argmin(axis=0)
        value = total[choice, np.arange(len(sizes))]
        back.append(np.where(value < best, choice, -1))
        best = np.minimum(value, best)
    bounds, b = [], len(sizes) - 1
    for choice in reversed(back):
        if choice[b] > 0:
            bounds.append(int(sizes[b]))
            b = int(choice[b]) - 1
    bounds.append(int(sizes[b]))
    return bounds[::-1]


def container_plan(bounds: list[int], counts: list[int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Patterns {bucket: documents} with their number of containers: batches of one bucket, topped up from smaller ones."""
    left = list(counts)
    plan = []
    for k in range(len(bounds) - 1, -1, -1):
        while left[k]:
            space, pattern = capacity, {}
            for j in range(k, -1, -1):
                m = min(left[j], space // bounds[j])
                if m:
                    pattern[j] = m
                    space -= m * bounds[j]
            times = min(left[j] // m for j, m in pattern.items())
            for j, m in pattern.items():
                left[j] -= m * times
            plan.append((pattern, times))
    return plan


def pack(documents: DataFrame, capacity: int = CAPACITY, buckets: int = BUCKETS, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, piece_no (0 but for documents over the capacity), n_tokens, container_id."""
    spark = documents.sparkSession
    sizes = materialize(token_sizes(documents, tokenizer), "sizes")
    cap = F.lit(capacity)
    full = F.expr(f"n_tokens div {capacity}")
    over = sizes.where(F.col("n_tokens") > capacity).select("doc_id", F.explode(F.sequence(F.lit(0), (full - 1).cast("int"))).alias("piece_no"), cap.cast("bigint").alias("n_tokens"))
    rest = sizes.select("doc_id", F.when(F.col("n_tokens") > capacity, full).otherwise(0).cast("int").alias("piece_no"), F.when(F.col("n_tokens") > capacity, F.col("n_tokens") % capacity).otherwise(F.col("n_tokens")).alias("n_tokens"))
    rest = rest.where((F.col("n_tokens") > 0) | (F.col("piece_no") == 0))
    items = over.unionAll(rest)

    histogram = {r["n_tokens"]: r["n"] for r in items.groupBy("n_tokens").agg(F.count("*").alias("n")).collect()}  # at most capacity + 1 rows
    bounds = bucket_bounds(histogram, buckets)
    edges = np.array(bounds, np.int64)
    counts = [0] * len(bounds)
    for size, n in histogram.items():
        if size > 0:
            counts[int(np.searchsorted(edges, size))] += n
    plan = container_plan(bounds, counts, capacity)
    starts: list[list[int]] = [[] for _ in bounds]  # per bucket: first place, documents per container, first container of each pattern
    per: list[list[int]] = [[] for _ in bounds]
    bases: list[list[int]] = [[] for _ in bounds]
    used, containers = [0] * len(bounds), 0
    for pattern, times in plan:
        for k, m in pattern.items():
            starts[k].append(used[k])
            per[k].append(m)
            bases[k].append(containers)
            used[k] += m * times
        containers += times
    table = spark.sparkContext.broadcast((edges, [tuple(np.array(x, np.int64) for x in (starts[k], per[k], bases[k])) for k in range(len(bounds))]))

    salts = max(1, sum(histogram.values()) // SALT_ROWS)
    lookup = spark.createDataFrame([(int(s), int(np.searchsorted(edges, s)) if s > 0 else -1) for s in histogram] or [(0, -1)], "n_tokens bigint, bucket int")  # at most capacity + 1 rows
    known = items.join(F.broadcast(lookup), "n_tokens").withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece_no"), F.lit(salts)))
    order = Window.partitionBy("bucket", "salt").orderBy("doc_id", "piece_no", "n_tokens")
    before = Window.partitionBy("bucket").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = known.groupBy("bucket", "salt").agg(F.count("*").alias("n")).select("bucket", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    placed = known.withColumn("row", F.row_number().over(order) - 1).join(offsets, ["bucket", "salt"]).select("doc_id", "piece_no", "n_tokens", "bucket", (F.col("row") + F.col("offset")).alias("place"))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, rows = table.value
        for batch in batches:
            of, place = batch.column(3).to_numpy(), batch.column(4).to_numpy()
            out = np.zeros(len(of), np.int64)
            for k in np.unique(of):
                at = np.flatnonzero(of == k)
                if k < 0:
                    out[at] = place[at] % max(1, containers)
                    continue
                start, m, base = rows[k]
                p = np.searchsorted(start, place[at], side="right") - 1
                out[at] = base[p] + (place[at] - start[p]) // m[p]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out)], ["doc_id", "piece_no", "n_tokens", "container_id"])

    return placed.mapInArrow(choose, "doc_id bigint, piece_no int, n_tokens bigint, container_id bigint")


def container_fill(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """container_id, n_items, used_tokens, unused_tokens."""
    return packed.groupBy("container_id").agg(F.count("*").alias("n_items"), F.sum("n_tokens").alias("used_tokens")).withColumn("unused_tokens", F.lit(capacity) - F.col("used_tokens"))
