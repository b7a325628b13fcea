"""Small helpers for Arrow-batched operators."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def map_rows(df: DataFrame, fn: Callable[[dict[str, list]], dict[str, list]], schema: str, setup: Callable | None = None) -> DataFrame:
    """mapInArrow over columns as Python lists: fn takes and returns {column: list}; rows may grow or shrink.

    setup, if given, runs once in each worker and its value is passed to fn as second argument.
    """
    wanted = T._parse_datatype_string(schema)
    arrow = to_arrow_schema(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = setup() if setup else None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = {n: as_list(batch.column(i)) for i, n in enumerate(batch.schema.names)}
            out = fn(columns, state) if setup else fn(columns)
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, wanted)


def as_list(column: pa.Array) -> list:
    """column.to_pylist(), without an Arrow scalar for each value of its lists."""
    kind = column.type
    if pa.types.is_list(kind):
        offsets = column.offsets.to_numpy()
        flat = as_list(column.values.slice(offsets[0], offsets[-1] - offsets[0]))
        at = (offsets - offsets[0]).tolist()
        rows = [flat[i:j] for i, j in zip(at, at[1:])]
        if column.null_count:
            rows = [x if valid else None for x, valid in zip(rows, column.is_valid().to_pylist())]
        return rows
    if pa.types.is_string(kind) or not column.null_count and (pa.types.is_integer(kind) or pa.types.is_floating(kind) or pa.types.is_boolean(kind)):
        return column.to_numpy(zero_copy_only=False).tolist()
    return column.to_pylist()


WORD = re.compile(r"[^\W_]+")
#: ASCII signs other than letters and digits are cut in one pass over the bytes.
ASCII_SIGNS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def cut_words(text: str) -> list[str]:
    """WORD.findall(text); only parts with signs beyond ASCII need the pattern."""
    words = text.encode("utf-8", "surrogatepass").translate(ASCII_SIGNS).decode("utf-8", "surrogatepass").split()
    if not words or "".join(words).isalnum():
        return words
    return [x for w in words for x in ((w,) if w.isalnum() else WORD.findall(w))]


class Hashed(dict):
    """word → bucket, remembered; forgets all when it grows too large for a worker."""

    def __init__(self, bits: int, limit: int = 1_000_000):
        super().__init__()
        self.mask, self.limit = (1 << bits) - 1, limit

    def __missing__(self, word: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = crc32(word.encode()) & self.mask
        return value


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values; np.unique hashes numbers, which takes many times as long."""
    x = np.sort(x)
    return x[np.flatnonzero(np.concatenate((np.ones(min(1, len(x)), bool), x[1:] != x[:-1])))]
