"""Page html in Arrow batches: parsers run only on rows that can have what is asked for."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tarnloom.functions import dom


def map_columns(df: DataFrame, fn: Callable[..., tuple], inputs: list[str], keep: list[str], outputs: str) -> DataFrame:
    """keep columns beside what fn(*inputs) returns for each row, in Arrow batches."""
    kept = [df.schema[c] for c in keep]
    made = T._parse_datatype_string(outputs)
    schema = T.StructType([*kept, *made.fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            rows = [fn(*x) for x in zip(*(b.column(b.schema.get_field_index(f"_in_{c}")).to_pylist() for c in inputs))]
            new = list(zip(*rows))
            columns = [b.column(b.schema.get_field_index(c)).cast(arrow.field(c).type) for c in keep]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(list(v), f.type) for v, f in zip(new, list(arrow)[len(keep) :]))], schema=arrow)

    return df.select(*keep, *(F.col(c).alias(f"_in_{c}") for c in inputs)).mapInArrow(run, schema)


def page_metadata(pages: DataFrame, html: str = "html", key: str = "page_id") -> DataFrame:
    """key, metadata: every name with its values."""
    with_head = pages.where(F.contains(F.lower(F.col(html)), F.lit("<")))
    return map_columns(with_head, lambda h: (list(dom.metadata(h).items()),), [html], [key], "metadata map<string,array<string>>")


def page_images(pages: DataFrame, html: str = "html", url: str = "url", key: str = "page_id") -> DataFrame:
    rows = pages.where(F.col(html).rlike(r"(?i)<img|<source|og:image|twitter:image|icon|poster|url\("))
    return map_columns(rows, lambda h, u: (dom.images(h, u or ""),), [html, url], [key], "images array<string>")


def page_attributes(pages: DataFrame, selector: str, attribute: str, html: str = "html", key: str = "page_id") -> DataFrame:
    rows = pages.where(F.contains(F.col(html), F.lit(attribute)))
    return map_columns(rows, lambda h: (dom.attributes(h, selector, attribute),), [html], [key], "values array<string>")


def page_markdown(pages: DataFrame, only_main: bool = True, html: str = "html", url: str = "url", key: str = "page_id", include: tuple[str, ...] = (), exclude: tuple[str, ...] = ()) -> DataFrame:
    """key, clean_html, markdown; where the main part is blank, both are made of the whole page."""

    def convert(h: str | None, u: str | None) -> tuple[str, str]:
        clean = dom.transform(h, u or "", include, exclude, only_main)
        md = dom.tidy_markdown(dom.markdown(clean))
        if only_main and not md.strip():
            clean = dom.transform(h, u or "", include, exclude, False)
            md = dom.tidy_markdown(dom.markdown(clean))
        return clean, md

    return map_columns(pages.where(F.length(F.trim(F.col(html))) > 0), convert, [html, url], [key], "clean_html string, markdown string")
