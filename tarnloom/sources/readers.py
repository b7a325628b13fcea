"""Readers of the formats that records come in."""

from __future__ import annotations

import zipfile
from collections.abc import Iterator
from io import BytesIO
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_jsonl(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """One object a line; blank lines are skipped, lines that do not parse keep only `_corrupt`; `_file` is where they stand."""
    full = T.StructType([*T._parse_datatype_string(schema).fields, T.StructField("_corrupt", T.StringType())])
    rows = spark.read.schema(full).option("columnNameOfCorruptRecord", "_corrupt").json(path)
    return rows.withColumn("_file", F.col("_metadata.file_path"))


def first_of_files(rows: DataFrame, key: str) -> DataFrame:
    """The first row of each key in the order of files and lines (an exact key → file order, ties by the row's text)."""
    return rows.groupBy(key).agg(F.min_by(F.struct(*rows.columns), F.struct("_file", F.to_json(F.struct(*[c for c in rows.columns if c != "_file"])))).alias("v")).select("v.*")


def read_json_tree(spark: SparkSession, folder: str, schema: str, skip: str = "raw") -> DataFrame:
    """All .json, .jsonl and .ndjson files under a folder but for those under a part named `skip`."""
    full = T._parse_datatype_string(schema)
    rows = spark.read.schema(full).option("recursiveFileLookup", "true").json(folder).withColumn("_file", F.col("_metadata.file_path"))
    return rows.where(F.col("_file").rlike(r"\.(?:json|jsonl|ndjson)$") & ~F.col("_file").rlike(rf"/{skip}/"))


HIT = "array<struct<title:string,url:string,summary:string>>"


def search_cache(cache: DataFrame, text: str = "value") -> DataFrame:
    """query, position, title, url, summary of a JSON object query → list of hits; entries that are no list are left out."""
    m = cache.select(F.explode(F.from_json(F.col(text), "map<string,string>")).alias("query", "raw"))
    lists = m.where(F.ltrim(F.col("raw")).startswith("["))
    return lists.select("query", F.posexplode(F.from_json("raw", HIT)).alias("position", "hit")).select("query", "position", "hit.*")


def load_records(rows: DataFrame, text: str = "value", item: str = "struct<title:string,url:string,summary:string>") -> DataFrame:
    """Records of either envelope: a JSON array, or an object with `records`."""
    as_list = F.when(F.ltrim(F.col(text)).startswith("["), F.from_json(F.col(text), f"array<{item}>"))
    as_object = F.from_json(F.col(text), f"struct<records:array<{item}>>")["records"]
    return rows.select(F.posexplode(F.coalesce(as_list, as_object)).alias("position", "record")).select("position", "record.*")


def categories(rows: DataFrame, text: str = "value", start: int = 0, n: int | None = None) -> DataFrame:
    """position, category: scenarios of all user roles, or the domains where there are none; a slice of them in order."""
    shape = "struct<user_roles:array<struct<scenarios:array<struct<scenario:string>>>>,domains:array<string>>"
    doc = F.from_json(F.col(text), shape)
    nested = F.flatten(F.transform(F.coalesce(doc["user_roles"], F.array()), lambda r: F.transform(r["scenarios"], lambda s: s["scenario"])))
    every = F.when(F.size(nested) > 0, nested).otherwise(F.coalesce(doc["domains"], F.array().cast("array<string>")))
    cut = F.slice(every, start + 1, n if n is not None else 1_000_000)
    return rows.select(F.posexplode(cut).alias("position", "category"))


_SHEET = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_WORD = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def _xlsx(data: bytes) -> list[tuple[str, int, list[str]]]:
    out = []
    with zipfile.ZipFile(BytesIO(data)) as z:
        names = set(z.namelist())
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in si.iter(f"{_SHEET}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_SHEET}si")]
        titles = [s.attrib.get("name", "") for s in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{_SHEET}sheet")]
        for i, title in enumerate(titles, 1):
            part = f"xl/worksheets/sheet{i}.xml"
            if part not in names:
                continue
            for r, row in enumerate(ElementTree.fromstring(z.read(part)).iter(f"{_SHEET}row")):
                cells: list[str] = []
                for c in row.iter(f"{_SHEET}c"):
                    letters = "".join(ch for ch in c.attrib.get("r", "") if ch.isalpha())
                    at = 0
                    for ch in letters:
                        at = at * 26 + ord(ch.upper()) - 64
                    while letters and len(cells) < at - 1:
                        cells.append("")
                    v = c.find(f"{_SHEET}v")
                    text = "".join(t.text or "" for t in c.iter(f"{_SHEET}t")) if c.attrib.get("t") == "inlineStr" else (v.text or "" if v is not None else "")
                    cells.append(shared[int(text)] if c.attrib.get("t") == "s" and text.isdigit() and int(text) < len(shared) else text)
                out.append((title, r, cells))
    return out


def _docx(data: bytes) -> list[tuple[str, int, list[str]]]:
    out = []
    with zipfile.ZipFile(BytesIO(data)) as z:
        body = ElementTree.fromstring(z.read("word/document.xml")).find(f"{_WORD}body")
        n = 0
        for block in body if body is not None else []:
            if block.tag == f"{_WORD}tbl":
                for row in block.iter(f"{_WORD}tr"):
                    out.append(("table", n, ["".join(t.text or "" for t in c.iter(f"{_WORD}t")) for c in row.iter(f"{_WORD}tc")]))
                    n += 1
                continue
            if block.tag != f"{_WORD}p":
                continue
            style = block.find(f"{_WORD}pPr/{_WORD}pStyle")
            name = style.attrib.get(f"{_WORD}val", "") if style is not None else ""
            listed = block.find(f"{_WORD}pPr/{_WORD}numPr") is not None
            kind = f"heading{name[-1]}" if name.startswith("Heading") and name[-1:].isdigit() else "list" if listed else "paragraph"
            text = "".join(t.text or "" for t in block.iter(f"{_WORD}t"))
            if text.strip():
                out.append((kind, n, [text]))
                n += 1
    return out


def office_blocks(files: DataFrame, content: str = "content", path: str = "path") -> DataFrame:
    """path, kind, position, cells of spreadsheets (kind is the sheet) and text documents; broken files give kind `error`.

    files: as spark.read.format("binaryFile") gives them.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for p, data in zip(b[path], b[content]):
                try:
                    blocks = _xlsx(bytes(data)) if p.lower().endswith(".xlsx") else _docx(bytes(data))
                except Exception as e:
                    blocks = [("error", 0, [type(e).__name__])]
                rows += [(p, k, n, cells) for k, n, cells in blocks]
            yield pd.DataFrame(rows, columns=["path", "kind", "position", "cells"])

    return files.where(F.lower(F.col(path)).rlike(r"\.(?:xlsx|docx)$")).select(path, content).mapInPandas(run, "path string, kind string, position int, cells array<string>")


def blocks_to_html(blocks: DataFrame) -> DataFrame:
    """path, html: blocks of a document in order, rows of tables as table rows."""
    esc = lambda c: F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "&", "&amp;"), "<", "&lt;"), ">", "&gt;")
    cells = F.array_join(F.transform("cells", lambda x: F.concat(F.lit("<td>"), esc(x), F.lit("</td>"))), "")
    text = esc(F.array_join("cells", " "))
    level = F.regexp_extract("kind", r"^heading(\d)$", 1)
    one = F.when(level != "", F.concat(F.lit("<h"), level, F.lit(">"), text, F.lit("</h"), level, F.lit(">"))).when(F.col("kind") == "list", F.concat(F.lit("<li>"), text, F.lit("</li>"))).when(F.col("kind") == "paragraph", F.concat(F.lit("<p>"), text, F.lit("</p>"))).otherwise(F.concat(F.lit("<tr>"), cells, F.lit("</tr>")))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", one.alias("html")))), lambda x: x["html"]), "")
    return blocks.groupBy("path").agg(joined.alias("html"))
