"""Record resolution whose result depends on order: greedy merges, fusion of partial records, provenance."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnloom.functions.urls import record_key
from tarnloom.operators.components import connected_components
from tarnloom.session import materialize


def first_wins(rows: DataFrame, key: Column, order: list[str]) -> DataFrame:
    """The first row of each key in order; NULL keys form one key."""
    w = Window.partitionBy("_k").orderBy(*order)
    return rows.withColumn("_k", key).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_k", "_n")


def fold_merge(records: list[tuple[str, str, bool]]) -> list[bool]:
    """Which of the records (title, url key, existing) stay: existing ones always; a new one only if neither its title
    nor its url is known yet; a dropped one makes nothing known. '' is no key."""
    titles: set[str] = set()
    urls: set[str] = set()
    out = []
    for title, url, existing in records:
        keep = existing or not ((title and title in titles) or (url and url in urls))
        if keep:
            if title:
                titles.add(title)
            if url:
                urls.add(url)
        out.append(keep)
    return out


def merge_records(existing: DataFrame, new: DataFrame, title: str = "title", url: str = "url", seq: str = "seq") -> DataFrame:
    """existing rows, and new rows that pass the two-key greedy merge, in the order of seq (existing first).

    Rows that share no key, even over others, cannot touch each other: connected components over titles and urls cut
    the fold into independent pieces, each folded in order. A row without any key stays. Only seq and keys travel.
    """
    both = existing.withColumn("_old", F.lit(True)).unionByName(new.withColumn("_old", F.lit(False)))
    t, u = F.lower(F.trim(F.coalesce(F.col(title), F.lit("")))), record_key(F.coalesce(F.col(url), F.lit("")))
    keyed = materialize(both.withColumn("_id", F.struct((~F.col("_old")).cast("int").alias("new"), F.col(seq).cast("bigint").alias("seq"))).withColumn("_t", t).withColumn("_u", u), "merge")
    node = F.concat_ws(":", F.lit("r"), F.col("_id.new"), F.col("_id.seq"))
    edges = keyed.where("_t != ''").select(node.alias("a"), F.concat(F.lit("t:"), "_t").alias("b")).unionAll(keyed.where("_u != ''").select(node.alias("a"), F.concat(F.lit("u:"), "_u").alias("b")))
    comps = connected_components(edges)
    placed = keyed.select(node.alias("node"), "_id", "_t", "_u", "_old").join(comps, "node", "left").withColumn("component", F.coalesce("component", F.col("node")))

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["new", "seq"])
        keep = fold_merge(list(zip(pdf["_t"], pdf["_u"], pdf["_old"])))
        return pdf.loc[keep, ["new", "seq"]]

    kept = placed.select("component", "_id.new", "_id.seq", "_t", "_u", "_old").groupBy("component").applyInPandas(fold, "new int, seq bigint")
    return keyed.join(kept.select(F.struct("new", "seq").alias("_id")), "_id", "left_semi").drop("_id", "_t", "_u", "_old")


def mergeable(a: dict, b: dict) -> bool:
    """At least one field known in both, and no known field that differs; a key that only one has is compared as missing."""
    compared = False
    for k in {*a, *b}:
        x, y = a.get(k, _MISSING), b.get(k, _MISSING)
        if x is None or y is None:
            continue
        compared = True
        if x is not _MISSING and y is not _MISSING and isinstance(x, (list, dict)) and isinstance(y, type(x)):
            if isinstance(x, dict) and not mergeable(x, y):
                return False
            continue
        if x is _MISSING or y is _MISSING or x != y:
            return False
    return compared


_MISSING = object()


def _nulls(x):
    if isinstance(x, dict):
        return {k: _nulls(v) for k, v in x.items()}
    if isinstance(x, list):
        return [_nulls(v) for v in x]
    return None if x == "null" else x


def _merge(a: dict, b: dict) -> dict:
    out = dict(a)
    for k, y in b.items():
        x = out.get(k)
        if isinstance(x, list) and isinstance(y, list):
            out[k] = x + [v for v in y if v not in x]
        elif isinstance(x, dict) and isinstance(y, dict):
            out[k] = _merge(x, y)
        elif y is not None:
            out[k] = y
        else:
            out.setdefault(k, None)
    return out


def fuse(records: list[dict]) -> list[dict]:
    """Greedy fusion in order: each record joins the first fused one it can be merged with, else stands for itself."""
    out: list[dict] = []
    for r in map(_nulls, records):
        for i, o in enumerate(out):
            if mergeable(o, r):
                out[i] = _merge(o, r)
                break
        else:
            out.append(r)
    return out


def fuse_records(rows: DataFrame, group: str, item: str, order: list[str]) -> DataFrame:
    """group, position, item (JSON): records of each group fused in order. A group is one entity, of bounded size."""
    shape = f"`{group}` {rows.schema[group].dataType.simpleString()}, position int, item string"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        fused = fuse([json.loads(x) for x in pdf[item] if x is not None])
        return pd.DataFrame({group: [pdf[group].iloc[0]] * len(fused), "position": range(len(fused)), "item": [json.dumps(x, sort_keys=True) for x in fused]})

    return rows.select(group, item, *order).groupBy(group).applyInPandas(run, shape)


def provenance(items: DataFrame, item: str = "item", url: str = "url") -> DataFrame:
    """item, sources: the distinct addresses whose items have exactly this JSON text."""
    return items.where(F.col(item).isNotNull()).groupBy(item).agg(F.array_sort(F.collect_set(url)).alias("sources"))


def array_to_object(schema: dict, items: list[dict]) -> dict:
    """One object of a schema out of many partial ones: arrays are joined without repeats, of scalars the first known one counts."""
    out: dict = {}
    for name, kind in schema.get("properties", {}).items():
        values = [i[name] for i in items if isinstance(i, dict) and i.get(name) is not None]
        if kind.get("type") == "array":
            joined: list = []
            for v in values:
                joined += [x for x in (v if isinstance(v, list) else [v]) if x not in joined]
            out[name] = joined
        elif kind.get("type") == "object":
            out[name] = array_to_object(kind, [v for v in values if isinstance(v, dict)])
        elif values:
            out[name] = values[0]
    return out


def split_schema(schema: dict, keys: list[str]) -> tuple[dict, dict]:
    """A JSON schema parted into the columns named (with dotted paths) and the rest, `required` lists along."""
    chosen = {k.split(".")[0] for k in keys}
    part = lambda names: {**schema, "properties": {k: v for k, v in schema.get("properties", {}).items() if k in names}, "required": [k for k in schema.get("required", []) if k in names]}
    own = set(schema.get("properties", {}))
    return part(own & chosen), part(own - chosen)


def mix_objects(schema: dict, single: dict, multi: dict) -> dict:
    """The two halves of a parted schema put together again; the second wins where both have a value."""
    out = {}
    for k, v in schema.get("properties", {}).items():
        a, b = single.get(k), multi.get(k)
        if v.get("type") == "object" and isinstance(a, dict) and isinstance(b, dict):
            out[k] = mix_objects(v, a, b)
        elif b is not None:
            out[k] = b
        elif a is not None:
            out[k] = a
    return out
