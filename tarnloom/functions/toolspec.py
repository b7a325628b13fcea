"""Declared functions as catalog rows: read from source text without running it, and a registry of callables."""

from __future__ import annotations

import ast
import inspect
import json
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

_TYPES = {"int": "integer", "float": "number", "str": "string", "bool": "boolean", "list": "array", "dict": "object", "tuple": "array", "set": "array"}
_KNOWN = ("name", "title", "description", "meta")


@dataclass(frozen=True)
class ToolSpec:
    name: str
    description: str = ""
    title: str | None = None
    parameters: dict[str, Any] = field(default_factory=dict)
    is_async: bool = False
    meta: dict[str, Any] = field(default_factory=dict)

    def row(self) -> tuple:
        return self.name, self.title, self.description, json.dumps(self.parameters), self.is_async, json.dumps(self.meta)


ROW = "name string, title string, description string, parameters string, is_async boolean, meta string"


def _schema_of(annotation: ast.expr | None) -> dict[str, Any]:
    if annotation is None:
        return {}
    if isinstance(annotation, ast.Constant) and isinstance(annotation.value, str):
        try:
            annotation = ast.parse(annotation.value, mode="eval").body
        except SyntaxError:
            return {}
    if isinstance(annotation, ast.Name):
        return {"type": _TYPES[annotation.id]} if annotation.id in _TYPES else {}
    if isinstance(annotation, ast.BinOp) and isinstance(annotation.op, ast.BitOr):
        options = [_schema_of(x) for x in (annotation.left, annotation.right) if not (isinstance(x, ast.Constant) and x.value is None)]
        return options[0] if len(options) == 1 else {"anyOf": options}
    if isinstance(annotation, ast.Subscript) and isinstance(annotation.value, ast.Name):
        name, inner = annotation.value.id, annotation.slice
        if name == "Optional":
            return _schema_of(inner)
        if name in ("list", "List", "set", "Set"):
            return {"type": "array", "items": _schema_of(inner)}
        if name in ("dict", "Dict"):
            return {"type": "object"}
        if name == "Literal":
            values = [ast.literal_eval(x) for x in (inner.elts if isinstance(inner, ast.Tuple) else [inner])]
            return {"enum": values}
    return {}


def _parameters(fn: ast.FunctionDef | ast.AsyncFunctionDef) -> dict[str, Any]:
    args = [*fn.args.posonlyargs, *fn.args.args]
    defaults: list = [None] * (len(args) - len(fn.args.defaults)) + list(fn.args.defaults)
    pairs = [*zip(args, defaults), *zip(fn.args.kwonlyargs, fn.args.kw_defaults)]
    properties, required = {}, []
    for a, d in pairs:
        if a.arg in ("self", "cls"):
            continue
        properties[a.arg] = _schema_of(a.annotation)
        if d is None:
            required.append(a.arg)
        else:
            try:
                properties[a.arg] = {**properties[a.arg], "default": ast.literal_eval(d)}
            except ValueError:
                pass  # a default that is no literal is left out
    return {"type": "object", "properties": properties, "required": required}


def from_source(source: str) -> ToolSpec:
    """The first function of a source text. Nothing is run: the decorator's literals, signature and docstring are read.

    Raises TypeError where a name, title, description or meta is given as another type, ValueError without a function.
    """
    tree = ast.parse(source)
    fn = next((n for n in tree.body if isinstance(n, (ast.FunctionDef, ast.AsyncFunctionDef))), None)
    if fn is None:
        raise ValueError("the source defines no function")
    given: dict[str, Any] = {}
    for d in fn.decorator_list:
        if isinstance(d, ast.Call):
            if d.args:
                given["name"] = ast.literal_eval(d.args[0])
            for k in d.keywords:
                if k.arg:
                    given[k.arg] = ast.literal_eval(k.value)
            break
    for k, kind in (("name", str), ("title", str), ("description", str), ("meta", dict)):
        if given.get(k) is not None and not isinstance(given[k], kind):
            raise TypeError(f"{k} must be {kind.__name__}")
    extras = {k: v for k, v in given.items() if k not in _KNOWN}
    meta = dict(given.get("meta") or {})
    if extras:
        meta["_decorator_extras"] = extras
    return ToolSpec(given.get("name") or fn.name, given.get("description") or ast.get_docstring(fn) or "", given.get("title"), _parameters(fn), isinstance(fn, ast.AsyncFunctionDef), meta)


def from_function(fn: Callable, name: str | None = None) -> ToolSpec:
    """A callable's row; a lambda needs a name."""
    name = name or fn.__name__
    if name == "<lambda>":
        raise ValueError("a lambda needs a name")
    kinds = {int: "integer", float: "number", str: "string", bool: "boolean", list: "array", dict: "object"}
    properties, required = {}, []
    for p in inspect.signature(fn).parameters.values():
        kind = kinds.get(p.annotation) or _TYPES.get(str(p.annotation), None)
        properties[p.name] = {"type": kind} if kind else {}
        if p.default is inspect.Parameter.empty:
            required.append(p.name)
        else:
            properties[p.name]["default"] = p.default
    return ToolSpec(name, inspect.getdoc(fn) or "", None, {"type": "object", "properties": properties, "required": required}, inspect.iscoroutinefunction(fn))


class ToolError(Exception):
    def __init__(self, kind: str, output: Any = None):
        super().__init__(kind)
        self.kind, self.output = kind, output


class Registry:
    """Callables by name, with a log of calls and remembered results; a call of an unknown name is an error row, not a crash."""

    def __init__(self) -> None:
        self._fns: dict[str, Callable] = {}
        self._specs: dict[str, ToolSpec] = {}
        self._kept: dict[tuple, Any] = {}
        self.calls: list[dict[str, Any]] = []

    def register(self, fn: Callable, name: str | None = None) -> ToolSpec:
        spec = from_function(fn, name)
        self._fns.setdefault(spec.name, fn)  # of one name the first counts
        return self._specs.setdefault(spec.name, spec)

    def describe(self) -> list[ToolSpec]:
        return [self._specs[k] for k in sorted(self._specs)]

    def call(self, tool: str, **arguments: Any) -> dict[str, Any]:
        key = (tool, json.dumps(arguments, sort_keys=True, default=str))
        if key in self._kept:
            row = {**self._kept[key], "cached": True}
        elif tool not in self._fns:
            row = {"tool": tool, "output": None, "error": "missing", "cached": False}
        else:
            try:
                row = {"tool": tool, "output": self._fns[tool](**arguments), "error": None, "cached": False}
            except ToolError as e:
                row = {"tool": tool, "output": e.output, "error": e.kind, "cached": False}
            except Exception as e:
                row = {"tool": tool, "output": None, "error": type(e).__name__, "cached": False}
            if row["error"] is None:
                self._kept[key] = row
        self.calls.append(row)
        return row
