"""Checks of solution and verifier code by its syntax tree; nothing is ever run."""

from __future__ import annotations

import ast

ALLOWED_IMPORTS = frozenset(("re", "math"))
DICT_METHODS = frozenset(("get", "items", "keys", "values", "append", "extend", "pop", "update", "setdefault", "join", "split", "strip", "lower", "upper", "sort", "format", "startswith", "endswith", "replace"))
#: Builtins that a solution may call, and names under which it would reach past its tools.
SAFE_BUILTINS = frozenset("abs all any bool dict enumerate float int iter isinstance len list max min next range round set sorted str sum tuple zip".split())
DATABASE_NAMES = frozenset(("db", "database", "ctx"))


def tool_calls(source: str, receiver: str = "tools") -> list[str]:
    """Names called on the receiver, in order of first use, without methods of dicts and strings."""
    try:
        tree = ast.parse(source)
    except SyntaxError:
        return []
    out: dict[str, None] = {}
    for n in ast.walk(tree):
        if isinstance(n, ast.Call) and isinstance(n.func, ast.Attribute) and isinstance(n.func.value, ast.Name) and n.func.value.id == receiver and n.func.attr not in DICT_METHODS:
            out.setdefault(n.func.attr)
    return list(out)


def _is_text(e: ast.AST) -> bool:
    """A value that is text for certain: a literal, an f-string, str(), repr() or a dump of JSON."""
    if isinstance(e, ast.Call):
        f = e.func
        return isinstance(f, ast.Name) and f.id in ("str", "repr") or isinstance(f, ast.Attribute) and isinstance(f.value, ast.Name) and f.value.id == "json" and f.attr in ("dump", "dumps")
    return isinstance(e, ast.JoinedStr) or isinstance(e, ast.Constant) and isinstance(e.value, str)


def _tool_of(call: ast.Call) -> str | None:
    """The tool that tools.name(…) or tools['name'](…) calls; '' for tools(…) or a computed name; None for other calls."""
    f = call.func
    if isinstance(f, ast.Name):
        return "" if f.id == "tools" else None
    if isinstance(f, (ast.Attribute, ast.Subscript)) and isinstance(f.value, ast.Name) and f.value.id == "tools":
        return f.attr if isinstance(f, ast.Attribute) else str(f.slice.value) if isinstance(f.slice, ast.Constant) else ""
    return None


def _imported(n: ast.Import | ast.ImportFrom) -> list[str] | None:
    """Names that an import brings in; None where it is not allowed."""
    if isinstance(n, ast.Import):
        return [a.asname or a.name.split(".")[0] for a in n.names] if {a.name.split(".")[0] for a in n.names} <= ALLOWED_IMPORTS else None
    return [a.asname or a.name for a in n.names] if not n.level and (n.module or "").split(".")[0] in ALLOWED_IMPORTS else None


def check_solution(source: str | None) -> tuple[bool, str]:
    """(ok, reason): a solve function and no other, no class, imports of re and math alone, no database names, calls of tools
    and safe builtins only, at least one tool call, and answers that are no text."""
    if not source or not source.strip():
        return False, "empty"
    try:
        nodes = list(ast.walk(ast.parse(source)))
    except SyntaxError:
        return False, "syntax"
    of = lambda *kinds: [n for n in nodes if isinstance(n, kinds)]
    names = [n.name for n in of(ast.FunctionDef)]
    if "solve" not in names:
        return False, "solve"
    if set(names) != {"solve"}:
        return False, "other function"
    imports = [_imported(n) for n in of(ast.Import, ast.ImportFrom)]
    if None in imports:
        return False, "import"
    if of(ast.ClassDef):
        return False, "class"
    if any(n.id in DATABASE_NAMES for n in of(ast.Name)):
        return False, "database"
    if any(n.attr.startswith("__") for n in of(ast.Attribute)):
        return False, "unsafe"
    solve = [n for n in of(ast.FunctionDef)][-1]
    calls = [n for n in ast.walk(solve) if isinstance(n, ast.Call)]
    known = SAFE_BUILTINS.union({"tools"}, *imports)
    for c in of(ast.Call):  # in solve and beside it
        if isinstance(c.func, ast.Name) and c.func.id not in known or isinstance(c.func, ast.Subscript) and isinstance(c.func.value, ast.Name) and c.func.value.id in ("__builtins__", "builtins"):
            return False, "unsafe"
    tools = [(c, t) for c in calls if (t := _tool_of(c)) is not None]
    if not tools:
        return False, "no tool call"
    for c, t in tools:
        given = [*c.args, *(k.value for k in c.keywords)]
        if t == "submit_result" and (not given or any(map(_is_text, given))):
            return False, "answer"
    for n in ast.walk(solve):
        targets = n.targets if isinstance(n, ast.Assign) else [n.target] if isinstance(n, ast.AnnAssign) and n.value else []
        if any(isinstance(t, ast.Name) and t.id == "answer" for t in targets) and _is_text(n.value):
            return False, "answer"
    return True, ""


def check_verifier(source: str | None) -> tuple[bool, str]:
    """(ok, reason): a verify function that does more than return True."""
    if not source or not source.strip():
        return False, "empty"
    try:
        tree = ast.parse(source)
    except SyntaxError:
        return False, "syntax"
    fn = next((n for n in tree.body if isinstance(n, ast.FunctionDef) and n.name == "verify"), None)
    if fn is None:
        return False, "verify"
    returns = [n.value for n in ast.walk(fn) if isinstance(n, ast.Return)]
    if not returns:
        return False, "no return"
    if all(isinstance(v, ast.Constant) and v.value is True for v in returns):
        return False, "constant"
    return True, ""


def drop_repeated_functions(source: str) -> str:
    """Of several functions of one name the first stays."""
    tree = ast.parse(source)
    seen: set[str] = set()
    body = []
    for n in tree.body:
        if isinstance(n, (ast.FunctionDef, ast.AsyncFunctionDef)):
            if n.name in seen:
                continue
            seen.add(n.name)
        body.append(n)
    tree.body = body
    return ast.unparse(tree)
