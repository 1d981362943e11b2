"""A tolerant scanner for Python source: definitions with signature, place and docstring, also in files that
don't compile. It looks only at strings, comments, brackets and lines that begin a definition."""

from __future__ import annotations

import ast
import re
import warnings
from inspect import cleandoc
from typing import NamedTuple

_STRING = r"""(?:[rRbBuUfF]{0,2})(?:\"\"\"(?:[^\\\"]|\\.|\"(?!\"\"))*(?:\"\"\"|\Z)|'''(?:[^\\']|\\.|'(?!''))*(?:'''|\Z)|"(?:[^"\\\n]|\\.)*(?:"|(?=\n)|\Z)|'(?:[^'\\\n]|\\.)*(?:'|(?=\n)|\Z))"""
_TOKENS = re.compile(rf"(?P<string>(?<![\w]){_STRING}|{_STRING})|#[^\n]*|^(?P<indent>[ \t\f]*)(?P<head>(?:async[ \t]+)?(?P<kind>def|class)[ \t]+(?P<name>[^\W\d]\w*))", re.M | re.S)
_HEADER = re.compile(rf"{_STRING}|#[^\n]*|[()\[\]{{}}:]", re.S)
_SIMPLE = re.compile(r"[ \t]*(?:\(([^()\[\]{}'\"#:=]*)\))?[ \t]*:")
_BEFORE_BODY = re.compile(r"(?:[ \t\f]*(?:#[^\n]*)?\n|[ \t\f]*\\\n)*[ \t\f]*")
_DOC = re.compile(rf"({_STRING})", re.S)
_DOC_GAP = re.compile(r"[ \t\f]*(?:\\\n[ \t\f]*)?")
_DOC_END = re.compile(r"[ \t\f]*(?:;|#|\n|\Z)")
_STUB = re.compile(r"\s*\.\.\.[ \t]*(?:#[^\n]*)?(?:\n|\Z)")
_PREFIX = re.compile(r"[a-zA-Z]*")


class Definition(NamedTuple):
    """A class or function. ``parameters``: names in order, without stars, defaults and annotations."""

    name: str  # qualified by the enclosing classes and functions
    kind: str  # class, function or method
    parameters: tuple[str, ...]
    start_line: int
    end_line: int
    docstring: str | None
    stub: bool  # its body is only ``...``
    code: str


def unify_lines(text: str) -> str:
    """``text`` with ``\\n`` as the only line end and without a byte order mark."""
    return text.removeprefix("﻿").replace("\r\n", "\n").replace("\r", "\n")


def _header_end(text: str, at: int) -> tuple[int, str]:
    """Where the colon of a definition's header ends, and the text between its brackets."""
    if m := _SIMPLE.match(text, at):
        return m.end(), m[1] or ""
    depth, opened, inner = 0, None, ""
    for m in _HEADER.finditer(text, at):
        c = m[0]
        if c in "([{" and len(c) == 1:
            if depth == 0 and c == "(" and opened is None:
                opened = m.end()
            depth += 1
        elif c in ")]}" and len(c) == 1:
            depth -= 1
            if depth == 0 and opened is not None and not inner:
                inner = text[opened : m.start()] + "\0"
        elif c == ":" and depth <= 0:
            return m.end(), inner.rstrip("\0")
    return -1, ""


def parameters(inner: str) -> tuple[str, ...]:
    """The parameter names in the text between a header's brackets: the normalised signature."""
    names, depth, start, parts = [], 0, 0, []
    if any(c in inner for c in "([{'\"#"):
        inner = re.sub(rf"#[^\n]*|{_STRING}", lambda m: "" if m[0][0] == "#" else "''", inner, flags=re.S)
    for i, c in enumerate(inner):
        depth += (c in "([{") - (c in ")]}")
        if c == "," and depth == 0:
            parts.append(inner[start:i])
            start = i + 1
    for part in [*parts, inner[start:]]:
        if m := re.match(r"\s*\*{0,2}\s*([^\W\d]\w*)", part):
            names.append(m[1])
    return tuple(names)


def docstring_at(text: str, at: int) -> str | None:
    """The cleaned docstring that a body beginning at ``at`` starts with; None if it starts otherwise."""
    at = _BEFORE_BODY.match(text, at).end()
    parts = []
    while m := _DOC.match(text, at):
        prefix = _PREFIX.match(m[0])[0].lower()
        if "b" in prefix or "f" in prefix:
            return None
        parts.append(m[0])
        at = _DOC_GAP.match(text, m.end()).end()
    if not parts or not _DOC_END.match(text, at):
        return None
    value = ""
    for p in parts:
        try:
            with warnings.catch_warnings():
                warnings.simplefilter("ignore")
                value += ast.literal_eval(p)
        except (SyntaxError, ValueError):
            value += p.strip("rRuU").strip("\"'")
    return cleandoc(value)


def definitions(source: str, with_code: bool = True) -> list[Definition]:
    """All classes and functions of ``source`` in order of their place. Empty for an empty text."""
    text = unify_lines(source)
    width = lambda indent: len(indent.expandtabs(8))
    raw: list[list] = []
    open_: list[tuple[int, int]] = []  # (indent, index in raw)
    skip_to = line = seen = 0
    for m in _TOKENS.finditer(text):
        if m["name"] is None or m.start() < skip_to:
            continue
        indent = width(m["indent"])
        while open_ and open_[-1][0] >= indent:
            open_.pop()
        body, inner = _header_end(text, m.end())
        if body < 0:
            continue
        line += text.count("\n", seen, m.start("head"))
        seen = m.start("head")
        outer = raw[open_[-1][1]] if open_ else None
        name = f"{outer[0]}.{m['name']}" if outer else m["name"]
        kind = "class" if m["kind"] == "class" else "method" if outer and outer[1] == "class" else "function"
        stub = bool(_STUB.match(text, body))
        raw.append([name, kind, parameters(inner) if m["kind"] == "def" else (), line + 1, indent, docstring_at(text, body), stub, m.start("head"), body])
        open_.append((indent, len(raw) - 1))
        skip_to = body
    if not with_code:
        return [Definition(n, k, p, s, 0, d, stub, "") for n, k, p, s, _, d, stub, _, _ in raw]
    out = []
    for name, kind, params, start, indent, doc, stub, begin, body in raw:
        end = _end(text, begin, body, indent)
        code = _TRAILING.sub("", text[text.rfind("\n", 0, begin) + 1 : end])
        out.append(Definition(name, kind, params, start, start + code.count("\n"), doc, stub, code))
    return out


_TRAILING = re.compile(r"(?:\n[ \t\f]*(?:#[^\n]*)?)+\Z")
_LINE = re.compile(r"^(?P<indent>[ \t\f]*)(?=[^\s#])", re.M)


def _end(text: str, begin: int, body: int, indent: int) -> int:
    """Where the block of a definition ends: at the first later line, outside strings, not indented further."""
    rest = text.find("\n", body)
    if rest < 0:
        return len(text)
    if text[body:rest].split("#")[0].strip():  # a body on the header's line
        return rest
    strings = _string_spans(text, body)
    k = 0
    for m in _LINE.finditer(text, rest + 1):
        while k < len(strings) and strings[k][1] <= m.start():
            k += 1
        if k < len(strings) and strings[k][0] < m.start() < strings[k][1]:
            continue
        if len(m["indent"].expandtabs(8)) <= indent:
            return m.start()
    return len(text)


def _string_spans(text: str, at: int) -> list[tuple[int, int]]:
    """Places of strings over several lines from ``at`` on."""
    return [m.span() for m in _TOKENS.finditer(text, at) if m["string"] and "\n" in m[0]]
