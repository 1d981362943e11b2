"""A strict JSON reader for trees of any depth that keeps numbers as they were written."""

from __future__ import annotations

import json
import re
from json.decoder import scanstring

WHITE = re.compile(r"[ \t\n\r]*")
NUMBER = re.compile(r"-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][-+]?\d+)?")


class Literal(str):
    """A number, as its text."""


def _refuse(name: str):
    raise ValueError(name)


_DECODER = json.JSONDecoder(parse_float=Literal, parse_int=Literal, parse_constant=_refuse)


def _deep(text: str):
    """The same without recursion, for trees deeper than the interpreter's stack."""
    stack: list = []  # of [container, pending key]
    at = WHITE.match(text, 0).end()
    while True:
        c = text[at : at + 1]
        if c in ("{", "["):
            stack.append([{} if c == "{" else [], None])
            at = WHITE.match(text, at + 1).end()
            if text[at : at + 1] == ("}" if c == "{" else "]"):
                value, at = stack.pop()[0], at + 1
            elif c == "[":
                continue
            else:
                at = _key(text, at, stack)
                continue
        elif c == '"':
            value, at = scanstring(text, at + 1, True)
        elif word := next((w for w in ("true", "false", "null") if text.startswith(w, at)), None):
            value, at = {"true": True, "false": False, "null": None}[word], at + len(word)
        elif m := NUMBER.match(text, at):
            value, at = Literal(m[0]), m.end()
        else:
            raise ValueError(at)
        while True:  # the value is complete: put it into what it stands in
            at = WHITE.match(text, at).end()
            if not stack:
                if at != len(text):
                    raise ValueError(at)
                return value
            holder, key = stack[-1]
            if isinstance(holder, list):
                holder.append(value)
            else:
                holder[key] = value
            c = text[at : at + 1]
            if c == ",":
                at = WHITE.match(text, at + 1).end()
                if isinstance(holder, dict):
                    at = _key(text, at, stack)
                break
            if c != ("]" if isinstance(holder, list) else "}"):
                raise ValueError(at)
            value, at = stack.pop()[0], at + 1


def _key(text: str, at: int, stack: list) -> int:
    if text[at : at + 1] != '"':
        raise ValueError(at)
    stack[-1][1], at = scanstring(text, at + 1, True)
    at = WHITE.match(text, at).end()
    if text[at : at + 1] != ":":
        raise ValueError(at)
    return WHITE.match(text, at + 1).end()


def parse(text: str):
    """The value of ``text``; numbers come as ``Literal``. ValueError unless it is complete, valid JSON."""
    try:
        return _DECODER.decode(text)
    except RecursionError:
        return _deep(text)


def unwrap(value):
    """``value``, or what it encodes if it is a string that holds JSON of an object, array or such a string."""
    while isinstance(value, str) and not isinstance(value, Literal) and value.lstrip()[:1] in ("{", "[", '"'):
        try:
            inner = parse(value)
        except ValueError:
            return value
        value = inner
    return value


def as_text(value) -> str:
    """A scalar as text, an object or array as JSON; empty for None. Half surrogates become U+FFFD."""
    if value is None:
        return ""
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (dict, list)):
        value = json.dumps(value, ensure_ascii=False)
    return value.encode("utf-16", "surrogatepass").decode("utf-16", "replace")
