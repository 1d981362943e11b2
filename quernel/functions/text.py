"""Column expressions over text: cleaning, names, signatures, JSON and XML replies, tokens, chunks, templates.

All are built-in expressions, so they stay in the JVM. Null in gives null out unless said otherwise; an empty text
is a text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Headers that end an examples block; methods and name prefixes of little interest; generic words.
DOC_HEADERS = ["Args", "Returns", "Raises", "Summary", "Description", "Parameters", "Attributes"]
PLAIN_DUNDERS = ["__repr__", "__str__", "__len__", "__iter__", "__getitem__", "__setitem__"]
ACCESSORS = ["get_", "set_", "is_", "has_"]
GENERIC_WORDS = ["getter", "setter", "returns", "return", "get", "set"]
# Glob patterns of paths that a directory scan leaves out.
IGNORED = [".git", "__pycache__", ".pytest_cache", ".env", "venv", "node_modules", ".DS_Store", "*.pyc", "*.pyo", "*.pyd", ".Python", "*.so"]


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_think(text: Column | str) -> Column:
    """Without ``<think>`` blocks (any case, over lines) and the white space after them and at the start."""
    return F.regexp_replace(F.regexp_replace(col(text), r"(?is)<think>.*?</think>(?U)\s*", ""), r"^(?U)\s+", "")


def strip(text: Column | str) -> Column:
    """Without white space (of Unicode) at both ends."""
    return F.regexp_replace(col(text), r"^(?U)\s+|(?U)\s+$", "")


def normalize_ws(text: Column | str) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return strip(F.regexp_replace(col(text), r"(?U)\s+", " "))


def lines(text: Column | str) -> Column:
    """The lines of a text; line ends are those of Unicode. A final line end begins no line."""
    return F.split(F.regexp_replace(col(text), r"(\r\n|[\n\r\u000b\f\u0085\u2028\u2029])$", ""), r"\r\n|[\n\r\u000b\f\u0085\u2028\u2029]")


def strip_examples(doc: Column | str) -> Column:
    """A docstring without its examples block: it runs from a line ``Example(s):`` to the next known header that
    isn't inside a code fence."""
    header = r"^(?U)\s*(" + "|".join(DOC_HEADERS) + r")\s*:.*$"
    start = F.struct(F.lit(False).alias("inside"), F.lit(False).alias("fenced"), F.array().cast("array<string>").alias("kept"))

    def step(state: Column, line: Column) -> Column:
        opens = line.rlike(r"^(?U)\s*Examples?\s*:.*$")
        fence = state["inside"] & F.startswith(strip(line), F.lit("```"))
        ends = state["inside"] & ~fence & ~state["fenced"] & line.rlike(header)
        keep = ~opens & (~state["inside"] | ends)
        return F.struct(
            F.when(opens, True).when(ends, False).otherwise(state["inside"]).alias("inside"),
            F.when(~opens & fence, ~state["fenced"]).otherwise(state["fenced"]).alias("fenced"),
            F.when(keep, F.concat(state["kept"], F.array(line))).otherwise(state["kept"]).alias("kept"),
        )

    return strip(F.array_join(F.aggregate(lines(doc), start, step)["kept"], "\n"))


def md_link(text: Column | str, target: Column | str) -> Column:
    """``[text](target)``."""
    return F.format_string("[%s](%s)", col(text), col(target))


def comma_list(text: Column | str) -> Column:
    """The trimmed, non-empty parts between commas; an empty array for null."""
    return F.coalesce(F.filter(F.transform(F.split(col(text), ","), strip), lambda x: x != ""), F.array().cast("array<string>"))


def name_in_signature(signature: Column | str) -> Column:
    """The first identifier before a bracket, empty if there is none."""
    return F.regexp_extract(col(signature), r"\b([A-Za-z_]\w*)\s*\(", 1)


def name_in_code(code: Column | str) -> Column:
    """The name in a first line ``class X`` or ``def x``; null otherwise (also for ``async def``)."""
    found = F.regexp_extract(F.regexp_replace(col(code), r"^(?U)\s+", ""), r"^(?:class|def) +([A-Za-z_]\w*)", 1)
    return F.when(found != "", found)


def module_path(path: Column | str) -> Column:
    """A relative path as a dotted module path."""
    return F.replace(F.regexp_replace(col(path), r"\.py$", ""), F.lit("/"), F.lit("."))


def last_segment(dotted: Column | str) -> Column:
    return F.element_at(F.split(col(dotted), r"\."), -1)


def display_name(identifier: Column | str, kind: Column | str) -> Column:
    """``Class.method`` for methods of more than two segments, else the last segment."""
    parts = F.split(col(identifier), r"\.")
    return F.when((col(kind) == "method") & (F.size(parts) > 2), F.array_join(F.slice(parts, -2, 2), ".")).otherwise(F.element_at(parts, -1))


def package_of(path: Column | str) -> Column:
    """First segment of a path; ``(root)`` for a bare file, ``(unknown)`` for null and empty."""
    return F.when(F.coalesce(col(path), F.lit("")) == "", "(unknown)").when(F.size(F.split(col(path), "/")) <= 1, "(root)").otherwise(F.split_part(col(path), F.lit("/"), F.lit(1)))


def base_name(path: Column | str) -> Column:
    return F.element_at(F.split(col(path), "/"), -1)


def extension(path: Column | str) -> Column:
    """What follows the last dot of the base name, ``none`` without one; a leading dot doesn't count."""
    found = F.regexp_extract(base_name(path), r"^.+\.([^.]+)$", 1)
    return F.when(found == "", "none").otherwise(found)


def ignored(path: Column | str) -> Column:
    """True if the path or one of its parents matches a pattern of ``IGNORED`` on its last segment."""
    segment = "|".join(p.replace(".", r"\.").replace("*", "[^/]*") for p in IGNORED)
    return col(path).rlike(rf"(^|/)({segment})(/|$)")


def trivial(signature: Column | str, kind: Column | str, doc: Column | str) -> Column:
    """True for components of little interest: some dunders; accessors with under 80 characters of documentation;
    functions and methods with under 40 that use a generic word. Without a name never. Null texts count as empty."""
    name = F.lower(name_in_signature(F.coalesce(col(signature), F.lit(""))))
    text = normalize_ws(strip_examples(F.coalesce(col(doc), F.lit(""))))
    generic = F.lower(text).rlike("|".join(GENERIC_WORDS))
    return (
        F.when(name == "", False)
        .when(name.isin(PLAIN_DUNDERS), True)
        .when(name.rlike("^(" + "|".join(ACCESSORS) + ")"), F.length(text) < 80)
        .otherwise(F.lower(F.coalesce(col(kind), F.lit(""))).isin("function", "method") & (F.length(text) < 40) & generic)
    )


def route(dotted: Column | str) -> Column:
    """What a dotted path leads to: ``method`` (capital parent, three segments or more), ``class`` (capital last),
    ``function``; null under two segments. Names with a leading underscore follow their parent."""
    parts = F.split(col(dotted), r"\.")
    last, parent = F.element_at(parts, -1), F.try_element_at(parts, F.lit(-2))
    return F.when(F.size(parts) < 2, None).when((F.size(parts) >= 3) & parent.rlike(r"^\p{Lu}"), "method").when(last.rlike(r"^\p{Lu}"), "class").otherwise("function")


def request_route(dotted: Column | str) -> Column:
    """What a requested name is: ``class`` (capital last), ``method`` (capital parent, two segments suffice), ``function``; null
    for a single segment that isn't a class. Names with a leading underscore aren't capital."""
    parts = F.split(col(dotted), r"\.")
    last, parent = F.element_at(parts, -1), F.try_element_at(parts, F.lit(-2))
    return F.when(last.rlike(r"^\p{Lu}"), "class").when(F.coalesce(parent.rlike(r"^\p{Lu}"), F.lit(False)), "method").when(F.size(parts) >= 2, "function")


def component_signature(identifier: Column | str, kind: Column | str) -> Column:
    """``class X`` or ``def x(...)``."""
    name = last_segment(identifier)
    return F.when(col(kind) == "class", F.concat(F.lit("class "), name)).otherwise(F.concat(F.lit("def "), name, F.lit("(...)")))


def first_line(text: Column | str) -> Column:
    return F.get(lines(text), F.lit(0))


def head_lines(text: Column | str, n: int) -> Column:
    return F.array_join(F.slice(lines(text), 1, n), "\n")


def snippet(text: Column | str, words: int) -> Column:
    """White space normalised, at most ``words`` words."""
    return F.array_join(F.slice(F.split(normalize_ws(text), " "), 1, words), " ")


def code_signature(code: Column | str, is_class: Column | bool = False) -> Column:
    """The signature in the first line of a piece of code: up to the first colon behind the bracket that closes the first
    one; the whole line, stripped, for classes and where no bracket closes or no colon follows."""
    line = strip(F.split_part(col(code), F.lit("\n"), F.lit(1)))
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("end"))

    def step(state: Column, i: Column) -> Column:
        c = F.substring(line, i, F.lit(1))
        depth = state["depth"] + F.when(c == "(", 1).when(c == ")", -1).otherwise(0)
        return F.struct(depth.alias("depth"), F.when((state["end"] == 0) & (c == ")") & (depth == 0), i).otherwise(state["end"]).alias("end"))

    places = F.when(F.length(line) > 0, F.sequence(F.lit(1), F.length(line))).otherwise(F.array().cast("array<int>"))
    end = F.aggregate(places, start, step)["end"]
    colon = F.locate(":", line, 1)
    after = F.instr(F.substring(line, end, F.length(line)), ":")
    whole = (end == 0) | (after == 0) | (colon == 0)
    return F.when(F.lit(is_class) if isinstance(is_class, bool) else is_class, line).when(whole, line).otherwise(F.substring(line, F.lit(1), end + after - 1))


def line_slice(text: Column | str, start: Column | str, end: Column | str) -> Column:
    """Lines ``start`` to ``end`` (from 1); null unless both are positive."""
    ok = (col(start) > 0) & (col(end) >= col(start))
    return F.when(ok, F.array_join(F.slice(F.split(F.replace(col(text), F.lit("\r\n"), F.lit("\n")), "\n"), col(start), col(end) - col(start) + 1), "\n"))


def chat_role(role: Column | str, dialect: str = "openai") -> Column:
    """Roles by provider: human and user, ai and assistant, system; others are users. ``gemini`` calls the
    assistant model and has no system."""
    plain = F.when(F.lower(col(role)).isin("ai", "assistant"), "assistant").when(F.lower(col(role)) == "system", "system").otherwise("user")
    if dialect == "gemini":
        return F.when(plain == "assistant", "model").otherwise("user")
    return plain


def json_reply(text: Column | str) -> Column:
    """The JSON object of a model's reply as text: from the first brace to the last, fences dropped; if that doesn't
    parse, once more with single quotes as double ones and True, False, None in JSON's spelling. Null if neither parses."""
    body = F.regexp_extract(col(text), r"(?s)\{.*\}", 0)
    repaired = F.replace(body, F.lit("'"), F.lit('"'))
    for python, plain in (("True", "true"), ("False", "false"), ("None", "null")):
        repaired = F.regexp_replace(repaired, rf"\b{python}\b", plain)
    # in brackets, as what follows a value would be ignored otherwise
    parses = lambda x: F.try_parse_json(F.concat(F.lit("["), x, F.lit("]"))).isNotNull() & (F.json_array_length(F.concat(F.lit("["), x, F.lit("]"))) == 1)
    return F.when(body == "", None).when(parses(body), body).when(parses(repaired), repaired)


def needs_info(text: Column | str) -> Column:
    """The flag in the first ``<INFO_NEED>`` of a reply."""
    return F.coalesce(F.lower(strip(F.regexp_extract(col(text), r"(?s)<INFO_NEED>(.*?)</INFO_NEED>", 1))) == "true", F.lit(False))


REQUEST_SCHEMA = "INTERNAL struct<CALLS struct<CLASS string, FUNCTION string, METHOD string>, CALL_BY string>, RETRIEVAL struct<QUERY string>"


def request(text: Column | str) -> Column:
    """The first ``<REQUEST>`` of a reply as a struct: classes, functions, methods, call_by, queries. Absent lists are
    empty; without ``INTERNAL`` and ``CALLS``, or if the XML is malformed, every field is empty."""
    xml = F.regexp_extract(col(text), r"(?s)<REQUEST>.*?</REQUEST>", 0)
    tree = F.from_xml(F.when(xml == "", "<REQUEST/>").otherwise(xml), REQUEST_SCHEMA, {"mode": "PERMISSIVE", "ignoreSurroundingSpaces": "true"})
    ok = F.coalesce(tree["INTERNAL"]["CALLS"].isNotNull(), F.lit(False))
    pick = lambda value: F.when(ok, comma_list(value)).otherwise(F.array().cast("array<string>"))
    return F.struct(
        pick(tree["INTERNAL"]["CALLS"]["CLASS"]).alias("classes"),
        pick(tree["INTERNAL"]["CALLS"]["FUNCTION"]).alias("functions"),
        pick(tree["INTERNAL"]["CALLS"]["METHOD"]).alias("methods"),
        F.coalesce(ok & (F.lower(tree["INTERNAL"]["CALL_BY"]) == "true"), F.lit(False)).alias("call_by"),
        pick(tree["RETRIEVAL"]["QUERY"]).alias("queries"),
    )


def word_count(text: Column | str) -> Column:
    """Words between white space; 0 for null and blank."""
    clean = normalize_ws(F.coalesce(col(text), F.lit("")))
    return F.when(clean == "", 0).otherwise(F.size(F.split(clean, " ")))


def token_estimate(text: Column | str) -> Column:
    """1.3 tokens a word."""
    return word_count(text) * F.lit(1.3).cast("double")


def truncate_words(text: Column | str, n: Column | int) -> Column:
    """The first ``n`` words; empty for null or n of 0 or less; unchanged if it has no more."""
    n = n if isinstance(n, Column) else F.lit(n)
    return F.when(col(text).isNull() | (n <= 0), "").when(word_count(text) <= n, col(text)).otherwise(F.array_join(F.slice(F.split(normalize_ws(text), " "), F.lit(1), n), " "))


def doc_budget(max_input: Column | str, max_output: Column | str) -> Column:
    """Tokens left for a document: half the output and 128 are kept free, then 60 % of the input, at least 256."""
    spare = F.greatest(F.lit(256), col(max_input) - (F.floor(col(max_output) * 0.5) + 128))
    return F.greatest(F.lit(256), F.floor(spare * 0.6)).cast("int")


def section_budgets(budget: Column | str) -> Column:
    """12 %, 44 % and the rest of a budget, at least 32, 128 and 128."""
    title = F.greatest(F.lit(32), F.floor(col(budget) * 0.12))
    body = F.greatest(F.lit(128), F.floor(col(budget) * 0.44))
    return F.struct(title.cast("int").alias("title"), body.cast("int").alias("body"), F.greatest(F.lit(128), col(budget) - title - body).cast("int").alias("context"))


def chunks(text: Column | str, size: int = 1200, overlap: int = 150) -> Column:
    """Windows of ``size`` characters every ``size - overlap``; the last ends with the text. Empty for an empty text,
    the whole text for a size of 0 or less."""
    if size <= 0:
        return F.when(F.length(col(text)) > 0, F.array(col(text))).otherwise(F.array().cast("array<string>"))
    if overlap >= size:
        raise ValueError("overlap must be smaller than size")
    step = size - overlap
    count = (F.lit(1) + F.greatest(F.lit(0), F.ceil((F.length(col(text)) - size) / step))).cast("int")
    cut = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.substring(col(text), i * step + 1, F.lit(size)))
    return F.when(F.length(col(text)) > 0, cut).otherwise(F.array().cast("array<string>"))


def occurrences(text: Column | str, part: Column | str) -> Column:
    """How often ``part`` occurs in ``text`` without overlap, letter case apart; 0 for an empty part."""
    t, p = F.lower(col(text)), F.lower(col(part))
    return F.when(F.length(p) == 0, 0).otherwise(((F.length(t) - F.length(F.replace(t, p, F.lit("")))) / F.length(p)).cast("int"))


def clock(seconds: Column | str) -> Column:
    """Seconds as ``hh:mm:ss``."""
    s = F.floor(col(seconds)).cast("long")
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60)


def price(tokens: Column | str, per_million: Column | str) -> Column:
    return col(tokens) * col(per_million) / F.lit(1e6)


def glossary(entries: Column | str) -> Column:
    """``- key: value`` lines of an array of (key, value), in its order."""
    return F.array_join(F.transform(col(entries), lambda e: F.concat(F.lit("- "), e["key"], F.lit(": "), e["value"])), "\n")


def as_list(value: Column | str, kind: str = "string") -> Column:
    """An array as it is, an empty one for null."""
    return F.coalesce(col(value), F.array().cast(f"array<{kind}>"))


def tidy_lines(text: Column | str) -> Column:
    """A text whose lines are stripped and blank lines dropped."""
    return F.array_join(F.filter(F.transform(F.split(col(text), "\n"), strip), lambda x: x != ""), "\n")


def similarity(a: Column | str, b: Column | str) -> Column:
    """Share of equal characters, place by place, over the longer of two texts whose lines are stripped and blank
    lines dropped; null if both are empty."""
    x, y = tidy_lines(a), tidy_lines(b)
    longest = F.greatest(F.length(x), F.length(y))
    same = F.aggregate(F.zip_with(F.split(x, ""), F.split(y, ""), lambda p, q: F.coalesce(p == q, F.lit(False)).cast("int")), F.lit(0), lambda s, v: s + v)
    return F.when(longest > 0, F.when((F.length(x) == 0) | (F.length(y) == 0), 0.0).otherwise(same / longest))


def similar_code(a: Column | str, b: Column | str, threshold: float = 0.9) -> Column:
    """Two classes are similar if their names agree; other code if lengths differ by at most ``1 - threshold`` and
    ``similarity`` reaches ``threshold``."""
    both = F.regexp_replace(col(a), r"^(?U)\s+", "").startswith("class ") & F.regexp_replace(col(b), r"^(?U)\s+", "").startswith("class ")
    return F.when(both, name_in_code(a).eqNullSafe(name_in_code(b))).otherwise(F.coalesce(similarity(a, b) >= threshold, F.lit(False)))


def relative_to(path: Column | str, root: str) -> Column:
    """A path below ``root``; for others the base name."""
    prefix = root.rstrip("/") + "/"
    return F.when(F.startswith(col(path), F.lit(prefix)), F.substr(col(path), F.lit(len(prefix) + 1))).otherwise(base_name(path))


def without_root(path: Column | str, root: str) -> Column:
    """A path without slashes in front and without a first segment ``root``."""
    clean = F.regexp_replace(col(path), "^/+", "")
    return F.when(F.split_part(clean, F.lit("/"), F.lit(1)) == root, F.regexp_replace(clean, r"^[^/]*/?", "")).otherwise(clean)
