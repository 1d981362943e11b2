"""Components and dependencies out of source files: each file is parsed once, names are resolved by joins."""

from __future__ import annotations

import ast
import builtins
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quernel.functions.python_source import unify_lines
from quernel.functions.text import module_path

# Modules of the standard library and names that never lead to a dependency.
STANDARD = "abc argparse array asyncio base64 collections copy csv datetime enum functools glob io itertools json logging math os pathlib random re shutil string sys time typing uuid warnings xml".split()
OWN = {"self", "cls"}
BUILTINS = frozenset(dir(builtins))
# Fields of a statement that hold statements.
BLOCKS = {"body", "handlers", "orelse", "finalbody", "cases"}

COMPONENT = "struct<name string, kind string, start_line int, end_line int, has_docstring boolean, docstring string, code string, bases array<string>, ord int>"
IMPORT = "struct<module string, name string, ord int>"
REFERENCE = "struct<owner string, kind string, first string, second string, modules array<string>>"
CALL = "struct<owner string, class string, prefix string, name string, var_class string>"
PARSED = f"repo_name string, relative_path string, error string, components array<{COMPONENT}>, imports array<{IMPORT}>, refs array<{REFERENCE}>, calls array<{CALL}>"


def _docstring(node) -> str | None:
    first = node.body[0] if node.body else None
    return first.value.value if isinstance(first, ast.Expr) and isinstance(first.value, ast.Constant) and isinstance(first.value.value, str) else None


def _functions(body: list) -> list:
    return [x for x in body if isinstance(x, (ast.FunctionDef, ast.AsyncFunctionDef))]


def _chain(node: ast.Attribute) -> list[str] | None:
    """The names of ``a.b.c``; None if it doesn't begin with a name."""
    parts = []
    while isinstance(node, ast.Attribute):
        parts.append(node.attr)
        node = node.value
    return [node.id, *reversed(parts)] if isinstance(node, ast.Name) else None


def _preorder(root: ast.AST) -> Iterator[ast.AST]:
    stack = [root]
    while stack:
        node = stack.pop()
        yield node
        stack += reversed(list(ast.iter_child_nodes(node)))


def _statements(tree: ast.Module) -> Iterator[ast.AST]:
    """Statements in the order of ``ast.walk``, with what holds statements; expressions hold none and aren't entered."""
    waiting = deque([tree])
    while waiting:
        node = waiting.popleft()
        yield node
        for field in node._fields:
            if field in BLOCKS:
                waiting.extend(getattr(node, field))


def references(node: ast.AST) -> Iterator[tuple[str, str, str | None]]:
    """(name, x, None) and (attribute, x, y) that a component refers to, in the order of its text. Its plain arguments, and names
    once they were assigned, are local and aren't references; other bindings aren't taken as local."""
    local = {a.arg for a in node.args.args} if isinstance(node, (ast.FunctionDef, ast.AsyncFunctionDef)) else set()

    def refer(x: ast.AST) -> Iterator[tuple[str, str, str | None]]:
        if isinstance(x, ast.Name) and x.id not in local and x.id not in OWN and x.id not in BUILTINS:
            yield "name", x.id, None
        elif isinstance(x, ast.Attribute) and (parts := _chain(x)) and parts[0] not in local and parts[0] not in OWN:
            yield "attribute", parts[0], parts[1]

    for x in _preorder(node):
        if isinstance(x, ast.Assign):
            local |= {t.id for t in x.targets if isinstance(t, ast.Name)}
        elif isinstance(x, ast.ClassDef):
            for base in x.bases:
                yield from refer(base)
        elif isinstance(x, ast.Call):
            yield from refer(x.func)
        elif isinstance(x, ast.Attribute) or isinstance(x, ast.Name) and isinstance(x.ctx, ast.Load):
            yield from refer(x)


def _calls(owner: str, cls: str | None, node: ast.AST, made_in_init: dict[str, str]) -> Iterator[tuple]:
    made = {}
    for x in _preorder(node):
        if isinstance(x, ast.Assign) and isinstance(x.value, ast.Call) and isinstance(x.value.func, ast.Name):
            for t in x.targets:
                if isinstance(t, ast.Name):
                    made[t.id] = x.value.func.id
        elif isinstance(x, ast.Call):
            if isinstance(x.func, ast.Name):
                yield owner, cls, None, x.func.id, None
            elif isinstance(x.func, ast.Attribute) and (parts := _chain(x.func)):
                if len(parts) == 2:
                    yield owner, cls, parts[0], parts[1], made.get(parts[0])
                elif len(parts) == 3 and parts[0] == "self":
                    yield owner, cls, parts[1], parts[2], made_in_init.get(parts[1], made.get(parts[1]))


def _made_on_self(cls: ast.ClassDef) -> dict[str, str]:
    """Class names by attribute, of ``self.x = C()`` in the constructor."""
    made = {}
    for init in (f for f in _functions(cls.body) if f.name == "__init__"):
        for x in _preorder(init):
            if isinstance(x, ast.Assign) and isinstance(x.value, ast.Call) and isinstance(x.value.func, ast.Name):
                for t in x.targets:
                    if isinstance(t, ast.Attribute) and isinstance(t.value, ast.Name) and t.value.id == "self":
                        made[t.attr] = x.value.func.id
    return made


def read_source(source: str, links: bool = True) -> tuple:
    """(error, components, imports, refs, calls) of one file. Names are relative to the module. Every class counts, by
    its bare name whatever it stands in, with its direct methods; functions only at the top. Dependencies are looked for
    in the first top-level class or function of a name. An error leaves all lists empty, and without ``links`` the last three
    are."""
    try:
        tree = ast.parse(unify_lines(source))
    except (SyntaxError, ValueError, RecursionError, MemoryError) as e:
        return type(e).__name__, [], [], [], []
    text_lines = unify_lines(source).split("\n")
    found: list[tuple] = []

    def component(name: str, kind: str, node) -> None:
        doc = _docstring(node)
        bases = [b.id for b in node.bases if isinstance(b, ast.Name)] if kind == "class" else []
        # the exact segment; columns count bytes
        own = text_lines[node.lineno - 1 : node.end_lineno]
        own[-1] = own[-1].encode()[: node.end_col_offset].decode()
        own[0] = own[0].encode()[node.col_offset :].decode()
        found.append((name, kind, node.lineno, node.end_lineno, doc is not None, doc or "", "\n".join(own), bases, len(found)))

    for node in _statements(tree):
        if isinstance(node, ast.ClassDef):
            component(node.name, "class", node)
            for f in _functions(node.body):
                component(f"{node.name}.{f.name}", "method", f)
    for f in _functions(tree.body):
        component(f.name, "function", f)
    if not links:
        return None, found, [], [], []

    imports = []
    for node in ast.walk(tree):
        if isinstance(node, ast.Import):
            imports += [(a.name, None, len(imports) + i) for i, a in enumerate(node.names)]
        elif isinstance(node, ast.ImportFrom) and node.module is not None:
            imports += [(node.module, a.name, len(imports) + i) for i, a in enumerate(node.names) if a.name != "*"]
    plain = {m for m, n, _ in imports if n is None}
    named: dict[str, set] = {}
    for m, n, _ in imports:
        if n is not None:
            named.setdefault(m, set()).add(n)

    refs, calls, seen = [], [], set()
    top_classes = {}
    for c in (x for x in tree.body if isinstance(x, ast.ClassDef)):
        top_classes.setdefault(c.name, c)
    targets = [(n, c) for n, c in top_classes.items()]
    for n, c in top_classes.items():
        for f in _functions(c.body):
            targets.append((f"{n}.{f.name}", f))
    targets += [(f.name, f) for f in _functions(tree.body)]
    for owner, node in targets:
        if owner in seen:
            continue
        seen.add(owner)
        for kind, first, second in dict.fromkeys(references(node)):
            if kind == "name":
                refs.append((owner, kind, first, None, [m for m, names in named.items() if m not in STANDARD and first in names]))
            elif first not in STANDARD and (first in plain or second in named.get(first, ())):
                refs.append((owner, "imported" if first in plain else "from", first, second, []))
        if not isinstance(node, ast.ClassDef):
            cls = owner.rpartition(".")[0] or None
            calls += _calls(owner, cls, node, _made_on_self(top_classes[cls]) if cls else {})
    return None, found, imports, refs, list(dict.fromkeys(calls))


def parse_files(files: DataFrame, links: bool = True) -> DataFrame:
    """One row per distinct file with content: what ``read_source`` finds. Files that don't compile have an ``error``
    and empty lists; null contents give no row. Parse once, keep the result (``session.cut``), and take the tables below from it.
    Without ``links`` only components are sought."""
    rows = files.select("repo_name", "relative_path", "content").where("content is not null").distinct()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(r, p, *read_source(c, links)) for r, p, c in batch.itertuples(index=False)]
            yield pd.DataFrame(out, columns=["repo_name", "relative_path", "error", "components", "imports", "refs", "calls"])

    return rows.mapInPandas(run, PARSED)


def _qualified(parsed: DataFrame, column: str) -> DataFrame:
    return parsed.select("repo_name", "relative_path", module_path("relative_path").alias("module"), F.explode(column).alias("x"))


def components(parsed: DataFrame) -> DataFrame:
    """(repo_name, id, component_type, relative_path, start_line, end_line, has_docstring, docstring, code, bases); of
    several with one id the last of a file counts."""
    rows = _qualified(parsed, "components").select("repo_name", F.concat_ws(".", "module", "x.name").alias("id"), "relative_path", "x")
    last = rows.withColumn("n", F.row_number().over(Window.partitionBy("repo_name", "id").orderBy(F.desc("relative_path"), F.desc("x.ord")))).where("n = 1")
    return last.select("repo_name", "id", F.col("x.kind").alias("component_type"), "relative_path", "x.start_line", "x.end_line", "x.has_docstring", "x.docstring", "x.code", "x.bases")


def imports(parsed: DataFrame) -> DataFrame:
    """(repo_name, relative_path, module, name): name is null for ``import m``."""
    return parsed.select("repo_name", "relative_path", F.explode("imports").alias("x")).select("repo_name", "relative_path", "x.module", "x.name")


def modules(parsed: DataFrame) -> DataFrame:
    """(repo_name, module) of every file."""
    return parsed.select("repo_name", module_path("relative_path").alias("module")).distinct()


def dependencies(parsed: DataFrame) -> DataFrame:
    """(repo_name, src, dst): resolved and existing dependencies, with those of classes on their methods but ``__init__``.

    A name leads to the first from-import of a module of the repository that has it, else to the own module; an attribute
    to the imported module of its first part. Kept are those that are components or whose first segment is a module.
    """
    known = modules(parsed)
    refs = _qualified(parsed, "refs").select("repo_name", "module", F.concat_ws(".", "module", "x.owner").alias("src"), "x.kind", "x.first", "x.second", "x.modules")
    names = refs.where("kind = 'name'")
    tried = names.select("*", F.posexplode_outer("modules").alias("pos", "candidate"))
    met = tried.join(known.select("repo_name", F.col("module").alias("candidate"), F.lit(True).alias("there")), ["repo_name", "candidate"], "left")
    chosen = met.groupBy("repo_name", "module", "src", "first").agg(F.min(F.when(F.col("there"), F.struct("pos", "candidate"))).alias("c"))
    by_name = chosen.select("repo_name", "src", F.concat_ws(".", F.coalesce("c.candidate", "module"), "first").alias("dst"))
    # an import must be of a module of the repository; from-imports aren't checked
    direct = refs.where("kind = 'imported'").join(known.select("repo_name", F.col("module").alias("first")), ["repo_name", "first"], "left_semi")
    by_part = direct.unionByName(refs.where("kind = 'from'").select(*direct.columns)).select("repo_name", "src", F.concat_ws(".", "first", "second").alias("dst"))
    raw = by_name.unionByName(by_part).distinct()
    own = components(parsed).select("repo_name", "id", "component_type")
    raw = raw.join(own.select("repo_name", F.col("id").alias("src")), ["repo_name", "src"], "left_semi")
    as_component = raw.join(own.select("repo_name", F.col("id").alias("dst")), ["repo_name", "dst"], "left_semi")
    heads = known.select("repo_name", F.col("module").alias("head"))
    as_module = raw.withColumn("head", F.split_part("dst", F.lit("."), F.lit(1))).join(heads, ["repo_name", "head"], "left_semi")
    methods = own.where("component_type = 'method'").select("repo_name", F.regexp_replace("id", r"\.[^.]*$", "").alias("src"), F.col("id").alias("dst")).where(~F.col("dst").endswith(".__init__"))
    methods = methods.join(own.where("component_type = 'class'").select("repo_name", F.col("id").alias("src")), ["repo_name", "src"], "left_semi")
    columns = ["repo_name", "src", "dst"]
    return as_component.select(*columns).unionByName(as_module.select(*columns)).unionByName(methods.select(*columns)).distinct()


def self_calls(parsed: DataFrame) -> DataFrame:
    """(repo_name, src, dst) between methods of one class by ``self.x(...)``; the default dependencies leave them out."""
    calls = _qualified(parsed, "calls").where("x.prefix = 'self' and x.class is not null")
    wanted = calls.select("repo_name", F.concat_ws(".", "module", "x.owner").alias("src"), F.concat_ws(".", "module", "x.class", "x.name").alias("dst"))
    own = components(parsed).where("component_type = 'method'").select("repo_name", F.col("id").alias("dst"))
    return wanted.join(own, ["repo_name", "dst"], "left_semi").select("repo_name", "src", "dst").distinct()


def call_sites(parsed: DataFrame) -> DataFrame:
    """(file, caller, caller_class, prefix, name, var_class) for ``lookups.edges_by_call``; file is repository and path."""
    file = F.concat_ws(":", "repo_name", "relative_path").alias("file")
    return parsed.select(file, F.explode("calls").alias("x")).select("file", F.concat_ws(":", "file", "x.owner").alias("caller"), F.col("x.class").alias("caller_class"), "x.prefix", "x.name", "x.var_class")


def definition_sites(parsed: DataFrame) -> DataFrame:
    """(file, id, class, name) of functions and methods, as above."""
    file = F.concat_ws(":", "repo_name", "relative_path").alias("file")
    rows = parsed.select(file, F.explode("components").alias("x")).where("x.kind <> 'class'")
    cls = F.when(F.contains("x.name", F.lit(".")), F.split_part("x.name", F.lit("."), F.lit(1)))
    return rows.select("file", F.concat_ws(":", "file", "x.name").alias("id"), cls.alias("class"), F.element_at(F.split("x.name", r"\."), -1).alias("name")).distinct()


def class_bases(parsed: DataFrame) -> DataFrame:
    """(file, class, pos, base) for ``lookups.inherited``."""
    file = F.concat_ws(":", "repo_name", "relative_path").alias("file")
    rows = parsed.select(file, F.explode("components").alias("x")).where("x.kind = 'class'")
    return rows.select("file", F.col("x.name").alias("class"), F.posexplode("x.bases").alias("pos", "base"))


def doc_items(components_: DataFrame) -> DataFrame:
    """(component_id, kind, location, signature, content, repo_name, relative_path) for enrichment: kind ``component`` if it
    is missing, location the first of relative path and file path that isn't empty, content the docstring."""
    from quernel.functions.text import component_signature

    text = lambda c: F.nullif(F.col(c), F.lit(""))
    kind = F.coalesce(text("component_type"), F.lit("component"))
    return components_.select(
        F.col("id").alias("component_id"),
        kind.alias("kind"),
        F.coalesce(text("file_path"), text("relative_path"), F.lit("")).alias("location"),
        component_signature("id", kind).alias("signature"),
        F.coalesce(text("docstring"), F.lit("")).alias("content"),
        "repo_name",
        "relative_path",
    )
