"""Problem 1: functions and methods paired with their documentation."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from quernel.functions.python_source import definitions
from quernel.llm.telling import telling
from quernel.session import cut

SYMBOLS = "repo_name string, relative_path string, module string, symbol string, signature string, parameters array<string>, start_line int, end_line int, stub boolean, definition_doc string, code string"


def symbol_table(files: DataFrame, with_code: bool = True) -> DataFrame:
    """Every definition of every file: qualified symbol, normalised signature (parameter names without
    annotations, defaults and stars), lines, docstring and, if ``with_code``, code; one further row with a null
    ``symbol`` for each file with content.

    Files whose content is null or blank give no rows; files that don't compile are scanned all the same; copies
    of a file count once. ``stub`` marks declarations: those in ``.pyi`` files and bodies of only ``...``.
    """
    rows = files.select("repo_name", "relative_path", "content").where(F.trim(F.regexp_replace("content", r"\s+", " ")) != "")

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: list[tuple] = []
            for repo, path, content in batch.itertuples(index=False):
                path = path or ""
                module = path.rpartition(".")[0].replace("/", ".") if "." in path.rpartition("/")[2] else path.replace("/", ".")
                out.append((repo, path, module, None, None, None, None, None, None, None, None))
                for d in definitions(content, with_code):
                    if d.kind != "class":
                        stub = path.endswith(".pyi") or d.stub
                        signature = f"{d.name.rpartition('.')[2]}({','.join(d.parameters)})"
                        out.append((repo, path, module, d.name, signature, list(d.parameters), d.start_line, d.end_line, stub, d.docstring, d.code if with_code else None))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in SYMBOLS.split(", ")])

    return rows.mapInPandas(scan, SYMBOLS)


def declared_functions(graph: DataFrame) -> DataFrame:
    """Current rows of functions and methods that aren't deleted: repo_name, id, relative_path, docstring, start_line.

    The current row of (repo_name, id) has the greatest scan_time, then the earliest ingested_at; further ties are
    settled by the other columns. ``component_type`` counts without case and outer blanks. One aggregation that
    combines before the shuffle.
    """
    age = F.expr("-timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ingested_at)")
    kind = F.lower(F.btrim("component_type", F.lit(" \t\r\n")))
    top = F.max(F.struct("scan_time", age.alias("age"), F.col("deleted_at").isNotNull().alias("deleted"), kind.isin("function", "method").alias("wanted"), "relative_path", "start_line", "docstring"))
    best = graph.groupBy("repo_name", "id").agg(top.alias("t")).where(F.col("t.wanted") & ~F.col("t.deleted"))
    return best.select("repo_name", "id", "t.relative_path", "t.docstring", "t.start_line")


def blank(column: str) -> F.Column:
    """Null, empty or only white space (of Unicode)."""
    return F.coalesce(~F.col(column).rlike(r"(?U)\S"), F.lit(True))


@F.pandas_udf(BooleanType())
def is_telling(doc: pd.Series, symbol: pd.Series, parameters: pd.Series) -> pd.Series:
    return pd.Series([telling(d, s or "", tuple(p) if p is not None else ()) for d, s, p in zip(doc, symbol, parameters)], dtype=bool)


def pairs(graph: DataFrame, files: DataFrame, with_code: bool = True, across_files: bool = True) -> DataFrame:
    """Components with a telling documentation: repo_name, id, documentation and, if ``with_code``, signature and code.

    A component joins the definitions of its symbol by (repo_name, module, qualified symbol), so those of all files of a
    module (``m.py``, ``m.pyi``) meet. Its own definition is sought in its own file first: the one at the declared line,
    else one whose normalised signature agrees with a documented declaration of that symbol (an overload or a stub), else
    the last. If that is a mere declaration, its code is that of the definition with the same normalised signature, in
    whatever file. The documentation is the ``docstring`` of the graph or, where that is blank, the one standing at the own
    definition, else at a declaration with the same normalised signature in the own file, else, with ``across_files``, in
    another file of the module. Components without a file with content are dropped. A component that no file of its module
    defines has null code. Null or empty inputs give no rows, a null repo_name or path never has a file, copies count once.
    The files are parsed once; the symbol table is kept in a checkpoint.
    """
    found = cut(symbol_table(files, with_code))
    declared = declared_functions(graph)
    module = F.replace(F.regexp_replace("relative_path", r"\.[^./]*$", ""), F.lit("/"), F.lit("."))
    declared = declared.withColumn("module", module)
    inside = F.startswith(F.col("id"), F.concat("module", F.lit(".")))
    declared = declared.withColumn("symbol", F.when(inside, F.substr("id", F.length("module") + 2)).otherwise(F.col("id")))
    # one row for each (module, symbol): its definitions side by side; the null symbol stands for a file itself
    kept = ["start_line", "relative_path", "signature", "parameters", "end_line", "stub", "definition_doc"] + ["code"] * with_code
    there = found.where(F.col("symbol").isNull()).select("repo_name", "relative_path").distinct()
    symbols = found.where(F.col("symbol").isNotNull()).groupBy("repo_name", "module", "symbol").agg(F.sort_array(F.collect_set(F.struct(*kept)), asc=False).alias("definitions"))
    joined = declared.join(there, ["repo_name", "relative_path"], "left_semi").join(symbols, ["repo_name", "module", "symbol"], "left")
    here = lambda d: d["relative_path"] == F.col("relative_path")
    documented = lambda d: d["definition_doc"].rlike(r"(?U)\S")
    first = lambda condition: F.get(F.filter("definitions", condition), F.lit(0))
    signed = F.transform(F.filter("definitions", lambda d: documented(d) & (here(d) | F.lit(across_files))), lambda d: d["signature"])
    pick = F.coalesce(
        first(lambda d: here(d) & (d["start_line"] == F.col("start_line"))),
        first(lambda d: here(d) & ~d["stub"] & F.array_contains(signed, d["signature"])),
        first(lambda d: here(d) & ~d["stub"]),
        first(here),
        first(lambda d: ~d["stub"]),
        first(lambda d: F.lit(True)),
    )
    joined = joined.withColumn("own", pick)
    agrees = lambda d: documented(d) & (d["signature"] == F.col("own.signature"))
    in_order = F.reverse("definitions")
    near = F.get(F.filter(in_order, lambda d: here(d) & agrees(d)), F.lit(0))["definition_doc"]
    far = F.get(F.filter(in_order, agrees), F.lit(0))["definition_doc"] if across_files else F.lit(None).cast("string")
    own_doc = F.when(documented(F.col("own")) & here(F.col("own")) | F.lit(across_files), F.col("own.definition_doc"))
    in_file = F.coalesce(*[F.when(c.rlike(r"(?U)\S"), c) for c in (own_doc, near, far)])
    joined = joined.withColumn("documentation", F.when(blank("docstring"), in_file).otherwise(F.col("docstring")))
    told = joined.where(~blank("documentation")).where(is_telling("documentation", "symbol", "own.parameters"))
    if not with_code:
        return told.select("repo_name", "id", "documentation")
    whole = lambda d: ~d["stub"] & (d["signature"] == F.col("own.signature"))
    definition = F.when(F.col("own.stub"), F.coalesce(first(lambda d: here(d) & whole(d)), first(whole), F.col("own"))).otherwise(F.col("own"))
    return told.withColumn("definition", definition).select("repo_name", "id", "documentation", F.col("definition.signature").alias("signature"), F.col("definition.code").alias("code"))
