"""Joins: what is known, done, pending, called and found where."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial
from itertools import groupby
from operator import itemgetter

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quernel.functions import places
from quernel.operators.skew import split_join


def known_or_module(deps: DataFrame, components: DataFrame, modules: DataFrame) -> DataFrame:
    """Rows (src, dst) whose dst is a component, or whose first segment is a module; two semi-joins and a union, as a
    join on either would be a nested loop."""
    head = F.split_part("dst", F.lit("."), F.lit(1))
    named = deps.join(components.select(F.col("id").alias("dst")).distinct(), "dst", "left_semi")
    headed = deps.withColumn("_head", head).join(modules.select(F.col("module").alias("_head")).distinct(), "_head", "left_semi")
    return named.select("src", "dst").unionByName(headed.select("src", "dst")).distinct()


def remaining(work: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``work`` whose ``keys`` aren't in ``done``; null keys are never done."""
    return work.join(done.select(*keys).distinct(), keys, "left_anti")


def class_methods(components: DataFrame, with_init: bool = False) -> DataFrame:
    """(class_id, methods): the sorted methods of each class, an empty list for classes without any. ``__init__`` is left out
    unless ``with_init``."""
    parts = F.split("id", r"\.")
    methods = components.where("component_type = 'method'").select(F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 1), ".").alias("class_id"), "id", F.element_at(parts, -1).alias("name"))
    if not with_init:
        methods = methods.where("name <> '__init__'")
    lists = methods.groupBy("class_id").agg(F.array_sort(F.collect_set("id")).alias("methods"))
    classes = components.where("component_type = 'class'").select(F.col("id").alias("class_id")).distinct()
    return classes.join(lists, "class_id", "left").select("class_id", F.coalesce("methods", F.array().cast("array<string>")).alias("methods"))


def class_method_edges(components: DataFrame) -> DataFrame:
    """(src, dst) from each class to its methods but ``__init__``."""
    return class_methods(components).select(F.col("class_id").alias("src"), F.explode("methods").alias("dst"))


def source_of(components: DataFrame, files: DataFrame, keys: list[str]) -> DataFrame:
    """Components with the ``content`` of their file, null where there is none."""
    return components.join(files.select(*keys, "content"), keys, "left")


#: Length of the substrings by which texts and keys meet.
GRAM = 16


def containing(items: DataFrame, keys: DataFrame, text: str, key: str, order: str, anywhere: bool = False) -> DataFrame:
    """Items joined with the first key (by ``order``) that their ``text`` contains; items without one are dropped, and
    so are null texts and keys.

    A substring test would compare every item with every key. Instead candidates are cut out of the text and looked up
    by equality, so the work grows with the texts, not with the keys: runs of whole path segments, or with ``anywhere``
    all substrings of ``GRAM`` characters, which meet the last ``GRAM`` of each key (shorter keys meet substrings of their
    own length), and of what met the key itself is compared.
    """
    ends = F.when(F.length(key) >= GRAM, F.right(key, F.lit(GRAM))).otherwise(F.col(key))
    if anywhere:
        lengths = [r[0] for r in keys.select(F.length(ends)).where(F.length(key) > 0).distinct().collect()]  # at most GRAM

        def substrings(n: int) -> Column:
            every = F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.substring(text, i, F.lit(n)))
            return F.when(F.length(text) >= n, every).otherwise(F.array().cast("array<string>"))

        cuts = [substrings(n) for n in lengths]
        runs = F.flatten(F.array(*cuts)) if cuts else F.array().cast("array<string>")
    else:
        parts = F.split(text, "/")
        n = F.size(parts)
        runs = F.flatten(F.transform(F.sequence(F.lit(1), n), lambda i: F.transform(F.sequence(i, n), lambda j: F.array_join(F.slice(parts, i, j - i + 1), "/"))))
    laid = items.select(F.struct(*items.columns).alias("_item"), F.explode(F.array_distinct(runs)).alias("_run"))
    met = laid.join(keys.select((ends if anywhere else F.col(key)).alias("_run"), F.col(order).alias("_order"), F.col(key).alias("_key")), "_run")
    met = met.where(F.contains(F.col(f"_item.{text}"), F.col("_key"))) if anywhere else met
    best = met.groupBy("_item").agg(F.min(F.struct("_order", "_key")).alias("_best"))
    return best.select("_item.*", F.col("_best._key").alias(key))


def with_defaults(left: DataFrame, right: DataFrame, keys: list[str], defaults: dict[str, str]) -> DataFrame:
    """Left join with a text in place of null or empty values."""
    joined = left.join(right, keys, "left")
    return joined.withColumns({c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(d)) for c, d in defaults.items()})


def requested(requests: DataFrame, deps: DataFrame) -> DataFrame:
    """(id, kind, req, dst): for each requested name the dependency it gets.

    ``requests``: (id, kind, pos, req), ``deps``: (id, ord, dst) with ``kind``. A name fits a dependency of its kind whose last
    segment it is or whose path contains it. Each dependency goes to its first fitting name, each name keeps its last
    dependency. Pairs are formed within one id and kind only.
    """
    fits = (F.col("req") == F.element_at(F.split("dst", r"\."), -1)) | F.contains("dst", "req")
    met = requests.join(deps, ["id", "kind"]).where(fits)
    first = met.withColumn("a", F.row_number().over(Window.partitionBy("id", "kind", "dst").orderBy("pos"))).where("a = 1")
    last = first.withColumn("b", F.row_number().over(Window.partitionBy("id", "kind", "req").orderBy(F.desc("ord")))).where("b = 1")
    return last.select("id", "kind", "req", "dst")


def inherited(wanted: DataFrame, classes: DataFrame, methods: DataFrame, depth: int = 7) -> DataFrame:
    """(file, class, method, found_in): where a method comes from, along base classes of the same file.

    ``wanted``: (file, class, method), ``classes``: (file, class, pos, base), ``methods``: (file, class, method). The search goes
    depth first in the order of bases, at most ``depth`` steps; a level is one join, so it takes ``depth`` joins.
    """
    state = wanted.select("file", "class", "method").distinct().withColumn("at", F.col("class")).withColumn("path", F.array().cast("array<int>"))
    owners = methods.select("file", F.col("class").alias("at"), "method").distinct()
    found = None
    for level in range(depth + 1):
        hit = state.join(owners, ["file", "at", "method"]).select("file", "class", "method", "path", F.col("at").alias("found_in"))
        found = hit if found is None else found.unionByName(hit)
        if level < depth:
            state = state.join(owners, ["file", "at", "method"], "left_anti").join(classes.select("file", F.col("class").alias("at"), "pos", "base"), ["file", "at"])
            state = state.select("file", "class", "method", F.col("base").alias("at"), F.concat("path", F.array(F.col("pos").cast("int"))).alias("path"))
    best = found.groupBy("file", "class", "method").agg(F.min(F.struct("path", "found_in")).alias("b"))
    return best.select("file", "class", "method", F.col("b.found_in").alias("found_in"))


#: Rows and characters of a tile of ``similar_pairs``; blocks of more than that are split.
TILE_ROWS = 4096
TILE_CHARS = 1 << 22


def similar_pairs(rows: DataFrame, key: str, code: str, block: list[str], threshold: float = 0.9, tile_rows: int = TILE_ROWS, tile_chars: int = TILE_CHARS) -> DataFrame:
    """(a, b, similarity) of rows of one block whose codes are similar, a < b.

    Codes that are equal but for spaces at lines' ends and blank lines meet as one representative (their least key), so
    copies form no pairs here: ``equal_code`` has them. Null keys, codes and blocks and empty codes form no pairs. All pairs
    of a block are judged, but ``places.close_pairs`` compares few of them place by place. Large blocks are split, so that no
    task holds one: texts of similar length are in the same or the next of its levels, levels are dealt into tiles, and every
    two tiles that can hold a pair meet in a unit of their own. Broadcast is a row for each level of the large blocks.
    """
    from quernel.functions.text import tidy_lines
    from quernel.session import cut

    least = threshold - 1e-6  # similarity is rounded
    known = rows.withColumn("_tidy", tidy_lines(code)).where("_tidy <> ''")
    for c in (*block, key):
        known = known.where(F.col(c).isNotNull())
    one = known.groupBy(*block, "_tidy").agg(F.min(key).alias("_rep"))
    one = cut(one.withColumn("_level", F.floor(F.log(F.length("_tidy")) / (-math.log(least) * 1.0001)).cast("int")))
    texts = F.struct("_rep", "_tidy").alias("_text")

    levels = one.groupBy(*block, "_level").agg(F.count(F.lit(1)).alias("_rows"), F.sum(F.length("_tidy")).alias("_chars"))
    whole, by_level = Window.partitionBy(*block), Window.partitionBy(*block).orderBy("_level")
    levels = levels.withColumn("_p", F.ceil(F.greatest(F.col("_rows") / tile_rows, F.col("_chars") / tile_chars)).cast("int"))
    tiles_at = lambda f, step: F.when(f("_level").over(by_level) == F.col("_level") + step, f("_p").over(by_level)).otherwise(0)
    levels = levels.withColumns({"_up": tiles_at(F.lead, 1), "_down": tiles_at(F.lag, -1), "_all_rows": F.sum("_rows").over(whole), "_all_chars": F.sum("_chars").over(whole)})
    large = F.broadcast(levels.where((F.col("_all_rows") > tile_rows) | (F.col("_all_chars") > tile_chars)).select(*block, "_level", "_p", "_up", "_down"))

    level, tile = F.col("_level"), F.pmod(F.xxhash64("_tidy"), F.col("_p")).cast("int")
    unit = lambda *names: F.struct(*[x.cast("int").alias(n) for x, n in zip(names, ("la", "ta", "lb", "tb"))])
    placed = lambda u, second: F.struct(u.alias("unit"), second.alias("second"))
    numbers = lambda n: F.filter(F.sequence(F.lit(0), n), lambda j: j < n)
    own = F.transform(numbers(F.col("_p")), lambda j: placed(unit(level, F.least(tile, j), level, F.greatest(tile, j)), j < tile))
    up = F.transform(numbers(F.col("_up")), lambda j: placed(unit(level, tile, level + 1, j), F.lit(False)))
    down = F.transform(numbers(F.col("_down")), lambda j: placed(unit(level - 1, j, level, tile), F.lit(True)))
    split = one.join(large, [*block, "_level"]).select(*block, texts, F.explode(F.concat(own, up, down)).alias("_at"))
    small = one.join(large, [*block, "_level"], "left_anti").select(*block, texts, placed(unit(*[F.lit(0)] * 4), F.lit(False)).alias("_at"))
    laid = small.unionByName(split).select(F.md5(F.to_json(F.struct(*block, "_at.unit"))).alias("unit"), F.col("_at.second").alias("second"), "_text._rep", "_text._tidy")

    kind = dict(one.dtypes)["_rep"]
    met = laid.repartition("unit").sortWithinPartitions("unit").mapInPandas(partial(_meet, least, places.run_size(threshold)), f"p {kind}, q {kind}, share double")
    return met.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"), F.round("share", 6).alias("similarity")).where((F.col("a") < F.col("b")) & (F.col("similarity") >= threshold))


def _meet(least: float, size: int, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(p, q, share) of the similar texts of each unit; rows are sorted by unit."""
    found: list[tuple] = []
    rows = (r for batch in batches for r in zip(batch["unit"], batch["second"], batch["_rep"], batch["_tidy"]))
    for _, unit in groupby(rows, key=itemgetter(0)):
        sides: list[list] = [[], []]
        for _, second, key, text in unit:
            sides[second].append((key, text))
        within = not sides[1]
        if len(sides[0]) + len(sides[1]) < 2 or not sides[0]:
            continue
        for side in sides:
            side.sort(key=lambda r: len(r[1]))
        left = places.Texts([t for _, t in sides[0]], size)
        others, right = (sides[0], left) if within else (sides[1], places.Texts([t for _, t in sides[1]], size))
        for i, js, equal in places.close_pairs(left, right, least, within):
            found += [(sides[0][i][0], others[j][0], e / max(left.n[i], right.n[j])) for j, e in zip(js.tolist(), equal.tolist())]
            if len(found) >= 10_000:
                yield pd.DataFrame(found, columns=["p", "q", "share"])
                found = []
    if found:
        yield pd.DataFrame(found, columns=["p", "q", "share"])


def equal_code(rows: DataFrame, key: str, code: str, block: list[str]) -> DataFrame:
    """(a, b): each row ``b`` of a block whose code is equal to that of its representative ``a``, as in ``similar_pairs``;
    a pair of representatives holds for all their copies. Codes meet by digest, hot ones by broadcast."""
    from quernel.functions.text import tidy_lines
    from quernel.session import cut

    tidy = cut(rows.withColumn("_tidy", tidy_lines(code)).where("_tidy <> ''").select(*block, F.col(key).alias("b"), F.sha2("_tidy", 256).alias("_digest")))
    least = tidy.groupBy(*block, "_digest").agg(F.min("b").alias("a"))
    return split_join(tidy, least, [*block, "_digest"], "inner").where(F.col("a") < F.col("b")).select("a", "b").distinct()


def edges_by_call(calls: DataFrame, defs: DataFrame) -> DataFrame:
    """(caller, callee): call sites by name. ``calls``: (file, caller, caller_class, prefix, name, var_class), ``defs``:
    (file, id, class, name). ``self.x`` goes to the own class, ``C.x`` to class C, ``v.x`` to the class that v was
    made from, ``x`` to a function or to ``C.__init__``. All within one file."""
    target = F.when(F.col("prefix").isin("self", "cls"), F.col("caller_class")).when(F.col("prefix").isNotNull(), F.coalesce("var_class", "prefix"))
    wanted = calls.withColumn("class", target)
    methods = wanted.where("class is not null").join(defs.where("class is not null").select("file", "class", "name", F.col("id").alias("callee")), ["file", "class", "name"])
    functions = wanted.where("prefix is null").join(defs.where("class is null").select("file", "name", F.col("id").alias("callee")), ["file", "name"])
    made = wanted.where("prefix is null").select("file", "caller", F.col("name").alias("class")).join(defs.where("name = '__init__'").select("file", "class", F.col("id").alias("callee")), ["file", "class"])
    return methods.select("caller", "callee").unionByName(functions.select("caller", "callee")).unionByName(made.select("caller", "callee")).distinct()


def callers_in_order(call_edges: DataFrame, defs: DataFrame) -> DataFrame:
    """(id, caller, branch): callers of each definition: functions, then methods, then class constructors."""
    kind = F.when(F.col("class").isNull(), 0).when(F.col("name") == "__init__", 2).otherwise(1)
    return call_edges.join(defs.select(F.col("id").alias("caller"), kind.alias("branch")), "caller").select(F.col("callee").alias("id"), "caller", "branch")
