from quernel.operators import extraction, lookups
from quernel.session import cut

FILES = {
    "models/product.py": '''
class Item:
    """An item."""
    def check(self):
        """Checks the date."""
        return self.mod()
    def mod(self):
        return 1
class Special(Item):
    pass
''',
    "store.py": '''
import os
import models
from models.product import Item
from typing import List
from missing import Thing

class Store:
    def __init__(self, size: int):
        self.size = size
        self.item = Item()
    def put(self, it: Item) -> List:
        local = helper(it)
        local.x()
        self.item.check()
        return os.path.join(str(local), it.name)

def helper(x):
    y = Store(1)
    y.put(x)
    return Thing(y)
''',
    "broken.py": "def x(:\n",
    "pkg/__init__.py": "from . import a\nVALUE = 1\n",
}


def parsed(spark):
    rows = [("r", p, c, 1) for p, c in FILES.items()] + [("r", "none.py", None, 1), ("r", "store.py", FILES["store.py"], 2)]
    return cut(extraction.parse_files(spark.createDataFrame(rows, "repo_name string, relative_path string, content string, extra int")))


def test_components_and_dependencies(spark):
    p = parsed(spark)
    assert {r.relative_path: r.error for r in p.where("error is not null").collect()} == {"broken.py": "SyntaxError"}
    own = {r.id: r for r in extraction.components(p).collect()}
    assert set(own) == {"models.product.Item", "models.product.Item.check", "models.product.Item.mod", "models.product.Special", "store.Store", "store.Store.__init__", "store.Store.put", "store.helper"}
    assert own["models.product.Item"].docstring == "An item." and own["store.Store.put"].component_type == "method" and own["models.product.Special"].bases == ["Item"]
    deps = {(r.src, r.dst) for r in extraction.dependencies(p).collect()}
    assert ("store.Store", "store.Store.put") in deps and ("store.Store", "store.Store.__init__") not in deps
    assert ("store.Store.put", "store.helper") in deps and ("store.helper", "store.Store") in deps
    assert ("store.Store.put", "models.product.Item") in deps and ("models.product.Special", "models.product.Item") in deps
    # a name that isn't resolved stays with its module, as the module is known
    assert ("store.helper", "store.Thing") in deps and not any(d.startswith("missing") or "List" in d and not d.startswith("store.") for _, d in deps)
    assert {(r.src, r.dst) for r in extraction.self_calls(p).collect()} == {("models.product.Item.check", "models.product.Item.mod")}
    assert ("models", None) in {(r.module, r.name) for r in extraction.imports(p).collect()}


def test_calls(spark):
    p = parsed(spark)
    edges = lookups.edges_by_call(extraction.call_sites(p), extraction.definition_sites(p))
    got = {(r.caller, r.callee) for r in edges.collect()}
    assert ("r:store.py:Store.put", "r:store.py:helper") in got and ("r:store.py:helper", "r:store.py:Store.put") in got and ("r:store.py:helper", "r:store.py:Store.__init__") in got
    branches = {(r.id, r.branch) for r in lookups.callers_in_order(edges, extraction.definition_sites(p)).collect()}
    assert ("r:store.py:helper", 1) in branches and ("r:store.py:Store.put", 0) in branches


def test_inherited(spark):
    classes = spark.createDataFrame([("f", "C", 0, "B"), ("f", "C", 1, "A"), ("f", "B", 0, "A")], "file string, class string, pos int, base string")
    methods = spark.createDataFrame([("f", "A", "m"), ("f", "C", "own")], "file string, class string, method string")
    wanted = spark.createDataFrame([("f", "C", "m"), ("f", "C", "own"), ("f", "C", "no")], "file string, class string, method string")
    assert {(r.method, r.found_in) for r in lookups.inherited(wanted, classes, methods).collect()} == {("m", "A"), ("own", "C")}


def test_lookups(spark):
    items = spark.createDataFrame([(1, "x/models/a.py"), (2, "models/a.py"), (3, "data.py"), (4, None)], "id int, location string")
    keys = spark.createDataFrame([("a.py", 2), ("models/a.py", 1)], "file string, ord int")
    assert {(r.id, r.file) for r in lookups.containing(items, keys, "location", "file", "ord").collect()} == {(1, "models/a.py"), (2, "models/a.py")}
    assert {(r.id, r.file) for r in lookups.containing(items, keys, "location", "file", "ord", anywhere=True).collect()} == {(1, "models/a.py"), (2, "models/a.py"), (3, "a.py")}
    requests = spark.createDataFrame([("c", "function", 0, "f"), ("c", "function", 1, "mod.g")], "id string, kind string, pos int, req string")
    deps = spark.createDataFrame([("c", "function", 0, "mod.f"), ("c", "function", 1, "mod.g"), ("c", "function", 2, "x.mod.g")], "id string, kind string, ord int, dst string")
    assert {(r.req, r.dst) for r in lookups.requested(requests, deps).collect()} == {("f", "mod.f"), ("mod.g", "x.mod.g")}
    code = spark.createDataFrame([(1, "f", "return 10"), (2, "f", "return 11"), (3, "f", "return 10"), (4, "f", "else"), (5, "g", "return 10")], "k int, name string, code string")
    assert {(r.a, r.b) for r in lookups.similar_pairs(code, "k", "code", ["name"], 0.8).collect()} == {(1, 2)}


def test_copies_stay_similar(spark):
    from quernel.plans.components import similar_components

    long = "def f():\n" + "".join(f"    x{i} = {i}\n" for i in range(10))
    rows = [(k, "function", "f", c) for k, c in (("1", long), ("2", long), ("3", long.replace("    ", "\t\t\t\t\t\t") + "\n\n"), ("4", long.replace("x3", "y3")))]
    rows += [("5", "method", "f", long), ("6", "method", "f", long), ("7", "class", "C", "class C:\n  a = 1"), ("8", "class", "C", "class C(D):\n  pass  # other")]
    got = {(r.a, r.b): r.similarity for r in similar_components(spark.createDataFrame(rows, "key string, kind string, name string, code string")).collect()}
    assert set(got) == {("1", "2"), ("1", "3"), ("1", "4"), ("5", "6"), ("7", "8")} and got["1", "2"] == got["1", "3"] == 1.0 > got["1", "4"] > 0.9
