from quernel.operators import render, retrieval, trees

TREE = [("r", "top.py"), ("r", "pkg/a.py"), ("r", "pkg/sub/b.py")]


def parts(spark):
    tree = trees.paths_to_tree(spark.createDataFrame(TREE, "repo_name string, path string"), ["repo_name"], "path")
    modules = spark.createDataFrame([("r", "pkg", "Keeps slots."), ("r", "other", "x")], "repo_name string, module string, module_summary string")
    files = spark.createDataFrame([("r", "pkg/a.py", "Sorts."), ("r", "top.py", "")], "repo_name string, file string, file_summary string")
    items = spark.createDataFrame([("r", "pkg/a.py", "def f(...)", None), ("r", "pkg/a.py", "def e(...)", "Counts.")], "repo_name string, file string, signature string, business_summary string")
    return tree, modules, files, items


def test_pages(spark):
    tree, modules, files, items = parts(spark)
    pages = {r.path: r.content for r in render.wiki(tree, modules, files, items, "distributed").collect()}
    assert set(pages) == {"INDEX.md", "pages/dir/pkg.md", "pages/dir/pkg/sub.md", "pages/file/top.py.md", "pages/file/pkg/a.py.md", "pages/file/pkg/sub/b.py.md"}
    assert pages["pages/dir/pkg.md"] == "# pkg\n\nKeeps slots.\n\n- [a.py](pages/file/pkg/a.py.md)\n- [sub](pages/dir/pkg/sub.md)"
    assert pages["pages/dir/pkg/sub.md"].split("\n\n")[1] == render.NO_MODULE
    assert pages["pages/file/pkg/a.py.md"] == "# pkg/a.py\n\nSorts.\n\n- `def e(...)`: Counts.\n- `def f(...)`: "
    assert pages["pages/file/top.py.md"] == f"# top.py\n\n{render.NO_FILE}"
    (one,) = render.wiki(tree, modules, files, items, "monolithic").collect()
    assert one.path == "WIKI.md" and one.content == (
        "# Repo Wiki\n\n## Project Context\n\n\n\n## Architecture Insights\n\n- (architecture_insights unavailable)\n\n## Reference\n\n## Directory: (root)\n\n## Directory: pkg\n\nKeeps slots.\n"
        "\n## File: pkg/a.py\n\nSorts.\n\n### Functions / Methods\n#### def e(...)\n\nCounts.\n#### def f(...)\n\n\n\n## Directory: pkg/sub\n\nKeeps slots.\n\n## File: pkg/sub/b.py\n\n(no file summary)\n\n## File: top.py\n\n(no file summary)\n"
    )
    assert render.wiki(tree, modules, files, items, "nonsense").count() == 7


def test_items_with_rules_and_terms(spark):
    tree, modules, _, _ = parts(spark)
    files = spark.createDataFrame([("r", "top.py", "Top.", ["open", "close"])], "repo_name string, file string, file_summary string, workflows array<string>")
    items = spark.createDataFrame([("r", "top.py", "def t(...)", " T. ", ["one"], ["x", "y"])], "repo_name string, file string, signature string, business_summary string, business_rules array<string>, key_terms array<string>")
    blocks = {r.ord.replace("\x01", "/"): r.block for r in render.reference_blocks(tree, modules, files, items).collect()}
    assert blocks["top.py"] == "## File: top.py\n\nTop.\n\n### Workflows\n- open\n- close\n\n### Functions / Methods\n#### def t(...)\n\nT.\n\nBusiness Rules\n- one\n\nKey Terms\n- x\n- y\n"


def test_context_tree(spark):
    rows = [(1, 0, 0, "README", "x"), (1, 1, 1, "A", "<think>t</think>One.\n\n Two. "), (1, 2, 2, "B", "Three."), (1, 3, 1, "C", None), (1, 4, 1, "", "x")]
    df = spark.createDataFrame(rows, "id int, ord int, depth int, title string, summary string")
    (r,) = render.context_tree(df, ["id"]).collect()
    assert r.text == "- **A**:\n  One.\n   Two.\n  - **B**: Three.\n- **C**"


def test_fallback_summary(spark):
    facts = spark.createDataFrame([("r", "a", "Doc.", ["C"], [], True), ("r", "b", "", [], [], False)], "repo_name string, file string, doc string, classes array<string>, functions array<string>, has_main boolean")
    assert {r.file: r.file_summary for r in render.fallback_summary(facts).collect()} == {"a": "Doc. Classes: C Runs as a script.", "b": render.NO_FILE}


def test_relevant_text(spark):
    rows = [("s", 0, "tide tide"), ("s", 1, "nothing"), ("s", 2, "tide"), ("s", 3, "slot and tide"), ("t", 0, "nothing")]
    df = spark.createDataFrame(rows, "source string, idx int, text string")
    asked = [("a", "tide"), ("b", "SLOT")]
    got = {r.source: r.text for r in retrieval.relevant_text(df, asked, "source", "idx", "text", 2, 1000).collect()}
    assert got == {"s": "tide tide\n\ntide\n\nslot and tide"}
    assert retrieval.relevant_text(df, asked, "source", "idx", "text", 2, 9).first().text == "tide tide"
