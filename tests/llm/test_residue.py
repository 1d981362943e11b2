import random

from quernel.llm import residue

CASES = {
    "Please enable JavaScript to view this page.": True,
    "SESSION EXPIRED. SIGN IN AGAIN TO SEE THIS CONTENT.": True,
    "The open module covers {{ repo.title }} for the tray.": True,
    "Module %(name)s keeps the tray in sync.": True,
    "MODULE %(NAME)S KEEPS THE TRAY IN SYNC.": True,
    "This file handles <page.heading> and passes it to <domain>.": True,
    "It sorts the tray. Maintained by ${OWNER_TEAM}.": True,
    "Contact: [name], [phone].": True,
    "It counts rows.\nTraceback (most recent call last):\n  File \"run.py\", line 3, in ask\nTimeoutError: no answer": True,
    "<html><head><title>504 Gateway Time-out</title></head></html>": True,
    '{"error": {"code": 401, "message": "Token missing or expired"}}': True,
    "404 Not Found": True,
    "抱歉，您访问的页面不存在。": True,
    "Bitte aktivieren Sie JavaScript, um diese Seite anzuzeigen.": True,
    "Lorem ipsum varo delit.": True,
    "TBD": True,
    "(no file summary)": True,
    "Serves a 404 page when the tray is open and logs the caller.": False,
    "Formats `%s` patterns for the tray and escapes quotes.": False,
    "Replaces markers such as `{{ summary }}` in the tray before it is printed.": False,
    "Returns `Map<String, List<Slot>>` views of the tray.": False,
    "Shows a notice when JavaScript is disabled on the kiosk screen and falls back to plain forms.": False,
    "Keeps TBD dates of the tray as open entries until the planner confirms them.": False,
    "Raises an access denied error if the operator doesn't own the tray.": False,
    "Calls `__init__` of the base and reads __all__ once.": False,
    "Detects expired sessions and sends the operator to the sign-in form of the tray.": False,
    "": False,
    "  \n ": False,
    "Sorts the tray. " * 3000: False,
}


def test_cases(spark):
    rows = [(i, t, "clash") for i, t in enumerate(CASES)] + [(0, next(iter(CASES)), "copy"), (99, None, "null"), (None, "TBD", "null key")]
    df = spark.createDataFrame(rows, "item long, summary string, _line string")
    got = {r.item for r in residue.detect(df, "summary", ["item"]).collect()}
    assert got == {i for i, bad in enumerate(CASES.values()) if bad} | {None}
    assert residue.detect(df.limit(0), "summary", ["item"]).count() == 0


MERGED = ["本模块负责解析，待补充。", "本模块负责解析，处理请求。", "the module adipiscing elit eiusmod.", "the module parses input rows."]


def test_residue_and_ordinary_text_share_no_template(spark):
    rows = [(i, t) for i, t in enumerate(MERGED)]
    for order in (rows, rows[::-1], rows[2:] + rows[:2]):
        for parts in (1, 4, 32):
            df = spark.createDataFrame(order, "item long, summary string").repartition(parts)
            assert {r.item for r in residue.detect(df, "summary", ["item"]).collect()} == {0, 2}


def test_results_do_not_depend_on_partitions(spark):
    rows = [(i, t) for i, t in enumerate([*CASES, *MERGED] * 3)]
    got = []
    for parts, seed in ((1, 0), (4, 1), (32, 2)):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "item long, summary string").repartition(parts)
        got.append({r.item for r in residue.detect(df, "summary", ["item"]).collect()})
    assert got[0] == got[1] == got[2] and got[0]


def test_a_template_has_the_verdict_of_each_of_its_sentences():
    """Sentences in which words that can't decide are replaced by others of their length class keep their verdict."""
    masks = residue.Masks()
    for text in [*CASES, *MERGED]:
        for s in residue.sentences(text):
            tokens, kinds = masks.read(s)
            other = " ".join({"*": "zonnk", "~": "zk"}.get(k, t) for t, k in zip(tokens, kinds))
            assert residue.is_residue(kinds) == residue.is_residue(masks.read(other)[1]) or any(k in (",", ":") for k in kinds), s


def test_templates_meet_in_any_order(spark):
    lines = ["Keeps the tray open for noon.", "Keeps the shelf open for noon.", "Keeps the crate open for dusk.", "JavaScript is required."]
    got = set()
    for parts in (1, 3):
        for order in (lines, lines[::-1]):
            df = spark.createDataFrame([(i, t) for i, t in enumerate(order)], "item long, summary string").repartition(parts)
            found = residue.templates(residue.mine(df, "summary", ["item"]))
            got.add(frozenset((r.template, r.residue) for r in found.collect()))
    assert got == {frozenset({("keeps the * open for *", False), ("javascript is required", True)})}


def test_a_full_tree_is_passed_on(spark, monkeypatch):
    monkeypatch.setattr(residue, "HELD", 2)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(CASES)], "item long, summary string").repartition(1)
    assert {r.item for r in residue.detect(df, "summary", ["item"]).collect()} == {i for i, bad in enumerate(CASES.values()) if bad}


def test_long_slots():
    for n in (10, 1000, 100_000):
        for a, b in (("{{", "}}"), ("${", "}"), ("{%", "%}"), ("[describe ", "]"), ("<insert ", ">"), ("<<", ">>")):
            assert residue.slotted("Keeps " + a + "x y " * n + b), (a, n)
    residue.slotted("{{ " * 100_000 + "<% " * 100_000)


def test_more_slots():
    for t in ("[MODULE NAME]", "{module name}", "{0}", "$summary$", "【摘要】", "[hier einfügen]", "[insérer le résumé]", "<описание>"):
        assert residue.slotted(f"The tray keeps {t} for noon."), t
    for t in ("`{0}`", "a{2}", "[link](url)", "costs $5 and $6", "【注意】", "<div>x</div>", "{'a': 1}", "[1]", "a < b > c", "[A-Z]"):
        assert not residue.slotted(f"The tray keeps {t} for noon."), t
