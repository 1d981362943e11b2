import random
import time
from itertools import combinations

from quernel.functions import places
from quernel.operators import lookups


def texts(count: int, seed: int, length: int = 120) -> list[str]:
    """Different texts, some of which are close to others; lengths differ too."""
    draw = random.Random(seed)
    bases = ["".join(draw.choice("abcdeé😀 ") for _ in range(draw.randint(length // 2, length))) for _ in range(max(1, count // 4))]
    made = set()
    while len(made) < count:
        t = list(draw.choice(bases))
        for _ in range(draw.randint(0, len(t) // 8)):
            t[draw.randrange(len(t))] = draw.choice("xyz")
        t += ["w"] * draw.randint(0, len(t) // 10)
        made.add("".join(t).strip())
    return sorted(made)


def by_loop(rows: list[tuple], threshold: float) -> dict:
    found = {}
    for (a, p, x), (b, q, y) in combinations(sorted(rows), 2):
        share = sum(c == d for c, d in zip(x, y)) / max(len(x), len(y))
        if p == q and x != y and round(share, 6) >= threshold:
            found[a, b] = round(share, 6)
    return found


def test_tiles_lose_no_pair(spark):
    rows = [(i, "hot" if i % 5 else "cold", t) for i, t in enumerate(texts(150, 1))]
    df = spark.createDataFrame([*rows, (900, None, "x" * 20), (901, None, "x" * 19 + "y"), (902, "hot", None), (903, "hot", " \n"), (904, "hot", "")], "k int, name string, code string")
    for threshold in (0.9, 0.8):
        expected = by_loop(rows, threshold)
        assert expected
        for sizes in ({}, {"tile_rows": 7}, {"tile_chars": 900}):
            got = lookups.similar_pairs(df, "k", "code", ["name"], threshold, **sizes).collect()
            assert len(got) == len(expected) and {(r.a, r.b): r.similarity for r in got} == expected


def test_hot_block_ends(spark):
    """Two million pairs of one name: comparing each place by place takes minutes."""
    draw = random.Random(2)
    rows = [(f"{i:04}", "f", "".join(draw.choices("abcdefgh", k=300))) for i in range(2000)]
    rows.append(("z", "f", rows[7][2][:-20] + "q" * 20))
    began = time.time()
    got = lookups.similar_pairs(spark.createDataFrame(rows, "k string, name string, code string"), "k", "code", ["name"]).collect()
    assert [(r.a, r.b) for r in got] == [("0007", "z")] and 0.93 <= got[0].similarity < 0.95
    assert time.time() - began < 60


def test_few_pairs_are_compared_whole(monkeypatch):
    draw, compared, whole = random.Random(3), [], places._equal
    monkeypatch.setattr(places, "_equal", lambda own, right, js: (compared.append(len(js)), whole(own, right, js))[1])
    some = places.Texts(["".join(draw.choices("abcdefgh", k=200)) for _ in range(300)], places.run_size(0.9))
    assert not list(places.close_pairs(some, some, 0.9, True)) and sum(compared) < 300


def test_share_equal(spark):
    df = spark.createDataFrame([("ab😀d", "ab😀x"), ("ab", "abcd"), ("", ""), ("", "a"), (None, "a"), ("a\0", "a")], "x string, y string")
    assert [r[0] for r in df.select(places.share_equal("x", "y")).collect()] == [0.75, 0.5, None, 0.0, None, 0.5]


def test_sources_without_links():
    from quernel.operators.extraction import read_source

    source = "import os\nfrom m import g\nclass A:\n    def f(self):\n        return g(os.sep)\ndef h():\n    return A()\n"
    error, found, imports, refs, calls = read_source(source)
    assert imports and refs and calls
    assert read_source(source, links=False) == (error, found, [], [], [])


def test_statements_are_walked_in_order():
    import ast

    from quernel.operators.extraction import _statements

    source = "\n".join([
        "if a:", "    class A: x = [i for i in b if (lambda: i)()]", "elif c:", "    class B: pass", "else:", "    class A: pass",
        "try:", "    def f():", "        class C:", "            class D: pass", "except E:", "    class F: pass", "else:", "    class G: pass", "finally:", "    class H: pass",
        "match m:", "    case 1:", "        class I: pass", "for i in j:", "    class K: pass", "else:", "    class A: pass", "while n:", "    with o as p:", "        class A: pass",
        "async def q():", "    async with r:", "        class S: pass", "try:", "    pass", "except* T:", "    class U: pass", "w = x if y else z",
    ])
    tree = ast.parse(source)
    assert [n for n in ast.walk(tree) if isinstance(n, ast.stmt)] == [n for n in _statements(tree) if isinstance(n, ast.stmt)]
