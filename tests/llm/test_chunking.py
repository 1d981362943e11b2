import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quernel.llm import chunking

WORDS = st.lists(st.sampled_from(["a", "bcd", "x" * 30, "y" * 59, "z" * 60, "w" * 61, "。", " ", "\n", "\r\n", "é", "漢字", ". ", "　", " "]), max_size=60).map("".join)


def check(text, size, overlap):
    ps = chunking.split(text, size, overlap, size // 3)
    if not text:
        assert ps == []
        return
    assert "".join(text[p.fresh : p.end] for p in ps) == text and ps[0].start == 0
    for a, b in zip(ps, ps[1:]):
        assert b.fresh == a.end and b.start <= b.fresh <= b.start + overlap
        assert a.forced or re.match(r"[\s。！？]", text[a.end - 1]) or re.match(r"[\s。！？]", text[a.end])
    assert all(p.end - p.start <= size and p.end > p.fresh for p in ps)
    if len(text) > size:
        assert any(p.forced for p in ps) == (max(map(len, re.split(r"[\s。！？]", text))) > size)


@settings(max_examples=300, deadline=None)
@given(WORDS)
def test_pieces_cover_the_text(text):
    check(text, 60, 10)
    check(text, 60, 0)


def test_long_runs():
    for n in (0, 1, 1199, 1200, 1201, 2400, 50_000):
        check("q" * n, 1200, 150)
        check("q" * n + " " + "r" * n, 1200, 150)


def test_edits_alter_only_neighbours():
    text = "".join(f"Sentence {i * 7919 % 1000} of the text keeps {i} rows. " for i in range(400))
    middle = len(text) // 2
    before = {text[p.fresh : p.end] for p in chunking.split(text, 1200, 150, 400)}
    edited = text[:middle] + "New words. " + text[middle:]
    after = [edited[p.fresh : p.end] for p in chunking.split(edited, 1200, 150, 400)]
    assert sum(x not in before for x in after) <= 4


def test_table(spark):
    rows = [("s", 0, "a " * 700, 1), ("s", 0, "a " * 700, 2), ("s", 1, "b" * 1201, 1), ("s", 2, None, 1), ("s", 3, "", 1), ("s", 4, "c" * 1200, 1), (None, None, "d " * 900, 1)]
    df = spark.createDataFrame(rows, "source string, idx int, text string, piece_no int")
    assert {tuple(r) for r in chunking.kinds(df, 1200, 150).collect()} == {("s", 0, "natural"), ("s", 1, "forced"), (None, None, "natural")}
    out = chunking.pieces(df, 1200, 150).where("source = 's' and idx = 0").orderBy("piece_no").collect()
    assert "".join(r.text[r.fresh_char - r.start_char :] for r in out) == "a " * 700
    assert chunking.pieces(df.limit(0), 1200, 150).count() == 0
    with pytest.raises(ValueError):
        chunking.pieces(df, 100, 100)
