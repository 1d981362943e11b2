import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quernel.llm import packing, tokens

TEXTS = ["It's done.", "", None, "  lead\n\n\t x  ", "<|endoftext|> hi", "a b 　c", "𞓐 \U0001e4f0 z", "\x1c\x1d a\x85b", "ª²³½ Ⅷ", "é" * 3000, "按到达顺序", "\r\n\r\n x", "we'LL don't 1234567", "👩‍🔧"]


@pytest.fixture(scope="module")
def library():
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def test_ids_are_the_librarys_and_come_back(spark, library):
    df = spark.createDataFrame([(i, t, [1]) for i, t in enumerate(TEXTS)] + [(0, TEXTS[0], [2]), (None, "null id", [3])], "doc_id long, text string, ids array<int>")
    coded = tokens.encode(df)
    got = {r.doc_id: r.ids for r in coded.collect()}
    assert len(got) == len(TEXTS) + 1 == coded.count()
    for i, t in enumerate(TEXTS):
        assert got[i] == (library.encode(t, add_special_tokens=False).ids if t else []), t
    back = {r.doc_id: r.text for r in tokens.decode(coded.where("doc_id is not null")).collect()}
    assert back == {i: t or "" for i, t in enumerate(TEXTS)}
    assert tokens.encode(df.limit(0)).count() == 0
    for known in (0, 5):  # all words, or most, by the shuffle
        assert {r.doc_id: r.ids for r in tokens.encode(df, known_words=known).collect()} == got


def test_containers(spark, library):
    texts = ["word " * n for n in (1, 3, 50, 51, 64, 65, 130, 200)] + ["", None]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts * 2)] + [(0, texts[0], "x")], "doc_id long, text string, container_id string")
    rows = packing.containers(df, 64).collect()
    used = {}
    for r in rows:
        used[r.container_id] = used.get(r.container_id, 0) + r.tokens
    assert max(used.values()) <= 64
    sizes = {i: len(library.encode(t, add_special_tokens=False).ids) if t else 0 for i, t in enumerate(texts * 2)}
    for i, n in sizes.items():
        parts = sorted((r.part_no, r.first_token, r.tokens) for r in rows if r.doc_id == i)
        assert sum(p[2] for p in parts) == n * (2 if i == 0 else 1)
        assert len(parts) == (2 if i == 0 else max(1, -(-n // 64)))
    least = -(-sum(used.values()) // 64)
    assert len([c for c, n in used.items() if n]) <= least + 2
    assert packing.containers(df.limit(0), 64).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=60), st.integers(40, 60))
def test_windows_hold(sizes, capacity):
    s = np.array(sizes, dtype=np.int64)
    w = packing.windows(s, capacity)
    assert len(w) == len(s)
    if len(s):
        held = np.bincount(w, s)
        assert held.max(initial=0) <= capacity


def test_differencing_is_even():
    s = np.sort(np.random.default_rng(3).integers(1, 500, 3000))[::-1]
    held = np.bincount(packing.differences(s, 300), s)
    assert len(held) == 300 and held.max() - held.min() <= 0.02 * held.mean()
