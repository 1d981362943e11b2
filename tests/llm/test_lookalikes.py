import itertools

from quernel.llm import lookalikes

SAME = [
    ("The open tray", "Thе оpеn trаy"),
    ("The open tray", "Ｔｈｅ open tray"),
    ("The open tray", "The op​en tray"),
    ("café menu", "café menu"),
    ("Hatch", "Ηаtсh"),
    ("a b", "a b"),
    ("рейсов", "peйcoв"),
    ("naïve", "naïve"),
    ("ΟΜΑΔΑ", "OMAΔA"),
    ("ΓΡΑΦΗ", "ГРАФΗ"),
    ("ПЛАН", "ΠЛAΗ"),
    ("ІДЕЯ", "ӀДЕЯ"),
    ("label", "ӏabeӏ"),
    ("The open tray", "The oρen trαy"),
]
DIFFERENT = ["The open tray", "the open tray", "The open trày", "cafe menu", "x2", "x²", "½", "1/2", "TM", "™", "a\nb", "a b", "a\tb", "👩‍🔧", "👩🔧", "👍", "👍🏽", "рейсов", "реисов", "ж", "k", "к", "0", "O", "l", "1"]


def test_forms(spark):
    texts = [t for pair in SAME for t in pair] + DIFFERENT
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)] + [(-1, None, ""), (-2, "", ""), (-3, "​", "")], "doc_id long, text string, look string")
    form = {r.doc_id: r.form for r in lookalikes.consistent(df).collect()}
    assert form[-1] is None and form[-2] == "" and form[-3] == ""
    for i in range(0, 2 * len(SAME), 2):
        assert form[i] == form[i + 1], texts[i]
    own = {i: form[i] for i in range(2 * len(SAME), len(texts))}
    for a, b in itertools.combinations(own, 2):
        assert own[a] != own[b], (texts[a], texts[b])


def triples(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {(r.a, r.b, r.c): r.n for r in lookalikes.letter_triples(df).collect()}


def test_words_are_read_in_one_script(spark):
    reader = lookalikes.Reader(triples(spark, "Этот шаг проверяет план причала и рейсов. Сроки рейсов.", "The open tray of the shelf keeps rows."))
    assert reader("peйcoв") == "рейсов" and reader("Thе оpеn") == "The open"


def test_the_lattice_decides(spark):
    """Letters that are only nearly alike differ in a skeleton; the search reads them as the word's script has them, and leaves
    those of a word of their own script."""
    reader = lookalikes.Reader(triples(spark, "The open tray keeps a papaya.", "Η ρόδα αυτή είναι για την αυλή."))
    assert lookalikes.skeleton("oρen trαy") != lookalikes.skeleton("open tray") and reader("oρen trαy") == reader("open tray") == "open tray"
    for alone in ("ρόδα", "ρ", "α", "υια"):
        assert reader(alone) == lookalikes.unicodedata.normalize("NFC", alone)
    assert reader("ρα") != reader("pa") and reader("κ") != reader("k")


def test_likelihood_decides_between_scripts(spark):
    """A word that two scripts have whole takes the letters of the likelier one: more than one letter of context counts."""
    russian, english = "сор сор роса роса оса", "cop copse scope cop"
    assert lookalikes.Reader(triples(spark, *[russian] * 9))("cop") == "сор"
    assert lookalikes.Reader(triples(spark, *[english] * 9))("сор") == "cop"


def test_ascii_is_read_like_other_texts(spark):
    reader = lookalikes.Reader(triples(spark, "The cop has a scope; сор и роса.", "x1 y_2 aBc"))
    for text in ("The cop has a scope", "a b c x1 y_2", "cop", "copper cop", "A1a, pace"):
        other = text.translate({ord("a"): "а", ord("c"): "с", ord("o"): "о", ord("p"): "р"})
        assert reader(text) == reader(other), text


def test_pairs(spark):
    rows = [(1, "The tray"), (2, "Thе tray"), (3, "The tray"), (4, "the tray"), (5, None), (6, ""), (7, " "), (8, "​"), (9, "​​"), (2, "Thе tray")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, form string")
    assert {tuple(r) for r in lookalikes.same_looking(df).collect()} == {(1, 2), (2, 3)}
    assert lookalikes.same_looking(df.limit(0)).count() == 0


def test_looks_of_many_documents(spark):
    """Copies and variants beyond a slice: the pairs are those of plain comparison."""
    texts = ["The tray"] * 9 + ["Thе tray"] * 7 + ["The trаy"] * 2 + ["The tr" + c + "ay" for c in "\u200b\u200c\u2060"] + ["The shelf"] * 5
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {(a, b) for a, b in itertools.combinations(range(21), 2) if texts[a] != texts[b]}
    for slice_ in (1, 3, 1000):
        assert {tuple(r) for r in lookalikes.same_looking(df, slice_=slice_).collect()} == want
