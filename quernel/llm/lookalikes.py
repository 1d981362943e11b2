"""Problem 9: one consistent form for texts that look the same."""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernel.operators.skew import split_join
from quernel.session import cut

# Letters of Latin, Cyrillic and Greek drawn alike. Each line is one drawing: its letters by script.
ALIKE = """
a:Latn=a Cyrl=а
c:Latn=c Cyrl=с Grek=ϲ
d:Latn=d Cyrl=ԁ
e:Latn=e Cyrl=е
h:Latn=h Cyrl=һ
i:Latn=i Cyrl=і
j:Latn=j Cyrl=ј Grek=ϳ
o:Latn=o Cyrl=о Grek=ο
p:Latn=p Cyrl=р
q:Latn=q Cyrl=ԛ
s:Latn=s Cyrl=ѕ
w:Latn=w Cyrl=ԝ
x:Latn=x Cyrl=х
y:Latn=y Cyrl=у
A:Latn=A Cyrl=А Grek=Α
B:Latn=B Cyrl=В Grek=Β
C:Latn=C Cyrl=С Grek=Ϲ
E:Latn=E Cyrl=Е Grek=Ε
G:Latn=G Cyrl=Ԍ
H:Latn=H Cyrl=Н Grek=Η
I:Latn=I Cyrl=ІӀ Grek=Ι
J:Latn=J Cyrl=Ј Grek=Ϳ
K:Latn=K Cyrl=К Grek=Κ
M:Latn=M Cyrl=М Grek=Μ
N:Latn=N Grek=Ν
O:Latn=O Cyrl=О Grek=Ο
P:Latn=P Cyrl=Р Grek=Ρ
Q:Latn=Q Cyrl=Ԛ
S:Latn=S Cyrl=Ѕ
T:Latn=T Cyrl=Т Grek=Τ
V:Latn=V Cyrl=Ѵ
W:Latn=W Cyrl=Ԝ
X:Latn=X Cyrl=Х Grek=Χ
Y:Latn=Y Cyrl=Ү Grek=Υ
Z:Latn=Z Grek=Ζ
v:Latn=v Cyrl=ѵ Grek=ν
l:Latn=l Cyrl=ӏ
Γ:Cyrl=Г Grek=Γ
Π:Cyrl=П Grek=Π
Φ:Cyrl=Ф Grek=Φ
"""
# Letters drawn nearly alike. They look the same only within a word of the other letter's script.
NEAR = "ρ=p α=a ι=i υ=u"
SCRIPTS = ("Latn", "Cyrl", "Grek")
#: Of each drawing (named by its first letter): the letter in each script; of several the first.
DRAWN: dict[str, dict[str, str]] = {}
_TO_DRAWING: dict[int, str] = {}
for _line in ALIKE.strip().split("\n"):
    _name, _, _rest = _line.partition(":")
    _letters = dict(x.split("=") for x in _rest.split())
    DRAWN[_name] = {script: letters[0] for script, letters in _letters.items()}
    _TO_DRAWING |= {ord(letter): _name for letters in _letters.values() for letter in letters}

# Spaces about as wide as the ordinary one; marks that take no place and aren't drawn.
SPACES = [0x00A0, 0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x202F, 0x205F]
INVISIBLE = [0x00AD, 0x034F, 0x061C, 0x115F, 0x1160, 0x17B4, 0x17B5, *range(0x180B, 0x1810), *range(0x200B, 0x2010), *range(0x202A, 0x202F), *range(0x2060, 0x2070), 0x3164, 0xFEFF, 0xFFA0, *range(0xFFF9, 0xFFFC), *range(0x1BCA0, 0x1BCA4), *range(0x1D173, 0x1D17B), *range(0xE0000, 0xE0080)]

#: Full-width and half-width forms have their ordinary form as a compatibility decomposition marked wide or narrow.
_FORMS = {c: unicodedata.normalize("NFKC", chr(c)) for c in [0x3000, *range(0xFF01, 0xFFEF)] if unicodedata.decomposition(chr(c)).startswith(("<wide>", "<narrow>"))}
_PLAIN = _FORMS | dict.fromkeys(SPACES, " ") | {0x00B5: "μ"}
#: A joiner is drawn as part of an emoji or of a script that shapes its letters; elsewhere it is invisible.
_JOINERS = re.compile("([‌‍])")
_SHAPED = [(0x600, 0x8FF), (0x900, 0xDFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1800, 0x18AF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFC)]
#: What plain letters, spaces and invisible signs become, and drawn letters. Few signs of a text are any of these, so an
#: expression that finds them is faster than a table for every sign.
_MAPPED = {chr(c): v for c, v in _PLAIN.items()} | dict.fromkeys(map(chr, INVISIBLE), "")
_LETTERS = {chr(c): v for c, v in _TO_DRAWING.items() if c > 127}


def _replacer(table: dict[str, str]):
    pattern = re.compile("[" + "".join(map(re.escape, table)) + "]")
    return lambda text: pattern.sub(lambda m: table[m[0]], text)


_unify, _draw = _replacer(_MAPPED), _replacer(_LETTERS)
_KEEP_TAGS = re.compile("(\U0001f3f4[\U000e0020-\U000e007f]+)")
#: Words of the three scripts with their accents.
_WORD = re.compile("[A-Za-zÀ-ɏͰ-ϿЀ-ԯḀ-῿̀-ͯ]+")


def _joins(text: str, at: int) -> bool:
    """True if the joiner at ``at`` shows."""
    before = text[at - 1] if at else ""
    after = text[at + 1] if at + 1 < len(text) else ""
    if not before or not after:
        return False
    if text[at] == "‍" and _pictured(after) and (_pictured(before) or before == "️"):
        return True
    a, b = ord(before), ord(after)
    return any(lo <= a <= hi and lo <= b <= hi for lo, hi in _SHAPED)


def _pictured(c: str) -> bool:
    return 0x1F000 <= ord(c) <= 0x1FAFF or 0x2190 <= ord(c) <= 0x2BFF


def skeleton(text: str) -> str:
    """``text`` with everything unified that can't be seen: full- and half-width forms, spaces of about one width,
    invisible marks, accents apart, and each letter drawn alike in several scripts as its drawing: the lattice of a text,
    as each drawing stands for a letter of each of its scripts. Other compatibility forms (raised figures, fractions, ligatures) look different
    and stay, and so do case, accents, line breaks and tabs."""
    if text.isascii():
        return text
    if _JOINERS.search(text):
        text = "".join(c if c not in "‌‍" else "" + c if _joins(text, i) else "" for i, c in enumerate(text))
        parts = re.split("([‌‍])", text)
        text = "".join(p if i % 2 else _visible(p) for i, p in enumerate(parts))
    else:
        text = _visible(text)
    return _draw(unicodedata.normalize("NFD", text))


def _visible(text: str) -> str:
    if "\U0001f3f4" in text:  # a flag's tags are drawn
        return "".join(p if i % 2 else _unify(p) for i, p in enumerate(_KEEP_TAGS.split(text)))
    return _unify(text)


def script_of(letter: str) -> str | None:
    c = ord(letter)
    return "Latn" if c < 0x250 or 0x1E00 <= c < 0x1F00 else "Grek" if 0x370 <= c < 0x400 or 0x1F00 <= c < 0x2000 else "Cyrl" if 0x400 <= c < 0x530 else None


class Scores:
    """Log probabilities of a letter after two others, by script, from counts of three letters over the whole corpus."""

    def __init__(self, triples: dict[tuple[str, str, str], int]) -> None:
        self.triples, self.before, letters = triples, Counter(), {}
        for (a, b, c), n in triples.items():
            self.before[a, b] += n
            letters.setdefault(script_of(c), set()).add(c)
        self.alphabet = {k: max(40, len(v)) for k, v in letters.items()}

    def __call__(self, a: str, b: str, c: str) -> float:
        return math.log((self.triples.get((a, b, c), 0) + 0.5) / (self.before[a, b] + 0.5 * self.alphabet.get(script_of(c), 40)))


#: What leaving a script within a word costs, and a letter that is only nearly alike, in log probability.
SWITCH, NEARLY = -12.0, -3.0
#: Of each letter drawn nearly like another: that one. In both directions.
_NEARLY: dict[str, str] = {a: b for x in NEAR.split() for a, b in (x.split("="), x.split("=")[::-1])}
#: For each script, the letter of each drawing, and which signs of a skeleton can be one of its letters or only that.
_SPELLED = {k: {ord(name): letters[k] for name, letters in DRAWN.items() if k in letters} for k in SCRIPTS}


def scripts_of(drawing: str) -> frozenset[str]:
    """The scripts that have a letter so drawn; all of them for what isn't a letter of the three."""
    if drawing in DRAWN:
        return frozenset(DRAWN[drawing])
    own = None if unicodedata.combining(drawing) else script_of(drawing)
    return frozenset([own]) if own else frozenset(SCRIPTS)


def read_word(word: str, scores: Scores) -> str:
    """The letters of a word given as drawings.

    If one script has all of them, it is read in that one; if several have, in the most likely. A word that no script has
    whole is searched by Viterbi over the lattice of its letters by script and of letters drawn nearly alike, where a
    path is scored by three letters at a time and pays ``SWITCH`` for each change of script and ``NEARLY`` for each letter
    that is only nearly alike. Ties go to the first script.
    """
    shared = set(SCRIPTS)
    for drawing in word:
        shared &= scripts_of(drawing)
    if shared:
        readings = [word.translate(_SPELLED[k]) for k in SCRIPTS if k in shared]
        return readings[0] if len(readings) == 1 else max(readings, key=lambda r: _likelihood(r, scores))
    best: dict[tuple[str, str], tuple[float, tuple]] = {("^", "^"): (0.0, ())}  # last two letters -> (score, path)
    for drawing in word:
        if unicodedata.combining(drawing):
            best = {k: (s, (path, drawing)) for k, (s, path) in best.items()}
            continue
        exact = list(DRAWN.get(drawing, {None: drawing}).values())
        options = [(letter, 0.0) for letter in exact] + [(_NEARLY[x], NEARLY) for x in exact if x in _NEARLY]
        step: dict[tuple[str, str], tuple[float, tuple]] = {}
        for (a, b), (s, path) in best.items():
            for letter, cost in options:
                total = s + cost + scores(a, b, letter) + (SWITCH if b != "^" and script_of(b) != script_of(letter) else 0.0)
                if (b, letter) not in step or total > step[b, letter][0]:
                    step[b, letter] = (total, (path, letter))
        best = step
    _, path = max(best.values(), key=lambda x: x[0])
    out = []
    while path:
        path, letter = path
        out.append(letter)
    return "".join(reversed(out))


def _likelihood(word: str, scores: Scores) -> float:
    total, a, b = 0.0, "^", "^"
    for c in word:
        if not unicodedata.combining(c):
            total += scores(a, b, c)
            a, b = b, c
    return total


#: Words of an ASCII text that another script could have as well: only these need reading.
_DRAWN_ASCII = "".join(x for x in DRAWN if x.isascii())
_SHARED = re.compile(rf"(?<![A-Za-z])[{_DRAWN_ASCII}]+(?![A-Za-z])")


class Reader:
    """Turns texts into their consistent form, remembering the words it has read."""

    LIMIT = 200_000

    def __init__(self, triples: dict[tuple[str, str, str], int]) -> None:
        self.scores, self.known = Scores(triples), {}

    def __call__(self, text: str) -> str:
        if text.isascii():
            return unicodedata.normalize("NFC", _SHARED.sub(self._found, text))
        return unicodedata.normalize("NFC", _WORD.sub(self._found, skeleton(text)))

    def _found(self, m: re.Match) -> str:
        word = m[0]
        if (found := self.known.get(word)) is None:
            if len(self.known) >= self.LIMIT:
                self.known.clear()
            found = self.known[word] = read_word(word, self.scores)
        return found


#: Letters that are counted: those of the three alphabets without accents, and all that are drawn alike. About 60, 100 and 70,
#: so there are at most some 1.5 million triples within a script, whatever the corpus.
_COUNTED = frozenset(chr(c) for r in (range(0x41, 0x5B), range(0x61, 0x7B), range(0x400, 0x460), range(0x391, 0x3CA)) for c in r) | {chr(c) for c in _TO_DRAWING} | {"^"}


def letter_triples(documents: DataFrame, text: str = "text") -> DataFrame:
    """(a, b, c, n) - how often letter c follows a and b within words of one script, over all texts; ``^`` begins a word.

    The JVM counts the distinct words of all texts, Python takes their letters. Words that mix scripts don't count, nor do
    letters outside of the three alphabets, so the greatest number of rows is fixed; in practice a few ten thousand."""
    words = documents.select(F.explode(F.regexp_extract_all(text, F.lit(_WORD.pattern), F.lit(0))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for batch in batches:
            for word, n in zip(batch["word"], batch["n"]):
                letters = [c for c in unicodedata.normalize("NFD", word) if not unicodedata.combining(c)]
                if len({script_of(c) for c in letters}) == 1:
                    for triple in zip(["^", "^", *letters], ["^", *letters], letters):
                        if _COUNTED.issuperset(triple):
                            total[triple] += n
        yield pd.DataFrame([(*k, n) for k, n in total.items()], columns=["a", "b", "c", "n"]).astype({"n": "int64"})

    return words.mapInPandas(run, "a string, b string, c string, n long").groupBy("a", "b", "c").agg(F.sum("n").alias("n"))


def consistent(documents: DataFrame, text: str = "text", into: str = "form") -> DataFrame:
    """``documents`` with the consistent form of ``text`` as ``into``: equal for texts that look the same, different
    for others. Null stays null, empty stays empty; texts of only invisible signs become empty. Other columns stay."""
    model = {(r.a, r.b, r.c): r.n for r in letter_triples(documents, text).collect()}  # bounded by the alphabets
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def form(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader = Reader(shared.value)
        for series in texts:
            yield series.map(lambda t: None if t is None else reader(t))

    return documents.withColumn(into, form(text))


#: About how many documents of one look are paired at a time.
SLICE = 1000


def same_looking(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", slice_: int = SLICE) -> DataFrame:
    """(doc_id_a, doc_id_b), a < b: pairs of documents with visible text that look the same and are stored differently.

    Documents meet on a digest of their form. Those of one look are cut into slices of about ``slice_``: a stored text with more
    copies than that has slices of its own, the others share some. Each two slices are paired as a unit of work, but never
    two of the same stored text, so copies of one text, however many, aren't paired with each other and no task gets a
    whole look. Null, empty and blank texts, and those of only invisible signs, give no pairs; repeated rows count once.
    """
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    formed = consistent(rows).where(F.col("form").rlike(r"[^\s\p{Z}]"))
    keyed = cut(formed.select("doc_id", F.md5("text").alias("stored"), F.md5("form").alias("look")))
    classes = keyed.groupBy("look", "stored").agg(F.count(F.lit(1)).alias("n"))
    looks = cut(classes.groupBy("look").agg(F.count(F.lit(1)).alias("classes"), F.sum("n").alias("rows"), F.sum(F.when(F.col("n") <= slice_, F.col("n"))).alias("small")).where("classes > 1"))
    several = split_join(keyed, looks.select("look", "small"), ["look"], "inner", counts=looks.select("look", F.col("rows").alias("n"))).distinct()
    large = classes.where(F.col("n") > slice_).select("stored", F.col("n").alias("copies"))
    placed = split_join(several, large, ["stored"], "left", counts=large.select("stored", F.col("copies").alias("n")))
    shared = F.concat(F.lit("s"), F.pmod(F.xxhash64("stored"), F.ceil(F.col("small") / slice_)))
    own = F.concat_ws("-", "stored", F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("copies") / slice_)))
    placed = placed.withColumn("slice", F.when(F.col("copies").isNull(), shared).otherwise(own)).withColumn("only", F.when(F.col("copies").isNotNull(), F.col("stored")))
    blocks = cut(placed.groupBy("look", "slice").agg(F.first("only").alias("only"), F.collect_list(F.struct("stored", "doc_id")).alias("items")))
    slices = blocks.groupBy("look").agg(F.array_sort(F.collect_list(F.struct("slice", "only"))).alias("all"))
    two = slices.select("look", F.posexplode("all").alias("i", "x"), "all").select("look", "x", F.explode(F.slice("all", F.col("i") + 1, F.size("all"))).alias("y"))
    units = two.where(F.col("x.only").isNull() | F.col("y.only").isNull() | (F.col("x.only") != F.col("y.only"))).select("look", F.col("x.slice").alias("sx"), F.col("y.slice").alias("sy"))
    left = units.join(blocks.select("look", F.col("slice").alias("sx"), F.col("items").alias("xs")), ["look", "sx"])
    both = left.join(blocks.select("look", F.col("slice").alias("sy"), F.col("items").alias("ys")), ["look", "sy"])
    met = both.select("sx", "sy", F.explode("xs").alias("x"), "ys").select("sx", "sy", "x", F.explode("ys").alias("y"))
    met = met.where((F.col("x.stored") != F.col("y.stored")) & ((F.col("sx") != F.col("sy")) | (F.col("x.stored") < F.col("y.stored"))))
    return met.select(F.least("x.doc_id", "y.doc_id").alias("doc_id_a"), F.greatest("x.doc_id", "y.doc_id").alias("doc_id_b")).where("doc_id_a < doc_id_b").distinct()
