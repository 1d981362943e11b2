"""Whether a documentation comment says anything about its component."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

# Words that would fit any function, by language. A comment of such words alone isn't telling.
GENERIC = set(
    """
a an the this that these those it its is are was be been being do does did done doing has have had will would can could may
of for from to in on at by with as and or not no nor but so here there above below see also via per into
i we you your our my me us one some any all same such other more next new
todo fixme xxx hack tbd tba tbc wip wtf nb note notes na nil null none nan undefined unknown blank empty void missing pending later soon
doc docs docstring docstrings documentation documented documenting document undocumented description descriptions describe describes
desc summary summarize explain explanation comment comments text write written add added insert enter fill provide provided update
available given follow follows following come comes coming needed required wanted unwanted necessary intentionally left goes
placeholder stub skeleton template boilerplate auto autogenerated generated automatically created generate sphinx
function functions func fn method methods routine procedure callable class classes object objects module member attribute property
helper helpers utility utilities util utils internal private public protected common general generic misc miscellaneous various
getter setter accessor mutator constructor initializer initialiser initialize initialise init destructor wrapper handler callback hook
main logic code implementation implements implement implemented body entry point interface api base default simple basic standard usual
return returns returned returning yield yields result results value values output outputs input inputs argument arguments arg args
parameter parameters param params kwargs data thing things stuff something anything everything item items
call calls called perform performs performed execute executes run runs handle handles process processes work works job action operation
operations task tasks use uses used using make makes get gets set sets
obvious trivial self explanatory explained evident name says named suggests implies
deprecated obsolete legacy experimental unstable beta alpha draft final reserved unused
test tests testing temp tmp foo bar baz qux quux asdf qwerty blah bla lorem ipsum dummy sample example hello world someone somebody nobody
type types int str float bool list dict tuple bytes optional otherwise etc ok yes nothing
siehe oben unten noch zu dokumentieren dokumentation dokumentiert hier fehlt fehlen die der das den dem eine ein einer beschreibung folgt folgen
spaeter später wird ist nachgereicht kommt hilfsfunktion funktion methode gibt zurück zurueck ergebnis wert offen ergänzen text keine kein
à a compléter completer documenter voir ci dessus dessous description documentation manquante manquant venir suivre plus tard la le les un une de du des
fonction méthode methode utilitaire renvoie retourne résultat valeur aucune pas rédiger
por documentar pendiente completar ver arriba abajo descripción descripcion documentación documentacion falta más tarde función método metodo
devuelve resultado valor sin el los las del hacer redactar texto
описание позже документация документировать нужно дописать смотри см выше ниже функция метод возвращает результат значение нет без будет добавить текст
περιγραφή αργότερα τεκμηρίωση συνάρτηση μέθοδος επιστρέφει αποτέλεσμα τιμή βλέπε παραπάνω προς συμπλήρωση θα ακολουθήσει λείπει η το ο του της
""".split()
)
# The same in scripts written without spaces, longest first.
GENERIC_HAN = ["自动生成的文档", "自动生成", "文档字符串", "如上所述", "同上", "见上", "参见上文", "暂无说明", "暂无描述", "暂无文档", "待补充", "待完善", "待办", "待写", "没有说明", "无说明", "无描述", "说明", "描述", "文档", "注释", "摘要", "稍后", "补充", "填写", "此处", "这里", "返回结果", "返回值", "返回", "结果", "函数", "方法", "辅助", "工具", "内部使用", "暂无", "说明なし", "ドキュメント", "未記入", "関数", "後で", "記入", "설명", "없음"]
# Words that open a remark that text is missing or to follow.
REMARK = re.compile(r"(?i)\W*(?:@?(?:to-?do|fix-?me|xxx|tbd|tba|wip|hack)\b|t\.b\.[da]\.)")
#: Directives of tools.
DIRECTIVE = re.compile(
    r"(?im)^\s*(?:#\s*)?(?:(?:pylint|flake8|mypy|pyright|ruff|isort|yapf|fmt|pragma|nosec|bandit|type|noinspection|coding|vim|eslint|doctest|noqa)\b\s*[:=+]\s*[\w \-.,:=\[\]]*|noqa\b.*|nosec\b.*|noinspection\s+\w+|-\*-.*-\*-)\s*$"
)
#: Lines of a docstring's skeleton: section titles, underlines.
SECTION = re.compile(r"(?im)^\s*(?:args|arguments|parameters|params|other parameters|keyword args|keyword arguments|attributes|returns?|yields?|raises|throws|except|notes?|examples?|see also|references|warnings?|todo)\s*:?\s*$")
#: A field of a skeleton: ``:param x: text``, ``@param x text``, ``x (int): text``, ``x : int``.
FIELD = re.compile(
    r"(?m)^\s*(?:[:@](?P<tag>param|parameter|arg|argument|key|keyword|type|rtype|returns?|yields?|raises?|ivar|cvar|var)\b[ \t]*(?P<a>[\w*. \t]*?)(?::|(?<=@)|$|(?<=\w)[ \t])[ \t]*(?P<text>.*)|(?P<b>\*{0,2}\w+)[ \t]*(?:\([^()\n]*\))?[ \t]*:(?!:)[ \t]*(?P<rest>.*))$"
)
WORD = re.compile(r"[^\W\d_]+|\d+", re.U)
HAN = re.compile(r"[぀-ヿ㐀-鿿豈-﫿가-힣]")
IGNORABLE = dict.fromkeys([0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, 0x200E, 0x200F, 0x180E])


def _split_name(name: str) -> list[str]:
    return [w.lower() for w in re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[^\W\d_A-Za-z]+|\d+", name)]


def stem(word: str) -> str:
    """English endings off, so that ``flushes``, ``flushing`` and ``flush`` agree."""
    for ends in (("ies", "es", "s"), ("ied", "ing", "ed", "y", "i", "e")):
        for end in ends:
            if word.endswith(end) and len(word) - len(end) >= 2:
                word = word[: -len(end)]
                break
    return word[:-1] if len(word) > 3 and word[-1] == word[-2] else word


# Verbs that say the same as a name's first word.
SYNONYMS = [
    "get fetch retrieve obtain read load look lookup find access return give",
    "set assign update put write store change modify replace",
    "is has can check test verify determine tell whether if true false ensure validate",
    "init initialise initialize construct create build make new set up prepare instantiate",
    "add insert append put",
    "remove delete drop discard",
]
_SYNONYMS = {w: group.split() for group in SYNONYMS for w in group.split()[:3]}


@lru_cache(20_000)
def _own_words(name: str, parameters: tuple[str, ...]) -> frozenset[str]:
    own = _split_name(name)
    return frozenset(stem(w) for w in [*own, *_SYNONYMS.get(own[0] if own else "", []), *(w for p in parameters for w in _split_name(p))])


_STEMS = frozenset(stem(w) for w in GENERIC)


def _empty_words(text: str, own: frozenset[str]) -> bool:
    """Nothing but generic and own words, numbers of the own name and signs."""
    if HAN.search(text):
        for phrase in GENERIC_HAN:
            text = text.replace(phrase, " ")
        if HAN.search(text):
            return False
    for token in WORD.findall(text):
        low = token.lower()
        if low in GENERIC or len(low) == 1 and low.isascii():
            continue
        root = stem(low)
        if root not in own and root not in _STEMS and not (low.endswith("s") and low[:-1] in own):
            return False
    return True


def telling(doc: str | None, name: str = "", parameters: tuple[str, ...] = ()) -> bool:
    """True if ``doc`` says something about what the component does or how it behaves.

    It doesn't if it is null or blank, or if each sentence and field of it is signs, a directive, a skeleton, a
    remark that text is missing, or made of generic words and those of ``name`` and ``parameters``.
    """
    if not doc:
        return False
    text = unicodedata.normalize("NFKC", doc).translate(IGNORABLE)
    text = DIRECTIVE.sub("", text)
    text = SECTION.sub("", text)
    own = _own_words(name.rpartition(".")[2], tuple(parameters))
    fields: list[tuple[str, str]] = []

    def take(m: re.Match) -> str:
        if m["tag"] or m["b"].lstrip("*") in parameters or m["b"] in ("self", "cls"):
            value = "" if m["tag"] in ("type", "rtype") else (m["text"] if m["tag"] else m["rest"]) or ""
            if not m["tag"] and not m["rest"]:
                return ""
            fields.append(((m["a"] or m["b"] or "").strip("* \t"), value))
            return ""
        return m[0]

    text = FIELD.sub(take, text)
    for fragment in re.split(r"(?<=[.!?;])\s+|(?<=[。！？；])|\n+", text):
        if fragment.strip() and not REMARK.match(fragment) and not _empty_words(fragment, own):
            return True
    for label, value in fields:
        value = re.sub(r"(?i)^(?:\([^()]*\)\s*)?", "", value)
        if value.strip() and not REMARK.match(value) and not re.fullmatch(r"\W*_?(?:type|description|summary)_?\W*", value) and not _empty_words(value, own | _own_words(label, ())):
            return True
    return False
