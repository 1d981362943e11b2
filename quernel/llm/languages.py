"""The language of a short text, from its script and its function words."""

from __future__ import annotations

import re

# Frequent function words by language.
WORDS = {
    "en": "the of and to in is it that for on with as are was be by this which from or an at not have has does do did what when where who why how if then than each every only all any no its they them he she we you can may will would should could into out after before until while once there here these those their but so because make let add extend keep kept way between within without unless across during over under yes never always both either",
    "de": "der die das den dem des ein eine einen einem einer und oder nicht ist sind war wird werden wurde mit von zu zum zur auf für im in an am bei nach vor über unter aus als auch nur noch wie was wer wo warum wann wenn dass weil ob er sie es wir ihr ich man sich hat haben kann kein keine jede jeder jedes jeden bevor sonst danach dann durch bis ohne um je innerhalb geschieht behandelt prüft zweimal einmal",
    "fr": "le la les un une des du de et ou ne pas est sont était être a ont avec pour par sur dans en au aux ce cette ces qui que quoi où quand comment pourquoi si il elle on nous vous ils elles je se son sa ses leur plus aussi puis sans avant après chaque fait comme mais donc entre sous quel quelle quels deux fois ici lorsque moins tout",
    "es": "el la los las un una unos unas de del y o no es son era ser fue ha han con para por en al a que qué quién cómo cuándo dónde cuál si él ella se su sus lo le les más también después antes sin según cada hace trata lee pero entre sobre este esta estos hasta cuando porque muy ya aquí dos veces vez tras menos como yo",
    "pt": "o a os as um uma de do da dos das e ou não é são com para por em no na nos nas que se seu sua mais também depois antes sem cada faz quando como porque ao pelo pela isso este esta até entre sobre",
    "it": "il lo la i gli le un una di del della dei delle e o non è sono con per in nel nella che si suo sua più anche dopo prima senza ogni quando come perché questo questa al alla da dal fino tra su",
}
_LANGUAGES: dict[str, list[str]] = {}
for _code, _words in WORDS.items():
    for _word in set(_words.split()):
        _LANGUAGES.setdefault(_word, []).append(_code)
_SCRIPTS = [("ja", re.compile(r"[぀-ヿ]")), ("ko", re.compile(r"[가-힣]")), ("zh", re.compile(r"[㐀-鿿]")), ("ru", re.compile(r"[Ѐ-ӿ]")), ("el", re.compile(r"[Ͱ-Ͽ]")), ("ar", re.compile(r"[؀-ۿ]")), ("he", re.compile(r"[֐-׿]")), ("hi", re.compile(r"[ऀ-ॿ]"))]
_LATIN = re.compile(r"[a-zA-ZÀ-ɏ]")
_HINTS = [("de", re.compile(r"[ßäöü]")), ("es", re.compile(r"[ñ¿¡]|ción")), ("fr", re.compile(r"[çœêèàù]|l'|d'|qu'"))]
_WORDS = re.compile(r"[^\W\d_]+(?:'(?=[a-zà-ÿ]))?")
#: Code, quotations and names, whose language doesn't count.
ASIDES = re.compile(r"```.*?```|`[^`]*`|“[^”]*”|„[^“”]*[“”]|«[^»]*»|「[^」]*」|\"[^\"\n]*\"|\b\w*_\w+\b|\b\w+\.\w+\b|\b\w+\(\)", re.S)


def language(text: str) -> str | None:
    """The code of the language of ``text`` as a whole, None where it can't be told."""
    text = ASIDES.sub(" ", text)
    if not text.isascii():
        letters = len(_LATIN.findall(text))
        for code, pattern in _SCRIPTS:
            # a sign of Han holds about as much as two letters
            n = len(pattern.findall(text)) * (3 if code in ("ja", "zh", "ko") else 1)
            if n >= 2 and n > letters:
                return code
    words = _WORDS.findall(text.lower())
    scores = dict.fromkeys(WORDS, 0)
    for w in words:
        for k in _LANGUAGES.get(w if w[-1] != "'" else w[:-1], ()):
            scores[k] += 1
    best = sorted(scores, key=lambda k: (-scores[k], k))
    if scores[best[0]] and scores[best[0]] > scores[best[1]]:
        return best[0]
    low = text.lower()
    tied = [k for k in best if scores[k] == scores[best[0]]]
    hinted = [k for k, p in _HINTS if p.search(low) and k in tied]
    return hinted[0] if len(hinted) == 1 and len(words) >= 2 else None
