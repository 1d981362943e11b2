"""Problem 6: prompt-response pairs and their defects."""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernel.llm.languages import language
from quernel.operators.skew import split_join
from quernel.session import cut

_TAGS = {"Q": "prompt", "R": "prompt", "QUESTION": "prompt", "REQUIREMENT": "prompt", "A": "response", "S": "response", "ANSWER": "response", "SOLUTION": "response"}
_ITEM = re.compile(r"<(QA|DESIGN)\s*>", re.I)
_FIELD = re.compile(r"<(Q|R|A|S|QUESTION|REQUIREMENT|ANSWER|SOLUTION)\s*(/\s*)?>", re.I)
_LABEL = re.compile(r"(?im)^[ \t]*(?:\*\*|\[|#+ *)?(question|requirement|answer|solution|code(?: snippet)?|reasoning(?: process)?|trace)(?:\]|\*\*)?[ \t]*:(?:\*\*)?[ \t]*")
#: Labels that belong to neither text.
_PREFIX = re.compile(r"(?i)^\s*(?:(?:question|requirement|answer)\s*[:：]\s*)+")


def parse_pairs(content: str | None) -> list[tuple[str, str, bool]]:
    """(prompt, response, broken off) of each pair in a log's content: XML-like items with or without a set or a code
    fence, a JSON array or object, or labelled lines. An absent response is empty; ``broken off`` says that the
    content ends inside the response. Null, empty and other contents have no pairs."""
    if not content or not content.strip():
        return []
    body = content.strip()
    fenced = re.sub(r"^```\w*\s*|\s*```$", "", body)
    if fenced[:1] in "[{" and re.match(r"\[\s*(?:\{|\])|\{", fenced):
        try:
            value = json.loads(fenced)
        except (ValueError, RecursionError):
            value = _loose_objects(fenced)
        items = value if isinstance(value, list) else next((v for v in value.values() if isinstance(v, list)), [value])
        out = []
        for item in items:
            if isinstance(item, dict):
                low = {str(k).lower(): v for k, v in item.items()}
                prompt = low.get("question", low.get("requirement", low.get("prompt")))
                response = low.get("answer", low.get("solution", low.get("response")))
                if prompt is not None or response is not None:
                    out.append((_text(prompt), _text(response), bool(low.get("\0broken"))))
        return out
    if _FIELD.search(body):
        return _tagged(body)
    return _labelled(body)


def _text(value) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def _loose_objects(text: str) -> list[dict]:
    """What can still be read of a JSON array that isn't complete."""
    out = []
    for chunk in re.split(r"\{(?=\s*\"(?:question|requirement|prompt)\"\s*:)", text)[1:]:
        item = {}
        for m in re.finditer(r'"(question|requirement|prompt|answer|solution|response)"\s*:\s*(?:"((?:[^"\\]|\\.)*)("?)|null)', chunk, re.S):
            raw = m[2] or ""
            try:
                item[m[1]] = json.loads(f'"{raw}"', strict=False)
            except ValueError:
                item[m[1]] = raw
            if m[2] is not None and not m[3]:
                item["\0broken"] = True
        out.append(item)
    return out


def _tagged(body: str) -> list[tuple[str, str, bool]]:
    starts = [m.end() for m in _ITEM.finditer(body)]
    if not starts:  # bare fields: each prompt begins a pair
        starts = [m.start() for m in _FIELD.finditer(body) if _TAGS[m[1].upper()] == "prompt"]
    out = []
    for begin, end in zip(starts, [*starts[1:], len(body)]):
        part = {}
        broken = False
        at = begin
        while m := _FIELD.search(body, at, end):
            role, at = _TAGS[m[1].upper()], m.end()
            if m[2]:
                part.setdefault(role, "")
                continue
            close = re.compile(rf"</\s*{m[1]}\s*>", re.I).search(body, at, end)
            if close:
                part.setdefault(role, body[at : close.start()])
                at = close.end()
                continue
            following = re.compile(r"</?(?:Q|R|A|S|CODE|TRACE|QA|DESIGN|SET)\b", re.I).search(body, at, end)
            stop = following.start() if following else end
            value = re.sub(r"<[/\w]*$|\s*```$", "", body[at:stop])
            part.setdefault(role, value)
            broken |= role == "response" and not following
            at = stop
        if part:
            out.append((part.get("prompt", ""), part.get("response", ""), broken))
    return out


def _labelled(body: str) -> list[tuple[str, str, bool]]:
    out: list[list] = []
    marks = list(_LABEL.finditer(body))
    for m, following in zip(marks, [*marks[1:], None]):
        value = body[m.end() : following.start() if following else len(body)]
        label = m[1].lower()
        if label in ("question", "requirement"):
            if out and out[-1][0] is not None and not value.strip() and not out[-1][0].strip():
                continue
            out.append([value, None, False])
        elif label in ("answer", "solution") and out:
            if out[-1][1] is None:
                out[-1][1:] = [value, following is None]
            else:
                out[-1][1] += m[0] + value
    return [(q, a or "", b) for q, a, b in out]


# Words for "no value".
NO_VALUE = set(
    "none null nil nan n/a na n.a. undefined empty blank void nothing (none) missing no-value novalue no_value notavailable noanswer nooutput "
    "keine keiner kein nichts leer aucun aucune rien vide néant ninguno ninguna nada vacío vacio 无 無 空 空白 没有 なし нет пусто отсутствует ничего κενό κανένα τίποτα".split()
)
NO_VALUES = re.compile(r"(?:not (?:available|applicable|given|provided|answered)|no (?:value|answer|response|output|data|content)(?: given| provided| available)?|(?:noch )?nicht vorhanden|keine (?:antwort|angabe)|pas de réponse|sans réponse|sin (?:respuesta|valor|datos)|нет ответа|нет данных|暂无|无内容|没有答案)")

# Refusals as token sequences; a slot ``*`` takes up to three tokens. Contractions are spelled out
# and curly apostrophes straightened before.
REFUSALS = """
i can not * help|i can not * assist|i can not * answer|i can not * comply|i can not * explain|i can not * provide|i can not * discuss|i can not * comment|i can not * say|i can not * share|i can not * tell|i can not * do that|i can not * fulfill|i can not * support|i can not * offer|i can not * continue|i can not * describe|i can not * respond|i can not * give
i could not * answer|i could not * help|i could not * say
i am unable to|i am not able to|i am not allowed to|i am not permitted to|i am not in a position to|i am not comfortable|i am not going to|i am not qualified to|i am afraid i can|i am prevented from|i am forbidden
i will not be able to|i will not * answer|i will not * guess|i will not * help|i will not * explain|i will not * comment|i will not * discuss|i will not * provide|i do not feel comfortable|i do not have enough * context|i do not have enough * information|i do not have * access to|i do not have the ability|i do not wish to|i do not want to answer|i refuse to|i decline to|i must decline|i have to decline|i need to decline|i must refuse|i have to refuse|i have to pass on|i must pass on|i will pass on|i will have to decline|i would rather not|i prefer not to|i would prefer not to|i choose not to|i should not answer|i must not|i may not answer|i may not discuss|i may not comment|i can offer no|i can give no|i can provide no|i can say nothing|i am going to pass|i have nothing to say|i have no answer|i have no comment
my guidelines * do not allow|my guidelines prevent|my guidelines forbid|my instructions * do not allow|my instructions forbid|my policy * does not allow|my policies * do not allow|my rules * do not allow|against my guidelines|against my policy|against my instructions|my programming does not
it would not be appropriate * me|it is not appropriate * me|it is not possible for me to|it would be inappropriate * me|it is inappropriate * me|it is beyond my|it is outside my|this is beyond my|this is outside my|this request is outside|this question is outside|that is outside what i|this is outside what i|this is beyond what i|outside the scope of what i|this request is beyond|beyond my|outside my|not within my
as a language model i|as an ai * i|as an ai language model|as an assistant i can not|as a model i
i apologize * but|i apologise * but|i apologize this request|i apologise this request|i am sorry but i|i am sorry i|sorry but i|sorry i am|sorry i can not|sorry i will not|unfortunately i can not|unfortunately i am|regrettably i|no comment from me
kann ich * nicht|ich kann * nicht helfen|ich kann * nicht beantworten|ich kann * nicht sagen|ich kann dazu nichts|ich kann * keine auskunft|ich kann diese|ich darf * nichts|ich darf * nicht|darf ich * nichts|darf ich * nicht|darf ich keine|es tut mir leid|tut mir leid|ich muss ablehnen|ich muss * ablehnen|ich möchte * nicht|ich bin nicht in der lage|ich bin nicht befugt|es ist mir nicht möglich|ist mir nicht möglich|ist mir * untersagt|als sprachmodell|als ki|ich lehne * ab|leider kann ich|leider darf ich|leider bin ich nicht
je ne peux pas|je ne peux * répondre|je ne suis pas en mesure|je ne suis pas autorisé|je ne suis pas capable|je suis désolé|désolé je|je regrette|je dois refuser|je dois décliner|je refuse|je préfère ne pas|je ne saurais|je ne souhaite pas|je n ai pas le droit|je n ai pas assez|il ne m est pas possible|il m est impossible|en tant que modèle|en tant qu ia|malheureusement je
lo siento|no puedo * ayudar|no puedo responder|no puedo contestar|no puedo * esa|no puedo dar|no puedo explicar|no puedo comentar|no puedo hablar|no me es posible|no estoy autorizado|no estoy en condiciones|no soy capaz|no tengo permitido|me es imposible|debo rechazar|tengo que rechazar|prefiero no|como modelo de lenguaje|como ia|lamentablemente no puedo|me temo que no
я не могу|не могу * ответить|не могу * помочь|к сожалению я|извините я|извините но|простите я|прошу прощения|я не в состоянии|мне нельзя|я вынужден отказать|вынужден отказаться|как языковая модель|я отказываюсь|я не имею права
λυπάμαι|δεν μπορώ να|δυστυχώς δεν|δεν είμαι σε θέση|ως γλωσσικό μοντέλο|δεν μου επιτρέπεται
outside of what i|outside what i|outside the bounds of what i|beyond what i may|beyond what i can|not something i can|not something i may|not something i am|nothing i can say|nothing i may say|i have been told not to|i have been asked not to|i have been instructed not to|i can neither|i am in no position|i can not in good conscience|i leave * unanswered|i must leave * unanswered|i will leave * unanswered|i will skip this question|i do not think i should|i do not think i can|i am going to have to|not at liberty
non posso * aiutare|non posso rispondere|non posso * questa|mi dispiace|non mi è possibile|non sono in grado|non sono autorizzato|devo rifiutare|purtroppo non|preferisco non|come modello linguistico
não posso * ajudar|não posso responder|não posso * essa|não posso * esta|não consigo responder|lamento mas|sinto muito|desculpe mas|não me é possível|não estou autorizado|devo recusar|infelizmente não posso|prefiro não|como modelo de linguagem
"""
_TEMPLATES = [t.split() for line in REFUSALS.strip().split("\n") for t in line.split("|")]
_BY_FIRST: dict[str, list[list[str]]] = {}
for _t in _TEMPLATES:
    _BY_FIRST.setdefault(_t[0], []).append(_t)
# Refusals in scripts written without spaces.
REFUSALS_HAN = re.compile(r"(?:我|本模型|作为(?:一个)?(?:语言|人工智能|AI)?模型).{0,10}(?:无法|不能|不便|不可以|无权|没有权限|不被允许|拒绝)|(?:抱歉|对不起|很遗憾|不好意思)|(?:恕|请恕).{0,4}(?:无法|不能|难)|お(?:答え|手伝い)できません|申し訳|답변(?:할 수 없|드릴 수 없)")
# How contractions are spelled out.
CONTRACTIONS = [(r"\bcannot\b", "can not"), (r"\bcan't\b", "can not"), (r"\bwon't\b", "will not"), (r"n't\b", " not"), (r"\bi'm\b", "i am"), (r"\bi'd\b", "i would"), (r"\bi'll\b", "i will"), (r"\bi've\b", "i have"), (r"\bit's\b", "it is"), (r"\bthat's\b", "that is")]
_CONTRACTIONS = [(re.compile(a), b) for a, b in CONTRACTIONS]
# Words by which a sentence speaks of speaker and reader, thanks or excuses. Such sentences may stand before a refusal.
SPEAKERS = frozenset(
    "i me my you your we our us thank thanks sorry apologies apologize apologise unfortunately regrettably please hello hi sure okay ich ihnen ihre ihr danke leider entschuldigung entschuldigen je vous votre merci désolé malheureusement bonjour"
    " yo usted ustedes gracias lamento lamentablemente disculpe я вы вам вас спасибо извините простите здравствуйте жаль сожалению σας ευχαριστώ λυπάμαι δυστυχώς συγγνώμη eu você obrigado desculpe io lei grazie scusi purtroppo".split()
)
_SPEAKERS_HAN = re.compile("[我您你咱]|谢谢|感谢|抱歉|对不起|遗憾|ありがとう|すみません|申し訳")
_WORD = re.compile(r"[^\W_]+")


def plain_tokens(text: str) -> list[str]:
    text = text.lower().replace("’", "'")
    if "'" in text or "cannot" in text:
        for pattern, value in _CONTRACTIONS:
            text = pattern.sub(value, text)
    return _WORD.findall(text)


def aligned(template: list[str], tokens: list[str], at: int) -> bool:
    """True if ``template`` lies over ``tokens`` from ``at`` on, each ``*`` over at most three tokens."""
    if template[0] != "*" and tokens[at] != template[0]:
        return False
    reach = {at}
    for part in template:
        if part == "*":
            reach = {r + k for r in reach for k in range(4)}
        else:
            reach = {r + 1 for r in reach if r < len(tokens) and tokens[r] == part}
        if not reach:
            return False
    return True


_PARTS = re.compile(r"(?<=[.!?])\s+|\n+|(?<=[。！？])")
_HAN = re.compile(r"[㐀-鿿぀-ヿ가-힣]")


def refuses(prompt: str, response: str) -> bool:
    """True if a sentence of ``response`` aligns with a refusal and none before it answers. A sentence answers unless it
    speaks of speaker or reader (thanks, excuses, announcements) or is the prompt again, by containment of its shingles."""
    text = _ASIDE.sub(" it ", response)
    asked = None
    for sentence in _PARTS.split(text.strip()):
        if _HAN.search(sentence):
            if REFUSALS_HAN.search(sentence):
                return True
            if not _SPEAKERS_HAN.search(sentence):
                return False
            continue
        tokens = plain_tokens(sentence)
        for i, token in enumerate(tokens):
            if token in _BY_FIRST and any(aligned(t, tokens, i) for t in _BY_FIRST[token]):
                return True
        if tokens and SPEAKERS.isdisjoint(tokens):
            asked = asked if asked is not None else shingles(plain_tokens(_ASIDE.sub(" it ", prompt)))
            own = shingles(tokens)
            if 2 * len(own & asked) < len(own):
                return False
    return False


_ASIDE = re.compile(r"```.*?```|`[^`]*`|“[^”]*”|«[^»]*»|\"[^\"\n]*\"", re.S)


def shingles(tokens: list[str], n: int = 3) -> set[tuple[str, ...]]:
    return {tuple(tokens[i : i + n]) for i in range(max(1, len(tokens) - n + 1))}


def common_subsequence(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, with bits for rows: O(len(a) * len(b) / word)."""
    where: dict[str, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for y in b:
        m = row & where.get(y, 0)
        row = (row + m | row & ~m) & full
    return len(a) - row.bit_count()


# Words that name a part of a pair.
LABELS = frozenset("question questions requirement requirements answer answers solution solutions prompt query task response reply q asked repeat repeated again frage anforderung antwort exigence réponse pregunta requisito respuesta вопрос требование ответ ερώτηση απαίτηση απάντηση domanda risposta pergunta resposta".split())
_LABELS_HAN = re.compile(r"(?:问题|需求|要求|回答|答案|提问)\s*[:：]")
_COPIED = re.compile(r"[㐀-鿿぀-ヿ]|[^\W㐀-鿿぀-ヿ]+")


def copies(prompt: str, response: str) -> bool:
    """True if ``response`` is nothing but ``prompt`` again, once or more, apart from case, spacing, signs and labels.

    Containment of the prompt's shingles finds candidates. Then the prompt, as often as its words occur in the response,
    is aligned with it by their longest common subsequence: it must be covered whole, and what else the response holds
    must be labels. Labels may stand anywhere, and those of the prompt needn't be repeated.
    """
    a, b = (_COPIED.findall(_LABELS_HAN.sub(" ", t).lower()) for t in (prompt, response))
    bare = [x for x in a if x not in LABELS] or a
    if not a or not b or not set(b).issuperset(bare):
        return False
    own = shingles(a)
    if 5 * len(own & shingles(b)) < 3 * len(own):
        return False
    of_a, of_b = Counter(bare), Counter(b)
    times = min(of_b[x] // n for x, n in of_a.items())
    if not times or any(n > times * of_a[x] and x not in LABELS for x, n in of_b.items()):
        return False
    return common_subsequence(bare * times, b) == times * len(bare)


_FINAL = ".!?。！？…‽؟।"
_CLOSERS = "\"'”’»)]}」』*_`"


def ending(response: str) -> tuple[str, str]:
    """How a response ends: ``whole``, ``broken`` or ``open`` with the token whose place at a sentence's end decides."""
    text = response.rstrip()
    if text.count("```") % 2 or text.replace("```", "").count("`") % 2:
        return "broken", ""
    if text.count("“") > text.count("”") and not text.count("„") or text.count("«") > text.count("»") or text.count("(") > text.count(")"):
        return "broken", ""
    bare = text.rstrip(_CLOSERS)
    if re.search(r"(?:\.\.\.|…)$", bare) and re.search(r"\w", bare):
        return "broken", ""
    if not bare:
        return "whole", ""
    if bare[-1] in _FINAL:
        return "whole", ""
    if text[-1] in _CLOSERS and text != bare:
        return "whole", ""
    if re.search(r"[,;:，；：、\-–—/&+=(\[{<]$", text):
        return "broken", ""
    last_line = text.rpartition("\n")[2]
    listed = re.match(r"\s*(?:[-*•]|\d+[.)])\s", last_line)
    if not listed and re.search(rf"[{_FINAL}][{re.escape(_CLOSERS)}]*(?:\s+\S|(?<=[。！？])\S)", text):
        return "broken", ""  # earlier sentences have their marks
    return "open", last_token(text)


def last_token(text: str) -> str:
    """The last word in lower case with digits as 0; the last two signs of scripts written without spaces."""
    if re.search(r"[㐀-鿿぀-ヿ]$", text):
        return text[-2:]
    return re.sub(r"\d+", "0", re.findall(r"\S+", text)[-1].lower().strip(_CLOSERS + "“«"))


_UNSEEN = dict.fromkeys([0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, 0xAD])


def judge(prompt: str, response: str, broken_off: bool) -> tuple[str | None, str | None]:
    """(defect, token): the defect of a pair, None if it has none, or ``open`` with the token that decides whether the
    response is truncated. Labels belong to neither text."""
    prompt, response = _PREFIX.sub("", prompt).strip(), _PREFIX.sub("", response)
    bare = (response if response.isascii() else response.translate(_UNSEEN)).strip()
    word = bare.strip(" \t\r\n.!?。…<>()[]{}\"'`*_-–—:;,").lower()
    if not re.search(r"\w", bare) or word.replace(" ", "") in NO_VALUE and len(word) < 20 or NO_VALUES.fullmatch(word):
        return "empty", None
    if copies(prompt, bare):
        return "copy", None
    if refuses(prompt, bare):
        return "refusal", None
    asked, told = language(prompt), language(bare)
    if asked and told and asked != told:
        return "language", None
    how, token = ending(bare)
    if how == "broken" or broken_off and how != "whole":
        return "truncated", None
    return ("open", token) if how == "open" else (None, None)


def pairs(log: DataFrame) -> DataFrame:
    """(log_id, component_id, pair_no, prompt, response, defect, token) of every pair of the agent ``writer``; see
    ``judge`` for defect and token. Pairs number from 1 in a content; copies of a row count once."""
    rows = log.where(F.col("agent") == "writer").select("log_id", "component_id", "content").where(F.col("content").isNotNull()).distinct()
    schema = "log_id long, component_id string, pair_no int, prompt string, response string, defect string, token string"

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in schema.split(", ")]
        for batch in batches:
            out = []
            for log_id, component, content in zip(batch["log_id"], batch["component_id"], batch["content"]):
                for n, (q, a, broken) in enumerate(parse_pairs(content), 1):
                    out.append((None if pd.isna(log_id) else int(log_id), component, n, q, a, *judge(q, a, broken)))
            yield pd.DataFrame(out, columns=names).astype({"log_id": "Int64"})

    return rows.mapInPandas(read, schema)


def word_places(log: DataFrame) -> DataFrame:
    """(token, ends, inside) - how often a word stands before a final mark, and how often another word follows it on the same
    line, with digits as 0; in scripts without spaces two signs count as a word. All contents of all agents are read, once."""
    closers = "[\"'”’»)`*_\\],}]"
    last = F.regexp_extract_all("content", F.lit(rf"(?<![^\s>])[^\s<]*[.!?]{closers}*(?=[\s<]|$)"), F.lit(0))
    last_wide = F.regexp_extract_all("content", F.lit(r"([\u3040-\u30ff\u3400-\u9fff]{2})[。！？]"), F.lit(1))
    words = F.regexp_extract_all("content", F.lit(r'(?U)(?<![^\s<>"\\])[^\s<>"\\]+(?=[ \t]+[\w`“(])'), F.lit(0))
    words_wide = F.regexp_extract_all("content", F.lit(r"(?=([\u3040-\u30ff\u3400-\u9fff]{2})[\u3040-\u30ff\u3400-\u9fff])"), F.lit(1))
    both = F.array(F.struct(F.lit(True).alias("end"), F.concat(last, last_wide).alias("tokens")), F.struct(F.lit(False).alias("end"), F.concat(words, words_wide).alias("tokens")))
    each = log.where(F.col("content").isNotNull()).select(F.explode(both).alias("t")).select("t.end", F.explode("t.tokens").alias("token"))
    tokens = each.groupBy("token", "end").agg(F.count(F.lit(1)).alias("n"))
    begin = F.regexp_replace(F.lower("token"), "^[“«\"'`*_(\\[{]+", "")
    bare = F.when(F.col("end"), F.regexp_replace(begin, rf"{closers}*[.!?]{closers}*$", "")).otherwise(F.regexp_replace(begin, "[,;:\"'”’»)`*_\\]}]+$", ""))
    return tokens.groupBy(F.regexp_replace(bare, r"\d+", "0").alias("token")).agg(F.sum(F.when(F.col("end"), F.col("n")).otherwise(0)).alias("ends"), F.sum(F.when(F.col("end"), 0).otherwise(F.col("n"))).alias("inside"))


#: A last word of which less than this share of uses lies elsewhere than at open ends is a fragment, no word.
ELSEWHERE = 1 / 4
#: A word of which less than this share of uses ends a sentence or another answer ends none.
ENDING = 1 / 100
#: Of a word not known otherwise: answers are whole if at most this share of them differ; texts that break off don't repeat.
DIFFERENT = 1 / 2


def defects(log: DataFrame) -> DataFrame:
    """(log_id, component_id, pair_no, defect) of each defective pair; a pair has at most one defect.

    In this order: ``empty``, ``copy``, ``refusal``, ``language``, ``truncated``. A response without final mark is
    truncated if earlier sentences have theirs, a bracket, quote or code is open, or by its last word: if in the whole log
    too small a share of the word's uses ends a sentence or another such response, or if it stands at such ends only and
    the responses differ. Shares don't depend on the log's size. Null and empty contents have no pairs.
    """
    answer = F.xxhash64(F.btrim("response", F.lit(" \t\r\n")))
    judged = cut(pairs(log).select("log_id", "component_id", "pair_no", "defect", "token", answer.alias("answer")).where("defect is not null"))
    key = ["log_id", "component_id", "pair_no"]
    sure = judged.where(F.col("defect") != "open").select(*key, "defect")
    unsure = judged.where(F.col("defect") == "open").drop("defect")
    last = unsure.groupBy("token").agg(F.count(F.lit(1)).alias("tails"), F.countDistinct(F.struct("log_id", "answer")).alias("logs"), F.countDistinct("answer").alias("answers"))
    uses = cut(last.join(word_places(log), "token", "left").fillna(0, ["ends", "inside"]))
    other = F.col("ends") + F.col("inside")
    known = other >= ELSEWHERE * (other + F.col("tails"))
    ends = F.col("ends") + F.col("tails") - 1 >= ENDING * (other + F.col("tails") - 1)
    whole = F.when(known, ends).otherwise(F.col("answers") <= DIFFERENT * F.col("logs"))
    short = split_join(unsure, uses.where(~whole).select("token"), ["token"], "inner", counts=uses.select("token", F.col("tails").alias("n"))).select(*key, F.lit("truncated").alias("defect"))
    return sure.unionByName(short).distinct()
