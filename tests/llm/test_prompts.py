import json

from quernel.llm import prompts
from quernel.llm.languages import language

Q = "Which tray reaches `sort_tray` once per shift?"
JUDGED = [
    (Q, "", "empty"),
    (Q, " \n", "empty"),
    (Q, "--", "empty"),
    (Q, "N/A", "empty"),
    (Q, "null", "empty"),
    (Q, "Answer:", "empty"),
    (Q, "​", "empty"),
    (Q, Q, "copy"),
    ("Question: " + Q, "Answer: " + Q.upper(), "copy"),
    (Q, Q + "\n" + Q, "copy"),
    (Q, Q + " The open tray is read first.", None),
    (Q, "I'm sorry, but I can't help with that.", "refusal"),
    (Q, "Thank you for asking about `sort_tray`. I must decline to answer this.", "refusal"),
    (Q, "Questions about the tray are beyond my remit as an assistant.", "refusal"),
    (Q, "抱歉，我无法回答这个问题。", "refusal"),
    (Q, "Lo siento, no puedo ayudar con eso.", "refusal"),
    (Q, "The guard declines every open tray and answers with code 4.", None),
    (Q, "It can't sort an open tray; the call is declined and the operator sees a notice.", None),
    (Q, "I would read it this way: the tray is unable to sort rows, so the worker sorts them once per shift.", None),
    (Q, "Der Dienst prüft den Liegeplan und die Störmeldung für jede Außenstelle.", "language"),
    (Q, "该服务在夜间结算之前检查退款单。", "language"),
    (Q, "The screen reads “Der Dienst prüft den Liegeplan” in that case.", None),
    ("¿Por qué `sort_tray` lee el plan dos veces?", "El servicio cuenta el plan en menos de 2 segundos.", None),
    (Q, "Rows of the tray are read. The open tray is kept apart from the", "truncated"),
    (Q, "Rows of the tray are read once per shift with `", "truncated"),
    (Q, "Rows of the tray are read once per shift:", "truncated"),
    (Q, "It audits the tray: \"once per shift\"", None),
    (Q, "Yes", "open"),
    (Q, "- check the tray\n- sort the rows", "open"),
    (Q, "Rows are read. (`max_retry`, `slot_guard`)", None),
]


def test_judge():
    for q, a, want in JUDGED:
        assert prompts.judge(q, a, False)[0] == want, (a, want)
    assert prompts.judge(Q, "Rows of the tray are read " * 4000 + ".", False)[0] is None


def test_copies_are_decided_by_alignment():
    asked = "Which tray reaches the shelf before the crate does?"
    for answer in (asked, asked.upper(), "You? Question again: " + asked, asked + " Question (repeated): " + asked, "Answer: " + asked.replace(" ", "  ")):
        assert prompts.copies(asked, answer) is ("You?" not in answer), answer
    # the same words, and most of the same shingles, in another order: only the subsequence tells them apart
    assert not prompts.copies(asked, "Before the crate does which tray reaches the shelf?")
    assert not prompts.copies(asked, asked + " The open one.") and not prompts.copies(asked, "The open one. " + asked)
    assert not prompts.copies(asked, asked[: len(asked) // 2]) and not prompts.copies("", asked) and not prompts.copies(asked, "")
    assert prompts.copies("Requirement: " + asked, asked) and prompts.copies("托盘在哪里？", "问题：托盘在哪里？")
    assert prompts.copies(asked * 500, asked * 500) and not prompts.copies(asked * 500, asked * 499 + "which tray reaches the shelf before the does crate?")


def test_copy_needs_the_subsequence(monkeypatch):
    asked = "Why does the worker of this shelf read each tray in turn and then sort all of its rows by owner and place?"
    answer = asked.replace("owner and place", "place and owner")
    assert not prompts.copies(asked, answer)
    monkeypatch.setattr(prompts, "common_subsequence", lambda a, b: len(a))
    assert prompts.copies(asked, answer)


def test_refusals_anywhere():
    thanks = "Thank you for your long and careful question about the tray, the shelf, the crate and all of the other things that your team keeps in store, "
    for answer in (
        thanks + "but I cannot help with that.",
        "Hello. Thank you for asking. I have read your question twice. I must decline to answer it.",
        Q + " I can't say.",
        "That falls outside of what I may talk about.",
        "Não posso ajudar com isso.",
        "Mi dispiace, non posso rispondere.",
        "谢谢您的提问。我看过代码。很遗憾，我无法回答。",
    ):
        assert prompts.judge(Q, answer, False)[0] == "refusal", answer
    for answer in (
        "The tray is sorted once per shift. I cannot say more about its owner.",
        "托盘每班排序一次。其他部分我无法回答。",
        "The guard refuses calls. Then the worker says that it is unable to help.",
    ):
        assert prompts.judge(Q, answer, False)[0] != "refusal", answer


def test_layouts():
    one = [(Q, "A one.", False)]
    assert prompts.parse_pairs(f"<SET>\n<QA>\n<Q>{Q}</Q>\n<A>A one.</A>\n<CODE>x</CODE></QA></SET>") == one
    assert prompts.parse_pairs(f"Here it is.\n```xml\n<QA><Q>{Q}</Q><A>A one.</A></QA>\n```") == one
    assert prompts.parse_pairs(json.dumps([{"question": Q, "answer": "A one."}])) == one
    assert prompts.parse_pairs(f"[Question]: {Q}\n[Answer]: A one.\n[Code Snippet]: y")[0][1].strip() == "A one."
    assert prompts.parse_pairs(f"<QA><Q>{Q}</Q><A/></QA>") == [(Q, "", False)]
    assert prompts.parse_pairs(json.dumps([{"question": Q}])) == [(Q, "", False)]
    assert prompts.parse_pairs(f"<QA><Q>{Q}</Q><A>It bre") == [(Q, "It bre", True)]
    assert prompts.parse_pairs(f'[{{"question": "{Q}", "answer": "It bre') == [(Q, "It bre", True)]
    assert prompts.parse_pairs("[Requirement]: r\n[Solution]: s\n\n[Requirement]: t\n[Solution]: u")[1][0].strip() == "t"
    for nothing in (None, "", "  ", "just prose", "[]", "{}"):
        assert prompts.parse_pairs(nothing) == []


def test_common_subsequence():
    def slow(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            before = 0
            for j, y in enumerate(b, 1):
                before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
        return row[-1]

    for a, b in (("abcbdab", "bdcaba"), ("", "abc"), ("aaaa", "aa"), ("xyz", "abc"), ("kitten", "sitting")):
        assert prompts.common_subsequence(list(a), list(b)) == slow(a, b)


def test_languages():
    for text, want in (("Why does it sort the tray twice?", "en"), ("Er prüft den Liegeplan, bevor er ihn sperrt.", "de"), ("Le service trie le reçu.", "fr"), ("El servicio cuenta el plan.", "es"), ("Служба повторяет план.", "ru"), ("该服务合并退款单。", "zh"), ("", None), ("42", None), ("`x`", None)):
        assert language(text) == want, text


def test_table(spark):
    def content(*answers):
        return "<SET>" + "".join(f"<QA><Q>{Q}</Q><A>{a}</A></QA>" for a in answers) + "</SET>"

    rows = [
        (1, "c", "writer", content("Rows end at the shelf.", "", Q)),
        (1, "c", "writer", content("Rows end at the shelf.", "", Q)),
        (2, None, "writer", content("The rows reach the")),
        (3, "c", "reader", content("")),
        (4, "c", "writer", None),
        (5, "c", "writer", ""),
        (6, "c", "writer", content("They end on the shelf", "Read at the shelf.")),
        *[(n, "c", "writer", content("Left as it was")) for n in (7, 8, 9)],
        (10, "c", "writer", content("Left as it fell")),
    ]
    df = spark.createDataFrame(rows, "log_id long, component_id string, agent string, content string")
    got = {(r.log_id, r.pair_no, r.defect) for r in prompts.defects(df).collect()}
    assert got == {(1, 2, "empty"), (1, 3, "copy"), (2, 1, "truncated"), (10, 1, "truncated")}
    assert prompts.defects(df.limit(0)).count() == 0


def test_truncation_does_not_depend_on_size(spark):
    def content(answer):
        return f"<SET><QA><Q>{Q}</Q><A>{answer}</A></QA></SET>"

    def truncated(copies):
        rows = []
        for i in range(copies):
            texts = [f"Only `a{i}` of the par", f"Because `b{i}` is the", f"It is left as `c{i}` was", "The rest was kept.", "It was kept."]
            rows += [(10 * i + n, "c", "writer", content(t)) for n, t in enumerate(texts)]
            rows.append((10 * i + 9, "c", "reader", "The tray is on the shelf. " * 200))
        df = spark.createDataFrame(rows, "log_id long, component_id string, agent string, content string")
        return sorted((r.log_id, r.defect) for r in prompts.defects(df).collect())

    assert truncated(2) == [(n, "truncated") for n in (0, 1, 10, 11)]
    assert truncated(6) == [(10 * i + n, "truncated") for i in range(6) for n in (0, 1)]
