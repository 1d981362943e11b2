"""Pairs for problem 6, written after its word lists and templates and never used for a change of them. Run as a script,
this prints recall and precision; README states them. Don't mend the lists by these: write new ones.

One sound answer of several lines had fallen apart into three entries in the first run; it was made one line, which
changed the precision from 0.92 to 0.97.

The truncation of a single sentence is decided by the whole log and isn't measured here."""

ASKED = "Which shelf does `pick_tray` ask first when two are open?"
DEFECTIVE = """
empty|-
empty|n.a.
empty|(no answer)
empty|Nothing.
empty|"None"
empty|No response.
empty|…
empty|Not specified
empty|k. A.
empty|Sans objet
refusal|I'd rather leave that to your own team.
refusal|I'm unable to share details about this function.
refusal|This is something I can't get into.
refusal|As an assistant I have to stay out of questions about this code.
refusal|I am sorry. That isn't something I can help you with.
refusal|Regrettably, I must refrain from answering.
refusal|I won't answer that.
refusal|Answering this would go against my rules.
refusal|Thanks for the question! Sadly, I'm not permitted to talk about internals.
refusal|Dazu darf ich mich nicht äußern.
refusal|Diese Frage kann ich leider nicht beantworten.
refusal|Je ne peux malheureusement pas vous répondre.
refusal|Lo lamento, pero no puedo contestar.
refusal|Я не могу ответить на этот вопрос.
refusal|对不起，这个问题我不能回答。
refusal|Δεν μπορώ να απαντήσω σε αυτό.
copy|Which shelf does `pick_tray` ask first when two are open?
copy|WHICH SHELF DOES PICK_TRAY ASK FIRST WHEN TWO ARE OPEN
copy|Question: which shelf does `pick_tray` ask first, when two are open?
copy|Answer: Which shelf does `pick_tray` ask first when two are open? Which shelf does `pick_tray` ask first when two are open?
copy|**Which shelf does `pick_tray` ask first when two are open?**
truncated|It asks the older one. The newer one is asked only if the
truncated|The older one is asked first; then,
truncated|It asks the older one first (see
truncated|It asks `older_shelf(
truncated|The shelf with fewer trays. Ties go to the
truncated|It asks the older one and...
language|Zuerst wird das ältere Regal gefragt, danach das neuere.
language|Le rayon le plus ancien est interrogé en premier.
language|Primero pregunta al estante más antiguo.
language|Сначала спрашивают старую полку.
language|先询问较旧的货架。
language|Πρώτα ρωτά το παλαιότερο ράφι.
""".strip().split("\n")

SOUND = """
The older one.
It asks the older shelf first, then the newer one.
Neither: with two open shelves it raises an error.
The shelf with fewer trays; ties go to the older one.
It can't tell, so it asks both.
The function declines the call when two shelves are open.
None of them is asked before the lock is held.
`older_shelf`, as the code's comment says.
First the left, then the right one!
The code sorts shelves by age and takes the first: `min(open_shelves, key=age)`
I would say the older one, since the list is sorted by age.
We ask the older one; you can see it in line 4.
Which shelf is asked first depends on age: the older one.
Nothing is asked; the tray stays.
It answers "I can't help" to the caller and goes on.
The error text reads „Regal nicht gefunden“ in that case.
1. the older one
2. the newer one
It asks the older one (the newer one is asked later).
Age decides.
Yes, the older one.
""".strip().split("\n")


def main() -> None:
    from quernel.llm.prompts import judge

    wrong_kind = [(x, judge(ASKED, x.partition("|")[2], False)[0]) for x in DEFECTIVE if judge(ASKED, x.partition("|")[2], False)[0] != x.partition("|")[0]]
    wrong = [(x, d) for x in SOUND if (d := judge(ASKED, x, False)[0]) not in (None, "open")]
    hit = len(DEFECTIVE) - len(wrong_kind)
    given = hit + len(wrong) + sum(d not in (None, "open") for _, d in wrong_kind)
    print(f"recall {hit}/{len(DEFECTIVE)} = {hit / len(DEFECTIVE):.3f}, precision {hit}/{given} = {hit / given:.3f}")
    print("missed", wrong_kind, "wrong", wrong, sep="\n")


if __name__ == "__main__":
    main()
