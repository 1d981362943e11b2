"""Docstrings for problem 1, written after the word lists of ``telling`` and never used for a change of them. Run as a
script, this prints recall and precision; README states them. Don't mend the lists by these: write new ones.

Each line is a function's name, its parameters and a docstring."""

TELLING = """
load_rows|path|Reads rows lazily; the file stays open until the last one.
merge|a,b|Left wins on equal keys.
close|self|Safe to call more than once.
retry|n|Backs off exponentially, at most a minute.
parse|text|Raises ValueError for dates before 1970.
to_json|obj|Keys are sorted so that digests agree.
rank|rows|Ties go to the older row.
send|mail|Drops mails larger than 10 MB.
hash_of|path|Streams the file in blocks of 64 kB.
start|self|Blocks until the port is open.
split|text|Keeps the separators.
size|self|In bytes, without the header.
next_id|self|Ids grow but may have gaps.
clean|rows|Removes rows whose owner is unknown.
wait|seconds|Polls every second.
find|key|None if the key was never written.
copy|src,dst|Doesn't follow links.
lock|name|Reentrant within a thread.
sum_up|rows|Uses Kahan summation to keep errors small.
token|user|Valid for one hour.
get_rate|day|Uses the rate of the day before on holidays.
set_limit|n|Takes effect with the next batch.
tick|self|Called by the scheduler, not by users.
encode|text|UTF-8, with surrogates replaced.
load|name|Lädt die Datei nur einmal und merkt sich das Ergebnis.
sperren|regal|Gibt False zurück, wenn schon jemand anders sperrt.
trier|lignes|Garde l'ordre des lignes égales.
fermer|self|Sans effet si le fichier est déjà fermé.
leer|ruta|Omite las líneas vacías.
contar|filas|Cuenta cada fila una sola vez.
читать|путь|Пропускает пустые строки.
закрыть|self|Ждёт завершения всех задач.
读取|路径|跳过空行并保留原有顺序。
排序|列表|相同的键保持原来的先后。
διάβασε|αρχείο|Παραλείπει τις κενές γραμμές.
apply|fn|Stops at the first error.
flush|self|Writes whatever is buffered, even half a record.
poll|self|Returns at once if nothing is ready.
bind|port|Port 0 picks a free one.
area|w,h|In square metres.
""".strip().split("\n")

EMPTY = """
load_rows|path|Load rows.
merge|a,b|Merges a and b.
close|self|Closes.
retry|n|TODO
parse|text|Parse the text.
to_json|obj|To JSON.
rank|rows|This function ranks rows.
send|mail|Sends the mail.
hash_of|path|Missing docstring.
start|self|FIXME: document me.
split|text|Docstring to be added.
size|self|:return: size
next_id|self|See base class.
clean|rows|noqa: D401
wait|seconds|Summary line.
find|key|Args:    key: key
copy|src,dst|Documentation pending.
lock|name|-----
sum_up|rows|A function.
token|user|Internal.
get_rate|day|Getter for rate.
set_limit|n|Setter of limit.
tick|self|Does the tick.
encode|text|Helper function.
load|name|Platzhalter.
sperren|regal|Noch zu dokumentieren.
trier|lignes|Documentation à venir.
leer|ruta|Pendiente de documentar.
читать|путь|Документация появится позже.
读取|路径|文档待补充
apply|fn|This method does something.
flush|self|Utility method.
poll|self|type: ignore
bind|port|Self explanatory.
area|w,h|Experimental.
run|self|Main entry point.
process|data|Process the data.
handle|event|Handles the given event.
init|self|Initialize.
update|self|Performs the update operation.
""".strip().split("\n")


def main() -> None:
    from quernel.llm.telling import telling

    def told(line: str) -> bool:
        name, parameters, doc = line.split("|")
        return telling(doc, name, tuple(parameters.split(",")))

    missed, wrong = [x for x in TELLING if not told(x)], [x for x in EMPTY if told(x)]
    hit = len(TELLING) - len(missed)
    print(f"recall {hit}/{len(TELLING)} = {hit / len(TELLING):.3f}, precision {hit}/{hit + len(wrong)} = {hit / (hit + len(wrong)):.3f}")
    print("missed", missed, "wrong", wrong, sep="\n")


if __name__ == "__main__":
    main()
