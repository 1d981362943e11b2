"""Four lists of texts for problem 4. The first was written after the messages and slots, gave a recall of 0.66 and a
precision of 0.93, and was then used to widen them; the second (0.67 and 0.98) and the third (0.51 and 1.00) were used
in the same way. The fourth was written after that and wasn't used for any change. Run as a script, this prints recall
and precision of all; README states those of the fourth. Don't mend the patterns by the fourth list: write a new one."""

RESIDUE = """
The server encountered an internal error and was unable to complete your request.
HTTP Status 404 – Not Found
This site can't be reached.
ERR_CONNECTION_TIMED_OUT
The connection was reset.
502 Bad Gateway
Error establishing a database connection
Your access to this site has been limited by the site owner.
You've been rate limited. Wait a few minutes before you try again.
Access to this resource on the server is denied!
Please verify you are a human
Enable JavaScript and cookies to continue
We're sorry but this app doesn't work properly without JavaScript enabled. Please enable it to continue.
You need to sign in to view this document.
Your login session has timed out, please log in again.
Too many login attempts, try again later.
Maintenance mode: we will be back shortly.
AttributeError: 'NoneType' object has no attribute 'split'
java.lang.NullPointerException at com.acme.Main.run(Main.java:14)
{"detail": "Authentication credentials were not provided."}
<html><body><h1>It works!</h1></body></html>
Lorem ipsum dolor sit amet, consectetur adipiscing elit.
Sed ut perspiciatis unde omnis iste natus error sit voluptatem.
TODO
TODO: write something useful here
[INSERT DESCRIPTION HERE]
[Your company name] keeps the tray.
Dear {{customer_name}}, the tray keeps rows.
Description goes here.
Add description here
To be written.
Summary pending.
N/A
???
Content unavailable
No description provided.
The description will be added later.
Write a short summary of this module.
Module description placeholder
As an AI language model, I cannot summarize this file.
I'm sorry, I can't help with that.
Please provide the code so I can summarize it.
Diese Seite benötigt JavaScript.
Diese Funktion ist derzeit nicht verfügbar, bitte versuchen Sie es später erneut.
Beschreibung folgt in Kürze.
Hier Beschreibung eintragen.
Cette page nécessite JavaScript pour fonctionner.
Description à compléter.
Une erreur est survenue, veuillez réessayer plus tard.
Esta página necesita JavaScript para funcionar.
Descripción pendiente.
Se ha producido un error inesperado.
Для работы сайта необходимо включить JavaScript.
Описание будет добавлено позже.
Произошла ошибка, попробуйте позже.
请开启 JavaScript 后再访问本页。
暂无描述
系统繁忙，请稍后再试。
Η σελίδα που ζητήσατε δεν βρέθηκε.
Η περιγραφή θα προστεθεί αργότερα.
The tray keeps ${project.name} rows.
Owner: <your name>
Keeps %(title)s rows open.
Keeps {user_name} rows open.
Blah blah blah
""".strip().split("\n")

ORDINARY = """
Handles 404 responses of the registry by asking the mirror.
Retries a request when the gateway answers 502 or 503.
Translates a NotFoundError into an empty list.
Raises PermissionError if the caller may not open the tray.
Checks whether JavaScript is enabled in the kiosk's browser and loads the plain form otherwise.
Renders the page shown while the site is under maintenance.
Signs the operator in again when the session has expired.
Limits each key to 500 requests a minute and rejects the rest.
Removes lorem ipsum passages from imported drafts before they are indexed.
Counts TODO comments per file and lists their owners.
Replaces each placeholder of a letter by the value of its field.
Fills missing descriptions with the first line of the docstring.
Writes the error page for unknown routes.
Maps exit codes of the solver to messages.
Parses a traceback and returns its last frame.
Not found keys are kept in a list and asked for again at night.
Access denied events are sent to the auditor.
Loading of large trays is split into pages.
Please note that rows without an owner are skipped.
Sorts empty trays before full ones.
No rows are returned for closed trays.
Missing values become zero.
Describes how a tray is opened, moved and closed.
Adds a summary line to each report.
Inserts the tray into the index and returns its place.
Test data is read from the shelf folder.
Returns None for an unknown tray.
Example: a tray of three rows gives three entries.
The tray could not be simpler: one list, two flags.
The model predicts how long a loan will stay open.
Sample rate and offset are stored beside each signal.
Service that keeps the index of all trays in memory.
Your changes are saved when the dialog closes.
Tracks which pages were moved and where they are now.
Verifies that tokens are neither missing nor expired.
Prüft, ob JavaScript aktiviert ist, und zeigt sonst die einfache Form.
Ergänzt fehlende Beschreibungen aus dem Kopf der Datei.
Zeigt die Fehlerseite, wenn ein Dienst nicht antwortet.
Vérifie que la page demandée existe et renvoie son titre.
Complète les descriptions manquantes à partir du fichier.
Comprueba si la sesión ha expirado y pide otra clave.
Devuelve el texto pendiente de cada página.
Проверяет, включён ли JavaScript, и показывает простую форму.
Возвращает описание модуля или пустую строку.
Обрабатывает ошибку 404 и перенаправляет на главную.
检查浏览器是否启用了 JavaScript，并据此选择表单。
处理待定请求并写入日志。
返回页面不存在时的默认内容。
Ελέγχει αν η σελίδα υπάρχει και επιστρέφει τον τίτλο.
Συμπληρώνει τα κενά πεδία από το αρχείο.
Formats dates as `{year}-{month}` for the shelf.
Reads `<name>` elements of the feed.
Matches the pattern [a-z]{2,4} against codes.
See the [summary](docs/summary.md) for the order of steps.
Returns a Map<String, List<Tray>> by owner.
Uses the temporary console command to list constant volumes.
Compares prices such as $5 and $7 per tray.
Blocks requests that exceed the quota of their team.
Generates a summary of each module with the model.
Serves index.html and the scripts of the viewer.
""".strip().split("\n")


SECOND_RESIDUE = """
You don't have permission to access / on this server.
HTTP ERROR 431
The requested URL was rejected. Please consult with your administrator.
Our systems have detected unusual traffic from your computer network.
The service you requested is temporarily overloaded.
504 Gateway Time-out
Connection timed out after 30 seconds.
Bad gateway: the upstream returned nothing.
Internal Server Error
Cloudflare is checking your connection.
This content isn't available right now.
This account has been suspended.
Please log in to your account to continue.
Your token has expired, please request a new one.
Quota exceeded for project 14.
KeyError: 'summary'
panic: runtime error: index out of range
Segmentation fault (core dumped)
error: unable to connect to the model
Scripts are disabled in this viewer, turn them on to see the text.
This form only works with JavaScript turned on.
You need a browser that supports JavaScript.
Dolor sit amet consectetur, elit sed do.
asdf asdf
FIXME: describe
TBA
<summary goes here>
[Insert summary]
{{TITLE}}
Text to be supplied by the owner.
Summary not available.
There is no description for this file.
Enter a brief description of the module here.
This is placeholder text.
Dummy text
The summary could not be produced because the model timed out.
I cannot access this file, so I cannot describe it.
Bitte JavaScript einschalten.
Zusammenfassung fehlt noch.
Platzhaltertext
Interner Serverfehler
Veuillez activer les cookies et JavaScript.
Résumé à rédiger.
Page introuvable
Debe habilitar JavaScript.
Resumen no disponible.
Página no encontrada
Включите JavaScript в браузере.
Текст появится позже.
Доступ запрещён.
请登录后查看。
待补充
此处插入说明。
Παρακαλώ ενεργοποιήστε τη JavaScript.
Κείμενο εδώ
Σφάλμα 404
Keeps #{module.title} rows.
Keeps @@OWNER@@ rows.
Maintained by [team name].
Keeps <project_name> open.
""".strip().split("\n")

SECOND_ORDINARY = """
Opens the sign-in window and waits for the operator's answer.
Collects server errors of the last hour into one mail.
Tells the caller to try again later when the queue is full.
Adds a retry header of 30 seconds to every 429 answer.
Loads scripts of a page only after its text.
Turns off cookies for guests.
Writes "not found" into the log when a tray is missing.
Catches TimeoutError and asks the next mirror.
Keeps a list of blocked requests for the auditor.
Sets the title of each page from its first heading.
Explains why a tray was refused.
Describes a tray by its owner, place and size.
The description of each tray is shortened to one line.
Text of a page is cut after 400 signs.
Summaries of closed trays are kept for a year.
The content is copied to the mirror every night.
Placeholder rows stand for trays that aren't delivered yet.
An empty list means that nothing is to be done.
To do lists are merged by their owner.
Please see the manual for the order of steps.
Sample rows are drawn by their hash.
Nothing is written when the tray is closed.
Redirecting rules are read from a file at start.
Loading order follows the names of the trays.
Server for the index of trays, started once a day.
Errors are counted by their code and sent to the board.
Session keys expire after one night.
Unknown error codes are shown as they are.
Your own trays stand first in the list.
We keep three copies of each tray.
Summary: counts rows by owner and prints them.
Error rates of all mirrors, by hour.
Access rules for trays, read at start and checked at every call.
None of the rows may be null.
Test for trays that were moved twice.
Pending trays are delivered first.
Missing owners are replaced by the team of the shelf.
Fills the form with the values of the last visit.
Inserts a blank between two words.
Writes a summary of the day into the log.
Lädt die Skripte der Seite erst nach dem Text.
Fehler 404 wird als leere Liste behandelt.
Bittet den Nutzer um eine neue Anmeldung.
Schreibt die Beschreibung der Datei in den Index.
Demande une nouvelle connexion quand la session expire.
Charge les scripts après le texte de la page.
Calcule le résumé de chaque page.
Escribe la descripción de cada página en el índice.
Cuenta los errores del servidor por hora.
Считает ошибки сервера за час.
Добавляет описание каждой страницы в указатель.
Проверяет доступ к полке.
统计每小时的服务器错误。
请求失败时重试三次。
写入每个模块的摘要。
Μετρά τα σφάλματα του διακομιστή ανά ώρα.
Γράφει την περιγραφή κάθε σελίδας.
Prints `${HOME}` and `{name}` as they are.
Returns at most $limit rows, or all.
Reads the [first](a.md) and the [second](b.md) page.
""".strip().split("\n")


THIRD_RESIDUE = """
Sorry, you have been blocked
The proxy server refused the connection.
503 Backend fetch failed
You are being redirected, hold on.
Your subscription has expired; renew it to read on.
Sign up to unlock this article.
Could not connect to the server.
Page not found (404)
This video is private.
RuntimeError: CUDA out of memory
fatal: not a git repository
Command failed with exit code 137
Max retries exceeded with url: /v1/summary
We use scripts here; allow them in your browser's settings.
To continue, switch on JavaScript.
Lorem dolor amet elit tempor.
qwerty
Summary: TBD
Details will follow.
[Describe the purpose of the module]
[company name] ships trays.
Text goes here
No description yet.
Nothing has been written here yet.
I am unable to summarise the file because it is empty.
The model returned no text.
Output truncated: token limit reached
Aktivieren Sie bitte JavaScript in Ihrem Browser.
Der Server antwortet nicht.
Noch keine Beschreibung vorhanden.
Le serveur ne répond pas.
Description manquante.
El servidor no responde.
Escriba aquí la descripción.
Сервер не отвечает.
Описание отсутствует.
服务器无响应，请稍后重试。
请在此处填写模块说明。
Ο διακομιστής δεν αποκρίνεται.
Keeps {{ name }} open.
Keeps %s open for ${DAY}.
""".strip().split("\n")

THIRD_ORDINARY = """
Refuses a connection when the proxy isn't known.
Redirects guests to the page of their shelf.
Shows a private tray only to its owner.
Runs a command and returns its exit code.
Counts retries per url and stops after five.
Switches scripts of a page on and off.
Follows the details of each tray.
Returns the purpose of a module as text.
Ships trays to the company that asked for them.
Cuts the output at the limit of tokens.
Says whether a model returned text.
Renews a subscription one day before it ends.
Reads an article and gives its first page.
Signs a letter with the key of its sender.
Nothing but the owner's name is kept.
The server keeps one copy of each tray.
Connects to the server and asks for the list.
A git folder is made for each shelf.
Memory of the solver is freed at the end.
Holds on to a tray until it is delivered.
Antwortet dem Server mit der Liste der Regale.
Prüft, ob eine Beschreibung vorhanden ist.
Répond au serveur avec la liste.
Responde al servidor con la lista.
Отвечает серверу списком полок.
检查服务器是否响应。
在列表中填写默认值。
Απαντά στον διακομιστή με τη λίστα.
Accepts dates as `{{ day }}` and `%d`.
The index [1] of a tray is never null.
""".strip().split("\n")


HELD_OUT_RESIDUE = """
Web server is down (error code 521).
Access from your country is not allowed.
This page isn't working right now.
The site is temporarily offline.
Request entity too large
HTTP 418
Your browser is not supported.
Our service is having problems, please come back later.
We could not verify your account.
You must accept cookies before you go on.
JavaScript appears to be switched off.
This viewer needs JavaScript.
Login failed: wrong password.
Subscribe to continue reading.
IndexError: list index out of range
Unhandled exception in worker 3.
curl: (7) Failed to connect to localhost port 8000
ssl certificate error
Model overloaded, retry later.
The request was aborted because it took too long.
No summary could be produced.
Summary not generated yet.
Description missing.
Add a one-line description.
Put your text here.
PLACEHOLDER
dummy
to be filled
[Add details]
[OWNER NAME]
<module description>
{{ module.description }}
${summary}
%(summary)s keeps rows.
Bitte Cookies zulassen und JavaScript aktivieren.
Inhalt wird nachgereicht.
Fehler beim Laden der Seite.
Impossible de charger la page.
Texte à insérer.
No se pudo cargar la página.
Sin descripción.
Не удалось загрузить страницу.
Заполните описание.
页面加载失败，请刷新重试。
请先启用浏览器的 JavaScript。
Δεν υπάρχει περιγραφή.
lorem ipsum dolor
""".strip().split("\n")

HELD_OUT_ORDINARY = """
Reports server errors above a given code.
Loads the page in a browser and counts its scripts.
Checks cookies and signs out users whose token is old.
Connects the viewer with the store and keeps retrying for a minute.
Failed builds are listed by their owner.
The request is split when it is too large.
Unhandled events go to a list that is read at night.
Your team's trays come first.
This module needs a lock while it writes.
Fills in missing owners from the list of teams.
Details of a tray are shown on a page of their own.
Adds a line with the owner to each page.
Puts the text of a tray into the index.
Empty descriptions are replaced by the name of the tray.
The summary of a module is written when all of its files are known.
Takes too long for more than ten trays.
Accepts passwords of at least ten signs.
Sends the mail again when the server is busy.
Model of a shelf with its trays.
Please the owner by sorting trays by date.
Zeigt Fehler beim Laden der Seite in einem Fenster an.
Zählt die Seiten eines Regals.
Charge la page et compte ses lignes.
Carga la página y cuenta sus filas.
Загружает страницу и считает строки.
刷新页面并重新加载列表。
Φορτώνει τη σελίδα και μετρά τις γραμμές.
Writes `{name}: {count}` per line.
Splits on `%` and `$`.
Keeps [a, b] and (c, d) apart.
""".strip().split("\n")


def main() -> None:
    from quernel.llm import residue

    masks = residue.Masks()

    def bad(text: str) -> bool:
        return residue.slotted(text) or any(m and residue.is_residue(m) for m in (masks.read(s)[1] for s in residue.sentences(text)))

    for name, residues, ordinary in (("used for changes", RESIDUE, ORDINARY), ("used later", SECOND_RESIDUE, SECOND_ORDINARY), ("used last", THIRD_RESIDUE, THIRD_ORDINARY), ("held out", HELD_OUT_RESIDUE, HELD_OUT_ORDINARY)):
        missed = [t for t in residues if not bad(t)]
        wrong = [t for t in ordinary if bad(t)]
        hit = len(residues) - len(missed)
        print(f"{name}: recall {hit}/{len(residues)} = {hit / len(residues):.3f}, precision {hit}/{hit + len(wrong)} = {hit / (hit + len(wrong)):.3f}")
        print("missed", missed, "wrong", wrong, sep="\n")


if __name__ == "__main__":
    main()
