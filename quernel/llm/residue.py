"""Problem 4: template residue, filler, error pages and notices instead of a summary."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

from quernel.operators.skew import split_join
from quernel.session import cut

#: First tokens that lead to a leaf of the prefix tree, below the number of tokens.
TREE_DEPTH = 2

# What servers, gateways, programs, sign-ins, fillers and script notices say, as sequences of tokens.
# ``a/b`` are alternatives, ``a_b`` two tokens, ``a?`` may be absent, ``a*`` any word that begins so, ``..`` up to six
# tokens, ``...`` any number, ``!a`` none of these follows, ``^`` and ``$`` a sentence's begin and end, ``;`` its end or a
# sign, ``0`` a number. Contractions are spelled out before.
MESSAGES = """
^ http? error/status/code? :? 0 :? not_found/forbidden/unauthorized/unauthorised/bad_gateway/bad_request/internal_server_error/internal_error/service_unavailable/service_temporarily_unavailable/gateway_timeout/gateway_time_out/too_many_requests/request_timeout/method_not_allowed/payment_required/this_page/page_not_found/the_server/error ;
^ http? error/status/code? :? 0 :? this_page/the_server/the_page ...
^ http? error/status code? :? 0 ;
^ error code :? 0 ;
^ the? requested url/page/resource/address .. returned .. error/0
^ the? requested url/page/resource/address .. was_not_found/could_not_be_found/can_not_be_found/is_not_available/does_not_exist
^ internal_server_error/bad_gateway/gateway_timeout/gateway_time_out/service_unavailable/service_temporarily_unavailable/not_found/page_not_found/forbidden/unauthorized/unauthorised/access_denied/access_is_denied/access_forbidden/access_is_forbidden/permission_denied/too_many_requests/request_timed_out/request_timeout/connection_refused/connection_reset/connection_reset_by_peer/connection_timed_out/server_error/network_error/site_not_found/server_not_found/bad_request ;
^ oops
^ %err ;
^ %h .. failed/failure/error/found/unavailable/refused/denied/forbidden/timeout/required/exceeded/gateway/request/allowed ;
^ http? error/status/code? :? %h ;
^ http? error/status/code? :? %h :? not_found/forbidden/unauthorized/unauthorised/bad_gateway/bad_request/internal_server_error/internal_error/service_unavailable/service_temporarily_unavailable/gateway_timeout/gateway_time_out/too_many_requests/request_timeout/method_not_allowed/payment_required/page_not_found/error ;
^ could_not/unable_to/failed_to connect/reach/resolve/open/load/fetch/access/read/find/authenticate/complete/process
^ the? .. server/proxy/gateway/host/backend/model/service did_not_respond/does_not_respond/is_not_responding/not_responding/refused_the/closed_the/reset_the
^ sorry? you have been/been_temporarily? blocked/banned/logged_out/signed_out/rate_limited/redirected
^ you are being/now? redirected/blocked/rate_limited/offline
^ you are not? signed_in/logged_in/online/connected
^ sign_up/subscribe/register/upgrade to see/view/continue/read/access/unlock
^ to continue/proceed/view/see/read .. enable/activate/turn_on/switch_on/allow/sign_in/log_in
^ this video/image/post/article/page/document/file is/was private/deleted/removed/unavailable/no_longer_available/not_available ;
^ fatal : !if/when/raised
^ warning : ... deprecated/failed/error ;
^ max/maximum retries/attempts exceeded
^ output/response/reply/answer/text was? truncated/cut_off/too_long/empty/blocked/filtered
^ token/context/output/rate/usage limit reached/exceeded/hit ;
^ command/process/job/task/build failed/exited/aborted/timed_out/was_killed with/after/:
^ no route to host
^ certificate has_expired/is_not_trusted/error
^ your connection is not_private/not_secure
^ der/die/das server/dienst/modell antwortet nicht
^ le/la serveur/service/modèle ne répond
^ el/la servidor/servicio/modelo no responde
^ il server/servizio non risponde
^ сервер/сервис/модель не отвечает
^ 连接超时/请求超时/网络超时/连接失败/请求失败 ;
服务器无响应/服务器未响应/服务器没有响应
^ ο διακομιστής δεν αποκρίνεται/ανταποκρίνεται
^ error : !if/when/raised/unless/where/for
^ connection timed out after 0
^ quota exceeded for
^ this page/site/content/form/account/app/application/website/viewer/document/feature/service/resource ... not_available/unavailable/suspended/disabled/restricted/removed/blocked/private/javascript/cookies/scripts ;
^ this page/site/content/form/account/app/application/website/viewer/document/feature/service/resource .. not_available/unavailable/suspended/disabled/restricted/javascript
^ the page/site/service/server/resource/content/url you requested
^ javascript/scripts/cookies are/is .. turn/enable/allow/activate/switch
^ the? server/service/gateway/proxy/application has? encountered/returned/responded_with/reported .. error
^ the? server/service/site/system is? currently/temporarily? busy/overloaded/unavailable/unreachable ;
^ error establishing/loading/fetching/retrieving/rendering/generating/connecting_to/processing ...
^ the? connection was/has_been reset/refused/closed/lost/interrupted/terminated ;
^ access to .. is/was/has_been denied/forbidden/restricted/limited/blocked ;
^ this/the/that site/page/server/address can_not be reached/displayed/opened/loaded ;
^ too many */~ attempts/requests
please try again
, try again later/soon/shortly ;
^ maintenance mode ;
^ java/javax/org/com/caused_by/*? */~? */~? %e at
^ sorry? we/you can_not/could_not/were_unable_to/are_unable_to find/load/reach/open/display/process/complete that/this/the/your page/site/content/server/request
^ the/this/that page/url/content/resource/site/website/document/link you_requested/you_have_requested/you_are_looking_for/you_were_looking_for/you_are_trying_to_reach/you_asked_for/requested/at_this_address? has_moved/has_been_moved/has_been_removed/no_longer_exists/does_not_exist/could_not_be_found/can_not_be_found/can_not_be_displayed/can_not_be_reached/can_not_be_opened/is_not_available/is_unavailable/was_not_found/is_temporarily_unavailable/is_temporarily_down/is_currently_unavailable ;
^ the/this page you_requested/you_are_looking_for/you_were_looking_for ...
^ the/this/our? site/website/server/service/system is? currently/temporarily? down/offline/closed/unavailable/undergoing/under for/due_to? scheduled/planned/routine? maintenance ;
^ we are currently/temporarily? down/offline/closed/undergoing/under .. maintenance
^ scheduled/planned? maintenance in_progress/under_way ;
^ we will be back soon/shortly/later
^ please? try again later/shortly/soon/in_a_few_minutes/in_a_moment/in_a_few_moments/in_0_minutes ;
^ upstream connect/request error/timeout
^ no healthy upstream
^ nginx/apache/cloudflare/openresty ;
^ nginx/apache 0
^ your request/connection/access/ip/address/account to_this_page/to_this_site/to_this_resource? was/has_been/is blocked/denied/refused/rejected/suspended/limited !when/if/unless/until
^ this/the? request/connection/access was/has_been blocked/denied/refused/rejected ;
^ your request could_not/can_not be processed/completed/understood/served
^ you do not have permission/access/the_right/authorization
^ you are not authorized/authorised/allowed to
^ you have been blocked/logged_out/signed_out/rate_limited
^ api? rate limit reached/exceeded/hit ;
^ api? rate limit reached/exceeded/hit for this/your
^ you have? exceeded/reached/hit your/the rate_limit/quota/usage_limit/limit/current_quota
^ quota exceeded ;
^ quota exceeded for this/your
^ retry after 0 s/sec/second/seconds/minute/minutes? ;
^ your login/user/browser/current? session has? expired/timed_out/ended
^ session has? expired/timed_out/ended ;
^ please? sign_in/log_in/login/signin/sign_on again/back_in ;
^ please? sign_in/log_in/login/signin/log_on again? to see/view/continue/read/access/proceed ;
^ please? sign_in/log_in/login/signin/log_on again? to see/view/read/access this/the/your/more
^ please sign_in/log_in/login/signin/log_on/authenticate
^ you must/need_to/have_to be? signed/logged/sign/log in
^ login/authentication/authorization/authorisation/sign_in is? required ;
^ login/authentication/authorization/authorisation/sign_in is? required to see/view/continue/read/access
^ invalid/missing/expired/incorrect api_key/token/credential/credentials/access_token/password ;
^ token missing_or_expired/missing/expired/invalid ;
^ checking your browser
^ please? verifying/verify/prove/confirm/checking that/if? you are a_human/human/not_a_robot
^ performing security check/verification ;
^ ddos protection by
^ just a moment ;
^ one moment please ;
^ complete the captcha
^ traceback most recent call last
^ %e : !if/when/raised/unless/where/in/on/for/whenever
^ file .. line 0
^ segmentation fault ;
^ fatal error ;
^ an? unexpected/unknown/internal/unhandled error/exception has? occurred ;
^ an error has? occurred ;
^ an error has? occurred while processing/loading/generating/handling your/this/the
^ something went wrong ;
^ something went wrong on/while/with our/your/loading
^ panic :
^ exception in thread
^ unhandled/uncaught exception ;
^ process/command exited/terminated/failed with code/status/exit_code/signal 0
^ killed/out_of_memory ;
^ %json
%code ... error/expired/missing/denied/unauthorized/unauthorised/forbidden/too_many/not_found/invalid/timeout/unavailable/internal
^ %markup
^ please enable/activate/turn_on/switch_on/allow/unblock javascript/java_script/scripts/script/cookies/js
^ enable/activate/turn_on/switch_on/allow javascript/java_script/scripts/cookies/js ;
^ enable/activate/turn_on/switch_on/allow javascript/java_script/scripts/cookies/js and/or cookies/javascript ;
^ enable/activate/turn_on/switch_on/allow javascript/java_script/scripts/cookies/js and/or? cookies? to view/see/continue/read/use/run/load/display/proceed/access
^ enable/activate/turn_on/switch_on/allow javascript/java_script/scripts/cookies/js and/or? cookies? in/on/for your/this
^ enable/activate/turn_on/switch_on/allow javascript/java_script/scripts/cookies/js and/then reload/refresh/try
^ you must/need_to/have_to/will_need_to/will_have_to/should enable/activate/turn_on/switch_on/allow javascript/java_script/scripts/cookies/js
^ you must/need_to/have_to have javascript/java_script/scripts/cookies/js enabled/turned_on/switched_on/active
^ this/the/our? site/page/app/application/website/content/form/viewer/service needs/requires/works_best_with/relies_on/depends_on/does_not_work_without/will_not_work_without javascript/java_script/scripts/cookies/js ;
^ this/the/our? site/page/app/application/website/content/form/viewer/service needs/requires javascript/java_script/scripts/cookies/js to_be? enabled/activated/turned_on/switched_on/to/and/in_your
^ this/the site/page/app/application/website/content is blank/empty without javascript/scripts
^ javascript/java_script/scripts/scripting/cookies/js is/are/must_be/has_to_be/have_to_be/needs_to_be/seems_to_be/appears_to_be required/needed/necessary/disabled/enabled/activated/turned_off/turned_on/off/switched_off/switched_on/blocked/not_enabled/not_available/not_supported ;
^ javascript/java_script/scripts/scripting/cookies/js is/are/must_be/has_to_be/have_to_be/needs_to_be/seems_to_be/appears_to_be required/needed/necessary/disabled/enabled/activated/turned_off/turned_on/off/switched_off/switched_on/blocked/not_enabled in your
^ javascript/java_script/scripts/scripting/cookies/js is/are/must_be/has_to_be/have_to_be required/needed/necessary/enabled/activated/turned_on/switched_on for this
^ javascript/java_script/scripts/scripting/cookies/js is/are/must_be/has_to_be/have_to_be required/needed/necessary/enabled/activated/turned_on/switched_on to view/see/use/continue/run/display/read/load
^ it looks_like/seems/appears that? your_browser? .. javascript/scripts/cookies .. disabled/off/blocked
^ we have detected/noticed that .. javascript/scripts/cookies
^ we_are? sorry ... javascript/scripts/cookies
^ please enable/allow/activate it/them
^ turn it/them on in your
^ turn it/them on and reload/refresh/try
^ allow/enable them/it and press/reload/refresh/try
^ allow/enable them/it in your browser
^ your browser has javascript/scripts/scripting/cookies disabled/turned_off/switched_off/blocked
^ your browser does_not/is_not/can_not support/run/running/supporting/execute/executing/have/allow ..
^ your browser is blocking/out_of_date/outdated/not_supported/too_old
^ a/an? javascript/script/cookie enabled/capable browser is needed/required/necessary
^ a/your browser with javascript/scripts/cookies enabled/support/turned_on is needed/required/necessary
^ without javascript/scripts this/the page/site/app/website/application/content
^ bitte ... javascript/cookies/skripte
bitte versuchen/versuche/warten ...
^ ein/es_ist_ein unerwarteter/interner? fehler ist? aufgetreten
.. derzeit/momentan/zurzeit/vorübergehend nicht verfügbar/erreichbar ;
^ bitte laden_sie/versuchen_sie/melden_sie/warten
^ aktivieren/schalten/erlauben sie? ... javascript/cookies/skripte
javascript/cookies/skripte ist/muss/wird/sind/müssen .. erforderlich/deaktiviert/aktiviert/benötigt/notwendig/ausgeschaltet/abgeschaltet/nötig werden/sein? $
^ diese/dieses/die? seite/website/webseite/anwendung/app/angebot benötigt/braucht/erfordert/verlangt javascript/cookies/skripte
^ ohne javascript/skripte kann/funktioniert/können/geht
^ veuillez ... javascript/cookies/scripts
veuillez réessayer/patienter/recharger
^ une erreur */~? */~? est_survenue/s_est_produite
^ erreur lors du/de
^ veuillez réessayer/patienter/vous_connecter/vous_reconnecter/vous_identifier
^ activez/activer/autorisez/autoriser/réactivez ... javascript/cookies/scripts ...
javascript/scripts/cookies est/doit/sont/doivent .. requis/désactivé/activé/nécessaire/désactivés/activés/nécessaires/obligatoire $
^ ce/cet/cette/le/la? site/page/application/contenu nécessite/requiert/exige/a_besoin .. javascript/cookies/scripts
^ por favor ... javascript/cookies
^ se_ha_producido/ha_ocurrido/se_produjo un error
inténtelo/inténtalo/intente/vuelva_a_intentarlo de_nuevo/nuevamente? más_tarde
^ si_è_verificato un errore
riprova/riprovare più_tardi
^ ocorreu um erro
tente novamente
debe/debes/tiene_que/hay_que habilitar/activar/permitir javascript/cookies
^ por favor inténtelo/inicie/espere/vuelva
^ active/activa/activar/habilite/habilita/habilitar/ative/ativar/ativa ... javascript/cookies
javascript/cookies está/debe/es/están/deben/deve/é .. desactivado/activado/necesario/requerido/obligatorio/habilitado/deshabilitado/desativado/ativado/necessário $
^ este/esta/esto/o/a? sitio/página/aplicación/site/aplicação/aplicativo requiere/necesita/precisa/requer/necessita .. javascript/cookies
^ questo/questa/il/la? sito/pagina/applicazione/contenuto richiede/necessita/ha_bisogno .. javascript/cookies
^ abilita/abilitare/abilitate/attiva/attivare/attivate ... javascript/cookies
javascript/cookies è/deve/sono .. disabilitato/disattivato/richiesto/necessario/abilitato/attivato/attivo $
^ schakel/zet javascript/cookies .. in/aan
javascript is .. uitgeschakeld/vereist/nodig $
^ włącz/proszę ... javascript
^ включите/разрешите/активируйте ... javascript/скрипты/cookies
^ пожалуйста ... javascript/скрипты/cookies/войдите/подождите/повторите
javascript/скрипты отключ*/выключ*/необходим*/должен/должны/требуется/заблокирован* ... $
^ для .. включите/необходим/требуется/нужен javascript/скрипты
^ для .. необходимо/нужно/требуется включить/разрешить? javascript/скрипты
^ произошла/возникла */~? ошибка
попробуйте/повторите .. позже/снова
^ требуется/необходим/нужен javascript
请 .. 启用/开启/打开/允许 .. javascript/脚本
^ 启用/开启/打开/需要 javascript ;
需要 启用/开启/打开/支持 javascript
javascript 已? 被? 禁用/关闭/未启用
您的浏览器/你的浏览器 ... javascript
javascript .. 您的浏览器/你的浏览器
javascript を? 有効/オン/が必要/が無効
^ ενεργοποιήστε ... javascript/cookies
^ παρακαλώ ...
javascript είναι/πρέπει .. απαραίτητη/απενεργοποιημένη/ενεργοποιημένη/απαραίτητο/ενεργοποιηθεί $
^ αυτή/η σελίδα/ιστοσελίδα/εφαρμογή απαιτεί/χρειάζεται javascript/cookies
^ seite nicht gefunden ;
^ die/diese seite .. nicht_gefunden/existiert_nicht/nicht_verfügbar/nicht_erreichbar
^ zugriff verweigert ;
^ interner serverfehler ;
^ dienst nicht verfügbar ;
^ ihre? sitzung ist? abgelaufen
^ melden sie sich .. an
^ fehler 0 ;
^ bitte warten ;
^ page introuvable/non_trouvée ;
^ cette/la page .. existe/introuvable
^ accès refusé/interdit ;
^ erreur interne/0/du_serveur ;
^ service indisponible ;
^ votre session a? expiré
^ session expirée ;
^ connectez/reconnectez/identifiez vous
^ página no encontrada ;
^ página não encontrada ;
^ pagina non trovata ;
^ la/esta página .. no_existe/no_se_encuentra/no_encontrada/no_está_disponible
^ acceso denegado/prohibido ;
^ acesso negado ;
^ accesso negato ;
^ error interno/0/del_servidor ;
^ erro/errore 0/interno ;
^ su/la/tu/sua/a sesión/sessão ha? expir*/caduc*
^ inicie/inicia sesión
^ servicio no disponible ;
^ страница не найдена ;
^ доступ запрещён/запрещен/закрыт ;
^ ошибка 0/сервера ;
^ внутренняя ошибка ;
^ сервис/сервер временно? недоступен ;
^ ваша? сессия истекла/завершена
^ войдите ...
^ 页面不存在/页面未找到/页面找不到/找不到页面/访问被拒绝/拒绝访问/服务器错误/服务器内部错误/会话已过期/会话过期/网络错误/网络异常/加载失败/系统繁忙/系统错误/权限不足 ;
抱歉 ... 页面不存在/找不到/无法访问/不存在
您访问的页面不存在/您访问的页面/您请求的页面/系统繁忙/服务器繁忙/请先登录/请重新登录/请登录/请稍后再试/请稍候再试/请稍后重试/服务不可用/ページが見つかりません/アクセスが拒否
^ παρουσιάστηκε/προέκυψε .. σφάλμα
προσπαθήστε ξανά/αργότερα
^ η σελίδα .. δεν_βρέθηκε/δεν_υπάρχει
^ η σελίδα δεν βρέθηκε/υπάρχει
^ δεν επιτρέπεται η πρόσβαση
^ σφάλμα διακομιστή/0
^ η σύνδεση/συνεδρία έληξε/απορρίφθηκε
^ loading/processing/redirecting content/page/data/text/summary? please_wait? $
^ please wait ;
^ please wait while
^ veuillez patienter ;
^ chargement en_cours? ;
^ espere por_favor? ;
^ cargando/laden/загрузка/подождите/加载中/正在加载/请稍候/読み込み中/φόρτωση/caricamento/carregando $
^ wird geladen $
"""
STAND_INS = """
^ lorem ipsum
lorem ipsum dolor
dolor sit amet
^ xxx/yyy/zzz/foo/bar/asdf/qwerty/blah/bla/test xxx/yyy/zzz/foo/bar/baz/qux/asdf/qwerty/blah/bla/test? xxx/yyy/zzz/foo/bar/baz/qux/asdf/qwerty/blah/bla/test? xxx/yyy/zzz/foo/bar/baz/qux/asdf/qwerty/blah/bla/test? $
^ summary/description/text/purpose/title/name/module/file/function : tbd/tba/tbc/todo/fixme/none/null/n_a/xxx/pending/missing/empty ;
^ nothing has_been/was/is written/added/recorded/provided/available/known here/yet? yet? ;
^ there is nothing here/yet/to_show
^ the? model/service/assistant returned/gave/produced/sent no/an_empty/nothing text/output/answer/summary/response/reply? ;
^ noch keine/kein beschreibung/zusammenfassung/text/inhalt vorhanden/verfügbar/hinterlegt? ;
^ description/résumé/texte/documentation manquante/manquant/absente/absent ;
^ falta/faltan la/el/una/un? descripción/resumen/texto ;
^ tbd/tba/tbc/todo/fixme/none/null/undefined/nan/wip ;
^ n a $
^ coming soon ;
^ to be done/written/added/defined/completed/determined/announced/documented/decided/filled_in/confirmed/supplied/provided later/soon? ;
^ work in progress ;
^ under construction ;
^ more? details/information/description/summary/text/documentation to_follow/to_come/coming_soon/will_follow/follows/follow later/soon? ;
^ placeholder text/summary/description/content? ;
^ placeholder for the/a/this/your? summary/description/text/content/documentation
^ this is? just/only? a/an/some? placeholder/filler/dummy/sample/example text/summary/description/content? ;
^ sample/example/dummy/filler/boilerplate summary/text/description/content ;
^ module/file/function/class/component? description/summary/text placeholder ;
^ a/the/this? file/module/function? summary/description/text/content/documentation will_be/is_to_be/has_yet_to_be/is_yet_to_be/needs_to_be/should_be/must_be added/written/provided/completed/filled_in/supplied/generated ;
^ a/the/this? file/module/function? summary/description/text/content/documentation will_be/is_to_be/has_yet_to_be/is_yet_to_be/needs_to_be/should_be/must_be added/written/provided/completed/filled_in/supplied/generated later/soon/here/once
^ please provide/share/paste/send/upload
^ text/summary/description/content/documentation to_be supplied/written/added/provided/defined/done/completed
^ there is no summary/description/documentation/text for/here/yet/available/of ..
^ enter/insert/write/provide/type a/an/the/your? short/brief/concise? description/summary/text ... here/below ;
^ replace this/the text/summary/line/placeholder/description/paragraph
^ replace me/with_your/before_release ;
^ summary/text/description/content/title/your_text/your_summary/your_description/documentation goes/comes/to_go/will_go/belongs/will_be_added/will_be_written/will_appear here/later/soon? ;
^ your summary/description/text/content here ;
^ insert/enter/add/write/put/type/provide/paste/supply/fill_in/describe the/a/an/your/some/this? */~/0? */~/0? */~/0? summary/description/text/content/name/title/module/file/function? here/below ;
^ insert/enter/add/write/put/type/provide/paste/supply/fill_in the/a/an/your? short/brief/one_line/concise/meaningful? summary/description/overview/text/documentation ;
^ insert/enter/write/provide/supply a/an/your/the? short/brief/one_line/concise/meaningful? summary/description/overview/documentation of/for this/the module/file/function/class/component/method ;
^ describe the/this/your module/file/function/class/component/method/purpose/purpose_of_this_module/purpose_of_this_file/purpose_of_this_function ;
^ describe what this/the module/file/function/class/component/method does ;
^ summarise/summarize the/this/your module/file/function/class/component/method ;
^ explain/state/list what/how/why this/the module/file/function/class/component/method
^ fill/fill_in this/me/in ;
^ a/the/this? file/module/function? summary/description/text/content/documentation/output could_not/can_not/was_not/has_not/has_not_yet be/been? generated/created/written/produced/loaded/retrieved/found/provided/added/supplied
^ a/the/this/your? file/module/function? summary/description/text/content/documentation is? missing/unavailable/not_available/not_yet_available/not_yet_written/not_written_yet/pending/empty/to_follow/follows ;
^ no/missing file/module/function/class/method/page? summary/description/output/content/text/documentation/data/response/answer/docstring is/was? available/provided/yet/generated/given/found/here/exists/written? yet/here/for_this_file/for_this_module/for_this_function? ;
^ nothing to_see_here/here/here_yet/yet ;
^ no_output/empty/blank/not_available/unavailable/no_answer/no_response/not_yet_written/not_yet_documented/not_documented/yet_to_be_written/to_do ;
^ the? model did_not/could_not/failed_to answer/respond/produce/generate/return
^ failed/unable to generate/create/produce/write/load/fetch/retrieve a/the/this? file/module/function? summary/description/documentation ;
^ summary/description/text generation failed
^ as an ai language_model/model/assistant
^ i am sorry
^ i can_not/am_unable_to/am_not_able_to/could_not summarise/summarize/describe/help/answer/generate/provide/access
^ text/beschreibung/zusammenfassung/inhalt/dokumentation folgt/fehlt/kommt_noch/steht_noch_aus/wird_noch_ergänzt/wird_ergänzt/wird_nachgereicht/noch_nicht_vorhanden/nicht_verfügbar/nicht_vorhanden/ausstehend in_kürze/später? ;
^ hier text/beschreibung/zusammenfassung/inhalt/kurz? .. einfügen/eintragen/ergänzen/eingeben/beschreiben ;
^ text/beschreibung/zusammenfassung/inhalt hier? bitte? einfügen/eintragen/ergänzen/eingeben ;
^ hier einfügen/eintragen/ergänzen ;
^ bitte ergänzen/ausfüllen/eintragen/einfügen/beschreiben ;
^ zusammenfassung/beschreibung/text/inhalt fehlt/folgt noch ;
^ platzhalter text/für? ;
^ platzhaltertext/blindtext/mustertext/beispieltext ;
^ wird noch? ergänzt/nachgereicht/beschrieben ;
^ keine zusammenfassung/beschreibung/angabe/angaben vorhanden/verfügbar/angegeben? ;
^ noch nicht beschrieben/dokumentiert/ausgefüllt/vorhanden ;
^ in arbeit/bearbeitung/kürze ;
^ texte/résumé/description/contenu à_venir/à_compléter/à_rédiger/à_insérer/manquant/manquante/indisponible/non_disponible ;
^ insérer/insérez/saisir/saisissez/ajouter/ajoutez/rédigez/décrivez le/la/un/une/ici/votre/ce/cette .. résumé/description/texte/ici/contenu/module/fichier ;
^ insérer/insérez/saisissez ici ;
^ pas_de/aucun/aucune résumé/description/texte/contenu disponible/fourni/fournie? ;
^ à compléter/venir/rédiger/faire/définir ;
^ texte/résumé de_remplacement/manquant/d_exemple ;
^ en cours de rédaction ;
^ remplacer/remplacez ce texte/résumé
^ texto/resumen/descripción/contenido pendiente/por_escribir/por_completar/por_añadir/de_relleno/de_ejemplo/próximamente/no_disponible de_redacción? ;
^ insertar/inserte/inserta/escriba/escribir/escribe/añadir/añada/introduzca/describa aquí/texto/el/la/un/una/su/este/esta .. resumen/descripción/texto/aquí/contenido/módulo/archivo? ;
^ sin/no_hay resumen/descripción/contenido disponible? ;
^ por completar/definir/escribir/hacer/rellenar ;
^ pendiente de redacción/escribir/completar? ;
^ próximamente/en_construcción ;
^ inserire/inserisci/scrivere/aggiungere qui/il/la/un/una .. riepilogo/descrizione/testo/qui ;
^ testo/descrizione/riepilogo in_arrivo/mancante/segnaposto/da_completare/da_scrivere ;
^ nessuna/nessun descrizione/riepilogo/testo disponibile? ;
^ inserir/insira/escreva/adicionar aqui/o/a/um/uma .. resumo/descrição/texto/aqui ;
^ texto/descrição/resumo pendente/em_breve/a_definir/por_escrever/indisponível ;
^ sem descrição/resumo ;
^ текст/описание/содержание/резюме/сводка будет/позже/отсутствует/появится/следует/недоступно/будут/не_заполнено .. ;
^ вставьте/введите/добавьте/заполните/опишите .. описание/текст/здесь/сюда/резюме/модуль/файл/сводку
^ нет/без описания/текста/резюме/содержания ;
^ описание/текст/резюме отсутствует/недоступно ;
^ заполнить/дополнить позже? ;
^ здесь будет/должно ..
^ заглушка/в_разработке/скоро_будет ;
此处填写/此处插入/此处输入/此处添加/在此添加/在此填写/在此输入/在此插入/这里填写/这里输入/请在此/填写摘要/填写说明/填写描述/请填写/待补充/待填写/待完善/暂无摘要/暂无说明/暂无描述/暂无内容/占位符/占位文本/示例文本/摘要待/摘要将/摘要生成失败/无法生成/稍后补充/敬请期待/説明を入力/準備中
待定/待续/未完成 $
^ το? κείμενο/περιγραφή/περίληψη ακολουθεί/λείπει/εκκρεμεί/εδώ/θα_προστεθεί/θα_ακολουθήσει/δεν_υπάρχει/δεν_είναι_διαθέσιμη ;
^ η περιγραφή/περίληψη ακολουθεί/λείπει/εκκρεμεί/θα_προστεθεί/θα_ακολουθήσει/δεν_είναι_διαθέσιμη
^ συμπληρώστε/εισάγετε/γράψτε .. περιγραφή/περίληψη/κείμενο/εδώ/εδω
^ δεν υπάρχει περιγραφή/περίληψη/κείμενο ;
^ σύντομα/υπό_κατασκευή ;
"""
# Words that speak to the reader or of the speaker, and what messages speak to them about. Texts about
# code do neither at once.
SPEECH = frozenset("you your yours please we our i sorry bitte ihr ihre ihren ihrem veuillez vous votre vos пожалуйста вы вам ваш ваша ваше ваши 您 您的 请 请您 παρακαλώ σας".split())
TOPICS = frozenset(
    "javascript cookies browser url administrator traffic captcha robot token session login password account permission connection network suspended overloaded rejected expired unavailable summarise summarize describe"
    " navigateur navegador браузер браузере 浏览器 konto compte cuenta аккаунт sitzung anmeldung".split()
)

# Signs of templates that aren't filled in. Code between backticks is left out before.
SLOTS = [
    r"\{\{(?:(?!\{\{|\}\})[\s\S])*\}\}",
    r"\{%(?:(?!\{%|%\})[\s\S])*%\}",
    r"<%(?:(?!<%|%>)[\s\S])*%>",
    r"\[%[^%\n]+%\]",
    r"[$#]\{[^{}\n]*\}",
    r"\{[A-Za-z_][\w.]*(?:![rsaRSA])?(?::[^{}\n]*)?\}",
    r"\{[A-Za-z]+(?:[ -][A-Za-z]+){1,4}\}",
    r"(?<![\w\\)\]}.*+?|])\{\d{1,2}\}(?![\w(\[])",
    r"%\([A-Za-z_]\w*\)[sdifrSDIFR]",
    r"(?<![\w%])%[sdSD](?!\w)",
    r"(?<![\w$])\$[A-Za-z_]+(?:[._][A-Za-z_]+)*\$(?!\w)",
    r"@@[\w.]+@@",
    r"(?<![\w`])__[A-Z][A-Z0-9_]*[A-Z0-9]__(?!\w)",
    r"<<[^<>\n]{2,}>>",
    r"(?<![\w>)\]`])<(?i:[a-z]+(?:[_.][a-z_]+)+|(?:domain|project|summary|name|title|author|date|owner|module|team|value|text|description|placeholder|company|email|beschreibung|zusammenfassung|titel|autor|datum|eigentümer|résumé|texte|titre|auteur|resumen|descripción|texto|título|riassunto|descrizione|resumo|descrição|описание|резюме|текст|название|автор|дата|имя|περιγραφή|περίληψη|κείμενο|όνομα|摘要|说明|描述|名称|模块名|作者|日期|(?:your|module|file|function|class|project|company|team|owner)[ _-][\w -]+))>(?![^<]*</)",
    r"<(?i:insert|enter|add|describe|your|todo|tbd|fill|no output|empty|placeholder|replace|write|hier|bitte|insérer|insérez|ajouter|insertar|inserte|escriba|inserire|inserir|вставьте|введите|здесь|εισάγετε|συμπληρώστε|填写|请|在此|此处)(?![\w-])[^<>\n]*>",
    r"\[(?i:insert|enter|add|describe|your|todo|tbd|fill|placeholder|replace|write|put|explain|list|state|summari[sz]e|hier|bitte|insérer|insérez|ajouter|à compléter|insertar|inserte|escriba|aquí|inserire|inserir|insira|вставьте|введите|заполните|здесь|εισάγετε|συμπληρώστε)\b[^\[\]]*\](?!\()",
    r"[\[【](?:请|在此|此处|填写|输入)[^\[\]【】]*[\]】]",
    r"【(?:[^【】]{0,6}(?:摘要|说明|描述|名称|姓名|日期|标题|内容|作者))】",
    r"\[(?i:name|phone|email|e-mail|date|title|author|address|company|owner|team|summary|description|version|module|project|url|link|number|city|contact|(?:module|file|function|class|project|company|team|owner|your|author)[ _-](?:name|title|summary|description|text|purpose|email|id))\](?!\()",
    r"\[[A-Z]{2,}(?:[ _-][A-Z]{2,})+\](?!\()",
    r"[\[(<](?i:(?:no|missing) (?:\w+ )?(?:summary|description|output|content|text)|(?:\w+ ){0,2}(?:summary|description|content|text|output) (?:unavailable|missing|pending|not available|goes here|here))[\])>]",
]
_SLOT = re.compile("|".join(f"(?:{s})" for s in SLOTS))
#: Every slot has one of these; most texts have none.
_LETTER = re.compile(r"[^\W_]")
_MARKS = re.compile(r"[?.…*_~/#-]")
_GATE = re.compile(r"[{<\[【%@$(]|__")
CODE = re.compile(r"```[\s\S]*?```|`[^`\n]*`")

# Words of the usual filler text, and short words of Latin.
FILLER = "lorem ipsum dolor amet consectetur adipiscing elit eiusmod tempor incididunt labore dolore magna aliqua enim minim veniam quis nostrud exercitation ullamco laboris nisi aliquip commodo consequat duis aute irure reprehenderit voluptate velit esse cillum fugiat nulla pariatur excepteur sint occaecat cupidatat proident sunt culpa officia deserunt mollit anim laborum".split()
FILLER += "perspiciatis unde omnis iste natus voluptatem accusantium doloremque laudantium totam aperiam eaque ipsa quae inventore veritatis quasi architecto beatae vitae dicta explicabo nemo ipsam quia voluptas aspernatur fugit consequuntur magni dolores ratione sequi nesciunt neque porro quisquam dolorem numquam eius modi tempora incidunt magnam quaerat".split()
LATIN = frozenset("sit sed ut et ad ex ea eu in id qui non do".split())
_FILLER = frozenset(FILLER)
_BEGINNINGS = frozenset(w[:4] for w in FILLER)
#: Beginnings of filler words that no common word of another language has.
_RARE = frozenset("lore ipsu adip eius incid ulla aliqu cupid occae".split())


def filler_class(word: str) -> str:
    """``%L`` for a word of the filler text or one a single letter away from it, ``%l`` for one that only begins like it."""
    if len(word) < 4:
        return "%l" if word in LATIN else ""
    if word in _FILLER or any(word.startswith(r) for r in _RARE):
        return "%L"
    if any(word[:i] + word[i + 1 :] in _FILLER or any(word[:i] + c + word[i + 1 :] in _FILLER for c in "aeiou") for i in range(len(word))):
        return "%L"
    return "%l" if word[:4] in _BEGINNINGS else ""


def _parts(line: str) -> list[str]:
    return [a.removesuffix("*") for p in line.split() if p not in ("^", "$", ";", "..", "...") for q in p.lstrip("!").removesuffix("?").split("/") if q not in ("*", "~", "0") for a in q.split("_")]


_LINES = [x for x in (MESSAGES + STAND_INS).split("\n") if x]
#: The words that can decide a verdict. They stand for themselves in every template.
LEXICON = SPEECH | TOPICS | frozenset(w for x in _LINES for w in _parts(x) if w[0] not in "%:,")
_STEMS = tuple(sorted({q[:-1] for x in _LINES for p in x.split() for q in p.split("/") if q.endswith("*") and len(q) > 1}))
_HAN = "㐀-鿿぀-ヿ"
_HAN_WORDS = "|".join(sorted((w for w in LEXICON if re.match(f"[{_HAN}]", w)), key=lambda w: (-len(w), w)))


#: The filler class of each word that may stand for itself.
_LITERALS = {w: filler_class(w) for w in LEXICON}


def _expression(line: str) -> str:
    """A message of tokens as a regular expression over tokens that are each followed by a blank."""
    out, fixed = "", {"^": "^", "$": "(?:[,:] )*$", ";": "(?=[,:] |$)", "..": "(?:\\S+ ){0,6}?", "...": "(?:\\S+ )*?"}
    for p in line.split():
        if p in fixed:
            out += fixed[p]
            continue
        choices = []
        for q in p.lstrip("!").removesuffix("?").split("/"):
            words = [re.escape(a[:-1]) + "\\S* " if len(a) > 1 and a.endswith("*") else "(?:0|%h) " if a == "0" else re.escape(a) + " " for a in q.split("_")]
            choices.append("(?:, )*".join(words))
        any_ = "(?:" + "|".join(choices) + ")"
        out += f"(?!{any_})" if p[0] == "!" else (f"(?:(?:, )*{any_})?" if p.endswith("?") else f"(?:, )*{any_}")
    return out


def _begins(line: str) -> set[str]:
    """The tokens that a message at a sentence's begin may begin with; ``*`` if any may."""
    found: set[str] = set()
    for p in line.split()[1:]:
        words = [q.split("_")[0] for q in p.removesuffix("?").split("/")]
        if p in ("$", ";", "..", "...") or p[0] == "!" or any(w[-1:] in ("*", "~") for w in words):
            return {"*"}
        found |= {m for w in words for m in (("0", "%h") if w == "0" else (w,))}
        if not p.endswith("?"):
            return found
    return {"*"}


def _by_begin() -> dict[str, re.Pattern]:
    groups: dict[str, list[str]] = {}
    for x in _LINES:
        if x[0] == "^":
            for begin in _begins(x):
                groups.setdefault(begin, []).append(f"(?:{_expression(x)[1:]})")
    return {begin: re.compile("|".join(group)) for begin, group in groups.items()}


#: A message that may stand anywhere needs one of these tokens.
_SOMEWHERE = frozenset(b for x in _LINES if x[0] != "^" for b in _begins("^ " + x.removeprefix(".. ")))
#: Messages at a sentence's begin, by its first token; those under ``*`` may begin with any.
_ANCHORED = _by_begin()
_ANYWHERE = re.compile("(?:^|(?<= ))(?:" + "|".join(f"(?:{_expression(x)})" for x in _LINES if x[0] != "^") + ")")
_TOKEN = re.compile(
    r"(?P<markup></?(?:!doctype|html|head|body|title|noscript|center|meta|script|hr|h\d)\b[^>]*>?)|(?P<json>\{\s*[\"'](?:errors?|message|detail|fault)[\"']\s*:)|(?P<code>\{\s*[\"'](?:code|status|title)[\"']\s*:)"
    rf"|(?P<han>{_HAN_WORDS})|(?P<run>(?:(?!{_HAN_WORDS})[{_HAN}])+)|(?P<word>[^\W{_HAN}]+)|:|(?P<sign>[,;()|…\[\]{{}}<>，、；（）]|(?<=\s)[-–—](?=\s))"
)
# How contractions are spelled out.
CONTRACTIONS = [("cannot", "can not"), ("can't", "can not"), ("won't", "will not"), ("n't", " not"), ("'re", " are"), ("'ll", " will"), ("'ve", " have"), ("i'm", "i am"), ("it's", "it is")]
_SENTENCE = re.compile(r"(?<=[.!?])\s+|(?<=[。！？])|[\r\n]+")


def sentences(text: str) -> list[str]:
    """The distinct sentences and lines of ``text``, lower case, code as one word."""
    parts = _SENTENCE.split(CODE.sub(" kode ", text).lower().replace("’", "'"))
    return list(dict.fromkeys(s for s in (p.strip() for p in parts) if s))


def slotted(text: str) -> bool:
    """True if ``text`` has an unfilled slot outside code, or is nothing but signs."""
    if not _LETTER.search(text):
        return bool(_MARKS.search(text))
    return bool(_GATE.search(text)) and bool(_SLOT.search(CODE.sub(" ", text)))


#: Codes of failed requests.
_HTTP = re.compile("[45][0-9]{2}")


class Masks:
    """The mask of each token: a word that can decide a verdict, its class, or a wildcard. Remembers what it has seen."""

    LIMIT = 200_000

    def __init__(self) -> None:
        self.known: dict[str, str] = {}

    def word(self, w: str) -> str:
        if (found := self.known.get(w)) is None:
            if len(self.known) >= self.LIMIT:
                self.known.clear()
            found = self.known[w] = self._mask(w)
        return found

    @staticmethod
    def _mask(w: str) -> str:
        if "_" in w:
            return "%err" if w.startswith("err_") else "*"
        if re.search(r"\d", w):
            return "%h" if _HTTP.fullmatch(w) else "0"
        if w in LEXICON or w.startswith(_STEMS):
            return w
        if len(w) > 6 and w.endswith(("error", "exception")):
            return "%e"
        return filler_class(w) or ("*" if len(w) > 3 else "~")

    def read(self, line: str) -> tuple[list[str], list[str]]:
        """The tokens of a sentence and their masks; signs at both ends don't count."""
        if "'" in line:
            for short, long in CONTRACTIONS:
                line = line.replace(short, long)
        tokens, masks = [], []
        for m in _TOKEN.finditer(line):
            kind, token = m.lastgroup, m[0]
            tokens.append("," if kind == "sign" else token)
            masks.append(self.word(token) if kind == "word" else token if kind == "han" or kind is None else "*" if kind == "run" else "," if kind == "sign" else f"%{kind}")
        start, end = 0, len(tokens)
        while start < end and tokens[start] == ",":
            start += 1
        while end > start and tokens[end - 1] == ",":
            end -= 1
        return tokens[start:end], masks[start:end]


def is_residue(masks: list[str]) -> bool:
    """True if the template whose tokens have these masks is a message, a stand-in or filler. As a word that isn't in the
    masks can't decide, all sentences of a template have its verdict."""
    line = "".join(m + " " for m in masks)
    own = _ANCHORED.get(masks[0]) if masks[0] != "*" else None
    if own and own.match(line) or _ANCHORED["*"].match(line) or not _SOMEWHERE.isdisjoint(masks) and _ANYWHERE.search(line):
        return True
    if not SPEECH.isdisjoint(masks) and not TOPICS.isdisjoint(masks):
        return True
    words = [m for m in masks if m[0] == "%" or m == "*" or m[0].isalpha() and len(m) > 3]
    classes = [m if m[0] == "%" else _LITERALS.get(m, "") for m in words]
    strong, weak = classes.count("%L"), classes.count("%l")
    return strong >= 2 and strong + weak >= 3 and 2 * (strong + weak) >= len(words)


class PrefixTree:
    """A tree of fixed depth over sentences: their number of tokens, then ``TREE_DEPTH`` first tokens lead to a leaf. In a
    leaf, sentences with equal masks share a template: the tokens that all of them have, and their masks elsewhere.

    Templates grow by a meet that knows no order, so trees grown apart can be merged in any way."""

    def __init__(self) -> None:
        self.masks = Masks()
        self.leaves: dict[int, list] = {}  # name -> [number of sentences, tokens, masks]

    def add(self, line: str) -> int | None:
        """The name of the template that ``line`` belongs to; None if it has no tokens."""
        tokens, masks = self.masks.read(line)
        if not tokens:
            return None
        path = "\x1f".join([str(len(tokens)), *tokens[:TREE_DEPTH], "", *masks])
        name = xxhash.xxh3_64_intdigest(path) - (1 << 63)
        self.put(name, 1, tokens, masks)
        return name

    def put(self, name: int, n: int, tokens: list[str], masks: list[str]) -> None:
        if (held := self.leaves.get(name)) is None:
            self.leaves[name] = [n, tokens, masks]
            return
        held[0] += n
        if held[1] != tokens:
            held[1] = [a if a == b else m for a, b, m in zip(held[1], tokens, masks)]

    def rows(self) -> Iterator[tuple[int, int, list[str], list[str]]]:
        for name, (n, tokens, masks) in self.leaves.items():
            yield name, n, tokens, masks


#: Sentences remembered and templates held at once by a task; beyond it partial templates are passed on.
HELD = 50_000
_TEMPLATE = "struct<name: bigint, n: bigint, tokens: array<string>, masks: array<string>>"


def mine(records: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """One pass over ``records``: rows with ``keys``, the names of the templates of their sentences (``_names``) and whether
    they have a slot (``_slot``), and rows that hold only a partial template (``_template``). Checkpointed."""
    rows = records.select(*keys, F.col(text).alias("_text")).where(F.col("_text").rlike(r"(?U)\S"))
    template = StructType([StructField("name", LongType()), StructField("n", LongType()), StructField("tokens", ArrayType(StringType())), StructField("masks", ArrayType(StringType()))])
    schema = StructType([*rows.select(*keys).schema.fields, StructField("_names", ArrayType(LongType())), StructField("_slot", BooleanType()), StructField("_template", template)])
    schema = StructType([StructField(f.name, f.dataType, True) for f in schema.fields])

    def grow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree, seen = PrefixTree(), {}
        columns = [f.name for f in schema.fields]

        def passed_on() -> pd.DataFrame:
            rows_ = [{"name": a, "n": n, "tokens": t, "masks": m} for a, n, t, m in tree.rows()]
            tree.leaves.clear()
            return pd.DataFrame({c: rows_ if c == "_template" else [None] * len(rows_) for c in columns}, dtype=object)

        for batch in batches:
            names, slots = [], []
            for t in batch["_text"]:
                own = []
                for s in sentences(t):
                    if (name := seen.get(s, 0)) == 0:
                        name = seen[s] = tree.add(s)
                    if name is not None:
                        own.append(name)
                names.append(own)
                slots.append(slotted(t))
            out = batch.drop(columns="_text")
            yield out.assign(_names=names, _slot=slots, _template=None)[columns]
            if len(seen) > HELD:
                seen.clear()
            if len(tree.leaves) > HELD:
                yield passed_on()
        yield passed_on()

    return cut(rows.mapInPandas(grow, schema))


def templates(mined: DataFrame) -> DataFrame:
    """(name, template, sentences, residue) - the templates of a corpus, each merged from its parts and judged once.

    ``sentences`` counts distinct sentences of each task; ``residue`` is the verdict of the template itself."""
    parts = mined.where(F.col("_template").isNotNull()).select("_template.*")
    ordered = parts.repartition(F.col("name")).sortWithinPartitions("name")

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree = PrefixTree()
        for batch in batches:
            for name, n, tokens, masks in zip(batch["name"], batch["n"], batch["tokens"], batch["masks"]):
                tree.put(int(name), int(n), list(tokens), list(masks))
            last = int(batch["name"].iloc[-1]) if len(batch) else None  # its parts may go on in the next batch
            open_ = tree.leaves.pop(last, None)
            yield _judged(tree)
            tree.leaves = {last: open_} if open_ else {}
        yield _judged(tree)

    return ordered.mapInPandas(merge, "name long, template string, sentences long, residue boolean")


def _judged(tree: PrefixTree) -> pd.DataFrame:
    rows = [(name, " ".join(tokens), n, is_residue(masks)) for name, n, tokens, masks in tree.rows()]
    return pd.DataFrame(rows, columns=["name", "template", "sentences", "residue"]).astype({"residue": bool})


def detect(records: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """The distinct ``keys`` of records whose ``text`` is, wholly or in part, residue.

    Sentences and lines are mined for templates with a fixed-depth prefix tree, each template is classified once and its
    verdict goes to all its sentences; unfilled slots are looked for in every record by itself. A word that can decide
    stands for itself in its template, so a template never holds both residue and ordinary text, and results don't
    depend on the order or partitions of rows. Null, empty and blank texts aren't cases, repeated rows count once,
    columns other than ``keys`` and ``text`` are ignored. Null keys are keys like others. A template that a third of the
    records carry is joined by broadcast, so it fills no task.
    """
    mined = mine(records, text, keys)
    own = mined.where(F.col("_template").isNull())
    bad = cut(templates(mined).where("residue").select(F.col("name").alias("_name")))
    carried = own.where(~F.col("_slot")).select(*keys, F.explode("_names").alias("_name"))
    messages = split_join(carried, bad, ["_name"], "inner").select(*keys)
    return messages.unionByName(own.where("_slot").select(*keys)).distinct()


def summaries(functions: DataFrame, files: DataFrame, modules: DataFrame) -> DataFrame:
    """(source_table, repo_name, record_key, summary) of the three stage-B tables."""
    parts = [
        (functions, "stage_b_function_items", F.col("item_id").cast("string"), "business_summary"),
        (files, "stage_b_file_summaries", F.col("file"), "file_summary"),
        (modules, "stage_b_module_summaries", F.col("module"), "module_summary"),
    ]
    return reduce(DataFrame.unionByName, [t.select(F.lit(n).alias("source_table"), "repo_name", k.alias("record_key"), F.col(c).alias("summary")) for t, n, k, c in parts])


KEYS = ["source_table", "repo_name", "record_key"]


def found(functions: DataFrame, files: DataFrame, modules: DataFrame) -> DataFrame:
    """The records whose summary is residue."""
    return detect(summaries(functions, files, modules), "summary", KEYS)


def matching(left: str, right: str, keys: list[str]) -> Column:
    """Equality of ``keys`` in which nulls are equal."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def kept(functions: DataFrame, files: DataFrame, modules: DataFrame) -> DataFrame:
    """The distinct records left over: neither blank nor residue."""
    rows = summaries(functions, files, modules).where(F.col("summary").rlike(r"(?U)\S")).distinct()
    bad = detect(summaries(functions, files, modules), "summary", KEYS)
    return rows.alias("r").join(bad.alias("b"), matching("r", "b", KEYS), "left_anti")
