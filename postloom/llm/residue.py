"""Template residue, filler, error pages and script notices in place of content.

A multi-pattern automaton finds phrases of many languages in the letters of the text. A text is residue when the phrases cover most of
its letters and one of them decides (everyday words and bits of sentences only support others), when it holds an unfilled placeholder outside code, or when nothing but printed empty values is in it. One pass over whole
texts, no shuffle; phrases are data, so more can be given.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame, functions as F

#: Phrases by reason. What servers, content systems and browsers print.
PHRASES: dict[str, tuple[str, ...]] = {
    "error_page": (
        "bad request", "unauthorized", "payment required", "forbidden", "page not found", "not found", "method not allowed", "not acceptable", "request timeout", "conflict", "gone", "payload too large",
        "too many requests", "unavailable for legal reasons", "internal server error", "not implemented", "bad gateway", "service unavailable", "service temporarily unavailable", "gateway time out", "gateway timeout", "http version not supported",
        "error", "http", "https", "http error", "server error", "fatal error", "status code", "error code", "oops", "whoops", "sorry", "uh oh", "hmm",
        "the server encountered an unexpected condition", "the server could not complete your request", "the server encountered an error", "the upstream server did not answer in time", "the server is temporarily unable to service your request",
        "the page you are looking for was moved removed or never existed", "the page you requested could not be found", "the page you are looking for", "the page you requested", "the requested url was not found on this server", "was moved removed or never existed", "does not exist", "could not be found", "this page does not exist", "this page doesn t exist",
        "sorry this page isn t available", "this page isn t available", "this page is not available", "this content isn t available", "this content is no longer available", "the link you followed may be broken", "or the page may have been removed", "the page may have been removed",
        "you are not allowed to see this content", "you don t have permission to view this resource", "you do not have permission to view this resource", "you don t have permission to access", "you do not have permission to access", "on this server", "you don t have access to this page", "access denied", "access is denied", "permission denied",
        "something went wrong on our end", "something went wrong", "an error occurred", "an unexpected error occurred", "an unexpected error has occurred", "try again later", "please try again later", "please try again", "please try again in minutes", "try again in minutes", "slow down and try again in minutes", "please try again in a few minutes", "in a few minutes", "slow down and",
        "if the problem persists contact the administrator", "if the problem persists", "contact the administrator", "please contact support", "rate limit reached", "rate limit exceeded", "retry after", "quota exceeded", "we can t reach that page right now", "we couldn t load this page", "can t reach this page", "this site can t be reached", "refused to connect", "took too long to respond",
        "host unreachable", "host is unreachable", "network is unreachable", "no route to host", "name or service not known", "could not resolve host", "connection refused", "connection timed out", "connection reset", "timed out", "server edge", "nginx", "apache", "cloudflare", "varnish", "openresty", "request id", "incident id", "ray id", "reference", "error reference", "trace id",
        "traceback most recent call last", "nullpointerexception", "exception in thread main", "segmentation fault", "uncaught typeerror", "syntaxerror", "typeerror", "valueerror", "attributeerror", "stack trace",
        "home", "login", "log in", "help", "back to start page", "back to home", "go back", "go to homepage", "return to homepage", "all rights reserved", "contact us", "menu", "skip to content", "the site is down for maintenance", "we are down for maintenance", "down for maintenance", "under maintenance", "we ll be back soon", "we will be back soon", "this video is unavailable", "this post is unavailable", "content unavailable", "database connection failed", "error establishing a database connection",
        "seite nicht gefunden", "die angeforderte adresse existiert nicht", "die angeforderte seite wurde nicht gefunden", "fehler", "zugriff verweigert", "sie haben keine berechtigung diese seite anzusehen", "sie haben keine berechtigung", "interner serverfehler", "bitte versuchen sie es später erneut", "bitte versuchen sie es spater erneut", "ein fehler ist aufgetreten", "dienst nicht verfügbar", "es ist ein fehler aufgetreten",
        "erreur", "une erreur interne est survenue", "une erreur est survenue", "veuillez réessayer plus tard", "veuillez reessayer plus tard", "page introuvable", "page non trouvée", "la page demandée n existe pas", "la page que vous recherchez n existe pas", "accès refusé", "acces refuse", "vous n avez pas l autorisation d afficher cette page", "service indisponible",
        "acceso denegado", "no tiene permiso para ver esta página", "no tiene permiso para ver esta pagina", "página no encontrada", "pagina no encontrada", "la página que busca no existe", "la dirección solicitada no existe", "ha ocurrido un error", "se ha producido un error", "inténtelo de nuevo más tarde", "intentelo de nuevo mas tarde", "error interno del servidor", "servicio no disponible",
        "página não encontrada", "pagina nao encontrada", "o endereço pode ter sido removido", "o endereco pode ter sido removido", "acesso negado", "você não tem permissão para ver esta página", "ocorreu um erro", "tente novamente mais tarde", "erro", "erro interno do servidor", "serviço indisponível", "a página pode ter sido removida",
        "pagina non trovata", "pagina inesistente", "accesso negato", "non hai i permessi per vedere questa pagina", "si è verificato un errore", "si e verificato un errore", "riprova più tardi", "riprova piu tardi", "errore", "errore interno del server", "servizio non disponibile", "la pagina richiesta non esiste",
        "pagina niet gevonden", "toegang geweigerd", "u hebt geen toestemming om deze pagina te bekijken", "er is een fout opgetreden", "er ging iets mis", "probeer het later opnieuw", "fout", "interne serverfout", "de opgevraagde pagina bestaat niet",
        "sidan hittades inte", "sidan kunde inte hittas", "åtkomst nekad", "ett fel uppstod", "ett fel har uppstått", "försök igen senare", "internt serverfel", "fel", "nie znaleziono strony", "strona nie została znaleziona", "odmowa dostępu", "brak dostępu", "wystąpił błąd", "spróbuj ponownie później", "wewnętrzny błąd serwera", "błąd",
        "sayfa bulunamadı", "sayfa bulunamadi", "erişim reddedildi", "erişim engellendi", "bir hata oluştu", "lütfen daha sonra tekrar deneyin", "hata", "sunucu hatası", "страница не найдена", "проверьте адрес и попробуйте снова", "проверьте адрес", "попробуйте снова", "перевірте адресу", "спробуйте ще раз", "доступ запрещён", "доступ запрещен", "произошла ошибка", "повторите попытку позже", "попробуйте позже", "попробуйте ещё раз позже", "внутренняя ошибка сервера", "ошибка", "ошибка сервера",
        "запрошенная страница не существует", "у вас нет прав для просмотра этой страницы", "сторінку не знайдено", "доступ заборонено", "сталася помилка", "спробуйте пізніше", "помилка", "внутрішня помилка сервера", "сервіс недоступний", "сервис недоступен", "сервер временно недоступен",
        "页面未找到", "找不到页面", "页面不存在", "您访问的页面不存在", "访问被拒绝", "没有权限", "您没有权限查看此页面", "服务器内部错误", "出错了", "发生错误", "请稍后再试", "服务不可用", "错误", "ページが見つかりません", "urlをご確認ください", "ご確認ください", "请检查网址", "请检查网址后重试", "お探しのページは見つかりませんでした", "アクセスが拒否されました", "エラーが発生しました", "しばらくしてからもう一度お試しください", "サーバーエラー", "サーバーエラーが発生しました", "このページを表示する権限がありません", "エラー", "サービスを利用できません",
    ),
    "script_notice": (
        "you need to enable javascript to run this app", "please enable javascript and cookies to continue", "please enable javascript to continue", "please enable javascript", "please enable cookies", "enable javascript", "enable javascript and cookies", "enable cookies", "javascript is disabled in your browser", "javascript is disabled", "javascript is required", "javascript is required to view this page", "this site requires javascript", "this page requires javascript", "this app requires javascript", "this app works best with javascript enabled", "requires javascript",
        "please turn it on in your browser settings and reload", "please turn it on", "in your browser settings", "and reload", "your browser does not support scripts", "your browser does not support javascript", "some parts of this page will not be shown", "to view this page", "to view this content", "to continue", "and reload the page",
        "checking your browser before you continue", "checking your browser before accessing", "checking your browser", "checking if the site connection is secure", "verifying you are human", "verify you are human", "please verify you are human", "verify that you are not a robot", "please complete the security check", "please complete the captcha", "just a moment", "this may take a few seconds", "this process is automatic", "your browser will redirect shortly", "needs to review the security of your connection before proceeding", "ddos protection by",
        "your session has expired", "please sign in again to see this post", "please sign in again", "session expired", "please sign in to continue", "please sign in", "please log in", "please log in to continue", "sign in to continue", "sign in to see this post", "sign in to view this post", "log in to continue", "log in to see this post", "log in to view", "you must be logged in", "you must be logged in to view this content", "you must be logged in to see this post", "to see this post", "sign up to see this", "sign in", "sign up", "join now to see", "create an account to continue", "members only",
        "bitte aktivieren sie javascript um diese seite anzuzeigen", "bitte aktivieren sie javascript", "um diese seite anzuzeigen", "aktivieren sie javascript", "bitte melden sie sich an", "bitte melden sie sich an um fortzufahren", "um fortzufahren", "ihre sitzung ist abgelaufen", "ihr browser wird überprüft", "javascript ist deaktiviert",
        "vous devez activer javascript pour afficher ce contenu", "veuillez activer javascript", "activer javascript", "pour afficher ce contenu", "pour continuer", "veuillez vous connecter", "veuillez vous connecter pour continuer", "votre session a expiré", "vérification de votre navigateur", "javascript est désactivé",
        "para continuar debe activar javascript en su navegador", "debe activar javascript", "active javascript", "habilite javascript", "habilite javascript para continuar", "en su navegador", "para continuar", "inicie sesión para continuar", "inicie sesión", "su sesión ha caducado", "su sesion ha caducado", "comprobando su navegador",
        "ative o javascript", "ative o javascript para continuar", "habilite o javascript", "no seu navegador", "para ver esta página", "faça login para continuar", "inicie sessão para continuar", "a sua sessão expirou", "sua sessão expirou", "verificando seu navegador", "é necessário ativar o javascript",
        "attiva javascript", "attiva javascript per continuare", "abilita javascript", "per visualizzare questa pagina", "per continuare", "nel tuo browser", "accedi per continuare", "la sessione è scaduta", "verifica del browser in corso",
        "schakel javascript in", "schakel javascript in om deze pagina te bekijken", "om deze pagina te bekijken", "javascript is uitgeschakeld", "log in om verder te gaan", "uw sessie is verlopen", "aktivera javascript", "aktivera javascript för att visa sidan", "för att visa den här sidan", "logga in för att fortsätta", "din session har gått ut",
        "włącz javascript", "włącz obsługę javascript aby wyświetlić stronę", "aby wyświetlić tę stronę", "zaloguj się aby kontynuować", "twoja sesja wygasła", "javascript i etkinleştirin", "lütfen javascript i etkinleştirin", "bu sayfayı görüntülemek için", "devam etmek için", "devam etmek için giriş yapın", "oturumunuzun süresi doldu",
        "включите javascript", "пожалуйста включите javascript", "для просмотра этой страницы", "для работы сайта необходимо включить javascript", "чтобы продолжить", "войдите чтобы продолжить", "ваша сессия истекла", "проверка браузера", "увімкніть javascript", "будь ласка увімкніть javascript", "щоб переглянути цю сторінку", "увійдіть щоб продовжити", "щоб продовжити", "для перегляду цієї сторінки",
        "请启用javascript", "请启用 javascript", "以查看此页面", "请登录后继续", "您的会话已过期", "正在检查您的浏览器", "javascriptを有効にしてください", "javascript を有効にしてください", "このページを表示するには", "続けるにはログインしてください", "セッションの有効期限が切れました", "ブラウザを確認しています",
    ),
    "filler": (
        "title goes here", "body text goes here", "text goes here", "subtitle goes here", "headline goes here", "caption goes here", "goes here", "your post text here", "your text here", "your title here", "your content here", "your caption here", "your headline here", "your message here", "click to edit this text block", "click to edit this text", "click here to edit", "click to add text", "click to add title", "double click to edit",
        "sample post", "sample text", "sample page", "sample content", "replace this text before publishing", "replace this text", "before publishing", "replace me", "insert hook here", "insert story here", "insert call to action here", "insert text here", "insert title here", "insert link here", "insert image here", "insert quote here", "insert name here", "add text here", "add title here", "add caption here", "enter text here", "enter your text here", "type here", "type something", "write something",
        "todo write caption", "todo write post", "todo write this", "todo write", "todo add text", "todo", "tbd", "tba", "fixme", "write caption", "caption tbd", "placeholder text", "placeholder", "this is a placeholder", "dummy text", "this is dummy text", "this is a test", "this is a test post", "test post", "test post please ignore", "just a test", "testing", "testing testing", "please ignore", "test", "ignore this post", "hello world", "asdf", "asdfasdf", "asdfgh", "asdfghjkl", "qwerty", "qwer", "blah blah blah", "blah blah", "foo bar baz", "foo bar", "xxx", "xxxx", "lorem ipsum", "lorem ipsum dolor sit amet", "coming soon", "draft", "untitled", "untitled post", "new post", "no content", "no text", "empty",
        "text hier einfügen", "ihr text hier", "hier steht ihr text", "titel hier einfügen", "votre texte ici", "insérez votre texte ici", "titre ici", "su texto aquí", "escriba su texto aquí", "inserte texto aquí", "título aquí", "seu texto aqui", "insira o texto aqui", "il tuo testo qui", "inserisci il testo qui", "uw tekst hier", "tekst hier invoegen", "din text här", "tutaj wpisz tekst", "metninizi buraya yazın", "ваш текст здесь", "вставьте текст", "ваш текст тут", "在此输入文本", "请输入内容", "ここにテキストを入力", "テキストを入力してください",
    ),
    "empty_value": ("undefined", "null", "nan", "none", "nil", "n a", "object object", "likes", "comments", "shares", "empty string", "no value", "missing value", "ref", "value", "nat"),
}

#: Words and bits of sentences that are on such pages but also in any post: they count for the coverage, but a text of them alone is content,
#: unless it has a status code of an error.
SUPPORT = frozenset(
    (
        "error", "http", "https", "oops", "whoops", "sorry", "uh oh", "hmm", "conflict", "gone", "forbidden", "unauthorized", "not implemented", "reference", "home", "login", "log in", "help", "menu", "go back", "contact us", "sign in", "sign up", "all rights reserved", "timed out", "does not exist",
        "could not be found", "on this server", "slow down and", "try again in minutes", "in a few minutes", "please try again", "reload the page", "refused to connect", "retry after", "nginx", "apache", "cloudflare", "varnish", "openresty", "cloud", "edge", "proxy", "origin", "gateway", "upstream", "cdn", "server", "browser", "host",
        "please turn it on", "in your browser settings", "and reload", "and reload the page", "to view this page", "to view this content", "to continue", "to see this post", "just a moment", "this may take a few seconds", "members only", "coming soon", "draft", "untitled", "new post", "empty", "placeholder", "before publishing", "please ignore",
        "likes", "comments", "shares", "views", "none", "nil", "value", "ref", "n a", "fehler", "erreur", "errore", "erro", "fout", "fel", "hata", "błąd", "ошибка", "помилка", "错误", "エラー", "um fortzufahren", "um diese seite anzuzeigen", "pour continuer", "pour afficher ce contenu", "para continuar", "en su navegador",
        "no seu navegador", "para ver esta página", "per continuare", "nel tuo browser", "per visualizzare questa pagina", "om deze pagina te bekijken", "devam etmek için", "bu sayfayı görüntülemek için", "чтобы продолжить", "щоб продовжити", "для просмотра этой страницы", "для перегляду цієї сторінки", "ご確認ください", "headerline",
    )
)
#: Phrases that stand for lines found by pattern.
_LINES = {"error_page": ("tracebackline", "headerline")}
#: Lines of stack traces of common languages, and of the head of a response of a server.
_FRAME = re.compile(r"""^[ \t]*(?:File\ "[^"\n]*",\ line\ \d+(?:,\ in\ \S+)? | at\ [\w$.<>]+\s?\([^()\n]*\))[ \t]*$""", re.M | re.X | re.I)
_RAISED = re.compile(r"^[ \t]*(?:Caused by: )?(?:[\w$]+\.)*\w+(?:Error|Exception)\b(?::[^\n]*)?$", re.M | re.I)
_HEADER = re.compile(r"^[ \t]*(?:server|via|date|connection|age|location|retry-after|cache-control|content-(?:type|length)|cf-ray|x-[\w-]+)[ \t]*:[^\n]*$", re.M | re.I)
_STATUS = re.compile(r"(?<![\w.,/-])[45]\d\d(?![\w,/-]|\.\d)")
#: A whole text as a language prints an absent value.
_PRINTED = frozenset(("None", "nil", "N/A", "n/a", "<NA>", "NaT", "<null>", "(null)", "[null]", "[object Object]", "{}", "[]"))

#: The running filler text of typesetting; fixed values.
LOREM = frozenset(
    """lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim
    veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum
    eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum""".split()
)

#: What an unfilled field is named after.
_FIELD = r"(?:your|insert|add|enter|name|first|last|date|product|link|team|company|city|topic|metric|event|job|author|role|headline|industry|title|user|start|end|recipient|sender|contact|email|phone|address|price|amount|subject|client|customer|department|location|country|url|image|hashtag|quote|number|position|salary|school|project|brand)"
_CODE = re.compile(r"```.*?(?:```|\Z)|`[^`\n]*`", re.S)
_PLACEHOLDER = re.compile(
    rf"""
    \{{\{{[^{{}}\n]{{1,60}}\}}\}} | \{{%[^%\n]{{1,60}}%\}} | \[%[^%\n]{{1,60}}%\] | <%=?[^%\n]{{1,60}}%> | \{{![A-Za-z_][\w.]*\}} | \*\|[A-Za-z0-9_:]+\|\* | @@[A-Za-z_]{{2,}}@@
    | [$#]\{{[\w.]*(?i:{_FIELD})[\w.]*\}} | (?<![\w\\\])}}])\{{\d{{1,2}}\}}(?![\w{{])
    | %%[A-Za-z_]{{3,}}%% | (?<![\w%])%[A-Z_]*(?i:{_FIELD})[A-Z_]*%(?![\w%]) | (?<![\w%])%[a-z]*_[a-z_]+%(?![\w%]) | (?<!\w)__[A-Z][A-Z0-9_]*?__(?!\w)
    | \[\[[A-Za-z][\w .-]{{1,40}}\]\] | \bTBD_[A-Z_]+ | \bX{{3,}}\s*\([a-z][\w ]*\)
    | \[(?:(?i:your|insert|add|enter|link|name|job|event|company|product|date|team|city|topic|metric|author|role|headline|industry|first|last|user|start|title|recipient|client|customer|position|location|hashtag|quote|number)\b)[A-Za-z _/-]{{0,40}}\](?!\()
    | <(?:(?i:your|insert|add|enter|link\ to|name|job|event|company|product|date|team|city|topic|metric|author|role|headline|industry|first|last|user|recipient|client|customer|position|location|start)\b)[A-Za-z _-]{{0,40}}>
    """,
    re.X,
)
_LIKELY = re.compile(r"\{[{%!\d]|\[[%A-Za-z\[]|<[%A-Za-z]|\*\||@@|[$#]\{|%[A-Za-z_%]|__[A-Z]|TBD_|XXX")
_TAG = re.compile(r"</?[A-Za-z][^<>\n]{0,200}>")
_WORDS = re.compile(r"\w+")
_CJK = re.compile(r"[぀-ヿ㐀-鿿]")


def letters(text: str) -> str:
    """Lower-cased words without tags, punctuation and words with digits, joined by single blanks."""
    return " ".join([w for w in _WORDS.findall((_TAG.sub(" ", text) if "<" in text else text).lower()) if w.isalpha()])


def build_automaton(phrases: dict[str, tuple[str, ...]] | None = None, support: frozenset[str] = SUPPORT) -> ahocorasick.Automaton:
    """The phrases, with their reason, length and whether they decide."""
    found = ahocorasick.Automaton()
    supporting = {letters(x) for x in support}
    for p in supporting:
        found.add_word(p, ("error_page", len(p), False))
    for reason, own in [*(phrases or PHRASES).items(), *_LINES.items()]:
        for p in own:
            if n := letters(p):
                found.add_word(n, (reason, len(n), n not in supporting))
    found.make_automaton()
    return found


def coverage(text: str, automaton: ahocorasick.Automaton) -> tuple[float, str, bool]:
    """The share of letters covered by whole-word phrases, the reason that covers most, and whether a phrase that decides is among them. 0 for a
    text without letters."""
    t = letters(text)
    if not t:
        return 0.0, "", False
    spans = []
    for end, (reason, n, decides) in automaton.iter(t):
        start = end - n + 1
        if (start == 0 or t[start - 1] == " " or _CJK.match(t[start])) and (end + 1 == len(t) or t[end + 1] == " " or _CJK.match(t[end])):
            spans.append((start, end + 1, reason, decides))
    covered, upto, by, decided = 0, 0, {}, False
    for start, end, reason, decides in sorted(spans, key=lambda s: (s[0], -s[1])):
        decided = decided or decides
        if end > upto:
            new = t[max(start, upto) : end]
            n = len(new) - new.count(" ")
            covered, upto = covered + n, end
            by[reason] = by.get(reason, 0) + n
    total = len(t) - t.count(" ")
    return covered / total, max(by, key=by.get) if by else "", decided


def judge(text: str | None, automaton: ahocorasick.Automaton, least: float = 0.6) -> tuple[str, float]:
    """(reason, coverage); the reason is empty for content. Null, empty and blank texts are content, as are texts of code alone."""
    if text is None or not text.strip():
        return "", 0.0
    if text.strip() in _PRINTED:
        return "empty_value", 1.0
    prose = _CODE.sub(" ", text) if "`" in text else text
    if _LIKELY.search(prose) and _PLACEHOLDER.search(prose):
        return "placeholder", 1.0
    if not prose.strip():
        return "", 0.0
    if ":" in prose or "(" in prose or '"' in prose:
        prose = _HEADER.sub(" headerline ", prose)
        if _FRAME.search(prose):
            prose = _RAISED.sub(" tracebackline ", _FRAME.sub(" tracebackline ", prose))
    share, reason, decided = coverage(prose, automaton)
    if share >= least and (decided or _STATUS.search(prose)):
        return reason, share
    words = letters(prose).split()
    if len(words) >= 4 and (n := sum(w in LOREM for w in words) / len(words)) >= 0.75:
        return "filler", n
    return "", share


def find_residue(df: DataFrame, id_col: str, text_col: str, phrases: dict[str, tuple[str, ...]] | None = None, least: float = 0.6) -> DataFrame:
    """id_col, reason, coverage of each record whose text is residue: an unfilled placeholder outside code, or text of which at least the share
    least of the letters is phrases of error pages, script or sign-in notices, filler or printed empty values.

    Null, empty and blank texts, code and bare links aren't residue. Repeated rows are judged each. Whole texts are read, of any length.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = build_automaton(phrases)
        for batch in batches:
            judged = [(i, *judge(t, automaton, least)) for i, t in zip(batch.iloc[:, 0], batch.iloc[:, 1])]
            if found := [x for x in judged if x[1]]:
                yield pd.DataFrame(found, columns=[id_col, "reason", "coverage"])

    lean = df.select(F.col(id_col), F.col(text_col))
    return lean.mapInPandas(run, f"`{id_col}` {dict(lean.dtypes)[id_col]}, reason string, coverage double")
