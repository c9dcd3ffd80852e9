"""Template residue and error-page text in place of content.

Contexts in which a page speaks of such text are taken out first: code,
nowiki, preformatted blocks, comments, quotations and italics. What is left is
searched with one grammar a kind of delimiter and with the phrases of fillers,
error pages and script notices; ambiguous words count only where they fill a
gap in a sentence, not where the sentence is about them. Placeholders are
weighed against what surrounds them: a line that speaks of placeholders at
least as often as it holds some is discounted, and so are all those of a
tutorial, a page that shows code, speaks of placeholders on half of the lines
that hold some, and holds them on few of its lines.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame

# Tags of HTML and of wiki markup; switches of wiki markup.
TAGS = (
    "a abbr b bdi bdo big blockquote br caption center cite code col colgroup dd del dfn div dl dt em font gallery h1 h2 h3 h4 h5 h6 hr i img includeonly "
    "indicator ins kbd li mark math nowiki noinclude noscript ol onlyinclude p poem pre q rb ref references rp rt ruby s samp score section small source span "
    "html head body title script style noscript form input button iframe label meta link main article header footer nav "
    "strike strong sub sup syntaxhighlight table tbody td templatestyles tfoot th thead timeline tr tt u ul var wbr"
).split()
SWITCHES = "NOTOC FORCETOC TOC NOEDITSECTION NEWSECTIONLINK NONEWSECTIONLINK NOGALLERY HIDDENCAT INDEX NOINDEX STATICREDIRECT NOCONTENTCONVERT NOTITLECONVERT DISAMBIG EXPECTUNUSEDCATEGORY".split()
LATIN = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim minim veniam quis nostrud ullamco laboris nisi aliquip commodo consequat duis velit".split()

#: Where text is shown as text. A quotation ends on its line.
SPOKEN_OF = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(nowiki|code|pre|syntaxhighlight|source|kbd|samp|tt|math|blockquote|q)\b[^<>]*(?<!/)>.*?</\1\s*>"
    r"|(?<!')''(?!')[^'\n]+(?<!')''(?!')"
    r"|(?<![\w\"])\"[^\"\n]+\"(?![\w\"])|“[^”\n]+”|«[^»\n]+»|„[^“”\n]+[“”]|「[^」\n]+」|『[^』\n]+』|‘[^’\n]+’",
    re.S | re.I,
)
#: A sentence that names a word or text before it.
NAMED = r"(?<!wrote )(?<!write )(?<!writes )(?<!written )(?<!word )(?<!words )(?<!letters )(?<!term )(?<!marked )(?<!spelled )(?<!called )(?<!read )(?<!reads )(?<!as )"

PLACEHOLDERS = [
    r"\{\{\{[^{}|<>\n]+\}\}\}",
    r"\$\{[\w.:-]+\}|\$\([\w.]+\)",
    r"(?<!\{)\{[A-Za-z0-9][\w. ]*\}(?!\})",
    r"(?<![\w%])%\(\w+\)[sdif]|(?<![\w%])%[sd](?![\w%])",
    r"(?<![\w%])%[1-9]\$[sd](?!\w)|(?<![\w$])\$1 (?:is|was|has|had|lies|are|were)\b(?=[^\n]*\$2(?![\d.,]*\d))|^\$1 (?:is|lies)\b",
    r"(?<![\w%])%[A-Z][A-Z_]{2,}%(?!\w)",
    r"\{%[^%\n]+%\}",
    r"<%[=#-]?[^%\n]+%>|<\?=?[^?\n]+\?>",
    r"<<\w+>>|\[\[\[\w+\]\]\]",
    rf"<(?!(?:{'|'.join(TAGS)})\b)[a-z][a-z0-9]*(?:[_ -][a-z0-9]+)*>",
    r"<[a-z]+(?:_[a-z]+)+>",
    rf"(?<!\w)__(?!(?:{'|'.join(SWITCHES)})__)[A-Z0-9]+(?:_[A-Z0-9]+)*__(?!\w)",
    r"@@\w+@@|(?<!\w)##\w+##(?!\w)",
    r"#(?:REF|VALUE|DIV/0|NUM|NULL)!|#NAME\?|#N/A\b",
    r"(?<!\[)\[(?i:insert|enter|add|fill in|put|place|your (?:name|text|title|address|city|company|date|email|own|organi[sz]ation)|name of|type|description of|date of|number of|todo|tbd)\b[^\[\]\n]*\](?![\](])",
    r"(?<!\[)\[(?:Your|YOUR)\b[^\[\]\n]*\](?![\](])",
    r"(?<!\[)\[[A-Z][A-Z0-9 _]* HERE\](?!\])",
    r"^(?:TODO|FIXME|TBD|TBA)(?::|\.?$)",
    NAMED + r"(?<!\w)X{4,8}(?!\w)|(?<!\w)XXX(?= [a-z]+)(?! Corps)(?=[^.\n]*\bX{3,})",
    r"(?<=\w )\?{3,8}(?=[\s.,;:]|$)",
    r"(?m)'''(?:undefined|null|NaN|None)'''|^(?:undefined|null|NaN) (?:is|was|has|are|were)\b|\b(?:in|of|near|from|by) (?:undefined|null|NaN)\b(?=[\s.,;]|$)(?! (?:value|string|hypothesis|pointer|behaviou?r|set)s?)",
]
FILLERS = [
    r"(?:^|[.!?]\s+)(?:sample|dummy|filler|placeholder) text\b(?! (?:is|was|were|are|in|from|for)\b)",
    r"\b(?:your|add) (?:own )?(?:text|content|title|description)s? (?:goes |go )?here\b|\b(?:text|content|description|title|biography|caption) (?:goes|go) here\b|\btext to (?:follow|come)\b",
    r"\binsert (?:[\w-]+ ){1,3}text here\b|^headline text$|\bbold text italic text\b|(?:^|(?<=\[\[))link title\b(?=\]\]|$)",
    r"\binsert (?:your |some |the )?(?:text|content|title|name|description|image|paragraph) here\b|(?m)^(?:content |page )?coming soon\b",
    r"\bblah(?:[ ,.]+blah){2,}",
    r"\breplace this (?:paragraph|text|section|sentence|line|placeholder)\b|\((?:editor|author|writer)s?: ?\d+ words\b|\bclick here to (?:add|edit|enter)\b|\bcontent coming soon\b",
    r"\bblindtext\b(?=[^.\n]*\b(?:bis|folgt|ersetzen|hier)\b)|\bplatzhalter(?:text)?\b(?=[^.\n]*\b(?:bis|folgt|ersetzen|hier|für)\b)|\bhier (?:steht|folgt|kommt)[^.\n]{0,30}\b(?:blind|platzhalter)?text\b|\btext folgt\b|\bbeispieltext\b",
    r"\btexto de (?:relleno|ejemplo|prueba|muestra)\b|\b(?:escriba|inserte|introduzca) (?:aquí )?(?:su|el|un) texto\b|\b(?:su|el) texto (?:va )?aquí\b",
    r"\btexte (?:provisoire|de remplissage|factice|à venir|d[’']exemple|bidon)\b|\b(?:insérez|saisissez|écrivez|ajoutez) (?:ici )?(?:votre|le|un) texte\b|\bvotre texte ici\b",
    r"(?:ダミー|サンプル|仮)(?:の)?(?:テキスト|文章|文)|ここに[^。\n]{0,30}(?:入力|記入|書い|書く|挿入|追加|入れ|入り|テキスト|文章|説明)|(?:本文|文章|説明)(?:は|を)?(?:後日|準備中|未定)|準備中です",
]
ERRORS = [
    r"\b[45]\d\d (?:not found|forbidden|bad gateway|service (?:temporarily )?unavailable|internal server error|gateway time-?out|unauthorized|bad request|too many requests)\b",
    r"\b(?:page|url|file|document|address|resource)\b[^.\n]{0,60}\b(?:was|were|could|can)(?: ?not|n[’']t) (?:be )?(?:found|displayed|loaded|shown)\b(?! (?:until|till|before|after|in|by|at|among|amid|guilty|to|again|when|where|that|worthy)\b)|\bcould not find (?:the|this|that) (?:page|file|document)\b|\bnot found on this server\b|(?m)^page not found\b",
    r"(?m)(?:^|[.!?:]\s+)access (?:denied|forbidden)\b|\byou (?:do not|don[’']t) have permission\b|\bpermission denied\b",
    r"(?m)^(?:service (?:temporarily )?unavailable|forbidden|unauthorized|bad request|loading\s*(?:…|\.\.\.))\s*[.!]?\s*$",
    r"\b(?:could not|cannot|can[’']t|unable to|failed to) (?:connect|establish a connection|select|open) (?:to )?[^.\n]{0,50}\b(?:database|server|host|socket)\b|\berror establishing\b",
    r"\binternal server error\b|\bgateway time-?out\b|(?m)(?:^|[.!?]\s+)too many requests\b|\b(?:service|server|site|page|website) is (?:temporarily |currently )?(?:unavailable|overloaded|down)\b|\b(?:experiencing|having) (?:some )?technical (?:difficulties|problems)\b|\bbad gateway\b",
    r"\b(?:please )?(?:try again|retry) (?:later|in a few|after \d+|in \d+)\b|\bthe upstream [^.\n]{0,40}did not (?:answer|respond)\b|\brequest timed out\b|\bconnection (?:timed out|refused|reset)\b",
    r"\b(?:fatal|parse|syntax|script|expression|cite|lua|database|runtime|unknown) error(?: in)?\s*[:(]|\blua error in\b|\bcite error\b|\bexpression error\b|\btemplate loop detected\b|\buncaught (?:\w+error|exception)\b|\btraceback \(most recent call last\)|\bsegmentation fault\b",
    r"\b[a-z]\w*(?:\.\w+)+(?:Exception|Error)\b|\bat [\w.$]+\(\w+\.\w+:\d+\)|\b(?:warning|notice|deprecated): [^\n]{0,80} in /\S+ on line \d+",
    r"(?m)(?:^|[.!?]\s+)(?:sorry|oops)[!,][^\n]{0,60}\b(?:problem|wrong|error|difficult|unavailable)|\bsomething went wrong\b|\ban (?:unexpected )?error (?:has )?occurred\b|(?m)^error\s*(?:\d+|:)",
    r"\berror interno\b|\bvuelva a intentar|\binténtelo (?:de nuevo|más tarde)\b|\bpágina (?:solicitada |que busca )?no (?:se ha encontrado|se encontró|encontrada|existe|fue encontrada|está disponible)\b|\bacceso denegado\b|\bno se pudo conectar\b",
    r"\berreur (?:interne|\d{3}|fatale|serveur)\b|\b(?:page|adresse) (?:demandée |recherchée )?(?:est )?(?:introuvable|non trouvée|n[’']existe pas|n[’']a pas été trouvée|n[’']a pu être trouvée)\b|\baccès (?:refusé|interdit)\b|\bréessayer? (?:plus tard|dans)\b|\bveuillez réessayer\b",
    r"\bseite (?:wurde|konnte|ist) (?:leider )?nicht (?:gefunden|verfügbar|geladen)\b|\bseite nicht gefunden\b|\bfehlercode\b|\b(?:interner )?server-?fehler\b|\bzugriff verweigert\b|\bversuchen sie es (?:später|erneut|in)\b",
    r"(?:ページ|ファイル|記事)[^。\n]{0,10}見つかりません|エラー(?:が発生|コード| ?\d{2,})|[（(]エラー|サーバー?[^。\n]{0,12}(?:応答|接続でき|エラー)|アクセス(?:が|は)?(?:拒否|できません)|(?:しばらく|時間を)[^。\n]{0,15}(?:再度|もう一度|お試し)",
]
NOTICES = [
    r"\b(?:enable|activate|allow|permit|turn on|switch on|unblock|accept) (?:the |your |all )?(?:java ?script|scripts?|cookies)\b(?! (?:in|by|from) \d)|\b(?:java ?script|scripts|cookies) (?:must|need to|have to|has to|should) be (?:enabled|turned on|allowed|accepted|activated)\b",
    r"\b(?:this|the) ?(?:site|page|website|wiki|application|app|map|content)? ?(?:requires?|needs?) (?:cookies|java ?script|scripts)\b",
    r"\b(?:java ?script|scripts|cookies) (?:is|are|seems? to be|appears? to be) (?:currently )?(?:disabled|required|turned off|switched off|blocked|not enabled|not supported)\b|\bneed to (?:allow|enable) (?:java ?script|scripts|cookies)\b",
    r"\byour browser (?:does not|doesn[’']t|has|is)\b[^.\n]{0,60}\b(?:scripts?|java ?script|cookies|supported|blocked|outdated)|\bchecking your browser\b|\bwithout (?:java ?script|scripts|cookies)[^.\n]{0,30}\b(?:cannot|can[’']t|will not|won[’']t) be\b",
    r"\b(?:activez|activer|autorisez|autoriser) (?:le |les |votre )?(?:java ?script|scripts?|cookies)\b|\b(?:nécessite|requiert|exige) (?:java ?script|l[’']activation|les? cookies|des scripts)\b|\bjava ?script (?:est désactivé|doit être|est requis|est nécessaire)\b",
    r"\b(?:active|activa|activar|habilite|habilita|habilitar|permita|acepte) (?:el |los |las )?(?:java ?script|scripts?|cookies)\b|\b(?:requiere|necesita|precisa) (?:java ?script|cookies|scripts)\b|\bjava ?script (?:está desactivado|debe estar|es necesario)\b",
    r"\b(?:java ?script|skripte|cookies)\b[^.\n]{0,40}\b(?:aktivieren|aktiviert werden|einschalten|zulassen|erlauben|erforderlich|deaktiviert|benötigt)\b|\b(?:aktivieren|erlauben|akzeptieren) sie (?:bitte )?(?:java ?script|skripte|cookies)\b|\b(?:benötigt|erfordert|braucht) (?:java ?script|skripte|cookies)\b",
    r"(?:java ?script|スクリプト|クッキー|cookie)[^。\n]{0,15}(?:有効|オンに|許可|必要|無効|ブロック)",
]
LOREM = re.compile(r"\blorem ipsum\b((?:\W+\w+){0,8})", re.I)
#: Filler Latin in any order: so many of its words on end, of which so many differ. Latin prose has other words between them.
LATIN_RUN, LATIN_KINDS = 8, 6
#: Words of a line that speaks of placeholders.
TUTORIAL = re.compile(
    r"\b(?:placeholders?|parameters?|variables?|syntax|syntaxes|format strings?|macros?|expands? to|substituted|stands? for|denotes?|is written|are written|interpolat\w+"
    r"|platzhaltern?|parametern?|variablen?|marcador(?:es)?|parámetros?|sintaxis|paramètres?|syntaxe)\b|変数|引数|構文",
    re.I,
)
#: Context in which a page shows text as text, and the greatest share of its lines that hold placeholders in a tutorial.
SHOWS = re.compile(r"<(?:nowiki|code|pre|syntaxhighlight|source|kbd|samp|tt)\b", re.I)
TUTORIAL_SHARE = 0.2
_CASED = re.compile("|".join(f"(?:{p})" for p in PLACEHOLDERS).replace("(?m)", ""), re.M)
_UNCASED = re.compile("|".join(f"(?:{p})" for p in FILLERS + ERRORS + NOTICES).replace("(?m)", ""), re.M | re.I)

#: Characters other than its own upper case that a letter of a grammar matches where case does not count.
_SAME = str.maketrans("İıſ", "iis")
#: Strings followed at once in working out what a grammar needs.
_MOST = 64


def fold(line: str) -> str:
    return line.translate(_SAME).lower()


def split_alternatives(pattern: str) -> list[str]:
    """The parts of a pattern between the bars of its outermost level."""
    out, depth, within, at, i = [], 0, False, 0, 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            i += 1
        elif within:
            within = c != "]"
        elif c == "[":
            within = True
            i += pattern[i + 1] in "]^"
        elif c in "()":
            depth += 1 if c == "(" else -1
        elif c == "|" and not depth:
            out.append(pattern[at:i])
            at = i + 1
        i += 1
    return [*out, pattern[at:]]


def _literals(item) -> tuple[set[str] | None, list[set[str]]]:
    """All strings an item of a parsed pattern matches, None if they are not few; and sets of which each match holds a string each."""
    op, arg = str(item[0]), item[1]
    if op == "LITERAL":
        return {fold(chr(arg))}, []
    if op in ("AT", "ASSERT", "ASSERT_NOT"):
        return {""}, []
    if op == "IN" and all(str(k) == "LITERAL" for k, _ in arg) and len(arg) <= 4:
        return {fold(chr(c)) for _, c in arg}, []
    if op == "SUBPATTERN":
        return _sequence(arg[3])
    if op == "BRANCH":
        parts = [_sequence(x) for x in arg[1]]
        exact = None if any(e is None for e, _ in parts) else set().union(*(e for e, _ in parts))
        needs = [_best([*n, e] if e is not None else n) for e, n in parts]
        return exact if exact and len(exact) <= _MOST else None, [set().union(*needs)] if all(needs) else []
    if op == "MAX_REPEAT":
        low, high, inner = arg
        exact, needs = _sequence(inner)
        if exact is not None and low == 0 and high == 1:
            return exact | {""}, []
        if exact is not None and low and len(exact) == 1:
            text = next(iter(exact)) * low
            return ({text} if low == high else None), [{text}]
        return None, [*needs, *([exact] if exact else [])] if low else []
    return None, []


def _sequence(items) -> tuple[set[str] | None, list[set[str]]]:
    run, needs, whole = {""}, [], True
    for item in items:
        exact, more = _literals(item)
        if exact is not None and len(run) * len(exact) <= _MOST:
            run = {a + b for a in run for b in exact}
            continue
        needs += [run, *more]
        run, whole = exact if exact is not None else {""}, False
    return (run, needs) if whole else (None, [*needs, run])


def _tidy(texts: set[str]) -> set[str]:
    """Without outer white space, which may come from what replaces a quotation, and without texts that hold another."""
    bare = {t.strip() for t in texts}
    return {t for t in bare if not any(o != t and o in t for o in bare)}


def _best(needs: list[set[str]]) -> set[str]:
    """The set whose shortest string is longest; empty if no set tells anything."""
    return max((t for n in needs if (t := _tidy(n)) and "" not in t), key=lambda t: (min(map(len, t)), -len(t)), default=set())


def marks_of(alternative: str) -> tuple[set[str], list[set[str]]]:
    """Folded strings of which each match of a grammar holds one, and all such sets; no strings where they are too common to tell."""
    exact, needs = _sequence(re._parser.parse(alternative))
    needs = [t for n in ([*needs, exact] if exact is not None else needs) if (t := _tidy(n)) and "" not in t]
    best = _best(needs)
    rare = best and all(len(m) > 2 or (len(m) == 2 and not (m.isascii() and m.isalnum())) for m in best)
    return best if rare else set(), needs


#: Each alternative of each grammar, its marks worked out from the grammar itself. A line without any mark is passed
#: over, but for the grammars that have none (single braces, unknown tags, stack frames): these are searched themselves.
ALTERNATIVES = [(a, 0) for p in PLACEHOLDERS for a in split_alternatives(p.replace("(?m)", ""))] + [(a, re.I) for p in FILLERS + ERRORS + NOTICES for a in split_alternatives(p.replace("(?m)", ""))]
_WORKED = [(re.compile(a, re.M | flag), *marks_of(a)) for a, flag in ALTERNATIVES]
MARKS = frozenset(m for _, marks, _ in _WORKED for m in marks) | {"lorem ipsum", "consectetur", "adipiscing", "eiusmod", "incididunt", "nostrud", "ullamco"}
_BARE = [(grammar, needs) for grammar, marks, needs in _WORKED if not marks]
#: Characters of lines kept in a worker's memory; past this it starts anew, which changes no result.
MEMORY = 30_000_000


class Detector:
    """Looks at each distinct line once: pages repeat most of their lines from revision to revision."""

    def __init__(self):
        import ahocorasick

        self.marks = ahocorasick.Automaton()
        for m in MARKS:
            self.marks.add_word(m, 1)
        self.marks.make_automaton()
        self.forget()

    def forget(self) -> None:
        self.screened: dict[str, bool] = {}
        self.judged: dict[str, tuple[str, int] | None] = {}
        self.size = 0

    def screen(self, line: str) -> bool:
        """Whether a line could hold residue at all."""
        hit = self.screened.get(line)
        if hit is None:
            raw = html.unescape(line) if "&" in line else line
            low = fold(raw)
            hit = next(self.marks.iter(low), None) is not None or any(all(any(t in low for t in n) for n in needs) and grammar.search(raw) for grammar, needs in _BARE)
            self.size += len(line)
            if self.size > MEMORY:
                self.forget()
            self.screened[line] = hit
        return hit

    def judge(self, line: str) -> tuple[str, int] | None:
        """The first passage of residue in a line, and how many placeholders the line holds if that is one, else 0."""
        if line not in self.judged:
            hit = None
            if m := _CASED.search(line):
                hit = m.group(), sum(1 for _ in _CASED.finditer(line))
            elif m := _UNCASED.search(line):
                hit = m.group(), 0
            elif m := next((m for m in LOREM.finditer(line) if sum(w.lower() in LATIN for w in re.findall(r"\w+", m.group(1))) >= 3), None):
                hit = m.group(), 0
            elif run := latin_run(line):
                hit = run, 0
            self.judged[line] = hit
        return self.judged[line]

    def residue(self, text: str | None) -> str | None:
        """The first passage of residue in a text, or None."""
        if not text or not any(map(self.screen, text.split("\n"))):
            return None
        plain = SPOKEN_OF.sub(" \u2042 ", text)
        if "&" in plain:
            plain = html.unescape(plain)
        lines = plain.split("\n")
        found = [(line, *hit) for line in lines if self.screen(line) and (hit := self.judge(line))]
        held = [line for line, _, n in found if n]
        about = {line for line in held if TUTORIAL.search(line)}
        if not about:
            return found[0][1] if found else None
        few = len(held) <= TUTORIAL_SHARE * sum(1 for line in lines if line.strip())
        tutorial = few and 2 * sum(line in about for line in held) >= len(held) and SHOWS.search(text) is not None
        return next((passage for line, passage, n in found if not n or not (tutorial or (line in about and len(TUTORIAL.findall(line)) >= n))), None)


def latin_run(line: str) -> str | None:
    """The first run of filler Latin in a line, of ``LATIN_RUN`` words or more of which ``LATIN_KINDS`` differ."""
    run: list[str] = []
    for word in [*re.findall(r"\w+", line), ""]:
        if word.lower() in LATIN:
            run.append(word)
        elif len(run) >= LATIN_RUN and len({w.lower() for w in run}) >= LATIN_KINDS:
            return " ".join(run)
        else:
            run = []
    return None


@lru_cache(maxsize=1)
def detector() -> Detector:
    return Detector()


def residue_pages(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, passage``: documents with residue in place of content, and the first passage found.

    Whole texts are searched. Null and empty texts have none; repeated rows give
    one row each; other columns are not read. One scan, no shuffle.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        find = detector().residue
        for pdf in batches:
            found = pd.Series([find(t) for t in pdf[text_col]], dtype=object)
            hit = found.notna().to_numpy()
            yield pd.DataFrame({"doc_id": pdf[id_col][hit], "passage": found[hit]})

    return documents.select(id_col, text_col).mapInPandas(run, f"doc_id {dict(documents.dtypes)[id_col]}, passage string")


def without_residue(documents: DataFrame) -> DataFrame:
    """The documents that hold no residue."""
    return documents.join(residue_pages(documents).select("doc_id").distinct(), "doc_id", "left_anti")
