"""Personal data in free text: found by anchor expansion, replaced by placeholders.

One Aho-Corasick automaton finds all anchors: at-signs and their disguises,
schemes, words that announce an identifier or a person, titles, words for
streets, and the digits that begin a number. From each anchor a deterministic
local parser expands to the boundaries of the value and validates its form,
check digits where the form has one. Expansion ends where the form ends, at no
fixed distance.
"""

from __future__ import annotations

import functools
import re
from bisect import bisect_right
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EMAIL, PHONE, ID_NUMBER, ADDRESS, NAME = "EMAIL", "PHONE", "ID_NUMBER", "ADDRESS", "NAME"
Span = tuple[int, int, str]

# Full-width forms and typographic signs, one character for one.
_PLAIN = {0xFF01 + k: 0x21 + k for k in range(94)} | {
    ord(c): ord(p) for c, p in (("\u2018", "'"), ("\u2019", "'"), ("\u2010", "-"), ("\u2011", "-"), ("\u2012", "-"), ("\u2013", "-"), ("\xa0", " "), ("\u202f", " "), ("\u3000", " "))
}

# --- e-mail -----------------------------------------------------------------

_LOCAL = frozenset("._%+'-")
_DOMAIN = re.compile(r"[A-Za-z0-9À-ɏ](?:[A-Za-z0-9À-ɏ-]*[A-Za-z0-9À-ɏ])?(?:\.[A-Za-z0-9À-ɏ](?:[A-Za-z0-9À-ɏ-]*[A-Za-z0-9À-ɏ])?)*\.[A-Za-zÀ-ɏ]{2,}")
_AT = r"\s*(?:\(\s*(?:at|ät|a|arroba)\s*\)|\[\s*(?:at|ät|a|arroba)\s*\]|\{\s*(?:at|ät)\s*\}|<\s*at\s*>|\s(?:at|arroba)\s)\s*"
_DOT = r"(?:\s*(?:\(\s*(?:dot|punkt|punto)\s*\)|\[\s*(?:dot|punkt|punto)\s*\]|\{\s*(?:dot|punkt)\s*\}|<\s*dot\s*>|\s(?:dot|punkt|punto)\s)\s*|\.)"
_DISGUISED = re.compile(rf"([A-Za-z0-9À-ɏ][A-Za-z0-9À-ɏ_%+-]*(?:{_DOT}[A-Za-z0-9À-ɏ_%+-]+)*?){_AT}([A-Za-z0-9À-ɏ-]+(?:{_DOT}[A-Za-z0-9À-ɏ-]+)*{_DOT}[A-Za-zÀ-ɏ]{{2,}})", re.IGNORECASE)
# Accounts of services, which are nobody's address.
_SERVICES = frozenset("git hg svn ssh root admin noreply no-reply donotreply do-not-reply postmaster mailer-daemon webmaster hostmaster abuse www-data".split())


def _part_of_local(c: str) -> bool:
    return c in _LOCAL or (c.isascii() and c.isalnum()) or "À" <= c <= "ɏ"


def _email(text: str, at: int) -> Span | None:
    start = at
    while start and _part_of_local(text[start - 1]):
        start -= 1
    while start < at and text[start] in _LOCAL:
        start += 1
    right = _DOMAIN.match(text, at + 1)
    if start == at or not right or (text[at - 1] in _LOCAL and text[at - 1] not in "_+"):
        return None
    end = right.end()
    before, after = text[start - 1 : start], text[end : end + 1]
    if before in ("/", "@") or text[max(0, start - 3) : start] == "://":
        return None
    if before == ":" and not text[max(0, start - 7) : start].lower().endswith("mailto:"):
        word = 1 + max(text.rfind(c, 0, start) for c in " \n\t")
        if "://" in text[word:start]:
            return None
    if text[start:at].lower() in _SERVICES or (after == ":" and re.match(r":[\w~/]", text[end : end + 2])):
        return None
    return start, end, EMAIL


def _disguised(text: str, anchors: list[int]) -> Iterator[Span]:
    """Addresses around written-out at-signs and dots, of which some end at ``anchors``."""
    for m in _DISGUISED.finditer(text):
        at = bisect_right(anchors, m.start(1))
        if at < len(anchors) and anchors[at] <= m.end():
            # A spaced "at" is ordinary prose unless a written-out dot follows.
            if re.search(r"[\[({<]", text[m.end(1) : m.start(2)]) or re.search(r"\s(?:dot|punkt|punto)\s", m.group(2), re.IGNORECASE):
                yield m.start(1), m.end(), EMAIL


# --- telephone, identity numbers --------------------------------------------

# Written forms of telephone numbers, by country code or trunk prefix.
_PHONE_FORMS = r"""(?:
      \+1[ .-]?\(\d{3}\)[ .-]?\d{3}[ .-]?\d{4}
    | \+1[ .-]\d{3}[ .-]\d{3}[ .-]\d{4}
    | \+33[ .-]?(?:\(0\)[ ]?)?\d(?:[ .-]\d{2}){4}
    | \+44[ ]?(?:\(0\)[ ]?)?(?:\d{2}[ ]\d{4}[ ]\d{4}|\d{4}[ ]\d{6}|\d{3}[ ]\d{3}[ ]\d{4}|7\d{3}[ ]\d{3}[ ]\d{3})
    | \+49[ ]?(?:\(0\)[ ]?)?\d{2,4}[ /-]\d{3,8}(?:[ -]\d{1,4})?
    | \+61[ ]?(?:\(0\)[ ]?)?(?:\d{3}[ ]\d{3}[ ]\d{3}|\d[ ]\d{4}[ ]\d{4})
    | \+86[ -]?1\d{2}[ -]?\d{4}[ -]?\d{4}
    | \+(?!1[ .(-]|33[ .(-]|44[ (]|49[ (]|61[ (]|86[ -])\d{1,3}[ .-](?:\(\d{1,4}\)[ .-]?)?\d{2,5}(?:[ .-]\d{2,5}){1,3}
    | \+\d{9,15}
    | \(\d{3}\)[ ]?\d{3}[ .-]\d{4}
    | \(0\d{2,4}\)[ ]?\d{3,8}(?:[ -]\d{1,4})?
    | [2-9]\d{2}(?P<sep>[.-])\d{3}(?P=sep)\d{4}
    | 0\d(?:[ .]\d{2}){4}
    | 07\d{3}[ ]\d{6}
    | 0[234578]\d{2}[ ]\d{3}[ ]\d{3,4}
    | 02\d[ ]\d{4}[ ]\d{4}
    | 0\d{2,4}/\d{3,9}(?:-\d{1,4})?
    | 0\d{2,4}[ ]\d{5,8}-\d{1,4}
    )(?![0-9A-Za-z@_]|[./:-]\d)"""
_PHONE = re.compile(r"(?<![0-9A-Za-z+@=_#:/.,-])" + _PHONE_FORMS, re.VERBOSE)
_AFTER_CUE = re.compile(_PHONE_FORMS, re.VERBOSE)
# Forms that are numbers of a telephone only where a word says so.
_CALLED = re.compile(r"(?:1[3-9]\d[ -]?\d{4}[ -]?\d{4}|0\d{2,4}[ -]?\d{5,8}|[2-9]\d{2}[ ]\d{3}[ ]\d{4}|[2-9]\d{9}|0\d{8,10})(?![0-9A-Za-z])")
_SSN = re.compile(r"(?<![0-9A-Za-z.,-])(?!000)\d{3}([ -])(?!00)\d{2}\1(?!0000)\d{4}(?![0-9A-Za-z]|[.,-]\d)")
_RESIDENT = re.compile(r"(?<![0-9A-Za-z])[1-9]\d{5}(?:19|20)\d{2}(?:0[1-9]|1[0-2])(?:0[1-9]|[12]\d|3[01])\d{3}[0-9Xx](?![0-9A-Za-z])")
_PASSPORT = re.compile(r"(?<![0-9A-Za-z])(?:[A-Za-z]{1,2}[ ]?\d{6,9}|[CFGHJKLMNPRTVWXYZ][CFGHJKLMNPRTVWXYZ0-9]{8}|\d{9})(?![0-9A-Za-z])")
_TAX = re.compile(r"(?<![0-9A-Za-z])(?:\d{2}[ ]\d{3}[ ]\d{3}[ ]\d{3}|\d{11}|\d{3}[./]\d{3}[./]\d{3}[.-]?\d{0,2}|\d{2}-\d{7})(?![0-9A-Za-z])")
_SOCIAL = re.compile(r"(?<![0-9A-Za-z])\d{3}[ -]?\d{2}[ -]?\d{4}(?![0-9A-Za-z])")
_LABEL_GAP = re.compile(r"[\s:：.#=-]*(?:(?:no|nr|num(?:ber|ero|mer)?|is|ist|es|lautet|on file|是|为|号码?)[\s:：.#=-]*){0,3}", re.IGNORECASE)

# --- addresses --------------------------------------------------------------

_CAPITAL = r"[A-ZÀ-ÖØ-Þ][\w'-]*"
_STREETS_EN = "street|road|lane|avenue|ave|court|drive|close|way|place|square|terrace|crescent|boulevard|blvd|highway|parkway"
_ADDRESS_EN = re.compile(rf"(?<![\w.,/:-])\d{{1,5}}[A-Za-z]?(?:-\d{{1,4}})?\s(?:{_CAPITAL}\s){{1,3}}(?i:{_STREETS_EN}|st|rd|ln)(?![\w-])")
_STREETS_DE = ("straße", "strasse", "str.", "weg", "platz", "allee", "gasse", "ring", "damm", "ufer")
_ADDRESS_DE = (
    re.compile(rf"(?<![\w-])(?:(?:Am|An\sder|Auf\sdem|Auf\sder|Im|In\sder|Zum|Zur|Unter\sden|Alte[rn]?|Neue[rn]?|Gro(?:ß|ss)e|Kleine)\s)?[A-ZÄÖÜ][\wäöüß-]*(?i:straße|strasse|str\.|weg|platz|allee|gasse|ring|damm|ufer)\s\d{{1,4}}[A-Za-z]?(?!\w)"),
    re.compile(r"(?<![\w-])[A-ZÄÖÜ][\wäöüß-]+\s(?:Straße|Strasse|Str\.|Weg|Platz|Allee|Gasse|Ring|Damm|Ufer|STRASSE|STRAẞE|WEG|PLATZ)\s\d{1,4}[A-Za-z]?(?!\w)"),
)
_STREETS_ES = ("calle", "avenida", "avda.", "plaza", "paseo", "camino", "carrera", "rua", "travessa", "praça", "largo")
_ADDRESS_ES = re.compile(rf"(?<![\w-])(?i:calle|avenida|avda\.|plaza|paseo|camino|carrera|rua|travessa|praça|largo)\s(?:(?:de|da|do|dos|del|la|las|los|el)\s){{0,3}}{_CAPITAL}(?:\s(?:(?:de|da|do|del|la)\s)?{_CAPITAL})?,?\s(?:n[º.o]\s?)?\d{{1,5}}[A-Za-z]?(?!\w)")
_STREETS_ZH = ("路", "街", "巷", "大道", "道", "弄", "胡同")
_NUMBER_ZH = re.compile(r"\d{1,5}号?")
# Characters that end the words before a street's name.
_ZH_BEFORE = frozenset("到在是为住往至于的归了和与及")


def _english(text: str, start: int) -> Span | None:
    m = _ADDRESS_EN.match(text, start)
    return (start, m.end(), ADDRESS) if m else None


def _german(text: str, begin: int, end: int) -> Span | None:
    """Around a word for a street from ``begin`` to ``end``, which a number must follow."""
    if not (text[end + 1 : end + 2].isdigit() and text[end].isspace()):
        return None
    # The street's name begins with this word, the one before, or the one before that.
    starts, at = [], begin
    for _ in range(3):
        while at and (text[at - 1].isalnum() or text[at - 1] in "-_"):
            at -= 1
        starts.append(at)
        if not at or not text[at - 1].isspace():
            break
        at -= 1
    for start in reversed(starts):
        for pattern in _ADDRESS_DE:
            m = pattern.match(text, start)
            if m and m.end() > end:
                return start, m.end(), ADDRESS
    return None


def _spanish(text: str, begin: int, end: int) -> Span | None:
    m = _ADDRESS_ES.match(text, begin)
    return (begin, m.end(), ADDRESS) if m else None


def _chinese(text: str, begin: int, end: int) -> Span | None:
    """A street's name has one to four characters; a word that leads to it ends it."""
    m = _NUMBER_ZH.match(text, end)
    start = begin
    while m and start > max(0, begin - 4) and "一" <= text[start - 1] <= "鿿" and text[start - 1] not in _ZH_BEFORE:
        start -= 1
    return (start, m.end(), ADDRESS) if m and start < begin else None


_TAIL = re.compile(r"\s?,?\s(?:Flat|Apt|Apartment|Unit|Suite|Whg|Wohnung|Piso|室)\.?\s?\w{1,4}|,\s\d{4,6}\s[A-ZÀ-Þ][\w-]+")

# --- names ------------------------------------------------------------------

_TOKEN = r"[A-Za-zÀ-ɏ]+(?:'[A-Za-zÀ-ɏ]{2,})*(?:-[A-Za-zÀ-ɏ]+(?:'[A-Za-zÀ-ɏ]{2,})*)*"
_PARTICLE = r"(?:(?:de|del|della|di|da|do|dos|du|van|von|vom|der|den|ter|la|le|al|el|bin|ibn|zu|DE|DEL|DI|DA|DO|DOS|DU|VAN|VON|DER|DEN|LA|LE|AL|BIN) )"
_INITIAL = r"(?:[A-Za-zÀ-ɏ]\. ?)"
_NAME = rf"(?:{_PARTICLE}{{0,3}}{_TOKEN}, (?:{_INITIAL}|{_TOKEN})|{_INITIAL}{{0,2}}{_TOKEN}(?: {_INITIAL})?(?: {_PARTICLE}{{0,3}}{_TOKEN})?|{_PARTICLE}{{1,3}}{_TOKEN})"
_TITLE = r"(?:(?:Dr|Mr|Mrs|Ms|Mx|Miss|Prof|Professor|Sir|Herr|Herrn|Frau|Hr|Fr|Sr|Sra|Srta|Don|Doña|Dra|Ing|Mag|Dipl|Mme|Mlle)\.? )"
_TITLES = re.compile(rf"{_TITLE}+", re.IGNORECASE)
_LAST_COMMA_INITIAL = re.compile(rf"{_TOKEN},\s[A-Za-zÀ-ɏ]\.?$")
# Words that are no part of a name, in the languages of the data.
_ORDINARY = frozenset(
    """a about again all alive along also am an and any are as ask asked at be been before blocks bot both build but by call can card cc clone cost could counted
    crew did do does done each exit export file first fix for from get git give good got green had has hash have he her here his how i id if in into is it its just keep
    kept last let log mail may me merged mobile more ms my never new next no nobody not note now of off on once only open or our out over owner page per pin ping
    please port queue release retry ring rollout rows run running said say says second see send she ship site slow so some span still ssn sure team tel thank thanks that the
    their them then there these they this time to today tomorrow total trace us user was way we were what when where which while who why will with without yes
    yet you your der die das den dem des ein eine und oder aber wenn weil dass ich du er es sie wir nicht mehr zu auf am im mit ohne von nach vor bei seit bitte denn war
    ist haben hat sonst alles was danach nur damit kann warum bevor danke siehe jetzt adresse gruß ruf schick rückfragen wohnt mobil reisepass steuer idnr protokoll ganze registro completo full
    el la los las un una y o pero si porque que del en con sin por para ya se lo le está más creo hemos todo nadie desde tras solo después cuando este esta puede favor
    antes gracias he ver manda envía llámame pasaporte adios
    monday tuesday wednesday thursday friday saturday sunday january february march july september october november december
    montag dienstag mittwoch donnerstag freitag samstag sonntag januar februar märz juni juli oktober dezember lunes martes miércoles jueves viernes sábado domingo enero febrero marzo junio julio septiembre octubre noviembre diciembre
    manager policy admin operator customer customers client support everyone everybody folks guys friend friends colleague colleagues sir madam boss reviewer author maintainer request ticket default
    design documentation spec contract agreement usual kollege kollegen zusammen world welt mundo kunde leiter cliente equipo jefe todos compañeros""".split()
)
_BOTS = re.compile(r"(?i)(?:^|[\s_-])(?:bots?|crew|team|runner|helper|agent|assistant|server|service|system|form|intake|inbox|dispatch|notifications?|alerts?|mailer|gateway|pipeline|oncall|on-call|desk|queue|ledger)(?:$|[\s_-])|助手|机器人|群")


def _case(token: str) -> str:
    core = token.replace("'", "").replace("-", "")
    return "upper" if core.isupper() and len(core) > 1 else "lower" if core[:1].islower() else "title"


def _trimmed(text: str, start: int, end: int, from_right: bool) -> tuple[int, int] | None:
    """Drops tokens that are ordinary words or written in another case than the name."""
    found = text[start:end]
    if "," in found:
        last = found.split(",")
        if any(w.strip().lower() in _ORDINARY for w in last) or _case(last[0].split()[-1]) != _case(last[1].split()[0].rstrip(".")):
            # Perhaps only the part next to the anchor is the name.
            cut = found.index(",")
            if from_right:
                start = start + cut + 1 + (len(found[cut + 1 :]) - len(found[cut + 1 :].lstrip()))
            else:
                end = start + cut
            found = text[start:end]
            if found.strip().lower() in _ORDINARY:
                return None
        return start, end
    parts = [(m.start() + start, m.end() + start, m.group()) for m in re.finditer(r"\S+", found)]
    solid = [p for p in parts if not re.fullmatch(_INITIAL, p[2]) and not re.fullmatch(_PARTICLE, p[2] + " ")]
    if not solid:
        return None
    if len(solid) == 2:
        first, second = solid
        other, near = (first, second) if from_right else (second, first)
        if near[2].lower() in _ORDINARY:
            return None
        if other[2].lower() in _ORDINARY or _case(other[2]) != _case(near[2]):
            if from_right:
                start = near[0]
                before = [p for p in parts if other[1] <= p[0] < near[0]]
                start = before[0][0] if before else near[0]
            else:
                end = near[1]
    elif solid[0][2].lower() in _ORDINARY:
        return None
    return start, end


def _left(opening: str, closing: str):
    """A phrase before a name; ``closing`` must follow unless empty."""
    pattern = re.compile(rf"(?:{_TITLE})*({_NAME})(?={closing})" if closing else rf"(?:{_TITLE})*({_NAME})", 0)
    any_case = re.compile(rf"(?i:{_TITLE})*")

    def parse(text: str, after: int) -> Span | None:
        begin = any_case.match(text, after).end()
        m = pattern.match(text, begin)
        if not m:
            return None
        span = _trimmed(text, m.start(1), m.end(1), False) if not closing else (m.start(1), m.end(1))
        if span is None or (text[span[0] : span[1]].lower() in _ORDINARY):
            return None
        return span[0], span[1], NAME

    return parse


_BACKWARD = re.compile(rf"(?<![\w'@.+-])({_NAME})$")


def _right(text: str, before: int) -> Span | None:
    """The name that ends at ``before``; it begins on the same line and has at most a dozen words."""
    cut = low = max(text.rfind("\n", 0, before), text.rfind("`", 0, before)) + 1
    at = before
    for _ in range(12):
        at = text.rfind(" ", low, at)
        cut = max(at, low)
        if at < 0:
            break
    m = _BACKWARD.search(text, cut, before)
    if not m:
        return None
    start, end = m.start(1), m.end(1)
    title = _TITLES.match(text[start:end])
    if title and title.end() < end - start:
        start += title.end()
    span = _trimmed(text, start, end, True)
    if span is None:
        return None
    return span[0], span[1], NAME


# Capitalised words of a person named where nothing else tells that it is one.
_CAPITALISED = r"[A-ZÀ-ÖØ-Þ](?:'[A-ZÀ-ÖØ-Þ])?[a-zß-ÿĀ-ɏ]+(?:'[A-Za-zÀ-ɏ]{2,}|-[A-Za-zÀ-ɏ]+)*"
_FULL_NAME = rf"{_CAPITALISED}(?: [A-Z]\.)?(?: (?:(?:de|del|della|di|da|do|dos|du|van|von|vom|der|den|ter|la|le|al|el|bin|ibn|zu) ){{0,3}}{_CAPITALISED}){{1,2}}"
_TITLED = r"(?:(?i:Dr|Mr|Mrs|Ms|Mx|Miss|Prof|Professor|Sir|Herr|Herrn|Frau|Sr|Sra|Srta|Señora?|Don|Doña|Dra|Mme|Mlle)\.? )"


_SOME_NAME = rf"(?:{_FULL_NAME}|(?:[A-Z]\. ?){{1,2}}{_CAPITALISED}|{_CAPITALISED})"


def _announced(least: int = 1, closing: str = ""):
    """A capitalised name right after its cue, of ``least`` words at least unless a title or initial leads it."""
    pattern = re.compile(rf"\s*((?:{_TITLED})*)({_SOME_NAME})(?![\w@])" + (f"(?={closing})" if closing else ""))
    titled = lambda m: bool(m.group(1)) or m.group(2)[1:2] == "."

    def parse(text: str, after: int) -> Span | None:
        m = pattern.match(text, after)
        if not m:
            return None
        # A name ends before the first ordinary word, and particles before that word are none of it.
        end, kept = m.start(2), 0
        for w in re.finditer(r"\S+", m.group(2)):
            if w.group()[0].isupper():
                if w.group().lower() in _ORDINARY:
                    break
                end, kept = m.start(2) + w.end(), kept + 1
        if not kept or (kept < least and not titled(m)):
            return None
        return m.start(2), end, NAME

    return parse


# Ordinary ways to introduce, name, greet and sign, and the commonest Chinese family names.
_INTRODUCED = ("my name is", "my name's", "mein name ist", "ich heiße", "ich heisse", "me llamo", "mi nombre es", "je m'appelle")
_MENTIONED = (
    "contact", "spoke with", "spoke to", "talked to", "talk to", "speak to", "speak with", "met with", "signed by", "written by", "reported by", "assigned to", "on behalf of", "forwarded by", "attn:",
    "ansprechpartner ist", "ansprechpartnerin ist", "gesprochen mit", "wenden sie sich an", "im auftrag von", "hablé con", "contacte a", "contacte con", "firmado por", "en nombre de", "hable con",
)
_ADDRESSED = ("mr.", "mrs.", "ms.", "dr.", "prof.", "mr", "mrs", "ms", "herr", "herrn", "frau", "señor", "señora", "sr.", "sra.")
_GREETED = ("dear", "hi", "hello", "hey", "hallo", "hola", "liebe", "lieber", "estimado", "estimada", "querido", "querida")
_SIGNED = ("regards", "sincerely", "best wishes", "best", "cheers", "grüße", "grüßen", "gruß", "saludos", "atentamente", "cordialement")
_SIGNATURE = re.compile(rf"[,.]?[ \t]*\n\s*{_TITLED}*({_SOME_NAME})[ \t]*(?=\n|$)")
_NAMED_ZH = ("我叫", "我的名字是", "联系人是", "联系人：", "联系人:")
_FAMILY_ZH = "王李张刘陈杨黄赵吴周徐孙马朱胡郭何高林罗郑梁谢宋唐许韩冯邓曹彭曾肖田董袁潘于蒋蔡余杜叶程苏魏吕丁任沈姚卢姜崔钟谭陆汪范金石廖贾夏韦傅方白邹孟熊秦邱江尹薛闫段雷侯龙史陶黎贺顾毛郝龚邵万钱严覃武戴莫孔向汤"
_NAME_ZH = re.compile(rf"\s*([{_FAMILY_ZH}][一-鿿]{{1,2}})(?=[，。,.！!、；;\s]|$)")


def _signed(text: str, after: int) -> Span | None:
    m = _SIGNATURE.match(text, after)
    return (m.start(1), m.end(1), NAME) if m and m.group(1).split()[0].lower() not in _ORDINARY else None


def _named_zh(text: str, after: int) -> Span | None:
    m = _NAME_ZH.match(text, after)
    return (m.start(1), m.end(1), NAME) if m else None


_END = r"\s*(?:[!.,;:…。！]|\n|$)"
# Phrases that announce a person, with what closes the name.
_NAME_LEFT = {
    "thanks, ": _END, "thank you, ": _END, "thx ": _END, "ping @": r"\sabout|" + _END, "per ": r"\s*:", "as ": r"\s(?:said|says|wrote|noted)",
    "这个归": r"\s*管", "这个归 ": r"\s*管", "请 @": r"\s*看", "请@": r"\s*看", "bitte mit ": r"\sklären", "lo pidió ": _END,
    "gruß, ": "", "grüße, ": "", "gracias, ": "", "regards, ": "", "cheers, ": "", "merci, ": _END, "danke, ": r"!", "saludos, ": "",
}
_NAME_RIGHT = (" asked for it", " hat danach gefragt", "'s card is", " 说先不要动", "说先不要动", " wants to know")
_PASSPORT_CUES = ("passport", "reisepass", "pasaporte", "passaporte", "passeport", "护照号码", "护照号", "护照")
_TAX_CUES = ("tax id", "taxpayer id", "tax number", "tax no", "tin:", "steuer-id", "steuer-idnr", "steueridentifikationsnummer", "idnr", "nif", "cpf", "税号", "纳税人识别号")
_RESIDENT_CUES = ("身份证号码", "身份证号", "身份证")
_SOCIAL_CUES = ("ssn", "social security")
_PHONE_CUES = ("tel", "phone", "mobil", "call me", "ring ", "手机", "电话", "llámame", "ruf mich", "number's")


@functools.cache
def _automaton() -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    cues: dict[str, list] = {}

    def add(word: str, kind: str, parse=None) -> None:
        cues.setdefault(word, []).append((kind, parse, len(word)))

    add("@", "at")
    for word in ("(at)", "( at )", "[at]", "[ at ]", "{at}", "<at>", "(ät)", "(a)", "[a]", " dot ", " punkt ", " punto ", "(arroba)", "[arroba]", " arroba "):
        add(word, "disguise")
    for word in _PASSPORT_CUES:
        add(word, "number", _PASSPORT)
    for word in _TAX_CUES:
        add(word, "number", _TAX)
    for word in _RESIDENT_CUES:
        add(word, "number", _RESIDENT)
    for word in _SOCIAL_CUES:
        add(word, "number", _SOCIAL)
    for word in _PHONE_CUES:
        add(word, "phone")
    for word, closing in _NAME_LEFT.items():
        add(word, "left", _left(word, closing))
    for word in _NAME_RIGHT:
        add(word, "right")
    for words, parse in ((_INTRODUCED, _announced()), (_MENTIONED, _announced(2)), (_ADDRESSED, _announced()), (_GREETED, _announced(1, r"\s*(?:[,!:]|\n|$)"))):
        for word in words:
            add(word + " ", "left", parse)
    for word in _SIGNED:
        add(word, "left", _signed)
    for word in _NAMED_ZH:
        add(word, "left", _named_zh)
    for words, parse in ((_STREETS_DE, _german), (_STREETS_ES, _spanish), (_STREETS_ZH, _chinese)):
        for word in words:
            add(word, "street", parse)
    for digit in "0123456789":
        add(digit, "digit")
    for word, entries in cues.items():
        machine.add_word(word, entries)
    machine.make_automaton()
    return machine


def _lowered(text: str) -> str:
    low = text.lower()
    return low if len(low) == len(text) else "".join(c if len(c.lower()) != 1 else c.lower() for c in text)


_CUE_GAP = re.compile(r"[\s:：.=]*")


def _resident(text: str, start: int) -> Span | None:
    m = _RESIDENT.match(text, start)
    if not m:
        return None
    weights = (7, 9, 10, 5, 8, 4, 2, 1, 6, 3, 7, 9, 10, 5, 8, 4, 2)
    check = "10X98765432"[sum(w * int(c) for w, c in zip(weights, m.group(), strict=False)) % 11]
    return (start, m.end(), ID_NUMBER) if m.group()[17].upper() == check else None


def _numbers(text: str, start: int, spans: list[Span], phone_to: int) -> int:
    """What the number that begins at ``start`` is; gives the end of the last telephone number."""
    if start >= phone_to:
        lead = start - 1 if start and text[start - 1] in "+(" else start
        m = _PHONE.match(text, lead) or (_PHONE.match(text, start) if lead < start else None)
        if m:
            phone_to = m.end()
            spans.append((m.start(), m.end(), PHONE))
    m = _SSN.match(text, start)
    found = (start, m.end(), ID_NUMBER) if m else _resident(text, start)
    for span in (found, _english(text, start)):
        if span:
            spans.append(span)
    return phone_to


def find_in_text(original: str) -> list[Span]:
    """The spans of personal data in a free text, sorted, none inside another."""
    text = original.translate(_PLAIN)
    spans: list[Span] = []
    names: list[Span] = []
    disguises: list[int] = []
    phone_to = 0
    for end, entries in _automaton().iter(_lowered(text)):
        for kind, parse, size in entries:
            begin = end - size + 1
            if kind == "digit":
                if not begin or not text[begin - 1].isdigit():
                    phone_to = _numbers(text, begin, spans, phone_to)
                continue
            if kind == "at":
                found = _email(text, end)
            elif kind == "disguise":
                disguises.append(end)
                continue
            elif kind == "street":
                found = parse(text, begin, end + 1)
            elif kind == "number":
                if begin and text[begin - 1].isascii() and text[begin - 1].isalnum():
                    continue
                gap = _LABEL_GAP.match(text, end + 1).end()
                m = parse.match(text, gap)
                found = (m.start(), m.end(), ID_NUMBER) if m else None
            elif kind == "phone":
                gap = _CUE_GAP.match(text, end + 1).end()
                m = _AFTER_CUE.match(text, gap) or _CALLED.match(text, gap)
                found = (m.start(), m.end(), PHONE) if m else None
            elif kind == "left":
                if begin and (text[begin - 1].isalnum() and text[begin].isascii()):
                    continue
                found = parse(text, end + 1)
            else:
                found = _right(text, begin)
            if found:
                (names if found[2] == NAME else spans).append(found)
    if disguises:
        spans += _disguised(text, disguises)
    closed = list(spans)
    for start, end, kind in spans:
        if kind == ADDRESS:
            while tail := _TAIL.match(text, end):
                end = tail.end()
            closed.append((start, end, kind))
    out = set(spans)
    for start, end, kind in names:
        # Text that belongs to an address is no name; what is left of it may be.
        inside = [b for a, b, _ in closed if a < end and b > start]
        if inside:
            rest = max(inside)
            while rest < end and text[rest] in " ,":
                rest += 1
            if rest >= end or not any(a <= start for a, b, _ in closed if a < end and b > start):
                continue
            start = rest
        if not _BOTS.search(text[start:end]):
            out.add((start, end, kind))
    return _outermost(out)


def _outermost(spans: set[Span]) -> list[Span]:
    out: list[Span] = []
    for span in sorted(spans, key=lambda s: (s[0], -s[1], s[2])):
        if out and span[1] <= out[-1][1]:
            continue
        out.append(span)
    return out


_REMARK = re.compile(r"\([^)]*\)|\[[^\]]*\]")
_WHOLE_NAME = re.compile(rf"(?:{_NAME})(?:\s{_PARTICLE}{{0,3}}{_TOKEN})?")


def find_in_name(original: str) -> list[Span]:
    """The spans in a field that holds a sender's name: the person and addresses."""
    text = original.translate(_PLAIN)
    spans: list[Span] = []
    for m in re.finditer("@", text):
        found = _email(text, m.start())
        if found:
            spans.append(found)
    spans += [(m.start(), m.end(), PHONE) for m in _PHONE.finditer(text)]
    rest = text
    for start, end, _ in spans:
        rest = rest[:start] + "\0" * (end - start) + rest[end:]
    rest = _REMARK.sub(lambda m: "\0" * len(m.group()), rest)
    bare = re.sub(r"[\0<>@\"]", " ", rest)
    start, end = len(bare) - len(bare.lstrip()), len(bare.rstrip())
    title = _TITLES.match(bare, start, end)
    if title:
        start = title.end()
    candidate = bare[start:end]
    if candidate and _WHOLE_NAME.fullmatch(candidate) and not _BOTS.search(candidate) and not candidate.islower() and not _BOTS.search(original):
        spans.append((start, end, NAME))
    return _outermost(set(spans))


def redact(text: str | None, in_name: bool = False) -> str | None:
    """``text`` with each value replaced by ``[TYPE]``; the rest stays as it is."""
    if not text:
        return text
    out, at = [], 0
    for start, end, kind in find_in_name(text) if in_name else find_in_text(text):
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
            at = end
    return "".join(out) + text[at:]


def personal_data(events: DataFrame, id_col: str = "row_id") -> DataFrame:
    """(row_id, field_name, pii_type, pii_text): each distinct value in ``text`` and ``name``.

    Null, empty and blank fields give no rows; whole texts are searched.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, fields, kinds, values = [], [], [], []
            seen: dict[str, list[Span]] = {}
            read: dict[str, list[Span]] = {}
            for row, text, name in zip(batch[id_col].to_pylist(), batch["text"].to_pylist(), batch["name"].to_pylist(), strict=True):
                if text:
                    spans = read.get(text)
                    if spans is None:
                        spans = read[text] = find_in_text(text)
                    for kind, value in dict.fromkeys((k, text[a:b]) for a, b, k in spans):
                        ids.append(row), fields.append("text"), kinds.append(kind), values.append(value)
                if name:
                    spans = seen.get(name)
                    if spans is None:
                        spans = seen[name] = find_in_name(name)
                    for kind, value in dict.fromkeys((k, name[a:b]) for a, b, k in spans):
                        ids.append(row), fields.append("name"), kinds.append(kind), values.append(value)
            columns = [pa.array(ids, batch[id_col].type), *(pa.array(x, pa.string()) for x in (fields, kinds, values))]
            yield pa.RecordBatch.from_arrays(columns, [id_col, "field_name", "pii_type", "pii_text"])

    kind = events.schema[id_col].dataType.simpleString()
    return events.select(id_col, "text", "name").mapInArrow(run, f"`{id_col}` {kind}, field_name string, pii_type string, pii_text string")


def redacted(events: DataFrame) -> DataFrame:
    """``events`` with typed placeholders in ``text`` and ``name``."""
    schema = events.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            for at, name in enumerate(batch.schema.names):
                if name in ("text", "name"):
                    columns[at] = pa.array([redact(x, name == "name") for x in batch[name].to_pylist()], batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return events.mapInArrow(run, schema)


def counts_by_type(events: DataFrame) -> DataFrame:
    return personal_data(events).groupBy("field_name", "pii_type").agg(F.count("*").alias("n"))
