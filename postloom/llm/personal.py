"""Personal data in free text, replaced by typed placeholders.

Patterns propose spans; checksums confirm identity numbers; words near a span raise or lower its score; spans at or above the threshold count,
and of overlapping ones the best. Names are proposed from a lexicon of the corpus' own author names, kept as a Bloom filter that is sized by
their number and built by a distributed aggregation, and from the words that introduce a person. Texts are read where they lie, in one pass.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..session import written
from . import bloom

THRESHOLD = 0.5

_AT = r"(?:\s?[@＠]\s?|\s*[\[(]\s*at\s*[\])]\s*)"
_DOT = r"(?:\.|\s*[\[(]\s*dot\s*[\])]\s*|\s+dot\s+)"
EMAIL = re.compile(rf"(?<![\w/.+-])[\w+-]+(?:{_DOT}[\w+-]+)*{_AT}[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)*{_DOT}[A-Za-z]{{2,}}(?![\w-])|(?<![\w/.+-])[\w+-]+(?:{_DOT}[\w+-]+)*\s+at\s+[A-Za-z0-9-]+(?:(?:\s+dot\s+|\s*[\[(]\s*dot\s*[\])]\s*)[A-Za-z0-9-]+)+(?![\w-])", re.I)
_EMAIL_LIKELY = re.compile(r"[@＠]|\bdot\b|[\[(]\s*(?:at|dot)\s*[\])]", re.I)

_DIGIT_WORD = r"(?:zero|oh|one|two|three|four|five|six|seven|eight|nine|null|eins|zwei|drei|vier|fünf|sechs|sieben|acht|neun|cero|uno|dos|tres|cuatro|cinco|seis|siete|ocho|nueve)"
PHONE_SPELLED = re.compile(rf"\b(?:(?:double|triple)\s+)?{_DIGIT_WORD}(?:[\s,.-]+(?:double\s+|triple\s+)?{_DIGIT_WORD}){{6,14}}\b", re.I)
PHONE = re.compile(r"(?<![\w.@#/-])(?:\+[ \t]?|\()?\d(?:[ \t./()-]{0,3}\d){6,14}(?![\w@]|[.-]\d)")
_PHONE_WORDS = re.compile(r"\b(?:call|phone|telephone|tel|mobile|cell|dial|ring|reach|text me|sms|whatsapp|signal|number is|new number|my number|desk line|landline|hotline|fax|pager|get me on|reach me|at me on|llam\w*|número|telefon\w*|rufnummer|anruf\w*|ruft|handy|nummer|appel\w*|numéro|portable|lig\w+|telemóvel|celular|chiam\w*|numero|cellulare|bel\b|bellen|ring\w*|nummer|zadzwo\w*|dzwo\w*|ara\w*|published|forwards to|звон\w*|телефон\w*|номер\w*|電話|电话)\b", re.I)
_NOT_PERSONAL = re.compile(r"\b(?:order|ticket|invoice|build|version|release|section|row|rows|issue|case|ref|reference|trace|incident|sku|part|serial|batch|commit|ip|gateway|port|pull request|pr|jira|tracking|shipment|parcel|job|run|error code|processed|bestellung|pedido|commande|auftrag)\b[\s#:.]*(?:no\.?|number|id|nr\.?)?[\s#:]*(?:[A-Z]{1,5}-)?$", re.I)

_ID_KIND = r"""(?:social\s+security(?:\s+(?:number|no\.?|num))?|ssn|soc(?:ial)?\s?sec|national\s+insurance(?:\s+(?:number|no\.?))?|ni\s?(?:number|no\.?)|nino|passport(?:\s+(?:no\.?|number|num|nr\.?|id))?|pasaporte|passeport|reisepass(?:nummer|nr\.?)?|passaporte|passaporto|paspoort(?:nummer)?
  |pesel|nip|personnummer|personnr\.?|samordningsnummer|fødselsnummer|cpr|hetu|dni|nie|nif|cif|aadhaar|aadhar|pan\s?(?:card|number)|steuer-?\s?id(?:entifikationsnummer)?|steueridentifikationsnummer|steuernummer|idnr\.?|sozialversicherungsnummer|personalausweis(?:nummer|nr\.?)?|ausweis(?:nummer|nr\.?)
  |codice\s+fiscale|carta\s+d['’]identità|insee|nir|numéro\s+de\s+sécurité\s+sociale|sécurité\s+sociale|bsn|burgerservicenummer|sofinummer|cpf|rg|curp|rfc|nss|cédula|cedula|rut|tax\s+(?:id|number|no\.?)|taxpayer\s+(?:id|number)|tin|itin|identity\s+card(?:\s+(?:no\.?|number))?|id\s+card(?:\s+(?:no\.?|number))?|national\s+id(?:entity)?(?:\s+(?:card|no\.?|number))?|kimlik(?:\s+no)?|tc\s+kimlik(?:\s+no)?|vergi\s+no|sin|medicare(?:\s+(?:no\.?|number))?|driver'?s?\s+licen[cs]e(?:\s+(?:no\.?|number))?|инн|снилс|паспорт|身份证(?:号)?|マイナンバー)"""
NATIONAL_ID = re.compile(rf"(?<![\w-])(?P<kind>{_ID_KIND})(?P<between>\s*(?:[:#=]|is|was|are|ist|est|es|è|é|of|number|no\.?|nr\.?|\()?\s*[:#(]?\s*)(?P<id>(?=[A-Z]*[ -]?(?:[A-Z0-9./ -]*\d){{4}})[A-Z]{{0,4}}[ .-]?\d[\dA-Z]*(?:[ ./-][\dA-Z]*\d[\dA-Z]*)*(?:[ -]?[A-Z])?)(?![\w])", re.I | re.X)
BARE_ID = re.compile(r"(?<![\w.@/-])(?:\d{3}-\d{2}-\d{4}|\d{6}[-+]\d{4}|\d{6}[-+A]\d{3}[A-HJ-NPR-Y]|\d{3}\.\d{3}\.\d{3}-\d{2}|\d{8}-?[A-HJ-NP-TV-Z]|[XYZ]-?\d{7}-?[A-HJ-NP-TV-Z]|[A-CEGHJ-PR-TW-Z][A-CEGHJ-NPR-TW-Z] ?\d{2} ?\d{2} ?\d{2} ?[A-D]|[12] ?\d{2} ?\d{2} ?\d{2,3} ?\d{3} ?\d{3} ?\d{2}|\d{4} \d{4} \d{4}|\d{2} \d{3} \d{3} \d{3}|\d{11})(?![\w]|[.-]\d)")

_EN_TYPE = r"(?:street|avenue|road|lane|boulevard|drive|court|place|square|terrace|close|crescent|parkway|highway|way|walk|mews|hill|row|st|ave|rd|ln|blvd|dr|ct|pl|sq|ter|cres|pkwy|hwy)"
_NAME_WORD = r"(?!(?:and|or|the|of|to|in|on|at|for|with|from|by|a|an|is|was|are|were|people|weeks?|months?|days?|hours?|percent|open|mistakes?|messages?|jobs?|items?|tickets?|rows?|pages?|tests?|minutes?|years?|internal|more|fewer|questions?)\b)[^\W\d_][\w'’-]*"
_TO = r"(?:[^\W\d_][\w'’.-]*)"
ADDRESS = re.compile(
    rf"""
    \b\d{{1,5}}[a-z]?,?\s+(?:{_NAME_WORD}\s+){{1,3}}{_EN_TYPE}\b\.?(?:\s*(?:\#|apt\.?|unit|suite|no\.?)\s*\w+)?(?:,\s*[^\W\d_][\w'’. -]{{1,30}}?\s+\d{{4,5}})?
    | \b(?:flat|apt\.?|apartment|unit|suite)\s+\d+\w?,\s*\d{{1,5}}\s+(?:{_NAME_WORD}\s+){{1,3}}{_EN_TYPE}\b
    | \b(?:p\.?\s?o\.?\s*box|post\s+office\s+box|postfach|apartado(?:\s+de\s+correos)?|bo[iî]te\s+postale|caixa\s+postal|casella\s+postale|postbus|skrytka\s+pocztowa|posta\s+kutusu)\s*(?:n[.ºo°]*\s*)?\d+
    | [^\W\d_][\w-]*(?:straße|strasse|str\.|allee|gasse|damm|ufer|straat|laan|gracht|kade|singel|gatan|vägen|gränd|stigen)\s+\d{{1,4}}\s?[a-z]?\b
    | \b(?:[A-ZÄÖÜ][\wäöüß-]+(?:weg|platz|ring|hof|plein|markt|torget))\s+\d{{1,4}}\s?[a-z]?\b(?=\s*(?:,|\.|$|\n|\)|\s\d{{4,5}}\b))
    | \b(?:am|an\ der|an\ den|im|in\ der|in\ den|zum|zur|auf\ dem|auf\ der|unter\ den|hinter\ der|hinterm|beim|alte[rs]?|neue[rs]?|lange|große|kleine|obere|untere)\s+[A-ZÄÖÜ][\wäöüß-]+(?:\s+[A-ZÄÖÜ][\wäöüß-]+)?\s+\d{{1,4}}\s?[a-z]?\b(?=,?\s*(?:\d{{5}}\b|[A-ZÄÖÜ+(\d]|$|\n))
    | \b\d{{1,4}}(?:\s?(?:bis|ter|quater))?,?\s+(?:rue|avenue|av\.|boulevard|bd\.?|impasse|place|chemin|allée|allee|quai|cours|route|square|passage|venelle|sentier)\s+(?:d['’]|l['’]|de\s+la\s+|de\s+l['’]|de\s+|du\s+|des\s+|la\s+|le\s+|les\s+)?{_TO}(?:\s+{_TO})?(?:,\s*\d{{5}})?
    | \b(?:calle|c/|avenida|avda\.?|plaza|paseo|camino|carrera|ronda|travesía|glorieta|callejón)\s+(?:de\s+|del\s+|de\s+la\s+|de\s+los\s+|de\s+las\s+)?{_TO}(?:\s+{_TO}){{0,3}}?,?\s+(?:n[ºo°.]+\s*)?\d{{1,4}}\b
    | \b(?:via|viale|piazza|corso|largo|vicolo|strada)\s+(?:di\s+|del\s+|della\s+|dei\s+|delle\s+|degli\s+)?{_TO}(?:\s+{_TO}){{0,2}}?,?\s+(?:n[.°]\s*)?\d{{1,4}}\b
    | \b(?:rua|travessa|praça|alameda|estrada|largo|beco)\s+(?:do\s+|da\s+|dos\s+|das\s+|de\s+)?{_TO}(?:\s+{_TO}){{0,3}}?,?\s+(?:n[.º°]+\s*)?\d{{1,4}}\b
    | \b(?:ul\.|ulica|aleja|al\.|plac|pl\.|os\.)\s+{_TO}(?:\s+{_TO})?\s+\d{{1,4}}
    | \b(?:ул\.|улица|вулиця|вул\.|проспект|просп\.|пр-т|переулок|провулок)\s+{_TO}(?:\s+{_TO})?,?\s+(?:д\.\s*|буд\.\s*)?\d{{1,4}}
    | \b{_TO}\s+(?:sokak|sokağı|sok\.|caddesi|cad\.|bulvarı)\s+(?:no[:.]?\s*)?\d{{1,4}}
    """,
    re.I | re.X,
)

_TITLE = r"(?:Dr|Prof|Mr|Mrs|Ms|Mx|Sir|Dame|Herr|Frau|Monsieur|Madame|Mme|Sr|Sra|Señor|Señora|Dott|Ing|Pan|Pani)"
_CAP = r"(?:[^\W\d_a-zà-öø-ÿ][\w'’]*(?:-[^\W\d_][\w'’]*)*|(?:van|von|de|der|al|el|la|le|di|da|du|bin|ibn)-[\w'’-]+)"
#: Words that introduce a person; they may be in any case, the name may not.
INTRODUCED = re.compile(
    rf"\b(?i:contact:|contact\s+person:?|cc|kudos|kudos\s+to|thanks\s+to|thank\s+you,?|shout-?out\s+to|hat\s+tip\s+to|credit\s+(?:where\s+it\s+is\s+due:|to)|ask|interviewed\s+with|the\s+talk\s+by|my\s+colleague|reviewed\s+it\s+except|learned\s+that\s+from|we\s+lost|i\s+owe|the\s+ticket\s+listed|as|then|danke\s+an|dank\s+aan|merci\s+(?:à|a)|gracias\s+a|obrigad[oa]\s+(?:a|ao|à)|grazie\s+a|tack\s+till|dzięki|teşekkürler|regards,|best,|{_TITLE}\.?)\s+({_CAP}(?:[ ]{_CAP}){{1,2}})"
)
TITLED = re.compile(rf"\b{_TITLE}\.\s+(?:[A-Z]\.\s*)*({_CAP}(?:\s+(?:[A-Z]\.\s+)?{_CAP})?)")
WORD = re.compile(r"[^\W\d_][\w'’]*(?:-[\w'’]+)*")
_ORG = frozenset(
    """inc inc. ltd llc gmbh ag corp co company labs lab systems system software cloud analytics academy cooperative coop guild consulting group team solutions media foundation school university institute
    agency partners weekly daily news newsletter studio studios technologies technology tech ventures capital bank holdings services digital data network networks community collective society association journal magazine press podcast channel bot official hq
    support desk department office committee board project initiative alliance council union club""".split()
)
_NO_NAME = frozenset(
    """the a an and or but of in on at to for with from by this that these those my our your his her their its i we you he she they it who what when where why how as if then than not no yes dr prof mr mrs ms
    phd mba pmp cissp cpa md esq jr sr ii iii speaker hiring author founder ceo cto cfo coach mentor engineer developer manager director consultant recruiter she he they him them deleted removed unknown anonymous admin moderator call whatsapp tel phone email mail mobile""".split()
)


def _digits(text: str) -> list[int]:
    return [int(c) for c in text if c.isdigit()]


def luhn(text: str) -> bool:
    """Whether the digits end in their Luhn check digit."""
    d = _digits(text)
    return len(d) > 1 and sum(x if k % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for k, x in enumerate(reversed(d))) % 10 == 0


def mod97(text: str) -> bool:
    """Whether the last two digits are 97 less the rest modulo 97."""
    d = "".join(map(str, _digits(text)))
    return len(d) > 4 and 97 - int(d[:-2]) % 97 == int(d[-2:])


def weighted(text: str, weights: tuple[int, ...], modulus: int) -> bool:
    """Whether the weighted sum of the digits, check digit included, is a multiple of the modulus."""
    d = _digits(text)
    return len(d) == len(weights) and sum(a * b for a, b in zip(d, weights)) % modulus == 0


def letter23(text: str) -> bool:
    """Whether the letter after eight digits is that of their remainder by 23."""
    m = re.fullmatch(r"([XYZ]?)-?(\d{7,8})-?([A-Z])", text.upper())
    return bool(m) and "TRWAGMYFPDXBNJZSQVHLCKE"[int((str("XYZ".index(m[1])) if m[1] else "") + m[2]) % 23] == m[3]


def iso7064(text: str) -> bool:
    """Whether the last of eleven digits is their ISO 7064 mod 11,10 check digit."""
    d = _digits(text)
    if len(d) != 11:
        return False
    p = 10
    for x in d[:-1]:
        s = (x + p) % 10 or 10
        p = 2 * s % 11
    return (11 - p) % 10 == d[-1]


def _mod11(d: list[int], weights: tuple[int, ...]) -> int:
    """The check digit after the weighted digits: 11 less their sum modulo 11; 10 is no digit."""
    return (11 - sum(a * b for a, b in zip(d, weights)) % 11) % 11


def _date(day: int, month: int) -> bool:
    return 1 <= day <= 31 and 1 <= month <= 12


def cpf(d: list[int]) -> bool:
    """Brazil, 11 digits."""
    check = lambda n: (sum(x * w for x, w in zip(d, range(n + 1, 1, -1))) * 10 % 11) % 10
    return len(d) == 11 and len(set(d)) > 1 and check(9) == d[9] and check(10) == d[10]


def pesel(d: list[int]) -> bool:
    """Poland, 11 digits that begin with a date of birth."""
    return len(d) == 11 and sum(a * b for a, b in zip(d, (1, 3, 7, 9, 1, 3, 7, 9, 1, 3, 1))) % 10 == 0 and _date(d[4] * 10 + d[5], d[2] % 2 * 10 + d[3])


def tax_id_de(d: list[int]) -> bool:
    """Germany, 11 digits: of the first ten just one digit comes two or three times, the last is the ISO 7064 check digit."""
    return len(d) == 11 and d[0] != 0 and sorted(d[:10].count(x) for x in set(d[:10]))[-2:] in ([1, 2], [1, 3]) and iso7064("".join(map(str, d)))


def kimlik(d: list[int]) -> bool:
    """Türkiye, 11 digits."""
    return len(d) == 11 and d[0] != 0 and (7 * sum(d[0:9:2]) - sum(d[1:8:2])) % 10 == d[9] and sum(d[:10]) % 10 == d[10]


def birth_number_no(d: list[int]) -> bool:
    """Norway, 11 digits that begin with a date of birth."""
    return len(d) == 11 and _date((d[0] * 10 + d[1]) % 40, (d[2] * 10 + d[3]) % 40) and _mod11(d, (3, 7, 6, 1, 8, 9, 4, 5, 2)) == d[9] and _mod11(d, (5, 4, 3, 2, 7, 6, 5, 4, 3, 2)) == d[10]


def ssn(d: list[int]) -> bool:
    """United States, 9 digits: no check digit, but areas, groups and serials that are never given. An area from 900 on is a tax number's."""
    return len(d) == 9 and not (d[:3] in ([0, 0, 0], [6, 6, 6]) or d[3:5] == [0, 0] or d[5:] == [0, 0, 0, 0])


def bsn(d: list[int]) -> bool:
    """Netherlands, 9 digits."""
    return len(d) == 9 and any(d) and (sum(x * w for x, w in zip(d, range(9, 1, -1))) - d[8]) % 11 == 0


def hetu(text: str) -> bool:
    """Finland: a date, a sign, three digits and the character of their remainder by 31."""
    m = re.fullmatch(r"(\d{6})[-+A](\d{3})([0-9A-Y])", text.upper())
    return bool(m) and _date(int(m[1][:2]), int(m[1][2:4])) and "0123456789ABCDEFHJKLMNPRSTUVWXY"[int(m[1] + m[2]) % 31] == m[3]


def verhoeff(d: list[int]) -> bool:
    """The check of the dihedral group of order ten, as for twelve digits in India."""
    c = 0
    for i, x in enumerate(reversed(d)):
        for _ in range(i % 8):
            x = (1, 5, 7, 6, 2, 8, 3, 0, 9, 4)[x]
        # c times x in the group: rotations are 0-4, reflections 5-9
        c = (c + x) % 5 if c < 5 and x < 5 else (c + x - 5) % 5 + 5 if c < 5 else (c - 5 - x) % 5 + 5 if x < 5 else (c - x) % 5
    return c == 0


def valid_id(text: str) -> bool:
    """Whether a number passes the checksum of a country that has its shape."""
    d = _digits(text)
    flat = re.sub(r"[ ./-]", "", text)
    if impossible_id(text):
        return False
    if re.fullmatch(r"\d{3}-\d{2}-\d{4}", text):
        return ssn(d)
    if not flat.isdigit():
        return letter23(flat) or hetu(text.strip())
    return (
        len(d) == 9 and (bsn(d) or luhn(flat))
        or len(d) == 10 and bool(re.search(r"[-+]", text)) and luhn(flat)
        or len(d) == 11 and (cpf(d) or pesel(d) or tax_id_de(d) or kimlik(d) or birth_number_no(d))
        or len(d) == 12 and (d[0] > 1 and verhoeff(d) or luhn(flat[2:]))
        or len(d) == 15 and mod97(flat)
    )


def impossible_id(text: str) -> bool:
    """Whether a labelled number stands for none: one digit over and over. Labelled numbers that only fail a checksum may be mistyped and are
    still a person's."""
    return len(set(_digits(text))) < 2


class Lexicon:
    """The Bloom filter of given ("g:") and family ("f:") names, with a cache of the words asked for."""

    def __init__(self, bits: bytes | None) -> None:
        self.bits = bloom.Bloom(bits) if bits else None
        self.cache: dict[str, tuple[bool, bool]] = {}

    def roles(self, word: str) -> tuple[bool, bool]:
        """Whether it's known as a given and as a family name, in any case."""
        if (found := self.cache.get(word)) is None:
            if len(self.cache) > 300_000:
                self.cache.clear()
            w = word.lower().replace("’", "'")
            found = self.cache[word] = (False, False) if self.bits is None or w in _NO_NAME or w in _ORG or len(w) < 3 else ("g:" + w in self.bits, "f:" + w in self.bits)
        return found


_AUTHOR_NOISE = re.compile(r"\([^)]*\)|<[^>]*>|\s[|–—/]\s.*$|\s-\s.*$|,\s*(?:PhD|MBA|PMP|CISSP|CPA|MD|MSc|BSc|Jr|Sr|II|III|Esq)\b.*$|[^\w\s.,'’@&+-]|\+?\d[\d\s()./-]{5,}.*$", re.I)


def author_parts(name: str | None) -> tuple[str, str] | None:
    """(given, family) of an author's display name; one may be empty; None if it is no person's: an organisation, a handle, an address, blank."""
    if not name or not name.strip():
        return None
    if EMAIL.fullmatch(name.strip()):
        return None
    t = EMAIL.sub(" ", name) if _EMAIL_LIKELY.search(name) else name
    t = _AUTHOR_NOISE.sub(" ", PHONE_SPELLED.sub(" ", t))
    t = re.sub(r"\b(?:call|tel|whatsapp|phone|mobile)\b.*$", " ", t, flags=re.I)
    t = " ".join(t.split()).strip(" ,-.")
    if not t or "&" in t or "@" in t or re.search(r"[_\d]", t) or re.match(r"(?i)the\s", t):
        return None
    swap = re.fullmatch(r"([^,]+),\s*([^,]+)", t)
    if swap:
        t = f"{swap[2]} {swap[1]}"
    t = re.sub(rf"^(?:{_TITLE})\.?\s+", "", t, flags=re.I)
    words = [w for w in t.replace(",", " ").split() if not re.fullmatch(r"[^\W\d_]\.?", w)]
    if not words or len(words) > 4 or any(w.lower().strip(".") in _ORG for w in words) or any(w.lower().strip(".") in _NO_NAME for w in words):
        return None
    if len(words) == 1:
        return None
    if not all(re.fullmatch(r"[^\W\d_][\w'’.-]*", w) for w in words):
        return None
    return words[0], words[-1]


def name_lexicon(df: DataFrame, name_col: str, least: int = 1) -> bytes:
    """The Bloom filter of the names in a column of display names; a name counts when at least `least` rows have it in its place.

    The counts are a distributed aggregation, and so is the filter. With 24 bits a name fewer than one unknown word in 10,000 is taken for a name at any
    size of the corpus; names for a filter of more than 128 MB (40 million) are an error.
    """

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[str, int] = {}
        for batch in batches:
            for name, n in batch.iloc[:, 0].value_counts().items():
                if p := author_parts(name):
                    for key in (f"g:{p[0].lower()}", f"f:{p[1].lower()}"):
                        found[key] = found.get(key, 0) + n
            if len(found) > 200_000:
                yield pd.DataFrame(list(found.items()), columns=["k", "n"])
                found.clear()
        if found:
            yield pd.DataFrame(list(found.items()), columns=["k", "n"])

    names = df.select(F.translate(name_col, "’", "'").alias("name")).mapInPandas(parts, "k string, n bigint").groupBy("k").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return bloom.build(written(names.select("k")), strict=True, per_key=24)  # read twice, worked out once


def _name_spans(text: str, lexicon: Lexicon, titled: bool) -> Iterator[tuple[int, int, str, float]]:
    cached, found = lexicon.cache, False
    for w in _TOKEN.findall(text):
        role = cached.get(w) or lexicon.roles(w)
        if role[0] or role[1]:
            found = True
            break
    if found:
        before = None  # (start, end, given, family)
        for m in WORD.finditer(text):
            word = m[0]
            base = word[:-2] if word.endswith(("'s", "’s", "'S", "’S")) and len(word) > 4 else word
            given, family = lexicon.roles(base)
            if not (given or family):
                before = None
                continue
            start, end = m.start(), m.start() + len(base)
            if before and re.fullmatch(r",?\s+(?:[^\W\d_]\.\s*)?", text[before[1] : start]) and (before[2] and family or before[3] and given):
                yield before[0], end, "person_name", 0.9
            elif base[0].isupper() or "-" in base:
                yield start, end, "person_name", 0.6
            before = (start, end, given, family)
        for m in INTRODUCED.finditer(text):
            words = m[1].split()
            if not any(w.lower().strip(".,'") in _ORG or w.lower() in _NO_NAME for w in words) and any(any(lexicon.roles(w.rstrip(",."))) for w in words):
                yield m.start(1), m.end(1), "person_name", 0.7
    if titled:
        for m in TITLED.finditer(text):
            if not any(w.lower().strip(".,") in _ORG or w.lower() in _NO_NAME for w in m[1].split()):
                yield m.start(1), m.end(1), "person_name", 0.7


#: As WORD, but parted at hyphens and apostrophes too, so that one look at each word tells whether names can be in a text.
_TOKEN = re.compile(r"[^\W\d_][\w'’-]*[^\W_]")

_ID_TRIGGERS = """social security|ssn|soc sec|social sec|national insurance|ni number|ni no|nino|passport|pasaporte|passeport|reisepass|passaporte|passaporto|paspoort|pesel|nip|personn|samordnings|fødselsnummer|cpr|hetu|dni|nie|nif|cif
|aadhaar|aadhar|pan card|pan number|steuer|idnr|sozialversicherung|ausweis|codice fiscale|carta d|insee|nir|sécurité sociale|bsn|burgerservice|sofinummer|cpf|rg|curp|rfc|nss|cédula|cedula|rut|tax id|tax number|tax no|taxpayer|tin|itin
|identity card|id card|national id|kimlik|vergi no|sin|medicare|licence|license|инн|снилс|паспорт|身份证|マイナンバー""".replace("\n", "").split("|")
#: Words of addresses that follow their number, and that precede it.
_AFTER_NUMBER = """street|avenue|ave|road|rd|lane|ln|boulevard|blvd|drive|court|ct|square|terrace|close|crescent|parkway|highway|way|walk|mews|hill|row|st|dr|pl|sq|ter|cres|pkwy|hwy|place|rue|av|bd|impasse|chemin|allée|allee|quai|cours|route|passage|venelle|sentier""".split("|")
_BEFORE_NUMBER = """box|postfach|apartado|boîte postale|boite postale|caixa postal|casella postale|postbus|skrytka pocztowa|posta kutusu|am|an der|an den|im|in der|in den|zum|zur|auf dem|auf der|unter den|hinter der|hinterm|beim|alte|alter|altes|neue|neuer|neues|lange|große|kleine|obere|untere|calle|avenida|avda|av|plaza|paseo|camino|carrera|ronda|travesía
|glorieta|callejón|via|viale|piazza|corso|largo|vicolo|strada|rua|travessa|praça|alameda|estrada|beco|ul|ulica|aleja|al|plac|pl|os|ул|улица|вулиця|вул|проспект|просп|переулок|провулок|sokak|sokağı|sok|caddesi|cad|bulvarı""".replace("\n", "").split("|")
_ADDRESS_SUFFIXES = ("straße", "strasse", "str.", "allee", "gasse", "damm", "ufer", "straat", "laan", "gracht", "kade", "singel", "gatan", "vägen", "gränd", "stigen", "weg", "platz", "ring", "hof", "plein", "markt", "torget", "c/")
_DIGIT_WORDS = tuple(_DIGIT_WORD[3:-1].split("|"))
_TITLES = tuple(f"{t.lower()}." for t in _TITLE[3:-1].split("|"))


def _triggers() -> ahocorasick.Automaton:
    """What must be in a lower-cased text for the costlier patterns to be tried: one pass finds all."""
    found: dict[str, set[str]] = {}
    for kind, words in (("id", _ID_TRIGGERS), ("after", _AFTER_NUMBER), ("before", _BEFORE_NUMBER), ("suffix", _ADDRESS_SUFFIXES), ("digit", _DIGIT_WORDS), ("title", _TITLES), ("dot", ("dot",))):
        for w in words:
            found.setdefault(w, set()).add(kind)
    out = ahocorasick.Automaton()
    for w, kinds in found.items():
        out.add_word(w, (len(w), tuple(sorted(kinds))))
    out.make_automaton()
    return out


_SIX_DIGITS = re.compile(r"\d(?:[\s./()+-]{0,4}\d){5}")
_STATE: dict[str, ahocorasick.Automaton] = {}


def _proposed(text: str, lexicon: Lexicon) -> Iterator[tuple[int, int, str, float]]:
    """(start, end, kind, score) of all spans proposed."""
    if "triggers" not in _STATE:
        _STATE["triggers"] = _triggers()
    low = text.lower()
    has_digit = not text.isalpha() and _ANY_DIGIT.search(text) is not None
    ids, dots, titled, digit_words = False, False, False, 0
    places: list[tuple[int, int]] = []
    n_low = len(low)
    for end, (n, kinds) in _STATE["triggers"].iter(low):
        start = end - n + 1
        bounded = (start == 0 or not low[start - 1].isalnum()) and (end + 1 == n_low or not low[end + 1].isalnum())
        for kind in kinds:
            if kind == "suffix":
                if has_digit and _THEN_NUMBER.match(low, end + 1):
                    places.append((start, end + 1))
            elif kind == "id":
                ids = ids or start == 0 or not low[start - 1].isalnum()
            elif not bounded:
                continue
            elif kind == "after":
                if has_digit and _ANY_DIGIT.search(low, max(0, start - 50), start):
                    places.append((start, end + 1))
            elif kind == "before":
                if has_digit and _ANY_DIGIT.search(low, end, end + 60):
                    places.append((start, end + 1))
            elif kind == "digit":
                digit_words += 1
            elif kind == "dot":
                dots = True
            else:
                titled = True
        titled = titled or "title" in kinds and (start == 0 or not low[start - 1].isalnum())
    if dots or "@" in text or "＠" in text or "(at)" in low or "[at]" in low:
        for m in EMAIL.finditer(text):
            yield m.start(), m.end(), "email", 0.95
    if has_digit and ids:
        for m in NATIONAL_ID.finditer(text):
            if sum(c.isdigit() for c in m["id"]) >= 5:
                yield m.start("id"), m.end("id"), "national_id", 0.85 + 0.1 * valid_id(m["id"]) - 0.4 * impossible_id(m["id"].strip())
    if has_digit and _SIX_DIGITS.search(text):
        for m in BARE_ID.finditer(text):
            near = text[max(0, m.start() - 40) : m.start()]
            if not _NOT_PERSONAL.search(near):
                yield m.start(), m.end(), "national_id", 0.2 + (_confirmed(m[0]) if valid_id(m[0]) else 0.0) + 0.2 * bool(_ID_NEAR.search(near)) - 0.3 * bool(_PHONE_WORDS.search(near) or _LOCAL.fullmatch(m[0]))
        for m in PHONE.finditer(text):
            if (found := _phone(text, m)) is not None:
                yield found
    if places and len(low) == len(text):
        upto = -1
        for start, end in sorted(places):
            a, b = max(0, start - 90, upto), min(len(text), end + 90)
            while 0 < a < start and text[a - 1].isalnum():
                a += 1
            while b < len(text) and text[b - 1].isalnum() and text[b].isalnum():
                b += 1
            for m in ADDRESS.finditer(text, a, b):
                yield m.start(), m.end(), "street_address", 0.75
                upto = m.end()
    elif places:
        for m in ADDRESS.finditer(text):
            yield m.start(), m.end(), "street_address", 0.75
    if digit_words >= 7:
        for m in PHONE_SPELLED.finditer(text):
            yield m.start(), m.end(), "phone", 0.7
    yield from _name_spans(text, lexicon, titled)


_ANY_DIGIT = re.compile(r"\d")
#: Words of people and papers, near which a bare number is more likely a person's.
_ID_NEAR = re.compile(r"\b(?:id|ident\w*|passport|citizen\w*|born|birth|social|insur\w*|tax\w*|employee|patient|holder|his|her|my|their|ausweis\w*|steuer\w*|documento|identi\w*)\b", re.I)


def _confirmed(text: str) -> float:
    """What a checksum adds to a bare number: less where a tenth of all numbers pass."""
    d = _digits(text)
    if re.search(r"[A-Za-z./-]", text) or len(d) > 12:
        return 0.35
    return 0.3 if len(d) == 11 and (cpf(d) or kimlik(d) or birth_number_no(d) or pesel(d)) else 0.2


_THEN_NUMBER = re.compile(r"\s+\d")
_LOCAL = re.compile(r"\(?[2-9]\d{2}\)?[-. ]\s?[2-9]\d{2}[-. ]\d{4}|0\d{2,5}\s?[/-]\s?\d{3,}[\d\s-]*|0[1-9]\d{2,3}[ -]?\d{6}|1[2-9]\d{2}[2-9]\d{6}|1?[-. ]?\(?[2-9]\d{2}\)?[-. ]\s?\d{3}[-. ]\d{4}|0\d(?:[ .]\d{2}){4}")
_NOT_PHONE = re.compile(r"\d{4}-\d{2}-\d{2}|\d{1,3}(?:\.\d{1,3}){3}|\d{1,3}(?: \d{3})+|\d{1,2}\.\d{1,2}\.\d{4}|\d{3}-\d{2}-\d{4}")


def _phone(text: str, m: re.Match) -> tuple[int, int, str, float] | None:
    t = m[0].strip()
    if not 7 <= sum(c.isdigit() for c in t) <= 15:
        return None
    start = m.start() + len(m[0]) - len(m[0].lstrip())
    near = text[max(0, start - 40) : start]
    score = 0.2
    if t.startswith("+"):
        score += 0.4
    elif _LOCAL.fullmatch(t):
        score += 0.35
    if _PHONE_WORDS.search(near) or _PHONE_WORDS.search(text[m.end() : m.end() + 12]):
        score += 0.3
    if not near.strip() or near.rstrip()[-1] in ",(:>—–|/-":
        score += 0.15
    if _NOT_PERSONAL.search(near):
        score -= 0.6
    if _NOT_PHONE.fullmatch(t):
        score -= 0.6
    return start, m.end(), "phone", score


_RANK = {"email": 0, "national_id": 1, "phone": 2, "street_address": 3, "person_name": 4}


def spans(text: str | None, lexicon: Lexicon, threshold: float = THRESHOLD) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the personal data in a text, in order, without overlaps; none for null and blank texts."""
    if not text or not text.strip():
        return []
    found = sorted((x for x in _proposed(text, lexicon) if x[3] >= threshold), key=lambda x: (_RANK[x[2]], -x[3], x[0] - x[1]))
    kept: list[tuple[int, int, str]] = []
    for start, end, kind, _ in found:
        if all(end <= a or start >= b for a, b, _ in kept):
            kept.append((start, end, kind))
    return sorted(kept)


def author_spans(name: str | None, lexicon: Lexicon) -> list[tuple[int, int, str]]:
    """As spans(), of a display name: what author_parts() takes for a person is a name."""
    out = [x for x in spans(name, lexicon) if x[2] != "person_name"] if name and name.strip() else []
    parts = author_parts(name)
    if parts is None and name and re.fullmatch(r"\s*[^\W\d_][\w'’-]*\s*", name) and any(lexicon.roles(name.strip())):
        parts = (name.strip(), "")
    if parts:
        for m in re.finditer("|".join(re.escape(p) for p in sorted(filter(None, parts), key=len, reverse=True)), name):
            if all(m.end() <= a or m.start() >= b for a, b, _ in out):
                out.append((m.start(), m.end(), "person_name"))
    return sorted(out)


def redacted(text: str | None, found: list[tuple[int, int, str]]) -> str | None:
    """The text with <KIND> for each span."""
    if text is None or not found:
        return text
    out, upto = [], 0
    for start, end, kind in found:
        out += [text[upto:start], f"<{kind.upper()}>"]
        upto = end
    return "".join(out) + text[upto:]


def find_personal(df: DataFrame, id_col: str, text_col: str, name_col: str, lexicon: bytes | None = None, redact: bool = False) -> DataFrame:
    """id_col, field_name, kind: one row for each kind of personal data in each of the two columns of a row; or, with redact, id_col and both
    columns with placeholders.

    lexicon is name_lexicon() of name_col unless given. Null and blank fields have no personal data and stay as they are. Rows that repeat
    are treated each. Whole texts are read.
    """
    shipped = name_lexicon(df, name_col) if lexicon is None else lexicon
    lean = df.select(F.col(id_col), F.col(text_col), F.col(name_col))
    kind_of_id = dict(lean.dtypes)[id_col]
    bits = df.sparkSession.sparkContext.broadcast(shipped)  # at most 128 MB; see name_lexicon()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = Lexicon(bits.value)
        authors: dict = {}
        for batch in batches:
            rows = []
            for i, text, name in zip(batch.iloc[:, 0], batch.iloc[:, 1], batch.iloc[:, 2]):
                a, b = spans(text, names), authors.get(name)
                if b is None:
                    if len(authors) > 100_000:
                        authors.clear()
                    b = authors[name] = author_spans(name, names)
                if redact:
                    rows.append((i, redacted(text, a), redacted(name, b)))
                else:
                    rows += [(i, text_col, k) for k in sorted({x[2] for x in a})] + [(i, name_col, k) for k in sorted({x[2] for x in b})]
            if rows:
                yield pd.DataFrame(rows, columns=[id_col, text_col, name_col] if redact else [id_col, "field_name", "kind"])

    return lean.mapInPandas(run, f"`{id_col}` {kind_of_id}, `{text_col}` string, `{name_col}` string" if redact else f"`{id_col}` {kind_of_id}, field_name string, kind string")
