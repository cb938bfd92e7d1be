"""Problem 1: find personal information in free text and replace it by typed placeholders.

An Aho-Corasick automaton over cheap anchors (at-signs, schemes, telephone
prefixes, pairs of digits, account cues, street endings, titles, first names,
initials, words that introduce a person) walks each text once; at every anchor a
deterministic parser expands to the boundaries of the item and validates it.
Addresses of pages and numbers of accounts are recognised too, so that nothing
within them is taken for something else; they stay.  Text without anchors is
never looked at again.
"""

from __future__ import annotations

import re
from bisect import bisect_right, insort

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.registry import query
from corpusloom.session import ship, table

KINDS = ("email", "idnum", "phone", "address", "name")
PLACEHOLDER = {k: f"[{k.upper()}]" for k in KINDS}

#: First names in common use in Sweden.
FIRST_NAMES = """
adam agnes albert albin alexander alfred alice alma alva alvar amanda anders andreas anette anita anna anneli annika
anton arne arthur arvid astrid axel barbro bengt berit bertil birger birgit birgitta bo boel britt britta bror börje
camilla carina carl carolina caroline cecilia charlotte christer christina claes dagmar dagny dan daniel david ebba
edit edvard egon einar elin elias elis elisabet elisabeth ella ellen elna elsa elsie elvira emanuel emil emilia emma
enar erik erika erland ernst ester eva evert fabian felix filip folke fredrik frida frits georg gerda gerhard gertrud
gillis gottfrid greta gudrun gun gunborg gunhild gunilla gunnar gunvor gustaf gustav göran göte gösta hans harald harry
hedda hedvig helena helga helge helmer henning henrik henry herbert hilda hilma hjalmar hjördis holger hugo håkan
ida inga ingeborg ingegerd inger ingrid ingvar irene irma isak isabella ivar jakob jan jenny jesper joakim johan johanna
john jonas josef julia kaj karin karl karolina katarina kerstin kjell klara klas knut konrad kristin kristina kurt
lars lasse leif lena lennart linda linnea lisa lisbeth lotta louise lovisa ludvig magnus maja malin margareta maria
marianne marie martin mats matilda mattias mikael moa mona märta nanna nils nina ola olga olle olof olov orvar oskar otto
patrik paul per pernilla peter petra pia ragnar ragnhild rakel rolf roland rune rut ruth sara selma signe sigrid
sigurd simon siv sixten sofia solveig staffan stefan stellan stig stina sture sune susanne svea sven svante sylvia
tage tekla teodor thomas tilda tomas tor torbjörn tore torsten tove tyra ture ulf ulla ulrik ulrika urban vendela vera
verner viggo viktor viktoria vilgot vilhelm viola viveka vivianne waldemar walter wilhelm yngve yvonne åke åsa östen
""".split()
#: Titles before a surname.
TITLES = """
herr fru fröken dr doktor professor docent rektor häradsdomare domare rådman sjukskötare sjuksköterska syster
kyrkoherde komminister prost pastor kantor ingenjör direktör disponent grosshandlare handlare handlanden fabrikör
byggmästare mäster lektor adjunkt magister fil.mag. fil.dr fil.lic. fil.kand. jur.kand. landshövding borgmästare
riksdagsman nämndeman kamrer kassör notarie advokat assessor konsul general överste major kapten löjtnant fänrik
sergeant kommissarie konstapel länsman fjärdingsman postmästare stins redaktör lantbrukare hemmansägare godsägare
friherre friherrinnan greve grevinnan änkefru
""".split()
#: How the names of streets end.
STREET_ENDINGS = """
gatan vägen gränd gränden stigen backen allén alléen torget esplanaden promenaden stråket leden strand stranden
kajen brinken slingan svängen rundeln platsen
""".split()
#: How streets of other countries end, and the words for one beside a number.
FOREIGN_ENDINGS = "gade vej stræde straße strasse katu kuja".split()
STREET_WORDS = "street road avenue lane drive square terrace".split()
#: What announces the number of an account.
ACCOUNT_CUES = "iban bankgiro plusgiro postgiro kontonummer kontonr clearing".split()
#: Words after which two capitalised words are a person.
PERSON_CUES = """
heter hette namn undertecknad kontaktperson kontakta ringer säger sade berättar skriver svarar intervjuar hälsar
""".split()
#: Words that follow no first name as a surname, and abbreviations that aren't initials.
NOT_SURNAMES = frozenset(
    """
    alla att av bland bor den denna det detta de dem du efter eller en enligt ett fick frågan från före får för genom
    gick han har hon hos hur i idag igår in ingen innan inte ja jag kan kl kom kommer lockade man med medan men mot
    mycket ned nej nr ner nu när någon något nästa nästan och om på redan sade samt sedan ser sig sin sina sitt ska
    skall skulle som strax så till tack talade trots två under upp ur ut utan vad var varför vem vi vid vill väntat
    vet är åt även över son ab hb kb co tel telefon fax pnr född död avled avlidit väckte gav tog stod följde stödde
    """.split()
)
ABBREVIATIONS = ("d.v.s.", "bl.a.", "t.ex.", "m.m.", "o.s.v.", "m.fl.", "f.d.", "s.k.", "p.g.a.", "f.ö.", "e.d.", "i.e.")

#: First names that are also words: only in the case of a name.
WORD_NAMES = frozenset("per stig kaj dan linda tor siv boel viola".split())

_L = "[^\\W\\d_]"
_AT = r"@|\(\s*at\s*\)|\[\s*at\s*\]|[\[(]\s*snabel-?a\s*[\])]"
_LABEL = rf"(?:{_L}|\d)(?:{_L}|[\d-])*"
_DOMAIN = re.compile(rf"{_LABEL}(?:\.{_LABEL})+")
_DOT = r"(?:\s*[\[(]\s*(?:punkt|dot)\s*[\])]\s*|\s+\.\s+|\.)"
_DOMAIN_SPACED = re.compile(rf"\s*{_LABEL}(?:{_DOT}{_LABEL})+")
_AT_FORM = re.compile(_AT)

_SEP = r"\s*[-–/.]?\s*"
_PHONE = re.compile(
    rf"(?:(?:\+|00)46{_SEP}(?:\(0\){_SEP})?(?P<a>[1-9]\d{{0,2}})|\((?P<b>[0oO][1-9]\d{{0,2}})\)|(?P<c>[0oO][1-9]\d{{0,2}}))"
    rf"(?P<rest>(?:{_SEP}\d{{2,9}})+)(?![\d\w])"
)
# a day of 61 to 91 is that of a coordination number
_IDNUM = re.compile(
    r"(?P<y>(?:18|19|20)?\d\d)(?P<m>0[1-9]|1[0-2])(?P<d>[06][1-9]|[1278]\d|[39][01])(?:\s?[-–—+]\s?|\s)?\d{4}(?![\d\w])(?!-\d)"
)
_ABROAD = re.compile(rf"(?:\+|00)(?!46)[1-9]\d{{0,2}}(?:{_SEP}\(0\))?(?P<rest>(?:{_SEP}\d{{1,9}})+)(?![\d\w])")
_PAGE_ADDRESS = re.compile(r"[^\s<>\"”’)\]]*")
_ACCOUNT = re.compile(r"(?:\s*(?:nr|nummer|no)?\.?\s*:?\s*)(?P<n>[A-Za-z]{2}\d{2}(?:\s?[A-Za-z0-9]{4}){2,7}(?:\s?[A-Za-z0-9]{1,3})?|\d[\d\s-]{4,24}\d)(?!\w)")
_NUMBERED = re.compile(rf"(?<![\w])\d{{1,4}}[A-Za-z]?\s+(?:{_L}[^\W\d_'’.-]*\s+){{1,3}}\Z")
_PERSON = re.compile(rf"(?:\s*:)?\s+(?P<f>{_L}{{2,}}(?:-{_L}+)?)\s+(?P<n>{_L}{{2,}}(?:-{_L}+)?)(?!\w)")
_HOUSE = re.compile(r"\s+\d{1,3}(?:\s?[A-Ha-h])?(?!\w)(?![.:,]\d)")
_WORD = rf"{_L}(?:{_L}|['’-](?={_L}))*"
_SURNAME = re.compile(rf"\s+(?P<n>{_WORD})")
_BEFORE_COMMA = re.compile(rf"(?P<n>{_WORD}),\s+\Z")
_FURTHER = re.compile(rf"[\s -](?P<n>{_L}\.|{_L}+)(?!\w)")
_TITLED = re.compile(rf"\.?\s+(?:{_L}\.\s?)*(?P<n>{_WORD})")
_NEIGHBOURS = re.compile(rf"(?<!\w)(?=({_L}{{2,}})\s+({_L}{{2,}})(?!\w))")
_INITIALS = re.compile(rf"(?:{_L}\.\s?){{1,4}}(?<=\s)(?P<n>{_WORD})")
_VOWEL = re.compile("[aeiouyåäöéæø]")


def _lower(text: str) -> str:
    """Lower case of the same length."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


#: Of what kind an item is that a parser of another name finds.
PARSED = {"abroad": "phone", "foreign": "address", "street": "address"}


def _local(low: str, first: int, stop: int) -> int | None:
    """Where a local part of letters, digits and ``.+_-`` begins that ends at ``stop``; null if there is none."""
    start = stop
    while start > first and (low[start - 1].isalpha() or low[start - 1].isdecimal() or low[start - 1] in ".+_-"):
        start -= 1
    while start < stop and not (low[start].isalpha() or low[start].isdecimal()):
        start += 1
    return start if start < stop else None


def _before_spaces(low: str, first: int, stop: int) -> int:
    """Where the white space begins that ends at ``stop``."""
    while stop > first and low[stop - 1].isspace():
        stop -= 1
    return stop


class Finder:
    """The automaton and its parsers."""

    def __init__(self):
        import ahocorasick

        self.names = frozenset(FIRST_NAMES)
        self.streets = tuple(STREET_ENDINGS)
        anchors: dict[str, set[str]] = {}

        def add(kind, words):
            for w in words:
                anchors.setdefault(w, set()).add(kind)

        add("email", ["@", "(at)", "( at )", "[at]", "[ at ]", "snabel-a", "snabela"])
        add("phone", ["+46", "0046", *(f"{z}{d}" for z in "0o" for d in range(1, 10))])
        add("abroad", [f"{z}{d}" for z in ("+", "00") for d in range(1, 10)])
        add("page", ["://"])
        add("account", ACCOUNT_CUES)
        add("idnum", [f"{a}{b}" for a in range(10) for b in range(10)])
        add("address", STREET_ENDINGS)
        add("foreign", FOREIGN_ENDINGS)
        add("street", STREET_WORDS)
        add("person", PERSON_CUES)
        add("title", TITLES)
        add("title", [t.replace(".", ". ").strip() for t in TITLES if "." in t])
        add("first", FIRST_NAMES)
        add("initial", [f"{chr(c)}." for c in [*range(97, 123), 229, 228, 246]])
        self.auto = ahocorasick.Automaton()
        for w, kinds in anchors.items():
            self.auto.add_word(w, (len(w), frozenset(kinds)))
        self.auto.make_automaton()

    def spans(self, text: str) -> list[tuple[int, int, str]]:
        """``(start, end, kind)`` of the items of a text, in order and disjoint."""
        low = _lower(text)
        caseless = low == text
        found: dict[str, list[tuple[int, int]]] = {k: [] for k in (*KINDS, "page", "account")}
        past = dict.fromkeys(found, 0)
        names: list[tuple[int, int, str]] = []
        for last, (size, kinds) in self.auto.iter(low):
            at, end = last + 1 - size, last + 1
            for kind in kinds:
                if kind in ("title", "first", "initial", "person"):
                    names.append((at, end, kind))
                    continue
                of = PARSED.get(kind, kind)
                if at < past[of]:
                    continue
                if kind == "email":
                    span = self._email(low, at, past[kind])
                else:
                    span = getattr(self, f"_{kind}")(text, low, at, end)
                if span:
                    found[of].append(span)
                    past[of] = span[1]
        taken: list[tuple[int, int, str]] = []

        def free(a: int, b: int) -> bool:
            """Whether no item taken so far, which are disjoint and in order, overlaps."""
            k = bisect_right(taken, (a, len(text) + 1, ""))
            return (not k or taken[k - 1][1] <= a) and (k == len(taken) or taken[k][0] >= b)

        for kind in ("page", "account", *KINDS[:-1]):
            for a, b in found[kind]:
                if free(a, b):
                    insort(taken, (a, b, kind))
        seen = 0
        locals_ = frozenset(frozenset(re.split(r"[._+-]", low[a:b].partition("@")[0])) for a, b in found["email"])
        for at, end, kind in names:
            if at < seen or not free(at, at + 1):
                continue
            if kind == "first":
                span = self._first(text, at, end, caseless, seen)
            elif kind == "person":
                span = self._person(text, at, end, caseless)
            else:
                span = getattr(self, f"_{kind}")(text, low, at, end, caseless)
            if span and free(*span):
                insort(taken, (*span, "name"))
                seen = span[1]
        for a, b in self._of_addresses(text, low, locals_) if locals_ else ():
            if free(a, b):
                insort(taken, (a, b, "name"))
        return [t for t in taken if t[2] in PLACEHOLDER]

    @staticmethod
    def _email(low: str, at: int, past: int):
        """An address around an at-sign, its local part after the address or at-sign before."""
        if low[at] not in "@([":
            at = max(low.rfind("[", max(past, at - 4), at), low.rfind("(", max(past, at - 4), at))
            if at < 0:
                return None
        sign = _AT_FORM.match(low, at)
        if not sign:
            return None
        end = sign.end()
        first = max(past, low.rfind("@", past, at) + 1)
        spaced = low[at - 1 : at].isspace() or sign.group() != "@"
        local = _local(low, first, _before_spaces(low, first, at) if spaced else at)
        if not spaced:
            domain = _DOMAIN.match(low, end)
        else:
            # "gerda . sjöberg @ ..." spaces its dots too; else the local part is one word
            while local is not None:
                dot = _before_spaces(low, first, local) - 1
                k = _before_spaces(low, first, dot)
                if not first <= dot < local - 1 or low[dot] != "." or k == dot or (further := _local(low, first, k)) is None:
                    break
                local = further
            domain = _DOMAIN_SPACED.match(low, end)
        if local is None or not domain:
            return None
        labels = re.split(_DOT, domain.group().strip())
        if not re.fullmatch(rf"{_L}{{2,}}", labels[-1]):
            return None
        return local, domain.end()

    @staticmethod
    def _page(text: str, low: str, at: int, end: int):
        start = at
        while start and (low[start - 1].isalnum() or low[start - 1] in "+.-"):
            start -= 1
        return (start, _PAGE_ADDRESS.match(text, end).end()) if start < at else None

    @staticmethod
    def _account(text: str, low: str, at: int, end: int):
        if at and low[at - 1].isalnum():
            return None
        m = _ACCOUNT.match(text, end)
        if not m:
            return None
        number = re.sub(r"[\s-]", "", m["n"]).upper()
        if number[:2].isalpha():
            turned = "".join(str(int(c, 36)) for c in number[4:] + number[:4])
            return m.span("n") if int(turned) % 97 == 1 else None
        return m.span("n")

    @staticmethod
    def _abroad(text: str, low: str, at: int, end: int):
        if at and (text[at - 1].isalnum() or text[at - 1] in "-–+/.,:=_@"):
            return None
        m = _ABROAD.match(text, at)
        if not m or (low[at] == "0" and not re.search(r"[\s/.–-]", m.group())):
            return None
        digits = sum(c.isdigit() for c in m.group()) - 2 * (low[at] == "0")
        return m.span() if 8 <= digits <= 15 else None

    def _foreign(self, text: str, low: str, at: int, end: int):
        span = self._address(text, low, at, end)
        return span if span and text[span[0]].isupper() else None

    @staticmethod
    def _street(text: str, low: str, at: int, end: int):
        if not text[at].isupper() or not text[at - 1 : at].isspace() or text[end : end + 1].isalnum():
            return None
        start = at
        for _ in range(4):  # a number, up to three words, and the word for a street
            start = _before_spaces(low, 0, start)
            while start and not low[start - 1].isspace():
                start -= 1
        m = _NUMBERED.search(text, start, at)
        return (m.start(), end) if m and all(w[0].isupper() for w in m.group().split()[1:]) else None

    def _person(self, text: str, at: int, end: int, caseless: bool):
        if caseless or (at and text[at - 1].isalnum()) or text[end : end + 1].isalnum():
            return None
        m = _PERSON.match(text, end)
        if not m or not m["f"].istitle() or not m["n"].istitle() or not self._surname(m, False) or m["f"].lower() in NOT_SURNAMES:
            return None
        return m.start("f"), m.end()

    @staticmethod
    def _of_addresses(text: str, low: str, locals_: frozenset):
        """Two neighbouring words that are parts of the local part of one of the text's addresses."""
        for m in _NEIGHBOURS.finditer(text):
            pair = {m[1].lower(), m[2].lower()}
            if len(pair) == 2 and m[1][0].isupper() and m[2][0].isupper() and any(pair <= parts for parts in locals_):
                yield m.start(1), m.end(2)

    @staticmethod
    def _phone(text: str, low: str, at: int, end: int):
        if low[at] == "4":
            return None
        if at and low[at - 1] == "(":
            at -= 1
        if at and (text[at - 1].isalnum() or text[at - 1] in "-–+/.,:=_@"):
            if not (text[at - 1] in ".,:" and not text[at - 2 : at - 1].isdigit()):
                return None
        m = _PHONE.match(text, at)
        if not m:
            return None
        area, digits = m["a"] or m["b"] or m["c"], re.sub(r"\D", "", m["rest"])
        national = len(area.lstrip("0oO")) + len(digits)
        return m.span() if 7 <= national <= 9 and len(digits) >= 5 else None

    @staticmethod
    def _idnum(text: str, low: str, at: int, end: int):
        if at and (text[at - 1].isalnum() or text[at - 1] in "-–+/.,:=_@" and text[at - 2 : at - 1].isdigit()):
            return None
        if at and text[at - 1] in "+/_=":
            return None
        m = _IDNUM.match(text, at)
        return m and m.span()

    def _address(self, text: str, low: str, at: int, end: int):
        house = _HOUSE.match(text, end)
        if not house:
            return None
        start = at
        while start and (text[start - 1].isalpha() or text[start - 1] in "-’'" and start > 1 and text[start - 2].isalpha()):
            start -= 1
        if at - start < 2 or text[start - 1 : start].isdigit():
            return None
        return start, house.end()

    @staticmethod
    def _surname(m, caseless: bool) -> bool:
        n = m["n"]
        low = n.lower()
        if len(n) < (2 if n.istitle() else 3) or low in NOT_SURNAMES or low.endswith("ade") or not _VOWEL.search(low):
            return False
        return caseless or n[0].isupper()

    @staticmethod
    def _starts(text: str, at: int, caseless: bool) -> bool:
        """Whether a word begins here, in a place and case in which a name can."""
        if at and (text[at - 1].isalnum() or text[at - 1] in "@._+-" and not (text[at - 1] in "-." and not text[at - 2 : at - 1].isalnum())):
            return False
        return caseless or text[at].isupper()

    def _first(self, text: str, at: int, end: int, caseless: bool, seen: int):
        if not self._starts(text, at, caseless) or text[end : end + 1].isalpha():
            return None
        if text[at:end].lower() in WORD_NAMES and not text[at:end].istitle():
            return None
        start = at
        before = _BEFORE_COMMA.search(text, max(seen, start - 60), start)
        if before and self._surname(before, caseless) and before["n"].lower() not in self.names:
            if text[end : end + 1] not in ("@", "+", "_", "-", ".") or text[end : end + 2] in (".", ". ", ".\n"):
                return before.start(), end
        while more := _FURTHER.match(text, end):
            if more["n"].lower() not in self.names and not (more["n"].endswith(".") and more["n"][0].isupper()):
                break
            end = more.end()
        m = _SURNAME.match(text, end)
        if m and self._surname(m, caseless) and text[m.end() : m.end() + 1] != "@":
            return start, m.end()
        return None

    def _title(self, text: str, low: str, at: int, end: int, caseless: bool):
        if at and (text[at - 1].isalnum() or text[at - 1] in "@._+-"):
            return None
        if text[end : end + 1].isalnum():
            return None
        m = _TITLED.match(text, end)
        if not m or not self._surname(m, caseless):
            return None
        stop = m.end()
        if m["n"].lower() in self.names:
            further = _SURNAME.match(text, stop)
            if further and self._surname(further, caseless):
                stop = further.end()
        return m.start("n"), stop

    def _initial(self, text: str, low: str, at: int, end: int, caseless: bool):
        if caseless or not text[at].isupper():
            return None
        if at and text[at - 1] not in " \n\t\r (\"'”“,;:/–<":
            return None
        if re.search(r"\d\s\Z|§\s?\Z", text[max(0, at - 2) : at]) or low.startswith(ABBREVIATIONS, at):
            return None
        m = _INITIALS.match(text, at)
        if not m or not self._surname(m, False):
            return None
        return m.start(), m.end()


def _finder() -> Finder:
    kept = globals().get("_kept")
    if kept is None:
        kept = globals()["_kept"] = Finder()
    return kept


def _scan(df: DataFrame, key: str, content: str, redact: bool) -> DataFrame:
    ship(df.sparkSession)
    key_type = df.schema[key].dataType.simpleString()

    def run(batches):
        finder = _finder()
        for batch in batches:
            kinds, texts = [], []
            for text in batch.column(1).to_pylist():
                spans = finder.spans(text) if text else []
                kinds.append(sorted({k for _, _, k in spans}))
                if redact:
                    parts, at = [], 0
                    for a, b, k in spans:
                        parts += (text[at:a], PLACEHOLDER[k])
                        at = b
                    texts.append("".join(parts) + text[at:] if spans else text)
            columns = [batch.column(0), pa.array(kinds, pa.list_(pa.string()))]
            names = [key, "kinds"]
            if redact:
                columns.append(pa.array(texts, pa.string()))
                names.append(content)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"`{key}` {key_type}, kinds array<string>" + f", `{content}` string" * redact
    return df.select(F.col(key), F.col(content)).mapInArrow(run, schema)


def redact(df: DataFrame, key: str = "box_id", content: str = "content") -> DataFrame:
    """The texts with placeholders: ``(key, kinds, content)``, one row per input row.

    Each e-mail address, telephone number, identity number, street address with
    house number and personal name becomes ``[EMAIL]``, ``[PHONE]``,
    ``[IDNUM]``, ``[ADDRESS]`` or ``[NAME]``; everything else stays as it is.
    ``kinds`` lists what was found.  Null stays null and empty stays empty, with
    no kinds; repeated rows are all treated.  No shuffle.
    """
    return _scan(df, key, content, True)


def kinds_found(df: DataFrame, key: str = "box_id", content: str = "content") -> DataFrame:
    """``(key, kind)`` for each text and kind of personal information in it."""
    return _scan(df, key, content, False).select(key, F.explode("kinds").alias("kind")).distinct()


@query("p1_found")
def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kinds_found(table(spark, sf_dir, "boxes"))


@query("p1_redacted")
def p1_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redact(table(spark, sf_dir, "boxes"))
