"""Character classes and patterns that mean the same in Java and RE2 syntax."""

from __future__ import annotations

#: White space as Python sees it, and word characters.
WS = r"\t-\r\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
W = r"\p{L}\p{N}_"
TOKEN = f"[^{WS}]+"
CAPITAL = "A-ZÖÄÅØÆ"

#: The Unicode blocks in which text counts as readable, by the ranges of the Unicode standard's list of blocks.
READABLE_BLOCKS = """
0000-007F 0080-00FF 0100-017F 0180-024F 02B0-02FF 1E00-1EFF 2000-206F 2070-209F 20A0-20CF 20D0-20FF 2100-214F
2150-218F 2190-21FF 2200-22FF 2300-23FF 2400-243F 2440-245F 2460-24FF 2500-257F 2580-259F 25A0-25FF 2600-26FF
2700-27BF 27C0-27EF 27F0-27FF 2900-297F 2980-29FF 2A00-2AFF 2B00-2BFF 2C60-2C7F 2E00-2E7F A720-A7FF AB30-AB6F
1D100-1D1FF 1D400-1D7FF 1F000-1F02F 1F030-1F09F 1F0A0-1F0FF 1F100-1F1FF 1F300-1F5FF 1F600-1F64F 1F650-1F67F
1F680-1F6FF 1F700-1F77F 1F780-1F7FF 1F800-1F8FF 1F900-1F9FF 1FA00-1FA6F 1FA70-1FAFF
""".split()
UNREADABLE = "[^" + "".join("\\x{%s}-\\x{%s}" % tuple(b.split("-")) for b in READABLE_BLOCKS) + "]"

#: A clock time or a figure like one, as in television tables.
CLOCK = r"\p{Nd}?\p{Nd}[.:]\p{Nd}\p{Nd}"

#: Six digits of a birth date, with the century or without, whose middle ones are a month.
_BORN = "(?:19|20)?[0-9][0-9](?:0[1-9]|1[0-2])[0-9][0-9]"
#: What stands for an identity number, by the sign between date and number, an e-mail address and a nick.
_MASKS = {" - ": "XXXXXX - XXXX", "-": "XXXXXX-XXXX", "": "XXXXXXXXXX"}
MAIL, NICK = "MEJLADRESS", "NICK"


def _numbers(*between: str) -> tuple[tuple[str, str], ...]:
    return tuple((f"{_BORN}{sign}[0-9]{{4}}", _MASKS[sign]) for sign in between)


def _nicks(*after: str) -> tuple[tuple[str, str], ...]:
    return tuple((f"@{gap}[{W}]+", NICK) for gap in after)


#: An address in one piece, whose local part is a run of word characters and dots, and one with all its signs apart.
_MAILS = ((rf"[{W}.]+@[{W}]+(?:\.[{W}]+)+", MAIL), (rf"[{W}]+(?: \. [{W}]+)* @ [{W}]+(?: \. [{W}]+)+", MAIL))
#: What is made anonymous, and what replaces it; the order of the alternatives, and that of the sequential variant, are fixed values.
ANONYMOUS = (*_numbers(" - ", "-", ""), *_nicks(" ", ""), *_MAILS)
ANONYMOUS_SEQUENCE = (*_numbers("", " - ", "-"), *_MAILS, *_nicks("", " "))


def quick(pattern: str) -> str:
    """The same matches without the cost of trying every place in a run of word characters (Java syntax).

    A pattern that begins with such a run matches from its start or, after a
    match that ended within it, from there, if anywhere in it.
    """
    for run, chars in ((f"[{W}.]+", f"{W}."), (f"[{W}]+", W)):
        if pattern.startswith(run):
            return f"(?:(?<![{chars}])|\\G){run}+{pattern[len(run) :]}"
    return pattern


_NBSP = r"\x{A0}"
#: Punctuation brought to plain forms, rule after rule, as the public Moses normalizer does for Swedish.
PUNCTUATION = (
    # space around brackets and before marks
    (r"\r", ""), (r"\(", " ("), (r"\)", ") "), (r" +", " "), (r"\) ([.!:?;,])", ")$1"), (r"\( ", "("), (r" \)", ")"),
    (r"([0-9]) %", "$1%"), (r" :", ":"), (r" ;", ";"),
    # quotes, dashes and dots
    (r"`", "'"), (r"''", ' " '), (r"[„“”]", '"'), (r"–", "-"), (r"—", " - "), (r" +", " "), (r"´", "'"), (r"[‘‚’]", "'"), (r"''", '"'), (r"…", "..."),
    # quotes of French and spaces that don't break
    (f"{_NBSP}?«{_NBSP}?", '"'), (f"{_NBSP}?»{_NBSP}?", '"'), (f"{_NBSP}([%:?!;])", "$1"), (f"nº{_NBSP}", "nº "), (f"{_NBSP}(ºC|cm)", " $1"), (f",{_NBSP}", ", "),
    (r" +", " "),
    # figures
    (f"([0-9]){_NBSP}([0-9])", "$1.$2"),
    # ends
    (f"^[{WS}]+", ""), (f"[{WS}]+$", ""),
)
#: Where the rules on quotes of French and spaces that don't break begin.
PUNCTUATION_TAIL = next(k for k, rule in enumerate(PUNCTUATION) if "«" in rule[0])
#: Abbreviations after whose full stop a Swedish sentence goes on, beside single capitals.
ABBREVIATIONS = "AB G VG dvs etc from iaf jfr kl kr mao mfl mm osv pga tex tom vs".split()
