"""Look-alike characters and code-point decompositions, built from the Unicode database."""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

#: Letters of other scripts that look like a Latin letter, by that letter.
LOOK_ALIKES = """
A АΑᎪ B ВΒᏴ C СϹᏟⅭ D Ꭰ E ЕΕᎬ F Ϝ G Ԍ H НΗᎻ I ІΙӀ J ЈᎫ K КΚᏦ L Ꮮ M МΜᎷ N Ν O ОΟՕ P РΡᏢ Q Ԛ S ЅՏᏚ T ТΤᎢ U Ս V Ѵ W Ԝ X ХΧ Y ҮΥ Z ΖᏃ
a аɑα b Ь c сϲ d ԁ e еҽ g ɡց h һհ i іιı j јϳ k κ l ӏ m м n ո o оοօ p рρ q ԛ s ѕ u υս v νѵ w ԝ x хχ y уγ z ᴢ
"""

#: Decompositions by these rules keep the look of a character.
SAME_LOOK = ("<wide>", "<narrow>", "<font>", "<noBreak>", "<compat>")


@cache
def look_alikes() -> dict[str, str]:
    """Look-alike letter to Latin letter."""
    found, words = {}, LOOK_ALIKES.split()
    for latin, others in zip(words[::2], words[1::2]):
        for c in others:
            found[c] = latin
    for c in "μαργκβ":  # Greek small letters with a look of their own
        found.pop(c, None)
    return found


@cache
def invisible() -> frozenset[str]:
    """Format characters and others that leave no mark on the page."""
    found = {chr(c) for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Cf"}
    found |= {chr(c) for c in (0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0)}
    found |= {chr(c) for c in [*range(0x180B, 0x180E), *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0)]}
    return frozenset(found)


@cache
def one_form(letters: bool = True) -> dict[int, str]:
    """Code point to its canonical or same-looking decomposition with look-alikes replaced (or with ``letters`` false kept); '' where it is invisible.

    Only code points that change; their marks are still apart, to be ordered and recomposed.
    """
    alike, gone, found = look_alikes(), invisible(), {}

    def expand(c: str) -> str:
        rule = unicodedata.decomposition(c)
        if letters and c in alike:
            return alike[c]
        if not rule or 0x3131 <= ord(c) <= 0x318E:  # Korean letters that stand apart
            return c
        head, *rest = rule.split()
        if head.startswith("<") and head not in SAME_LOOK:
            return c
        parts = rest if head.startswith("<") else [head, *rest]
        out = "".join(expand(chr(int(x, 16))) for x in parts)
        if head == "<compat>" and out.startswith(" ") and len(out) > 1:
            return c  # a spacing accent is not a space and an accent
        return out

    for code in range(sys.maxunicode + 1):
        if 0xAC00 <= code <= 0xD7A3 or 0xD800 <= code <= 0xDFFF:
            continue  # Korean syllables are composed by rule
        c = chr(code)
        if c in gone:
            found[code] = ""
        elif unicodedata.category(c) == "Zs" and c != " ":
            found[code] = " "
        elif (out := expand(c)) != c:
            found[code] = out
    return found


@cache
def compositions() -> dict[str, str]:
    """Two code points (a starter and what follows) to the one that they compose to."""
    found = {}
    for code in range(0xC0, 0x1F000):
        rule = unicodedata.decomposition(chr(code))
        if rule and not rule.startswith("<") and len(rule.split()) == 2:
            pair = "".join(chr(int(x, 16)) for x in rule.split())
            if unicodedata.normalize("NFC", pair) == chr(code):
                found[pair] = chr(code)
    return found


#: First of the Korean syllables and of the leading, vowel and trailing letters, and how many there are.
SYLLABLE, LEADING, VOWEL, TRAILING = 0xAC00, 0x1100, 0x1161, 0x11A7
LEADINGS, VOWELS, TRAILINGS = 19, 21, 28


@cache
def joining() -> frozenset[str]:
    """Code points that belong to the character before them: marks, what composes with a starter, and what is invisible."""
    follows = {pair[1] for pair in compositions()} | {chr(c) for c in range(VOWEL, VOWEL + VOWELS)} | {chr(c) for c in range(TRAILING + 1, TRAILING + TRAILINGS)}
    found = {chr(c) for c in range(sys.maxunicode + 1) if unicodedata.combining(chr(c))} | follows
    for code, to in one_form().items():
        if not to or unicodedata.combining(to[0]) or to[0] in follows:
            found.add(chr(code))
    return frozenset(found)


def character_class(chars) -> str:
    """The inside of a character class of a pattern (Java syntax) that holds these."""
    codes, out = sorted(map(ord, chars)), []
    for code in codes:
        if out and out[-1][1] == code - 1:
            out[-1][1] = code
        else:
            out.append([code, code])
    return "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in out)
