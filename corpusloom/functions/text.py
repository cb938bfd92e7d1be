"""String functions: ``Column -> Column``, native wherever Spark can express them."""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, StringType

from corpusloom.functions.patterns import ABBREVIATIONS, ANONYMOUS, ANONYMOUS_SEQUENCE, CAPITAL, PUNCTUATION, PUNCTUATION_TAIL, TOKEN, WS, W, quick


def token_count(text: Column) -> Column:
    """Number of white-space separated tokens; null for null."""
    return F.regexp_count(text, F.lit(TOKEN))


def one_line(text: Column) -> Column:
    """Line feeds as spaces."""
    return F.translate(text, "\n", " ")


def replace_matches(text: Column, pattern: str, replace) -> Column:
    """Replace every leftmost match of a pattern without groups by ``replace(match)``, in one pass."""
    between = F.split(text, pattern, -1)
    matches = F.transform(F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1)), replace)
    parts = F.zip_with(between, F.concat(matches, F.array(F.lit(""))), lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    return F.when(text.isNotNull(), F.array_join(parts, ""))


def anonymize(text: Column) -> Column:
    """Identity numbers, e-mail addresses and nicks made anonymous in a single pass, alternatives in order."""

    def replaced(match: Column) -> Column:
        out = F.lit("")
        for pattern, by in reversed(ANONYMOUS):
            out = F.when(match.rlike(f"^(?:{pattern})$"), by).otherwise(out)
        return out

    # every pattern needs an at-sign or six digits, so most texts are spared the costly one
    found = replace_matches(text, "|".join(quick(p) for p, _ in ANONYMOUS), replaced)
    return F.when(text.rlike("@|[0-9]{6}"), found).otherwise(text)


def anonymize_sequential(text: Column) -> Column:
    """The same patterns one after the other, each on the result of the one before."""
    for pattern, by in ANONYMOUS_SEQUENCE:
        text = F.regexp_replace(text, quick(pattern), by)
    return text


def strip_incomplete(text: Column) -> Column:
    """From the first capitalised word to the last sentence end before white space.

    Without such a word from the beginning; without such an end all but the last
    character.
    """
    head = F.length(F.regexp_extract(text, f"(?s)^(.*?)[{CAPITAL}][{W}]+", 1))
    upto = F.length(F.regexp_extract(text, f"(?s)^(.*[.!?\"'])[{WS}]", 1))
    end = F.when(upto > 0, upto).otherwise(F.length(text) - 1)
    return F.substring(text, head + 1, F.greatest(end - head, F.lit(0)))


def replace_words(text: Column, words: Mapping[str, str], ignore_case: bool = False) -> Column:
    """Replace whole words of a bounded dictionary, longest first; with ``ignore_case`` in any case.

    A match consumes the characters around it, so of two words that share one
    separator only the first is replaced.  Of keys that differ in case only the
    last counts where case doesn't.
    """
    if not words:
        return text
    if ignore_case:
        words = {k.lower(): v for k, v in words.items()}
    table = F.create_map(*(F.lit(x) for pair in sorted(words.items()) for x in pair))
    meant = lambda w: table[F.lower(w) if ignore_case else w]

    def replaced(match: Column) -> Column:
        n, rest = F.length(match), F.substring(match, F.lit(2), F.length(match))
        # with a character before and after the word, only before, only after, or neither
        both, before, after = F.substring(match, F.lit(2), n - 2), rest, F.substring(match, F.lit(1), n - 1)
        first, last = F.substring(match, 1, 1), F.substring(match, -1, 1)
        return F.coalesce(
            F.concat(first, meant(both), last), F.concat(first, meant(before)), F.concat(meant(after), last), meant(match)
        )

    case = "(?iu)" if ignore_case else ""
    return replace_matches(text, f"{case}(?:^|[^{W}])(?:{_alternatives(list(words))})(?:[^{W}]|$)", replaced)


def _alternatives(keys: list[str], depth: int = 0) -> str:
    """A pattern of the keys, longest first, branching by their first two letters so that few are tried at a place."""
    escape = lambda s: "".join("\\" + c if not (c.isalnum() or c == "_") else c for c in s)
    if depth == 2 or len(keys) < 4:
        return "|".join(escape(k[depth:]) for k in sorted(keys, key=lambda k: (-len(k), k)))
    branches: dict[str, list[str]] = {}
    for k in keys:
        branches.setdefault(k[depth : depth + 1], []).append(k)
    ends = branches.pop("", None)  # a key that ends here comes after the longer ones
    parts = [f"{escape(c)}(?:{_alternatives(ks, depth + 1)})" for c, ks in sorted(branches.items())]
    return "|".join([*parts, ""] if ends else parts)


def plain_punctuation(text: Column) -> Column:
    """Quotes, dashes and spaces in plain forms: what the rules of ``PUNCTUATION`` give one after the other, in few passes.

    Single characters that no earlier rule looks at are translated together,
    rules on the same spaces are one pattern, and rules on spaces that don't
    break are spared a text without any.
    """
    text = F.translate(text, "–„“”\r", '-"""')
    text = F.regexp_replace(F.replace(F.replace(text, F.lit("("), F.lit(" (")), F.lit(")"), F.lit(") ")), " {2,}", " ")
    text = F.regexp_replace(text, r" (?:(?=[:;)])|(?<=\( )|(?<=\) )(?=[.!?,])|(?<=[0-9] )(?=%))", "")
    text = F.replace(F.translate(text, "`", "'"), F.lit("''"), F.lit(' " '))
    text = F.regexp_replace(F.replace(text, F.lit("—"), F.lit(" - ")), " {2,}", " ")
    text = F.replace(F.replace(F.translate(text, "´‘‚’", "''''"), F.lit("''"), F.lit('"')), F.lit("…"), F.lit("..."))

    def unbroken(t: Column) -> Column:
        for pattern, by in PUNCTUATION[PUNCTUATION_TAIL:]:
            t = F.regexp_replace(t, pattern, by)
        return t

    ends = f"^[{WS}]+|[{WS}]+$"
    plain = lambda t: F.regexp_replace(F.translate(t, "«»", '""'), ends, "")
    return F.transform(F.array(text), lambda t: F.when(t.contains(" "), unbroken(t)).otherwise(plain(t)))[0]


def collapse_spaces(text: Column) -> Column:
    """Runs of spaces as one."""
    return F.regexp_replace(text, " {2,}", " ")


def _in_arrow(function):
    """Column functions of a ``str -> str`` function, over texts and over arrays of texts, in Arrow batches; nulls stay null."""

    def each(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else t if t.isascii() else function(t) for t in texts.to_pylist()], pa.string())

    @arrow_udf(StringType())
    def over_texts(texts: pa.Array) -> pa.Array:
        return each(texts)

    @arrow_udf(ArrayType(StringType()))
    def over_arrays(arrays: pa.Array) -> pa.Array:
        sizes = pc.fill_null(pc.list_value_length(arrays), 0).to_numpy()
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        return pa.ListArray.from_arrays(offsets, each(arrays.flatten()), mask=arrays.is_null())

    return over_texts, over_arrays


#: Unicode normal form KC; ASCII passes through.
nfkc, nfkc_array = _in_arrow(lambda text: unicodedata.normalize("NFKC", text))


#: What NFKD leaves beyond ASCII.
_ASCII = str.maketrans(
    {
        **dict.fromkeys("‐‑‒–—―−⁃﹘﹣－", "-"), **dict.fromkeys("‘’‚‛′´ʹʻʼʽˈ‹›", "'"), **dict.fromkeys("“”„‟″«»〝〞", '"'),
        **dict.fromkeys("•·‣∙●▪■◦", "*"), "…": "...", "。": ".", "、": ",", "⁄": "/", "∕": "/", "×": "x", "÷": "/", "¦": "|", "¡": "!", "¿": "?", "§": "SS", "¶": "P",
        "†": "+", "‡": "++", "‰": "0/00", "°": "deg", "©": "(c)", "®": "(r)", "€": "EUR", "£": "GBP", "¥": "JPY", "¢": "c", "¤": "$", "₤": "GBP",
        "←": "<-", "→": "->", "≤": "<=", "≥": ">=", "≠": "!=", "≈": "~", "±": "+-", "¬": "-",
        "ß": "ss", "ẞ": "SS", "ð": "d", "Ð": "D", "đ": "d", "Đ": "D", "þ": "th", "Þ": "Th", "ł": "l", "Ł": "L", "œ": "oe", "Œ": "OE", "ı": "i",
        "ħ": "h", "Ħ": "H", "ŧ": "t", "Ŧ": "T", "ŋ": "ng", "Ŋ": "NG", "ĸ": "k", "ƒ": "f", "ə": "e",
    }
)


_SPARED = frozenset("åäöÅÄÖæøÆØ")


def _fold(text: str) -> str:
    out = []
    for c in unicodedata.normalize("NFC", text):
        if c in _SPARED or c.isascii():
            out.append(c)
        else:
            parts = unicodedata.normalize("NFKD", c.translate(_ASCII)).translate(_ASCII)
            out += (x for x in parts if not unicodedata.combining(x) and (x.isascii() or x.isalnum()))
    return "".join(out)


#: Latin letters without marks and punctuation in ASCII, but the letters of Nordic languages as they are.
#: Letters of other scripts only lose their marks; characters without width go.
ascii_fold, ascii_fold_array = _in_arrow(_fold)


#: What the public tokenizers' clean-up for translation removes, and what it takes for a space.
_NMT_GONE = r"[\x{1}-\x{8}\x{B}\x{E}-\x{1F}\x{7F}\x{8F}\x{9F}]"
_NMT_SPACE = r"[\t\n\f\r\x{1680}\x{200B}-\x{200F}\x{2028}\x{2029}\x{2581}\x{FEFF}\x{FFFD}]"


def clean_up(text: Column) -> Column:
    """Control characters gone, other white space and invisible characters as spaces."""
    return F.regexp_replace(F.regexp_replace(text, _NMT_GONE, ""), _NMT_SPACE, " ")


def tokenizer_text(text: Column) -> Column:
    """What a tokenizer is given: cleaned up, in normal form KC, runs of spaces as one."""
    return collapse_spaces(nfkc(clean_up(text)))


_OPEN, _CLOSE = r"['\"(\[¿¡\p{Pi}]", r"['\")\]\p{Pf}]"
_SOUND = rf"(?={_OPEN}*\p{{Lu}})"
#: Ends of sentences but for a lone full stop, with the white space after them, before what can begin a sentence.
_ENDS = (rf"([?!]|\.\.) +{_SOUND}", rf"([?!.] *{_CLOSE}+) +(?={_OPEN}* *\p{{Lu}})", rf"([?!.]) +(?={_OPEN}+ *\p{{Lu}})")
_HELD = "|".join([r"\p{Lu}", *ABBREVIATIONS])
#: A word that ends in a full stop, but for an abbreviation or an acronym, before what can begin a sentence.
_STOP = (
    rf"(?<![^ \n])(?![^ \n]*?(?<![{W}.-])(?:{_HELD})\.+ )(?![^ \n]*\.[\p{{Lu}}-]+\.+ )([^ \n]*\.) +(?={_OPEN}* *[\p{{Lu}}0-9])"
)


def sentences(text: Column) -> Column:
    """Sentences of Swedish text, without white space at their ends; none of text without any.

    A break is white space after a question or exclamation mark, several full
    stops or closing quotes, before a capital; or after a word with a full stop
    before a capital or digit, if the word is no abbreviation, initial or acronym.
    """
    marked = F.regexp_replace(F.regexp_replace(text, f"[{WS}&&[^\n]]+", " "), r" ?\n ?", "\n")
    for end in (*_ENDS, _STOP):
        marked = F.regexp_replace(marked, end, "$1\n")
    return F.filter(F.transform(F.split(marked, "\n"), lambda s: F.trim(s)), lambda s: s != "")


def strip_incomplete_sentences(parts: Column) -> Column:
    """From the first sentence that begins with a capital to the last that ends with an end mark or quote."""
    first = F.array_position(F.transform(parts, lambda s: s.rlike(f"^[{CAPITAL}]")), True)
    back = F.array_position(F.transform(F.reverse(parts), lambda s: s.rlike("[.!?\"']\\n?\\z")), True)
    count = F.size(parts) - back - first + 2
    return F.when((first > 0) & (back > 0) & (count > 0), F.slice(parts, F.greatest(first, F.lit(1)).cast("int"), F.greatest(count, F.lit(0)).cast("int"))).otherwise(
        F.array().cast("array<string>")
    )


def shingles(text: Column, n: int = 5) -> Column:
    """Distinct character n-grams without the last one; none for texts of up to ``n`` characters."""
    chars = F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))

    def joined(c: Column) -> Column:
        # neighbours side by side, so that no position is counted from the start of the text
        grams = c
        for k in range(1, n):
            grams = F.zip_with(grams, F.slice(c, F.lit(k + 1), F.size(c)), lambda a, b: F.concat(a, b))
        return F.array_distinct(F.slice(grams, F.lit(1), F.size(c) - n))

    found = F.transform(F.array(chars), joined)[0]
    return F.when(F.length(text) > n, found).otherwise(F.array().cast("array<string>"))


def pretokens(text: Column) -> Column:
    """White-space tokens cut after each digit and around each punctuation character."""
    marks = r"\p{P}$+<=>^`|~"
    tokens = F.filter(F.split(text, f"[{WS}]+"), lambda t: t != "")
    digits = F.flatten(F.transform(tokens, lambda t: F.regexp_extract_all(t, F.lit(r"\P{Nd}*\p{Nd}|\P{Nd}+"), F.lit(0))))
    return F.flatten(F.transform(digits, lambda t: F.regexp_extract_all(t, F.lit(f"[{marks}]|[^{marks}]+"), F.lit(0))))
