"""Shared column expressions: payload texts, labelled fields, letters and digits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: ``label: value`` with a label of letters, after any decoration.
FIELD = r"(?s)^[^\p{L}\p{N}]*(\p{L}[\p{L} .\-]{0,30}?)\s*:\s*(\S.*)$"
FIELD_BREAK = r"[\r\n;|]+"
MIN_FIELDS = 4


def plain_text(content: Column) -> Column:
    """The text itself, or of a text that is a JSON list of strings its elements on lines of their own."""
    parsed = F.from_json(content, "array<string>")
    joined = F.array_join(parsed, "\n")
    return F.when(content.rlike(r"^\s*\["), F.coalesce(joined, content)).otherwise(content)


def letters_and_digits(text: Column) -> Column:
    """Lower-case letters (with their marks) and digits, nothing else."""
    return F.lower(F.regexp_replace(text, r"[^\p{L}\p{M}\p{N}]+", ""))


def same_letters(text: Column) -> Column:
    """What equal contents share: letters and digits, or without any the signs themselves."""
    bare = letters_and_digits(text)
    return F.when(bare != "", bare).otherwise(F.regexp_replace(text, r"[\s\p{Z}]+", ""))


def labelled_fields(text: Column) -> Column:
    """``array<struct<label, value>>`` of a text of at least four labelled fields and nothing else, or null."""
    parts = F.filter(F.split(text, FIELD_BREAK), lambda x: x.rlike(r"[\p{L}\p{N}]"))
    fields = F.transform(
        parts,
        lambda x: F.struct(
            letters_and_digits(F.regexp_extract(x, FIELD, 1)).alias("label"),
            letters_and_digits(F.regexp_extract(x, FIELD, 2)).alias("value"),
        ),
    )
    only = (F.size(parts) >= MIN_FIELDS) & F.forall(parts, lambda x: x.rlike(FIELD))
    # a cheap look for four colons keeps most texts out of the costly branch
    return F.when(text.rlike(r"(?s):.*:.*:.*:"), F.when(only, fields))
