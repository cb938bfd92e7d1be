"""Normalizers over content arrays, applied in one fixed order whatever the order of the call."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as T

ORDER = ("unicode", "unidecode", "moses", "common_errors", "anonymize", "strip_string", "sentence_split", "strip_sentence")
NATIVE = {"moses": T.plain_punctuation, "anonymize": T.anonymize, "strip_string": T.strip_incomplete}
ARRAYS = {"unicode": T.nfkc_array, "unidecode": T.ascii_fold_array}


def apply_normalizers(packages: DataFrame, names: list[str], key: str, content: str = "content", errors: Mapping[str, str] | None = None) -> DataFrame:
    """Packages with normalized content; nulls are untouched.

    With ``sentence_split`` the elements become arrays of sentences;
    ``strip_sentence`` needs it.  Native normalizers transform the array in its
    row.  The two that need Python take the arrays in Arrow batches, without
    exploding them.
    """
    wanted = [n for n in ORDER if n in names]
    if unknown := set(names) - set(ORDER):
        raise ValueError(f"unknown normalizers: {sorted(unknown)}")
    if "strip_sentence" in wanted and "sentence_split" not in wanted:
        raise ValueError("strip_sentence needs sentence_split")
    for name in wanted:
        if name in ARRAYS:
            packages = packages.withColumn(content, ARRAYS[name](F.col(content)))
        elif name == "common_errors":
            packages = packages.withColumn(content, F.transform(content, lambda t: T.replace_words(t, errors or {})))
        elif name == "sentence_split":
            packages = packages.withColumn(content, F.transform(content, T.sentences))
        elif name == "strip_sentence":
            packages = packages.withColumn(content, F.transform(content, T.strip_incomplete_sentences))
        else:
            packages = packages.withColumn(content, F.transform(content, NATIVE[name]))
    return packages
