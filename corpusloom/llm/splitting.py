"""Problem 10: cut oversized texts into pieces at natural boundaries, with overlap."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.bytebpe import DEFAULT_VOCABULARY, Encoder, Shared, worker_encoder
from corpusloom.llm.registry import query
from corpusloom.session import table

CLOSERS = "\"'”’»)]"
#: Words before a cut whose split into tokens the cut may change; the pattern looks ahead over white space only.
TAIL = 8


def _units(encoder: Encoder, text: str, largest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Character and token offsets of the text's units, and which end inside a word.

    A unit is a word; in a word of more than ``largest`` tokens, each run of
    tokens that ends with a character.
    """
    chars, tokens, inner = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], [np.zeros(1, bool)]
    far, so_far = 0, 0

    def add(lengths, sizes, inside) -> None:
        nonlocal far, so_far
        chars.append(far + lengths)
        tokens.append(so_far + sizes)
        inner.append(inside)
        far, so_far = int(chars[-1][-1]), int(tokens[-1][-1])

    for part in encoder.slices(text):
        words = encoder.split(part)
        if not words:
            continue
        encoder.learn(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        sizes = np.fromiter(map(encoder.sizes.__getitem__, words), np.int64, len(words))
        start = 0
        for k in [*np.flatnonzero(sizes > largest).tolist(), len(words)]:
            if k > start:
                add(np.cumsum(lengths[start:k]), np.cumsum(sizes[start:k]), np.zeros(k - start, bool))
            if k < len(words):
                at, upto = encoder.inner_ends(words[k])
                add(np.array(at, np.int64), np.array(upto, np.int64), np.arange(len(at)) < len(at) - 1)
            start = k + 1
    return np.concatenate(chars), np.concatenate(tokens), np.concatenate(inner)


def _in(codes: np.ndarray, test) -> np.ndarray:
    """Which code points a test of characters holds for, asked once for each."""
    every, at = np.unique(codes, return_inverse=True)
    return np.fromiter((test(chr(c)) for c in every.tolist()), bool, len(every))[at]


def _boundaries(text: str, chars: np.ndarray, inner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted units after which a line, a sentence and a word ends, but for the last."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    units = 1 + np.flatnonzero(~inner[1:-1])
    before, after = codes[chars[units] - 1], codes[chars[units]]
    at_line = (before == 10) | (after == 10)
    lines, words = units[at_line], units[~at_line]
    words = words[_in(after[~at_line], str.isspace)]
    k, first = chars[words] - 1, chars[words - 1]
    while len(more := np.flatnonzero((k > first) & _in(codes[k], CLOSERS.__contains__))):
        k[more] -= 1
    return lines, words[_in(codes[k], ".!?…".__contains__)], words


def pieces_of(encoder: Encoder, text: str, total: int, limit: int, overlap: int) -> list[tuple[int, int, int]]:
    """``(start, end, tokens)`` of the pieces of a text of ``total`` tokens.

    Token offsets are prefix sums over the words; a sorted array per kind of
    boundary (paragraph or line end, sentence end, word end) is searched for the
    last boundary within the limit.  A kind is passed over when its last
    boundary would leave more than half of the limit unused; without any
    boundary the cut is hard, between two characters.  The next piece begins at
    the last unit that repeats at least ``overlap`` tokens.
    """
    if total <= limit:
        return [(0, len(text), total)]
    chars, tokens, inner = _units(encoder, text, max(1, overlap // 2))
    n = len(chars) - 1
    lines, sentences, words = _boundaries(text, chars, inner)

    def size_of(a: int, b: int) -> int:
        """Tokens of the text between two units: the sums hold but for the last words, which are encoded anew."""
        k = max(a, b - TAIL)
        if inner[a] or inner[k : b + 1].any():
            return encoder.counts([text[chars[a] : chars[b]]])[0]
        return int(tokens[k] - tokens[a]) + encoder.counts([text[chars[k] : chars[b]]])[0]

    upto = lambda offsets, x: int(np.searchsorted(offsets, x, "right"))
    found, start = [], 0
    while True:
        last = upto(tokens, tokens[start] + limit) - 1
        if last >= n:
            end = n
        else:
            end = 0
            half, some = tokens[start] + limit // 2, tokens[start] + overlap + 1
            for kind, least in ((lines, half), (sentences, half), (words, some)):
                k = upto(kind, last) - 1
                if k >= 0 and tokens[kind[k]] >= least:
                    end = int(kind[k])
                    break
            end = end or max(last, start + 1)
        # a cut may change how its ends are split into tokens; then step back
        while (size := size_of(start, end)) > limit and end > start + 1:
            end -= 1
        found.append((int(chars[start]), int(chars[end]), size))
        if end >= n:
            return found
        start = max(start + 1, min(end, upto(tokens, tokens[end] - overlap) - 1))


def split_oversized(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    limit: int = 2000,
    overlap: int = 100,
    vocabulary: str = DEFAULT_VOCABULARY,
    with_text: bool = True,
) -> DataFrame:
    """Pieces of every text: ``(key, piece_no, n_tokens, start, end[, piece])``.

    ``start`` and ``end`` are character offsets; each piece has at most
    ``limit`` tokens when encoded on its own (a single character that alone has
    more is the only exception), and repeats the last ``overlap`` tokens of the
    piece before, extended to the start of a word.  A text within the limit is
    one piece; null and empty texts have none.  Repeated rows give repeated
    pieces.  No shuffle.
    """
    if not 0 <= overlap < limit // 2:
        raise ValueError("the overlap must be less than half of the limit")
    shared = Shared(df.sparkSession, vocabulary)
    key_type = df.schema[key].dataType

    def run(batches):
        encoder = worker_encoder(shared)
        for batch in batches:
            rows: tuple[list, ...] = ([], [], [], [], [], [])
            held = 0
            texts = batch.column(1).to_pylist()
            totals = encoder.counts([t or "" for t in texts])
            for i, t in enumerate(texts):
                if not t:
                    continue
                for no, (a, b, n) in enumerate(pieces_of(encoder, t, totals[i], limit, overlap), 1):
                    for column, x in zip(rows, (i, no, n, a, b, t[a:b] if with_text else None)):
                        column.append(x)
                    held += b - a
                if with_text and held > 8_000_000:
                    yield emit(batch, rows)
                    rows, held = ([], [], [], [], [], []), 0
            yield emit(batch, rows)

    def emit(batch, rows):
        columns = [
            batch.column(0).take(pa.array(rows[0], pa.int64())),
            pa.array(rows[1], pa.int32()),
            *(pa.array(x, pa.int64()) for x in rows[2:5]),
        ]
        names = [key, "piece_no", "n_tokens", "start", "end"]
        if with_text:
            columns.append(pa.array(rows[5], pa.string()))
            names.append("piece")
        return pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"`{key}` {key_type.simpleString()}, piece_no int, n_tokens bigint, start bigint, end bigint"
    return df.select(F.col(key), F.col(text)).mapInArrow(run, schema + ", piece string" * with_text)


def oversized(
    df: DataFrame, key: str = "doc_id", text: str = "text", limit: int = 2000, overlap: int = 100, vocabulary: str = DEFAULT_VOCABULARY
) -> DataFrame:
    """Keys of the texts that the operator cuts.

    A token is at least one byte, so a text of at most ``limit`` bytes is never
    cut and needs no encoding.
    """
    longer = df.where(F.octet_length(text) > limit)
    pieces = split_oversized(longer, key, text, limit, overlap, vocabulary, with_text=False)
    return pieces.where("piece_no = 2").select(key).distinct()


@query("p10_found")
def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oversized(table(spark, sf_dir, "documents"))


@query("p10_pieces")
def p10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_oversized(table(spark, sf_dir, "documents"))
