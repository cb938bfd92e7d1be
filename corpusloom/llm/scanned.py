"""Problem 2: noise in text from scanned pages.

A noisy channel: confusions of characters are learned from known misreadings,
every rare word gets as candidates the corpus words that it may be a misreading
of, and a Viterbi search over each line weighs confusion probabilities against
corpus bigrams.  Running headers are lines whose text, with confusable
characters folded, recurs over the corpus beside a page number, a date or in
capitals, at the edge of pages; page numbers are lines that hold their page's number; hyphens at line
ends count where a word goes on in the next line of running text.
"""

from __future__ import annotations

import math
import re
import zlib
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.registry import query
from corpusloom.llm.survivor import package_key
from corpusloom.session import cut, meet, ship, table

HYPHENS = "-‐‑¬=\xad"
#: Words after a hyphen that belongs to the word, as in "in- och utförsel".
SUSPENDING = ("och", "eller", "samt", "till", "respektive")
#: A line at the edge of at least so many pages of a package is a header; so is one that recurs so often in the
#: corpus, in capitals or with a number or date, and stands at a page's edge in at least this share.
IN_PACKAGE, IN_CAPITALS, NUMBERED, AT_EDGE = 2, 5, 3, 2 / 3
#: Prior probability that a word is misread, and how far above the expected number of misreadings a count may lie.
ERROR, SLACK = 0.05, 4.0
#: What a word that all misreadings explain still counts for, and one with a sign or digit among its letters.
RESIDUE, ODD = 0.05, 1e-6
#: How many times as probable a word is after one that it always follows.
BIGRAM = 50.0
#: Known misreadings are a fixed table.
MAX_REPLACEMENTS = 100_000

_DATE = re.compile(r"(?:(?<!\S)(?!d[ec](?:n|ri)\s)(\S+)\s+)?(?<!\S)(?:d[ec](?:n|ri)\s+)?\d{1,2}[:.]?[ea]?\s+(?!d[ec](?:n|ri)\s)([^\W\d_]+\w*)(?:\s+\d{4})?", re.I)
_PAGE = re.compile(r"\W*(?:sid(?:an|a)?\.?|s\.)?\s*\W*(\d{1,5})\W*\Z", re.I)
_DIGIT = re.compile(r"\d")
_EDGE = ".,;:!?\"”“'’()[]…–—»*"
_DAYS = "måndag tisdag onsdag torsdag fredag lördag söndag".split()
_MONTHS = "januari februari mars april maj juni juli augusti september oktober november december".split()


class Folding:
    """Confusable characters made one, by the learned confusions.

    Single characters that are taken for each other form classes; longer signs
    are then replaced by what they mean, and letters are all that is left.
    """

    def __init__(self, rules: list[tuple[str, str, float]]):
        parent: dict[str, str] = {}

        def root(c: str) -> str:
            while parent.setdefault(c, c) != c:
                c = parent[c]
            return c

        for seen, meant, _ in rules:
            if len(seen) == len(meant) == 1:
                a, b = sorted((root(seen), root(meant)), key=lambda c: (not c.isalpha(), c))
                parent[b] = a
        self.one = {ord(c): root(c) for c in parent}
        self.one |= {ord(seen): "" for seen, meant, _ in rules if len(seen) == 1 and not meant}
        weight = {(seen, meant): p for seen, meant, p in rules}
        longer = {}
        for seen, meant, p in rules:
            if (len(seen) > 1 or len(meant) > 1) and p > weight.get((meant, seen), 0):
                a, b = seen.translate(self.one), meant.translate(self.one)
                if a and a != b and p > longer.get(a, ("", 0))[1]:
                    longer[a] = (b, p)
        self.longer = [(a, longer[a][0]) for a in sorted(longer, key=lambda a: (-len(a), a)) if a not in longer[a][0]]
        self.days = frozenset(self(d + end) for d in _DAYS for end in ("", "en"))
        self.months = frozenset(map(self, _MONTHS))

    def __call__(self, text: str) -> str:
        low = re.sub(r"\s+", "", text.lower()).translate(self.one)
        for a, b in self.longer:
            low = low.replace(a, b)
        return re.sub(r"[\W\d_]+", "", low)

    def undated(self, m: re.Match) -> str:
        """A date as a space, with its weekday; what is none as it is."""
        if self(m[2]) not in self.months:
            return m[0]
        return " " if m[1] is None or self(m[1]) in self.days else f"{m[1]} "


def header_form(line: str, page_no: int | None, fold: Folding) -> str | None:
    """The folded text of a line that has the form of a running header, else null: with its page's number or a date, or in capitals."""
    text = line.strip()
    capitals = text == text.upper()
    if not capitals and not _DIGIT.search(text):
        return None
    rest = _DATE.sub(fold.undated, text)
    dated = rest != text
    if page_no is not None:
        numbered = re.sub(rf"^{page_no}(?!\d)|(?<!\d){page_no}$", " ", rest.strip())
    else:
        numbered = rest
    if not dated and numbered == rest.strip() and not capitals:
        return None
    if sum(c.isalpha() for c in numbered) < 4:
        return None
    return fold(numbered) or None


def is_page_number(line: str, page_no: int | None) -> bool:
    """Whether a line holds only its page's number and decoration; digits may stand apart."""
    if page_no is None or not _DIGIT.search(line):
        return False
    m = _PAGE.match(re.sub(r"(?<=\d)\s(?=\d)", "", line.strip()))
    return bool(m) and int(m[1]) == page_no


class Page:
    """Roles of the lines of a page, and the words of its running text."""

    def __init__(self, content: str, page_no: int | None, headers: frozenset[str], fold: Folding):
        self.lines = content.split("\n")
        self.roles = []
        for line in self.lines:
            if not line.strip():
                self.roles.append("blank")
            elif is_page_number(line, page_no):
                self.roles.append("page_number")
            elif headers and (form := header_form(line, page_no, fold)) and form in headers:
                self.roles.append("header")
            else:
                self.roles.append("text")
        text = [i for i, r in enumerate(self.roles) if r == "text"]
        self.hyphens: list[int] = []
        self.open: int | None = None  # last line, if it ends in a hyphen and nothing follows on the page
        self.words: list[tuple[str, int, int, int]] = []  # word, its line, the line it ends in, its length in the first
        self.start = self.lines[text[0]].strip()[:40] if text else None
        skip = 0
        for at, i in enumerate(text):
            words = self.lines[i].split()
            if skip:
                words = words[skip:]
                skip = 0
            if not words:
                continue
            tail = words[-1]
            hyphened = len(tail) > 1 and tail[-1] in HYPHENS and tail[-2].isalpha()
            after = self.lines[text[at + 1]].strip() if at + 1 < len(text) else None
            if hyphened and (after is None or goes_on(after)):
                words = words[:-1]
            for raw in words:
                if w := raw.strip(_EDGE).lower():
                    self.words.append((w, i, i, len(w)))
            if hyphened and after is None:
                self.open = i
            elif hyphened and goes_on(after):
                self.hyphens.append(i)
                first = tail[:-1].lstrip(_EDGE).lower()
                rest = after.split()[0].rstrip(_EDGE).lower()
                if first and rest and rest[-1] not in HYPHENS:
                    self.words.append((first + rest, i, text[at + 1], len(first)))
                    skip = 1


def goes_on(after: str) -> bool:
    """Whether a text line can begin with the second part of a word."""
    first = after.split()[0].strip(_EDGE) if after.split() else ""
    return bool(first) and not first[0].isupper() and not first.isdigit() and first.lower() not in SUSPENDING


def header_lines(scans: DataFrame, fold: Folding) -> DataFrame:
    """``(scan_id, pkey, page_no, form, edge, capitals)`` of the lines that have the form of a header; the first and last lines besides page numbers are a page's edge."""

    def run(batches):
        for batch in batches:
            out: list[tuple] = []
            for r in batch.to_pylist():
                lines = [x for x in (r["content"] or "").split("\n") if x.strip() and not is_page_number(x, r["page_no"])]
                for k, line in enumerate(lines):
                    if form := header_form(line, r["page_no"], fold):
                        text = line.strip()
                        out.append((r["scan_id"], r["pkey"], r["page_no"], form, int(k in (0, len(lines) - 1)), int(text == text.upper())))
            types = (pa.int64(), pa.string(), pa.int32(), pa.string(), pa.int32(), pa.int32())
            names = ["scan_id", "pkey", "page_no", "form", "edge", "capitals"]
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(types)], names=names)

    rows = scans.select("scan_id", package_key(F.col("package_id")).alias("pkey"), "page_no", "content")
    return rows.mapInArrow(run, "scan_id bigint, pkey string, page_no int, form string, edge int, capitals int")


def recurring_headers(scans: DataFrame, fold: Folding) -> DataFrame:
    """``(scan_id, headers)``: the folded texts of the running headers of every scan that has any.

    A header recurs at the edge of pages, of one package or over the corpus;
    headlines that recur in a large corpus stand anywhere.
    """
    lines = cut(header_lines(scans, fold))
    n = F.count("*")
    known = lines.groupBy("form").agg(n.alias("n"), F.sum("edge").alias("edge"), F.sum("capitals").alias("capitals"))
    often = (F.col("n") >= IN_CAPITALS) | ((F.col("n") >= NUMBERED) & (F.col("capitals") < F.col("n")))
    over_all = known.where(often & (F.col("edge") >= AT_EDGE * F.col("n"))).select("form")
    placed = lines.where("edge = 1 AND pkey IS NOT NULL AND page_no IS NOT NULL").select("pkey", "form", "page_no").distinct()
    within = placed.groupBy("pkey", "form").agg(n.alias("n")).where(F.col("n") >= IN_PACKAGE).select("form")
    headers = over_all.unionByName(within).distinct()
    return meet(lines, headers, "form").groupBy("scan_id").agg(F.collect_set("form").alias("headers"))


def parsed(scans: DataFrame, headers: DataFrame, fold: Folding) -> DataFrame:
    """Pages with the roles of their lines and the words of their running text.

    ``words``, with each word's line, the line it ends in and its length in the
    first, are arrays side by side.
    """
    fields = ("scan_id", "pkey", "page_no", "scanned_at", "roles", "hyphens", "open", "start", "words", "lines", "lines2", "cuts")
    numbers = pa.list_(pa.int32())
    types = (pa.int64(), pa.string(), pa.int32(), pa.timestamp("us"), pa.list_(pa.string()), numbers, pa.int32(), pa.string(), pa.list_(pa.string()), *[numbers] * 3)

    def run(batches):
        for batch in batches:
            out: list[tuple] = []
            for r in batch.to_pylist():
                p = Page(r["content"] or "", r["page_no"], frozenset(r["headers"] or ()), fold)
                words = list(zip(*p.words)) or [()] * 4
                out.append((r["scan_id"], r["pkey"], r["page_no"], r["scanned_at"], p.roles, p.hyphens, p.open, p.start, *words))
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(types)], names=list(fields))

    scans = scans.select("scan_id", "package_id", "page_no", "scanned_at", "content")
    rows = meet(scans, headers, "scan_id", "left").select(
        "scan_id", package_key(F.col("package_id")).alias("pkey"), "page_no", F.col("scanned_at").cast("timestamp_ntz"), "content", "headers"
    )
    schema = (
        "scan_id bigint, pkey string, page_no int, scanned_at timestamp_ntz, roles array<string>, hyphens array<int>, "
        "open int, start string, words array<string>, lines array<int>, lines2 array<int>, cuts array<int>"
    )
    return rows.mapInArrow(run, schema)


def confusions(replacements: DataFrame) -> list[tuple[str, str, float]]:
    """``(seen, meant, probability)`` of character confusions, from known misreadings aligned with their words."""
    rows = replacements.select("misread", "corrected").limit(MAX_REPLACEMENTS + 1).collect()
    if len(rows) > MAX_REPLACEMENTS:
        raise ValueError(f"more than {MAX_REPLACEMENTS} known misreadings")
    counts: dict[tuple[str, str], int] = {}
    for bad, good in rows:
        if not bad or not good:
            continue
        for op, a, b, c, d in SequenceMatcher(None, bad.lower(), good.lower(), False).get_opcodes():
            if op != "equal" and b > a:
                pair = (bad.lower()[a:b], good.lower()[c:d])
                counts[pair] = counts.get(pair, 0) + 1
    total = sum(counts.values())
    rules = {(s, m): n / total for (s, m), n in counts.items()}
    # a letter of a longer sign may itself be misread, as 1) for l) for b
    for (seen, meant), p in list(rules.items()):
        for (one, letter), q in list(rules.items()):
            if len(seen) > 1 and len(letter) == 1 and letter in seen and one:
                rules.setdefault((seen.replace(letter, one, 1), meant), p * q)
    return sorted((s, m, p) for (s, m), p in rules.items())


class Grams:
    """Which runs of four characters words of the corpus have: a set of bits of fixed size, so it may err by one too many."""

    BITS = 1 << 22

    def __init__(self, bits: np.ndarray):
        self.bits, self.known = bits, {}

    @classmethod
    def place(cls, gram: str) -> int:
        return zlib.crc32(gram.encode("utf-8", "surrogatepass")) % cls.BITS

    @classmethod
    def of(cls, words: DataFrame) -> Grams:
        """Of all words in a column ``meant``; every task sends the places of its own, each once."""

        def run(batches):
            found: set[int] = set()
            for batch in batches:
                for w in batch.column(0).to_pylist():
                    w = f"^{w}$"
                    found.update(cls.place(w[i : i + 4]) for i in range(max(1, len(w) - 3)))
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.int32())], names=["place"])

        bits = np.zeros(cls.BITS // 8, np.uint8)
        places = words.select("meant").mapInArrow(run, "place int").distinct().toArrow().column(0).to_numpy()
        np.bitwise_or.at(bits, places >> 3, (1 << (places & 7)).astype(np.uint8))
        return cls(bits)

    def __contains__(self, gram: str) -> bool:
        found = self.known.get(gram)
        if found is None:
            at = self.place(gram)
            found = self.known[gram] = bool(self.bits[at >> 3] >> (at & 7) & 1)
            if len(self.known) > 1_000_000:
                self.known.clear()
        return found


def readings(word: str, rules: list[tuple[str, str, float]], least: float, grams=None) -> dict[str, float]:
    """Words that a word may be a misreading of, with the logarithm of the channel's probability, down to ``least``.

    With ``grams`` only those whose runs of four characters all occur in it.
    """
    begin: dict[str, list] = {}
    for seen, meant, p in rules:
        begin.setdefault(seen[0], []).append((seen, meant, math.log(ERROR) + math.log(p)))
    found: dict[str, float] = {}
    open_ = [(0, "^", 0.0)]
    while open_:
        at, out, score = open_.pop()
        if at == len(word):
            if score < 0 and (meant := out[1:]) != word and score > found.get(meant, -math.inf):
                if grams is None or (out + "$")[-4:] in grams:
                    found[meant] = score
            continue
        steps = [(1, word[at], 0.0)]
        steps += [(len(seen), meant, p) for seen, meant, p in begin.get(word[at], ()) if score + p >= least and word.startswith(seen, at)]
        for size, meant, p in steps:
            longer = out + meant
            if grams is None or all(longer[i - 3 : i + 1] in grams for i in range(max(3, len(out)), len(longer))):
                open_.append((at + size, longer, score + p))
    return found


#: Words of letters and hyphens only, the rest is odd.
_SOUND = r"^[\p{L}-]+$"


def candidate_table(counts: DataFrame, rules: list[tuple[str, str, float]]) -> DataFrame:
    """``(w, own, readings)``: words that may be misread, what they count for themselves, and what they may mean.

    A reading must be a word of the corpus, of letters and hyphens.  Words of
    any length and any number of errors count; a reading so improbable that not
    the most frequent word with its most frequent neighbours could win isn't
    listed.  A word keeps of its own count what exceeds the expected number of
    misreadings.
    """
    spark = counts.sparkSession
    known = counts.where(F.col("w").rlike(_SOUND)).select(F.col("w").alias("meant"), F.col("n").alias("times"))
    most = known.agg(F.max("times")).first()[0] or 1
    shared = spark.sparkContext.broadcast((rules, Grams.of(known)))
    best = math.log(most) + 2 * math.log1p(BIGRAM * most)

    def run(batches):
        known_rules, grams = shared.value
        for batch in batches:
            words, counts_, meant, scores = [], [], [], []
            for w, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sound = all(c.isalpha() or c == "-" for c in w)
                for m, s in readings(w, known_rules, math.log(RESIDUE if sound else ODD) - best, grams).items():
                    if len(m) > 1:  # a single character has no others to be recognised by
                        words.append(w)
                        counts_.append(n)
                        meant.append(m)
                        scores.append(s)
            columns = [pa.array(words, pa.string()), pa.array(counts_, pa.int64()), pa.array(meant, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["w", "n", "meant", "channel"])

    possible = counts.mapInArrow(run, "w string, n bigint, meant string, channel double")
    expected = F.col("times") * F.exp("channel")
    odd = ~F.col("w").rlike(_SOUND)
    worth = (SLACK * expected * 5 >= F.col("n")) | (odd & (F.col("times") > F.col("n"))) | (F.col("times") >= 20 * F.col("n"))
    pairs = meet(possible, known, "meant").withColumn("expected", expected).where(worth)
    grouped = pairs.groupBy("w").agg(
        F.max("n").alias("n"), F.sum("expected").alias("expected"), F.collect_list(F.struct("meant", "channel", "times")).alias("readings")
    )
    own = F.greatest(F.lit(RESIDUE), F.col("n") - SLACK * F.col("expected"))
    return grouped.select("w", F.when(odd, ODD).otherwise(own).alias("own"), "readings")


def viterbi(options: list[list[tuple[str, float, float]]], pairs: dict[tuple[str, str], int]) -> list[str]:
    """The most probable words of a stretch of a line.

    ``options``: per place the possible words, the first as it is seen, with the
    logarithm of the channel and the count.  A word's probability is raised by
    how often it follows the word before, other than here.
    """
    best = {w: (s + math.log(n), [w]) for w, s, n in options[0]}
    for k in range(1, len(options)):
        step: dict[str, tuple[float, list[str]]] = {}
        for w, s, n in options[k]:
            for before, (score, path) in best.items():
                here = w == options[k][0][0] and before == options[k - 1][0][0]
                # a misread word and its copies are no evidence for each other
                together = 0 if n <= RESIDUE else max(0, pairs.get((before, w), 0) - here)
                value = score + s + math.log(n) + math.log1p(BIGRAM * together / max(n, 1.0))
                if w not in step or value > step[w][0]:
                    step[w] = (value, [*path, w])
        best = step
    return max(best.values(), key=lambda x: x[0])[1]


def corrections(pages: DataFrame, rules: list[tuple[str, str, float]]) -> DataFrame:
    """``(scan_id, line, w, meant, wrong)``: words of running text that are misread, their lines, what they mean, and the lines with the wrong characters."""
    tokens = pages.select("scan_id", F.explode("words").alias("w"))
    counts = cut(tokens.groupBy("w").agg(F.count("*").alias("n")))
    candidates = cut(candidate_table(counts, rules))
    # a page asks once for each of its words, so a word of every line travels once a page
    words = pages.select("scan_id", F.explode(F.array_distinct("words")).alias("w"))
    hits = meet(words, candidates, "w").groupBy("scan_id").agg(F.collect_list(F.struct("w", "own", "readings")).alias("hits"))
    near = F.explode(
        F.zip_with(F.slice("words", 1, F.size("words") - 1), F.slice("words", 2, F.size("words")), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    )
    bigrams = pages.where("size(words) > 1").select(near.alias("x")).groupBy("x.a", "x.b").agg(F.count("*").alias("n"))
    known = cut(meet(pages.select("scan_id", "words", "lines", "lines2", "cuts"), hits, "scan_id"))

    def options_of(row):
        """Per line with hits: places, and for each place its possible words."""
        hit = {h["w"]: h for h in row["hits"]}
        ws, at, lines = row["words"], row["lines"], {}
        for i, w in enumerate(ws):
            if w in hit:
                lines.setdefault(at[i], set()).update(k for k in (i - 1, i, i + 1) if 0 <= k < len(ws))
        for places in lines.values():
            runs, run_ = [], []
            for i in sorted(places):
                if run_ and i != run_[-1] + 1:
                    runs.append(run_)
                    run_ = []
                run_.append(i)
            runs.append(run_)
            for r in runs:
                options = []
                for i in r:
                    h = hit.get(ws[i])
                    here = [(ws[i], 0.0, h["own"] if h else 1.0)]
                    if h:
                        here += [(c["meant"], c["channel"], float(c["times"])) for c in h["readings"]]
                    options.append(here)
                yield r, options

    def ask(batches):
        for batch in batches:
            ids, a, b = [], [], []
            for row in batch.to_pylist():
                wanted = {(x[0], y[0]) for _, o in options_of(row) for p, q in zip(o, o[1:]) for x in p for y in q}
                for x, y in wanted:
                    ids.append(row["scan_id"])
                    a.append(x)
                    b.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], names=["scan_id", "a", "b"])

    wanted = known.select("scan_id", "words", "lines", "hits").mapInArrow(ask, "scan_id bigint, a string, b string")
    found = meet(wanted, bigrams, ["a", "b"]).groupBy("scan_id").agg(F.collect_list(F.struct("a", "b", "n")).alias("pairs"))

    def decide(batches):
        types = (pa.int64(), pa.int32(), pa.string(), pa.string(), pa.list_(pa.int32()))
        for batch in batches:
            out: list[tuple] = []
            for row in batch.to_pylist():
                pairs = {(p["a"], p["b"]): p["n"] for p in row["pairs"] or ()}
                fixed = set()
                for places, options in options_of(row):
                    for i, o, w in zip(places, options, viterbi(options, pairs)):
                        if w != o[0][0] and (i, w) not in fixed:
                            fixed.add((i, w))
                            line, line2 = row["lines"][i], row["lines2"][i]
                            out.append((row["scan_id"], line, o[0][0], w, _wrong_lines(o[0][0], w, row["cuts"][i], line, line2)))
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(types)], names=["scan_id", "line", "w", "meant", "wrong"])

    known = meet(known, found, "scan_id", "left")
    return known.mapInArrow(decide, "scan_id bigint, line int, w string, meant string, wrong array<int>")


def open_hyphens(pages: DataFrame) -> DataFrame:
    """``(scan_id, line)``: page ends in a hyphen whose word goes on; if the next page is known, it must say so."""
    ends = pages.where("open IS NOT NULL").select("scan_id", "pkey", (F.col("page_no") + 1).alias("page_no"), F.col("open").alias("line"))
    first = F.regexp_extract(F.lower("start"), r"^[^\p{L}\p{N}]*(\S+)", 1)
    stops = F.col("start").rlike(r"^[^\p{L}\p{N}]*\p{Lu}") | first.rlike(r"^[0-9]+\W*$") | first.isin(*SUSPENDING)
    begins = pages.where("start IS NOT NULL").groupBy("pkey", "page_no").agg(F.min(stops.cast("int")).alias("stops"))
    return meet(ends, begins, ["pkey", "page_no"], "left").where("stops IS NULL OR stops = 0").select("scan_id", "line")


def read_pages(scans: DataFrame, replacements: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parsed pages and the corrections of their words."""
    ship(scans.sparkSession)
    rules = confusions(replacements)
    fold = Folding(rules)
    pages = cut(parsed(scans, recurring_headers(scans, fold), fold))
    return pages, corrections(pages, rules)


def _wrong_lines(w: str, meant: str, cut_at: int, line: int, line2: int) -> list[int]:
    """Lines of a word's halves in which its characters differ from what is meant."""
    if line == line2:
        return [line]
    lines = set()
    for op, a, b, _, _ in SequenceMatcher(None, w, meant, False).get_opcodes():
        if op != "equal":
            lines |= {line} if b <= cut_at else {line2} if a >= cut_at else {line, line2}
    return sorted(lines)


def noisy_lines(scans: DataFrame, replacements: DataFrame) -> DataFrame:
    """``(scan_id, line_no, kind)`` of every noisy line: hyphen, misread, header or page_number.

    Lines count from 1, empty lines included.  Null, empty and blank pages give
    no rows; of repeated scans every one counts; pages without number or package
    have no page numbers or following pages.
    """
    pages, fixes = read_pages(scans, replacements)
    roles = pages.select("scan_id", F.posexplode("roles").alias("line", "kind")).where(F.col("kind").isin("header", "page_number"))
    hyphens = pages.select("scan_id", F.explode("hyphens").alias("line")).unionByName(open_hyphens(pages))
    misread = fixes.select("scan_id", F.explode("wrong").alias("line"), F.lit("misread").alias("kind"))
    found = roles.unionByName(hyphens.withColumn("kind", F.lit("hyphen"))).unionByName(misread)
    return found.select("scan_id", (F.col("line") + 1).cast("bigint").alias("line_no"), "kind").distinct()


def _cased(raw: str, meant: str) -> str:
    """A corrected word between the punctuation and in the case of what it replaces."""
    core = raw.strip(_EDGE)
    at = raw.find(core) if core else 0
    if core.isupper() and len(core) > 1:
        meant = meant.upper()
    elif core[:1].isupper():
        meant = meant[:1].upper() + meant[1:]
    return raw[:at] + meant + raw[at + len(core) :]


def repaired(content: str, roles: list[str], fixes: dict[tuple[int, str], str]) -> list[str]:
    """Paragraphs of a page: its text lines joined, words at hyphens too, misread words corrected."""
    out: list[str] = []
    text, glue = "", False
    for i, (line, role) in enumerate(zip(content.split("\n"), roles)):
        if role == "blank":
            if text and not glue:
                out.append(text)
                text = ""
            continue
        if role != "text":
            continue
        for raw in line.split():
            if glue:
                head, _, last = text.rpartition(" ")
                joined = last + raw
                text = f"{head} {joined}" if head else joined
                raw_word, glue = joined, False
            else:
                text = f"{text} {raw}" if text else raw
                raw_word = raw
            for at in (i, i - 1):
                meant = fixes.get((at, raw_word.strip(_EDGE).lower()))
                if meant is not None:
                    text = text[: len(text) - len(raw_word)] + _cased(raw_word, meant)
                    break
        rest = content.split("\n")[i + 1 :]
        after = next((x.strip() for x, r in zip(rest, roles[i + 1 :]) if r == "text"), None)
        if len(text) > 1 and text[-1] in HYPHENS and text[-2].isalpha() and after is not None and goes_on(after):
            text, glue = text[:-1], True
    return [*out, text] if text else out


def paragraphs(scans: DataFrame, replacements: DataFrame) -> DataFrame:
    """Continuous paragraphs of every package: ``(package, page_no, paragraph_no, text)``.

    Page and number are those of a paragraph's beginning.  Of a page scanned
    several times the latest scan with text counts.  Headers, page numbers and
    blank pages are left out, hyphenated words joined, misread words corrected.  A
    paragraph whose page ends within a sentence or word goes on with the first
    of the next page, over any number of pages; pages of a package are never
    gathered in one task.  Pages without package or number stand alone.
    """
    pages, fixes = read_pages(scans, replacements)
    by_page = fixes.groupBy("scan_id").agg(F.collect_list(F.struct("line", "w", "meant")).alias("fixes"))
    alone = F.concat(F.lit("#"), F.col("scan_id").cast("string"))
    whole = pages.where(F.exists("roles", lambda r: r == "text")).select(
        "scan_id",
        "roles",
        "scanned_at",
        F.when(F.col("page_no").isNull(), alone).otherwise(F.coalesce("pkey", alone)).alias("package"),
        F.coalesce("page_no", F.lit(0)).alias("page_no"),
    )
    best = whole.groupBy("package", "page_no").agg(F.max(F.struct("scanned_at", "scan_id"))["scan_id"].alias("scan_id"))
    rows = meet(whole, best, ["package", "page_no", "scan_id"], "left_semi")
    rows = meet(meet(rows, scans.select("scan_id", "content"), "scan_id"), by_page, "scan_id", "left")

    def run(batches):
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for r in batch.to_pylist():
                parts = repaired(r["content"], r["roles"], {(f["line"], f["w"]): f["meant"] for f in r["fixes"] or ()})
                for k, t in enumerate(parts, 1):
                    for column, x in zip(out, (r["package"], r["page_no"], k, len(parts), t)):
                        column.append(x)
            types = (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, types)], names=["package", "page_no", "paragraph_no", "of", "text"])

    rows = rows.select("package", "page_no", "roles", "content", "fixes")
    found = cut(rows.mapInArrow(run, "package string, page_no int, paragraph_no int, of int, text string"))
    ended = F.col("text").rlike(r"[.!?:…][\"”’»)\]]*$") | ~F.col("text").rlike(r"\p{Ll}")
    last = found.where((F.col("paragraph_no") == F.col("of")) & ~ended)
    last = last.select("package", (F.col("page_no") + 1).alias("page_no"), F.col("page_no").alias("to_page"), F.col("paragraph_no").alias("to_no"))
    goes = F.col("text").rlike(r"^[^\p{L}\p{N}]*[\p{Ll}\p{N}]")
    links = cut(meet(found.where((F.col("paragraph_no") == 1) & goes).select("package", "page_no"), last, ["package", "page_no"]))
    while True:  # a page that is all one paragraph passes its link on; doubling ends after log2 of the longest chain
        onward = links.select("package", F.col("page_no").alias("to_page"), F.lit(1).alias("to_no"), F.col("to_page").alias("far_page"), F.col("to_no").alias("far_no"))
        after = cut(
            meet(links, onward, ["package", "to_page", "to_no"], "left").select(
                "package",
                "page_no",
                F.coalesce("far_page", "to_page").alias("to_page"),
                F.coalesce("far_no", "to_no").alias("to_no"),
                F.col("far_page").isNotNull().alias("moved"),
            )
        )
        links = after.drop("moved")
        if after.where("moved").isEmpty():
            break
    heads = links.select("package", "page_no", F.lit(1).alias("paragraph_no"), "to_page", "to_no")
    placed = meet(found, heads, ["package", "page_no", "paragraph_no"], "left")
    parts = placed.groupBy("package", F.coalesce("to_page", "page_no").alias("page"), F.coalesce("to_no", "paragraph_no").alias("no")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("page_no", "text"))), lambda x: x["text"]).alias("texts")
    )
    joined = F.aggregate(
        F.slice("texts", 2, F.greatest(F.size("texts") - 1, F.lit(0))),
        F.element_at("texts", 1),
        lambda a, t: F.when(a.rlike(r"\p{L}[-‐‑¬=\u00AD]$"), F.concat(F.regexp_replace(a, r".$", ""), t)).otherwise(F.concat(a, F.lit(" "), t)),
    )
    return parts.select("package", F.col("page").alias("page_no"), F.col("no").alias("paragraph_no"), joined.alias("text"))


@query("p2_found")
def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return noisy_lines(table(spark, sf_dir, "scans"), table(spark, sf_dir, "replacements"))


@query("p2_paragraphs")
def p2_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs(table(spark, sf_dir, "scans"), table(spark, sf_dir, "replacements"))
