"""Queries of the core operators over the driver's tables, with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.functions.patterns import ABBREVIATIONS, ANONYMOUS, ANONYMOUS_SEQUENCE, CAPITAL, CLOCK, PUNCTUATION, TOKEN, UNREADABLE, WS, W
from corpusloom.operators import content as C
from corpusloom.operators import dedup as D
from corpusloom.operators import filters as R
from corpusloom.operators import grams as M
from corpusloom.operators import scoring as S
from corpusloom.operators import stats as A
from corpusloom.plans.pipelines import run_pipeline
from corpusloom.plans.registry import query
from corpusloom.session import table
from corpusloom.sources import readers

MAX_DICTIONARY = 10_000


def q(pattern: str) -> str:
    """A pattern as an SQL literal."""
    return "'" + pattern.replace("'", "''") + "'"


def boxes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "boxes").select("box_id", "package_id", "pos", "content")


def packages(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "packages").select("rec_id", "meta", "content")


def paragraphs(spark: SparkSession, d: str) -> DataFrame:
    """Lines of the documents, with year and title."""
    docs = table(spark, d, "documents").select("doc_id", F.col("pub_year").alias("year"), "title", F.split("text", "\n", -1).alias("content"))
    return C.explode_content(docs, "doc_id", keep=["year", "title"])


def dictionary(spark: SparkSession, d: str) -> dict[str, str]:
    """The fixed table of known misreadings."""
    rows = table(spark, d, "replacements").where("misread IS NOT NULL AND corrected IS NOT NULL").limit(MAX_DICTIONARY + 1).collect()
    if len(rows) > MAX_DICTIONARY:
        raise ValueError(f"more than {MAX_DICTIONARY} replacements")
    return {r["misread"]: r["corrected"] for r in rows}


def common(spark: SparkSession, d: str) -> dict[str, list[str]]:
    """The fixed table of common words by language."""
    found: dict[str, list[str]] = {}
    rows = table(spark, d, "common_words").limit(MAX_DICTIONARY + 1).collect()
    if len(rows) > MAX_DICTIONARY:
        raise ValueError(f"more than {MAX_DICTIONARY} common words")
    for r in sorted(rows, key=lambda r: (r["lang"], r["word_rank"])):
        found.setdefault(r["lang"], []).append(r["word"])
    return found


LINE = "replace(content, chr(10), ' ')"
WORDS = lambda text: f"len(regexp_extract_all({text}, {q(TOKEN)}))"
TIMES = lambda text: f"len(regexp_extract_all({text}, {q(CLOCK)}))"
ELEMENTS = "SELECT rec_id, unnest(range(len(content))) AS pos, unnest(content) AS text FROM packages"
PARAGRAPHS = """SELECT doc_id, pub_year AS year, title, unnest(range(len(parts))) AS pos, unnest(parts) AS text
    FROM (SELECT *, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL)"""


# --- content


@query("explode_content", f"SELECT rec_id, CAST(pos AS INTEGER) AS pos, text FROM ({ELEMENTS})")
def explode_content(spark, d):
    return C.explode_content(packages(spark, d), "rec_id")


@query("text_lines", f"SELECT rec_id, CAST(pos AS INTEGER) AS pos, text AS line FROM ({ELEMENTS}) WHERE text <> ''")
def text_lines(spark, d):
    return C.text_lines(packages(spark, d), "rec_id")


_KEPT = f"""kept AS (
    SELECT rec_id, pos, replace(text, chr(10), ' ') AS text, text IS NOT NULL AND {WORDS("text")} >= 25 AS keep FROM ({ELEMENTS})
)"""


def _rendered(df: DataFrame) -> DataFrame:
    return C.explode_content(df, "rec_id").withColumn("pos", F.col("pos").cast("bigint"))


@query(
    "content_breaks",
    f"""WITH {_KEPT}, marked AS (
        SELECT *, lag(keep) OVER (PARTITION BY rec_id ORDER BY pos) AS before FROM kept
    ), emitted AS (
        SELECT rec_id, pos, CASE WHEN keep THEN text END AS text FROM marked WHERE keep OR text IS NULL OR before
    ) SELECT rec_id, row_number() OVER (PARTITION BY rec_id ORDER BY pos) - 1 AS pos, text FROM emitted""",
)
def content_breaks(spark, d):
    return _rendered(C.filter_content(packages(spark, d), lambda t: R.first_failing(t, [R.num_tokens(25)])))


@query("content_breaks_removed", f"WITH {_KEPT} SELECT rec_id, row_number() OVER (PARTITION BY rec_id ORDER BY pos) - 1 AS pos, text FROM kept WHERE keep")
def content_breaks_removed(spark, d):
    return _rendered(C.filter_content(packages(spark, d), lambda t: R.first_failing(t, [R.num_tokens(25)]), remove_breaks=True))


@query(
    "fuse_paragraphs",
    f"""WITH islands AS (
        SELECT *, sum(CASE WHEN text IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY rec_id ORDER BY pos) AS island FROM ({ELEMENTS})
    ), fused AS (
        SELECT rec_id, island, string_agg(text, ' ' ORDER BY pos) AS text FROM islands WHERE text IS NOT NULL GROUP BY rec_id, island
    ) SELECT rec_id, row_number() OVER (PARTITION BY rec_id ORDER BY island) - 1 AS pos, text FROM fused""",
)
def fuse_paragraphs(spark, d):
    return _rendered(C.fuse_paragraphs(packages(spark, d)))


@query(
    "fuse_ignore_breaks",
    f"SELECT rec_id, CAST(0 AS BIGINT) AS pos, coalesce(string_agg(text, ' ' ORDER BY pos), '') AS text FROM ({ELEMENTS}) GROUP BY rec_id",
)
def fuse_ignore_breaks(spark, d):
    return _rendered(C.fuse_paragraphs(packages(spark, d), ignore_breaks=True))


@query(
    "regroup_kept",
    f"""WITH {_KEPT} SELECT p.rec_id, coalesce((SELECT string_agg(text, '|' ORDER BY pos) FROM kept k WHERE k.rec_id = p.rec_id AND keep), '') AS content
    FROM packages p""",
)
def regroup_kept(spark, d):
    docs = C.explode_content(packages(spark, d), "rec_id").withColumn("text", T.one_line(F.col("text")))
    kept = docs.where(T.token_count(F.col("text")) >= 25)
    return C.regroup(packages(spark, d), kept, "rec_id").select("rec_id", F.array_join("content", "|").alias("content"))


@query("prefix_ids", "SELECT rec_id, concat_ws('_', 'kb', meta.package_id) AS package_id FROM packages")
def prefix_ids(spark, d):
    return C.prefix_ids(packages(spark, d), "kb").select("rec_id", "meta.package_id")


@query(
    "document_keys",
    r"""WITH keys AS (SELECT box_id, concat_ws('_', package_id, pos) AS key FROM boxes WHERE package_id IS NOT NULL)
    SELECT box_id, key, regexp_extract(key, '(?s)^(.*)_([0-9]+)$', 1) AS package, TRY_CAST(regexp_extract(key, '(?s)^(.*)_([0-9]+)$', 2) AS INTEGER) AS pos FROM keys""",
)
def document_keys(spark, d):
    keys = boxes(spark, d).where("package_id IS NOT NULL").select("box_id", C.document_key(F.col("package_id"), F.col("pos")).alias("key"))
    position = F.regexp_extract("key", "(?s)^(.*)_([0-9]+)$", 2).try_cast("int")
    return keys.select("box_id", "key", C.key_package(F.col("key")).alias("package"), position.alias("pos"))


# --- filters


@query("filter_num_tokens", f"SELECT box_id FROM boxes WHERE {WORDS(LINE)} >= 30")
def filter_num_tokens(spark, d):
    return boxes(spark, d).where(R.first_failing(F.col("content"), [R.num_tokens()]).isNull() & F.col("content").isNotNull()).select("box_id")


@query("filter_unicode", f"SELECT crawl_id FROM crawl WHERE NOT regexp_matches(content, {q(UNREADABLE)})")
def filter_unicode(spark, d):
    crawl = table(spark, d, "crawl")
    return crawl.where(R.first_failing(F.col("content"), [R.readable()]).isNull() & F.col("content").isNotNull()).select("crawl_id")


@query("filter_lines", f"SELECT crawl_id, line FROM (SELECT crawl_id, unnest(string_split(content, chr(10))) AS line FROM crawl) WHERE NOT regexp_matches(line, {q(UNREADABLE)})")
def filter_lines(spark, d):
    lines = table(spark, d, "crawl").select("crawl_id", F.explode(F.split("content", "\n", -1)).alias("line"))
    return lines.where(R.readable().keep(F.col("line")))


@query(
    "filter_lines_swedish",
    rf"""WITH lines AS (SELECT crawl_id, i, string_split(content, chr(10))[i] AS line FROM (SELECT crawl_id, content, unnest(range(1, len(string_split(content, chr(10))) + 1)) AS i FROM crawl)),
    words AS (SELECT crawl_id, i, line, unnest(regexp_split_to_array(lower(line), '[^\p{{L}}]+')) AS word FROM lines WHERE NOT regexp_matches(line, {q(UNREADABLE)})),
    counts AS (SELECT crawl_id, i, line, lang, count(*) AS n FROM words JOIN (SELECT DISTINCT lang, word FROM common_words) USING (word) GROUP BY crawl_id, i, line, lang),
    sums AS (SELECT crawl_id, i, line, sum(n) AS total, coalesce(max(n) FILTER (lang = 'sv'), 0) AS swedish, coalesce(max(n) FILTER (lang <> 'sv'), 0) AS other FROM counts GROUP BY crawl_id, i, line)
    SELECT crawl_id, line FROM sums WHERE swedish - other >= 0.95 * total""",
)
def filter_lines_swedish(spark, d):
    """Readable lines in Swedish, ahead of any other language by 0.95."""
    return filter_lines(spark, d).where(R.language(R.word_provider(common(spark, d)), margin=0.95).keep(F.col("line")))


@query("filter_tv_tables", f"SELECT box_id FROM boxes WHERE {TIMES(LINE)} <= 3")
def filter_tv_tables(spark, d):
    return boxes(spark, d).where(R.first_failing(F.col("content"), [R.tv_tables()]).isNull() & F.col("content").isNotNull()).select("box_id")


@query("filter_language_label", "SELECT doc_id FROM documents WHERE text IS NOT NULL AND lang = 'sv'")
def filter_language_label(spark, d):
    docs = table(spark, d, "documents")
    spec = R.language(R.label_provider(F.col("lang")))
    return docs.where(F.col("text").isNotNull() & spec.keep(F.col("text"))).select("doc_id")


@query(
    "filter_language_words",
    r"""WITH words AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\p{L}]+')) AS word FROM documents WHERE text IS NOT NULL),
    counts AS (SELECT doc_id, lang, count(*) AS n FROM words JOIN (SELECT DISTINCT lang, word FROM common_words) USING (word) GROUP BY doc_id, lang),
    shares AS (SELECT doc_id, lang, n / sum(n) OVER (PARTITION BY doc_id) AS share FROM counts),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY share DESC, lang DESC) AS r,
        lead(share) OVER (PARTITION BY doc_id ORDER BY share DESC, lang DESC) AS second FROM shares)
    SELECT doc_id FROM ranked WHERE r = 1 AND lang = 'sv' AND share - coalesce(second, 0) >= 0.5""",
)
def filter_language_words(spark, d):
    spec = R.language(R.word_provider(common(spark, d)))
    return table(spark, d, "documents").where(F.col("text").isNotNull() & spec.keep(F.col("text"))).select("doc_id")


#: The languages of the labels.
LABELS = ["da", "de", "en", "fi", "fr", "sv"]


@query(
    "filter_language_grams",
    rf"""WITH texts AS (SELECT doc_id, lang, string_split(' ' || trim(regexp_replace(lower(text), '[^\p{{L}}]+', ' ', 'g'), ' ') || ' ', '') AS c FROM documents WHERE text IS NOT NULL),
    grams AS (SELECT doc_id, lang, ((unicode(c[i]) * 31 + unicode(c[i + 1])) % {M.BUCKETS} * 31 + unicode(c[i + 2])) % {M.BUCKETS} AS b
        FROM (SELECT doc_id, lang, c, unnest(range(1, len(c) - 1)) AS i FROM texts)),
    labels AS (SELECT unnest({LABELS}) AS label), buckets AS (SELECT unnest(range({M.BUCKETS})) AS b),
    counts AS (SELECT label, buckets.b, count(grams.b) AS n FROM labels CROSS JOIN buckets LEFT JOIN grams ON grams.lang = label AND grams.b = buckets.b GROUP BY 1, 2),
    model AS (SELECT label, b, ln((n + 0.5) / (sum(n) OVER (PARTITION BY label) + 0.5 * {M.BUCKETS})) AS w FROM counts),
    sums AS (SELECT doc_id, label, sum(w) AS s FROM (SELECT doc_id, b FROM grams) JOIN model USING (b) GROUP BY 1, 2),
    probs AS (SELECT doc_id, label, 1 / (SELECT sum(exp(least(o.s - a.s, 700))) FROM sums o WHERE o.doc_id = a.doc_id) AS p FROM sums a)
    SELECT doc_id FROM probs GROUP BY doc_id HAVING max(p) FILTER (label = 'sv') - max(p) FILTER (label <> 'sv') >= 0.5""",
)
def filter_language_grams(spark, d):
    docs = table(spark, d, "documents")
    spec = R.language(M.gram_provider(M.learn(docs, "text", "lang", LABELS)))
    return docs.where(F.col("text").isNotNull() & spec.keep(F.col("text"))).select("doc_id")


_SPECS = [R.num_tokens(), R.readable(), R.tv_tables()]
_VERDICT = f"""CASE WHEN content IS NULL THEN NULL WHEN {WORDS(LINE)} < 30 THEN 'num_tokens'
    WHEN regexp_matches({LINE}, {q(UNREADABLE)}) THEN 'unicode' WHEN {TIMES(LINE)} > 3 THEN 'tv_tables' END"""


@query("filter_verdicts", f"SELECT coalesce({_VERDICT}, 'kept') AS filter_name, count(*) AS n FROM boxes WHERE content IS NOT NULL GROUP BY 1")
def filter_verdicts(spark, d):
    rows = boxes(spark, d).where("content IS NOT NULL").select(R.first_failing(F.col("content"), _SPECS).alias("v"))
    return rows.groupBy(F.coalesce("v", F.lit("kept")).alias("filter_name")).agg(F.count("*").alias("n"))


@query("removed_report", f"SELECT filter_name, box_id, text FROM (SELECT box_id, {LINE} AS text, {_VERDICT} AS filter_name FROM boxes) WHERE filter_name IS NOT NULL")
def removed_report(spark, d):
    rows = R.apply_filters(boxes(spark, d), _SPECS, "content")
    return rows.where("filter_name IS NOT NULL").select("filter_name", "box_id", F.col("content").alias("text"))


@query("exact_duplicates", "SELECT box_id FROM boxes WHERE content IS NULL UNION ALL SELECT min(box_id) FROM boxes WHERE content IS NOT NULL GROUP BY content")
def exact_duplicates(spark, d):
    return R.exact_duplicates(boxes(spark, d), "content", ["box_id"]).select("box_id")


@query("exact_duplicates_min_size", f"SELECT min(box_id) AS box_id FROM boxes WHERE {WORDS('content')} >= 30 GROUP BY content")
def exact_duplicates_min_size(spark, d):
    return R.exact_duplicates(boxes(spark, d), "content", ["box_id"], least_tokens=30).select("box_id")


@query(
    "exact_duplicate_verdicts",
    f"""WITH rows_ AS (SELECT box_id, {LINE} AS text, {_VERDICT} AS v FROM boxes),
    firsts AS (SELECT min(box_id) AS box_id FROM rows_ WHERE v IS NULL AND text IS NOT NULL GROUP BY text)
    SELECT filter_name, count(*) AS n FROM (
        SELECT coalesce(v, CASE WHEN text IS NULL OR box_id IN (SELECT box_id FROM firsts) THEN 'kept' ELSE 'exact_duplicate' END) AS filter_name FROM rows_
    ) GROUP BY filter_name""",
)
def exact_duplicate_verdicts(spark, d):
    rows = R.apply_filters(boxes(spark, d), _SPECS, "content", ["box_id"], duplicates="exact")
    return rows.groupBy(F.coalesce("filter_name", F.lit("kept")).alias("filter_name")).agg(F.count("*").alias("n"))


# --- normalizers


def _sql_single_pass() -> str:
    pattern = "|".join(p for p, _ in ANONYMOUS)
    cases = " ".join(f"WHEN regexp_matches(m, {q(f'^(?:{p})$')}) THEN {q(by)}" for p, by in ANONYMOUS)
    return f"""array_to_string(list_transform(list_zip(regexp_split_to_array(content, {q(pattern)}),
        list_transform(regexp_extract_all(content, {q(pattern)}), lambda m: CASE {cases} END)), lambda z: z[1] || coalesce(z[2], '')), '')"""


@query("anonymize", f"SELECT box_id, {_sql_single_pass()} AS text FROM boxes WHERE content IS NOT NULL")
def anonymize(spark, d):
    return boxes(spark, d).where("content IS NOT NULL").select("box_id", T.anonymize(F.col("content")).alias("text"))


def _sql_chain(rules, text: str) -> str:
    for pattern, by in rules:
        text = f"regexp_replace({text}, {q(pattern)}, {q(by.replace('$1', chr(92) + '1'))}, 'g')"
    return text


@query("anonymize_sequential", f"SELECT box_id, {_sql_chain(ANONYMOUS_SEQUENCE, 'content')} AS text FROM boxes WHERE content IS NOT NULL")
def anonymize_sequential(spark, d):
    return boxes(spark, d).where("content IS NOT NULL").select("box_id", T.anonymize_sequential(F.col("content")).alias("text"))


@query("plain_punctuation", f"SELECT doc_id, {_sql_chain(PUNCTUATION, 'text')} AS text FROM documents")
def plain_punctuation(spark, d):
    return table(spark, d, "documents").select("doc_id", T.plain_punctuation(F.col("text")).alias("text"))


@query("collapse_spaces", "SELECT box_id, regexp_replace(content, ' {2,}', ' ', 'g') AS text FROM boxes")
def collapse_spaces(spark, d):
    return boxes(spark, d).select("box_id", T.collapse_spaces(F.col("content")).alias("text"))


_HEAD, _UPTO = f"(?s)^(.*?)[{CAPITAL}][{W}]+", f"(?s)^(.*[.!?\"'])[{WS}]"


@query(
    "strip_incomplete",
    f"""WITH t AS (SELECT box_id, content, length(regexp_extract(content, {q(_HEAD)}, 1)) AS a, length(regexp_extract(content, {q(_UPTO)}, 1)) AS e FROM boxes)
    SELECT box_id, substring(content, a + 1, greatest(CASE WHEN e > 0 THEN e ELSE length(content) - 1 END - a, 0)) AS text FROM t WHERE content IS NOT NULL""",
)
def strip_incomplete(spark, d):
    return boxes(spark, d).where("content IS NOT NULL").select("box_id", T.strip_incomplete(F.col("content")).alias("text"))


_OPEN, _CLOSE = r"""['"(\[¿¡\p{Pi}]""", r"""['")\]\p{Pf}]"""
_SPACE = WS.replace(r"\t-\r", r"\t\x{B}-\r")
_HELD = "|".join([r"\p{Lu}", *ABBREVIATIONS])


def _sentences_sql() -> str:
    """Sentences of documents by walking along the words of each line: a break stands after a word if what it ends in and what follows ask for one."""
    capital = f"regexp_matches(rest, {q(f'^{_OPEN}* ?' + chr(92) + 'p{Lu}')})"
    near = f"regexp_matches(rest, {q(f'^{_OPEN}*' + chr(92) + 'p{Lu}')})"
    opened = f"regexp_matches(rest, {q(f'^{_OPEN}+ ?' + chr(92) + 'p{Lu}')})"
    begins = f"regexp_matches(rest, {q(f'^{_OPEN}* ?[' + chr(92) + 'p{Lu}0-9]')})"
    held = f"regexp_matches(w, {q(f'(?:^|[^{W}.-])(?:{_HELD})[.]+$')}) OR regexp_matches(w, {q(chr(92) + '.[' + chr(92) + 'p{Lu}-]+[.]+$')})"
    ends = f"""(regexp_matches(w, '([?!]|[.][.])$') AND {near})
        OR ((regexp_matches(w, {q(f'[?!.]{_CLOSE}+$')}) OR (regexp_matches(w, {q(f'^{_CLOSE}+$')}) AND regexp_matches(coalesce(prior, ''), '[?!.]$'))) AND {capital})
        OR (regexp_matches(w, '[?!.]$') AND {opened}) OR (regexp_matches(w, '[.]$') AND NOT ({held}) AND {begins})"""
    return f"""lines AS (SELECT doc_id, unnest(range(1, len(l) + 1)) AS line, unnest(l) AS t FROM (SELECT doc_id, string_split(regexp_replace(
            regexp_replace(text, {q(f"[{_SPACE}]+")}, ' ', 'g'), ' ?' || chr(10) || ' ?', chr(10), 'g'), chr(10)) AS l FROM documents)),
        words AS (SELECT doc_id, line, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS w FROM (SELECT doc_id, line, string_split(t, ' ') AS ws FROM lines)),
        near AS (SELECT *, lag(w) OVER o AS prior, lead(w) OVER o || coalesce(' ' || lead(w, 2) OVER o, '') AS rest FROM words WINDOW o AS (PARTITION BY doc_id, line ORDER BY i)),
        ended AS (SELECT *, coalesce({ends}, FALSE) AS ends FROM near),
        numbered AS (SELECT *, coalesce(sum(CASE WHEN ends THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, line ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS no FROM ended),
        parts AS (SELECT doc_id, line, no, trim(string_agg(w, ' ' ORDER BY i), ' ') AS s FROM numbered GROUP BY doc_id, line, no)"""


@query("sentences", f"WITH {_sentences_sql()} SELECT doc_id, count(*) AS n, min(s) AS least, max(s) AS most FROM parts WHERE s <> '' GROUP BY doc_id")
def sentences(spark, d):
    rows = table(spark, d, "documents").select("doc_id", F.explode(T.sentences(F.col("text"))).alias("s"))
    return rows.groupBy("doc_id").agg(F.count("*").alias("n"), F.min("s").alias("least"), F.max("s").alias("most"))


@query(
    "complete_sentences",
    f"""WITH {_sentences_sql()}, placed AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line, no) AS k FROM parts WHERE s <> ''),
    ends AS (SELECT doc_id, min(k) FILTER (regexp_matches(s, {q(f"^[{CAPITAL}]")})) AS first, max(k) FILTER (regexp_matches(s, {q("[.!?" + chr(34) + "']$")})) AS last FROM placed GROUP BY doc_id)
    SELECT d.doc_id, coalesce((SELECT string_agg(s, '|' ORDER BY k) FROM placed p JOIN ends e USING (doc_id) WHERE p.doc_id = d.doc_id AND k BETWEEN first AND last), '') AS sentences
    FROM documents d WHERE text IS NOT NULL""",
)
def complete_sentences(spark, d):
    parts = T.strip_incomplete_sentences(T.sentences(F.col("text")))
    return table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", F.array_join(parts, "|").alias("sentences"))


_BOUND = f"'(?:^|[^{W}])(?:' || alternatives || ')(?:[^{W}]|$)'"


@query(
    "replace_words",
    f"""WITH d AS (SELECT map(list(misread), list(corrected)) AS table_, string_agg(regexp_escape(misread), '|' ORDER BY length(misread) DESC, misread) AS alternatives
        FROM replacements WHERE misread IS NOT NULL AND corrected IS NOT NULL),
    cut AS (SELECT scan_id, content, table_, regexp_extract_all(content, {_BOUND}) AS found, regexp_split_to_array(content, {_BOUND}) AS between FROM scans, d),
    meant AS (SELECT scan_id, content, between, list_transform(found, lambda m: coalesce(m[1] || table_[m[2:len(m) - 1]] || m[len(m)], m[1] || table_[m[2:]], table_[m[:len(m) - 1]] || m[len(m)], table_[m])) AS meant FROM cut)
    SELECT scan_id, CASE WHEN content IS NOT NULL THEN array_to_string(list_transform(list_zip(between, meant), lambda z: z[1] || coalesce(z[2], '')), '') END AS content FROM meant""",
)
def replace_words(spark, d):
    words = dictionary(spark, d)
    return table(spark, d, "scans").select("scan_id", T.replace_words(F.col("content"), words).alias("content"))


_ANY_CASE = f"'(?i)(?:^|[^{W}])(?:' || alternatives || ')(?:[^{W}]|$)'"


@query(
    "replace_words_ignore_case",
    f"""WITH d AS (SELECT map(list(misread), list(corrected)) AS table_, string_agg(regexp_escape(misread), '|' ORDER BY length(misread) DESC, misread) AS alternatives
        FROM (SELECT lower(misread) AS misread, any_value(corrected) AS corrected FROM replacements WHERE misread IS NOT NULL AND corrected IS NOT NULL GROUP BY 1)),
    cut AS (SELECT scan_id, content, table_, regexp_extract_all(content, {_ANY_CASE}) AS found, regexp_split_to_array(content, {_ANY_CASE}) AS between FROM scans, d),
    meant AS (SELECT scan_id, content, between, list_transform(found, lambda m: coalesce(m[1] || table_[lower(m[2:len(m) - 1])] || m[len(m)], m[1] || table_[lower(m[2:])],
        table_[lower(m[:len(m) - 1])] || m[len(m)], table_[lower(m)])) AS meant FROM cut)
    SELECT scan_id, CASE WHEN content IS NOT NULL THEN array_to_string(list_transform(list_zip(between, meant), lambda z: z[1] || coalesce(z[2], '')), '') END AS content FROM meant""",
)
def replace_words_ignore_case(spark, d):
    words = dictionary(spark, d)
    return table(spark, d, "scans").select("scan_id", T.replace_words(F.col("content"), words, ignore_case=True).alias("content"))


_GONE, _GAP = (p.replace(r"\t\n\f\r", r"\t\n\x{C}\r") for p in (T._NMT_GONE, T._NMT_SPACE))


@query("clean_up", f"SELECT crawl_id, regexp_replace(regexp_replace(content, {q(_GONE)}, '', 'g'), {q(_GAP)}, ' ', 'g') AS content FROM crawl")
def clean_up(spark, d):
    return table(spark, d, "crawl").select("crawl_id", T.clean_up(F.col("content")).alias("content"))


@query("tokenizer_text")
def tokenizer_text(spark, d):
    return table(spark, d, "crawl").select("crawl_id", T.tokenizer_text(F.col("content")).alias("content"))


@query("nfkc")
def nfkc(spark, d):
    return table(spark, d, "crawl").select("crawl_id", T.nfkc("content").alias("content"))


@query("ascii_fold")
def ascii_fold(spark, d):
    return table(spark, d, "crawl").select("crawl_id", T.ascii_fold("content").alias("content"))


# --- statistics

_DOCS = f"docs AS (SELECT *, {WORDS('text')} AS words FROM ({PARAGRAPHS}) WHERE {WORDS('text')} > 0)"


@query(
    "stats_by_year",
    f"""WITH {_DOCS} SELECT year, count(*) AS docs, CAST(sum(words) AS BIGINT) AS words, round(avg(DISTINCT words), 6) AS avg_doc_len,
        round(avg(words), 6) AS mean_doc_len FROM docs GROUP BY year""",
)
def stats_by_year(spark, d):
    return A.by_year(A.documents_with_words(paragraphs(spark, d)))


@query("length_histogram", f"WITH {_DOCS} SELECT year, CAST(words AS INTEGER) AS length, count(*) AS n FROM docs GROUP BY 1, 2")
def length_histogram(spark, d):
    return A.length_histogram(A.documents_with_words(paragraphs(spark, d)))


@query("title_histogram", f"WITH {_DOCS} SELECT year, title, count(*) AS n FROM docs GROUP BY 1, 2")
def title_histogram(spark, d):
    return A.title_histogram(A.documents_with_words(paragraphs(spark, d)))


_BIN = "CASE " + " ".join(f"WHEN words < {b} THEN {b}" for b in A.BINS[:-1]) + f" ELSE {A.BINS[-1]} END"


def _bins_sql(value: str) -> str:
    return f"""WITH {_DOCS}, bins AS (SELECT {_BIN} AS bin, CAST(sum({value}) AS BIGINT) AS n FROM docs GROUP BY 1)
        SELECT bin, n, round(n / sum(n) OVER (), 6) AS share FROM bins"""


@query("length_bins", _bins_sql("1"))
def length_bins(spark, d):
    return A.power_bins(A.length_histogram(A.documents_with_words(paragraphs(spark, d))))


@query("length_bins_weighted", _bins_sql("words"))
def length_bins_weighted(spark, d):
    return A.power_bins(A.length_histogram(A.documents_with_words(paragraphs(spark, d))), weighted=True)


@query(
    "year_table",
    f"""WITH {_DOCS} SELECT CASE WHEN grouping(year) = 1 THEN 'all' ELSE CAST(year AS VARCHAR) END AS year, count(*) AS docs, CAST(sum(words) AS BIGINT) AS words,
        round(avg(DISTINCT words), 6) AS avg_doc_len, round(avg(words), 6) AS mean_doc_len FROM docs GROUP BY GROUPING SETS ((year), ())""",
)
def year_table(spark, d):
    return A.year_table(A.documents_with_words(paragraphs(spark, d)))


@query(
    "stats_json",
    f"""WITH {_DOCS}, years AS (SELECT coalesce(year, -1) AS year, coalesce(title, '') AS title, words FROM docs),
    lengths AS (SELECT year, sum(n) AS docs, sum(n * words) AS total, string_agg('"' || words || '":' || n, ',' ORDER BY words) AS list FROM (SELECT year, words, count(*) AS n FROM years GROUP BY ALL) GROUP BY year),
    titles AS (SELECT year, string_agg(to_json(title) || ':' || n, ',' ORDER BY title) AS list FROM (SELECT year, title, count(*) AS n FROM years GROUP BY ALL) GROUP BY year)
    SELECT year, '{{"#docs":' || docs || ',"#words":' || total || ',"doc lengths":{{' || l.list || '}},"titles":{{' || t.list || '}}}}' AS stats FROM lengths l JOIN titles t USING (year)""",
)
def stats_json(spark, d):
    return A.as_json(A.documents_with_words(paragraphs(spark, d)))


# --- near duplicates


@query(
    "shingle_counts",
    """SELECT doc_id, CASE WHEN length(text) > 5 THEN len(list_distinct(list_transform(range(1, length(text) - 4), lambda i: substring(text, i, 5)))) ELSE 0 END AS n
    FROM documents WHERE text IS NOT NULL""",
)
def shingle_counts(spark, d):
    docs = table(spark, d, "documents").where("text IS NOT NULL")
    return docs.select("doc_id", F.size(T.shingles(F.col("text"))).cast("bigint").alias("n"))


@query("fingerprints")
def fingerprints(spark, d):
    return D.fingerprints(table(spark, d, "documents"), "doc_id")


@query("bands")
def bands(spark, d):
    return D.bands(D.fingerprints(table(spark, d, "documents"), "doc_id"), "doc_id")


_PAIRS = """texts AS (SELECT min(doc_id) AS rep, text FROM documents WHERE length(text) > 5 GROUP BY text),
    grams AS (SELECT rep, unnest(list_distinct(list_transform(range(1, length(text) - 4), lambda i: substring(text, i, 5)))) AS gram FROM texts),
    sizes AS (SELECT rep, count(*) AS n FROM grams GROUP BY rep),
    shared AS (SELECT a.rep AS src, b.rep AS dst, count(*) AS n FROM grams a JOIN grams b ON a.gram = b.gram AND a.rep < b.rep GROUP BY 1, 2),
    pairs AS (SELECT src, dst, shared.n / WHOLE AS jaccard FROM shared JOIN sizes a ON a.rep = src JOIN sizes b ON b.rep = dst WHERE shared.n / WHOLE > 0.5)"""
_UNION, _LEAST = _PAIRS.replace("WHOLE", "(a.n + b.n - shared.n)"), _PAIRS.replace("WHOLE", "least(a.n, b.n)")
#: Rounds of the choice of mains that the SQL has room for.
_ROUNDS = 10


def _near_sql(rank: str) -> str:
    """Classes by the choice in order of keys: round by round a text none of whose smaller neighbours is open or a main becomes one."""
    rounds = "".join(
        f""", r{k + 1} AS (SELECT s.node, CASE WHEN any_value(s.main) IS NOT NULL THEN any_value(s.main) WHEN coalesce(max(n.main), 0) = 1 THEN 0
            WHEN count(e.dst) = count(n.main) THEN 1 END AS main
            FROM r{k} s LEFT JOIN both_ e ON e.src = s.node AND e.dst < e.src LEFT JOIN r{k} n ON n.node = e.dst GROUP BY s.node)"""
        for k in range(_ROUNDS)
    )
    return f"""WITH {_UNION}, both_ AS (SELECT src, dst FROM pairs UNION SELECT dst, src FROM pairs),
    r0 AS (SELECT DISTINCT src AS node, CAST(NULL AS INTEGER) AS main FROM both_){rounds},
    mains AS (SELECT s.node, CASE WHEN any_value(s.main) = 1 THEN s.node ELSE min(e.dst) FILTER (n.main = 1) END AS main
        FROM r{_ROUNDS} s LEFT JOIN both_ e ON e.src = s.node AND e.dst < e.src LEFT JOIN r{_ROUNDS} n ON n.node = e.dst GROUP BY s.node),
    ranked AS (SELECT main, node, row_number() OVER (PARTITION BY main ORDER BY {rank}, node <> main, node) AS k FROM mains JOIN texts ON texts.rep = mains.node),
    best AS (SELECT main, node AS class_id FROM ranked WHERE k = 1),
    links AS (SELECT src AS rep, count(*) AS links FROM both_ GROUP BY src),
    firsts AS (SELECT min(doc_id) AS rep, text FROM documents WHERE text IS NOT NULL GROUP BY text)
    SELECT d.doc_id, coalesce(class_id, f.rep) AS class_id, coalesce(links, 0) AS links FROM documents d JOIN firsts f USING (text)
        LEFT JOIN mains ON mains.node = f.rep LEFT JOIN best USING (main) LEFT JOIN links ON links.rep = f.rep"""


@query("similar_pairs", f"WITH {_UNION} SELECT * FROM pairs")
def similar_pairs(spark, d):
    return D.similar_pairs(table(spark, d, "documents"), "doc_id")


@query("similar_pairs_min", f"WITH {_LEAST} SELECT * FROM pairs")
def similar_pairs_min(spark, d):
    return D.similar_pairs(table(spark, d, "documents"), "doc_id", kind="min")


@query("text_classes", "SELECT min(doc_id) AS rep, count(*) AS copies FROM documents WHERE text IS NOT NULL GROUP BY text")
def text_classes(spark, d):
    return D.text_classes(table(spark, d, "documents"), "doc_id").select("rep", "copies")


@query("near_duplicates_first", _near_sql("0"))
def near_duplicates_first(spark, d):
    return D.near_duplicates(table(spark, d, "documents"), "doc_id")


@query("near_duplicates_longest", _near_sql("-length(text)"))
def near_duplicates_longest(spark, d):
    return D.near_duplicates(table(spark, d, "documents"), "doc_id", keep="longest")


@query(
    "merged_edges",
    """SELECT src, dst, max(jaccard) AS jaccard FROM (SELECT o_custkey AS src, o_orderkey % 1000 AS dst, o_orderkey % 7 / 7.0 AS jaccard FROM orders) GROUP BY src, dst""",
)
def merged_edges(spark, d):
    return D.merged(_edges(spark, d))


def _edges(spark, d):
    orders = table(spark, d, "orders")
    return orders.select(F.col("o_custkey").alias("src"), (F.col("o_orderkey") % 1000).alias("dst"), (F.col("o_orderkey") % 7 / F.lit(7.0)).alias("jaccard"))


@query(
    "symmetric_edges",
    """WITH e AS (SELECT o_custkey AS src, o_orderkey % 1000 AS dst, o_orderkey % 7 / 7.0 AS jaccard FROM orders)
    SELECT src, dst, max(jaccard) AS jaccard FROM (SELECT * FROM e UNION ALL SELECT dst, src, jaccard FROM e) GROUP BY src, dst""",
)
def symmetric_edges(spark, d):
    return D.symmetric(_edges(spark, d))


# --- scores


@query("filter_by_score", "SELECT box_id, score FROM boxes JOIN scores USING (package_id, pos) WHERE score < 430")
def filter_by_score(spark, d):
    return R.by_score(S.with_scores(boxes(spark, d), table(spark, d, "scores"), ["package_id", "pos"])).select("box_id", "score")


@query(
    "scored_packages",
    """SELECT package_id, string_agg(content, '|' ORDER BY pos, content, score) AS texts, count(*) AS n
    FROM boxes JOIN scores USING (package_id, pos) WHERE score < 430 AND content IS NOT NULL GROUP BY package_id""",
)
def scored_packages(spark, d):
    docs = S.with_scores(boxes(spark, d).where("content IS NOT NULL"), table(spark, d, "scores"), ["package_id", "pos"]).withColumnRenamed("content", "text")
    found = S.scored_packages(docs, "package_id")
    return found.select("package_id", F.array_join("content", "|").alias("texts"), F.size("content").cast("bigint").alias("n"))


@query("unscored", "SELECT count(*) AS packages, CAST(sum(gap) AS BIGINT) AS incomplete FROM (SELECT package_id, max(CASE WHEN score IS NULL THEN 1 ELSE 0 END) AS gap FROM scores GROUP BY package_id)")
def unscored(spark, d):
    return S.incomplete(table(spark, d, "scores"), "package_id")


@query(
    "choice_scores",
    f"""SELECT box_id, round(score / pow(10, ln({WORDS('content')})), 6) AS choice FROM boxes JOIN scores USING (package_id, pos)
    WHERE {WORDS('content')} > 0 AND score IS NOT NULL""",
)
def choice_scores(spark, d):
    docs = S.with_scores(boxes(spark, d), table(spark, d, "scores"), ["package_id", "pos"]).where("score IS NOT NULL")
    docs = docs.withColumn("words", T.token_count(F.col("content"))).where("words > 0")
    return docs.select("box_id", F.round(S.choice_score(F.col("score"), F.col("words")), 6).alias("choice"))


_UNIGRAM = f"""WITH words AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), {q(TOKEN)})) AS w FROM documents),
    counts AS (SELECT w, count(*) AS c FROM words GROUP BY w), total AS (SELECT sum(c) AS total, count(*) AS types FROM counts)
    SELECT doc_id, count(*) AS words, round(pow(10.0, -sum(log10((c + 1.0) / (total + types))) / count(*)), 4) AS perplexity
    FROM words JOIN counts USING (w), total GROUP BY doc_id"""


@query("perplexity_unigram", _UNIGRAM)
def perplexity_unigram(spark, d):
    return S.unigram_scores(table(spark, d, "documents"), "doc_id")


@query(
    "perplexity_bigram",
    f"""WITH chain AS (SELECT doc_id, list_concat(['<s>'], regexp_extract_all(lower(text), {q(TOKEN)})) AS c FROM documents WHERE text IS NOT NULL),
    pairs AS (SELECT doc_id, unnest(c[1:len(c) - 1]) AS a, unnest(c[2:]) AS b FROM chain WHERE len(c) > 1),
    ab AS (SELECT a, b, count(*) AS n FROM pairs GROUP BY a, b), firsts AS (SELECT a, sum(n) AS t FROM ab GROUP BY a),
    types AS (SELECT count(DISTINCT b) AS v FROM ab)
    SELECT doc_id, count(*) AS words, round(pow(10.0, -sum(log10((n + 0.1) / (t + 0.1 * v))) / count(*)), 4) AS perplexity
    FROM pairs JOIN ab USING (a, b) JOIN firsts USING (a), types GROUP BY doc_id""",
)
def perplexity_bigram(spark, d):
    return S.bigram_scores(table(spark, d, "documents"), "doc_id")


@query(
    "sentence_scores",
    f"""WITH {_sentences_sql()}, chain AS (SELECT doc_id, list_concat(['<s>'], regexp_extract_all(lower(s), {q(TOKEN)})) AS c FROM parts WHERE s <> ''),
    pairs AS (SELECT doc_id, unnest(c[1:len(c) - 1]) AS a, unnest(c[2:]) AS b FROM chain WHERE len(c) > 1),
    ab AS (SELECT a, b, count(*) AS n FROM pairs GROUP BY a, b), firsts AS (SELECT a, sum(n) AS t FROM ab GROUP BY a), types AS (SELECT count(DISTINCT b) AS v FROM ab),
    scored AS (SELECT doc_id, round(pow(10.0, -sum(log10((n + 0.1) / (t + 0.1 * v))) / count(*)), 1) AS score FROM pairs JOIN ab USING (a, b) JOIN firsts USING (a), types GROUP BY doc_id)
    SELECT doc_id, coalesce(score, -1) AS score FROM documents LEFT JOIN scored USING (doc_id)""",
)
def sentence_scores(spark, d):
    return S.sentence_scores(table(spark, d, "documents"), "doc_id")


@query(
    "cut_by_perplexity",
    f"""WITH chain AS (SELECT doc_id, pos, text, list_concat(['<s>'], regexp_extract_all(lower(text), {q(TOKEN)})) AS c FROM ({PARAGRAPHS})),
    pairs AS (SELECT doc_id, pos, unnest(c[1:len(c) - 1]) AS a, unnest(c[2:]) AS b FROM chain WHERE len(c) > 1),
    ab AS (SELECT a, b, count(*) AS n FROM pairs GROUP BY a, b), firsts AS (SELECT a, sum(n) AS t FROM ab GROUP BY a), types AS (SELECT count(DISTINCT b) AS v FROM ab),
    scored AS (SELECT doc_id, pos, pow(10.0, -sum(log10((n + 0.1) / (t + 0.1 * v))) / count(*)) AS score FROM pairs JOIN ab USING (a, b) JOIN firsts USING (a), types GROUP BY doc_id, pos)
    SELECT doc_id, string_agg(text, '|' ORDER BY pos) AS texts, count(*) AS n FROM scored JOIN chain USING (doc_id, pos) WHERE score < 430 GROUP BY doc_id""",
)
def cut_by_perplexity(spark, d):
    packages_ = table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", F.split("text", "\n", -1).alias("content"))
    found = S.cut_by_perplexity(packages_, "doc_id")
    return found.select("doc_id", F.array_join("content", "|").alias("texts"), F.size("content").cast("bigint").alias("n"))


# --- sources


def _crawl(spark, d, style):
    return table(spark, d, "crawl").where(F.col("style") == style)


def _flat(df: DataFrame) -> DataFrame:
    return df.select("meta.package_id", "meta.title", "meta.created", "meta.year", F.size("content").alias("lines"), F.array_join("content", "|").alias("content"))


def _crawl_sql(style: str, uid: str, time: str) -> str:
    return f"""SELECT CASE WHEN url <> 'failed' AND {time} = 'failed' THEN {uid} || '_' || url ELSE {uid} END AS package_id, url AS title, {time} AS created,
        CASE WHEN {time} = 'failed' THEN -1 ELSE coalesce(TRY_CAST(string_split({time}, '-')[1] AS INTEGER), -1) END AS year,
        CAST(len(string_split(content, chr(10))) AS INTEGER) AS lines, array_to_string(string_split(content, chr(10)), '|') AS content
        FROM crawl WHERE style = '{style}' AND content IS NOT NULL AND url IS NOT NULL AND {time} IS NOT NULL"""


@query("corpus_mc4", _crawl_sql("mc4", "('mc4_' || url || '-' || created)", "created"))
def corpus_mc4(spark, d):
    rows = _crawl(spark, d, "mc4").where("content IS NOT NULL AND url IS NOT NULL AND created IS NOT NULL")
    return _flat(readers.mc4_records(rows.select(F.col("content").alias("text"), F.col("created").alias("timestamp"), "url")))


@query("corpus_oscar", _crawl_sql("oscar", "('oscar_' || url || '-' || created)", "created"))
def corpus_oscar(spark, d):
    rows = _crawl(spark, d, "oscar").where("content IS NOT NULL AND url IS NOT NULL AND created IS NOT NULL")
    headers = F.struct(F.col("created").alias("warc-date"), F.col("url").alias("warc-target-uri"))
    return _flat(readers.oscar_records(rows.select("content", headers.alias("warc_headers"))))


@query("corpus_wiki", _crawl_sql("wiki", "('wiki_' || title || '-' || url)", "'failed'").replace("AND url IS NOT NULL", "AND url IS NOT NULL AND title IS NOT NULL"))
def corpus_wiki(spark, d):
    rows = _crawl(spark, d, "wiki").where("content IS NOT NULL AND url IS NOT NULL AND title IS NOT NULL")
    return _flat(readers.wiki_records(rows.select(F.col("content").alias("text"), "title", "url")))


@query(
    "corpus_martin",
    f"""WITH t AS (SELECT *, list_filter(list_transform(string_split(content, chr(10)), lambda s: trim(s, ' ')), lambda s: s <> '') AS body FROM crawl WHERE style = 'martin' AND content IS NOT NULL)
    SELECT 'KB_/data/' || crawl_id || CASE WHEN url = 'failed' THEN '' ELSE '_' || url END AS package_id, url AS title, 'failed' AS created, -1 AS year,
        CAST(len(body) AS INTEGER) AS lines, array_to_string(body, '|') AS content FROM t WHERE len(body) > 0 AND url IS NOT NULL""",
)
def corpus_martin(spark, d):
    rows = _crawl(spark, d, "martin").where("content IS NOT NULL AND url IS NOT NULL")
    url = F.when(F.col("url") == "failed", "").otherwise(F.concat(F.lit(" "), "url"))
    value = F.concat(F.lit("## START ## /data/"), F.col("crawl_id").cast("string"), url, F.lit("\n"), "content")
    return _flat(readers.martin_records(rows.select(value.alias("value"))))


@query("package_json", f"SELECT rec_id, CAST(pos AS INTEGER) AS pos, text FROM ({ELEMENTS})")
def package_json(spark, d):
    """Packages written as JSON and parsed back."""
    rows = packages(spark, d).select(F.to_json(F.struct(F.col("meta").withField("title", F.col("rec_id").cast("string")).alias("meta"), "content"), {"ignoreNullFields": "false"}).alias("value"))
    parsed = readers.parse_packages(rows, "value")
    return parsed.select(F.col("meta.title").cast("bigint").alias("rec_id"), F.posexplode("content").alias("pos", "text"))


# --- tokenizer preparation

_MARKS = r"\p{P}$+<=>^`|~"


@query(
    "pretoken_counts",
    rf"""WITH t AS (SELECT unnest(regexp_extract_all(text, {q(TOKEN)})) AS w FROM documents),
    digits AS (SELECT unnest(regexp_extract_all(w, '\P{{Nd}}*\p{{Nd}}|\P{{Nd}}+')) AS w FROM t),
    parts AS (SELECT unnest(regexp_extract_all(w, {q(f"[{_MARKS}]|[^{_MARKS}]+")})) AS w FROM digits)
    SELECT w AS pretoken, count(*) AS n FROM parts GROUP BY w""",
)
def pretoken_counts(spark, d):
    words = table(spark, d, "documents").select(F.explode(T.pretokens(F.col("text"))).alias("pretoken"))
    return words.groupBy("pretoken").agg(F.count("*").alias("n"))


# --- pipelines


def _documents_as_packages(spark, d):
    docs = table(spark, d, "documents")
    content = F.coalesce(F.split("text", "\n\n+"), F.array().cast("array<string>")).alias("content")
    return docs.select("doc_id", "lang", content), R.label_provider(F.col("lang"))


def _pipeline(name: str):
    def run(spark, d):
        packages_, provider = _documents_as_packages(spark, d)
        errors = dictionary(spark, d) if name == "ocr" else None
        return run_pipeline(packages_, name, "doc_id", provider, errors=errors, least_tokens=15).select("doc_id", "content")

    return run


for _name in ("ocr", "plain", "fuse", "split", "audit"):
    query(f"pipeline_{_name}")(_pipeline(_name))
