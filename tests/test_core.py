import itertools
import json
import math
import random
import re
import unicodedata
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.functions import patterns
from corpusloom.functions import text as T
from corpusloom.operators import content as C
from corpusloom.operators import dedup as D
from corpusloom.operators import filters as R
from corpusloom.operators import grams as M
from corpusloom.operators import normalizers as N
from corpusloom.operators import scoring as S
from corpusloom.operators import stats as A
from corpusloom.plans.pipelines import PIPELINES, run_pipeline
from corpusloom.sources import archive, readers, sinks

ODD = ["", " ", "a", "\x1c", "a\x1cb c\x85d\xa0e", "x y", "Aa bb. Cc", "no end", "End. ", "é́", "𝕬𝕭 😀", "a\r\nb", "\n\n", None]


def column(spark, values, expr):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, t string").select("i", expr(F.col("t")).alias("x")).collect()
    return [r["x"] for r in sorted(rows, key=lambda r: r["i"])]


def test_token_count(spark):
    values = [*ODD, " ".join("w" * 29), " ".join("w" * 30)]
    assert column(spark, values, T.token_count) == [None if v is None else len(v.split()) for v in values]


def test_unreadable_blocks(spark):
    values = ["abc", "Ωmega", "Привет", "漢字", "ɐ", "á", "☀️", "﻿", "�", "ɏ", "ỿ", "\U0001f600", "\U0001fb00"]
    got = column(spark, values, lambda t: R.readable().keep(t))
    allowed = [tuple(int(x, 16) for x in b.split("-")) for b in patterns.READABLE_BLOCKS]
    assert got == [all(any(a <= ord(c) <= b for a, b in allowed) for c in v) for v in values]


def test_tv_tables(spark):
    values = ["19.00 20:15 21.30", "19.00 20:15 21.30 1:05", "9:99", "", None]
    assert column(spark, values, lambda t: R.tv_tables().keep(t)) == [True, False, True, True, None]


#: What each text becomes in a single pass.
ANON = {
    "8001011234@mail.com": "XXXXXXXXXXNICK.com",
    "800101-1234 och 19800101 - 1234.": "XXXXXX-XXXX och XXXXXX - XXXX.",
    "@nick @ nick a@b.c": "NICK NICK MEJLADRESS",
    "å.ö@b.se.": "MEJLADRESS.",
    "a . b @ c . se x": "MEJLADRESS x",
    "800001-1234 801301-1234 801231-1234 801031 1234": "800001-1234 801301-1234 XXXXXX-XXXX 801031 1234",
    "198013011234 198012011234": "1XXXXXXXXXX4 XXXXXXXXXX",
    "a@b": "aNICK",
    "a.b.c@d.e.f": "MEJLADRESS",
    "@ ! @": "@ ! @",
    "12": "12",
    "": "",
}


def test_anonymize(spark):
    assert column(spark, list(ANON), T.anonymize) == list(ANON.values())
    long = ["x" * 40_000 + " 123456 a@b.se", "a.b." * 9_000 + "c@d.e"]
    assert column(spark, long, T.anonymize) == [v[: v.rfind(" ") + 1] + "MEJLADRESS" for v in long]
    assert column(spark, [None], T.anonymize) == [None]
    assert column(spark, ["8001011234@mail.com", "@ @a"], T.anonymize_sequential) == ["MEJLADRESS", "NICK"]


def strip_model(doc):
    a = re.search(r"[A-ZÖÄÅØÆ]\w+", doc)
    ends = [m.start() for m in re.finditer(r"[.!?\"'](?=\s)", doc)]
    return doc[a.start() if a else 0 : ends[-1] + 1 if ends else -1]


@settings(max_examples=15, deadline=None)
@given(texts=st.lists(st.text(alphabet="aBÅ.!?\"' \n", max_size=25), min_size=1, max_size=12))
def test_strip_incomplete(spark, texts):
    assert column(spark, texts, T.strip_incomplete) == [strip_model(t) for t in texts]


def test_replace_words(spark):
    words = {"örn": "om", "örnar": "ornar", "a.b": "c"}
    got = column(spark, ["örn är örnets örn", "örn örn örn", "örnar.", "xörn", "a.b axb", "", None], lambda t: T.replace_words(t, words))
    assert got == ["om är örnets om", "om örn om", "ornar.", "xörn", "c axb", "", None]
    any_case = column(spark, ["ÖRN är Örnets örn", "A.B", "örnAR!"], lambda t: T.replace_words(t, words, ignore_case=True))
    assert any_case == ["om är Örnets om", "c", "ornar!"]
    assert column(spark, ["ÖRN"], lambda t: T.replace_words(t, {"örn": "x", "ÖRN": "y"}, ignore_case=True)) == ["y"]


def test_python_normalizers(spark):
    values = ["ﬁ ½ ＡＢ", "åäö É ß “x” – ø", "plain", "", None]
    assert column(spark, values, T.nfkc) == [None if v is None else unicodedata.normalize("NFKC", v) for v in values]
    folded = column(spark, values, T.ascii_fold)
    assert folded[1].startswith("åäö E") and folded[2:] == ["plain", "", None]


def test_ascii_fold_of_whole_strings(spark):
    values = ["åäö É ß “x” – ø", "1914–1918, kl. 9–18", "‘a’ «b» 5 € … § 4", "þorn Łódź ðæ", "a\u200bb\xadc", "e\u0301 ½"]
    want = ["åäö E ss \"x\" - ø", "1914-1918, kl. 9-18", "'a' \"b\" 5 EUR ... SS 4", "thorn Lodz dæ", "abc", "e 1/2"]
    assert column(spark, values, T.ascii_fold) == want


#: Sentences of a text.
SENTENCES = {
    'Ett. Två! "Tre?" 4 st. slut': ["Ett.", "Två!", '"Tre?" 4 st. slut'],
    "Han kom kl. 9 med A. B. Ek från AB. Sedan gick han m.m. Hej": ["Han kom kl. 9 med A. B. Ek från AB. Sedan gick han m.m.", "Hej"],
    "Ja... Nej (kl. 10). Jo. Han gick. 5 st kom. U.S.A. Är": ["Ja...", "Nej (kl. 10).", "Jo.", "Han gick.", "5 st kom.", "U.S.A. Är"],
    "Vad? (Ja.) [Nej.] slut etc. Hej": ["Vad?", "(Ja.)", "[Nej.] slut etc. Hej"],
    "en  rad\nTvå.\x85Tre": ["en rad", "Två.", "Tre"],
    "utan slut": ["utan slut"],
    "  ": [],
    "": [],
}


def test_sentences(spark):
    assert column(spark, list(SENTENCES), T.sentences) == list(SENTENCES.values())
    whole = column(spark, ["låg. Ett. Två! rest", "inget", "A."], lambda t: T.strip_incomplete_sentences(T.sentences(t)))
    assert whole == [["Ett."], [], ["A."]]


def test_plain_punctuation(spark):
    rows = {
        "“a” ‘b’ ”c” «d» \u00a0»e": "\"a\" 'b' \"c\" \"d\" \"e",
        "1 % ( x ) . y": "1% (x). y",
        "– — …": "- - ...",
        "5\u00a0000 kr\u00a0: ja\u00a0?": "5.000 kr: ja?",
        " a\r\n b ": "a\n b",
        "''x''": '" x "',
    }
    assert column(spark, list(rows), T.plain_punctuation) == list(rows.values())


def test_tokenizer_text(spark):
    values = ["a\x01b\tc\u200b\u200bd ﬁ", "\ufeffx\x0by", None, ""]
    assert column(spark, values, T.tokenizer_text) == ["ab c d fi", " xy", None, ""]


def test_shingles(spark):
    values = ["", "abcde", "abcdef", "abcdefg", "aaaaaaaaa", "😀bcdefg", None]
    got = column(spark, values, T.shingles)
    assert got[:5] == [[], [], ["abcde"], ["abcde", "bcdef"], ["aaaaa"]]
    assert got[5] == ["😀bcde", "bcdef"] and got[6] == []


def test_pretokens(spark):
    assert column(spark, ["ab12c, d-e x$"], T.pretokens) == [["ab1", "2", "c", ",", "d", "-", "e", "x", "$"]]


def fold_model(items, remove=False):
    out = []
    for text, keep in items:
        if text is None:
            out += [] if remove else [None]
        elif keep:
            out.append(text)
        elif out and out[-1] is not None and not remove:
            out.append(None)
    return out


def test_breaks_and_fuse(spark):
    rng = random.Random(1)
    cases = [[(rng.choice([None, "a", "b"]), rng.random() < 0.5) for _ in range(rng.randint(0, 7))] for _ in range(300)]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, e array<struct<text: string, keep: boolean>>")
    rows = df.select("i", C.break_fold(F.col("e")).alias("x"), C.break_fold(F.col("e"), True).alias("y")).collect()
    for r in rows:
        assert r["x"] == fold_model(cases[r["i"]]) and r["y"] == fold_model(cases[r["i"]], True)
    contents = [[], [None], ["a"], ["a", "b", None, None, "c"], [None, "a", None], None]
    packs = spark.createDataFrame(list(enumerate(contents)), "i int, content array<string>")
    fused = {r["i"]: r["content"] for r in C.fuse_paragraphs(packs).collect()}
    assert fused == {1: [], 2: ["a"], 3: ["a b", "c"], 4: ["a"]}
    whole = {r["i"]: r["content"] for r in C.fuse_paragraphs(packs, ignore_breaks=True).collect()}
    assert whole == {1: [""], 2: ["a"], 3: ["a b c"], 4: ["a"]}


def test_regroup_and_keys(spark):
    packs = spark.createDataFrame([("p_1", ["x", None, "y"]), ("q", [])], "id string, content array<string>")
    docs = C.explode_content(packs, "id")
    assert sorted((r["id"], r["pos"]) for r in docs.collect()) == [("p_1", 0), ("p_1", 1), ("p_1", 2)]
    kept = docs.where("text = 'y'")
    assert {r["id"]: r["content"] for r in C.regroup(packs, kept, "id").collect()} == {"p_1": ["y"], "q": []}
    keys = docs.select(C.document_key(F.col("id"), F.col("pos")).alias("k"))
    assert {(r[0], r[1]) for r in keys.select(C.key_package(F.col("k")), C.key_position(F.col("k"))).collect()} == {("p_1", 0), ("p_1", 1), ("p_1", 2)}


def test_filters_keep_or_remove_everything(spark):
    rows = [(1, "b a"), (2, "b a"), (3, None), (4, None), (5, "c"), (6, "b  a")]
    df = spark.createDataFrame(rows, "i int, text string")
    assert sorted(r["i"] for r in R.exact_duplicates(df, "text", ["i"]).collect()) == [1, 3, 4, 5, 6]
    marked = R.apply_filters(df, [R.num_tokens(2)], order=["i"], duplicates="exact").collect()
    assert {r["i"]: r["filter_name"] for r in marked} == {1: None, 2: "exact_duplicate", 3: None, 4: None, 5: "num_tokens", 6: None}
    sized = R.apply_filters(df, [], order=["i"], duplicates="exact_min_size", least_tokens=2).collect()
    assert {r["i"] for r in sized if r["filter_name"] == "exact_duplicate_min_size"} == {2, 5}
    empty = df.where("false")
    assert R.apply_filters(empty, [R.num_tokens(2)], order=["i"], duplicates="exact").count() == 0


def test_language_filter(spark):
    words = {"sv": ["och", "att"], "en": ["and", "to"]}
    spec = R.language(R.word_provider(words))
    assert column(spark, ["och att x", "och and", "x", "and to", ""], lambda t: spec.keep(t)) == [True, False, False, False, False]


def test_filters_run_in_their_fixed_order(spark):
    df = spark.createDataFrame([(1, "漢字")], "i int, text string")
    marked = R.apply_filters(df, [R.readable(), R.num_tokens(2)], order=["i"]).first()
    assert marked["filter_name"] == "num_tokens"


def test_gram_provider(spark):
    sv, en = "det är en båt och den ligger vid kajen", "there is a boat and it lies at the quay"
    docs = spark.createDataFrame([(sv, "sv"), (en, "en"), (None, "sv"), ("", "en"), ("x", "other")], "text string, lang string")
    model = M.learn(docs, "text", "lang", ["en", "sv"])
    spec = R.language(M.gram_provider(model), margin=0.9)
    assert column(spark, [sv, en, "båten ligger", "a boat lies", "123", "", None], lambda t: spec.keep(t)) == [True, False, True, False, False, False, False]
    grams = lambda t: [((ord(a) * 31 + ord(b)) % M.BUCKETS * 31 + ord(c)) % M.BUCKETS for a, b, c in zip(t, t[1:], t[2:])]
    assert column(spark, ["Åh, nej!", "a"], M.trigrams) == [grams(" åh nej "), grams(" a ")]
    logs = {name: sum(model[name][g] for g in grams(" båt boat ")) for name in model}
    probs = column(spark, ["båt boat"], M.gram_provider(model))[0]
    assert {p["label"]: p["prob"] for p in probs} == pytest.approx({a: 1 / sum(math.exp(logs[b] - logs[a]) for b in logs) for a in logs})


def test_filter_lines_swedish(spark, tmp_path):
    from corpusloom.plans.core_queries import filter_lines_swedish

    lines = ["det är och att", "det är and to", "and to", "det är och att漢", "xyz", ""]
    spark.createDataFrame([(1, "\n".join(lines)), (2, None)], "crawl_id long, content string").write.parquet(str(tmp_path / "crawl.parquet"))
    words = [(k, i, w) for k, ws in (("sv", "det är och att"), ("en", "and to")) for i, w in enumerate(ws.split())]
    spark.createDataFrame(words, "lang string, word_rank int, word string").write.parquet(str(tmp_path / "common_words.parquet"))
    assert [tuple(r) for r in filter_lines_swedish(spark, str(tmp_path)).collect()] == [(1, "det är och att")]


def test_normalizer_driver(spark):
    packs = spark.createDataFrame([(1, ["ﬁ x@y.se", None, "Två. "]), (2, [])], "i int, content array<string>")
    got = {r["i"]: r["content"] for r in N.apply_normalizers(packs, ["anonymize", "unicode"], "i").collect()}
    assert got == {1: ["fi MEJLADRESS", None, "Två. "], 2: []}
    odd = ["a\x1db", "\x1a", "", None, "ﬁ\x1e"]
    packs = spark.createDataFrame([(1, odd), (2, None), (3, []), (4, [None]), (5, ["½"])], "i int, content array<string>")
    for name in ("unicode", "unidecode"):
        got = {r["i"]: r["content"] for r in N.apply_normalizers(packs.repartition(1), [name], "i").collect()}
        assert got == {1: ["a\x1db", "\x1a", "", None, "fi\x1e"], 2: None, 3: [], 4: [None], 5: ["1⁄2" if name == "unicode" else "1/2"]}
    with pytest.raises(ValueError):
        N.apply_normalizers(packs, ["strip_sentence"], "i")
    split = N.apply_normalizers(packs, ["sentence_split", "strip_sentence"], "i").collect()
    assert {r["i"]: r["content"] for r in split}[1][2] == []


def greedy(n, edges):
    near = {i: {} for i in range(n)}
    for a, b in edges:
        near[a][b] = near[b][a] = 1
    seen, main = set(), {}
    for i in range(n):
        if i in seen or not near[i]:
            continue
        for j in [i, *near[i]]:
            if j not in seen:
                seen.add(j)
                main[j] = i
    return main


def test_mains_equal_the_walk_in_order(spark):
    rng = random.Random(2)
    for _ in range(3):
        n = 30
        edges = sorted({tuple(sorted(rng.sample(range(n), 2))) for _ in range(35)})
        df = spark.createDataFrame([(a, b, 0.9) for a, b in edges], "src int, dst int, jaccard double")
        assert {r["node"]: r["main"] for r in D.mains(df).collect()} == greedy(n, edges)


def test_similar_pairs_against_brute_force(spark):
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(200)) for _ in range(12)]
    texts = base + [b[:190] + "zzzzzzzzzz" for b in base] + [base[0], None, "", "kort"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = {(r["src"], r["dst"]): r["jaccard"] for r in D.similar_pairs(df, "i").collect()}
    grams = [{t[k : k + 5] for k in range(len(t) - 5)} if t else set() for t in texts]
    for (a, b), s in got.items():
        assert s == pytest.approx(len(grams[a] & grams[b]) / len(grams[a] | grams[b])) and s > 0.5
    assert {(i, i + 12) for i in range(12)} <= set(got)
    rows = {r["i"]: (r["class_id"], r["links"]) for r in D.near_duplicates(df, "i").collect()}
    assert rows[24] == (0, 1) and rows[12] == (0, 1) and rows[27] == (27, 0) and 25 not in rows
    assert {r["i"] for r in D.choose(df.where("text IS NOT NULL"), D.similar_pairs(df, "i"), "i", keep="longest").collect()} >= {0, 26, 27}
    assert D.similar_pairs(df.where("false"), "i").count() == 0


def pairs_model(texts, kind, above=0.5):
    grams = [{t[k : k + 5] for k in range(len(t) - 5)} if t else set() for t in texts]
    first = {t: i for i, t in reversed(list(enumerate(texts)))}
    reps = [i for i, t in enumerate(texts) if grams[i] and first[t] == i]
    whole = {"union": lambda a, b: len(a | b), "min": lambda a, b: min(len(a), len(b)), "max": lambda a, b: max(len(a), len(b))}[kind]
    found = {(a, b): len(grams[a] & grams[b]) / whole(grams[a], grams[b]) for a in reps for b in reps if a < b}
    return {pair: s for pair, s in found.items() if s > above}


def graded_texts():
    """Texts that share from a third to all of their characters, some contained in longer ones, short ones and copies."""
    rng = random.Random(4)
    draw = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    base = [draw(rng.choice([60, 200, 200, 900])) for _ in range(12)]
    texts = base + [t[: len(t) * k // 12] + draw(len(t) - len(t) * k // 12) for t in base for k in range(4, 12)]
    return texts + [t[a : a + n] for t in base for a, n in ((3, 12), (10, 40))] + ["abcdef", "abcdefg", base[0], None, "", "kort"]


@pytest.mark.parametrize("kind, block", [("union", 4_000_000), ("union", 3000), ("max", 3000), ("min", 4_000_000), ("min", 3000)])
def test_similar_pairs_are_all_found(spark, monkeypatch, kind, block):
    monkeypatch.setattr(D, "BLOCK", block)
    texts = graded_texts()
    got = D.similar_pairs(spark.createDataFrame(list(enumerate(texts)), "i int, text string"), "i", kind=kind).collect()
    want = pairs_model(texts, kind)
    assert len(got) == len(want) and {(r["src"], r["dst"]): r["jaccard"] for r in got} == pytest.approx(want)
    assert sum(s < 0.7 for s in want.values()) > 20


@pytest.mark.parametrize("kind", ["union", "max", "min"])
def test_bounds_keep_all_similar_pairs_and_few_others(kind):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 9))) for _ in range(150)]
    base = [" ".join(rng.choice(words) for _ in range(rng.randint(40, 60))) for _ in range(150)]
    texts = base + [t[: len(t) * 3 // 4] + " " + u[: len(u) // 3] for t, u in zip(base[:40], base[40:])]
    want = pairs_model(texts, kind)
    names = ["rep", "text", "block", "most"]
    most = max(map(len, texts))
    rows = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array([zlib.compress(t.encode()) for t in texts]), pa.array([0] * len(texts)), pa.array([most] * len(texts))], names=names)
    side = D._Side([p for b in D._packed([rows], D._Axes(texts[:100])) for p in b.column("texts").to_pylist()])
    keys = side.keys.to_pylist()
    likely = {tuple(sorted((keys[x], keys[y]))) for i, j in D._likely(side, side, True, 0.5, kind) for x, y in zip(i, j)}
    assert set(want) <= likely and len(want) >= 40
    assert kind == "min" or len(likely) < len(texts) ** 2 / 20


def test_jaccard_kinds(spark):
    df = spark.createDataFrame([(["a", "b", "c"], ["b", "c", "d", "e"], [])], "a array<string>, b array<string>, e array<string>")
    r = df.select(*(D.jaccard(F.col("a"), F.col("b"), k) for k in ("union", "min", "max")), D.jaccard(F.col("a"), F.col("e"))).first()
    assert tuple(r) == (pytest.approx(2 / 5), pytest.approx(2 / 3), 0.5, 0.0)


def test_scores(spark):
    df = spark.createDataFrame([(-4.0, 2, 3), (0.0, 0, 0)], "lp double, n int, words int")
    a, b = df.select(S.perplexity(F.col("lp"), F.col("n")), S.choice_score(F.lit(10.0), F.col("words"))).collect()
    assert a[0] == pytest.approx(100.0) and a[1] == pytest.approx(10 / 10 ** math.log(3)) and tuple(b) == (None, None)


def test_scores_of_a_given_model(spark):
    letters_model = lambda: ((lambda text: list(text)), (lambda tokens: -2.0 * len(tokens)))
    df = spark.createDataFrame([(1, "abc"), (2, ""), (3, None), (4, "Ab. Cd"), (5, " ")], "i int, text string")
    assert {r["i"]: r["score"] for r in S.model_scores(df, "i", letters_model).collect()} == {1: 100.0, 2: -math.inf, 3: -math.inf, 4: 100.0, 5: 100.0}
    assert {r["i"]: r["score"] for r in S.model_scores(df, "i", letters_model, by_sentence=True).collect()} == {1: 100.0, 2: -1.0, 3: -1.0, 4: 100.0, 5: -1.0}
    assert {r["i"] for r in S.sentence_scores(df, "i").where("score = -1").collect()} == {2, 3, 5}
    packs = spark.createDataFrame([("p", ["a b", None, "c"]), ("q", [])], "k string, content array<string>")
    found = S.cut_by_perplexity(packs, "k").collect()
    assert [(r["k"], r["content"]) for r in found] == [("p", ["a b", "c"])] and len(found[0]["scores"]) == 2


def test_stats(spark):
    docs = spark.createDataFrame([(2000, "t", "a b"), (2000, "t", "c d"), (-1, None, "x"), (2001, "u", " ")], "year int, title string, text string")
    worded = A.documents_with_words(docs)
    rows = {r["year"]: (r["docs"], r["words"], r["avg_doc_len"], r["mean_doc_len"]) for r in A.by_year(worded).collect()}
    assert rows == {2000: (2, 4, 2.0, 2.0), -1: (1, 1, 1.0, 1.0)}
    bins = {r["bin"]: r["n"] for r in A.power_bins(A.length_histogram(worded)).collect()}
    assert bins == {2: 1, 4: 2}
    parsed = {r["year"]: json.loads(r["stats"]) for r in A.as_json(worded).collect()}
    assert parsed[2000] == {"#docs": 2, "#words": 4, "doc lengths": {"2": 2}, "titles": {"t": 2}} and parsed[-1]["titles"] == {"": 1}
    table = {r["year"]: r["docs"] for r in A.year_table(worded).collect()}
    assert table == {"2000": 2, "-1": 1, "all": 3}


def test_readers(spark, tmp_path):
    f = tmp_path / "a.jsonl"
    f.write_text('{"meta":{"package_id":"p1","year":1995},"content":["first",null,["two","parts"],"[x"]}\nbroken\n\n')
    rows = readers.read_packages(spark, str(f)).collect()
    assert len(rows) == 1 and rows[0]["content"] == ["first", None, "two parts", "[x"] and rows[0]["meta"]["year"] == 1995
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "b.jsonl").write_text(f.read_text())
    assert readers.read_packages(spark, str(tmp_path), suffix=".jsonl").count() == 2
    g = tmp_path / "glued.txt"
    g.write_text('{"a":{"b":0.9}}{"c":{"d":0.8}}\n\n{"e":{"f":0.7,"g":0.6},"h":{"i":1.0}}\n{}\nxx\n')
    assert {(r["src"], r["dst"]) for r in readers.read_candidates(spark, str(g)).collect()} == {("a", "b"), ("c", "d"), ("e", "f"), ("e", "g")}
    s = tmp_path / "scores.json"
    s.write_text('{"p": [1.5, null], "q": []}')
    assert {tuple(r) for r in readers.read_scores(spark, str(s)).collect()} == {("p", 0, 1.5), ("p", 1, None)}
    m = tmp_path / "crawl.txt"
    m.write_text("## START ## /data/a http://x.test/1\nrad ett\n\n  rad ## START ## två\n## START ## /data/b\n## START ## /data/c\nslut\n")
    got = {r["meta"]["package_id"]: (r["meta"]["title"], r["content"]) for r in readers.read_corpus(spark, str(m), "martin").collect()}
    assert got == {"KB_/data/a_http://x.test/1": ("http://x.test/1", ["rad ett", "rad ## START ## två"]), "KB_/data/c": ("failed", ["slut"])}
    o = tmp_path / "oscar.json"
    o.write_text('{"content":"a\\nb\\n","warc_headers":{"warc-date":"2019-03-01","warc-target-uri":"u"}}\n')
    r = readers.read_corpus(spark, str(o), "oscar").first()
    assert r["meta"]["package_id"] == "oscar_u-2019-03-01" and r["meta"]["year"] == 2019 and r["content"] == ["a", "b", ""]
    with pytest.raises(ValueError):
        readers.read_corpus(spark, str(o), "other")


def test_sinks_round_trip(spark, tmp_path):
    packs = spark.createDataFrame([(("p", "t", "c", 1990, "1", "2"), ["a", None])], f"meta {__import__('corpusloom.schema', fromlist=['META']).META}, content array<string>")
    sinks.write_packages(packs, str(tmp_path / "out"), by_year=True)
    assert (tmp_path / "out" / "year=1990").exists()
    back = readers.read_packages(spark, str(tmp_path / "out" / "year=1990")).first()
    assert back["content"] == ["a", None] and back["meta"]["package_id"] == "p"
    edges = spark.createDataFrame([("a", "b", 0.5), ("a", "c", 0.75)], "src string, dst string, jaccard double")
    assert json.loads(sinks.candidate_records(edges).first()[0]) == {"a": {"b": 0.5, "c": 0.75}}


def fake_archive(url, headers):
    assert headers["Authorization"].startswith("Basic ")
    if "/p2/" in url:
        raise OSError("gone")
    if url.endswith("meta.json"):
        return b'{"title": "T", "year": "x"}'
    return b'[{"content": "a"}, {"content": ["b", "c"]}, {"content": null}]'


def fake_search(wanted):
    return ["p1", "p2", "p3"] if wanted == {"tags": "issue"} else []


def fake_both(wanted):
    return ["p7"] if wanted == {"tags": "issue", "meta.genre": "news"} else []


class Flaky:
    """Ids with lost connections between them, and an empty one at the end."""

    def __init__(self, found):
        self.found = iter(found)

    def __iter__(self):
        return self

    def __next__(self):
        x = next(self.found)
        if isinstance(x, Exception):
            raise x
        return x


def test_draining_a_search():
    class ProtocolError(Exception):
        pass

    assert list(archive.drained(Flaky(["a", ProtocolError(), OSError(), "b", "", "c"]))) == ["a", "b"]
    assert list(archive.drained([])) == []
    with pytest.raises(ValueError):
        list(archive.drained(Flaky(["a", ValueError()])))
    with pytest.raises(OSError):
        list(archive.drained(Flaky([OSError()] * 100)))


def test_login_file(tmp_path):
    f = tmp_path / "login.yaml"
    f.write_text("# login\nurl: https://x.test/\nuser: 'me'  # who\npassword: \"a: b#c\"\n\n")
    assert archive.read_login(str(f)) == {"url": "https://x.test/", "user": "me", "password": "a: b#c"}
    assert archive.ArchiveReader({"login_file": str(f), "user": "you"}).options == {"url": "https://x.test/", "user": "you", "password": "a: b#c"}


def test_download_appends_by_year(spark, tmp_path):
    module = tmp_path / "stub_transport.py"
    module.write_text(
        "def get(url, headers):\n"
        "    if url.endswith('meta.json'):\n"
        "        return b'{\"title\": \"T\", \"year\": 1990}' if '/p1/' in url else b'{\"title\": \"U\"}'\n"
        "    return b'[{\"content\": \"a\"}]'\n"
    )
    spark.sparkContext.addPyFile(str(module))
    out = str(tmp_path / "out")
    for ids in ("p1", "p2,p3"):
        archive.download(spark, out, url="http://x/", ids=ids, transport="stub_transport:get", page="1")
    back = readers.read_packages(spark, out, suffix=".json").select("meta.package_id", "meta.year").collect()
    assert {tuple(r) for r in back} == {("p1", 1990), ("p2", -1), ("p3", -1)}
    assert (tmp_path / "out" / "year=1990").exists()


def test_text_batches(spark):
    lines = spark.createDataFrame([(str(i),) for i in range(7)], "value string").repartition(3)
    got = list(readers.text_batches(lines, 3))
    assert [len(b) for b in got] == [3, 3, 1] and sorted(x for b in got for x in b) == list("0123456")


def test_archive(monkeypatch):
    import sys

    sys.modules["fake_archive_module"] = sys.modules[__name__]
    options = {"url": "http://x/", "transport": "fake_archive_module:fake_archive", "search": "fake_archive_module:fake_search", "tags": "issue", "user": "u", "page": "2"}
    reader = archive.ArchiveReader(options)
    parts = reader.partitions()
    assert [p.ids for p in parts] == [["p1", "p2"], ["p3"]]
    rows = [r for p in parts for r in reader.read(p)]
    with_genre = archive.ArchiveReader(options | {"genre": "news", "search": "fake_archive_module:fake_both"})
    assert with_genre.ids() == ["p7"]
    assert [r[0][0] for r in rows] == ["p1", "p3"] and rows[0] == (("p1", "T", "no created", -1, "no edition", "no issue"), ["a", "b c", None])


def curated(packages, name, errors, least):
    """The steps of a pipeline by hand: ``{key: (lang, content)}`` to ``{key: content}``."""
    langs = {k: lang for k, (lang, _) in packages.items()}
    rows = {k: list(c or []) for k, (_, c) in packages.items()}

    def keeps(k, t, filters):
        times = len(re.findall(r"\d?\d[.:]\d\d", t))
        readable = all(ord(c) < 0x250 for c in t)
        ok = {"num_tokens": len(t.split()) >= least, "unicode": readable, "tv_tables": times <= 3, "language": langs[k] == "sv"}
        return all(ok[f] for f in filters)

    def normalized(t, names):
        if "unicode" in names:
            t = unicodedata.normalize("NFKC", t)
        if "moses" in names:
            t = t.replace("“", '"').replace("”", '"').replace("–", "-")
        if "anonymize" in names:
            t = t.replace("@kurt", "NICK").replace("800101-1234", "XXXXXX-XXXX")
        if "common_errors" in names:
            for bad, good in errors.items():
                t = re.sub(rf"(^|\W){bad}(\W|$)", rf"\1{good}\2", t)
        return strip_model(t) if "strip_string" in names else t

    def perplexities(docs):
        pairs = [list(zip(["<s>", *(ws := t.lower().split())], ws)) for t in docs]
        both, first = Counter(p for ps in pairs for p in ps), Counter(a for ps in pairs for a, _ in ps)
        types = len({b for _, b in both})
        p = lambda a, b: math.log10((both[a, b] + 0.1) / (first[a] + 0.1 * types))
        return [round(10 ** (-sum(p(*x) for x in ps) / len(ps)), 4) if ps else math.inf for ps in pairs]

    for step, *rest in PIPELINES[name]:
        if step in ("filter", "filter_no_breaks"):
            for k, c in rows.items():
                c = [None if t is None else t.replace("\n", " ") for t in c]
                rows[k] = fold_model([(t, t is not None and keeps(k, t, rest[0])) for t in c], step != "filter")
        elif step == "normalize":
            rows = {k: [None if t is None else normalized(t, rest[0]) for t in c] for k, c in rows.items()}
        elif step == "exact":
            seen = set()
            for k in sorted(rows):
                marked = []
                for t in rows[k]:
                    marked.append((t, t is not None and t not in seen))
                    seen.add(t)
                rows[k] = fold_model(marked)
        elif step == "fuse":
            groups = {k: [" ".join(g) for is_null, g in ((n, list(g)) for n, g in itertools.groupby(c, lambda t: t is None)) if not is_null] for k, c in rows.items() if c}
            rows = groups
        else:
            docs = sorted(((f"{k}_{i}", k, i, t) for k, c in rows.items() for i, t in enumerate(c) if t is not None))
            texts = [d[3] for d in docs]
            edges = [(a, b) for a, b in pairs_model(texts, "union")]
            main = greedy(len(docs), edges)
            score = perplexities(texts)
            stars = {}
            for d, m in main.items():
                stars.setdefault(m, []).append(d)
            gone = set()
            for m, star in stars.items():
                best = min(star, key=lambda d: (score[d], d != m, d)) if rest[0] == "score" else m
                gone |= set(star) - {best}
            rows = {k: [t for j, (_, key, _, t) in enumerate(docs) if key == k and j not in gone] for k in rows}
            for k in rows:
                kept = sorted((i, t) for j, (_, key, i, t) in enumerate(docs) if key == k and j not in gone)
                rows[k] = [t for _, t in kept]
    return rows


def curation_fixture():
    rng = random.Random(8)
    words = "byn kvarnen hamnen skolan vägen mötet tidningen festen staden båten fisket handeln ån bron".split()
    sentence = lambda n: " ".join(rng.choice(words) for _ in range(n)).capitalize() + ". "
    base = [sentence(9) + sentence(9) + "slut" for _ in range(14)]
    odd = ["“Hej – ﬁsket” " + base[0], base[1] + " @kurt 800101-1234 x", "örn " + base[2] + " örn", "漢字 " + base[3], "1.00 2.00 3.00 4.00 " + base[4], "kort", "", "rad\n" + base[5]]
    near = [b[:-12] + rng.choice(words) + " slut" for b in base[6:]]
    pool = base + odd + near + [None, None]
    langs = ["sv", "sv", "sv", "en", None]
    return {k: (langs[k % 5], [rng.choice(pool) for _ in range(rng.randint(0, 9))] if k else None) for k in range(30)}


@pytest.mark.parametrize("name", sorted(PIPELINES))
def test_pipelines_against_brute_force(spark, tmp_path, name):
    packages, errors = curation_fixture(), {"örn": "om"}
    df = spark.createDataFrame([(f"k{k:02}", *v) for k, v in packages.items()], "k string, lang string, content array<string>")
    got = run_pipeline(df, name, "k", R.label_provider(F.col("lang")), errors=errors, least_tokens=15, export=str(tmp_path / "text"))
    want = curated({f"k{k:02}": v for k, v in packages.items()}, name, errors, 15)
    assert {r["k"]: list(r["content"] or []) for r in got.collect()} == want
    lines = [x for f in sorted((tmp_path / "text").glob("*.txt")) for x in f.read_text().splitlines()]
    assert lines == [t for k in sorted(want) for t in want[k] if t]
    assert run_pipeline(df.where("false"), name, "k", R.label_provider(F.col("lang"))).count() == 0


def test_ocr_pipeline_keeps_the_copy_of_lowest_perplexity(spark):
    text = "Det var en gång en lång text som handlade om flera saker i byn och om folk som bodde där i många år innan de for till staden. "
    worse = text.replace("flera saker", "fl3ra s4ker").replace("många år", "mångn ör")
    rows = [(1, "sv", [worse + "Slut."]), (2, "sv", [text + "Slut."])]
    rows += [(3, "sv", ["Andra talade också om flera saker i byn, men det gick där i många år innan någon kom ihåg vad som egentligen hade hänt med kvarnen."])]
    packs = spark.createDataFrame(rows, "k int, lang string, content array<string>")
    kept = {}
    for name in ("ocr", "fuse"):
        got = {r["k"]: r["content"] for r in run_pipeline(packs, name, "k", R.label_provider(F.col("lang")), least_tokens=15).collect()}
        kept[name] = sorted(k for k, c in got.items() if any(c))
    assert kept == {"ocr": [2, 3], "fuse": [1, 3]}


def test_streaming(spark, tmp_path):
    from corpusloom.streaming.first_seen import first_seen, windowed_counts

    source = tmp_path / "in"
    rows = [("a", "2020-01-01 00:00:00"), ("a", "2020-01-01 01:00:00"), ("b", "2020-01-02 00:00:00")]
    spark.createDataFrame(rows, "t string, at string").select("t", F.to_timestamp("at").alias("at")).write.parquet(str(source))
    stream = spark.readStream.schema("t string, at timestamp").parquet(str(source))
    for name, df, mode in (("firsts", first_seen(stream, "t", "at"), "append"), ("counts", windowed_counts(stream, "at"), "complete")):
        query = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).start()
        query.processAllAvailable()
        query.stop()
    assert sorted(r["t"] for r in spark.sql("SELECT t FROM firsts").collect()) == ["a", "b"]
    assert sorted(r["n"] for r in spark.sql("SELECT n FROM counts").collect()) == [1, 2]
