import datetime
import random

import numpy as np
import pytest

from corpusloom.llm import scanned, survivor

META = "struct<package_id: string, title: string, created: string, year: int, edition: string, issue: string>"
SCHEMA = f"rec_id long, meta {META}, content array<string>, origin string, received_at timestamp, package string"
A = "Det var en gång en liten båt som låg vid kajen hela sommaren."
B = "En annan dag kom en storm som slet loss alla förtöjningar i hamnen."
X = "Helt andra ord handlar om skogen, marken och det som växer där uppe."


def at(day):
    return datetime.datetime(2020, 1, day)


def test_survivors(spark):
    rows = [
        (1, ("bib000012", "failed", None, -1, "1", ""), [A, None], "low", at(1), "clash"),
        (2, ("KB_bib-000012", "Titel", "1990-01-01", 1990, None, "no issue"), [A, B], "mid", at(2), "clash"),
        (3, ("bib_12", "Ny titel", "", 1991, "2", None), [A, B[:40]], "high", at(3), "clash"),
        (4, ("bib000012", None, None, None, None, None), None, "high", at(4), "clash"),
        (5, ("bib000012", "Annan", "1700-01-01", 1700, "1", "1"), [X], "high", at(5), "clash"),
        (6, (None, "Ensam", None, 1, None, None), [A, B], "high", at(5), "clash"),
        (7, ("bib000013", "T", None, 5, None, None), [], "none", None, "clash"),
        (8, ("bib000013", "U", None, 5, None, None), ["", None], None, at(1), "clash"),
        (9, None, [A], "low", at(1), "clash"),
    ]
    records = spark.createDataFrame(rows, SCHEMA)
    origins = spark.createDataFrame([("low", 1), ("mid", 2), ("high", 3), (None, 9)], "origin string, trust int")
    got = {(r["first_rec_id"], r["field_name"]): r["rec_id"] for r in survivor.survivors(records, origins).collect()}
    assert got == {
        (1, "title"): 3,
        (1, "created"): 2,
        (1, "year"): 3,
        (1, "edition"): 3,
        (1, "content"): 2,
        (7, "title"): 8,
        (7, "year"): 8,
    }
    assert survivor.survivors(records.where("false"), origins).count() == 0
    again = {(r["first_rec_id"], r["field_name"]): r["rec_id"] for r in survivor.survivors(records.union(records.where("rec_id = 2")), origins).collect()}
    assert again[(1, "content")] == 2


def test_no_join_of_survivors_broadcasts(spark):
    rows = [(i, (f"bib{i % 9}", f"t{i % 3}", "x", 1, "1", "1"), [A, B], "low", at(1), "") for i in range(30)]
    origins = spark.createDataFrame([("low", 1)], "origin string, trust int")
    plan = survivor.survivors(spark.createDataFrame(rows, SCHEMA), origins)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_a_hot_package(spark):
    rows = [(i, ("bib7", f"t{i % 3}", "x", 1, "1", "1"), [A, f"{B} {i}"], "low", at(1), "") for i in range(300)]
    origins = spark.createDataFrame([("low", 1)], "origin string, trust int")
    got = survivor.survivors(spark.createDataFrame(rows, SCHEMA), origins).collect()
    assert {r["first_rec_id"] for r in got} == {0} and len(got) == 6


def common(p, q):
    best = [[0] * (len(q) + 1) for _ in range(len(p) + 1)]
    for i, x in enumerate(p):
        for j, y in enumerate(q):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


@pytest.mark.parametrize("cells", [1, 20, 4_000_000])
def test_alignment_against_brute_force(monkeypatch, cells):
    monkeypatch.setattr(survivor, "CELLS", cells)
    rng = random.Random(cells)
    for _ in range(200):
        p, q = ([rng.randrange(4) for _ in range(rng.randrange(12))] for _ in range(2))
        pairs = survivor.matches(np.array(p, int), np.array(q, int))
        assert len(pairs) == common(p, q) and all(p[i] == q[j] for i, j in pairs)
        assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(pairs, pairs[1:]))
    assert survivor.deviations("a b c d", "a c d e") == [(1, 0, None), (4, 1, "e")]
    assert survivor.deviations("a b c", "a x y c") == [(1, 0, "x"), (2, 1, "y")] and survivor.deviations("a", "") == [(0, 0, None)]


def test_votes_decide_what_the_order_leaves_open(spark):
    def record(k, day, title):
        return (k, ("bib7", title, None, None, None, None), [A, B], "low", at(day), "")

    origins = spark.createDataFrame([("low", 1)], "origin string, trust int")

    def survivor_of(*rows):
        found = survivor.survivors(spark.createDataFrame([record(*r) for r in rows], SCHEMA), origins).collect()
        return next(r["rec_id"] for r in found if r["field_name"] == "title")

    # three of the same rank: two agree
    assert survivor_of((1, 2, "a b c"), (2, 2, "a x c"), (3, 2, "a x c")) == 2
    # two of the same rank: older ones decide, by the column in which they differ
    assert survivor_of((1, 2, "a b c"), (2, 2, "a x c"), (3, 1, "a x d"), (4, 1, "q x")) == 2
    assert survivor_of((1, 2, "a b c"), (2, 2, "a x c"), (3, 1, "a b d")) == 1
    # inserted words are voted on too, and a tie stays with the smallest id
    assert survivor_of((1, 2, "a c"), (2, 2, "a b c"), (3, 2, "z a b c")) == 2
    assert survivor_of((1, 2, "a b"), (2, 2, "a c")) == 1
    # older values never outvote a more recent one
    assert survivor_of((1, 1, "a x c"), (2, 1, "a x c"), (3, 2, "a b c"), (4, 1, "a x c")) == 3


WORDS = [a + b + c for a in "bdfgklmn" for b in "aeiouy" for c in ("r", "st", "nk")]


def content_rows(spark, contents):
    rows = [(i, (key, None, None, None, None, None), boxes, "low", at(1), "") for i, (key, boxes) in enumerate(contents)]
    return survivor.prepared(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([("low", 1)], "origin string, trust int")).cache()


def label_groups(rows):
    found = survivor.content_labels(rows).join(rows.select("pid", "node", "rec_id"), ["pid", "node"]).collect()
    groups = {}
    for r in found:
        groups.setdefault(r["label"], set()).add(r["rec_id"])
    return sorted(map(sorted, groups.values()))


def groups_by_hand(contents):
    """Contents of a key that have four fifths of the shingles of a box of each other, by every pair of box and content."""
    boxes, has = [], []
    for _, texts in contents:
        mine, everything = [], set()
        for w in (t.split()[:-1] for t in texts):
            mine.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)})
            everything |= mine[-1] | {tuple(w[:3]), tuple(w[:4])}
        boxes.append(mine)
        has.append(everything)
    of = list(range(len(contents)))
    for i, mine in enumerate(boxes):
        for j in range(len(contents)):
            if contents[i][0] == contents[j][0] and any(len(m & has[j]) >= 0.8 * len(m) for m in mine):
                old, into = of[i], of[j]
                of = [into if x == old else x for x in of]
    return sorted([i for i, x in enumerate(of) if x == k] for k in set(of))


def test_a_part_of_a_content_that_is_not_the_largest_with_its_shingles(spark):
    text = WORDS[:30]
    other = lambda n, k: [f"{w}{k}" for w in (WORDS * 3)[:n]]
    part, whole = " ".join(text), " ".join(other(10, "x") + text + other(10, "y"))
    larger = [" ".join(text[:14] + other(100, "z")), " ".join(other(100, "u") + text[16:])]
    records = [(1, whole, 2), (2, part, 1), (3, larger[0], 3), (4, larger[1], 3)]
    # the part shares less than half of its shingles with each of the larger two and all with the whole
    rows = [(k, ("bib7", f"t{k}", None, None, None, None), [box], "low", at(day), "") for k, box, day in records]
    origins = spark.createDataFrame([("low", 1)], "origin string, trust int")
    got = {(r["first_rec_id"], r["field_name"]): r["rec_id"] for r in survivor.survivors(spark.createDataFrame(rows, SCHEMA), origins).collect()}
    assert got == {(1, "title"): 1, (1, "content"): 1}


@pytest.mark.parametrize("pointing", [True, False])
def test_content_labels_against_every_pair(spark, monkeypatch, pointing):
    if not pointing:
        monkeypatch.setattr(survivor, "pointed_links", lambda open_, held, turn: open_.selectExpr("pid", "label AS node", "label AS to").where("false"))
    rng = random.Random(7)
    contents = []
    for key in range(30):
        texts = [rng.sample(WORDS, 40) for _ in range(3)]
        for _ in range(rng.randrange(2, 9)):
            boxes = []
            for _ in range(rng.randrange(1, 3)):
                pieces = [rng.sample(WORDS, rng.randrange(30))]
                for _ in range(rng.randrange(1, 4)):
                    text, start = rng.choice(texts), rng.randrange(30)
                    pieces.insert(rng.randrange(2), text[start : start + rng.randrange(4, 25)])
                boxes.append(" ".join(w for piece in pieces for w in piece))
            contents.append((f"bib{key}", boxes))
    groups = groups_by_hand(contents)
    assert label_groups(content_rows(spark, contents)) == groups and 30 < len(groups) < len(contents)


PAGE = "Byns Tidning   2\n\nVi gick till mark-\nnaden i går, och till in-\noch utförseln vid hamnen.\nDet var kväl¬ \nlen efter.\n- 2 -"


def replacements(spark):
    rows = [("kv«llen", "kvällen"), ("marknadcn", "marknaden"), ("harnnen", "hamnen"), ("g«r", "går"), ("dct", "det"), (None, "x")]
    return spark.createDataFrame(rows, "misread string, corrected string")


def scans(spark, rows):
    return spark.createDataFrame(rows, "scan_id long, package_id string, page_no int, content string, scanned_at timestamp, headers string")


def test_headers_recur_at_the_edge_in_tables_of_any_size(spark):
    page = lambda k, head, text: (k, f"p{k % 7}", k, f"{head}\n\nen rad text\n{text}\nmer text", at(1), "")
    date = lambda k: ("Fredagen", "fredageri", "Söridagen")[k % 3]
    rows = [page(k, f"Byns Blad {date(k)} den {1 + k % 28} maj 1978", "VÄGMÖTET I BYN") for k in range(1, 41)]
    rows += [(100 + k, "liten", k, f"Från salen {k}\n\nen rad text", at(1), "") for k in (1, 2)]
    rows += [(200, "annan", 9, "text\nFrån torget 9\ntext", at(1), "")]
    got = {(r["scan_id"], r["line_no"]) for r in scanned.noisy_lines(scans(spark, rows), replacements(spark)).collect() if r["kind"] == "header"}
    assert got == {(k, 1) for k in [*range(1, 41), 101, 102]}


def test_noisy_lines(spark):
    rows = [(i, "bib1", 2, PAGE, at(1), "") for i in range(8)]
    rows += [(20, "bib1", 3, "Det var marknadcn vid harnnen.\nSist på sidan kom hamn-", at(1), ""), (21, "bib 0001", 4, "nen fram.\nSlut.", at(1), "")]
    rows += [(30, None, None, None, None, ""), (31, "bib1", 9, "", at(1), ""), (32, "bib1", 9, " \n ", at(1), ""), (33, None, None, "7\nNågot.", at(1), "")]
    got = {tuple(r) for r in scanned.noisy_lines(scans(spark, rows), replacements(spark)).collect()}
    assert {r[1:] for r in got if r[0] == 1} == {(1, "header"), (3, "hyphen"), (6, "hyphen"), (8, "page_number")}
    assert {r[1:] for r in got if r[0] == 20} == {(1, "misread"), (2, "hyphen")}
    assert not [r for r in got if r[0] > 20]
    assert scanned.noisy_lines(scans(spark, rows).where("false"), replacements(spark)).count() == 0


def test_paragraphs(spark):
    rows = [(100 + i, f"bib{100 + i}", 2, PAGE, at(1), "") for i in range(40)]
    rows += [(10, "bib9", 1, "Det var marknadcn vid ham-", at(1), ""), (11, "bib9", 2, "nen och", at(1), ""), (12, "bib9", 3, "slut.\n\nNytt stycke.", at(2), ""), (13, "bib9", 3, "gammalt", at(1), "")]
    got = [tuple(r) for r in scanned.paragraphs(scans(spark, rows), replacements(spark)).collect()]
    assert ("bib:103", 2, 1, "Vi gick till marknaden i går, och till in- och utförseln vid hamnen. Det var kvällen efter.") in got
    assert [r for r in got if r[0] == "bib:9"] and not [r for r in got if "Tidning" in r[3]]
    joined = [r for r in got if r[0] == "bib:9" and r[1] == 1]
    assert [r[3] for r in joined] == ["Det var marknaden vid hamnen och slut."]
    assert ("bib:9", 3, 2, "Nytt stycke.") in got


RULES = [("1", "i", 0.1), ("1", "l", 0.1), ("«", "ä", 0.5), ("0", "o", 0.1), ("rn", "m", 0.1), ("c", "e", 0.2)]


def test_folding_and_forms():
    fold = scanned.Folding(RULES)
    assert fold("1GELV1KENS T1DN1NG") == fold("Igelvikens Tidning") and fold("harnnen") == fold("hamncn") != fold("hamnar")
    assert scanned.header_form("12 345", 3, fold) is None and scanned.header_form("vanlig rad", 3, fold) is None
    long = "EN MYCKET LÅNG RUBRIK " * 9
    assert scanned.header_form(long + "OM HAMNEN", 3, fold) != scanned.header_form(long + "OM SKOGEN", 3, fold)
    assert scanned.is_page_number("– 5 –", 5) and scanned.is_page_number("1 2", 12) and not scanned.is_page_number("9.", None)


def test_readings(spark):
    assert "kvällen" in scanned.readings("kv«llen", RULES, -30.0)
    long = "kv«llens0rdstyrclscn" * 8
    meant = long.replace("«", "ä").replace("0", "o").replace("c", "e")
    grams = scanned.Grams.of(spark.createDataFrame([(meant,)], "meant string"))
    assert list(scanned.readings(long, RULES, -1000.0, grams)) == [meant]
    assert scanned.readings(long, RULES, -20.0, grams) == {}


def test_no_join_broadcasts_pages(spark):
    rows = [(i, f"bib{i}", 2, PAGE, at(1), "") for i in range(40)]
    for found in (scanned.noisy_lines, scanned.paragraphs):
        plan = found(scans(spark, rows), replacements(spark))._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
