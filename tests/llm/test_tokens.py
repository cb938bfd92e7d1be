import random

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import bytebpe, encoding, mixing, splitting

TEXTS = ["", None, "hej", "It's we'll\n\n  x ", "<|endoftext|>", "å" * 50, "x" * 3000, "a\x1c\x85b\xa0c　", "😀é́", "z!" * 400, " \n" * 30]


@pytest.fixture(scope="module")
def reference():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(bytebpe.DEFAULT_VOCABULARY)
    t.encode_special_tokens = True
    return lambda s: t.encode(s, add_special_tokens=False).ids


def test_ids_equal_the_public_library(spark, reference):
    rng = random.Random(1)
    texts = TEXTS + ["".join(rng.choice("abcåäö ,.\n019'") for _ in range(rng.randint(1, 400))) for _ in range(60)]
    df = spark.createDataFrame([(i, t, "clash", [1]) for i, t in enumerate(texts)], "doc_id long, text string, ids string, key array<int>")
    got = {r["doc_id"]: r["ids"] for r in encoding.encode(df).collect()}
    assert got == {i: reference(t) if t else [] for i, t in enumerate(texts)}
    counts = {r["doc_id"]: r["n_tokens"] for r in encoding.count_tokens(df, ["doc_id"]).collect()}
    assert counts == {i: len(x) for i, x in got.items()}
    assert encoding.encode(df.where("false")).count() == 0
    assert encoding.encode(df.union(df)).count() == 2 * len(texts)


def test_slices_never_cut_a_word(reference, monkeypatch):
    monkeypatch.setattr(bytebpe, "SLICE_CHARS", 50)
    encoder = bytebpe.Encoder(bytebpe.read_merges())
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab  \n\t.1'") for _ in range(700)) for _ in range(20)] + ["x" * 500]
    assert encoder.ids(texts) == [reference(t) for t in texts]


def test_long_rows_equal_short_ones():
    encoder = bytebpe.Encoder(bytebpe.read_merges())
    rng = random.Random(3)
    for _ in range(40):
        w = "".join(rng.choice("aabcdeånst") for _ in range(rng.randint(2, 120)))
        assert encoder._long(w.encode()) == encoder.words([w])[0]


def test_pieces(spark, reference):
    rng = random.Random(4)
    words = ["hus", "båt", "skogsmarknaden", "och", "7"]
    text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", ". ", ".\n", ".\n\n"]) for _ in range(900))
    texts = [text, "x" * 2000, "å€" * 700, "kort", "", None, text]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, piece int")
    rows = splitting.split_oversized(df, limit=200, overlap=20).collect()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert set(by) == {0, 1, 2, 3, 6} and [r["piece"] for r in by[3]] == ["kort"]
    for i, parts in by.items():
        parts.sort(key=lambda r: r["piece_no"])
        assert parts[0]["start"] == 0 and parts[-1]["end"] == len(texts[i])
        for r in parts:
            assert r["piece"] == texts[i][r["start"] : r["end"]] and r["n_tokens"] == len(reference(r["piece"])) <= 200
        for a, b in zip(parts, parts[1:]):
            assert a["start"] < b["start"] < a["end"] < b["end"]
            assert 18 <= len(reference(texts[i][b["start"] : a["end"]])) <= 40
    ends = [texts[0][r["end"] - 1 : r["end"] + 1] for r in by[0][:-1]]
    assert sum("." in e or "\n" in e for e in ends) > len(ends) * 0.8
    found = {r["doc_id"] for r in splitting.oversized(df, limit=200, overlap=20).collect()}
    assert found == {i for i, t in enumerate(texts) if t and len(reference(t)) > 200}
    assert splitting.oversized(df.where("false")).count() == 0
    with pytest.raises(ValueError):
        splitting.split_oversized(df, limit=10, overlap=8)


def test_water_filling():
    t = [mixing.Target("a", 0.5, 1, 100), mixing.Target("b", 0.5, 2, 1000)]
    assert mixing.water_fill(t) == pytest.approx(200) and t[0].epochs == 1 and t[1].epochs == pytest.approx(0.1)
    assert mixing.water_fill(t, 1000) == pytest.approx(1000) and t[0].epochs == 1 and t[1].epochs == pytest.approx(0.9)
    assert mixing.water_fill(t, 10**6) == pytest.approx(2100) and (t[0].epochs, t[1].epochs) == (1, 2)
    assert mixing.water_fill([mixing.Target("a", 1.0, 3, 0)]) == 0


def test_a_filled_mix_clamps_and_redistributes(spark):
    rng = random.Random(6)
    rows = [(i, "abc"[min(2, i % 4)], "ord " * rng.randint(1, 30)) for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    targets = spark.createDataFrame([("a", 0.6, 1), ("b", 0.2, 3), ("c", 0.2, 3)], "source string, target_share double, max_repeats int")
    chosen, shares = mixing.mix(docs, targets, mixing.available)
    got = {r["source"]: r for r in shares.collect()}
    used = {r["source"]: r["n"] for r in chosen.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("n")).collect()}
    assert used == {k: v["used_tokens"] for k, v in got.items()}
    size = {k: v["available_tokens"] for k, v in got.items()}
    assert used["a"] == size["a"] and got["a"]["actual_share"] < 0.3
    rest = (sum(size.values()) - size["a"]) / 2
    assert used["b"] == pytest.approx(rest, rel=0.01) and used["c"] == pytest.approx(rest, rel=0.01)
    assert {k: v["actual_share"] for k, v in got.items()} == pytest.approx({k: n / sum(used.values()) for k, n in used.items()})


def test_mix(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["a", "b", None, "other"]), "ord " * rng.randint(1, 30), 1) for i in range(800)] + [(900, "a", None, 1), (901, "a", "", 1), (902, "c", "en ", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, repeats int")
    targets = spark.createDataFrame([("a", 0.7, 3), ("b", 0.3, 1), ("none", 0.0, 2)], "source string, target_share double, max_repeats int")
    chosen, shares = mixing.mix(docs, targets)
    got = {r["source"]: r for r in shares.collect()}
    assert abs(got["a"]["actual_share"] - 0.7) < 0.02 and abs(got["b"]["actual_share"] - 0.3) < 0.02
    used: dict = {}
    for r in chosen.collect():
        assert r["repeats"] <= {"a": 3, "b": 1}[r["source"]] and r["n_tokens"] > 0
        used[r["source"]] = used.get(r["source"], 0) + r["repeats"] * r["n_tokens"]
    assert used == {k: v["used_tokens"] for k, v in got.items() if v["used_tokens"]}
    again = mixing.mix(docs, targets)[0]
    assert sorted(again.collect()) == sorted(chosen.collect())
    empty, none = mixing.mix(docs.where("false"), targets)
    assert empty.count() == 0 and {r["actual_share"] for r in none.collect()} == {0.0}
    with pytest.raises(ValueError):
        mixing.mix(docs, targets.union(targets))
    assert mixing.mix(docs, targets.where("false"))[0].count() == 0
    assert chosen.select(F.max("repeats")).first()[0] >= 1


def test_long_words_and_matrices_give_the_same_ids(monkeypatch):
    rng = random.Random(9)
    merges = bytebpe.read_merges(bytebpe.DEFAULT_VOCABULARY)
    words = ["".join(rng.choice("aabcdeåö漢 e") for _ in range(rng.randint(1, 60))) for _ in range(300)] + ["a" * 200, "ab" * 90, "aab" * 70]
    by_matrix = bytebpe.Encoder(merges).words(words)
    monkeypatch.setattr(bytebpe, "LONG", 0)
    encoder = bytebpe.Encoder(merges)
    assert [encoder._long(w.encode()) for w in words] == by_matrix


def test_sizes_of_pieces_are_those_of_pieces_encoded_alone():
    encoder = bytebpe.Encoder(bytebpe.read_merges(bytebpe.DEFAULT_VOCABULARY))
    rng = random.Random(10)
    for _ in range(12):
        text = "".join(rng.choice(["ord ", "  ", "\n\n", "don't ", "x" * rng.randint(1, 300), "123 ", "!? ", "\t \t", "漢字"]) for _ in range(600))
        for a, b, n in splitting.pieces_of(encoder, text, encoder.counts([text])[0], 90, 20):
            assert encoder.counts([text[a:b]])[0] == n <= 90
