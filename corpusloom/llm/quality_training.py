"""Learns the rule list of ``quality`` from labelled documents.

``python -m corpusloom.llm.quality_training DATA_DIR`` writes labelled documents
of the four kinds (their forms drawn at random, their words made up), computes
their statistics with Spark, induces rules by incremental reduced-error pruning,
reports the accuracy on held-out documents and writes ``quality_rules.py``.
"""

from __future__ import annotations

import random
import sys
from pathlib import Path

import numpy as np

#: Which statistics may decide on a kind: what it is made of, never its length.
USES = {
    "junk": "distinct_share symbol_share vowel_share letter_share mean_word_length mixed_token_share".split(),
    "table": "column_line_share figure_line_share clock_line_share field_share common_share digit_share symbol_share".split(),
    "list": "common_share sentence_end_share punctuated_line_share words_per_item field_share symbol_share digit_share".split(),
}
#: Bound of the labelled sample the rules are fitted on.
TRAINING_DOCUMENTS = 16_000


class Writer:
    """Labelled documents with made-up words."""

    def __init__(self, seed: int, common: list[str]):
        self.r, self.common = random.Random(seed), common
        self.lexicon = [self._word() for _ in range(3000)]
        self.near = self.lexicon

    def _word(self) -> str:
        r = self.r
        onset = "b d f g h j k l m n p r s t v br fr gr kl kr sk sl sp st str tr".split()
        coda = ["", "", "n", "r", "l", "s", "t", "k", "m", "ng", "nd", "rk", "st"]
        return "".join(r.choice(onset) + r.choice("aeiouyåäö") + r.choice(coda) for _ in range(r.choice((1, 2, 2, 3, 3, 4, 5, 6))))

    def word(self) -> str:
        return self.r.choice(self.near)

    def sentence(self, density: float) -> str:
        r = self.r
        words = [r.choice(self.common) if r.random() < density else self.word() for _ in range(r.randint(3, 18))]
        if r.random() < 0.3:
            words[r.randrange(len(words))] = r.choice((str(r.randint(1, 2020)), f"{r.randint(1, 12)}.{r.randint(10, 59)}–{r.randint(13, 20)}.00", f"0{r.randint(10, 99)}-{r.randint(100, 999)} {r.randint(10, 99)} {r.randint(10, 99)}", f"{r.randint(10**9, 10**10)}", f"{r.randint(1, 99)}{r.choice('abcABC')}", f"{r.randint(1, 12)}H:{r.randint(1, 9)}", f"O{r.randint(10, 99)} - {r.randint(100, 999)} {r.randint(10, 99)}"))
        if r.random() < 0.15:
            words[r.randrange(len(words))] += ","
        return " ".join(words).capitalize() + r.choice("......!?")

    def prose(self) -> str:
        r = self.r
        density = r.uniform(0.05, 0.6)
        self.near = r.sample(self.lexicon, r.choice((12, 20, 40, 100, 400)))
        sentences = [self.sentence(density) for _ in range(r.choice((1, 1, 2, 3, 4, 6, 9, 14)))]
        if r.random() < 0.15:
            sentences.insert(0, self.sentence(density)[:-1].upper() + "\n")
        text = " ".join(sentences)
        if r.random() < 0.5:
            text = self.wrap(text, r.randint(18, 80))
        if r.random() < 0.15:
            text = text.replace(" ", "  ")
        if r.random() < 0.2:
            text = "".join(c for c in text if c.isalnum() or c.isspace())
        if r.random() < 0.1:
            text = r.choice(("* ", "--- ", "– ", "  ", "• ")) + text + r.choice((" ***", "", "\n\n"))
        if r.random() < 0.1:
            text = text.replace(". ", ".\n\n")
        if r.random() < 0.05:
            text = text.replace(",", " ,").replace(".", " .")
        return self.cased(text)

    @staticmethod
    def wrap(text: str, width: int) -> str:
        out, line = [], ""
        for w in text.split(" "):
            if line and len(line) + len(w) >= width:
                out.append(line)
                line = w
            else:
                line = f"{line} {w}" if line else w
        return "\n".join([*out, line])

    def cased(self, text: str) -> str:
        x = self.r.random()
        return text.upper() if x < 0.1 else text.lower() if x < 0.2 else text.title() if x < 0.3 else text

    def item(self) -> str:
        r = self.r
        return " ".join(self.word() for _ in range(r.choice((1, 1, 1, 2, 2, 3))))

    def figure(self) -> str:
        r = self.r
        return r.choice((f"{r.randint(1, 400)}:{r.randint(0, 99):02}", f"{r.randint(1, 9999)} kr", str(r.randint(1, 9999)), f"{r.randint(1, 99)},{r.randint(0, 99):02}", f"{r.randint(1, 90)}kg", f"O{r.randint(10, 99)} - {r.randint(100, 999)} {r.randint(10, 99)} {r.randint(10, 99)}"))

    def list(self) -> str:
        r, n = self.r, self.r.randint(4, 24)
        form = r.randrange(7)
        if form == 0:
            mark = r.choice(("• ", "- ", "– ", "* ", "", ""))
            text = "\n".join(mark + self.item() for _ in range(n))
        elif form == 1:
            text = ", ".join(self.item() for _ in range(n))
        elif form == 2:
            gap = r.choice((f" {'.' * r.randint(3, 12)} ", f" {'.' * r.randint(6, 10)} ", " ", ", ", " ... ", ": ", " – ", "\t"))
            text = "\n".join(self.item() + gap + self.figure() for _ in range(n))
        elif form == 3:
            head = self.word().capitalize() + ":\n" if r.random() < 0.7 else ""
            text = head + "\n".join(f"{self.item().title()}, {self.word().capitalize()}" for _ in range(n))
        elif form == 4:
            text = r.choice(("; ", " | ", "\n", " • ", " / ")).join(self.item() + (" " + self.figure()) * (r.random() < 0.3) for _ in range(n))
        elif form == 5:
            text = "\n".join(f"{i}{r.choice('.)')} {self.item()}" for i in range(1, n))
        else:
            colon = r.choice((": ", " : ", ":", ":  "))
            value = lambda: r.choice((self.item(), self.figure(), f"0{r.randint(10, 99)}-{r.randint(100, 999)} {r.randint(10, 99)} {r.randint(10, 99)}", f"{r.randint(0, 9999):09}"))
            text = r.choice(("\n", "; ", " | ", "\n\n")).join(self.word().capitalize() + colon + value() for _ in range(r.randint(4, 9)))
        return self.cased(text)

    def table(self) -> str:
        r, rows = self.r, self.r.randint(4, 14)
        form, columns = r.randrange(5), r.randint(2, 6)
        small = r.random() < 0.4
        number = lambda: str(r.randint(0, 40)) if small else r.choice((str(r.randint(0, 99999)), str(r.randint(0, 99)), f"{r.randint(0, 999)}.{r.randint(0, 99):02}"))
        if form == 0:
            text = "\n".join("\t".join([self.word().capitalize(), *(number() for _ in range(columns))]) for _ in range(rows))
        elif form == 1:
            text = "\n".join(self.word().capitalize().ljust(16) + "".join(number().rjust(9) for _ in range(columns)) for _ in range(rows))
        elif form == 2:
            head = " | ".join(self.word().capitalize() for _ in range(columns + 1))
            text = head + "\n" + "\n".join(" | ".join([self.word(), *(r.choice((number(), f"{r.randint(1, 99)} kg")) for _ in range(columns))]) for _ in range(rows))
        elif form == 3:
            text = "\n".join(" ".join(str(r.randint(10 ** r.randint(0, 4), 99999)) for _ in range(columns + 1)) for _ in range(rows))
        else:
            text = "\n".join(f"{r.randint(6, 23)}{r.choice('.:')}{r.choice(range(0, 60, 5)):02} {self.item().capitalize()}" for _ in range(rows))
        return self.cased(text) if r.random() < 0.3 else text

    def junk(self) -> str:
        r, form = self.r, self.r.randrange(7)
        if form == 0:
            return "".join(r.choice("|/\\*_-^<>:;.,'\"#§+=~i1lI¦ ") for _ in range(r.randint(30, 250))) + r.choice(("", "", f"¦{r.randint(0, 9999):04}¦{r.randint(0, 9999):04}"))
        if form == 1:
            bits = ["ii", "11", "ll", "III", "'", "''", ",,", ";;", ":", "::", "..", "...", "---", "-", "1", "l", "I", "·", "··"]
            return " ".join(r.choice(bits) for _ in range(r.randint(30, 110))) + r.choice(("", f" {r.getrandbits(36):x}"))
        if form == 2:
            return " ".join("".join(r.choice("bcdfghjklmnpqrstvxz") for _ in range(r.randint(1, 8))) for _ in range(r.randint(15, 60)))
        if form == 3:
            bits = ["Ã¶", "Ã¤", "Ã¥Ã", "ï¿½", "â€", "Â¤", "ÃÃ", "¿½"]
            return " ".join(r.choice(bits) + r.choice(("", "q", "kk", "zzz", "xx")) + str(r.randint(1, 999)) for _ in range(r.randint(12, 50)))
        if form == 4:
            alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
            text = "".join(r.choice(alphabet) for _ in range(r.randint(60, 300))) + "="
            return self.wrap_hard(text, r.randint(40, 90)) if r.random() < 0.3 else text
        if form == 5:
            few = [self.word() if r.random() < 0.7 else r.choice(self.common) for _ in range(r.randint(1, 8))]
            again = r.randint(5, 20)
            mixed = r.random() < 0.3
            text = r.choice((" ", " ", "\n")).join(" ".join(r.choice(few) if mixed else w for w in few) for _ in range(again))
            return self.cased(text + r.choice(("", ".", "!")))
        once = self.sentence(0.3)
        return self.cased(r.choice((" ", "\n")).join([once] * r.randint(8, 20)))

    @staticmethod
    def wrap_hard(text: str, width: int) -> str:
        return "\n".join(text[i : i + width] for i in range(0, len(text), width))

    def documents(self, n: int) -> list[tuple[int, str, str]]:
        kinds = ("prose", "prose", "list", "table", "junk")
        out = []
        for i in range(n):
            self.near = self.lexicon
            kind = self.r.choice(kinds)
            out.append((i, kind, getattr(self, kind)()))
        return out


def grow(x: np.ndarray, y: np.ndarray, use: list[int]) -> list[tuple[int, str, float]]:
    """One rule by FOIL gain until it covers no negative."""
    rule, held = [], np.ones(len(y), bool)
    for _ in range(6):
        p, n = (held & y).sum(), (held & ~y).sum()
        if n == 0 or p == 0:
            break
        best = (0.0, None)
        for j in use:
            values = x[held, j]
            cuts = np.unique(np.quantile(values, np.linspace(0, 1, 65)))
            cuts = np.unique(np.round((cuts[1:] + cuts[:-1]) / 2, 4)) if len(cuts) > 1 else []
            for c in cuts:
                for sign, on in ((">", values > c), ("<=", values <= c)):
                    a, b = (on & y[held]).sum(), (on & ~y[held]).sum()
                    if a:
                        gain = a * (np.log2(a / (a + b)) - np.log2(p / (p + n)))
                        if gain > best[0] + 1e-9:
                            best = (gain, (j, sign, float(c)))
        if best[1] is None:
            break
        rule.append(best[1])
        held &= covers(x, [best[1]])
    return rule


def covers(x: np.ndarray, rule) -> np.ndarray:
    on = np.ones(len(x), bool)
    for j, sign, c in rule:
        on &= x[:, j] > c if sign == ">" else x[:, j] <= c
    return on


def prune(x: np.ndarray, y: np.ndarray, rule):
    """Drop final conditions as long as (p - n) / (p + n) on the pruning set doesn't fall."""

    def worth(r):
        on = covers(x, r)
        p, n = (on & y).sum(), (on & ~y).sum()
        return (p - n) / (p + n) if p + n else -1.0

    while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
        rule = rule[:-1]
    return rule, worth(rule)


def induce(x: np.ndarray, labels: np.ndarray, names: list[str], order: list[str], seed: int = 3):
    """Ordered rules, kind after kind, by incremental reduced-error pruning; the rest is the default kind."""
    rng, rules, left = np.random.default_rng(seed), [], np.ones(len(labels), bool)
    for kind in order:
        tries = 0
        while (left & (labels == kind)).sum() >= 8 and tries < 6:
            ids = rng.permutation(np.flatnonzero(left))
            grown, pruned = ids[: len(ids) * 2 // 3], ids[len(ids) * 2 // 3 :]
            rule = grow(x[grown], labels[grown] == kind, [names.index(n) for n in USES[kind]])
            rule, value = prune(x[pruned], labels[pruned] == kind, rule) if rule else (rule, 0.0)
            if value <= 0.9:  # try another split of the documents before giving up
                tries += 1
                continue
            rules.append((kind, [(names[j], s, c) for j, s, c in rule]))
            left &= ~covers(x, rule)
    return rules


def apply_rules(x: np.ndarray, names: list[str], rules, default: str) -> np.ndarray:
    out = np.array([default] * len(x), object)
    open_ = np.ones(len(x), bool)
    for kind, conditions in rules:
        on = open_ & covers(x, [(names.index(n), s, c) for n, s, c in conditions])
        out[on], open_ = kind, open_ & ~on
    return out


def labelled(spark, common: list[str], n: int, seed: int):
    """Statistics and labels of ``n`` written documents."""
    from corpusloom.llm.quality import statistics

    documents = Writer(seed, common).documents(n)
    df = spark.createDataFrame([(i, t) for i, _, t in documents], "box_id long, content string")
    found = statistics(df, common).toPandas().set_index("box_id").loc[range(n)]
    return found.to_numpy(float), list(found.columns), np.array([k for _, k, _ in documents], object)


def main(data_dir: str) -> None:
    from pyspark.sql import SparkSession

    from corpusloom.llm.quality import common_words
    from corpusloom.session import table

    spark = SparkSession.builder.master("local[*]").config("spark.ui.enabled", "false").getOrCreate()
    common = common_words(table(spark, data_dir, "common_words").where("lang = 'sv'"))
    x, names, y = labelled(spark, common, TRAINING_DOCUMENTS, 1)
    rules = induce(x, y, names, ["junk", "table", "list"])
    tx, tnames, ty = labelled(spark, common, 4000, 2)
    got = apply_rules(tx, tnames, rules, "prose")
    for kind in ("prose", "list", "table", "junk"):
        hit = ((got == kind) & (ty == kind)).sum()
        print(f"{kind}: precision {hit / max(1, (got == kind).sum()):.4f}, recall {hit / (ty == kind).sum():.4f}")
    body = "".join(f"    ({k!r}, {c!r}),\n" for k, c in rules)
    Path(__file__).with_name("quality_rules.py").write_text(
        f'"""Learned by ``quality_training`` from {TRAINING_DOCUMENTS} written documents; not edited by hand."""\n\n'
        f"RULES = [\n{body}]\nDEFAULT_KIND = 'prose'\n"
    )


if __name__ == "__main__":
    main(sys.argv[1])
