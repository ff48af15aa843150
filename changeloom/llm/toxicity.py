"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text, normalised by length, with exception phrases.

The lexicon is learned from labelled rows. A term is a whole word, or the beginning of words where at least
``PREFIX_WORDS`` different words share it. Occurrences count once for each word before them, so that words that
merely stand in copies of a toxic text stay out. Terms far more frequent in toxic rows are kept, the most telling of
those that begin alike; their log odds are the weights. Word pairs around a term that occur in clean rows become exception phrases. A logistic curve
over the weight per word turns matches into a score.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.llm.common import bounded_sample, fold_of, staged, with_python

#: Letters of other scripts and digits that are read as Latin letters. "l" is read as "i", as "1" may be either.
HOMOGLYPHS = ("абвгеікмнорѕстухјԁһԛԝɡαβγεικνορτυχω", "abbreikmhopsctyxjdhqwgabyeiknoptuxw")
DIGITS = ("0134578", "oieastb")
SAME = ("l", "i")

PREFIXES = (4, 5, 6, 7)
PREFIX_WORDS = 5
#: A term counts if it stands after this many different words at least: in copies of one text it does not.
MIN_SPREAD = 8
MIN_LOG_ODDS = 2.0
MIN_GAIN = 40.0
FLUSH = 100_000
#: Rows that are used for fitting, at most (about); everything else covers all rows.
TRAIN_ROWS = 12_000
_WORD = re.compile(r"[^\W_]+")


def _folding() -> dict[int, str]:
    table = {c: base for c in range(0xC0, 0x250) if (base := unicodedata.normalize("NFKD", chr(c))[0]) and base.isascii()}
    for there, here in (HOMOGLYPHS, DIGITS, SAME):
        table |= {ord(a): b for a, b in zip(there, here, strict=True)}
    return {c: "i" if x == "l" else x.lower() for c, x in table.items()}


FOLDING = _folding()


def folded_words(text: str | None) -> list[str]:
    """The words of a text in lower case, with look-alikes folded to Latin letters."""
    return _WORD.findall(text.lower().translate(FOLDING)) if text else []


@dataclass
class Lexicon:
    """Weights of terms (" word " or " beginning"), phrases that excuse a term inside them, and the logistic curve."""

    weights: dict[str, float]
    exceptions: set[str]
    slope: float = 0.0
    bias: float = -20.0

    def automaton(self) -> ahocorasick.Automaton | None:
        if not self.weights:
            return None
        found = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            found.add_word(term, (len(term), weight))
        for phrase in self.exceptions - self.weights.keys():
            found.add_word(phrase, (len(phrase), None))
        found.make_automaton()
        return found

    def score(self, density: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.bias + self.slope * np.log1p(density), -50, 50)))


def density_of(text: str | None, automaton: ahocorasick.Automaton | None) -> float:
    """Weight of the terms outside exception phrases, per hundred words."""
    words = folded_words(text)
    if automaton is None or not words:
        return 0.0
    hits, excused = [], []
    for end, (length, weight) in automaton.iter(f" {' '.join(words)} "):
        (excused if weight is None else hits).append((end - length + 1, end, weight))
    # Of the phrases that begin at or before a term, the one that ends last tells whether one of them holds it.
    excused.sort()
    begins, reach = [x for x, _, _ in excused], list(accumulate((y for _, y, _ in excused), max))
    total = sum(w for a, b, w in hits if not (k := bisect_right(begins, a)) or reach[k - 1] < b)
    return 100 * total / (len(words) + 10)


def _word_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per word and label: occurrences after different words of a row, and a bitmap of the words before it."""
    counts: dict[str, list[int]] = {}

    def out() -> pd.DataFrame:
        return pd.DataFrame([(w, *c) for w, c in counts.items()], columns=["word", "clean", "toxic", "clean_bits", "toxic_bits"])

    for batch in batches:
        for text, label in zip(batch["text"], batch["label"], strict=True):
            words, label = folded_words(text), int(label)
            bits = {word: 1 << (zlib.crc32(word.encode()) % 63) for word in {"", *words}}
            for before, word in set(zip(["", *words], words)):
                if (found := counts.get(word)) is None:
                    counts[word] = found = [0, 0, 0, 0]
                found[label] += 1
                found[2 + label] |= bits[before]
            if len(counts) > FLUSH:
                yield out()
                counts.clear()
    if counts:
        yield out()


def _terms_of(word: Column) -> Column:
    """The terms that a word counts for: itself, and its beginnings."""
    starts = [F.when(F.length(word) >= size, F.concat(F.lit(" "), F.substring(word, 1, size))) for size in PREFIXES]
    return F.array_compact(F.array(F.concat(F.lit(" "), word, F.lit(" ")), *starts))


def _spread(count: int, bits: int) -> float:
    """Different words before a term, estimated from its bitmap; a full bitmap says no more than the count."""
    filled = bits.bit_count()
    return float(count) if filled >= 60 else min(float(count), -63 * math.log(1 - filled / 63))


def _gain(toxic: float, clean: float, all_toxic: float, all_clean: float) -> float:
    """Log-likelihood ratio of a term's rates in toxic and clean rows."""
    rate = (toxic + clean) / (all_toxic + all_clean)
    parts = ((toxic, rate * all_toxic), (clean, rate * all_clean))
    return 2 * sum(n * math.log(n / expected) for n, expected in parts if n > 0)


def _chosen(candidates: list[tuple[str, float, float]], all_toxic: float, all_clean: float) -> dict[str, float]:
    """Weights of the terms kept of (term, toxic, clean): the best ones of which none begins with another."""
    def weight(toxic: float, clean: float) -> float:
        return math.log((toxic + 0.5) / (all_toxic + 1)) - math.log((clean + 0.5) / (all_clean + 1))

    scored = [(_gain(t, c, all_toxic, all_clean), len(term), term, weight(t, c)) for term, t, c in candidates]
    kept: dict[str, float] = {}
    beginnings, within = set(), set()  # the beginnings kept, and all that a kept term begins with
    for gain, _, term, odds in sorted(scored, reverse=True):
        stem, whole = term.rstrip(), term.endswith(" ")
        if gain < MIN_GAIN or odds < MIN_LOG_ODDS or not whole and stem in within:
            continue
        starts = {stem[:k] for k in range(1, len(stem) + 1)}
        if starts & beginnings:
            continue
        kept[term] = odds
        within |= starts
        if not whole:
            beginnings.add(stem)
    return kept


def _curve(density: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and bias of a logistic curve over log(1 + density), by Newton steps with a small penalty."""
    x = np.column_stack([np.log1p(density), np.ones(len(density))])
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - labels) + np.array([0.01, 0.001]) * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag([0.01, 0.001])
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def learn(labelled: DataFrame, *, train_rows: int = TRAIN_ROWS) -> Lexicon:
    """A lexicon from rows (doc_id, text, label 0 or 1); about ``train_rows`` of them are looked at.

    Without toxic or without clean rows the lexicon is empty and every score is the share of toxic rows.
    """
    rows = staged(bounded_sample(labelled.filter("label IN (0, 1)"), "doc_id", train_rows), "toxicity-train")
    totals = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if not totals.get(0) or not totals.get(1):
        return Lexicon({}, set(), 0.0, 20.0 if totals.get(1) else -20.0)
    sums = [F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")]
    sums += [F.bit_or("clean_bits").alias("clean_bits"), F.bit_or("toxic_bits").alias("toxic_bits")]
    by_word = (
        with_python(rows.select("text", "label"))
        .mapInPandas(_word_counts, "word string, clean long, toxic long, clean_bits long, toxic_bits long")
        .groupBy("word")
        .agg(*sums)
    )
    counts = (
        by_word.withColumn("term", F.explode(_terms_of(F.col("word"))))
        .groupBy("term")
        .agg(*sums, F.count_if(F.col("toxic") > 0).alias("words"))
    )
    words = rows.select("label", F.size(F.split(F.col("text"), r"\s+")).alias("n")).groupBy("label").agg(F.sum("n").alias("n"))
    sizes = {r["label"]: float(r["n"] or 1) for r in words.collect()}
    odds = F.log((F.col("toxic") + 0.5) / (sizes[1] + 1)) - F.log((F.col("clean") + 0.5) / (sizes[0] + 1))
    likely = (
        counts.filter((F.bit_count("toxic_bits") >= MIN_SPREAD) & (odds >= MIN_LOG_ODDS))
        .filter(F.col("term").endswith(" ") | (F.col("words") >= PREFIX_WORDS))
        .collect()  # terms of the rows used for fitting, whose number is bounded
    )
    found = [(r["term"], _spread(r["toxic"], r["toxic_bits"]), _spread(r["clean"], r["clean_bits"])) for r in likely]
    weights = _chosen(found, sizes[1], sizes[0])
    lexicon = Lexicon(weights, set())
    lexicon.exceptions = _exceptions(rows, lexicon)
    automaton_of = lexicon.automaton

    def densities(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = automaton_of()
        for batch in batches:
            yield pd.DataFrame({"density": [density_of(t, automaton) for t in batch["text"]], "label": batch["label"]})

    seen = rows.select("text", "label").mapInPandas(densities, "density double, label int").toPandas()
    lexicon.slope, lexicon.bias = _curve(seen["density"].to_numpy(), seen["label"].to_numpy())
    return lexicon


def _exceptions(rows: DataFrame, lexicon: Lexicon) -> set[str]:
    """Pairs of a term's word and a neighbour that stand in clean rows and in no toxic one."""
    whole = {t for t in lexicon.weights if t.endswith(" ")}
    starts = tuple(t[1:] for t in lexicon.weights if not t.endswith(" "))

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for text, label in zip(batch["text"], batch["label"], strict=True):
                words = folded_words(text)
                hits = [i for i, w in enumerate(words) if f" {w} " in whole or (starts and w.startswith(starts))]
                around = {" ".join(words[a : a + 2]) for i in hits for a in (i - 1, i) if 0 <= a < len(words) - 1}
                found[int(label)].update(around)
            phrases = list(found[0].keys() | found[1].keys())
            yield pd.DataFrame({"phrase": phrases, "clean": [found[0][p] for p in phrases], "toxic": [found[1][p] for p in phrases]})

    counted = (
        rows.select("text", "label")
        .mapInPandas(pairs, "phrase string, clean long, toxic long")
        .groupBy("phrase")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .filter((F.col("clean") >= 5) & (F.col("toxic") == 0))
        .collect()
    )
    return {f" {r["phrase"]} " for r in counted}


def score(docs: DataFrame, lexicon: Lexicon, *, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the score (0 to 1) of every whole text; null and empty texts match nothing."""
    automaton_of, score_of = lexicon.automaton, lexicon.score

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = automaton_of()
        for texts in batches:
            yield pd.Series(score_of(np.array([density_of(t, automaton) for t in texts], dtype=float)))

    return with_python(docs).withColumn(name, scored(F.col(text_col)))


def training_rows(docs: DataFrame, labels: DataFrame, *, folds: int = 3, held_out: int = 1, rows: int = TRAIN_ROWS) -> DataFrame:
    """Labelled texts outside the held-out fold, a bounded number of them: their ids are small enough to be broadcast.

    Null ids, null labels and labels other than 0 and 1 are left out; of several labels of a row the largest counts.
    """
    known = labels.filter("toxic IN (0, 1) AND doc_id IS NOT NULL").filter(fold_of("doc_id", folds) != held_out)
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    chosen = bounded_sample(known, "doc_id", rows)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def toxicity(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``.

    Nulls, empty texts, repeated rows and empty tables are allowed: a text without words scores as one without any
    match. ``labels`` (doc_id, toxic) is read for fitting only; ids in fold 1 of 3 are never looked at.
    """
    lexicon = learn(training_rows(docs, labels))
    scored = score(docs.select("doc_id", "text"), lexicon)
    held = (fold_of("doc_id", 3) == 1).alias("held_out")
    return scored.select("doc_id", held, "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
