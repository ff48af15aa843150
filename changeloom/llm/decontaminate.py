"""Benchmark decontamination: greedy string tiling over shared-token seeds.

A seed is a run of ``SEED`` words that a document and a benchmark item share. Documents keep only the stretches that
seeds cover, since nothing else can be part of a tile; seeds are then joined with those of the items, and for every
pair that meets, the longest common stretches are marked again and again, found by Karp-Rabin hashes, until none of
``SEED`` words is left unmarked on both sides. A document is contaminated by an item if the tiles cover enough of the
item, in whatever order its passages come.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.llm.common import fresh, staged, with_python

SEED = 5
COVERAGE = 0.5
#: Bits of the filter of the items' seeds that documents are held against; its size does not depend on the benchmark.
FILTER_BITS = 24
REMEMBERED = 200_000
_WORD = re.compile(r"\w+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word.encode(), 1)
        return value


def hashed_words(text: str | None, words: _Words) -> np.ndarray:
    """Hashes of a text's words in lower case; punctuation does not count."""
    found = _WORD.findall(text.lower()) if text else []
    return np.fromiter(map(words.__getitem__, found), np.uint64, len(found))


def window_hashes(tokens: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hashes of all stretches of ``size`` tokens."""
    count = len(tokens) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for i in range(size):
        total = total * _BASE + tokens[i : i + count]
    return total ^ total >> np.uint64(31)


def tiles(item: np.ndarray, stretches: list[np.ndarray], least: int = SEED) -> list[tuple[int, int, int, int]]:
    """Greedy string tiling: (start in the item, stretch, start in it, words), longest first, none overlapping."""
    free_item = np.ones(len(item), bool)
    free = [np.ones(len(s), bool) for s in stretches]
    found: list[tuple[int, int, int, int]] = []
    size = max([least, *(min(len(item), len(s)) for s in stretches)])
    while size >= least:
        matches = _matches(item, free_item, stretches, free, size)
        if matches:
            # Matches of the size found now are maximal or longer; the longest are marked first.
            for words, a, k, b in sorted(matches, key=lambda m: (-m[0], m[1:])):
                if free_item[a : a + words].all() and free[k][b : b + words].all():
                    free_item[a : a + words] = free[k][b : b + words] = False
                    found.append((a, k, b, words))
        if matches and size > least:
            continue
        if not matches and size == least:
            break
        size = max(least, size // 2) if not matches else size
    return found


def _matches(item, free_item, stretches, free, size) -> list[tuple[int, int, int, int]]:
    at: dict[int, list[int]] = defaultdict(list)
    for a, value in enumerate(window_hashes(item, size).tolist()):
        if free_item[a : a + size].all():
            at[value].append(a)
    out, longest = [], size
    for k, tokens in enumerate(stretches):
        hashes = window_hashes(tokens, size)
        for b in np.flatnonzero(np.isin(hashes, np.fromiter(at, np.uint64, len(at)))).tolist() if at else ():
            if not free[k][b : b + size].all():
                continue
            for a in at[int(hashes[b])]:
                if not np.array_equal(item[a : a + size], tokens[b : b + size]):
                    continue
                words = size
                while (
                    a + words < len(item) and b + words < len(tokens) and item[a + words] == tokens[b + words]
                    and free_item[a + words] and free[k][b + words]
                ):
                    words += 1
                longest = max(longest, words)
                out.append((words, a, k, b))
    # Only the longest: shorter ones may be cut by them and are found again in the next round.
    return [m for m in out if m[0] == longest]


def _items(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = _Words()
        for batch in batches:
            tokens = [hashed_words(t, words) for t in batch["text"]]
            seeds = [np.unique(window_hashes(t, SEED)).view(np.int64) for t in tokens]
            yield pd.DataFrame({"item_id": batch["item_id"], "tokens": [t.view(np.int64) for t in tokens], "seeds": seeds})

    rows = benchmark.select(F.col(item_col).alias("item_id"), F.col(text_col).alias("text"))
    kind = rows.schema["item_id"].dataType.simpleString()
    return staged(with_python(rows).mapInPandas(hashed, f"item_id {kind}, tokens array<long>, seeds array<long>"), "tiling-items")


def _filter_of(seeds: DataFrame) -> np.ndarray:
    """Bits of the seeds' hashes, two of 2^FILTER_BITS for each."""
    places = F.explode(F.array(F.col("seed"), F.shiftright("seed", FILTER_BITS))).alias("place")
    place = F.col("place").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(31)).cast("int"))
    words = seeds.select(places).groupBy(F.shiftright(place, 5).alias("word")).agg(F.bit_or(mask).alias("bits"))
    bits = np.zeros(1 << FILTER_BITS - 5, np.uint32)
    for row in words.toLocalIterator():  # at most 2^(FILTER_BITS - 5) rows
        bits[row["word"]] = row["bits"]
    return bits


def _may_be_seeds(windows: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which hashes the filter does not rule out."""
    possible = np.ones(len(windows), bool)
    for place in (windows, windows >> np.uint64(FILTER_BITS)):
        place = place & np.uint64((1 << FILTER_BITS) - 1)
        possible &= (bits[place >> np.uint64(5)] >> (place & np.uint64(31)).astype(np.uint32) & np.uint32(1)).astype(bool)
    return possible


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    coverage: float = COVERAGE,
) -> DataFrame:
    """doc_id, text_key (a hash of the text), item_id, coverage, tiles and longest for every contaminated pair.

    ``coverage`` is the share of the item's words that tiles cover. Items of fewer than ``SEED`` words, null and empty
    texts on either side match nothing. Repeated rows give repeated pairs; items that repeat an id are different items
    of one id. Empty tables give an empty result; other columns are not read.
    """
    items = _items(benchmark, item_col, item_text_col).withColumn("item", F.monotonically_increasing_id())
    items = staged(items, "tiling-items")
    seeds = items.select("item", F.explode("seeds").alias("seed"))
    shared = docs.sparkSession.sparkContext.broadcast(_filter_of(seeds))  # of fixed size

    def cover(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits, words = shared.value, _Words()
        for batch in batches:
            rows = []
            for doc_id, key, text in zip(batch["doc_id"], batch["text_key"], batch["text"], strict=True):
                tokens = hashed_words(text, words)
                windows = window_hashes(tokens, SEED)
                hit = np.flatnonzero(_may_be_seeds(windows, bits))
                if len(hit):
                    cuts = np.flatnonzero(np.diff(hit) > 1) + 1
                    stretches = [tokens[r[0] : r[-1] + SEED].view(np.int64) for r in np.split(hit, cuts)]
                    rows.append((doc_id, key, np.unique(windows[hit]).view(np.int64), stretches))
            if rows:
                yield pd.DataFrame(rows, columns=["doc_id", "text_key", "seeds", "stretches"])

    texts = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    covered = with_python(texts).mapInPandas(
        cover, f"doc_id {kind}, text_key long, seeds array<long>, stretches array<array<long>>"
    )
    covered = staged(covered.withColumn("row", F.monotonically_increasing_id()), "tiling-covered")
    pairs = covered.select("row", F.explode("seeds").alias("seed")).join(seeds, "seed").select("row", "item").distinct()

    def tile(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [
                tiles(np.asarray(tokens, np.int64).view(np.uint64), [np.asarray(s, np.int64).view(np.uint64) for s in stretches])
                for tokens, stretches in zip(batch["tokens"], batch["stretches"], strict=True)
            ]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "text_key": batch["text_key"], "item_id": batch["item_id"],
                "coverage": [sum(t[3] for t in f) / len(tokens) for f, tokens in zip(found, batch["tokens"], strict=True)],
                "tiles": [len(f) for f in found], "longest": [max((t[3] for t in f), default=0) for f in found],
            })

    item_kind = items.schema["item_id"].dataType.simpleString()
    met = pairs.join(covered.drop("seeds"), "row").join(items.select("item", "item_id", "tokens"), "item")
    tiled = met.select("doc_id", "text_key", "item_id", "tokens", "stretches").mapInPandas(
        tile, f"doc_id {kind}, text_key long, item_id {item_kind}, coverage double, tiles int, longest int"
    )
    return tiled.filter(F.col("coverage") >= coverage)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that no benchmark item contaminates, with all their columns.

    Rows go by their text, so repeated ids and null ids make no difference.
    """
    found = contamination(docs, benchmark, text_col=text_col, **options)
    key = fresh(docs, "text_key")
    keys = staged(found.select(F.col("text_key").alias(key)).distinct(), "tiling-keys")
    return docs.join(keys, F.xxhash64(text_col) == F.col(key), "left_anti")
