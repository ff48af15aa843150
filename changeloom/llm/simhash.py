"""SimHash near-duplicates: fingerprints, a byte-position inverted index with count filtering, components.

Two 64-bit fingerprints that differ in at most 4 bits differ in at most 4 of their 8 bytes, so they share at least
4 positional bytes. Postings of single bytes would be far too long, so the index posts *triples* of positions: the 20
triples of :func:`covering_triples` are such that any 4 shared positions contain one of them. Pairs that meet in a
posting list have their shared bytes tallied, pairs below the guaranteed minimum are dropped, and the rest is verified
by its differing bits. No list is cut off: long ones are dealt out as pairs of blocks to many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom.llm.common import fresh, raw, staged, with_python

POSITIONS = 8
#: Shingles are hashed in pieces of this many, so that a very long text needs no more memory than a short one.
PIECE = 1 << 16
#: Posting lists up to this length are one block; the blocks of longer ones grow with the square root of the length.
BLOCK = 256


def covering_triples() -> list[tuple[int, int, int]]:
    """The triples of byte positions of which any 4 positions contain at least one.

    Positions fall into three classes. Of 4 positions, 3 are in one class, or 2 in one class and 1 in the next: these
    are the triples kept, 20 of 56.
    """
    def kept(triple: tuple[int, int, int]) -> bool:
        counts = [sum(p % 3 == c for p in triple) for c in range(3)]
        return max(counts) == 3 or any(counts[c] == 2 and counts[(c + 1) % 3] == 1 for c in range(3))

    return [t for t in combinations(range(POSITIONS), 3) if kept(t)]


def fingerprint(text: bytes, size: int = 4) -> bytes:
    """The 8 bytes of a text's fingerprint; zero for a text without words."""
    words = text.lower().split()
    if not words:
        return bytes(8)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts, ends = (ends - lengths)[: 1 - size], ends[size - 1 :]
    if len(words) < size:
        starts, ends = np.array([0]), np.array([len(joined)])
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), PIECE):
        spans = zip(starts[at : at + PIECE].tolist(), ends[at : at + PIECE].tolist(), strict=True)
        hashes = b"".join([xxhash.xxh64_digest(joined[a:b], 42) for a, b in spans])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        whole = len(bits) // 255 * 255  # sums of up to 255 bits fit into a byte
        counts += bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        counts += bits[whole:].sum(axis=0, dtype=np.uint8)
    return np.packbits(counts * 2 > len(starts)).tobytes()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4) -> DataFrame:
    """Id and ``fp`` (the fingerprint as a long) of every row."""

    @F.pandas_udf(T.LongType())
    def fp(texts: pd.Series) -> pd.Series:
        data = b"".join([fingerprint(t, size) for t in texts])
        return pd.Series(np.frombuffer(data, ">i8").astype(np.int64))

    return with_python(docs).select(F.col(id_col).alias("doc_id"), fp(raw(text_col)).alias("fp"))


def groups_within(prints: np.ndarray, max_bits: int, min_bytes: int) -> list[np.ndarray]:
    """Positions that links connect, for each group of two or more; each position is compared with those not yet reached."""
    left, found = np.arange(len(prints)), []
    while len(left):
        group, left = [left[:1]], left[1:]
        waiting = [group[0][0]]
        while waiting and len(left):
            differing = prints[left] ^ prints[waiting.pop()]
            shared = (differing.view(np.uint8).reshape(-1, POSITIONS) == 0).sum(axis=1)
            near = shared >= min_bytes
            near[near] = np.bitwise_count(differing[near]) <= max_bits
            if near.any():
                group.append(left[near])
                waiting.extend(left[near])
                left = left[~near]
        if len(group) > 1:
            found.append(np.concatenate(group))
    return found


def _runs(max_bits: int):
    min_bytes = POSITIONS - max_bits

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: pd.DataFrame | None = None

        def links(part: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            keys, prints = part[["key", "lo", "hi"]].to_numpy(), part["fp"].to_numpy().view(np.uint64)
            edges = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            starts, ends = np.append(0, edges), np.append(edges, len(part))
            many = ends - starts > 1
            for a, b in zip(starts[many].tolist(), ends[many].tolist(), strict=True):
                for group in groups_within(prints[a:b], max_bits, min_bytes):
                    members = np.sort(prints[a:b][group].view(np.int64))
                    yield members[1:], np.full(len(members) - 1, members[0])

        def out(part: pd.DataFrame) -> Iterator[pd.DataFrame]:
            pairs = list(links(part))
            if pairs:
                yield pd.DataFrame({"a": np.concatenate([p[0] for p in pairs]), "b": np.concatenate([p[1] for p in pairs])})

        for batch in batches:
            if not len(batch):
                continue
            part = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            last = part[["key", "lo", "hi"]].to_numpy()
            begin = int((last != last[-1]).any(axis=1).nonzero()[0][-1]) + 1 if (last != last[-1]).any() else 0
            rest = part.iloc[begin:]
            if begin:
                yield from out(part.iloc[:begin])
        if rest is not None:
            yield from out(rest)

    return run


def links(prints: DataFrame, max_bits: int = 4) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints, enough of the links to connect what the links connect."""
    if not 0 <= max_bits <= 4:
        raise ValueError("the triples of positions find up to 4 differing bits")
    byte = [F.shiftrightunsigned("fp", 8 * (POSITIONS - 1 - p)).bitwiseAND(F.lit(255)) for p in range(POSITIONS)]
    keys = [
        F.lit(k << 24) + F.shiftleft(byte[i], 16) + F.shiftleft(byte[j], 8) + byte[m]
        for k, (i, j, m) in enumerate(covering_triples())
    ]
    postings = prints.select("fp", F.explode(F.array(*keys)).alias("key"))
    long_lists = staged(postings.groupBy("key").count().filter(F.col("count") > BLOCK), "simhash-lists")
    side = F.lit(BLOCK) * F.ceil(F.sqrt(F.col("count") / BLOCK))
    dealt = (
        postings.join(long_lists, "key", "left")
        .withColumn("blocks", F.coalesce(F.ceil(F.col("count") / side), F.lit(1)))
        .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        # Every pair of blocks is compared as one list, which compares each block with itself as well.
        .filter((F.col("blocks") == 1) | (F.col("own") != F.col("other")))
        .select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "fp")
        .repartition("key", "lo", "hi")
        .sortWithinPartitions("key", "lo", "hi")
    )
    return with_python(dealt).mapInPandas(_runs(max_bits), "a long, b long").distinct()


def components(pairs: DataFrame) -> DataFrame:
    """``node`` and the smallest node reachable (``label``) for every node of the pairs (a, b).

    Each round takes the smallest label among the neighbours and then the label's own label, so rounds grow with the
    logarithm of the longest path. Rounds are written to the shared folder.
    """
    both = staged(pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))), "simhash-pairs")
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")), "simhash-labels")
    while True:
        near = both.join(labels, both.b == labels.node).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("m"))
        hooked = staged(labels.join(near, "node").select("node", F.least("label", "m").alias("label")), "simhash-labels")
        roots = hooked.select(F.col("node").alias("label"), F.col("label").alias("root"))
        jumped = staged(hooked.join(roots, "label").select("node", F.col("root").alias("label")), "simhash-labels")
        changed = labels.withColumnRenamed("label", "was").join(jumped, "node").filter(F.col("was") != F.col("label"))
        labels = jumped
        if changed.isEmpty():
            return labels


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = 4, max_bits: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (the smallest id reachable over links) of every row.

    Null and empty texts have fingerprint zero and are linked like any other. Rows with a null id are linked, but
    never name a component; one of null ids only has a null component_id. Repeated rows stay, ties cannot occur, and
    an empty table gives an empty result. Other columns are ignored, whatever their names.
    """
    prints = staged(fingerprints(docs, id_col, text_col, size), "simhash-prints")
    nodes = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-nodes")
    labels = components(links(nodes, max_bits))
    known = nodes.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("label", "fp").alias("label"), "first"
    )
    smallest = known.groupBy("label").agg(F.min("first").alias("component_id"))
    named = staged(known.select("fp", "label").join(smallest, "label").select("fp", "component_id"), "simhash-named")
    return prints.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = 4, max_bits: int = 4) -> DataFrame:
    """The rows of ``docs`` with one row of each group left: the one with the smallest id.

    Rows of one id are one document: of those that name a group the one with the smallest fingerprint stays. Of a group of null ids only, one row of each fingerprint stays. Nulls,
    empty texts and empty tables are treated as :func:`near_duplicates` says; all columns are kept.
    """
    found = staged(near_duplicates(docs, id_col=id_col, text_col=text_col, size=size, max_bits=max_bits), "simhash-found")
    key, printed_as, nth = fresh(docs, "group_id"), fresh(docs, "printed_as"), fresh(docs, "nth_row")
    by_id = found.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias(key))
    again = staged(by_id.count().filter("count > 1").select(key), "simhash-again")
    lost = found.filter("doc_id != component_id").select(F.col("doc_id").alias(key))
    gone = lost.union(again).distinct()
    kept = docs.filter(F.col(id_col).isNotNull()).join(gone, F.col(id_col) == F.col(key), "left_anti")
    nameless = found.filter("component_id IS NULL")
    if again.isEmpty() and nameless.isEmpty():
        return kept
    # Ids of several rows and groups without any id: rows are told apart by their fingerprints.
    heads = (
        found.join(again, F.col("doc_id") == F.col(key), "left_semi")
        .filter("doc_id = component_id")
        .union(nameless)
        .select(F.col("doc_id").alias(key), F.col("fingerprint").alias(printed_as))
        .distinct()
    )
    unclear = docs.join(again, F.col(id_col) == F.col(key), "left_semi").union(docs.filter(F.col(id_col).isNull()))
    printed = with_python(unclear).withColumn(printed_as, _hex_print(text_col, size))
    matching = printed[id_col].eqNullSafe(heads[key]) & (printed[printed_as] == heads[printed_as])
    # A group without ids is one of equal or linked fingerprints; the smallest stands for all of it.
    once = Window.partitionBy(id_col).orderBy(printed_as, F.xxhash64(text_col))
    chosen = printed.join(heads, matching, "left_semi").filter(F.col(id_col).isNotNull())
    chosen = chosen.withColumn(nth, F.row_number().over(once)).filter(F.col(nth) == 1).drop(printed_as, nth)
    once = Window.partitionBy(printed_as).orderBy(F.xxhash64(text_col))
    unnamed = printed.filter(F.col(id_col).isNull()).join(heads, matching, "left_semi")
    unnamed = unnamed.withColumn(nth, F.row_number().over(once)).filter(F.col(nth) == 1).drop(printed_as, nth)
    return kept.union(chosen).union(unnamed)


def _hex_print(text_col: str, size: int):
    @F.pandas_udf(T.StringType())
    def printed(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, size).hex() for t in texts])

    return printed(raw(text_col))
