"""Exact top-k search by inner product on a bit-sliced index.

Vectors are quantised to floor(256 x). A block of rows stores, for every dimension, one bitmap over the rows for each
bit of the value above the block's minimum. A query's scores are sums of such bitmaps: multiplying by a component
shifts the bitmaps by the bits of its absolute value, a negative component takes their complements, and full adders
add the bitmaps of equal weight, three at a time, until one bitmap is left for each bit of the score. The best rows
are then found from the most significant bitmap downward. Rows of a block lie in the order of their ids, so rows that
tie at the boundary are resolved exactly, by the smaller id. Vectors too large for 64-bit sums are not in the index;
their products are taken one by one, in Python's integers.
"""

from __future__ import annotations

import heapq
import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeloom.llm.common import staged, with_python

#: Rows of a block, about; a block's bitmaps hold as many bits for each dimension and bit of the values.
BLOCK = 16_384
#: Queries that travel together, and queries that are added up together.
CHUNK, TOGETHER = 256, 32
#: Components in the index are below this, and so small that scores of their number of dimensions fit into 64 bits.
LIMIT, SCORES = float(1 << 20), float(1 << 61)
Bitmap = np.ndarray


def _usable(vector: Column) -> Column:
    return ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def _wide(vector: Column) -> Column:
    """Whether a component is as large as ``LIMIT``, or so large that sums of products might not fit."""
    limit = F.least(F.lit(LIMIT), F.sqrt(F.lit(SCORES) / F.greatest(F.size(vector), F.lit(1))) / 256)
    return F.exists(vector, lambda x: F.abs(x) >= limit)


def quantised(vector: Column) -> Column:
    """floor(256 x) of every component; null where a component is null, not finite, or too large for the index."""
    return F.when(_usable(vector) & ~_wide(vector), F.transform(vector, lambda x: F.floor(x.cast("double") * 256)))


def pack(bits: np.ndarray) -> Bitmap:
    """Words of 64 rows each, over the last axis."""
    padded = np.zeros((*bits.shape[:-1], -(-bits.shape[-1] // 64) * 64), bool)
    padded[..., : bits.shape[-1]] = bits
    return np.packbits(padded, axis=-1, bitorder="little").view("<u8")


def unpack(words: Bitmap) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(words).view(np.uint8), axis=-1, bitorder="little").astype(bool)


def slices_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, Bitmap]:
    """Per dimension the smallest value and the number of bitmaps, and all bitmaps one below the other."""
    low = values.min(axis=0)
    above = values - low
    widths = np.array([int(x).bit_length() for x in above.max(axis=0)], np.int64)
    maps = [pack((above[:, d] >> j & 1).astype(bool)) for d, width in enumerate(widths) for j in range(width)]
    words = -(-len(values) // 64)
    return low, widths, np.array(maps, "<u8").reshape(len(maps), words)


def add_up(low: np.ndarray, widths: np.ndarray, maps: Bitmap, queries: np.ndarray) -> tuple[list[Bitmap], np.ndarray]:
    """Bitmaps (queries x words) of the sums, least significant first, and what to add to a sum for the score."""
    size, negative = np.abs(queries), queries < 0
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    pending: dict[int, list[Bitmap]] = defaultdict(list)
    at = 0
    for d, width in enumerate(widths.tolist()):
        flip = np.where(negative[:, d], full, np.uint64(0))[:, None]
        bits = int(size[:, d].max()).bit_length()
        masks = [np.where(size[:, d] >> i & 1, full, np.uint64(0))[:, None] for i in range(bits)]
        for j in range(width):
            one = maps[at + j] ^ flip
            for i, mask in enumerate(masks):
                pending[i + j].append(one & mask)
                _carry(pending, i + j, 3)
        at += width
    out, weight = [], 0
    while weight <= max(pending, default=-1):
        _carry(pending, weight, 2)
        out.append(pending[weight][0] if pending[weight] else np.zeros((len(queries), maps.shape[1]), "<u8"))
        weight += 1
    top = low + (1 << widths) - 1
    return out, (np.where(negative, -size * top, size * low)).sum(axis=1)


def _carry(pending: dict[int, list[Bitmap]], weight: int, most: int) -> None:
    """Adds bitmaps of one weight until fewer than ``most`` are left; carries go to the next weight."""
    while len(maps := pending[weight]) >= most:
        a, b = maps.pop(), maps.pop()
        if maps:
            c, odd = maps.pop(), a ^ b
            pending[weight].append(odd ^ c)
            pending[weight + 1].append((a & b) | (odd & c))
        else:
            maps.append(a ^ b)
            pending[weight + 1].append(a & b)


def best(sums: list[Bitmap], open_rows: Bitmap, k: int) -> tuple[Bitmap, Bitmap]:
    """Rows that belong to the best k, and rows that tie for the places left, from the top bitmap downward."""
    sure, ties = np.zeros_like(open_rows), open_rows.copy()
    for bitmap in reversed(sums):
        higher = ties & bitmap
        count = (np.bitwise_count(sure).sum(axis=1, dtype=np.int64) + np.bitwise_count(higher).sum(axis=1, dtype=np.int64))[:, None]
        sure = np.where(count <= k, sure | higher, sure)
        ties = np.where(count > k, higher, ties & ~bitmap)
    return sure, ties


def search_block(low, widths, maps, ids: np.ndarray, queries: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of the k best rows of a block for each query; ``own`` is the query's own row here, or -1."""
    sums, base = add_up(low, widths, maps, queries)
    allowed = np.ones((len(queries), len(ids)), bool)
    allowed[np.flatnonzero(own >= 0), own[own >= 0]] = False
    sure, ties = best(sums, pack(allowed), k)
    sure, ties = unpack(sure), unpack(ties)
    places = k - sure.sum(axis=1, keepdims=True)
    chosen = sure | ties & (np.cumsum(ties, axis=1) <= places)
    query, row = np.nonzero(chosen)
    score = base[query].copy()
    for weight, bitmap in enumerate(sums):
        score += (bitmap[query, row >> 6] >> (row & 63).astype(np.uint64) & np.uint64(1)).astype(np.int64) << weight
    return query, row, score


def index(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", block_rows: int = BLOCK) -> DataFrame:
    """The bit-sliced index: one row per block, with ids, quantised values of the rows, minima, widths and bitmaps.

    Vectors that are null or hold null or non-finite components and vectors without id take no part; those with huge
    components (``LIMIT``) are left to :func:`_wide_answers`.
    """
    values = vectors.select(F.col(id_col).cast("long").alias("vec_id"), quantised(F.col(vector_col)).alias("v"))
    values = values.filter("v IS NOT NULL AND vec_id IS NOT NULL").withColumn("dims", F.size("v"))
    blocks = max(1, -(-vectors.count() // block_rows))
    dealt = values.withColumn("block", F.pmod(F.xxhash64(F.lit(5), "vec_id", "v"), F.lit(blocks)))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("vec_id", kind="stable", ignore_index=True)
        v = np.stack(rows["v"].to_numpy()).astype(np.int64) if rows["dims"].iloc[0] else np.zeros((len(rows), 0), np.int64)
        low, widths, maps = slices_of(v) if v.shape[1] else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, -(-len(v) // 64)), "<u8"))
        return pd.DataFrame({
            "dims": [rows["dims"].iloc[0]], "block": [rows["block"].iloc[0]], "ids": [rows["vec_id"].to_numpy(np.int64).tobytes()],
            "v": [v.tobytes()], "low": [low.tobytes()], "widths": [widths.tobytes()], "maps": [maps.tobytes()],
        })

    schema = "dims int, block long, ids binary, v binary, low binary, widths binary, maps binary"
    built = with_python(dealt).groupBy("dims", "block").applyInPandas(build, schema)
    return staged(built, "topk-index").withColumn("blocks", F.lit(blocks))


def _whole(x: float) -> int:
    return int(x) * 256 if abs(x) >= 1 << 52 else math.floor(256 * x)


def _answers(scores: list[int], ids: list[int], k: int) -> list[tuple[int, int, int]]:
    """(vec_id, score, over) of the k best; ``over`` tells on which side a score leaves 64 bits."""
    top = heapq.nsmallest(k, range(len(ids)), key=lambda j: (-scores[j], ids[j]))
    low, high = -(1 << 63), (1 << 63) - 1
    return [(ids[j], min(max(scores[j], low), high), (scores[j] > high) - (scores[j] < low)) for j in top]


def _wide_answers(vectors: DataFrame, found: DataFrame, k: int, every: int, id_col: str, vector_col: str) -> DataFrame | None:
    """What huge vectors add to the answers: as queries with all rows, as candidates of all queries. None without any."""
    vector = F.col(vector_col)
    wide = vectors.filter(F.col(id_col).isNotNull() & _usable(vector) & _wide(vector))
    wide = wide.select(F.col(id_col).cast("long").alias("vec_id"), F.transform(vector, lambda x: x.cast("double")).alias("x"))
    wide = staged(wide.withColumn("place", F.monotonically_increasing_id()).withColumn("dims", F.size("x")), "topk-wide")
    number = wide.count()
    if not number:
        return None

    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(rows["x"].to_numpy()).astype(np.float64)
        ids, places = (rows[c].to_numpy(np.int64).tobytes() for c in ("vec_id", "place"))
        return pd.DataFrame({"dims": [rows["dims"].iloc[0]], "wide_ids": [ids], "places": [places], "x": [x.tobytes()]})

    dealt = wide.withColumn("part", F.pmod(F.xxhash64("place"), F.lit(-(-number // CHUNK))))
    parts = with_python(dealt).groupBy("dims", "part").applyInPandas(gather, "dims int, wide_ids binary, places binary, x binary")
    parts = staged(parts, "topk-parts")

    def values(x: bytes, dims: int) -> np.ndarray:
        return np.array([_whole(c) for c in np.frombuffer(x).tolist()], object).reshape(-1, dims)

    def ints(x: bytes) -> list[int]:
        return np.frombuffer(x, np.int64).tolist()

    columns = ["query_id", "query_block", "query_row", "vec_id", "score", "over"]
    shape = "query_id long, query_block long, query_row long, vec_id long, score long, over int"

    def with_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                ids, wide_ids, places, w = ints(row.ids), ints(row.wide_ids), ints(row.places), values(row.x, row.dims)
                v = np.frombuffer(row.v, np.int64).reshape(len(ids), row.dims).astype(object)
                asked = [n for n, i in enumerate(ids) if i % every == 0]
                out = [(ids[n], row.block, n, *a) for n in asked for a in _answers((w @ v[n]).tolist(), wide_ids, k)]
                out += [(i, -1, at, *a) for i, at, q in zip(wide_ids, places, w, strict=True) if i % every == 0 for a in _answers((v @ q).tolist(), ids, k)]
                yield pd.DataFrame(out, columns=columns)

    def with_wide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                ids, places, w, others = ints(row.wide_ids), ints(row.places), values(row.x, row.dims), values(row.other_x, row.dims)
                other_ids, other_places, out = ints(row.other_ids), ints(row.other_places), []
                for i, at, q in zip(ids, places, w, strict=True):
                    if i % every == 0:
                        there = [n for n, place in enumerate(other_places) if place != at]
                        out += [(i, -1, at, *a) for a in _answers((others[there] @ q).tolist(), [other_ids[n] for n in there], k)]
                yield pd.DataFrame(out, columns=columns)

    others = parts.select("dims", F.col("wide_ids").alias("other_ids"), F.col("places").alias("other_places"), F.col("x").alias("other_x"))
    return (
        found.select("dims", "block", "ids", "v").join(parts, "dims").mapInPandas(with_blocks, shape)
        .union(parts.join(others, "dims").mapInPandas(with_wide, shape))
    )


def top_k(vectors: DataFrame, *, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` best rows for every row whose id is divisible by ``every``.

    A query is compared with all other rows of its length; the row itself is left out, rows that repeat its id or its
    vector are not. Ties go to the smaller id; fewer than ``k`` rows are all returned. See :func:`index` for vectors
    that take no part; an empty table gives an empty result. A score among the best that 64 bits do not hold is an error.
    """
    found = index(vectors, id_col=id_col, vector_col=vector_col)

    def chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                ids = np.frombuffer(row.ids, np.int64)
                v = np.frombuffer(row.v, np.int64).reshape(len(ids), row.dims)
                wanted = np.flatnonzero(ids % every == 0)
                for a in range(0, len(wanted), CHUNK):
                    own = wanted[a : a + CHUNK]
                    yield pd.DataFrame({
                        "dims": [row.dims], "own_block": [row.block], "own": [own.tobytes()],
                        "queries": [ids[own].tobytes()], "qv": [v[own].tobytes()], "blocks": [row.blocks],
                    })

    shape = "dims int, own_block long, own binary, queries binary, qv binary, blocks int"
    asked = found.select("dims", "block", "ids", "v", "blocks").mapInPandas(chunks, shape)
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - F.lit(1).cast("long")))).drop("blocks")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                ids, low, widths = (np.frombuffer(x, np.int64) for x in (row.ids, row.low, row.widths))
                maps = np.frombuffer(row.maps, "<u8").reshape(-1, -(-len(ids) // 64))
                queries = np.frombuffer(row.queries, np.int64)
                qv = np.frombuffer(row.qv, np.int64).reshape(len(queries), row.dims)
                own = np.frombuffer(row.own, np.int64) if row.own_block == row.block else np.full(len(queries), -1)
                for a in range(0, len(queries), TOGETHER):
                    part = slice(a, a + TOGETHER)
                    q, r, score = search_block(low, widths, maps, ids, qv[part], own[part], k)
                    yield pd.DataFrame({
                        "query_id": queries[part][q], "query_block": row.own_block, "query_row": np.frombuffer(row.own, np.int64)[part][q],
                        "vec_id": ids[r], "score": score,
                    })

    pairs = asked.join(found.drop("v", "blocks"), ["dims", "block"])
    answers = pairs.mapInPandas(search, "query_id long, query_block long, query_row long, vec_id long, score long")
    answers = answers.withColumn("over", F.lit(0))
    wide = _wide_answers(vectors, found, k, every, id_col, vector_col)
    if wide is not None:
        answers = answers.union(wide)
    # The place of the query tells repeated rows with one id apart.
    order = Window.partitionBy("query_id", "query_block", "query_row").orderBy(F.desc("over"), F.desc("score"), "vec_id")
    ranked = answers.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    score = F.when(F.col("over") == 0, F.col("score")).otherwise(F.raise_error("A score does not fit into 64 bits").cast("long"))
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", score.alias("score"))
