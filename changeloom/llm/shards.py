"""Token ids in training order: a keyed permutation of all sequences, written as fixed-stride binary shards.

Texts are turned into token ids and packed into sequences of equal length, a separator after each text. Sequences are
numbered by input partition and place in it; a keyed Feistel network, walked along its cycles until it lands inside
the number of sequences, gives each its slot. Slots are dealt out by range, a shard holding the same number of slots,
and every record has the same number of bytes, so a reader finds any slot by one seek and resumes where it stopped.

The texts are encoded twice: first to count and describe the sequences, then to send each straight to its shard.
Encoding is cheaper than keeping all ids a second time.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.llm.common import staged, with_python
from changeloom.session import scratch_path

#: Fixed value: how the vocabulary's tokenizer cuts a text into pieces.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for texts without white space next to white space: nothing has to be looked ahead at, which takes half the time.
PLAIN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s"
_BLANKS_MEET = re.compile(r"\s\s")
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
LENGTH = 1024
SHARD_RECORDS = 16_384
#: Between records, so that text files can carry them; two bytes keep records aligned to ids.
RECORD_END = "\n\n"
ROUNDS = 4


class Encoder:
    """Ids of texts as bytes, two for each id."""

    def __init__(self, vocabulary: bytes):
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
        self.separator = np.uint16(len(ranks)).tobytes()
        self.any, self.plain = (
            tiktoken.Encoding("pieces", pat_str=p, mergeable_ranks=ranks, special_tokens={}) for p in (PATTERN, PLAIN_PATTERN)
        )

    def encode(self, text: str) -> bytes:
        encoding = self.any if _BLANKS_MEET.search(text) else self.plain
        return array("H", encoding.encode_ordinary(text)).tobytes()


@lru_cache(1)
def encoder_of(vocabulary: bytes) -> Encoder:
    """The encoder of a Python worker, which its tasks share."""
    return Encoder(vocabulary)


def vocabulary_of(spark: SparkSession, path: str) -> bytes:
    """The vocabulary file, read on the driver; it has a fixed size and is sent to the tasks."""
    if "://" in path:
        return bytes(spark.read.format("binaryFile").load(path).select("content").head()[0])
    with open(path, "rb") as file:
        return file.read()


def packed(rows: Iterator[tuple[object, str]], encoder: Encoder, length: int) -> Iterator[tuple[bytes, list, int]]:
    """Sequences of one partition: ids, the documents they hold a part of, and how many ids are not padding."""
    size, parts, ids, held = 2 * length, [], [], 0
    for doc_id, text in rows:
        data = encoder.encode(text or "") + encoder.separator
        at = 0
        while at < len(data):
            piece = data[at : at + size - held]
            parts.append(piece)
            ids.append(doc_id)
            held, at = held + len(piece), at + len(piece)
            if held == size:
                yield b"".join(parts), ids, length
                parts, ids, held = [], [], 0
    if held:
        yield b"".join(parts) + encoder.separator * ((size - held) // 2), ids, held // 2


def _mix(x: np.ndarray, key: np.uint64) -> np.ndarray:
    x = (x + key) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ x >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(32)


def permuted(numbers: np.ndarray, total: int, key: int, *, inverse: bool = False) -> np.ndarray:
    """The slot of every number below ``total``; a bijection for each key. ``inverse`` gives the number of a slot."""
    half = max(1, -(-max(1, (total - 1).bit_length()) // 2))
    low, shift = np.uint64((1 << half) - 1), np.uint64(half)
    rounds = [np.uint64(zlib.crc32(f"{key}:{r}".encode()) << 16 | r) for r in range(ROUNDS)]
    out = np.asarray(numbers, np.uint64).copy()
    walking = np.arange(len(out))
    while len(walking):
        left, right = out[walking] >> shift, out[walking] & low
        for k in reversed(rounds) if inverse else rounds:
            if inverse:
                left, right = right ^ (_mix(left, k) & low), left
            else:
                left, right = right, left ^ (_mix(right, k) & low)
        out[walking] = left << shift | right
        walking = walking[out[walking] >= total]
    return out.astype(np.int64)


def materialise(
    docs: DataFrame,
    path: str | None = None,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = VOCABULARY,
    length: int = LENGTH,
    shard_records: int = SHARD_RECORDS,
    key: int = 2024,
) -> DataFrame:
    """Writes the shards below ``path`` (default: the shared folder) and returns one row per sequence.

    Columns: slot, shard, offset (of the record in its shard, in bytes), doc_ids (in order, an id once for each part),
    tokens (ids that are not padding) and crc (of the record's ids). Shard n is the one file in ``path/shard=n``, its
    records in the order of their slots, each of ``2 * length`` bytes of little-endian ids and two line ends.

    A null or empty text is a separator alone; repeated rows and null ids are kept as they come; an empty table gives
    no rows and no shard. Only a partition's last sequence is padded. ``docs`` must come in the same partitions when it
    is read again, as files do; if it does not, the write fails.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "token-shards")
    rows = with_python(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    kind = rows.schema["doc_id"].dataType.simpleString()
    content = spark.sparkContext.broadcast(vocabulary_of(spark, vocabulary))

    def sequences(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[bytes, list, int]]:
        encoder = encoder_of(content.value)
        texts = ((i, t) for b in batches for i, t in zip(b["doc_id"].astype(object).where(b["doc_id"].notna(), None), b["text"], strict=True))
        return packed(texts, encoder, length)

    def in_batches(found: Iterator[tuple], columns: list[str], most: int = 2048) -> Iterator[pd.DataFrame]:
        held = []
        for row in found:
            held.append(row)
            if len(held) == most:
                yield pd.DataFrame(held, columns=columns)
                held = []
        if held:
            yield pd.DataFrame(held, columns=columns)

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        found = ((part, k, ids, n, zlib.crc32(data)) for k, (data, ids, n) in enumerate(sequences(batches)))
        return in_batches(found, ["part", "place", "doc_ids", "tokens", "crc"])

    described = staged(
        rows.mapInPandas(describe, f"part int, place long, doc_ids array<{kind}>, tokens int, crc long"), "shards-sequences"
    )
    # One number for each input partition.
    counts = {r["part"]: r["count"] for r in described.groupBy("part").count().collect()}
    ends = np.cumsum([counts.get(p, 0) for p in range(max(counts, default=-1) + 1)]).tolist()
    starts, total = [0, *ends[:-1]], ends[-1] if ends else 0

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        start = starts[part] if part < len(starts) else 0
        seen = 0

        def slots() -> Iterator[tuple]:
            nonlocal seen
            for data, _, _ in sequences(batches):
                seen += 1
                yield start + seen - 1, data

        for batch in in_batches(slots(), ["slot", "record"]):
            batch["slot"] = permuted(batch["slot"].to_numpy(), total, key)
            yield batch
        if seen != counts.get(part, 0):
            raise RuntimeError(f"partition {part} held {counts.get(part, 0)} sequences and now holds {seen}; stage its rows first")

    shard = F.expr(f"slot div {shard_records}")
    shards = max(1, -(-total // shard_records))
    records = rows.mapInPandas(place, "slot long, record binary").withColumn("shard", shard)
    # A shard is a range of slots and belongs to the task of its number, so none gets two.
    dealt = records.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("shard", "slot")
    dealt.select("shard", F.col("record").cast("string")).write.partitionBy("shard").option("lineSep", RECORD_END).text(path)

    @F.pandas_udf("long")
    def slot_of(part: pd.Series, number: pd.Series) -> pd.Series:
        start = np.array([starts[p] for p in part], np.int64)
        return pd.Series(permuted(start + number.to_numpy(np.int64), total, key))

    placed = described.withColumn("slot", slot_of("part", "place")).withColumn("shard", shard)
    offset = (F.col("slot") % shard_records) * (2 * length + len(RECORD_END))
    return placed.select("slot", "shard", offset.alias("offset"), "doc_ids", "tokens", "crc")


def records_of(shard: bytes, length: int = LENGTH, first: int = 0) -> np.ndarray:
    """The ids of a shard's records (records x length), from record ``first`` on."""
    stride = 2 * length + len(RECORD_END)
    body = np.frombuffer(shard, np.uint8, offset=first * stride).reshape(-1, stride)
    return np.ascontiguousarray(body[:, : 2 * length]).view("<u2")
