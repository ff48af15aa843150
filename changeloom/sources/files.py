"""What the driver needs to know about change files: size, kind and header line. Never their content."""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column as Expr
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import ChangeError
from ..operators.merge import SEQ

# Fixed value: the first four bytes of a zstd frame.
ZSTD_MAGIC = 0x28B52FFD

# File endings that make Spark decompress zstd by itself.
_ZSTD_ENDINGS = (".zst", ".zstd")
_LOCAL = "^file:/+"


@dataclass(frozen=True)
class ChangeFile:
    """One change file and its place in the list it came in."""

    seq: int
    path: str
    #: Qualified names, as the file sources report them (plain and percent-encoded).
    name: str
    uri: str
    size: int
    #: Spark's CSV source can read it; otherwise it is encrypted, or compressed without saying so.
    direct: bool
    compressed: bool
    header: tuple[str, ...] | None

    @property
    def pattern(self) -> str:
        """The path with glob characters escaped."""
        return "".join(f"\\{c}" if c in "{}[]*?\\" else c for c in self.name)


def with_position(df: DataFrame, members: Sequence[ChangeFile], file_path: Expr) -> DataFrame:
    """``df`` with the position of each row's file, found by its (percent-encoded) path.

    What is broadcast is one short row per file.
    """
    if len(members) == 1:
        return df.withColumn(SEQ, F.lit(members[0].seq))
    files = df.sparkSession.createDataFrame([(f.uri, f.seq) for f in members], "__uri string, __position int")
    located = df.withColumn("__uri", F.regexp_replace(file_path, _LOCAL, "file:/"))
    unknown = F.raise_error(F.concat(F.lit("Unexpected change file "), F.col("__uri"))).cast("int")
    positioned = located.join(F.broadcast(files), "__uri", "left")
    return positioned.withColumn(SEQ, F.coalesce("__position", unknown)).drop("__uri", "__position")


def within(size: Expr, bound: int, limit: int | None = None) -> Expr:
    """TRUE for records up to ``bound`` bytes; a longer one fails the job, which names ``limit`` if that is another number."""
    message = f"Record beyond the record limit of {(limit or bound) // 2**20} MiB"
    return F.when(size > bound, F.raise_error(F.lit(message)).cast("boolean")).otherwise(F.lit(True))


def cell_bytes(cells: Sequence[str | Expr]) -> Expr:
    """Size of a record: the bytes of its cells, without quotes and commas."""
    return sum((F.coalesce(F.octet_length(c), F.lit(0)).cast("bigint") for c in cells), F.lit(0))


def probe(spark: SparkSession, paths: Sequence[str], sealed: Sequence[bool]) -> list[ChangeFile]:
    """Look at the first bytes of each file; ``sealed`` files are encrypted and not opened."""
    with ThreadPoolExecutor(max_workers=min(32, max(1, len(paths)))) as pool:
        return list(pool.map(lambda args: _probe(spark, *args), zip(range(len(paths)), paths, sealed)))


def _probe(spark: SparkSession, seq: int, path: str, sealed: bool) -> ChangeFile:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    location = jvm.org.apache.hadoop.fs.Path(path)
    try:
        fs = location.getFileSystem(conf)
        status = fs.getFileStatus(location)
        qualified = status.getPath()
        uri = re.sub(_LOCAL, "file:/", qualified.toUri().toString())
        facts = (seq, path, qualified.toString(), uri, status.getLen())
        if sealed:
            return ChangeFile(*facts, direct=False, compressed=False, header=None)
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(location)
        stream = fs.open(location)
        try:
            zstd = status.getLen() >= 4 and stream.readInt() & 0xFFFFFFFF == ZSTD_MAGIC
            by_name = location.getName().endswith(_ZSTD_ENDINGS)
            if zstd != by_name or (codec is not None and not zstd):
                return ChangeFile(*facts, direct=False, compressed=zstd, header=None)
            stream.seek(0)
            content = jvm.com.github.luben.zstd.ZstdInputStreamNoFinalizer(stream) if zstd else stream
            reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(content, "UTF-8"))
            return ChangeFile(*facts, direct=True, compressed=zstd, header=_header(path, reader.readLine))
        finally:
            stream.close()
    except Py4JJavaError as e:
        raise ChangeError(f"Failed to open file <{path}>: {e.java_exception.getMessage()}") from e


def _header(path: str, read_line) -> tuple[str, ...]:
    text = read_line()
    while text is not None and is_open(text):
        more = read_line()
        if more is None:
            break
        text = f"{text}\n{more}"
    return parse_header(path, text or "")


def is_open(text: str) -> bool:
    """Whether a record that starts with ``text`` goes on in the next line, by the rule that the split reading follows."""
    return re.sub(r'(?s)^.*[^,]"', "", text.replace('""', "")).count('"') % 2 == 1


def parse_header(path: str, text: str) -> tuple[str, ...]:
    names = next(csv.reader([text.removeprefix("﻿")]), [])
    if not names or len(set(names)) != len(names):
        raise ChangeError(f"File <{path}> has no usable header: {names}")
    return tuple(names)
