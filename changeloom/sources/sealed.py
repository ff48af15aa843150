"""Change files that Spark's CSV source cannot open: encrypted, or zstd without the file ending.

Executors read them in pieces. A cipher block needs only the block before it, so an encrypted file is cut into ranges; a
zstd file is cut between its frames, whose borders one task finds from their headers, without decompressing. Every piece
is decrypted or decompressed and cut into lines where it is read, and the ends of lines that lie in several pieces are
put together. From there on the lines take the way of large files, so records are told apart and parsed by many tasks
and by the same rules. Encrypted zstd files, and those that Arrow's file systems do not reach, are one piece of less than
2 GiB on disk.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column as Expr
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from ..errors import ChangeError
from ..model import ReadOptions
from ..operators.merge import SEQ
from ..session import scratch_path, set_for, ship_package
from .files import ZSTD_MAGIC, ChangeFile, is_open, parse_header, within
from .records import _BLOCK, _LINE, parse_lines, told

_KEYS = "path string, uri string, key binary, seq int, size long"
_PIECES = "path string, uri string, seq int, piece long, start long, size long"
_CUT = f"path string, {SEQ} int, {_BLOCK} long, {_LINE} long, part int, value binary"
#: Bytes read at once, and bytes of a block, whose lines are brought together.
_READ, _BLOCK_BYTES = 4 << 20, 1 << 24
_BATCH, _BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 1 << 20
#: Bytes of a file, as stored, that are a task at least.
PIECE = 16 << 20
#: Bytes of a file to be written, before it is encrypted. The task holds it several times: as text, encrypted, in Python.
FILE = 8 << 20
#: Blocks are numbered through a file: those of a piece follow those of the piece before.
_BLOCKS = 1 << 24
#: A cipher block; the first of a file is the random one.
_CIPHER = 16
#: The first four bytes, read in the order of the machine, of zstd frames and of frames to be skipped.
_FRAME, _SKIPPED = 0xFD2FB528, range(0x184D2A50, 0x184D2A60)
#: What a row of a cut piece is: a line, or the end, the start or a middle part of one that other pieces share.
_WHOLE, _HEAD, _TAIL, _THROUGH = range(4)
_FIRST, _LAST = -1, 1 << 62
#: Where Arrow can read.
_REACHED = re.compile("^(file|hdfs|s3a?|gs|abfss?):")


def read_sealed(
    spark: SparkSession,
    members: Sequence[ChangeFile],
    header: Sequence[str],
    names: Sequence[str],
    parser: dict[str, str],
    options: ReadOptions,
) -> DataFrame:
    """Text cells ``names`` of files that share a header, and the file position."""
    limit = options.record_bytes
    longest = 2 * limit + 3 * len(header)
    # What follows looks at the lines several times; files are opened once.
    path = scratch_path(spark, "cut-lines")
    # Python workers get one piece at once.
    with set_for(spark, _BATCH, str(_BATCH_BYTES)):
        cut_lines(spark, members, options, longest).write.option("compression", "zstd").parquet(path)
    lines = joined_lines(spark.read.schema(_CUT).parquet(path), longest, limit)
    value = F.col("value").cast("string")
    return parse_lines(lines.select(SEQ, _BLOCK, _LINE, *told(value, F.col("path"))), header, names, parser, limit)


def cut_lines(spark: SparkSession, members: Sequence[ChangeFile], options: ReadOptions, longest: int) -> DataFrame:
    """The lines of all pieces, and the parts of lines that pieces share."""
    limit = options.record_bytes

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, path, seq, piece in zip(*(batch.column(c) for c in ("content", "path", "seq", "piece"))):
                with _plain(content.as_buffer(), packed=piece.as_py() == 0) as stream:
                    yield from _lines(stream, path.as_py(), seq.as_py(), piece.as_py(), longest, limit)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            with pa.CompressedInputStream(_stretch(row), "zstd") as stream:
                yield from _lines(stream, row["path"], row["seq"], row["piece"], longest, limit)

    kinds: dict[str, list[ChangeFile]] = {}
    for f in members:
        kind = "cipher" if f.path in options.keys else "frames"
        # Zstd frames cannot be found before they are decrypted.
        kinds.setdefault(kind if _reached(f) and f.compressed == (kind == "frames") else "whole", []).append(f)
    parts = []
    if whole := kinds.get("whole"):
        # What is in them shows once they are open.
        parts.append(_contents(spark, whole, options).select("content", "path", "seq", F.lit(0).cast("long").alias("piece")).mapInArrow(cut, _CUT))
    if cipher := kinds.get("cipher"):
        parts.append(_deciphered(spark, cipher, options, PIECE).mapInArrow(cut, _CUT))
    if frames := kinds.get("frames"):
        parts.append(_frames(spark, frames, options, PIECE).mapInArrow(unpack, _CUT))
    return reduce(DataFrame.unionByName, parts)


def joined_lines(cut: DataFrame, longest: int, limit: int) -> DataFrame:
    """Lines of files from those of their pieces. Only the first and the last line of a piece are compared with others."""
    whole = cut.filter(F.col("part") == _WHOLE).select("path", SEQ, _BLOCK, _LINE, "value")
    ordered = Window.partitionBy(SEQ).orderBy(_BLOCK, _LINE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begun = F.last(F.when(F.col("part") == _TAIL, F.col(_BLOCK)), ignorenulls=True).over(ordered)
    shared = cut.filter(F.col("part") != _WHOLE).withColumn("begun", F.coalesce(begun, F.lit(_FIRST)))
    size = F.sum(F.octet_length("value").cast("long")).over(Window.partitionBy(SEQ, "begun"))
    shared = shared.withColumn("bytes", size).filter(within(F.col("bytes"), longest, limit))
    pieces = F.array_sort(F.collect_list(F.struct(_BLOCK, _LINE, F.col("value").cast("string").alias("value"))))
    text = F.array_join(F.transform(pieces, lambda p: p["value"]), "")
    lines = shared.groupBy(SEQ, "begun").agg(
        F.min("path").alias("path"), text.cast("binary").alias("value"), F.bool_or(F.col("part") == _HEAD).alias("ended")
    )
    # Behind the last line break of a file there is no line, unless something stands there.
    lines = lines.filter(F.col("ended") | (F.octet_length("value") > 0)).select(
        "path",
        SEQ,
        F.greatest("begun", F.lit(0)).alias(_BLOCK),
        F.when(F.col("begun") == _FIRST, F.lit(_FIRST)).otherwise(F.lit(_LAST)).cast("long").alias(_LINE),
        "value",
    )
    return whole.unionByName(lines)


def sealed_headers(spark: SparkSession, files: Sequence[ChangeFile], options: ReadOptions) -> dict[int, tuple[tuple[str, ...], bool]]:
    """Column names of each file by its position, and whether it is zstd inside; found on executors, from its first bytes."""

    def first_record(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, packed = [], []
            for content in batch.column("content"):
                buffer = content.as_buffer()
                packed.append(_is_zstd(buffer))
                with _plain(buffer) as stream:
                    lines = _some(stream, _READ).decode("utf-8", "replace").split("\n")
                text = lines.pop(0)
                while lines and is_open(text):
                    text = f"{text}\n{lines.pop(0)}"
                found.append(text)
            columns = [batch.column("seq"), pa.array(found, pa.string()), pa.array(packed, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["seq", "line", "packed"])

    near, far = [f for f in files if _reached(f)], [f for f in files if not _reached(f)]
    parts = [_beginnings(spark, near, options)] if near else []
    if far:
        parts.append(_contents(spark, far, options).select("content", "seq"))
    rows = reduce(DataFrame.unionByName, parts).mapInArrow(first_record, "seq int, line string, packed boolean").collect()
    paths = {f.seq: f.path for f in files}
    return {r["seq"]: (parse_header(paths[r["seq"]], r["line"]), r["packed"]) for r in rows}


def _reached(f: ChangeFile) -> bool:
    return bool(_REACHED.match(f.uri))


def _listed(spark: SparkSession, files: Sequence[ChangeFile], options: ReadOptions) -> DataFrame:
    ship_package(spark)
    return spark.createDataFrame([(f.name, f.uri, options.keys.get(f.path), f.seq, f.size) for f in files], _KEYS)


def _contents(spark: SparkSession, files: Sequence[ChangeFile], options: ReadOptions) -> DataFrame:
    content = spark.read.format("binaryFile").load([f.pattern for f in files]).select("path", "content")
    keyed = content.join(F.broadcast(_listed(spark, files, options).select("path", "key", "seq")), "path")
    return keyed.select(_deciphers(F.lit(True)).alias("content"), "path", "seq")


def _deciphers(to_the_end: Expr) -> Expr:
    """``content`` decrypted, if there is a key: some cipher blocks behind the one before them.

    Padding is checked where the file ends. Elsewhere a block that holds nothing but padding is added.
    """
    mode = (F.lit("CBC"), F.lit("PKCS"))
    padding = F.substring(F.aes_encrypt(F.lit(b""), F.col("key"), *mode, F.substring("content", -_CIPHER, _CIPHER)), _CIPHER + 1, _CIPHER)
    closed = F.when(to_the_end, F.col("content")).otherwise(F.concat("content", padding))
    return F.when(F.col("key").isNotNull(), F.aes_decrypt(closed, F.col("key"), *mode)).otherwise(F.col("content"))


def _read(pieces: DataFrame, more: str) -> DataFrame:
    """``pieces`` (path, uri, seq, piece, start, size, and ``more``) with their ``content``."""
    kept = [n.split()[0] for n in more.split(", ")]

    def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, row in enumerate(batch.to_pylist()):
                one = batch.slice(k, 1)
                with _stretch(row) as stream:
                    content = pa.array([stream.read(row["size"])], pa.binary())
                yield pa.RecordBatch.from_arrays([*(one.column(n) for n in kept), content], [*kept, "content"])

    return pieces.mapInArrow(contents, f"{more}, content binary")


def _deciphered(spark: SparkSession, files: Sequence[ChangeFile], options: ReadOptions, piece: int) -> DataFrame:
    """The plain bytes (content) of ranges of ``piece`` bytes of encrypted files."""
    ranges = [max(1, -(-(f.size - _CIPHER) // piece)) for f in files]
    listed = _listed(spark, files, options).withColumnRenamed("size", "whole")
    last = F.greatest(F.lit(0), F.ceil((F.col("whole") - _CIPHER) / piece) - 1)
    pieces = listed.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long")))).select(
        "*", (F.col("piece") * piece).alias("start"), F.lit(piece + _CIPHER).cast("long").alias("size"), (F.col("piece") == last).alias("ends")
    )
    read = _read(pieces.repartition(sum(ranges)), "path string, key binary, seq int, piece long, ends boolean")
    return read.select("path", "seq", "piece", _deciphers(F.col("ends")).alias("content"))


def _beginnings(spark: SparkSession, files: Sequence[ChangeFile], options: ReadOptions) -> DataFrame:
    """The first plain bytes (content) of files; those of zstd files are not decompressed."""
    listed = _listed(spark, files, options).withColumn("ends", F.col("size") <= _READ + _CIPHER)
    pieces = listed.withColumn("start", F.lit(0).cast("long")).withColumn("size", F.lit(_READ + _CIPHER).cast("long"))
    read = _read(pieces.repartition(len(files)), "key binary, seq int, ends boolean")
    return read.select(_deciphers(F.col("ends")).alias("content"), "seq")


def _frames(spark: SparkSession, files: Sequence[ChangeFile], options: ReadOptions, piece: int) -> DataFrame:
    """Stretches of whole frames, ``piece`` bytes or more each, of zstd files."""

    def borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            with _stretch({**row, "start": 0}) as stream:
                found, start = [], 0
                for end in _frame_ends(stream, row["path"]):
                    if end - start >= piece:
                        found.append((start, end))
                        start = end
            if start < row["size"]:
                found.append((start, row["size"]))
            rows = [
                {**{n: row[n] for n in ("path", "uri", "seq")}, "piece": k, "start": a, "size": b - a} for k, (a, b) in enumerate(found)
            ]
            types = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            names = [n.split()[0] for n in _PIECES.split(", ")]
            yield pa.RecordBatch.from_pylist(rows, pa.schema(list(zip(names, types, strict=True))))

    listed = _listed(spark, files, options).select("path", "uri", "seq", "size").repartition(len(files))
    return listed.mapInArrow(borders, _PIECES).repartition(sum(1 + f.size // piece for f in files))


def _frame_ends(stream: pa.NativeFile, path: str) -> Iterator[int]:
    """Where the frames of a zstd file end, by the headers of frames and of the blocks in them."""
    held, at = b"", 0  # bytes read, and the position of the first of them

    def number(position: int, size: int) -> int:
        nonlocal held, at
        if position + size > at + len(held):
            stream.seek(position)
            held, at = _some(stream, _READ), position
        found = held[position - at : position - at + size]
        if len(found) < size:
            raise ChangeError(f"File <{path}> ends inside a zstd frame")
        return int.from_bytes(found, "little")

    position, size = 0, stream.size()
    while position < size:
        magic = number(position, 4)
        if magic in _SKIPPED:
            position += 8 + number(position + 4, 4)
        elif magic == _FRAME:
            told_by = number(position + 4, 1)
            alone = told_by >> 5 & 1
            content = (alone, 2, 4, 8)[told_by >> 6]
            position += 5 + (1 - alone) + (0, 1, 2, 4)[told_by & 3] + content
            last = False
            while not last:
                block = number(position, 3)
                last = bool(block & 1)
                position += 3 + (1 if block >> 1 & 3 == 1 else block >> 3)
            position += 4 * (told_by >> 2 & 1)
        else:
            raise ChangeError(f"File <{path}> holds something else than zstd frames")
        if position > size:
            raise ChangeError(f"File <{path}> ends inside a zstd frame")
        yield position


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    return (row for batch in batches for row in batch.to_pylist())


def _located(path: str) -> tuple[fs.FileSystem, str]:
    local = re.sub("^file:/+", "/", path)
    if "://" not in local:
        return fs.LocalFileSystem(), local
    return fs.FileSystem.from_uri(re.sub("^s3a:", "s3:", local))


def _stretch(row: dict) -> pa.NativeFile:
    """The bytes of a file from ``start`` on, ``size`` of them at most."""
    files, path = _located(row["path"] if row["uri"].startswith("file:") else row["uri"])
    source = files.open_input_file(path)
    size = source.size()
    if row["start"] == 0 and row["size"] >= size:
        return source
    return source.get_stream(row["start"], min(row["size"], size - row["start"]))


def _some(stream: pa.NativeFile, size: int) -> bytes:
    """``size`` bytes, fewer only at the end."""
    found = []
    while size and (data := stream.read(size)):
        found.append(data)
        size -= len(data)
    return b"".join(found)


def _is_zstd(buffer: pa.Buffer) -> bool:
    return buffer.size >= 4 and int.from_bytes(buffer.slice(0, 4).to_pybytes(), "big") == ZSTD_MAGIC


def _plain(buffer: pa.Buffer, packed: bool = True) -> pa.NativeFile:
    source = pa.BufferReader(buffer)
    return pa.CompressedInputStream(source, "zstd") if packed and _is_zstd(buffer) else source


def _lines(stream: pa.NativeFile, path: str, seq: int, piece: int, longest: int, limit: int) -> Iterator[pa.RecordBatch]:
    """The lines of a piece, and what stands before its first and behind its last line break; a line of more than ``longest`` bytes fails before all of it is held."""
    done = number = 0
    broken = False

    def batch(lines: list[bytes], at: int | None = None, part: int = _WHOLE) -> pa.RecordBatch:
        n = len(lines)
        block = piece * _BLOCKS + (0 if at == _FIRST else done // _BLOCK_BYTES)
        numbers = pa.array(range(number, number + n) if at is None else [at], pa.int64())
        columns = [pa.array([path] * n, pa.string()), pa.array([seq] * n, pa.int32()), pa.array([block] * n, pa.int64()), numbers]
        columns += [pa.array([part] * n, pa.int32()), pa.array(lines, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["path", SEQ, _BLOCK, _LINE, "part", "value"])

    held: list[bytes] = []
    size = 0
    while data := stream.read(_READ):
        first, *rest = data.split(b"\n")
        held.append(first)
        size += len(first)
        if size > longest:
            raise ChangeError(f"Record beyond the record limit of {limit // 2**20} MiB in file <{path}>")
        if rest:
            lines = [b"".join(held), *rest[:-1]]
            if not broken:
                yield batch([lines.pop(0)], _FIRST, _HEAD)
                broken = True
            if lines:
                yield batch(lines)
            held, size, number = [rest[-1]], len(rest[-1]), number + len(lines)
        done += len(data)
    yield batch([b"".join(held)], _LAST, _TAIL) if broken else batch([b"".join(held)], _FIRST, _THROUGH)
    # Workers wait for other tasks; what the last piece took need not wait with them.
    pa.default_memory_pool().release_unused()


class WholeFiles(DataSource):
    """Spark data source that writes each row (name, content) as one file below ``path``.

    It writes where Arrow's file systems reach: local and mounted folders, HDFS, S3, GCS and Azure.
    """

    @classmethod
    def name(cls) -> str:
        return "changeloom_files"

    def schema(self) -> str:
        return "name string, content binary"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options["path"])


@dataclass
class _Written(WriterCommitMessage):
    """Files of a task, by the names they are to get and those they have until all tasks are done."""

    names: list[tuple[str, str]]


class _Writer(DataSourceWriter):
    """Files get their names once all tasks are done, so attempts that were lost or ran twice leave none behind."""

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
        files, base = _located(self.path)
        files.create_dir(base, recursive=True)
        names = []
        for row in iterator:
            hidden = f".{row.name}.{uuid.uuid4().hex}"
            with files.open_output_stream(f"{base}/{hidden}") as out:
                out.write(row.content)
            names.append((hidden, row.name))
        return _Written(names)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        self._each(messages, lambda files, hidden, name: files.move(hidden, name))

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._each(messages, lambda files, hidden, name: files.delete_file(hidden))

    def _each(self, messages: list[WriterCommitMessage | None], do) -> None:
        files, base = _located(self.path)
        names = [n for m in messages if m for n in m.names]
        with ThreadPoolExecutor(max_workers=32) as pool:
            list(pool.map(lambda n: do(files, f"{base}/{n[0]}", f"{base}/{n[1]}"), names))


def write_sealed(df: DataFrame, path: str, key: bytes, files: int, null_value: str, *, file_bytes: int = FILE) -> list[str]:
    """Rows as encrypted change files below ``path``, written by executors; returns their paths.

    ``files`` tasks at most take whole partitions, and start another file where one would exceed ``file_bytes`` before it
    is encrypted: a file is encrypted whole (AES-CBC, a random first block), so that is what a task holds, or one record, if
    that is longer. Texts are quoted, NULL is ``null_value``. Without rows there is one file that holds the header alone.
    """
    spark = df.sparkSession
    ship_package(spark)
    spark.dataSource.register(WholeFiles)
    quoted = [
        F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')) if t == "string" else F.col(c).cast("string") for c, t in df.dtypes
    ]
    line = F.concat_ws(",", *[F.coalesce(c, F.lit(null_value)) for c in quoted])
    header = ",".join(df.columns).encode()

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId()
        for number, text in enumerate(_texts(batches, header, file_bytes)):
            names = pa.array([f"part-{place:05d}-{number:05d}.csv.aes"], pa.string())
            yield pa.RecordBatch.from_arrays([names, pa.array([text], pa.binary())], ["name", "text"])

    def write(texts: DataFrame) -> list[str]:
        sealed = F.aes_encrypt(F.col("text"), F.lit(key), F.lit("CBC"), F.lit("PKCS")).alias("content")
        rows = texts.select("name", sealed)
        # Python workers get one file at once, or some lines.
        with set_for(spark, _BATCH, str(_BATCH_BYTES)):
            rows.write.format(WholeFiles.name()).mode("append").option("path", path).save()
        return sorted(r["path"] for r in spark.read.format("binaryFile").load(path).select("path").collect())

    # No key decides where a row goes, so nothing is shuffled and equal rows need not meet in one file.
    lines = df.coalesce(files).select(line.cast("binary").alias("line"))
    written = write(lines.mapInArrow(gathered, "name string, text binary"))
    if written:
        return written
    return write(spark.range(1).select(F.lit("part-00000-00000.csv.aes").alias("name"), F.lit(header + b"\n").alias("text")))


def _texts(batches: Iterator[pa.RecordBatch], header: bytes, limit: int) -> Iterator[bytes]:
    """Lines below a header, as texts of up to ``limit`` bytes; one line at least is in each."""
    held, size = [header], len(header) + 1
    for batch in batches:
        for line in batch.column(0).to_pylist():
            if len(held) > 1 and size + len(line) >= limit:
                text = b"\n".join([*held, b""])
                held, size = [header], len(header) + 1
                yield text
            held.append(line)
            size += len(line) + 1
    if len(held) > 1:
        yield b"\n".join([*held, b""])
    pa.default_memory_pool().release_unused()
