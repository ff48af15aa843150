"""Tables as versioned parquet folders with atomic publishing.

A table is a folder with data below ``data/`` and one small commit file per version below ``commits/``. A
commit names, for each bucket of the key, the data folder that holds its rows, together with columns, key
and defaults. Every write goes to a data folder of its own and the commit file comes last and is never
overwritten: a job that dies leaves the last version in force, and the slower of two writers fails.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column as Expr
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import ChangeError
from ..model import KeyedTable, SystemColumns, TableSpec

BUCKET = "__bucket"

#: File systems whose rename is one step and refuses a name that is taken.
_EXCLUSIVE_RENAME = ("hdfs", "abfs", "abfss")
# Fixed value: the file system option for a write that only succeeds where nothing is yet.
_ONLY_IF_ABSENT = "fs.option.create.conditional.overwrite"


@dataclass(frozen=True)
class Commit:
    version: int
    schema: dict
    #: Key columns the buckets are cut by, and their number; one bucket means an unbucketed table.
    bucket_keys: tuple[str, ...]
    buckets: int
    #: Bucket -> data folder with its rows. A bucket without rows is missing.
    folders: dict[int, str]
    #: Dropped columns that data files may still hold; a new column of that name needs a rewrite.
    retired: tuple[str, ...]
    #: Position in a change stream, so that a repeated micro-batch is recognised.
    stream: dict[str, int]

    def to_json(self) -> str:
        return json.dumps({**self.__dict__, "folders": {str(k): v for k, v in self.folders.items()}})

    @classmethod
    def from_json(cls, text: str) -> Commit:
        raw = json.loads(text)
        raw["bucket_keys"], raw["retired"] = tuple(raw["bucket_keys"]), tuple(raw["retired"])
        raw["folders"] = {int(k): v for k, v in raw["folders"].items()}
        return cls(**raw)


class VersionedTable:
    """A published table at a path that all executors reach."""

    def __init__(self, spark: SparkSession, path: str, system: SystemColumns | None = None) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.system = system or SystemColumns()

    @classmethod
    def create(cls, spark: SparkSession, path: str, spec: TableSpec, *, buckets: int = 1) -> VersionedTable:
        """An empty table. ``buckets`` > 1 lets small batches rewrite only the buckets they touch."""
        table = cls(spark, path, spec.system)
        if table.exists():
            raise ChangeError(f"Table <{path}> already exists")
        if buckets > 1 and not spec.source_keys:
            raise ChangeError("A bucketed table needs a key")
        table._commit(Commit(1, spec.schema().jsonValue(), tuple(spec.source_keys), buckets, {}, (), {}))
        return table

    def exists(self) -> bool:
        return bool(self.versions())

    def versions(self) -> list[int]:
        folder = self._path("commits")
        fs = self._fs()
        if not fs.exists(folder):
            return []
        names = (status.getPath().getName() for status in fs.listStatus(folder))
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def head(self, version: int | None = None) -> Commit:
        versions = self.versions()
        if not versions:
            raise ChangeError(f"Table <{self.path}> not found")
        stream = self._fs().open(self._path(f"commits/{version or versions[-1]:010d}.json"))
        try:
            reader = self._jvm().java.io.InputStreamReader(stream, "UTF-8")
            return Commit.from_json(self._jvm().java.io.BufferedReader(reader).readLine())
        finally:
            stream.close()

    def read(self, buckets: set[int] | None = None, version: int | None = None) -> KeyedTable:
        """The table, or some buckets of it, as of a version."""
        commit = self.head(version)
        spec = self.spec(commit)
        paths = [
            f"{self.path}/data/{folder}/{BUCKET}={bucket}"
            for bucket, folder in sorted(commit.folders.items())
            if buckets is None or bucket in buckets
        ]
        if not paths:
            return KeyedTable(self.spark.createDataFrame([], spec.schema()), spec)
        return KeyedTable(self.spark.read.schema(spec.schema()).parquet(*paths), spec)

    def spec(self, commit: Commit | None = None) -> TableSpec:
        schema = T.StructType.fromJson((commit or self.head()).schema)
        return TableSpec.from_schema(schema, self.system)

    def touched(self, keys: DataFrame, commit: Commit) -> set[int]:
        """Buckets that hold the given keys: at most as many numbers as there are buckets."""
        found = keys.select(bucket_of(commit.bucket_keys, commit.buckets).alias(BUCKET)).distinct()
        return {row[BUCKET] for row in found.collect()}

    def publish(
        self,
        state: KeyedTable,
        *,
        settled: DataFrame | None = None,
        buckets: set[int] | None = None,
        base: Commit | None = None,
        stream: dict[str, int] | None = None,
        rebalance: bool = True,
    ) -> Commit:
        """Write the new state of the table, or of ``buckets`` only, and make it the current version.

        ``base`` is the version the state was computed from; if another one was published since, the
        commit fails and nothing changes.

        Rows of a bucketed table are brought together by bucket. ``settled`` rows, and with
        ``rebalance=False`` all rows, still lie bucket by bucket as they were read and need no shuffle.
        """
        base = base or self.head()
        version, spec = base.version + 1, state.spec
        bucket_keys = base.bucket_keys
        if tuple(spec.source_keys) != bucket_keys:
            bucket_keys = tuple(spec.source_keys)
            if buckets is not None:
                raise ChangeError("A key change rewrites the whole table")
        count = base.buckets if bucket_keys else 1

        def prepared(df: DataFrame) -> DataFrame:
            typed = df.select(*[F.col(c.name).cast(c.dtype).alias(c.name) for c in spec.columns])
            return typed.withColumn(BUCKET, bucket_of(bucket_keys, count) if count > 1 else F.lit(0))

        rows = prepared(state.df)
        if count > 1 and rebalance:
            # Splits a bucket of any size over several tasks and joins small ones.
            rows = rows.hint("rebalance", BUCKET)
        if settled is not None:
            rows = rows.unionByName(prepared(settled))
        folder = f"{version:010d}-{uuid.uuid4().hex}"
        rows.write.partitionBy(BUCKET).parquet(f"{self.path}/data/{folder}")
        kept = {} if buckets is None else {b: f for b, f in base.folders.items() if b not in buckets}
        written = {b: folder for b in self._written(folder)}
        commit = Commit(
            version,
            spec.schema().jsonValue(),
            bucket_keys,
            count,
            {**kept, **written},
            base.retired if kept else (),
            {**base.stream, **(stream or {})},
        )
        self._commit(commit)
        return commit

    def evolve(self, spec: TableSpec, base: Commit) -> Commit | None:
        """Change the specification without rewriting data, where the stored files allow it; else None.

        That is so if columns are only dropped, or added without values, and the bucketing stays.
        """
        old = self.spec(base)
        added = [c for c in spec.columns if c.name not in old]
        dropped = [c.name for c in old.columns if c.name not in spec]
        fits = (
            all(c.default is None and not c.key and c.name not in base.retired for c in added)
            and all(old[c.name].dtype == c.dtype for c in spec.columns if c.name in old)
            and (base.buckets == 1 or tuple(spec.source_keys) == base.bucket_keys)
        )
        if not fits:
            return None
        commit = replace(
            base,
            version=base.version + 1,
            schema=spec.schema().jsonValue(),
            bucket_keys=tuple(spec.source_keys),
            retired=tuple(sorted({*base.retired, *dropped})),
        )
        self._commit(commit)
        return commit

    def expire(self, keep: int = 1) -> None:
        """Forget all but the last ``keep`` versions, and delete the bucket folders only they used.

        Folders of versions not yet published are left alone, as someone may be writing them.
        """
        versions = self.versions()
        kept, old = versions[-keep:], versions[:-keep]
        used: dict[str, set[int]] = {}
        for version in kept:
            for bucket, folder in self.head(version).folders.items():
                used.setdefault(folder, set()).add(bucket)
        fs = self._fs()
        for version in old:
            fs.delete(self._path(f"commits/{version:010d}.json"), False)
        for status in fs.listStatus(self._path("data")) if fs.exists(self._path("data")) else []:
            folder = status.getPath().getName()
            if folder not in used:
                if int(folder.split("-", 1)[0]) <= kept[-1]:
                    fs.delete(status.getPath(), True)
                continue
            for bucket in self._written(folder):
                if bucket not in used[folder]:
                    fs.delete(self._path(f"data/{folder}/{BUCKET}={bucket}"), True)

    def _written(self, folder: str) -> list[int]:
        names = [s.getPath().getName() for s in self._fs().listStatus(self._path(f"data/{folder}"))]
        return [int(n.split("=", 1)[1]) for n in names if n.startswith(f"{BUCKET}=")]

    def _commit(self, commit: Commit) -> None:
        """Put the commit file in place in one step that fails if there is one, so that of several writers one wins.

        Local files are written aside and linked, HDFS and hierarchical stores rename, S3 takes a conditional
        write. Other stores offer no such step here and are refused.
        """
        self._fs().mkdirs(self._path("commits"))
        folder = self._fs().resolvePath(self._path("commits"))
        fs = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        scheme, hadoop = folder.toUri().getScheme(), self._jvm().org.apache.hadoop.fs.Path
        target, aside = hadoop(folder, f"{commit.version:010d}.json"), hadoop(folder, f".{commit.version:010d}.{uuid.uuid4().hex}")
        content = bytearray(commit.to_json().encode())
        try:
            if scheme == "s3a":
                out = fs.createFile(target).overwrite(False).must(_ONLY_IF_ABSENT, True).build()
                out.write(content)
                out.close()
                return
            if scheme != "file" and scheme not in _EXCLUSIVE_RENAME:
                raise ChangeError(f"Tables cannot be published safely on <{scheme}>")
            out = fs.create(aside, False)
            out.write(content)
            out.close()
            if scheme == "file":
                here, there = (self._jvm().java.io.File(p.toUri().getPath()).toPath() for p in (aside, target))
                self._jvm().java.nio.file.Files.createLink(there, here)
                won = True
            else:
                won = fs.rename(aside, target)
        except Py4JJavaError as e:
            if not fs.exists(target):
                raise
            won, cause = False, e
        else:
            cause = None
        fs.delete(aside, False)
        if not won:
            raise ChangeError(f"Version {commit.version} of <{self.path}> was published by someone else") from cause

    def _jvm(self):
        return self.spark.sparkContext._jvm

    def _path(self, name: str):
        return self._jvm().org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _fs(self):
        return self._path("commits").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())


def bucket_of(keys: tuple[str, ...], buckets: int) -> Expr:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
