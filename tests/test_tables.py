"""Published tables, whole batches of files, migrations by name, and the request stream."""

import json
import os
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

import pytest
from helpers import END, SYS, rows, ts
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom import BatchFiles, ChangeError, Column, ReadOptions, TableSpec, UnsupportedMigration, UserActionError
from changeloom.functions import skew
from changeloom.operators import history, merge
from changeloom.plans import batches
from changeloom.plans.migrations import alter_table, migrate
from changeloom.sources.tables import BUCKET, VersionedTable
from changeloom.streaming.requests import follow

MARK, TOKEN = "same-42", "nil-7f3a"
OPTIONS = ReadOptions(null_value=TOKEN, unmodified=MARK)

BOOKS = TableSpec(
    (
        Column("id", T.IntegerType(), key=True),
        Column("title", T.StringType()),
        Column("n", T.IntegerType()),
        Column(SYS.deleted, T.BooleanType()),
        Column(SYS.synced, T.TimestampType()),
    )
)
VERSIONS = TableSpec(
    (
        Column("id", T.IntegerType(), key=True),
        Column("title", T.StringType()),
        Column(SYS.start, T.TimestampType(), key=True),
        Column(SYS.end, T.TimestampType()),
        Column(SYS.active, T.BooleanType()),
    )
)


@pytest.fixture(params=[1, 4], ids=["plain", "bucketed"])
def buckets(request):
    return request.param


@pytest.fixture(params=[True, False], ids=["small", "large"])
def size(request, monkeypatch):
    """Batches as they are, or taken for too large to be broadcast."""
    if not request.param:
        for module in (batches, merge, history, skew):
            monkeypatch.setattr(module, "fits_broadcast", lambda *_: False)


@pytest.fixture
def put(tmp_path):
    def write(name, header, *lines):
        path = tmp_path / name
        path.write_text("\n".join([header, *lines]) + "\n")
        return str(path)

    return write


HEADER = f"id,title,n,{SYS.deleted},{SYS.synced}"


def test_life_cycle(spark, tmp_path, put, buckets, size):
    table = VersionedTable.create(spark, str(tmp_path / "books"), BOOKS, buckets=buckets)
    assert rows(table.read()) == [] and table.spec() == BOOKS

    opened = put("1.csv", HEADER, "501,Mill Lane,7,false,2022-06-01T09:00:00.5Z", "502,Ferry Road,2,false,2022-06-01T09:00:00Z")
    batches.write_batch(table, BatchFiles(replace=(opened,)), OPTIONS)
    moved = put(
        "2.csv",
        HEADER,
        '502,"Ferry Road, pier",2,false,2022-06-03T10:30:00Z',
        f"640,{TOKEN},31,false,2022-06-03T10:30:00Z",
        "503,null,,false,2022-06-03T10:30:00.123456789Z".replace(",,", f",{TOKEN},"),
    )
    batches.write_batch(table, BatchFiles(replace=(moved,)), OPTIONS)
    assert rows(table.read(), "id", "title", "n") == [
        (501, "Mill Lane", 7),
        (502, "Ferry Road, pier", 2),
        (503, "null", None),
        (640, None, 31),
    ]

    counted = put(
        "3.csv",
        HEADER,
        f'640,"{MARK}",32,false,2022-07-01T23:59:59.999999999Z',
        f"502,Quay,{MARK},false,2022-07-02T00:00:00.000000000Z",
        f"503,{TOKEN},5,false,2022-07-01T08:00:00Z",
        "999,unknown,1,false,2022-07-01T08:00:00Z",
    )
    closed = put("4.csv", HEADER, f"501,{TOKEN},{TOKEN},true,2022-07-02T12:00:00Z")
    commit = batches.write_batch(table, BatchFiles(update=(counted,), delete=(closed,)), OPTIONS)
    expected = [(502, "Quay", 2), (503, None, 5), (640, None, 32)]
    assert rows(table.read(), "id", "title", "n") == expected
    assert commit.version == 4 and table.versions() == [1, 2, 3, 4]
    assert rows(table.read(version=2), "id") == [(501,), (502,)]

    table.expire(keep=2)
    assert table.versions() == [3, 4] and rows(table.read(), "id", "title", "n") == expected
    assert len(rows(table.read(version=3))) == 4
    assert len(list((tmp_path / "books" / "data").glob("0000000002-*/*=*"))) == (0 if buckets == 1 else 1)

    batches.truncate(table, SYS.synced, 1656720000 * 10**9, SYS.deleted)
    assert rows(table.read(), "id", SYS.deleted) == [(502, False), (503, True), (640, True)]
    batches.truncate(table, SYS.synced, None, SYS.deleted)
    assert rows(table.read(), "id", SYS.deleted) == [(502, False), (503, True), (640, True)]
    batches.truncate(table, SYS.synced, 1893456000 * 10**9)
    assert rows(table.read()) == [] and table.spec() == BOOKS
    assert batches.truncate(VersionedTable(spark, str(tmp_path / "none")), SYS.synced, 1) is None


def test_only_touched_buckets_are_written(spark, tmp_path, put):
    spec = TableSpec((Column("id", T.IntegerType(), key=True), Column("s", T.StringType())))
    table = VersionedTable.create(spark, str(tmp_path / "t"), spec, buckets=16)
    batches.load(table, spark.range(500).select(F.col("id").cast("int"), F.lit("old").alias("s")), check=True)
    before = table.head()
    assert len(before.folders) == 16
    batches.write_batch(table, BatchFiles(replace=(put("a.csv", "id,s", "7,new", "9999,more"),)))
    after = table.head()
    changed = {b for b in after.folders if after.folders[b] != before.folders.get(b)}
    assert 1 <= len(changed) <= 2
    written = {int(d.split("=")[1]) for d in os.listdir(tmp_path / "t" / "data" / after.folders[min(changed)]) if BUCKET in d}
    assert written == changed
    state = table.read()
    assert state.df.count() == 501 and rows(state.df.filter("s = 'new' OR id = 9999")) == [(7, "new"), (9999, "more")]
    # Emptying a bucket leaves it without folder.
    keep = sorted(after.folders)[0]
    keys = table.read({b for b in after.folders if b != keep}).df
    lines = [str(r[0]) for r in keys.select("id").collect()]
    batches.write_batch(table, BatchFiles(delete=(put("d.csv", "id", *lines),)))
    assert list(table.head().folders) == [keep]


def test_failed_batch_changes_nothing(spark, tmp_path, put, monkeypatch):
    scratch = tmp_path / "scratch"
    monkeypatch.setattr(batches, "scratch_path", lambda _, label: f"{scratch}/{label}")
    table = VersionedTable.create(spark, str(tmp_path / "t"), BOOKS)
    good = put("a.csv", HEADER, "1,Guide,42,false,2024-01-09T04:10:19Z")
    bad = put("b.csv", HEADER, "2,Rings,many,false,2024-01-09T04:10:19Z")
    with pytest.raises(Exception, match="CAST"):
        batches.write_batch(table, BatchFiles(replace=(good, bad)))
    assert table.versions() == [1]
    with pytest.raises(Exception, match="Key column <id> is NULL"):
        batches.write_batch(table, BatchFiles(replace=(good, put("n.csv", HEADER, ",x,1,false,"))))
    assert table.versions() == [1]
    with pytest.raises(ChangeError, match="belong to history"):
        batches.write_batch(table, BatchFiles(earliest=(good,)))
    with pytest.raises(ChangeError, match="table with a key"):
        keyless = VersionedTable.create(spark, str(tmp_path / "k"), BOOKS.with_keys([]))
        batches.write_batch(keyless, BatchFiles(replace=(good,)))
    with pytest.raises(ChangeError, match="already exists"):
        VersionedTable.create(spark, str(tmp_path / "t"), BOOKS)
    with pytest.raises(ChangeError, match="Table .* not found"):
        VersionedTable(spark, str(tmp_path / "missing")).read()
    big = put("big.csv", "id,title", f"1,{'x' * (25 * 2**20)}")
    assert os.listdir(scratch) == []  # nothing staged is left behind
    with pytest.raises(UserActionError, match="raise max_record_mib"):
        batches.write_batch(table, BatchFiles(replace=(big,)), columns=[BOOKS["id"], BOOKS["title"]])
    with pytest.raises(UserActionError, match="repeated"):
        twice = spark.createDataFrame([(1, "a", 1, None, None)] * 2, BOOKS.schema())
        batches.load(table, twice, check=True)


def test_one_of_several_writers_wins(spark, tmp_path):
    table = VersionedTable.create(spark, str(tmp_path / "t"), BOOKS)
    nexts = [replace(table.head(), version=2, stream={"writer": k}) for k in range(8)]

    def won(commit):
        try:
            table._commit(commit)
        except ChangeError:
            return None
        return commit.stream["writer"]

    with ThreadPoolExecutor(8) as pool:
        winners = [w for w in pool.map(won, nexts) if w is not None]
    assert [table.head().stream["writer"]] == winners
    assert table.versions() == [1, 2]


def test_truncation_leaves_other_buckets_alone(spark, tmp_path):
    table = VersionedTable.create(spark, str(tmp_path / "t"), BOOKS, buckets=8)
    batches.load(table, spark.createDataFrame([(i, "a", 1, False, ts(f"2024-01-{i:02} 00:00:00")) for i in range(1, 29)], BOOKS.schema()))
    before = table.head().folders
    batches.truncate(table, SYS.synced, 1_704_153_600 * 10**9)  # 2024-01-02: one row is older
    assert {r[0] for r in rows(table.read(), "id")} == set(range(2, 29))
    changed = {b for b, folder in before.items() if table.head().folders.get(b) != folder}
    assert len(changed) == 1
    batches.truncate(table, SYS.synced, 0)
    assert {r[0] for r in rows(table.read(), "id")} == set(range(2, 29))


def test_another_default_writes_no_data(spark, tmp_path):
    table = VersionedTable.create(spark, str(tmp_path / "t"), BOOKS)
    batches.load(table, spark.createDataFrame([(1, "a", 1, False, None)], BOOKS.schema()))
    folders = table.head().folders
    migrate(table, "add_column_with_default_value", column=Column("n", T.IntegerType(), default="7"))
    assert table.spec()["n"].default == "7" and table.head().folders == folders
    assert rows(table.read(), "id", "n") == [(1, 1)]


def test_versions_sent_again_are_refused(spark, tmp_path, put, size):
    table = VersionedTable.create(spark, str(tmp_path / "h"), VERSIONS, buckets=4)
    head = f"id,title,{SYS.start},{SYS.end},{SYS.active}"
    first = put("first.csv", head, f"1,a,2024-01-01T00:00:00Z,{END},true", f"2,b,2024-01-01T00:00:00Z,{END},true")
    batches.write_history_batch(table, BatchFiles(replace=(first,)), OPTIONS)
    with pytest.raises(UserActionError, match="key of their own"):
        batches.write_history_batch(table, BatchFiles(replace=(first,)), OPTIONS)
    unkeyed = put("unkeyed.csv", head, f"3,c,{TOKEN},{END},true")
    with pytest.raises(UserActionError, match="key of their own"):
        batches.write_history_batch(table, BatchFiles(replace=(unkeyed,)), OPTIONS)
    starts = put("starts.csv", f"id,{SYS.start}", "1,2024-01-01T00:00:00Z", "2,2024-01-01T00:00:00Z")
    batches.write_history_batch(table, BatchFiles(replace=(first,), earliest=(starts,)), OPTIONS)
    assert rows(table.read(), "id", "title") == [(1, "a"), (2, "b")]


def test_slower_writer_fails(spark, tmp_path):
    table = VersionedTable.create(spark, str(tmp_path / "t"), BOOKS)
    base = table.head()
    row = spark.createDataFrame([(1, "a", 1, False, None)], BOOKS.schema())
    state = table.read(version=base.version)
    table.publish(state.with_df(row), base=base)
    with pytest.raises(ChangeError, match="published by someone else"):
        table.publish(state.with_df(row.limit(0)), base=base)
    assert rows(table.read(), "id") == [(1,)]


def test_history_batch_from_files(spark, tmp_path, put, buckets, size):
    table = VersionedTable.create(spark, str(tmp_path / "h"), VERSIONS, buckets=buckets)
    header = f"{SYS.end},{SYS.active},title,{SYS.start},id"
    initial = put(
        "0.csv",
        header,
        f"{END},true,Initial,2024-01-09T04:10:19.156057706Z,1",
        f"{END},true,Second,2024-01-09T04:10:19.156057706Z,2",
        f"{END},true,Third,2024-01-09T04:10:19.156057706Z,3",
    )
    batches.write_history_batch(table, BatchFiles(replace=(initial,)), OPTIONS)
    files = BatchFiles(
        earliest=(put("e.csv", f"{SYS.start},id", "2025-03-01T10:00:00Z,1", "2025-03-01T10:00:00Z,2"),),
        update=(
            put(
                "u.csv",
                header,
                f"{END},true,Updated,2025-03-01T10:00:00.000Z,1",
                f"{END},true,{MARK},2025-03-01T10:00:00.000Z,2",
            ),
        ),
        delete=(put("d.csv", f"{SYS.end},id,title", f"2025-03-09T04:10:19Z,3,{TOKEN}"),),
    )
    for _ in range(2):  # sent twice, same table
        batches.write_history_batch(table, files, OPTIONS)
        got = rows(table.read(), "id", "title", SYS.active, SYS.end)
        shut, deleted = ts("2025-03-01T09:59:59.999Z"), ts("2025-03-09T04:10:19Z")
        plain = [(i, t, a, e.isoformat()) for i, t, a, e in got]
        closed, end = shut.replace(tzinfo=None).isoformat(), ts(END).replace(tzinfo=None).isoformat()
        assert plain == [
            (1, "Initial", False, closed),
            (1, "Updated", True, end),
            (2, "Second", False, closed),
            (2, "Second", True, end),
            (3, "Third", False, deleted.replace(tzinfo=None).isoformat()),
        ]


def test_alter_published_table(spark, tmp_path):
    table = VersionedTable.create(spark, str(tmp_path / "t"), BOOKS, buckets=4)
    data = [(i, f"t{i}", i, False, None) for i in range(20)]
    batches.load(table, spark.createDataFrame(data, BOOKS.schema()))
    before = table.head()

    added = BOOKS.put(Column("x", T.LongType()))
    commit = alter_table(table, added)
    assert commit.folders == before.folders  # an empty column takes no rewrite
    assert rows(table.read(), "id", "x") == sorted(((i, None) for i in range(20)), key=repr)
    assert alter_table(table, added) == commit  # nothing to do

    commit = alter_table(table, added.without("n"), drop_columns=True)
    assert commit.folders == before.folders and commit.retired == ("n",) and "n" not in table.spec()
    commit = alter_table(table, added.without("n").put(Column("n", T.IntegerType())))
    assert commit.folders != before.folders and commit.retired == ()  # the old cells must not come back
    assert {r[0] for r in rows(table.read(), "n")} == {None}

    wanted = table.spec().with_keys(["id", "title"])
    commit = alter_table(table, wanted)
    assert commit.bucket_keys == ("id", "title") and table.read().df.count() == 20
    with pytest.raises(UserActionError):
        alter_table(table, table.spec().with_keys([SYS.deleted]))
    assert table.head() == commit


def test_rows_that_stay_in_their_bucket_are_not_shuffled(spark, tmp_path, monkeypatch):
    spec = TableSpec((Column("id", T.IntegerType(), key=True), Column("s", T.StringType()), Column(SYS.synced, T.TimestampType())))
    table = VersionedTable.create(spark, str(tmp_path / "t"), spec, buckets=4)
    data = [(i, str(i), ts("2024-01-01" if i % 2 else "2024-03-01")) for i in range(40)]
    batches.load(table, spark.createDataFrame(data, spec.schema()))
    plans, publish = [], VersionedTable.publish

    def watched(self, state, *, rebalance=True, **rest):
        plans.append((rebalance, "Exchange" in state.df._jdf.queryExecution().toString()))
        return publish(self, state, rebalance=rebalance, **rest)

    monkeypatch.setattr(VersionedTable, "publish", watched)
    migrate(table, "rename_column", from_column="s", to_column="text")
    migrate(table, "add_column_with_default_value", column=Column("n", T.IntegerType(), default="4"))
    batches.truncate(table, SYS.synced, 1706745600 * 10**9)
    migrate(table, "live_to_soft_delete")
    migrate(table, "soft_delete_to_live")
    assert plans == [(False, False)] * 5
    assert rows(table.read(), "id", "text", "n") == sorted([(i, str(i), 4) for i in range(0, 40, 2)], key=repr)
    for bucket, folder in table.head().folders.items():
        assert f"{BUCKET}={bucket}" in os.listdir(tmp_path / "t" / "data" / folder)


def test_migrations_by_name(spark, tmp_path):
    spec = TableSpec((Column("id", T.IntegerType(), key=True), Column("s", T.StringType())))
    table = VersionedTable.create(spark, str(tmp_path / "t"), spec, buckets=2)
    batches.load(table, spark.createDataFrame([(1, "a"), (2, "b")], spec.schema()))
    migrate(table, "rename_column", from_column="s", to_column="text")
    migrate(table, "copy_column", from_column="text", to_column="other")
    migrate(table, "add_column_with_default_value", column=Column("n", T.IntegerType(), default="4"))
    migrate(table, "update_column_value", column="other", value="NULL")
    assert rows(table.read()) == [(1, "a", None, 4), (2, "b", None, 4)]

    copy = VersionedTable(spark, str(tmp_path / "copy"))
    migrate(table, "copy_table", into=copy)
    assert rows(copy.read()) == rows(table.read()) and copy.spec() == table.spec()
    hist = VersionedTable(spark, str(tmp_path / "hist"))
    migrate(table, "copy_table_to_history_mode", into=hist, now="2024-01-01T00:00:00Z")
    assert hist.spec().keys == ["id", SYS.start]
    moment = "2024-06-01T00:00:00Z"
    migrate(hist, "add_column_in_history_mode", column=Column("m", T.LongType()), default="1", operation_timestamp=moment)
    migrate(hist, "drop_column_in_history_mode", column="text", operation_timestamp=moment)
    assert rows(hist.read(), "id", "text", "m", SYS.active) == sorted(
        [(1, "a", None, False), (1, None, 1, True), (2, "b", None, False), (2, None, 1, True)], key=repr
    )
    migrate(hist, "history_to_soft_delete")
    assert rows(hist.read(), "id", SYS.deleted) == [(1, False), (2, False)]
    migrate(hist, "soft_delete_to_live")
    migrate(hist, "live_to_soft_delete")
    migrate(hist, "soft_delete_to_live")
    migrate(hist, "live_to_history")
    migrate(hist, "history_to_live")
    assert rows(hist.read(), "id", "m") == [(1, 1), (2, 1)]
    with pytest.raises(UnsupportedMigration):
        migrate(table, "sharpen")
    with pytest.raises(ChangeError, match="needs a target"):
        migrate(table, "copy_table")
    with pytest.raises(ChangeError, match="already exists"):
        migrate(table, "copy_table", into=copy)


def test_requests_are_applied_once_and_in_order(spark, tmp_path, put):
    spec = TableSpec((Column("id", T.IntegerType(), key=True), Column("s", T.StringType())))
    table = VersionedTable.create(spark, str(tmp_path / "t"), spec)
    requests = tmp_path / "requests"
    requests.mkdir()

    def request(sequence, **files):
        (requests / f"{9 - sequence}.json").write_text(json.dumps({"sequence": sequence, **files}) + "\n")

    def run(checkpoint):
        query = follow(
            spark, str(requests), table, str(tmp_path / checkpoint), options=OPTIONS, available_now=True
        )
        query.awaitTermination()

    request(0, replace=[put("0.csv", "id,s", "1,a", "2,b")])
    request(1, update=[put("1.csv", "id,s", f"1,{MARK}", "2,c")], delete=[put("2.csv", "id", "1")])
    run("c1")
    assert rows(table.read()) == [(2, "c")] and table.head().stream["requests"] == 1
    version = table.head().version
    run("c2")  # the stream's own checkpoint is lost: the table still knows
    assert table.head().version == version
    request(2, replace=[put("3.csv", "id,s", "5,e")])
    run("c2")
    assert rows(table.read()) == [(2, "c"), (5, "e")]
    request(4, replace=[put("4.csv", "id,s", "6,f")])
    run("c2")
    request(3, replace=[put("5.csv", "id,s", "7,g")])
    with pytest.raises(Exception, match="came after request 4"):
        run("c2")
    assert rows(table.read()) == [(2, "c"), (5, "e"), (6, "f")]
