"""Moving between live, soft-delete and history mode; column changes in history tables."""

import datetime as dt

import pytest
from helpers import END, SYS, rows, table, ts, utc
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom import ChangeError, Column
from changeloom.operators import modes

HISTORY = f"id int, v string, {SYS.start} timestamp, {SYS.end} timestamp, {SYS.active} boolean"
MOMENT = "2024-06-01T00:00:00Z"
BEFORE = "2024-05-31T23:59:59.999Z"
EPOCH = "1970-01-01T00:00:00"


def at(text):
    return F.lit(text).cast("timestamp")


def versions(spark, *data, ddl=HISTORY):
    full = [(*r[:-3], ts(r[-3]), ts(r[-2]), r[-1]) for r in data]
    return table(spark, full, ddl, ["id", SYS.start], defaults={SYS.active: "true"})


def shown(t, *columns):
    return sorted((tuple(utc(v) for v in r) for r in t.df.select(*columns).collect()), key=repr)


def plain(text):
    return utc(ts(text))


def soft(spark, flag=SYS.deleted):
    ddl = f"id int, v string, {flag} boolean, {SYS.synced} timestamp"
    data = [
        (1, "a", False, ts("2024-01-01T00:00:00Z")),
        (2, "b", True, ts("2024-01-03T00:00:00Z")),
        (3, "c", None, ts("2024-01-02T00:00:00Z")),
    ]
    return table(spark, data, ddl, ["id"])


def test_soft_to_live(spark):
    live = modes.soft_delete_to_live(soft(spark))
    assert live.spec.names == ["id", "v", SYS.synced] and rows(live, "id") == [(1,), (3,)]
    own = modes.soft_delete_to_live(soft(spark, "removed"), "removed")
    assert "removed" in own.spec and rows(own, "id") == [(1,), (3,)]
    with pytest.raises(ChangeError, match="not found"):
        modes.soft_delete_to_live(soft(spark), "removed")


@pytest.mark.parametrize("flag", [SYS.deleted, "removed"])
def test_soft_to_history(spark, flag):
    t = modes.soft_delete_to_history(soft(spark, flag), flag)
    assert t.spec.keys == ["id", SYS.start] and t.spec[SYS.active].default == "true"
    assert ("removed" in t.spec) == (flag == "removed") and SYS.deleted not in t.spec
    last, end = "2024-01-03T00:00:00", plain(END)
    assert shown(t, "id", SYS.start, SYS.end, SYS.active) == [
        (1, last, end, True),
        (2, EPOCH, EPOCH, False),
        (3, last, end, True),
    ]
    with pytest.raises(ChangeError, match="version columns already"):
        modes.live_to_history(t, at(MOMENT))


def books(spark, ddl=HISTORY, extra=()):
    return versions(
        spark,
        (1, "old", *extra, "2024-01-01T00:00:00Z", "2024-01-31T23:59:59.999Z", False),
        (1, "new", *extra, "2024-02-01T00:00:00Z", END, True),
        (2, "gone", *extra, "2024-01-01T00:00:00Z", "2024-03-01T00:00:00Z", False),
        ddl=ddl,
    )


def test_history_to_soft(spark):
    t = modes.history_to_soft_delete(books(spark))
    assert t.spec.keys == ["id"] and t.spec.names == ["id", "v", SYS.deleted]
    assert t.spec[SYS.deleted].default == "false"
    assert rows(t) == [(1, "new", False), (2, "gone", True)]


def test_history_to_soft_with_own_flag(spark):
    ddl = HISTORY.replace("v string,", "v string, removed boolean,")
    t = modes.history_to_soft_delete(books(spark, ddl, (None,)), "removed")
    assert rows(t, "id", "v", "removed", SYS.deleted) == [(1, "new", False, False), (2, "gone", True, False)]
    with pytest.raises(ChangeError, match="no key columns besides"):
        keyless = table(spark, [], HISTORY, [SYS.start])
        modes.history_to_soft_delete(keyless)


def test_history_to_live(spark):
    t = modes.history_to_live(books(spark))
    assert t.spec.keys == ["id"] and rows(t) == [(1, "new")]
    everything = modes.history_to_live(books(spark), keep_deleted_rows=True)
    assert everything.spec.keys == [] and rows(everything) == [(1, "new"), (1, "old"), (2, "gone")]


def test_live_to_soft_and_back(spark):
    live = table(spark, [(1, "a"), (2, "b")], "id int, v string", ["id"])
    t = modes.live_to_soft_delete(live)
    assert rows(t) == [(1, "a", False), (2, "b", False)]
    assert rows(modes.soft_delete_to_live(t)) == rows(live)
    kept = modes.live_to_soft_delete(soft(spark))
    assert rows(kept, "id", SYS.deleted) == [(1, False), (2, True), (3, False)]


def test_live_to_history_and_back(spark):
    live = table(spark, [(1, "a")], "id int, v string", ["id"])
    t = modes.live_to_history(live, at(MOMENT))
    assert shown(t, *t.spec.names) == [(1, "a", plain(MOMENT), plain(END), True)]
    assert t.spec.keys == ["id", SYS.start]
    assert rows(modes.history_to_live(t)) == rows(live)


def test_copies(spark):
    assert rows(modes.copy_table(soft(spark))) == rows(soft(spark))
    assert modes.copy_table(books(spark)).spec.keys == ["id", SYS.start]
    with pytest.raises(ChangeError, match="table with a key"):
        modes.copy_table(table(spark, [], "a int", []))
    assert rows(modes.copy_table_to_history(soft(spark), at(MOMENT), SYS.deleted), "id", SYS.active) == [
        (1, True),
        (2, False),
        (3, True),
    ]
    assert shown(modes.copy_table_to_history(soft(spark), at(MOMENT)), SYS.start) == [(plain(MOMENT),)] * 3


def test_add_column_in_history(spark):
    t = books(spark)
    once = modes.add_column_in_history(t, Column("n", T.IntegerType(), default="5"), "7", at(MOMENT))
    twice = modes.add_column_in_history(once, Column("s", T.StringType()), "x", at(MOMENT))
    assert twice.spec["n"].default is None and twice.spec.names == [*t.spec.names, "n", "s"]
    end, gone = plain(END), plain("2024-03-01T00:00:00Z")
    first = plain("2024-01-01T00:00:00Z")
    assert shown(twice, "id", "v", SYS.start, SYS.end, SYS.active, "n", "s") == [
        (1, "new", plain("2024-02-01T00:00:00Z"), plain(BEFORE), False, None, None),
        (1, "new", plain(MOMENT), end, True, 7, "x"),
        (1, "old", first, plain("2024-01-31T23:59:59.999Z"), False, None, None),
        (2, "gone", first, gone, False, None, None),
    ]


def test_drop_column_in_history(spark):
    ddl = HISTORY.replace("v string,", "v string, w string,")
    t = versions(
        spark,
        (1, "a", "b", "2024-01-01T00:00:00Z", END, True),
        (2, None, "b", "2024-01-01T00:00:00Z", END, True),
        (3, "c", "d", "2024-01-01T00:00:00Z", "2024-02-01T00:00:00Z", False),
        ddl=ddl,
    )
    t = modes.drop_column_in_history(modes.drop_column_in_history(t, "v", at(MOMENT)), "w", at(MOMENT))
    first = plain("2024-01-01T00:00:00Z")
    assert shown(t, "id", "v", "w", SYS.start, SYS.active) == sorted(
        [
            (1, "a", "b", first, False),
            (1, None, None, plain(MOMENT), True),
            (2, None, "b", first, False),
            (2, None, None, plain(MOMENT), True),
            (3, "c", "d", first, False),
        ],
        key=repr,
    )


def test_history_must_be_ready(spark):
    empty = versions(spark)
    added = modes.add_column_in_history(empty, Column("n", T.IntegerType()), "7", at(MOMENT))
    assert "n" in added.spec and rows(added) == []
    assert modes.drop_column_in_history(empty, "v", at(MOMENT)).spec == empty.spec
    late = versions(spark, (1, "a", "2024-06-02T00:00:00Z", END, True))
    for call in (
        lambda: modes.add_column_in_history(late, Column("n", T.IntegerType()), "7", at(MOMENT)),
        lambda: modes.drop_column_in_history(late, "v", at(MOMENT)),
    ):
        with pytest.raises(ChangeError, match="starts after the moment"):
            call()
    closed = versions(spark, (1, "a", "2024-06-02T00:00:00Z", END, False))
    assert rows(modes.add_column_in_history(closed, Column("n", T.IntegerType()), "7", at(MOMENT)), "n") == [(None,)]


def test_last_versions_are_limited_before_the_shuffle(spark, tmp_path):
    books(spark).df.write.parquet(str(tmp_path / "t"))
    t = books(spark).with_df(spark.read.parquet(str(tmp_path / "t")))
    plan = modes.history_to_soft_delete(t).df._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Exchange", 1)
    assert "WindowGroupLimit" in above and "WindowGroupLimit" in below


def test_migrations_do_not_shuffle_the_table(spark, tmp_path):
    soft(spark).df.write.parquet(str(tmp_path / "t"))
    t = soft(spark).with_df(spark.read.parquet(str(tmp_path / "t")))
    for state in (modes.soft_delete_to_live(t), modes.live_to_soft_delete(t), modes.live_to_history(t, at(MOMENT))):
        assert "Exchange" not in state.df._jdf.queryExecution().executedPlan().toString()
    main = modes.soft_delete_to_history(t).df._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in main and "hashpartitioning" not in main
    assert dt.datetime(1970, 1, 1) in [r[0] for r in rows(modes.soft_delete_to_history(t), SYS.start)]
