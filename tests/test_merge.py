"""Keyed changes: upsert, partial update, delete, truncate, whole batches."""

import datetime as dt
import random

import pytest
from helpers import SYS, rows, table
from pyspark.sql import functions as F

from changeloom import ChangeError
from changeloom.operators import merge
from changeloom.operators.merge import SEQ, stack

MARK = "same-42"
DDL = "id int, title string, n int"


def books(spark):
    return table(spark, [(1, "Guide", 42), (2, "Rings", 1)], DDL, ["id"])


def test_upsert_replaces_and_inserts(spark):
    s = spark.createDataFrame([(2, "Towers", 1), (3, "Hobbit", None)], DDL)
    assert rows(merge.upsert(books(spark), s)) == [(1, "Guide", 42), (2, "Towers", 1), (3, "Hobbit", None)]


def test_upsert_leaves_columns_it_does_not_bring(spark):
    t = table(spark, [(1, "Guide", 42), (2, "Rings", 1)], DDL, ["id"], defaults={"n": "7"})
    s = spark.createDataFrame([("new", 3), (None, 2)], "title string, id int")
    assert rows(merge.upsert(t, s)) == [(1, "Guide", 42), (2, None, 1), (3, "new", 7)]


def test_upsert_twice_is_once(spark):
    s = spark.createDataFrame([(2, "Towers", 1), (3, "Hobbit", None)], DDL)
    once = merge.upsert(books(spark), s)
    assert rows(merge.upsert(once, s)) == rows(once)


def test_upsert_without_key_appends(spark):
    t = table(spark, [(1, "a", 1)], DDL, [])
    assert rows(merge.upsert(t, spark.createDataFrame([(1, "a", 1)], DDL))) == [(1, "a", 1), (1, "a", 1)]
    with pytest.raises(ChangeError, match="table with a key"):
        merge.apply_changes(t, replace=t.df)


def test_upsert_of_key_only_table(spark):
    t = table(spark, [(1,), (2,)], "id int", ["id"])
    assert rows(merge.upsert(t, spark.createDataFrame([(2,), (3,)], "id int"))) == [(1,), (2,), (3,)]


def test_update_partial(spark):
    s = spark.createDataFrame(
        [("2", "Empire", MARK), ("1", None, "15"), ("9", "nobody", "1")], "id string, title string, n string"
    )
    assert rows(merge.update_partial(books(spark), s, MARK)) == [(1, None, 15), (2, "Empire", 1)]


def test_update_without_marker_keeps_on_empty_text(spark):
    s = spark.createDataFrame([("2", "", None)], "id string, title string, n string")
    assert rows(merge.update_partial(books(spark), s)) == [(1, "Guide", 42), (2, "Rings", None)]


def test_update_decodes_binary_and_casts(spark):
    t = table(
        spark,
        [(1, bytearray(b"old"), dt.date(2024, 1, 1)), (2, bytearray(b"old"), dt.date(2024, 1, 1))],
        "id int, b binary, d date",
        ["id"],
    )
    s = spark.createDataFrame([("1", "bmV3", MARK), ("2", MARK, "2025-02-03")], "id string, b string, d string")
    assert rows(merge.update_partial(t, s, MARK)) == [
        (1, bytearray(b"new"), dt.date(2024, 1, 1)),
        (2, bytearray(b"old"), dt.date(2025, 2, 3)),
    ]
    bad = spark.createDataFrame([("1", MARK, "not a date")], "id string, b string, d string")
    with pytest.raises(Exception, match="CAST"):
        merge.update_partial(t, bad, MARK).df.collect()


def test_composite_keys(spark):
    t = table(
        spark,
        [(1, 100, "first"), (2, 200, "second"), (3, 300, "third"), (3, 301, "other")],
        "a int, b int, s string",
        ["a", "b"],
    )
    u = spark.createDataFrame([("2", "200", "new"), ("3", "200", "no such row")], "a string, b string, s string")
    t = merge.update_partial(t, u, MARK)
    d = spark.createDataFrame([(1, 100, "ignored"), (3, 300, "ignored")], "a int, b int, s string")
    assert rows(merge.delete_rows(t, d)) == [(2, 200, "new"), (3, 301, "other")]


def test_repeated_keys_are_resolved_by_load_time(spark):
    ddl = f"id int, s string, {SYS.synced} timestamp"
    t = table(spark, [], ddl, ["id"])
    at = [dt.datetime(2024, 1, day) for day in (1, 2, 3)]
    s = spark.createDataFrame([(1, "b", at[1]), (1, "c", at[2]), (1, "a", at[0]), (1, "c2", at[2])], ddl)
    assert rows(merge.upsert(t, s), "id", "s") == [(1, "c2")]


def test_truncate(spark):
    ddl = "id int, at timestamp, gone boolean"
    at = dt.datetime(2024, 2, 9, tzinfo=dt.timezone.utc)
    early = at - dt.timedelta(microseconds=1)
    t = table(spark, [(1, early, False), (2, at, None), (3, None, False), (4, early, None)], ddl, ["id"])
    cutoff = merge.cutoff_at(1707436800 * 10**9 + 999)  # the part below a microsecond is cut off
    assert rows(merge.truncate_before(t, "at", cutoff), "id") == [(2,), (3,)]
    soft = merge.truncate_before(t, "at", cutoff, "gone")
    assert rows(soft, "id", "gone") == [(1, True), (2, None), (3, False), (4, True)]
    assert rows(merge.truncate_before(t, "at", merge.cutoff_at(None)), "id") == [(1,), (2,), (3,), (4,)]
    with pytest.raises(ChangeError, match="not found"):
        merge.truncate_before(t, "at", cutoff, "missing")


def test_insert_and_update_column_value(spark):
    t = table(spark, [(1, "a", 1)], DDL, ["id"], defaults={"title": "none"})
    t = merge.insert(t, spark.createDataFrame([(5, 2)], "n int, id int"))
    assert rows(t) == [(1, "a", 1), (2, "none", 5)]
    assert rows(merge.update_column_value(t, "n", "12")) == [(1, "a", 12), (2, "none", 12)]
    assert rows(merge.update_column_value(t, "title", "NULL")) == [(1, None, 1), (2, None, 5)]


def apply_model(state, replace, update, delete):
    """Row by row, file by file: what the folded plan must equal."""
    state = dict(state)
    for file in replace:
        for key, a, b in file:
            old = state.get(key, (None, None))
            state[key] = (a, old[1] if b == "absent" else b)
    for file in update:
        for key, a, b in file:
            if key in state:
                old = state[key]
                state[key] = (old[0] if a == MARK else a, old[1] if b == MARK else b)
    for file in delete:
        for key in file:
            state.pop(key, None)
    return sorted(((k, *v) for k, v in state.items()), key=repr)


@pytest.mark.parametrize("narrow", [False, True], ids=["all columns", "some columns"])
@pytest.mark.parametrize("small", [False, True], ids=["shuffled", "small"])
@pytest.mark.parametrize("files", [(1, 0, 1), (2, 1, 0), (0, 3, 2), (2, 3, 2), (0, 1, 0)])
def test_batch_equals_files_in_order(spark, narrow, files, small):
    """Keys are independent, so one run covers many small cases."""
    rng, keys = random.Random(sum(files)), range(300)
    values, cells = ["x", "y", "z", None], ["p", "q", None, MARK]

    def file(choices, chance=0.5):
        return [(k, rng.choice(choices), rng.choice(choices)) for k in keys if rng.random() < chance]

    state = file(values)
    replace = [file(values) for _ in range(files[0])]
    update = [file(cells) for _ in range(files[1])]
    delete = [[k for k in keys if rng.random() < 0.2] for _ in range(files[2])]
    t = table(spark, state, "k int, a string, b string", ["k"])
    if narrow:
        replace = [[(k, a, "absent") for k, a, _ in part] for part in replace]
        parts = [spark.createDataFrame([r[:2] for r in part], "k int, a string") for part in replace]
    else:
        parts = [spark.createDataFrame(part, "k int, a string, b string") for part in replace]
    updates = [
        spark.createDataFrame([(str(k), a, b) for k, a, b in part], "k string, a string, b string") for part in update
    ]
    if len(updates) == 1:
        [updates] = updates
    deletes = [spark.createDataFrame([(k,) for k in part], "k int") for part in delete]
    got = merge.apply_changes(
        t,
        replace=stack(parts),
        update=stack(updates) if isinstance(updates, list) else updates,
        delete=stack(deletes),
        unmodified=MARK,
        small=small,
    )
    assert rows(got) == apply_model({k: (a, b) for k, a, b in state}, replace, update, delete)


def stored(spark, df, path):
    df.write.parquet(str(path))
    return spark.read.parquet(str(path))


def test_target_rows_are_read_once_and_not_shuffled_for_small_changes(spark, tmp_path):
    target = spark.range(1000).select(F.col("id").cast("int"), F.lit("s").alias("title"), F.lit(1).alias("n"))
    t = table(spark, [], DDL, ["id"]).with_df(stored(spark, target, tmp_path / "t"))
    change = stored(spark, target.limit(5), tmp_path / "s")
    text = stored(spark, target.limit(5).select(*[F.col(c).cast("string") for c in target.columns]), tmp_path / "u")
    keys = stored(spark, target.limit(5).select("id"), tmp_path / "d")
    for kwargs in (
        {"replace": stack([change, change]), "delete": keys},
        {"replace": stack([change, change]), "update": stack([text, text]), "delete": keys},
        {"update": text},
    ):
        plan = merge.apply_changes(t, **kwargs).df._jdf.queryExecution().executedPlan().toString()
        lines = plan.splitlines()
        scan, *others = [i for i, line in enumerate(lines) if "FileScan" in line and f"{tmp_path}/t" in line]
        # New rows are told by a second read of the key alone.
        assert len(others) <= 1 and not any("title" in lines[i] for i in others), plan
        above = [line.strip(" :+-") for line in lines[:scan]]
        depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
        ancestors = [a for a, d, i in zip(above, depth, range(scan)) if d < min(depth[i + 1 : scan + 1])]
        assert not any(a.startswith("Exchange") for a in ancestors), plan
        assert any("BroadcastHashJoin" in a for a in ancestors), plan


def test_stack_marks_order(spark):
    parts = [spark.createDataFrame([(i,)], "id int") for i in range(3)]
    assert rows(stack(parts), SEQ, "id") == [(i, i) for i in range(3)]
    assert stack([]) is None


@pytest.mark.parametrize("small", [False, True])
def test_a_repeated_stored_key_has_one_outcome(spark, small):
    stored = table(spark, [(1, "a"), (1, "b"), (2, "c")], "id int, v string", ["id"])
    for changes in ([(1, "new"), (3, "d")], [(1, "new"), (3, "d")]):
        got = merge.apply_changes(stored, replace=spark.createDataFrame(changes, "id int, v string"), small=small)
        assert rows(got, "id", "v") == [(1, "new"), (1, "new"), (2, "c"), (3, "d")]


def test_rows_that_rank_alike_are_not_mixed(spark):
    stored = table(spark, [(1, "a", "b")], "id int, v string, w string", ["id"])
    changes = [("1", "x", "k"), ("1", "y", "j")]
    got = merge.update_partial(stored, spark.createDataFrame(changes, "id string, v string, w string"), "~")
    assert rows(got, "id", "v", "w")[0] in [(1, "x", "k"), (1, "y", "j")]
