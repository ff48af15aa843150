"""Type-2 history: scenarios, a row-by-row model, and skewed keys."""

import datetime as dt
import random

import pytest
from helpers import END, SYS, rows, table, ts, utc
from pyspark.sql import functions as F

from changeloom import ChangeError
from changeloom.functions import skew
from changeloom.operators import history
from changeloom.operators.merge import stack

MARK = "same-42"
DDL = (
    f"id int, title string, n int, blob binary, {SYS.synced} timestamp, {SYS.active} boolean, "
    f"{SYS.start} timestamp, {SYS.end} timestamp"
)
TEXT = "id string, title string, n string, blob string, " + ", ".join(
    f"{c} string" for c in (SYS.synced, SYS.active, SYS.start, SYS.end)
)
SHORT = f"id int, v string, {SYS.start} timestamp, {SYS.end} timestamp, {SYS.active} boolean"


def versions(spark, *data):
    full = [(i, t, n, bytearray(b), ts(s), a, ts(s), ts(e)) for i, t, n, b, s, a, e in data]
    return table(spark, full, DDL, ["id", SYS.start])


def earliest(spark, *data, ddl=f"id int, {SYS.start} timestamp"):
    return spark.createDataFrame([(k, ts(t)) for k, t in data], ddl)


def shown(t):
    return [tuple(utc(v) for v in r) for r in sorted(t.df.select("id", "title", "n", SYS.active, SYS.start, SYS.end).collect(), key=lambda r: (r[0], r[4]))]


def iso(text):
    return utc(ts(text))


@pytest.fixture(params=[False, True], ids=["shuffled", "small"])
def small(request):
    return request.param


def berths(spark):
    """Ships at the berths of a harbour: berth 41 changed hands once, 52 and 60 have had one ship each."""
    return versions(
        spark,
        (41, "Kittiwake", 310, b"k", "2021-03-02T06:00:00Z", False, "2022-07-15T11:29:59.999Z"),
        (41, "Petrel", 280, b"p", "2022-07-15T11:30:00Z", True, END),
        (52, "Gannet", 95, b"g", "2024-05-20T18:45:30.25Z", True, END),
        (60, "Auk", None, b"a", "2020-01-01T00:00:00Z", True, END),
    )


#: Berth 41 is reported anew from a later moment, berth 52 from before its only ship.
CUTS = [(41, "2023-10-01T08:15:00Z"), (52, "2023-09-30T00:00:00Z")]
FIRST = (41, "Kittiwake", 310, False, iso("2021-03-02T06:00:00Z"), iso("2022-07-15T11:29:59.999Z"))
SECOND = (41, "Petrel", 280, False, iso("2022-07-15T11:30:00Z"), iso("2023-10-01T08:14:59.999Z"))
OTHER = (60, "Auk", None, True, iso("2020-01-01T00:00:00Z"), iso(END))


def test_earliest_only(spark, small):
    got = history.apply_history_batch(berths(spark), earliest=earliest(spark, *CUTS), small=small)
    assert shown(got) == [FIRST, SECOND, OTHER]
    trimmed = history.drop_overlapping(berths(spark), earliest(spark, *CUTS), small=small)
    one_by_one = history.close_versions(trimmed, earliest(spark, *CUTS), small=small)
    assert shown(one_by_one) == [FIRST, SECOND, OTHER]


def test_versions_without_start_stay(spark, small):
    t = berths(spark)
    unknown = t.df.filter("id = 41").limit(1).withColumn(SYS.start, F.lit(None).cast("timestamp"))
    t = t.with_df(t.df.union(unknown))
    for got in (
        history.drop_overlapping(t, earliest(spark, *CUTS), small=small),
        history.apply_history_batch(t, earliest=earliest(spark, *CUTS), small=small),
    ):
        assert got.df.filter(F.col(SYS.start).isNull()).count() == 1


def arrivals(spark):
    came, leaves = "2023-10-04T05:20:00Z", "9998-12-31T00:00:00Z"
    return spark.createDataFrame(
        [("41", MARK, "275", "cA==", came, "true", came, leaves), ("52", "Fulmar", MARK, MARK, came, "true", came, leaves)],
        TEXT,
    )


def test_partial_versions_take_the_latest_version(spark, small):
    batch = dict(earliest=earliest(spark, *CUTS), update=arrivals(spark), unmodified=MARK, small=small)
    got = history.apply_history_batch(berths(spark), **batch)
    came, leaves = iso("2023-10-04T05:20:00Z"), iso("9998-12-31T00:00:00Z")
    lengthened = (41, "Petrel", 275, True, came, leaves)
    # The only version of berth 52 overlapped, so there is nothing to take from.
    fresh = (52, "Fulmar", None, True, came, leaves)
    assert shown(got) == [FIRST, SECOND, lengthened, fresh, OTHER]
    blobs = rows(got.df.filter(F.col(SYS.active) & (F.col("id") < 60)), "id", "blob")
    assert blobs == [(41, bytearray(b"p")), (52, None)]
    assert shown(history.apply_history_batch(got, **batch)) == shown(got)  # sent twice


def test_latest_version_may_be_inactive(spark, small):
    t = versions(
        spark,
        (1, "a", 1, b"", "2024-01-01T00:00:00Z", False, "2024-01-31T23:59:59.999Z"),
        (1, "b", 2, b"", "2024-02-01T00:00:00Z", False, "2024-02-02T00:00:00Z"),
        (1, "c", 3, b"", "2024-03-01T00:00:00Z", True, END),
        (2, "x", 9, b"", "2024-01-01T00:00:00Z", True, END),
    )
    cut = earliest(spark, (1, "2024-03-01T00:00:00Z"), (5, "2024-03-01T00:00:00Z"))
    assert rows(history.latest_versions(t, cut, small=small), "id", "title") == [(1, "b")]
    keys = spark.createDataFrame([(5,)], "id int")
    assert rows(history.latest_versions(t, cut, only=keys, small=small), "id") == []


def test_replace_and_delete_files(spark, small):
    ship = versions(spark, (41, "Skua", 120, b"", "2023-11-11T11:11:11Z", True, END)).df
    t = history.apply_history_batch(versions(spark), earliest=earliest(spark, *CUTS), replace=ship, small=small)
    left = ts("2023-12-24T16:00:00.5Z")
    departures = spark.createDataFrame([(left, 41), (left, 77)], f"{SYS.end} timestamp, id int")
    for _ in range(2):  # the second time nothing is open any more
        t = history.apply_history_batch(t, delete=departures, small=small)
    assert shown(t) == [(41, "Skua", 120, False, iso("2023-11-11T11:11:11Z"), utc(left))]
    assert shown(history.close_deleted(t.with_df(ship), departures, small=small)) == shown(t)


def test_delete_reaches_rows_of_the_same_batch(spark, small):
    t = versions(spark, (1, "a", 1, b"", "2024-01-01T00:00:00Z", True, END))
    new = versions(spark, (1, "b", 2, b"", "2024-02-01T00:00:00Z", True, END)).df
    end = ts("2024-02-10T00:00:00Z")
    d = spark.createDataFrame([(1, end)], f"id int, {SYS.end} timestamp")
    got = history.apply_history_batch(
        t, earliest=earliest(spark, (1, "2024-02-01T00:00:00Z")), replace=new, delete=d, small=small
    )
    assert [(r[1], r[3], r[5]) for r in shown(got)] == [
        ("a", False, iso("2024-01-31T23:59:59.999Z")),
        ("b", False, utc(end)),
    ]


def test_older_batch_replaces_newer_versions(spark, small):
    t = versions(spark, *[(k, f"t{k}", 1, b"", "2025-01-09T00:00:00Z", True, END) for k in (1, 2, 3)])
    new = versions(spark, (2, "late", 1, b"", "2024-01-01T00:00:00Z", True, END)).df
    got = history.apply_history_batch(
        t, earliest=earliest(spark, (2, "2024-01-01T00:00:00Z")), replace=new, small=small
    )
    assert [(r[0], r[1]) for r in shown(got)] == [(1, "t1"), (2, "late"), (3, "t3")]


def test_first_delete_file_wins_and_null_end_closes(spark, small):
    t = versions(spark, (1, "a", 1, b"", "2024-01-01T00:00:00Z", True, END), (2, "b", 1, b"", "2024-01-01T00:00:00Z", True, END))
    ddl = f"id int, {SYS.end} timestamp"
    first = spark.createDataFrame([(1, ts("2024-05-01T00:00:00Z")), (2, None)], ddl)
    second = spark.createDataFrame([(1, ts("2024-04-01T00:00:00Z"))], ddl)
    got = history.apply_history_batch(t, delete=stack([first, second]), small=small)
    assert [(r[3], r[5]) for r in shown(got)] == [(False, iso("2024-05-01T00:00:00Z")), (False, None)]


def test_key_needed(spark):
    t = table(spark, [], SHORT, [SYS.start])
    with pytest.raises(ChangeError, match="no key columns besides"):
        history.apply_history_batch(t, earliest=t.df)


DAY = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def day(n):
    return DAY + dt.timedelta(days=n)


def model(state, first, update, replace, delete):
    """Row by row: state rows are [key, value, start, end, active]."""
    state = [list(r) for r in state]
    state = [r for r in state if not (r[0] in first and r[2] >= first[r[0]])]
    latest = {}
    for r in state:
        if r[0] in first and (r[0] not in latest or r[2] > latest[r[0]][2]):
            latest[r[0]] = list(r)
    for r in state:
        if r[0] in first and r[4]:
            r[3], r[4] = first[r[0]] - dt.timedelta(milliseconds=1), False
    for k, v, start in update:
        value = (latest[k][1] if k in latest else None) if v == MARK else v
        state.append([k, value, start, day(2000), True])
    state += [list(r) for r in replace]
    for k, end in delete.items():
        for r in state:
            if r[0] == k and r[4]:
                r[3], r[4] = end, False
    return sorted(((k, v, utc(s), utc(e), a) for k, v, s, e, a in state), key=repr)


def random_batch(seed, size=400):
    """Independent keys, so one run covers many small cases."""
    rng = random.Random(seed)

    def version(k):
        return (k, rng.choice("abc"), day(rng.randrange(10)), day(rng.randrange(10)), rng.choice([True, False, None]))

    def distinct(items):
        return list({(r[0], r[2]): r for r in items}.values())

    keys = range(size)
    return dict(
        state=distinct(version(k) for k in keys for _ in range(rng.randrange(5))),
        first={k: day(rng.randrange(10)) for k in keys if rng.random() < 0.6},
        update=distinct(
            (k, rng.choice(["n", None, MARK]), day(rng.randrange(10)))
            for k in keys
            for _ in range(rng.randrange(3))
        ),
        replace=distinct(version(k) for k in keys if rng.random() < 0.4),
        delete={k: day(rng.randrange(10)) for k in keys if rng.random() < 0.4},
    )


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("without", [(), ("first",), ("delete",), ("first", "delete"), ("update", "replace")])
def test_batch_equals_model(spark, small, seed, without):
    data = random_batch(seed)
    for name in without:
        data[name] = type(data[name])()
    t = table(spark, data["state"], SHORT, ["id", SYS.start])
    text = [(str(k), v, s.isoformat(), day(2000).isoformat(), "true") for k, v, s in data["update"]]
    frames = {
        "first": ("earliest", list(data["first"].items()), f"id int, {SYS.start} timestamp"),
        "update": ("update", text, f"id string, v string, {SYS.start} string, {SYS.end} string, {SYS.active} string"),
        "replace": ("replace", data["replace"], SHORT),
        "delete": ("delete", list(data["delete"].items()), f"id int, {SYS.end} timestamp"),
    }
    given = {
        kind: spark.createDataFrame(content, ddl) for name, (kind, content, ddl) in frames.items() if name not in without
    }
    got = history.apply_history_batch(t, **given, unmodified=MARK, small=small)
    plain = sorted((tuple(utc(v) for v in r) for r in got.df.collect()), key=repr)
    assert plain == model(**data)


def skewed(spark, n=40000):
    """One key owns half of the versions; the rest are spread over 5,000 keys."""
    key = F.when(F.col("i") % 2 == 0, F.lit(7)).otherwise(F.col("i") % 5000).cast("int")
    base = spark.range(n).withColumnRenamed("id", "i").select(key.alias("id"), "i")
    start = F.timestamp_seconds(F.col("i").cast("long"))
    df = base.select("id", F.lit("v").alias("v"), start.alias(SYS.start), start.alias(SYS.end), F.lit(False).alias(SYS.active))
    return table(spark, [], SHORT, ["id", SYS.start]).with_df(df)


def test_hot_keys_are_found_and_spread(spark):
    t = skewed(spark)
    hot = dict(skew.hot_keys(t.df, ["id"]))
    expected = spark.range(1).select(F.xxhash64(F.lit(7))).first()[0]
    assert list(hot) == [expected] and 14 <= hot[expected] <= 18

    right = t.df.groupBy("id").agg(F.max(SYS.start).alias("last"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = t.df.join(right, "id", "left")
        joined = skew.lookup_join(t.df, right, ["id"], salt_by=[SYS.start], small=False)
        assert joined.exceptAll(plain.select(joined.columns)).isEmpty()
        assert plain.select(joined.columns).exceptAll(joined).isEmpty()
        none = skew.lookup_join(t.df, right, ["id"], salt_by=[SYS.start], eligible=F.col(SYS.active), small=False)
        assert none.filter(F.col("last").isNotNull()).isEmpty() and none.count() == t.df.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_fits_broadcast_measures(spark):
    df = spark.range(1000).select(F.col("id"), F.lit("x" * 100).alias("s"))
    assert skew.fits_broadcast(df) and not skew.fits_broadcast(df, 100_000)
    assert skew.fits_broadcast(df.select("id"), 100_000) and not skew.fits_broadcast(df.select("id"), 10_000)
    assert skew.fits_broadcast(df.limit(0), 0)


def test_rows_of_a_hot_key_are_spread(spark, tmp_path):
    skewed(spark).df.write.parquet(str(tmp_path / "t"))
    t = skewed(spark).with_df(spark.read.parquet(str(tmp_path / "t")))
    cut = earliest(spark, (7, "1970-01-01T05:00:00Z"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        every = history.latest_versions(t, cut, small=False)
        joined = skew.lookup_join(t.df, cut.withColumnRenamed(SYS.start, "cut"), ["id"], salt_by=[SYS.start], small=False)
        spread = joined.filter("id = 7").groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert every.count() == 1
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert len(spread) == 8 and sum(r["count"] for r in spread) == 20008
    assert max(r["count"] for r in spread) < 2 * 20008 / 8


def test_untouched_versions_are_not_shuffled(spark, tmp_path):
    skewed(spark).df.write.parquet(str(tmp_path / "t"))
    t = skewed(spark).with_df(spark.read.parquet(str(tmp_path / "t")))
    got = history.apply_history_batch(t, earliest=earliest(spark, (7, "2030-01-01T00:00:00Z")), small=False)
    lines = got.df._jdf.queryExecution().executedPlan().toString().splitlines()
    top = lines.index("+- Union")
    branches = [i for i, line in enumerate(lines) if i > top and line[3:6] in (":- ", "+- ")]
    passing = "\n".join(lines[branches[1] :])
    assert "Exchange hashpartitioning" not in passing.split("Subquery")[0] and "FileScan" in passing
    assert got.df.count() == t.df.count()
