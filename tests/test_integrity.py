import datetime as dt
import random

import pytest
from helpers import SYS, rows, table

from changeloom.operators import checks, history
from changeloom.operators.checks import ACTIVE, BACKWARD, OVERLAP

DAY = dt.timedelta(days=1)
T0 = dt.datetime(2024, 1, 1)
DDL = f"id int, b string, {SYS.start} timestamp, {SYS.end} timestamp, {SYS.active} boolean, wide string"


def _order(version):
    return tuple((v is not None, v) for v in version)


def plain(data):
    """Each version against all earlier ones of its key."""
    out = []
    for i, (*key, start, end, active, _) in enumerate(data):
        earlier = [
            v for j, v in enumerate(data)
            if v[:2] == tuple(key) and j != i and (_order(v[2:5]), j) < (_order((start, end, active)), i)
        ]
        known = start is not None
        found = [BACKWARD] if known and end is not None and end < start else []
        found += [OVERLAP] if known and any(v[3] is not None and v[3] >= start for v in earlier) else []
        found += [ACTIVE] if active and any(v[4] for v in earlier) else []
        out += [(*key, start, end, active, problem) for problem in found]
    return sorted(out, key=repr)


def _versions(seed, count, hot):
    rng = random.Random(seed)
    data = []
    for k in range(count):
        key = (1, "hot") if k < hot else (rng.choice((None, 2, 3, 4, 5)), rng.choice(("x", None)))
        start = None if rng.random() < 0.03 else T0 + rng.randrange(400) * DAY
        end = None if rng.random() < 0.05 else (start or T0) + rng.randrange(-2, 4) * DAY
        data.append((*key, start, end, rng.choice((True, False, False, None)), "w"))
    return data


@pytest.mark.parametrize("partitions", [1, 2, 7, 40])
def test_sweep_agrees_with_comparing_all_versions(spark, partitions):
    data = _versions(partitions, 300, 150)  # one key has half of all rows
    t = table(spark, data, DDL, ["id", "b", SYS.start])
    assert rows(checks.history_violations(t, partitions=partitions)) == plain(data)


def test_a_hot_key_is_swept_by_many_tasks(spark):
    data = [(1 if k % 2 else k, "x", T0 + k * DAY, T0 + k * DAY + DAY / 2, False, "w") for k in range(4000)]
    data[3001] = (1, "x", T0 + 3001 * DAY, T0 + 3900 * DAY, True, "w")
    data[3999] = (1, "x", T0 + 3999 * DAY, None, True, "w")
    t = table(spark, data, DDL, ["id", "b", SYS.start])
    found = checks.history_violations(t, partitions=16)
    # The end of one version reaches over several borders.
    assert rows(found) == plain_of_one(data)
    path = found.inputFiles()[0].rsplit("/", 1)[0]
    parts = spark.read.parquet(path).filter("id = 1").groupBy("__part").count().collect()
    assert len(parts) >= 7 and max(r["count"] for r in parts) < 600


def plain_of_one(data):
    late = [(*v[:5], OVERLAP) for v in data if v[0] == 1 and T0 + 3001 * DAY < v[2] <= T0 + 3900 * DAY]
    return sorted([*late, (*data[3999][:5], ACTIVE)], key=repr)


def test_clean_and_empty_tables(spark):
    data = [(k, "x", T0 + n * DAY, T0 + (n + 1) * DAY - dt.timedelta(milliseconds=1), n == 4, "w") for k in range(9) for n in range(5)]
    t = table(spark, data, DDL, ["id", "b", SYS.start])
    assert rows(checks.history_violations(t)) == []
    assert rows(checks.history_violations(t.with_df(t.df.limit(0)))) == []


@pytest.mark.parametrize("small", [True, False])
def test_marked_cells_bring_only_their_columns(spark, tmp_path, small):
    ddl = f"id int, {SYS.start} timestamp, {SYS.end} timestamp, {SYS.active} boolean, title string, price int, wide string"
    data = [(k % 20, T0 + k * DAY, T0 + (k + 1) * DAY, False, f"t{k}" if k % 3 else None, k, "w" * 50) for k in range(400)]
    table(spark, data, ddl, ["id", SYS.start]).df.write.parquet(f"{tmp_path}/t")
    t = table(spark, data, ddl, ["id", SYS.start]).with_df(spark.read.parquet(f"{tmp_path}/t"))
    cut = spark.createDataFrame([(k, T0 + 300 * DAY) for k in range(25)], f"id int, {SYS.start} timestamp")
    late = str(T0 + 500 * DAY)
    update = spark.createDataFrame(
        [(str(k), late, late, "true", "~" if k % 2 else "new", "5", "wide") for k in range(25)],
        f"id string, {SYS.start} string, {SYS.end} string, {SYS.active} string, title string, price string, wide string",
    )
    update.write.parquet(f"{tmp_path}/u")
    update = spark.read.parquet(f"{tmp_path}/u")
    assert history.marked_columns(t, update, "~") == ["title"]
    cells = history.previous_cells(t, update, cut, "~", small=small)
    plan = cells._jdf.queryExecution().executedPlan().toString()
    assert "wide" not in plan and "price" not in plan and cells.columns == ["id", "title"]
    assert rows(cells) == sorted([(k, f"t{280 + k}" if (280 + k) % 3 else None) for k in range(1, 20, 2)], key=repr)
    whole = history.latest_versions(t, cut, small=small)
    expected = rows(history.append_partial_versions(t, update, whole, "~"))
    assert rows(history.append_partial_versions(t, update, cells, "~")) == expected
    untouched = update.withColumn("title", update["wide"])
    assert history.previous_cells(t, untouched, cut, "~", small=small) is None
    batch = rows(history.apply_history_batch(t, earliest=cut, update=untouched, unmodified="~", small=small))
    assert (21, T0 + 500 * DAY, T0 + 500 * DAY, True, "wide", 5, "wide") in batch
