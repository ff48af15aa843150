import pytest
from helpers import rows, table

from changeloom import BatchFiles, ChangeError, KeyedTable, ReadOptions, TableSpec
from changeloom.operators.merge import apply_changes, stack
from changeloom.plans.batches import write_bucketed_batch
from changeloom.sources.bucketed import copy_bucketed, open_bucketed, save_bucketed

DDL = "a int, b string, v string, n long"


@pytest.fixture
def books(spark, tmp_path):
    def save(data, name, buckets=4, **kwargs):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        save_bucketed(table(spark, data, DDL, ["a", "b"], **kwargs), name, buckets, path=f"{tmp_path}/{name}")
        return open_bucketed(spark, name)

    return save


def plan_lines(df):
    """The nodes of the physical plan with their depth in it."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return [(len(line) - len(line.lstrip(" :+-")), line.lstrip(" :+-")) for line in text.split("\n") if line.strip()]


def above_bucketed_scans(df):
    """For each scan of a bucketed table, the nodes between it and the result."""
    lines = plan_lines(df)
    found = []
    for at, (depth, line) in enumerate(lines):
        if "Bucketed: true" in line:
            nodes = []
            for d, node in reversed(lines[:at]):
                if d < depth:
                    nodes.append(node)
                    depth = d
            found.append(nodes)
    return found


DATA = [(k, "x" if k % 2 else "y", f"v{k}", k) for k in range(200)]


@pytest.mark.parametrize("kinds", [{"replace"}, {"update"}, {"delete"}, {"replace", "update", "delete"}])
@pytest.mark.parametrize("buckets", [4, 64])
def test_large_batches_do_not_shuffle_the_target(spark, books, kinds, buckets):
    stored = books(DATA, f"books_{buckets}", buckets)
    plain = table(spark, DATA, DDL, ["a", "b"])
    replace = stack([spark.createDataFrame([(k, "x", "new", -k) for k in range(150, 260)], DDL)])
    update = spark.createDataFrame([(str(k), "x", "~", "7") for k in range(40)] + [("3", "x", None, "~")], "a string, b string, v string, n string")
    delete = spark.createDataFrame([(k, "y") for k in range(0, 60, 2)] * 2, "a int, b string")
    batch = {k: v for k, v in {"replace": replace, "update": update, "delete": delete}.items() if k in kinds}
    result = apply_changes(stored, **batch, unmodified="~", small=False)
    scans = above_bucketed_scans(result.df)
    assert scans and not any("Exchange" in node for nodes in scans for node in nodes)
    assert rows(result) == rows(apply_changes(plain, **batch, unmodified="~", small=False))
    assert rows(result) == rows(apply_changes(stored, **batch, unmodified="~", small=True))
    assert "Exchange" in str(plan_lines(apply_changes(plain, **batch, unmodified="~", small=False).df))


def test_result_is_written_bucket_by_bucket(spark, books, tmp_path):
    stored = books(DATA, "books_old", 4, defaults={"n": "5"})
    changes = spark.createDataFrame([(k, "x", "new") for k in range(190, 230)], "a int, b string, v string")
    state = apply_changes(stored, replace=changes, small=False)
    spark.sql("DROP TABLE IF EXISTS books_new")
    save_bucketed(state, "books_new", stored.buckets, path=f"{tmp_path}/new", dealt=True)
    new = open_bucketed(spark, "books_new")
    assert (new.buckets, new.spec) == (4, stored.spec) and new.spec["n"].default == "5"
    assert rows(new) == rows(state)
    assert len(list((tmp_path / "new").glob("part-*.parquet"))) == 4
    again = apply_changes(new, delete=changes, small=False).df
    assert not any("Exchange" in node for nodes in above_bucketed_scans(again) for node in nodes)
    assert {r[2] for r in rows(again)} == {f"v{k}" for k in range(200)} - {f"v{k}" for k in range(191, 200, 2)}


def test_change_files_into_the_next_table(spark, books, tmp_path):
    books(DATA, "books_one")
    (tmp_path / "r.csv").write_text("b,a,n,v\nx,1,9,\"two\nlines\"\nz,900,1,q\n")
    (tmp_path / "u.csv").write_text("a,b,v,n\n2,y,~,NULL\n")
    (tmp_path / "d.csv").write_text("a,b\n4,y\n")
    files = BatchFiles(replace=(f"{tmp_path}/r.csv",), update=(f"{tmp_path}/u.csv",), delete=(f"{tmp_path}/d.csv",))
    spark.sql("DROP TABLE IF EXISTS books_two")
    options = ReadOptions(null_value="NULL", unmodified="~")
    new = write_bucketed_batch(spark, "books_one", "books_two", files, options, path=f"{tmp_path}/two", small=False)
    expected = {r[:2]: r for r in DATA} | {(1, "x"): (1, "x", "two\nlines", 9), (900, "z"): (900, "z", "q", 1), (2, "y"): (2, "y", "v2", None)}
    del expected[4, "y"]
    assert rows(new) == sorted(expected.values(), key=repr)
    assert rows(open_bucketed(spark, "books_one")) == sorted(DATA, key=repr)


def test_refusals(spark, books, tmp_path):
    stored = books([(1, "x", "v", 1)], "books_taken")
    with pytest.raises(Exception, match="already exists"):
        save_bucketed(stored, "books_taken", 4, path=f"{tmp_path}/other")
    with pytest.raises(ChangeError, match="key"):
        save_bucketed(KeyedTable(stored.df, TableSpec.of(stored.df)), "books_keyless", 4)
    with pytest.raises(ChangeError, match="at least one"):
        save_bucketed(stored, "books_none", 0)
    spark.sql("DROP TABLE IF EXISTS books_flat")
    stored.df.write.option("path", f"{tmp_path}/flat").saveAsTable("books_flat")
    with pytest.raises(ChangeError, match="buckets of its key"):
        open_bucketed(spark, "books_flat")


def test_empty_tables_and_batches(spark, books):
    stored = books([], "books_empty")
    changes = spark.createDataFrame([(1, "x", "v", 1)], DDL)
    assert rows(apply_changes(stored, replace=changes, small=False)) == [(1, "x", "v", 1)]
    assert rows(apply_changes(stored, replace=changes.limit(0), delete=changes, small=False)) == []


def test_copies_keep_key_and_defaults(spark, books, tmp_path):
    stored = books(DATA, "books_origin", 4, defaults={"v": "none"})
    spark.sql("DROP TABLE IF EXISTS books_copy")
    copy = copy_bucketed(stored, "books_copy", 8, path=f"{tmp_path}/copy", keys=["n"])
    assert (copy.buckets, copy.spec.keys, copy.spec["v"].default) == (8, ["a", "b", "n"], "none")
    assert rows(copy) == sorted(DATA, key=repr)
    with pytest.raises(ChangeError, match="not found"):
        copy_bucketed(stored, "books_other", 4, keys=["q"])
    with pytest.raises(ChangeError, match="key"):
        copy_bucketed(KeyedTable(stored.df, TableSpec.of(stored.df)), "books_other", 4)
