import pytest
from helpers import rows, table

from changeloom import ChangeError
from changeloom.operators.merge import apply_changes
from changeloom.sources.clustered import open_clustered, save_clustered

DDL = "a int, b string, v string"
DATA = [(k, "x", f"value {k} " * 5) for k in range(20_000)]


def scans(df):
    """Rows that each file scan of an executed plan gave."""
    found = []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        if name.startswith("Scan parquet"):
            found.append(node.metrics().get("numOutputRows").get().value())
        children = node.children()
        for k in range(children.size()):
            walk(children.apply(k))

    walk(df._jdf.queryExecution().executedPlan())
    return found


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("clustered") / "t")
    save_clustered(table(spark, DATA, DDL, ["a", "b"], defaults={"v": "d"}), path, files=4, row_group_bytes=1 << 15)
    return open_clustered(spark, path)


BATCHES = {
    "replace": lambda s: {"replace": s.createDataFrame([(k, "x", "new") for k in range(9000, 9900)] + [(9500, "y", "other")], DDL)},
    "update": lambda s: {"update": s.createDataFrame([(str(k), "x", "~" if k % 2 else "set") for k in range(9000, 9900)], "a string, b string, v string")},
    "delete": lambda s: {"delete": s.createDataFrame([(k, "x") for k in range(9000, 9900)] * 2, "a int, b string")},
    "beyond": lambda s: {"replace": s.createDataFrame([(k, "x", "new") for k in range(30_000, 30_100)], DDL)},
}


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("kind", sorted(BATCHES))
def test_a_batch_reads_few_row_groups_of_what_it_joins(spark, stored, kind, small):
    batch = BATCHES[kind](spark)
    result = apply_changes(stored, **batch, unmodified="~", small=small).df
    plain = table(spark, DATA, DDL, ["a", "b"])
    assert rows(result) == rows(apply_changes(plain, **batch, unmodified="~", small=small))
    read = sorted(scans(result))
    joined, untouched = read[:-1], read[-1]
    # Of 20,000 rows 900 lie between the bounds, or none; a scan that gave nothing may be left out of the plan.
    assert joined or kind == "beyond"
    assert max(joined, default=0) <= (0 if kind == "beyond" else 4000)
    assert untouched == 20_000 if kind == "beyond" else untouched < 20_000
    assert stored.spec["v"].default == "d"


def test_rows_without_key_and_batches_without_rows(spark, tmp_path):
    data = [(None, "x", "a"), (1, "x", "b"), (2, "x", "c")]
    save_clustered(table(spark, data, DDL, ["a", "b"]), f"{tmp_path}/t", files=2)
    t = open_clustered(spark, f"{tmp_path}/t")
    empty = spark.createDataFrame([], DDL)
    assert rows(apply_changes(t, replace=empty, delete=empty, small=False)) == sorted(data, key=repr)
    assert rows(apply_changes(t, delete=spark.createDataFrame([(2, "x"), (None, "x")], "a int, b string"), small=False)) == rows(t.df.filter("v <> 'c'"))
    spark.createDataFrame(data, DDL).write.parquet(f"{tmp_path}/plain")
    with pytest.raises(ChangeError, match="without|not written with a key"):
        open_clustered(spark, f"{tmp_path}/plain")
