import numpy as np
import pytest

from changeloom.llm import mixing


def plain_targets(sizes: dict) -> dict:
    """Sharing again and again what capped sources leave."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(order)}
    left, open_, out = sum(sizes.values()), set(sizes), {}
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not over:
            return out | share
        for s in over:
            out[s] = 3.0 * sizes[s]
            open_.discard(s)
            left -= 3 * sizes[s]


@pytest.mark.parametrize("seed", range(5))
def test_targets(spark, seed):
    rng = np.random.default_rng(seed)
    sizes = {f"s{k:02d}": int(rng.choice([0, 1, 10, 1000, 100_000]) * rng.integers(1, 9)) for k in range(rng.integers(1, 12))} | {None: 5, "é": 70}
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(rows).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def test_counts_meet_the_budget_as_well_as_any_subset():
    rng = np.random.default_rng(1)
    for _ in range(200):
        sizes = np.sort(rng.choice(np.arange(1, 40), rng.integers(1, 7), replace=False))
        counts = rng.integers(1, 5, len(sizes))
        budget = int(rng.integers(0, (sizes * counts).sum() + 1))
        taken = mixing.pick_counts(sizes, counts, budget)
        assert (0 <= taken).all() and (taken <= counts).all() and (sizes * taken).sum() <= budget
    many = np.arange(1, 3000)
    taken = mixing.pick_counts(many, np.full(2999, 50), 123_456_789)
    assert (many * taken).sum() == 123_456_789


def test_mix_of_documents(spark):
    rng = np.random.default_rng(3)
    rows = [(k, "w " * int(rng.integers(1, 60)), rng.choice(["a", "b", "c", "d"], p=[0.1, 0.2, 0.6, 0.1])) for k in range(800)]
    rows = [(i, t, str(s)) for i, t, s in rows] + [(900, None, "a"), (901, " \t\n", None), (902, "one two", None), (None, "x y z", "b")]
    rows += [(5, "same words", "c")] * 40
    docs = spark.createDataFrame([(*r, -1.0, "t") for r in rows], "doc_id long, text string, source string, mix_target double, base string")
    mixed = mixing.mix(docs).toPandas()
    assert len(mixed) == len(rows) and "base" in mixed.columns
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = plain_targets(sizes)
    for source, part in mixed.groupby("source", dropna=False):
        source = source if isinstance(source, str) else None
        taken = (part["mix_size"] * part["mix_times"]).sum()
        assert part["mix_target"].iloc[0] == pytest.approx(want[source]) and abs(taken - want[source]) <= max(1, 0.002 * want[source])
        assert part["mix_times"].between(0, 3).all() and (part["mix_source_size"] == sizes[source]).all()
    columns = ["doc_id", "source", "mix_size", "mix_times"]
    again = mixing.mix(docs.repartition(5)).toPandas()
    assert sorted(map(str, again[columns].values.tolist())) == sorted(map(str, mixed[columns].values.tolist()))
    assert mixing.mix(docs.limit(0)).count() == 0


def test_own_columns_of_any_name_stay(spark):
    names = "doc_id long, text string, source string, mix_hash int, mix_source int, mix_part string, __mix_source string, mix_base int"
    rows = [(k, "a b " * (k % 5), f"s{k % 3}", 1, 2, "p", "q", k) for k in range(40)]
    docs = spark.createDataFrame(rows, names)
    got = mixing.mix(docs)
    assert got.columns[: len(docs.columns)] == docs.columns
    assert sorted(tuple(r) for r in got.select(*docs.columns).collect()) == rows
