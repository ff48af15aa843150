import numpy as np
import pytest

from changeloom.llm import decontaminate as dc


def plain_tiles(item, stretches, least):
    """Greedy tiling by trying all pairs of places."""
    free, open_, covered = np.ones(len(item), bool), [np.ones(len(s), bool) for s in stretches], 0
    while True:
        best = (least - 1, 0, 0, 0)
        for a in range(len(item)):
            for k, s in enumerate(stretches):
                for b in range(len(s)):
                    n = 0
                    while a + n < len(item) and b + n < len(s) and item[a + n] == s[b + n] and free[a + n] and open_[k][b + n]:
                        n += 1
                    if n > best[0]:
                        best = (n, a, k, b)
        n, a, k, b = best
        if n < least:
            return covered
        free[a : a + n] = open_[k][b : b + n] = False
        covered += n


@pytest.mark.parametrize("letters", [2, 3, 6])
def test_tiles_cover_what_plain_tiling_covers(letters):
    rng = np.random.default_rng(letters)
    for _ in range(60):
        item = rng.integers(0, letters, rng.integers(5, 25)).astype(np.uint64)
        stretches = [rng.integers(0, letters, rng.integers(5, 20)).astype(np.uint64) for _ in range(rng.integers(1, 4))]
        found = dc.tiles(item, stretches)
        assert sum(t[3] for t in found) == plain_tiles(item, stretches, dc.SEED)
        for a, k, b, n in found:
            assert n >= dc.SEED and item[a : a + n].tolist() == stretches[k][b : b + n].tolist()


ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"


@pytest.fixture(scope="module")
def tables(spark):
    docs = [
        (1, f"words before. {ITEM.upper()}, and after"),
        (2, "theta iota kappa lambda mu other words alpha beta gamma delta epsilon zeta eta"),
        (3, "alpha beta gamma delta epsilon and then something else entirely"),
        (4, "alpha mu beta lambda gamma kappa delta iota epsilon theta zeta eta"),
        (5, None),
        (6, ""),
        (1, f"words before. {ITEM.upper()}, and after"),
        (None, "x " * 100_000 + ITEM),
    ]
    items = [(7, ITEM), (7, "too short"), (8, None), (None, "one two three four five six")]
    return spark.createDataFrame([(*d, 0.0) for d in docs], "doc_id long, text string, coverage double"), spark.createDataFrame(items, "item_id long, text string")


def test_whole_reordered_and_partial_passages(tables):
    got = sorted(((r["doc_id"], r["item_id"], round(r["coverage"], 3), r["tiles"]) for r in dc.contamination(*tables).collect()), key=str)
    assert got == sorted([(1, 7, 1.0, 1), (1, 7, 1.0, 1), (2, 7, 1.0, 2), (None, 7, 1.0, 1)], key=str)
    every = dc.contamination(*tables, coverage=0.0).filter("doc_id = 3").collect()
    assert [(r["coverage"], r["longest"]) for r in every] == [(5 / 12, 5)]


def test_clean_rows_stay_as_they_are(tables):
    left = dc.drop_contaminated(*tables)
    assert left.columns == tables[0].columns
    assert sorted(r["doc_id"] for r in left.collect()) == [3, 4, 5, 6]


def test_empty_tables(tables):
    docs, items = tables
    assert dc.contamination(docs.limit(0), items).count() == 0
    assert dc.contamination(docs, items.limit(0)).count() == 0
    assert dc.drop_contaminated(docs, items.limit(0)).count() == docs.count()


def test_own_columns_of_any_name_stay(spark):
    item = " ".join(f"word{k}" for k in range(30))
    docs = spark.createDataFrame([(1, item, 5, 6), (2, "clean text of a few words here", 7, 8)], "doc_id long, text string, __tainted int, text_key int")
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert [tuple(r) for r in dc.drop_contaminated(docs, benchmark).collect()] == [(2, "clean text of a few words here", 7, 8)]
