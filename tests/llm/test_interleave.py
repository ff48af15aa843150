import hashlib
import zlib
from collections import Counter, defaultdict

from changeloom.llm import interleave


def plain(rows, shards, seed):
    """Shard and slot of rows (key columns..., source), ranked source by source in one list."""

    def digits(text, n):
        return int(hashlib.md5(text.encode()).hexdigest()[:n], 16)

    strata = defaultdict(list)
    for *key, source in rows:
        order = digits("|".join([str(seed), *("" if k is None else str(k) for k in key)]), 15)
        strata["-" if source is None else f"={source}"].append((order, [(k is not None, k or 0) for k in key], (*key, source)))
    places = []
    for name, members in strata.items():
        phase = digits(f"{seed}|{name}", 13) / 2**52
        for rank, (order, ties, row) in enumerate(sorted(members, key=lambda m: m[:2])):
            places.append(((rank + phase) / len(members), name, order, ties, row))
    out = Counter()
    for at, (*_, row) in enumerate(sorted(places, key=lambda p: p[:4])):
        shard = at * shards // len(places)
        out[(*row, shard, at - -(-shard * len(places) // shards))] += 1
    return out


def got(df):
    return Counter(tuple(r) for r in df.collect())


def test_agrees_with_one_sorted_list_and_shards_match_the_mixture(spark):
    rows = [(k, f"t{k % 7}", "big" if k % 3 else f"s{k % 40}") for k in range(3000)] + [(k, "x", None) for k in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sharded = interleave.interleave(docs, 7, seed=5)
    result = got(sharded)
    assert result == plain(rows, 7, 5)
    by_shard = Counter(r[3] for r in result)
    assert max(by_shard.values()) - min(by_shard.values()) <= 1
    total = Counter(r[2] for r in rows)
    for (source, _), n in Counter((r[2], r[3]) for r in result).items():
        assert abs(n - total[source] / 7) <= 2 * (1 + total[source] / len(rows) * len(total))


def test_another_number_of_buckets_changes_nothing(spark, monkeypatch):
    rows = [(k, "t", f"s{k % 3}") for k in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    expected = plain(rows, 40, interleave.SEED)
    for most in (1, 3, 1000):
        monkeypatch.setattr(interleave, "MOST_BUCKETS", most)
        assert got(interleave.interleave(docs)) == expected


def test_small_odd_and_empty_tables(spark):
    rows = [(None, None, None), (None, None, None), (1, "a", ""), (1, "a", ""), (2, "", "-"), (None, "b", "=")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert got(interleave.interleave(docs, 4, seed=1)) == plain(rows, 4, 1)
    assert got(interleave.interleave(docs.limit(0), 4)) == Counter()


def test_own_columns_stay(spark):
    docs = spark.createDataFrame([(1, "a", "s", 9, 8, 7, 6)], "doc_id long, text string, source string, shard int, slot int, _n int, _place int")
    sharded = interleave.interleave(docs, 3)
    assert sharded.columns == [*docs.columns, "shard_", "slot_"]
    assert tuple(sharded.first()) == (1, "a", "s", 9, 8, 7, 6, 0, 0)


def test_report_measures_whole_texts_and_written_shards_read_back(spark, tmp_path):
    texts = [(1, "x" * 300_000 + "é", "a"), (2, None, "b"), (3, "", None), (4, "ß\x00", "a")]
    docs = spark.createDataFrame(texts, "doc_id long, text string, source string").selectExpr("*", "1 as n_chars", "2 as size")
    result = {r["doc_id"]: r for r in interleave.report(docs).collect()}
    for doc_id, text, _ in texts:
        data = (text or "").encode()
        assert (result[doc_id]["size"], result[doc_id]["text_crc32"]) == (len(data) + 16, zlib.crc32(data))
    assert {r["law"] for r in result.values()} == {"rows"} and {r["grown_shard"] for r in result.values()} == {None}
    sharded = interleave.interleave(docs, 2)
    interleave.write_shards(sharded, f"{tmp_path}/shards", files=3)
    assert got(spark.read.parquet(f"{tmp_path}/shards").select(*sharded.columns)) == got(sharded)
