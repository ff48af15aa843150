import itertools
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from changeloom.llm import simhash


def plain_fingerprint(text: str | None) -> int:
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute(rows: list[tuple[int | None, str | None]]) -> list[tuple]:
    prints = [plain_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    for _ in rows:
        for i, j in itertools.combinations(range(len(rows)), 2):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                group[i] = group[j] = min(group[i], group[j])
    ids = {g: min((rows[k][0] for k in range(len(rows)) if group[k] == g and rows[k][0] is not None), default=None) for g in group}
    return sorted(((i, f"{p:016x}", ids[g]) for (i, _), p, g in zip(rows, prints, group, strict=True)), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(60)]
    out: list[tuple[int | None, str | None]] = [(900, None), (901, ""), (902, " \n"), (903, "one two"), (904, "One  TWO"), (None, "alone here"), (905, "ÄÖ x y z")]
    for start in range(0, 60, 6):
        words = rng.choices(vocabulary, k=rng.choice([3, 30, 200]))
        for k in range(6):
            copy = list(words)
            for _ in range(k // 2):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            out.append((start + 5 - k, " ".join(copy)))
    out.append(out[10])
    out.append((7, "a text whose id another one has"))
    out.append((300, " ".join(rng.choices(vocabulary, k=140_000))))
    return out


def test_components_agree_with_comparing_all_pairs(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit(1)).withColumn("label", F.lit("x"))
    got = sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()), key=str)
    assert got == brute(rows)


def test_long_posting_lists_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 4)
    rng = random.Random(5)
    prints = {rng.getrandbits(64) for _ in range(40)}
    centre = rng.getrandbits(64)
    for _ in range(150):
        prints.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.choice([2, 3, 6]))))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    pairs = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"))
    found = {r["node"]: r["label"] for r in simhash.components(pairs).collect()}
    label = {p: p for p in signed}
    for _ in range(8):
        for a, b in itertools.combinations(signed, 2):
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4:
                label[a] = label[b] = min(label[a], label[b])
    assert {p: found.get(p, p) for p in signed} == label


def test_one_row_of_each_group_stays(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("__id", F.lit("kept"))
    left = simhash.drop_near_duplicates(docs)
    assert left.columns == ["doc_id", "text", "__id"]
    heads = [(i, f) for i, f, c in brute(rows) if i == c]
    # Rows of one id are one document, the one with the smallest fingerprint.
    expected = {(i, f) for i, f in heads if i is None or f == min(g for j, g in heads if j == i)}
    got = [(r["doc_id"], f"{plain_fingerprint(r['text']):016x}") for r in left.collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.drop_near_duplicates(docs).count() == 0
