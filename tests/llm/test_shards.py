import random
import zlib
from pathlib import Path

import numpy as np
import pytest

from changeloom.llm import shards

VOCABULARY = Path(shards.VOCABULARY).read_bytes()


def test_cutting_texts_changes_no_ids():
    rng, encoder = random.Random(1), shards.Encoder(VOCABULARY)
    letters = "ab 'stre\n\t  1²Ⅷ_-!?éß漢́‍😀\x1c\x85\xa0  ª٣"
    for _ in range(5000):
        text = "".join(rng.choices(letters, k=rng.randrange(40)))
        assert np.frombuffer(encoder.encode(text), np.uint16).tolist() == encoder.any.encode_ordinary(text), text


@pytest.mark.parametrize("total", [1, 2, 3, 5, 100, 1024, 4097])
def test_slots_are_a_permutation(total):
    for key in (0, 7):
        slots = shards.permuted(np.arange(total), total, key)
        assert sorted(slots.tolist()) == list(range(total))
        assert shards.permuted(slots, total, key, inverse=True).tolist() == list(range(total))
    if total > 1000:
        assert shards.permuted(np.arange(total), total, 1).tolist() != shards.permuted(np.arange(total), total, 2).tolist()


def test_shards_hold_every_text_once(spark, tmp_path):
    rows = [(k, f"text number {k}, said \n\n{'again ' * (k % 40)}é漢") for k in range(300)]
    rows += [(1000, None), (1001, ""), (None, "nameless " * 50_000), (3, "twice"), (3, "twice")]
    staged = str(tmp_path / "rows")
    spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, slot int").repartition(3).write.parquet(staged)
    docs, out = spark.read.parquet(staged), str(tmp_path / "shards")
    found = shards.materialise(docs, out, length=64, shard_records=100, key=5).toPandas().sort_values("slot", ignore_index=True)
    assert found["slot"].tolist() == list(range(len(found)))
    records = []
    for k in range(-(-len(found) // 100)):
        (file,) = Path(out, f"shard={k}").glob("part-*")
        data = file.read_bytes()
        assert len(data) % (2 * 64 + 2) == 0
        records.append(shards.records_of(data, 64))
        assert shards.records_of(data, 64, first=7).tolist() == records[-1][7:].tolist()
    records = np.concatenate(records)
    assert [zlib.crc32(r.tobytes()) for r in records] == found["crc"].tolist()
    assert (found["offset"] == found["slot"] % 100 * 130).all() and (found["shard"] == found["slot"] // 100).all()
    # Back in the order of their numbers, the sequences of each partition spell its texts.
    order = shards.permuted(np.arange(len(found)), len(found), 5)
    encoder = shards.Encoder(VOCABULARY)
    end = int(np.frombuffer(encoder.separator, np.uint16)[0])
    ids = np.concatenate([records[s][: found["tokens"][s]] for s in order])
    texts = [encoder.any.decode(p[:-1].tolist()) for p in np.split(ids, np.flatnonzero(ids == end) + 1) if len(p)]
    assert sorted(texts) == sorted(t or "" for _, t in rows)
    assert shards.materialise(docs.limit(0), str(tmp_path / "none")).count() == 0
