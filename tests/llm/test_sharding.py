import itertools
import zlib

import numpy as np
import pytest

from quotelane.llm import sharding

SCHEMA = "doc_id long, text string, lang string, source string, shard int, slot long"


@pytest.mark.parametrize("dimensions,bits", [(1, 4), (2, 4), (3, 3), (4, 2)])
def test_the_curve_visits_every_cell_by_single_steps(dimensions, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dimensions)))
    index = sharding.hilbert_index(cells, bits)
    assert sorted(index) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(index)], axis=0)).sum(1) == 1).all()


def documents(spark, n=500):
    rows = [(i, "x" * (i * 37 % 400), ("en", "de", None)[i % 3], f"s{i % 7}", 1, 1) for i in range(n)]
    rows += [(5, "same", "en", "s1", 1, 1)] * 3 + [(None, None, None, None, None, None), (7, "é", "en", "", 1, 1)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("task_rows", [100_000, 50])
def test_counts_slots_and_digests(spark, monkeypatch, task_rows):
    monkeypatch.setattr(sharding, "TASK_ROWS", task_rows)
    docs = documents(spark)
    texts = {}
    for r in docs.collect():
        texts.setdefault(r["doc_id"], set()).add(r["text"])
    rows = sharding.sharded(docs).collect()
    assert len(rows) == docs.count()
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r["shard"], []).append(r)
        assert (r["size"], r["text_crc32"]) in {
            (len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for t in texts[r["doc_id"]]}
    assert sorted(by_shard) == list(range(24))
    sizes = [len(v) for v in by_shard.values()]
    assert max(sizes) - min(sizes) <= 1
    last = -1
    for shard in range(24):
        own = sorted(by_shard[shard], key=lambda r: r["slot"])
        assert [r["slot"] for r in own] == list(range(len(own)))
        assert own[0]["curve"] >= last and [r["curve"] for r in own] == sorted(r["curve"] for r in own)
        last = own[-1]["curve"]


def test_few_rows_and_none(spark):
    docs = documents(spark)
    few = sharding.sharded(docs.limit(3)).collect()
    assert len(few) == 3 and len({r["shard"] for r in few}) == 3 and {r["slot"] for r in few} == {0}
    assert sharding.sharded(docs.where("false")).collect() == []


def test_files_prune_by_every_dimension(spark, tmp_path):
    docs = documents(spark).drop("shard", "slot")
    sharding.write_shards(docs, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == docs.count() and set(docs.columns) < set(back.columns)
    shards_of = back.where("source = 's3'").select("shard").distinct().count()
    assert shards_of < 16
