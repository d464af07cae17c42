import math

import numpy as np
import pytest

from quotelane.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, start string, n_chars long"


@pytest.mark.parametrize("size", [1, 2, 3, 5, 64, 1000])
def test_permutations(size):
    for key in (1, 2):
        out = mixing.permuted(np.arange(size), size, key)
        assert sorted(out) == list(range(size))
        assert (mixing.permuted(out, size, key, back=True) == np.arange(size)).all()


def test_targets_reshare_what_is_above_the_most():
    targets = mixing.share_out([100, 10, 1000], [3, 3, 1], 1.5, 2.0)
    assert targets == [200.0, 20.0, 1445.0]
    assert mixing.share_out([0, 0], [1, 1], 1.5, 2.0) == [0.0, 0.0]
    assert mixing.share_out([], [], 1.5, 2.0) == []


def test_draws_add_up_and_follow_the_weights():
    counts = mixing.draw_counts([600, 300, 0, 100], 10, 4)
    assert counts.sum(0).tolist() == [600, 300, 0, 100] and (counts.sum(1) == 100).all()
    assert counts[:, 0].std() > 0  # drawn, not dealt evenly
    assert mixing.draw_counts([], 4, 1).shape == (4, 0)


def documents(spark):
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(f"d{i}w{k}" for k in range(rng.integers(1, 60))), ("a", "b", None)[i % 3], "s", "t", 0) for i in range(150)]
    rows += [(200, None, "a", "s", "t", 0), (201, " \n", "b", "s", "t", 0), (None, "x y z", "c", "s", "t", 0),
             (None, "x y z", "c", "s", "t", 0), (202, " ".join(["v"] * 9000), "d", "s", "t", 0)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("block", [7, 256])
def test_words_meet_targets(spark, block):
    docs = documents(spark)
    found = mixing.Mix(docs, block_words=block, shards=5).words_taken().collect()
    again = mixing.Mix(docs, block_words=block, shards=5).words_taken().collect()
    assert sorted(map(str, found)) == sorted(map(str, again)) and len(found) == docs.count()
    assert all(r["taken"] <= 2 * r["size"] for r in found)
    sums = {}
    for r in found:
        total = sums.setdefault(r["source_size"], [r["target"], 0, 0])
        total[1] += r["size"]
        total[2] += r["taken"]
    assert len(sums) == 5
    for size, (target, words, taken) in sums.items():
        assert words == size and taken == round(target)
    whole = sum(sums)
    assert math.isclose(sum(t for t, _, _ in sums.values()), 1.5 * whole)


def test_mixed_documents_hold_their_own_words(spark):
    docs = documents(spark)
    mix = mixing.Mix(docs, block_words=7, shards=3, keep_rows=True)
    out = mix.documents()
    assert out.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = out.collect()
    for r in rows:
        words, own = r["text"].split(), texts[r["doc_id"]].split()
        assert r["n_chars"] == len(r["text"]) and len(words) <= len(own) and set(words) <= set(own)
    assert sum(len(r["text"].split()) for r in rows) == sum(round(s.target) for s in mix.sources)


def test_empty_table(spark):
    docs = documents(spark).where("false")
    assert mixing.Mix(docs).words_taken().collect() == []
    assert mixing.Mix(docs, keep_rows=True).documents().collect() == []
