import numpy as np
import pytest
import xxhash

from quotelane.llm import simhash
from quotelane.llm.components import connected

DOCS = "doc_id long, text string, fingerprint string, fp long"


def brute_fingerprint(text, k=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [b" ".join(words)]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(values, distance=2):
    values = sorted(set(values))
    root = {v: v for v in values}
    for _ in values:
        changed = False
        for a in values:
            for b in values:
                if bin((a ^ b) & (1 << 64) - 1).count("1") <= distance and root[b] < root[a]:
                    root[a], changed = root[b], True
        if not changed:
            break
    return root


def near_prints():
    """Chains, stars and loners of 64-bit numbers."""
    rng = np.random.default_rng(3)
    values = [int(v) for v in rng.integers(-(2**63), 2**63 - 1, 40)]
    for v in values[:12]:
        for _ in range(5):
            bits = rng.choice(64, rng.integers(1, 4), replace=False)
            for b in bits:
                v ^= -(1 << 63) if b == 63 else 1 << int(b)
            values.append(v)
    return values


def test_every_close_pair_meets_at_an_anchor_of_one_of_them():
    rng = np.random.default_rng(1)
    tables = simhash.golay_tables(2)
    x = rng.integers(-(2**63), 2**63 - 1, 500)
    y = x.copy()
    for n, k in enumerate(rng.integers(0, 3, 500)):
        for b in rng.choice(64, k, replace=False):
            y[n] ^= np.int64(-(1 << 63) if b == 63 else 1 << int(b))
    row, anchor, covered = simhash._expand(x, tables)
    owner = dict(zip(row[covered].tolist(), anchor[covered].tolist()))
    assert len(owner) == 500 and covered.sum() == 500
    row, anchor, _ = simhash._expand(y, tables)
    assert {(r, a) for r, a in owner.items()} <= set(zip(row.tolist(), anchor.tolist()))


@pytest.mark.parametrize("limit", [2048, 2])
def test_links_join_what_brute_force_joins(spark, monkeypatch, limit):
    monkeypatch.setattr(simhash, "COVERED_PER_TASK", limit)
    values = near_prints()
    frame = spark.createDataFrame([(v,) for v in set(values)], "fp long")
    found = {r["node"]: r["root"] for r in connected(simhash.links(frame)).collect()}
    expected = brute_roots(values)
    assert {v: found.get(v, v) for v in expected} == expected


def test_large_runs_are_joined_without_all_pairs():
    fp = np.arange(300, dtype=np.int64)
    covered = np.ones(300, bool)
    u, v = simhash._compare(np.zeros(300, int), np.zeros(300, int), fp, covered, 2)
    assert len(u) == 299 and set(v.tolist()) == {0}


def test_documents_and_edge_cases(spark):
    long = " ".join(f"w{i}" for i in range(70_000))
    rows = [(5, None), (3, " \n"), (7, "One two"), (8, "one  TWO"), (9, "a b c d"), (9, "a b c d"),
            (None, "a b c d"), (10, long), (11, "É b c"), (12, "é b c"), (None, "only null ids")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], DOCS)
    got = [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()]
    prints = [f"{brute_fingerprint(t):016x}" for _, t in rows]
    component = [3, 3, 7, 7, 9, 9, 9, 10, 11, 12, None]
    expected = [(i, p, c) for (i, _), p, c in zip(rows, prints, component)]
    assert sorted(got, key=str) == sorted(expected, key=str)
    kept = simhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [10, 11, 12, 3, 7, 9, None]
    assert simhash.near_duplicates(docs.where("false")).collect() == []
    assert simhash.without_near_duplicates(docs.where("false")).collect() == []


def test_components_of_chains_and_repeated_links(spark):
    chain = [(i, i + 1) for i in range(40)] + [(7, 3), (3, 7), (50, 50), (61, 60), (60, 61)]
    frame = spark.createDataFrame(chain, "u long, v long")
    found = {r["node"]: r["root"] for r in connected(frame).collect()}
    assert found == {**{i: 0 for i in range(41)}, 60: 60, 61: 60}
