import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from quotelane.llm import manifest
from quotelane.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def levels(hashes):
    out = [hashes]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def siblings(tree, place):
    found = []
    for level in tree[:-1]:
        start = place // 8 * 8
        run = level[start : start + 8]
        found.append((run[: place - start], run[place - start + 1 :]))
        place //= 8
    return found


def lowered(row):
    if row[0] is None or zlib.crc32(str(row[0]).encode()) % 3 or row[4] is None:
        return row
    return (*row[:4], "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in row[4]))


def brute_force(rows):
    """The whole report by building every level."""
    languages = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in languages:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[lang] = own, levels([leaf(r) for r in own])
    whole = levels([trees[lang][1][-1][0] for lang in languages])
    out = []
    for k, lang in enumerate(languages):
        own, tree = trees[lang]
        for place, row in enumerate(own):
            path = siblings(tree, place) + siblings(whole, k)
            hashed = leaf(lowered(row))
            for left, right in path:
                hashed = digest(*left, hashed, *right)
            out.append((row[0], tree[0][place], tree[-1][0], whole[-1][0],
                        digest(*[h for left, right in path for h in left + right]), hashed, hashed == whole[-1][0]))
    return out


def in_order(rows):
    return sorted(map(tuple, rows), key=repr)


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [tuple(r) for r in docs.select(*manifest.FIELDS).collect()]
    report = QUERIES["op12_merkle_manifest"](spark, FOLDER)
    assert report.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert in_order(report.collect()) == in_order(brute_force(rows))


@pytest.mark.parametrize("sizes", [(1,), (8, 9), (64, 65, 1), (512,), (513, 7), (1200, 3, 64)])
def test_sizes_around_stored_levels(spark, sizes):
    rng = random.Random(sum(sizes))
    rows = [(i, "s", f"l{k}", i, rng.choice(["Text", "low", ""])) for k, n in enumerate(sizes) for i in range(n)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert in_order(manifest.tamper_report(docs).collect()) == in_order(brute_force(rows))


def test_many_keys_make_a_tree_of_several_stored_levels(spark):
    rows = [(i, None, f"l{i % 700}", 1, f"T{i}") for i in range(1500)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert in_order(manifest.tamper_report(docs).collect()) == in_order(brute_force(rows))


def test_awkward_rows(spark):
    rows = [
        (1, None, None, None, None), (1, "", "", 0, ""), (2, "-", "é", 3, "Ä long TEXT " * 100_000), (None, "a", "é", 1, "NO"),
        (2, "-", "é", 3, "two"), (2, "-", "é", 3, "two"), (None, "a", "é", 1, "NO"), (7, "a", "z", 1, "QUICK"),
        (9, "a", None, 1, "A:B"),
    ]
    docs = spark.createDataFrame([(*r, "x", 5, "y") for r in rows], SCHEMA + ", tree string, place int, hash string")
    assert in_order(manifest.tamper_report(docs).collect()) == in_order(brute_force(rows))
    assert manifest.tamper_report(docs.where("false")).collect() == []


def test_equal_ids_are_spread_and_kept(spark):
    rows = [(5, "s", "en", 1, "same")] * 900 + [(6, "s", "en", 1, "other")] * 10
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert in_order(manifest.tamper_report(docs).collect()) == in_order(brute_force(rows))


def test_only_every_third_level_is_stored(spark):
    docs = spark.range(600).select(
        F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit("en").alias("lang"),
        F.lit(1).alias("n_chars"), F.lit("T").alias("text"))
    made = manifest.Manifest(docs)
    sizes = [sorted(level.select(F.size("members")).toPandas().iloc[:, 0]) for level in made.trees.levels]
    assert sizes == [[88, 512], [2]]
    root = made.root().collect()
    proofs = made.proofs()
    assert len(root) == 1 and proofs.count() == 600
    assert proofs.where(manifest.folded(F.col("leaf"), F.col("path")) != root[0]["root"]).count() == 0
    assert proofs.where(F.size("path") != 4).count() == 0
