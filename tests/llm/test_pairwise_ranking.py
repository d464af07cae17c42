import zlib

import numpy as np

from quotelane.llm import ranking

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, label string, score string"


def test_held_out_labels_are_predicted(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    found = ranking.scored(docs, labels).join(labels, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)
    held = [r for r in found if r["held_out"]]
    assert np.mean([r["predicted"] == r["quality"] for r in held]) > 0.95
    good = [r["score"] for r in held if r["quality"] == 1]
    bad = [r["score"] for r in held if r["quality"] == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.97


def test_held_out_labels_are_not_learned(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    turned = labels.selectExpr(
        "doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2, 1 - quality, quality) AS quality")
    one, two = (ranking.fit(docs, x) for x in (labels, turned))
    assert np.array_equal(one.weights, two.weights) and one.threshold == two.threshold


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "a b c " * 9000), (3, "a b c " * 9000), (None, "| | !! ### x")]
    docs = spark.createDataFrame([(i, t, "l", "s") for i, t in rows], SCHEMA)
    nothing = spark.createDataFrame([], "doc_id long, quality int")
    found = ranking.scored(docs, nothing).collect()
    assert len(found) == 5 and all(abs(r["score"] - 0.7) < 1e-12 for r in found)
    odd = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (3, None), (None, 1), (5, 7)], "doc_id long, quality int")
    found = ranking.scored(docs, odd).collect()
    assert len(found) == 5 and all(0 <= r["score"] <= 1 for r in found)
    assert ranking.scored(docs.where("false"), odd).collect() == []
