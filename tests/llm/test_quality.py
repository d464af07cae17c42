import math
import re
from collections import Counter

from quotelane.llm import quality

SCHEMA = "doc_id long, text string, lang string, kept string, n_words string, row string"


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {p for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for p in (i, i + 1, i + 2)}
    seen, repeats = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeats += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeats, len(covered))


def distance(p, q):
    half = lambda a, b: a * math.log2(2 * a / (a + b)) / 2 if a > 0 else 0.0
    return math.sqrt(sum(half(a, b) + half(b, a) for a, b in zip(p, q)))


def histogram(text):
    classes = [r"[a-z]", r"[A-Z]", r"[0-9]", r"[\x20\x09-\x0D]", r"""[.,;:!?'"()-]""", r"[#*$%&|<>]"]
    found = [len(re.findall(c, text)) for c in classes]
    return [*found, len(text) - sum(found)]


def sample():
    prose = "the cat of the house and the dog in a garden is by the old tree with leaves on it for now "
    rows = [(i, prose * (3 + i % 3) + f"word{i}", "en") for i in range(60)]
    rows += [(100, "ZZ!! QQ!! " * 60, "en"), (101, "### $$$ %%% a " * 30, "en"), (102, "short text", "en")]
    rows += [(103, None, "en"), (104, "", None), (105, prose * 5, None), (106, prose * 5, "xx")]
    rows += [(107, "a b\na b\n\n  \na b\nc d e f", "en"), (108, "\t\x0b\x0c\r\n x", "en"), (1, rows[1][1], "en")]
    return rows


def test_counts_and_distances_match_brute_force(spark):
    rows = sample()
    docs = spark.createDataFrame([(i, t, x, "k", "n", "r") for i, t, x in rows], SCHEMA)
    found = quality.judged(docs).select("row.doc_id", "row.text", "row.lang", "n_words", "word_chars",
        "n_symbols", "n_dup_lines", "n_repeat_words", "class_distance", "word_distance", "base_failed", "kept").collect()
    assert len(found) == len(rows)
    english = [t or "" for _, t, x in rows if x == "en"]
    every = [t or "" for _, t, _ in rows]

    def reference(texts):
        chars = [sum(c) for c in zip(*map(histogram, texts))]
        words = Counter(w.lower() for t in texts for w in re.findall(r"[^\x20\x09-\x0D]+", t))
        total = sum(words.values())
        top = sorted(((-n, w) for w, n in words.items() if n > 1))[: quality.COMMON_WORDS]
        return [c / sum(chars) for c in chars], {w: -n / total for n, w in top}

    for r in found:
        text = r["text"] or ""
        assert tuple(r[3:8]) == counts(text)
        n, repeats = r["n_words"], r["n_repeat_words"]
        assert r["base_failed"] == (n < 50 or 100 * repeats > 50 * n)
        if n < 50:
            assert r["class_distance"] is None and r["word_distance"] is None and not r["kept"]
            continue
        chars, common = reference(english if r["lang"] == "en" else every)
        own = histogram(text)
        assert math.isclose(r["class_distance"], distance([c / sum(own) for c in own], chars), abs_tol=1e-9)
        words = Counter(w.lower() for w in re.findall(r"[^\x20\x09-\x0D]+", text))
        p = [words[w] / n for w in common]
        q = list(common.values())
        assert math.isclose(r["word_distance"], distance([*p, 1 - sum(p)], [*q, 1 - sum(q)]), abs_tol=1e-7)
        judged = r["class_distance"] <= quality.CLASS_DISTANCE and r["word_distance"] <= quality.WORD_DISTANCE
        assert r["kept"] == (judged and not r["base_failed"])


def test_kept_documents_keep_their_columns(spark):
    prose = " ".join(f"the word{i} of" for i in range(40))
    docs = spark.createDataFrame([(1, prose, "en", "k", "n", "r"), (2, "x", "en", "k", "n", "r")], SCHEMA)
    kept = quality.kept_documents(docs)
    assert kept.columns == docs.columns and [r["doc_id"] for r in kept.collect()] == [1]
    assert quality.kept_documents(docs.where("false")).collect() == []


def test_labels_of_the_test_data(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = quality.judged(docs).select("row.doc_id", "base_failed", "kept").join(labels, "doc_id").collect()
    assert all(r["kept"] for r in found if r["quality"] == 1 and not r["base_failed"])
    assert sum(r["kept"] for r in found if r["quality"] == 0) <= 1
