import itertools
import random
import re
import time

import pytest

from quotelane.llm import licenses
from quotelane.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def brute_force(text):
    """The base columns, word by word."""
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    places = [
        (i, label) for phrase, label in BASE.items() for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({label for _, label in places})))


@pytest.fixture(scope="module")
def scanner():
    return licenses.Scanner()


def base_of(found):
    return found["n_words"], found["n_base"], found["first_word"], found["last_word"], found["base_labels"]


def test_random_texts_equal_brute_force(scanner):
    rng = random.Random(4)
    parts = ["gnu", "General", "public", "LICENSE", "apache", "cc", "BY", "mit", "é", "İ", "1", " ", "\n", "-", "\x00",
             "\x7f", "cc by", "mit license", "Kmit"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) + rng.choice(["", " ", ".", "\n"]) for _ in range(rng.randint(0, 25)))
        assert base_of(scanner.scan(text.encode())) == brute_force(text), repr(text)


def test_query_equals_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = QUERIES["op11_license_scan"](spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert base_of(r) == brute_force(texts[r["doc_id"]])
        assert set(r["base_labels"].split(",")) <= set(r["labels"].split(","))
        assert r["labels"] == ",".join(sorted(set(r["labels"].split(","))))
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"])
    assert any(r["n_base"] for r in rows)


OPERANDS = {"MIT": ("mit", 2), "GPL-3.0-only": ("gpl", 0), "MPL-2.0": ("mpl", 1), "CC0-1.0": ("cc0", 3)}


def expression(rng, depth):
    """A random expression: its text, labels and use, written with every bracket it needs."""
    kind = rng.choice(["id", "with", "and", "or"]) if depth else "id"
    if kind in ("id", "with"):
        name = rng.choice(list(OPERANDS))
        label, use = OPERANDS[name]
        if kind == "id":
            return name, {label}, use, 4
        return f"{name} {rng.choice(['with', 'WITH'])} Some-exception-2.0", {label}, min(use + 1, 3), 3
    binds = {"or": 1, "and": 2}[kind]
    sides = [expression(rng, depth - 1) for _ in range(2)]
    text = f" {rng.choice([kind, kind.upper()])} ".join(f"({s[0]})" if s[3] < binds else s[0] for s in sides)
    return text, sides[0][1] | sides[1][1], (max if kind == "or" else min)(sides[0][2], sides[1][2]), binds


def test_random_expressions():
    rng = random.Random(5)
    for _ in range(2000):
        text, labels, use, _ = expression(rng, 5)
        read = licenses.evaluate(text.encode())
        assert read[:2] == (labels, use), text
        assert read[2].lower() == text.lower()
        assert licenses.evaluate(read[2].encode())[:2] == (labels, use)


@pytest.mark.parametrize(
    "text, normal",
    [("MIT and some words", "MIT"), ("MIT AND (", "MIT"), ("(MIT", None), ("foo", None), ("", None), ("OR MIT", None),
     ("MIT OR", "MIT"), ("MIT) or ISC", "MIT"), ("(MIT OR ISC) WITH x-1", "(MIT OR ISC)"), ("MIT WITH (a)", "MIT"),
     ("Zlib.", "Zlib"), ("Made-Up-7.0", "Made-Up-7.0"), ("MIT\nOR ISC", "MIT")],
)
def test_longest_complete_beginning(text, normal):
    read = licenses.evaluate(text.encode())
    assert (read and read[2]) == normal


def test_tags_and_notices(scanner):
    found = scanner.scan(
        b"// SPDX-License-Identifier: (MIT or GPL-2.0-only WITH Linux-syscall-note) AND Zlib */\nspdx license identifier =\n"
        b"SPDX-License-Identifier: nothing known. Creative Commons Attribution-ShareAlike")
    assert found["expressions"] == ["(MIT OR GPL-2.0-only WITH Linux-syscall-note) AND Zlib"]
    assert found["labels"] == "cc-by,cc-by-sa,gpl,mit,zlib" and found["base_labels"] == ""
    assert found["score"] == 1.0 and found["uses"] == "notice"
    strict = scanner.scan(b"License-Expression: LicenseRef-Own OR Made-Up-7.0")
    assert strict["labels"] == "other" and strict["uses"] == "strict"
    assert scanner.scan(b"a committed licensee, near cc bytes")["labels"] == ""


@pytest.mark.parametrize(
    "text",
    [b"mit license " * 200_000, b"x" * 2_000_000, b"SPDX-License-Identifier: MIT OR ISC " * 50_000,
     b"SPDX-License-Identifier: " + b"(" * 100_000 + b"MIT" + b" OR ISC)" * 100_000, b"cc by " * 300_000],
)
def test_very_long_texts_take_linear_time(scanner, text):
    started = time.monotonic()
    found = scanner.scan(text)
    assert time.monotonic() - started < 20
    assert found["n_words"] > 0


def test_rows(spark):
    texts = [None, "", "MIT License", "MIT License", "CC-BY", "no licence"]
    docs = spark.createDataFrame(
        [(k if k != 3 else 2, t, 1, "x") for k, t in enumerate(texts)] + [(None, "cc by", 1, "x")],
        "doc_id long, text string, n_words int, labels string")
    rows = licenses.license_report(docs).collect()
    got = sorted((r["doc_id"] is None, r["doc_id"], r["n_words"], r["labels"], r["score"] > 0, r["expressions"]) for r in rows)
    assert got == [
        (False, 0, 0, "", False, []), (False, 1, 0, "", False, []), (False, 2, 2, "mit", True, []),
        (False, 2, 2, "mit", True, []), (False, 4, 2, "cc-by", True, []), (False, 5, 2, "", False, []),
        (True, None, 2, "cc-by", True, []),
    ]
    assert licenses.license_report(docs.where("false")).collect() == []


def test_families():
    for name, label in {"GPL-2.0+": "gpl", "LGPL-2.1-or-later": "lgpl", "CC-BY-4.0": "cc-by", "BSD-3-Clause": "bsd",
                        "CC-BY-NC-SA-4.0": "cc-by-nc-sa", "MIT-0": "mit-0", "0BSD": "0bsd", "GPLx": "other"}.items():
        assert licenses.family(name) == label
    assert not set(itertools.chain(BASE.values())) - set(licenses.FAMILIES)
