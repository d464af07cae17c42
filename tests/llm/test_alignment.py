import hashlib
import random
import time
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from quotelane.llm import alignment
from quotelane.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def spans(sizes):
    out, at = [], 0
    for size in sizes:
        out.append((at, at + size))
        at += size
    return out


def brute_force(rows):
    """All columns from byte ranges, every A token against every B token near it."""
    a = Tokenizer.from_file(BYTES)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    vocabulary = alignment.Pair(BYTES, PIECES)
    made, total = [], Counter()
    for doc_id, text in rows:
        whole = (" " + (text or "")).encode()
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a = [vocabulary.a_bytes[i] for i in ids_a]
        bytes_b = [vocabulary.b_bytes[i] for i in ids_b]
        if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            ids_a = ids_b = bytes_a = bytes_b = []
        at_a, at_b = spans(map(len, bytes_a)), spans(map(len, bytes_b))
        common = sorted({e for _, e in at_a} & {e for _, e in at_b})
        cut = defaultdict(lambda: ([], []))
        for side, ids, at in ((0, ids_a, at_a), (1, ids_b, at_b)):
            for i, (_, end) in zip(ids, at):
                cut[next(c for c in common if c >= end)][side].append(str(i))
        groups = ";".join(f"{','.join(cut[c][0])}|{','.join(cut[c][1])}" for c in common)
        links = Counter(
            (i, j) for i, (s, e) in zip(ids_a, at_a) for j, (t, f) in zip(ids_b, at_b) if s < f and t < e)
        total.update(links)
        made.append((doc_id, ids_a, ids_b, len(common), links, groups))
    most = defaultdict(int)
    for (_, j), n in total.items():
        most[j] = max(most[j], n)
    return [
        (doc_id, len(ids_a), len(ids_b), n, sum(links.values()),
         sum(k for p, k in links.items() if total[p] == most[p[1]]), sum(k * total[p] for p, k in links.items()),
         hashlib.sha256(groups.encode()).hexdigest() if groups else "")
        for doc_id, ids_a, ids_b, n, links, groups in made
    ]


def in_order(rows):
    return sorted(map(tuple, rows), key=repr)


AWKWARD = [
    (1, None), (2, ""), (3, " "), (3, "Hello  world\n\n\tthere"), (3, "Hello  world\n\n\tthere"), (None, "naïve 🙂 日本語"),
    (5, "<|endoftext|> </s><s>"), (6, "a▁b"), (7, "<0x41>"), (8, "\x00\x01"), (9, "aaaaaaaaaaaaaaaaaaaaaaaaa" * 20), (10, "x"),
]


def test_awkward_texts(spark):
    docs = spark.createDataFrame(
        [(i, t, "x", 1) for i, t in AWKWARD], "doc_id long, text string, block string, n_a int").repartition(3)
    found = alignment.alignments(docs, BYTES, PIECES)
    assert found.columns == COLUMNS
    assert in_order(found.collect()) == in_order(brute_force(AWKWARD))
    empty = alignment.alignments(docs.where("false"), BYTES, PIECES)
    assert empty.columns == COLUMNS and empty.collect() == []


def test_query_equals_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    rows = [r for r in rows if len(r[1] or "") < 3000]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert in_order(alignment.alignments(docs, BYTES, PIECES).collect()) == in_order(brute_force(rows))
    assert QUERIES["op13_token_alignment"](spark, FOLDER).count() == 200


@pytest.mark.parametrize("hot_parts", [1, 20, 10_000])
def test_blocks_and_shares_change_nothing(spark, monkeypatch, hot_parts):
    monkeypatch.setattr(alignment, "BLOCK_PAIRS", 7)
    monkeypatch.setattr(alignment, "_ROW_PAIRS", 2)
    monkeypatch.setattr(alignment, "REMEMBERED", 3)
    monkeypatch.setattr(alignment, "HOT_PARTS", hot_parts)
    rows = AWKWARD + [(100 + k, f"the same words and number {k}, the same") for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert in_order(alignment.alignments(docs, BYTES, PIECES).collect()) == in_order(brute_force(rows))


def test_groups_are_kept_on_request(spark):
    docs = spark.createDataFrame([("k", "unbelievable things")], "doc_id string, text string")
    row = alignment.alignments(docs, BYTES, PIECES, keep_groups=True).first()
    assert row["doc_id"] == "k" and hashlib.sha256(row["groups"].encode()).hexdigest() == row["groups_sha256"]
    pair = alignment.Pair(BYTES, PIECES)
    for group in row["groups"].split(";"):
        left, right = ([int(i) for i in side.split(",")] for side in group.split("|"))
        assert b"".join(pair.a_bytes[i] for i in left) == b"".join(pair.b_bytes[i] for i in right)


def test_the_fast_encoder_gives_the_ids_of_the_tokenizer():
    rng, level = random.Random(2), alignment.ByteLevel(BYTES)
    assert level.fast is not None
    letters = [" ", "  ", "\n", "\t", "a", "b", "the", "Ab", "'s", "'LL", "1", "23", ".", "!?", "é", "ñ", "中", "🙂", "\u0301",
               "\u00a0", "\u2003", "\u200b", "\x00", "\x85", "\u180e", "²", "Ⅷ", "٣", "<|endoftext|>", "▁", "\ufeff", "न"]
    for _ in range(4000):
        text = " " + "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        assert level.fast.encode_ordinary(text) == level.encode(text) == level.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000][::37]
    for c in points:
        text = f" a{c}b {c}{c} 1{c}2 .{c}. {c} '{c}  {c}\n"
        assert level.fast.encode_ordinary(text) == level.tokenizer.encode(text, add_special_tokens=False).ids, hex(ord(c))


@pytest.mark.parametrize("text", ["x" * 300_000, " " * 300_000, "ab" * 150_000, "word " * 200_000 + "x" * 50_000, "\n \t" * 100_000])
def test_very_long_texts(text):
    pair, started = alignment.Pair(BYTES, PIECES), time.monotonic()
    n_a, n_b, n_groups, groups, links = pair.document(text)
    assert n_a == len(pair.a.tokenizer.encode(" " + text, add_special_tokens=False).ids)
    assert len(links) >= max(n_a, n_b) and groups.count(";") == n_groups - 1
    assert time.monotonic() - started < 20


def test_parts_give_what_whole_texts_give():
    rng, pair = random.Random(6), alignment.Pair(BYTES, PIECES)
    assert pair.cut
    letters = [" ", " ", "  ", "\n", "\t", "a", "the", "Ab", "'s", "12", ".", "!?", "é", "中", "🙂", "\u00a0", "\u2003", "\x1c",
               "\x85", "\u3000", "<0x41>", "</s>"]
    for _ in range(4000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(1, 40)))
        (ids_a, ids_b), = pair.encode([" " + text])
        groups, links = pair.aligned(ids_a, ids_b)
        assert pair.document(text) == (len(ids_a), len(ids_b), len(groups), ";".join(groups), links), repr(text)


def test_documents_learnt_together_give_what_each_gives_alone():
    rng = random.Random(7)
    letters = [" ", "  ", "\n", "a", "the", "Ab", "12", ".", "é", "中", "🙂", " ", "▁", "</s>", "zqx"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(600)]
    texts += [None, "", " ", "▁a", "a▁b c"] * 3
    alone = alignment.Pair(BYTES, PIECES)
    assert alignment.Pair(BYTES, PIECES).documents(texts) == [alone.document(text) for text in texts]
