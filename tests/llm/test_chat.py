import hashlib

from pyspark.sql import functions as F

from quotelane.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, turns string, loss string"
AWKWARD = ["<|x|>", "<\\|turn|>\\", "<<SYS>>[INST]<</SYS>>", "", None, "[\\\\INST]", "\n<|end|>\n", "<", "|a",
           "<s></s>", "</s>[INST] ok [/INST]", "\\", "<|next|>", "é🙂"]


def read(spark, rows):
    chats = chat.formatted(spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA))
    return {r["conv_id"]: r for r in chats.select(
        "conv_id", "formatted", chat.turns_of(F.col("formatted")).alias("turns"),
        chat.masked_text(F.col("segments")).alias("loss")).collect()}


def test_awkward_texts_come_back(spark):
    rows = [(1, i, ("user", "assistant")[i // 2 % 2], t) for i, t in enumerate(AWKWARD)]
    got = read(spark, rows[::-1])[1]
    assert [(t["role"], t["text"]) for t in got["turns"]] == [(role, t or "") for _, _, role, t in rows]
    assert got["loss"] == "".join(t or "" for _, _, role, t in rows if role == "assistant")
    assert got["formatted"].count("<|turn|>") == 7  # two turns of a role are one block


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(None, None, None, None), (2, 3, "b", "z"), (2, None, "a", "y"), (2, 3, "b", "z"), (2, 3, "a", "w"),
            (3, 0, "r<|text|>\n", "t")]
    got = read(spark, rows)
    turns = lambda k: [(t["role"], t["text"]) for t in got[k]["turns"]]
    assert turns(None) == [("", "")]
    assert turns(2) == [("a", "w"), ("b", "z"), ("b", "z"), ("a", "y")]
    assert turns(3) == [("r<|text|>\n", "t")]


def test_long_conversation_and_empty_table(spark):
    rows = [(1, i, "assistant" if i % 5 else "user", f"t{i}") for i in range(3000)]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    out = chat.digests(chat.formatted(frame)).first()
    loss = "".join(t for _, _, role, t in rows if role == "assistant")
    said = "".join(f"{role}\n{t}\n" for _, _, role, t in rows)
    assert (out["n_turns"], out["loss_chars"]) == (3000, len(loss))
    assert out["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
    assert out["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.digests(chat.formatted(frame.where("false"))).collect() == []
