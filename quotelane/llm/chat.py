"""Chat formatting as Spark expressions, with a loss mask and a way back.

The turns of a conversation are collected as structs and sorted. Adjacent turns of one
role are merged into one block by array aggregation; a mark between their texts keeps them
apart, so nothing is lost. A conversation becomes a sequence of blocks

    <|turn|>role<|text|>first text<|next|>second text<|end|>\\n

Control strings inside roles and texts (those of this template and of other common ones)
get a backslash after their first character, one more if there are some already; reading
back takes one away. An escaped text holds no control string, so the output can be cut at
its marks. The output is also kept as segments with a flag: those under the loss mask are
exactly the texts of assistant turns.

Defined results: a null text, role or conversation number counts as an empty string, an
empty role and a conversation of its own; null turns come last; ties of a turn number are
ordered by role and text; repeated rows are turns of their own; an empty table gives an
empty result.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelane.llm.columns import sha256_hex

#: The marks of the template, and the control strings that texts may not hold.
TURN, TEXT, NEXT, END = "<|turn|>", "<|text|>", "<|next|>", "<|end|>\n"
LOSS_ROLE = "assistant"
CONTROL = r"\||s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)({CONTROL})", r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)({CONTROL})", r"$1$2$3")


def formatted(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn",
    role: str = "role", text: str = "text", loss_role: str = LOSS_ROLE,
) -> DataFrame:
    """Rows (conv_id, formatted, segments): ``segments`` are (text, loss) in order, and
    ``formatted`` is their texts joined."""
    blank = lambda c: F.coalesce(turns[c].cast("string"), F.lit(""))
    rows = turns.select(
        turns[conv_id].alias("conv_id"),
        F.struct(
            turns[turn].isNull().alias("unknown"), turns[turn].alias("turn"),
            blank(role).alias("role"), blank(text).alias("text"),
        ).alias("turn"),
    )
    sorted_turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    # Where each run of one role starts, and how far it goes.
    starts = F.filter(
        F.sequence(F.lit(0), F.size("turns") - 1),
        lambda k: (k == 0) | (F.get("turns", k)["role"] != F.get("turns", k - 1)["role"]),
    )
    runs = sorted_turns.select("conv_id", "turns", starts.alias("starts"))
    blocks = F.transform("starts", lambda start, k: F.struct(
        F.get("turns", start)["role"].alias("role"),
        F.transform(
            F.slice("turns", start + 1, F.coalesce(F.get("starts", k + 1), F.size("turns")) - start),
            lambda t: t["text"],
        ).alias("texts")))
    merged = runs.select("conv_id", blocks.alias("blocks"))

    def segment(value: Column, loss: Column) -> Column:
        return F.struct(value.alias("text"), loss.alias("loss"))

    def segments(block: Column) -> Column:
        under = block["role"] == loss_role
        texts = F.transform(block["texts"], lambda t, k: F.array(
            segment(F.when(k == 0, F.lit("")).otherwise(F.lit(NEXT)), F.lit(False)),
            segment(escaped(t), under)))
        head = segment(F.concat(F.lit(TURN), escaped(block["role"]), F.lit(TEXT)), F.lit(False))
        return F.concat(F.array(head), F.flatten(texts), F.array(segment(F.lit(END), F.lit(False))))

    cut = merged.select("conv_id", F.flatten(F.transform("blocks", segments)).alias("segments"))
    return cut.select("conv_id", F.array_join("segments.text", "").alias("formatted"), "segments")


def turns_of(formatted_text: Column) -> Column:
    """The turns (role, text) of a formatted conversation, merged ones apart again."""
    quoted = lambda mark: mark.replace("|", r"\|")
    blocks = F.split(formatted_text, quoted(TURN), -1)
    blocks = F.slice(blocks, F.lit(2), F.size(blocks) - 1)  # nothing precedes the first mark

    def turns(block: Column) -> Column:
        parts = F.split(block, quoted(TEXT), -1)
        body = F.get(parts, F.lit(1))
        texts = F.split(F.substring(body, F.lit(1), F.length(body) - len(END)), quoted(NEXT), -1)
        return F.transform(texts, lambda t: F.struct(
            unescaped(F.get(parts, F.lit(0))).alias("role"), unescaped(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def masked_text(segments: Column) -> Column:
    """All text under the loss mask, as it was before escaping."""
    under = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(under, lambda s: unescaped(s["text"])), "")


def digests(chats: DataFrame) -> DataFrame:
    """What can be read back from formatted conversations, as counts and digests."""
    read = chats.select(
        "conv_id", turns_of(F.col("formatted")).alias("turns"),
        masked_text(F.col("segments")).alias("loss"), F.length("formatted").alias("length"))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        sha256_hex(F.array_join(said, "")).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        sha256_hex(F.col("loss")).alias("loss_sha256"),
        F.col("length").cast("long").alias("formatted_chars"),
    )
