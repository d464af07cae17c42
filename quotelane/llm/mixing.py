"""Mixing sources to target weights, in fixed-length blocks of words.

The words of a source, document after document, are packed into blocks of ``block_words``
(the last may be shorter). The output has ``shards`` shards. For each shard a multinomial
draw, weighted by what every source has left of its target, says how many of the shard's
slots a source gets. The i-th slot of a source takes block ``p(i)``, where p is a
pseudorandom permutation of the source's block numbers, another one in each pass over the
source; slots and blocks are joined by block number. The last slot of a source is cut so
that the source's words meet its target to the word.

The driver holds one row per source and ``shards`` x sources counts, never documents.
Places of documents within a source are sums over buckets of about ``BUCKET_ROWS``
documents, so a source with a third of all rows is spread over many tasks.

Defined results: a null source is a source of its own and comes last; a text without words
takes no part (0 words taken); repeated rows are documents of their own; reruns agree; an
empty table gives an empty mix.
"""

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotelane.llm.columns import SPACES, word_count
from quotelane.session import materialize

BLOCK_WORDS = 256
SHARDS = 64
SHARE = 1.5
MOST = 2.0
SEED = 20240917
BUCKET_ROWS = 20_000
#: Slots per row of the table that slots are generated from.
RANGE_SLOTS = 1 << 15
#: Up to so many sources are broadcast (about 100 bytes each); more are joined by shuffle.
BROADCAST_SOURCES = 100_000
#: A word and the white space after it.
WORD = r"[^\x20\x09-\x0D]+" + "(?:" + SPACES + ")?"


def cycling_weight(position: int) -> float:
    """3, 1, 2 for the first sources in order, and again."""
    return (3.0, 1.0, 2.0)[position % 3]


def share_out(sizes: Sequence[int], weights: Sequence[float], share: float, most: float) -> list[float]:
    """Targets: ``share`` of all sizes, by weight; none above ``most`` times its size."""
    targets = [0.0] * len(sizes)
    left, free = share * sum(sizes), list(range(len(sizes)))
    while free:
        total = sum(weights[k] for k in free)
        over = [k for k in free if left * weights[k] / total > most * sizes[k]]
        if not over:
            for k in free:
                targets[k] = left * weights[k] / total
            break
        for k in over:
            targets[k] = most * sizes[k]
        left -= sum(targets[k] for k in over)
        free = [k for k in free if k not in set(over)]
    return targets


def permuted(index: np.ndarray, size: int, key: int, back: bool = False) -> np.ndarray:
    """A keyed permutation of range(size): a Feistel network, walked until in range."""
    bits = max(2, (size - 1).bit_length() + (size - 1).bit_length() % 2) // 2
    mask = np.uint64((1 << bits) - 1)
    shift = np.uint64(bits)
    keys = np.random.SeedSequence(key).generate_state(4, np.uint64)

    def mix(x: np.ndarray, k: np.uint64) -> np.ndarray:
        x = (x ^ k) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return (x ^ (x >> np.uint64(32))) & mask

    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> shift, out[todo] & mask
        if back:
            for k in keys[::-1]:
                left, right = right ^ mix(left, k), left
        else:
            for k in keys:
                left, right = right, left ^ mix(right, k)
        out[todo] = left << shift | right
        todo = todo[out[todo] >= size]
    return out.astype(np.int64)


@dataclass
class Source:
    """What the plan knows of one source."""

    name: str | None
    rows: int
    size: int
    target: float = 0.0
    slots: int = 0
    last_words: int = 0

    def plan(self, number: int, block: int, seed: int) -> None:
        """Slots that hold the target's words, and how many words the last one keeps."""
        words = round(self.target)
        if not words:
            return
        passes, rest = divmod(words, self.size)
        blocks = -(-self.size // block)
        short = self.size - (blocks - 1) * block
        self.slots = passes * blocks
        self.last_words = block
        if rest:
            at = int(permuted(np.array([blocks - 1]), blocks, _key(seed, number, passes), back=True)[0])
            needed = -(-rest // block)
            if at < needed:  # the short block is among them
                needed = max(at + 1, -(-(rest + block - short) // block))
            before = (needed - 1) * block - (block - short) * (at < needed - 1)
            self.slots += needed
            self.last_words = rest - before


def _key(seed: int, number: int, passes: int) -> int:
    return (seed << 40) ^ (number << 8) ^ passes


def draw_counts(slots: Sequence[int], shards: int, seed: int) -> np.ndarray:
    """Multinomial counts per shard and source that add up to ``slots`` per source."""
    rng = np.random.default_rng(seed)
    left = np.array(slots, np.int64)
    counts = np.zeros((shards, len(left)), np.int64)
    for shard in range(shards):
        need = -(-int(left.sum()) // (shards - shard))
        while need:
            drawn = np.minimum(rng.multinomial(need, left / left.sum()), left)
            counts[shard] += drawn
            left -= drawn
            need -= int(drawn.sum())
    return counts


class Mix:
    """The plan of a mix and its tables."""

    def __init__(
        self, docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
        weight: Callable[[int], float] = cycling_weight, share: float = SHARE, most: float = MOST,
        block_words: int = BLOCK_WORDS, shards: int = SHARDS, seed: int = SEED, keep_rows: bool = False,
    ):
        self.spark, self.block, self.text = docs.sparkSession, block_words, text
        self.names, self.seed, self.keep_rows = docs.columns, seed, keep_rows
        # Rows are told apart by number, since ids may repeat; texts move once, at the end.
        row = [F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")] if keep_rows else []
        self.rows = materialize(
            docs.select(
                F.monotonically_increasing_id().alias("number"), docs[doc_id].alias("doc_id"),
                docs[source].cast("string").alias("source"), word_count(docs[text]).alias("size"), *row),
            "mix-rows",
        )
        sized = self.rows.drop("row")
        totals = sized.groupBy("source").agg(F.count("*").alias("rows"), F.sum("size").alias("size")).collect()
        self.sources = sorted((Source(r["source"], r["rows"], r["size"]) for r in totals),
                              key=lambda s: (s.name is None, s.name or ""))
        weights = [weight(k) for k in range(len(self.sources))]
        targets = share_out([s.size for s in self.sources], weights, share, most)
        for number, (one, target) in enumerate(zip(self.sources, targets)):
            one.target = target
            one.plan(number, block_words, seed)
        self.counts = draw_counts([s.slots for s in self.sources], shards, seed)
        self.placed = self._place(sized)

    def source_table(self) -> DataFrame:
        rows = [(k, s.name is None, s.name or "", max(1, math.ceil(s.rows / BUCKET_ROWS)), s.size, s.target)
                for k, s in enumerate(self.sources)]
        table = self.spark.createDataFrame(
            rows, "sid int, unnamed boolean, name string, buckets int, source_size long, target double")
        return F.broadcast(table) if len(rows) <= BROADCAST_SOURCES else table

    def _place(self, sized: DataFrame) -> DataFrame:
        """Each document with its number of words before it in its source (``start``)."""
        named = self.source_table()
        rows = sized.join(
            named, (F.col("source").isNull() == named["unnamed"])
            & (F.coalesce(sized["source"], F.lit("")) == named["name"]),
        ).withColumn("bucket", F.pmod(F.xxhash64("doc_id"), "buckets").cast("int"))
        before = Window.partitionBy("sid", "bucket").orderBy("doc_id", "number").rowsBetween(Window.unboundedPreceding, -1)
        rows = rows.withColumn("within", F.coalesce(F.sum("size").over(before), F.lit(0)))
        earlier = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        totals = rows.groupBy("sid", "bucket").agg(F.sum("size").alias("words"))
        totals = totals.select("sid", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset"))
        return materialize(
            rows.join(totals, ["sid", "bucket"]).select(
                "number", "doc_id", "sid", "size", "source_size", "target",
                (F.col("offset") + F.col("within")).alias("start")),
            "placed",
        )

    def slots(self) -> DataFrame:
        """Rows (sid, block, shard, pass, words): the blocks that the slots of shards take."""
        seed, block, ranges = self.seed, self.block, []
        for k, one in enumerate(self.sources):
            first = 0
            for shard, count in enumerate(self.counts[:, k].tolist()):
                for at in range(first, first + count, RANGE_SLOTS):
                    n = min(RANGE_SLOTS, first + count - at)
                    ranges.append((k, shard, at, n, -(-one.size // block), one.slots, one.last_words))
                first += count

        def fill(batches):
            for batch in batches:
                for k, shard, at, n, blocks, slots, last in zip(*(c.to_pylist() for c in batch.columns)):
                    index = np.arange(at, at + n)
                    number = np.empty(n, np.int64)
                    for passes in np.unique(index // blocks):
                        now = index // blocks == passes
                        number[now] = permuted(index[now] % blocks, blocks, _key(seed, k, int(passes)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, k, np.int32)), pa.array(number),
                         pa.array(np.full(n, shard, np.int32)), pa.array((index // blocks).astype(np.int32)),
                         pa.array(np.where(index == slots - 1, last, block))],
                        ["sid", "block", "shard", "pass", "words"])

        table = self.spark.createDataFrame(
            ranges, "sid int, shard int, at long, n long, blocks long, slots long, last long")
        return table.repartition("sid", "shard", "at").mapInArrow(
            fill, "sid int, block long, shard int, pass int, words long")

    def taken(self) -> DataFrame:
        """Rows (sid, block, shard, pass, number, doc_id, first_word, n_words), one for each
        piece of a document in a slot; ``number`` is that of the document in ``rows``."""
        size, start = F.col("size"), F.col("start")

        def piece(b):
            first = F.greatest(b * self.block - start, F.lit(0))
            return F.struct(
                b.alias("block"), first.alias("first_word"),
                (F.least((b + 1) * self.block - start, size) - first).alias("n_words"),
                F.greatest(start - b * self.block, F.lit(0)).alias("at"))

        blocks = F.sequence(F.floor(start / self.block), F.floor((start + size - 1) / self.block))
        pieces = self.placed.where("size > 0").select(
            "sid", "number", "doc_id", F.explode(F.transform(blocks, piece)).alias("p"))
        pieces = pieces.select("sid", "number", "doc_id", "p.*")
        fits = F.least(F.col("n_words"), F.col("words") - F.col("at"))
        # Spark takes the slots for as few as the ranges they come from; both sides grow with
        # the data, so neither is broadcast.
        joined = self.slots().hint("merge").join(pieces, ["sid", "block"]).withColumn("n_words", fits)
        return joined.where("n_words > 0").drop("words", "at")

    def words_taken(self) -> DataFrame:
        """One row per document: doc_id, size, source_size, target, taken."""
        sums = self.taken().groupBy("number").agg(F.sum("n_words").alias("taken"))
        return self.placed.join(sums, "number", "left").select(
            "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))

    def documents(self) -> DataFrame:
        """The mix as documents: one row per document and pass over its source, its text
        the words that the mix takes in that pass. ``n_chars`` follows the text."""
        if not self.keep_rows:
            raise ValueError("the mix was planned without keep_rows")
        passes = self.taken().groupBy("number", "pass").agg(
            F.sort_array(F.collect_list(F.struct("first_word", "n_words"))).alias("spans"))
        passes = passes.groupBy("number").agg(F.collect_list("spans").alias("passes"))
        words = F.regexp_extract_all(F.col(f"row.`{self.text}`"), F.lit(WORD), F.lit(0))
        rows = self.rows.join(passes, "number").select("row", "passes", words.alias("words"))
        part = lambda s: F.slice("words", (s["first_word"] + 1).cast("int"), s["n_words"].cast("int"))
        texts = F.transform("passes", lambda spans: F.array_join(F.flatten(F.transform(spans, part)), ""))
        rows = rows.select("row", F.explode(texts).alias("mixed"))
        changed = {self.text: F.col("mixed"), "n_chars": F.length("mixed").cast("long")}
        return rows.select(*[
            (changed[n] if n in changed else F.col(f"row.`{n}`")).alias(n) for n in self.names])
