"""SimHash near-duplicates: a covering code gives anchor points, fingerprints meet there.

A fingerprint has 64 bits. Its first 46 bits are two words of 23 bits, and the anchors are
the pairs of codewords of the perfect Golay code: every 23-bit word lies within 3 bits of
exactly one codeword, so every fingerprint is covered by one anchor (at most 3 bits away
in each half). The other 18 bits are free. A fingerprint within ``distance`` bits of a
covered one exceeds the radius of that anchor by at most ``distance`` bits, both halves
together, so each fingerprint is copied to every such anchor, about 61 for two bits, and
compared there with the fingerprints that the anchor covers. No link is missed.

Equal fingerprints are one row from the start, so groups of copies cost nothing. At an
anchor linked fingerprints are joined at once; it emits at most one link per row that it
holds, not all pairs. An anchor that covers very many fingerprints is split: its covered
fingerprints are dealt to several tasks, and the others are copied to each.

Defined results: a null or blank text has fingerprint zero; a text of fewer words than a
shingle is one shingle; null ids do not count as smallest id (a component of null ids
only has a null id); repeated rows stay; an empty table gives an empty result.
"""

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelane.llm.components import connected
from quotelane.session import materialize

SHINGLE = 3
DISTANCE = 2
#: An anchor that covers more fingerprints than this is split.
COVERED_PER_TASK = 2048
#: Up to so many split anchors are broadcast (16 bytes each); more are joined by shuffle.
BROADCAST_ROWS = 100_000

#: Fixed value: a generator polynomial of the binary Golay code of length 23.
GENERATOR = 0b101011100011


# --- fingerprints -----------------------------------------------------------------------


def simhash(text: str | None, shingle: int) -> int:
    """The fingerprint as a signed 64-bit number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # ASCII rules
    if not words:
        return 0
    shingle = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    starts = range(0, len(words) - shingle + 1, 1 << 16)
    total, counts = 0, np.zeros(64, np.int64)
    for at in starts:  # very long texts in pieces
        piece = words[at : at + (1 << 16) + shingle - 1]
        hashes = [digest(b" ".join(s), 42) for s in zip(*(piece[k:] for k in range(shingle)))]
        total += len(hashes)
        bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(0, dtype=np.int64)
    packed = np.packbits(2 * counts > total).tobytes()
    return int.from_bytes(packed, "big", signed=True)


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([simhash(t, shingle) for t in texts.to_pylist()], pa.int64())

    return F.arrow_udf(of, "long")(F.coalesce(text, F.lit("")))


def fingerprint_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


# --- anchors ----------------------------------------------------------------------------


def _remainder(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words modulo the generator: their syndromes."""
    words = words.copy()
    for bit in range(22, 10, -1):
        words ^= np.where(words >> bit & 1, GENERATOR << (bit - 11), 0)
    return words


def golay_tables(distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each excess 0..distance: ragged lists, by syndrome, of what to flip in a word
    to reach the codewords that lie 3 + excess bits away (excess 0: 3 bits or fewer)."""
    codewords = np.arange(1 << 12, dtype=np.int64) << 11
    codewords |= _remainder(codewords)
    codewords = codewords[np.bitwise_count(codewords) <= 6 + distance]  # others are farther
    light = np.array([sum(c) for k in range(4) for c in combinations([1 << b for b in range(23)], k)])
    leaders = np.zeros(1 << 11, np.int64)
    leaders[_remainder(light)] = light
    flips = leaders[:, None] ^ codewords[None, :]
    away = np.maximum(np.bitwise_count(flips).astype(np.int64) - 3, 0)
    lists = []
    for excess in range(distance + 1):
        chosen = away == excess
        starts = np.concatenate([[0], np.cumsum(chosen.sum(1))])
        lists.append((starts, flips[chosen]))
    return lists


def _expand(fp: np.ndarray, tables) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All anchors of each fingerprint: its row number, the anchor, whether it covers."""
    bits = fp.view(np.uint64)
    halves = [(bits >> np.uint64(41)).astype(np.int64), (bits >> np.uint64(18)).astype(np.int64) & 0x7FFFFF]
    syndromes = [_remainder(h) for h in halves]
    rows, anchors, covers = [], [], []
    for e1, (starts1, flips1) in enumerate(tables):
        for e2, (starts2, flips2) in enumerate(tables[: len(tables) - e1]):
            n1 = starts1[syndromes[0] + 1] - starts1[syndromes[0]]
            n2 = starts2[syndromes[1] + 1] - starts2[syndromes[1]]
            row = np.repeat(np.arange(len(fp)), n1 * n2)
            k = np.arange(len(row)) - np.repeat(np.cumsum(n1 * n2) - n1 * n2, n1 * n2)
            first = halves[0][row] ^ flips1[starts1[syndromes[0][row]] + k // n2[row]]
            second = halves[1][row] ^ flips2[starts2[syndromes[1][row]] + k % n2[row]]
            rows.append(row)
            anchors.append((first >> 11) << 12 | second >> 11)
            covers.append(np.full(len(row), e1 + e2 == 0))
    return np.concatenate(rows), np.concatenate(anchors), np.concatenate(covers)


def at_anchors(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Rows (anchor, fp, covered): each fingerprint at every anchor it may be linked at."""

    def expand(batches):
        tables = golay_tables(distance)
        for batch in batches:
            column = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for at in range(0, len(column), 4096):
                fp = np.ascontiguousarray(column[at : at + 4096])
                row, anchor, covered = _expand(fp, tables)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(fp[row]), pa.array(covered)],
                    ["anchor", "fp", "covered"],
                )

    return fps.select("fp").mapInArrow(expand, "anchor long, fp long, covered boolean")


def _split_hot(copies: DataFrame, own: DataFrame) -> DataFrame:
    """Add ``part``: 0, or at an anchor covering many fingerprints one of several parts."""
    hot = materialize(
        own.groupBy("anchor").count().where(F.col("count") > COVERED_PER_TASK)
        .select("anchor", F.ceil(F.col("count") / COVERED_PER_TASK).cast("int").alias("parts")),
        "hot-anchors",
    )
    rows = hot.count()
    if not rows:
        return copies.withColumn("part", F.lit(0))
    joined = copies.join(F.broadcast(hot) if rows <= BROADCAST_ROWS else hot, "anchor", "left")
    own_part = F.pmod(F.xxhash64("fp"), F.coalesce("parts", F.lit(1))).cast("int")
    every = F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)
    # A covered row goes to all parts too, but compares as covered in its own part only.
    return joined.select("anchor", "fp", F.col("covered").alias("was"), own_part.alias("own"),
                         F.explode(every).alias("part")).select(
        "anchor", "fp", (F.col("was") & (F.col("own") == F.col("part"))).alias("covered"), "part")


# --- comparison at each anchor ------------------------------------------------------------


def _joined(fp: np.ndarray, covered: np.ndarray, distance: int):
    """Links that join what is linked at one anchor: (member, smallest member)."""
    label = np.arange(len(fp))
    for i in np.flatnonzero(covered):
        near = np.bitwise_count(fp ^ fp[i]) <= distance
        roots = np.unique(label[near])
        if len(roots) > 1:
            label[np.isin(label, roots)] = roots[0]
    moved = np.flatnonzero(label != np.arange(len(fp)))
    return fp[moved], fp[label[moved]]


def _compare(anchor, part, fp, covered, distance):
    """Links within whole runs of equal (anchor, part)."""
    start = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1])])
    size = np.diff(np.r_[start, len(anchor)])
    own = np.add.reduceat(covered.astype(np.int64), start)
    large = (own > 0) & (size > 64)
    out = []
    # Small runs at once: every covered row against every row of its run.
    run = np.repeat(np.arange(len(start)), size)
    row = np.flatnonzero(covered & ~large[run])
    for at in range(0, len(row), 1 << 16):
        i = row[at : at + (1 << 16)]
        n = size[run[i]]
        left = np.repeat(i, n)
        right = np.repeat(start[run[i]], n) + np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n)
        linked = (np.bitwise_count(fp[left] ^ fp[right]) <= distance) & (fp[left] != fp[right])
        out.append((fp[left][linked], fp[right][linked]))
    for r in np.flatnonzero(large):
        span = slice(start[r], start[r] + size[r])
        out.append(_joined(fp[span], covered[span], distance))
    return [np.concatenate(x) if x else np.zeros(0, np.int64) for x in zip(*out)] or [np.zeros(0, np.int64)] * 2


def links(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links (u, v) between distinct fingerprints that join exactly those fingerprints
    which chains of differences of ``distance`` bits or fewer join."""
    copies = at_anchors(fps, distance)
    dealt = _split_hot(copies, at_anchors(fps, 0))

    def compare(batches):
        left = None  # a run may go on in the next batch
        for batch in batches:
            new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            left = new if left is None else [np.concatenate(x) for x in zip(left, new)]
            if not len(left[0]):
                continue
            last = np.flatnonzero((left[0] != left[0][-1]) | (left[1] != left[1][-1]))
            cut = last[-1] + 1 if len(last) else 0
            if cut:
                u, v = _compare(*[x[:cut] for x in left], distance)
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])
                left = [x[cut:] for x in left]
        if left is not None and len(left[0]):
            u, v = _compare(*left, distance)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return (
        dealt.select("anchor", "part", "fp", "covered")
        .repartition("anchor", "part")
        .sortWithinPartitions("anchor", "part", "fp")
        .mapInArrow(compare, "u long, v long")
        .select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
        .distinct()
    )


def clustered(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Rows (fp, root, component_id) for each distinct fingerprint of (doc_id, fp)."""
    groups = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprints")
    roots = connected(links(groups, distance))
    named = groups.join(roots, groups["fp"] == roots["node"], "left").select(
        groups["fp"], F.coalesce("root", "fp").alias("root"), "first"
    )
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    return named.join(smallest, "root").select("fp", "root", "component_id")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
    shingle: int = SHINGLE, distance: int = DISTANCE,
) -> DataFrame:
    """Rows (doc_id, fingerprint, component_id), one per row of ``docs``."""
    prints = materialize(
        docs.select(docs[doc_id].alias("doc_id"), fingerprint(docs[text], shingle).alias("fp")),
        "prints",
    )
    return prints.join(clustered(prints, distance), "fp").select(
        "doc_id", fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id"
    )


def without_near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
    shingle: int = SHINGLE, distance: int = DISTANCE,
) -> DataFrame:
    """One document of each component, the one with the smallest id, in full."""
    names = docs.columns
    rows = materialize(
        docs.select(F.struct(*[docs[f"`{c}`"] for c in names]).alias("row"),
                    docs[doc_id].alias("doc_id"), fingerprint(docs[text], shingle).alias("fp")),
        "printed",
    )
    clusters = clustered(rows.select("doc_id", "fp"), distance)
    first = rows.join(clusters, "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    return first.dropDuplicates(["root"]).select("row.*")
