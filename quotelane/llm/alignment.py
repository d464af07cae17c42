"""Two tokenizers side by side: groups of tokens over equal bytes, and links between ids.

Both tokenizers cut the same bytes, a space and the text. The ends at which tokens of both
stop are found by intersecting the hash sets of their cumulative ends, kept as dictionaries
from an end to an index. The sorted common ends slice both id lists into groups; within a
slice, every two tokens whose bytes overlap are linked. A slice has no common end inside, so
its links are one path through both lists, found by two pointers.

How often two ids are linked is counted over the whole table. Documents are gathered in
blocks of about ``BLOCK_PAIRS`` distinct linked pairs. A block sends each of its pairs once to
be counted, and once more to fetch the count, so frequent pairs are summed up before each
shuffle. Pairs held by more than one in ``HOT_PARTS`` of all (block, pair) rows number at most
``HOT_PARTS`` and are broadcast; the others are joined by shuffle, where no pair has a larger
share than that. The highest count of each id of the second vocabulary is broadcast: at most
one row per piece.

Defined results: null and empty texts have no tokens, nor have texts whose tokens do not give
the bytes again (for example one that holds the piece model's word mark): zeros and an empty
digest. Special tokens' strings are plain text. A very long text is a block of its own.
Repeated rows are documents of their own and count as often; null ids are kept; an empty
table gives an empty result.
"""

import hashlib
import json
import os
import re
from collections.abc import Iterator, Sequence
from itertools import accumulate, chain, count

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quotelane.session import materialize

#: Distinct pairs per document, summed up, after which a block is closed.
BLOCK_PAIRS = 1 << 18
HOT_PARTS = 10_000
#: A pair of ids is one number: the first times this, plus the second.
WIDTH = 1 << 24
MARK = "▁"
#: Fixed value: where byte-level tokenizers cut a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LONG_RUN = 500
#: A space that follows no white space begins a part, but for one that ends the text: alone it
#: would have no pieces.
_PARTS = re.compile(r" .*?\S(?= (?!\Z))|.+", re.DOTALL)
#: So many parts are remembered at a time, and as many from before; longer ones are not.
REMEMBERED, REMEMBERED_CHARACTERS = 100_000, 100
_LONG_SPACE = re.compile(r"\s{%d}" % LONG_RUN)
#: Pairs per row of the table of pairs.
_ROW_PAIRS = 4096
#: Documents whose new parts are learnt together.
_LEARNT_TOGETHER = 256


def _byte_characters() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones of
    Latin-1 for themselves, the others by further characters in turn."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class ByteLevel:
    """The byte-level tokenizer of a file.

    Its merges rank as the ids of what they make, so the same file serves as the ranks of a
    faster encoder, which gives the same ids. Texts with a run of ``LONG_RUN`` characters
    without a place to cut go to the tokenizer itself, whose time does not grow with the square
    of a run, and so do all texts if the file is of another kind.
    """

    def __init__(self, file: str):
        # Spark's tasks share the cores already; the library's own threads would only contend.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(file)
        self.tokenizer.encode_special_tokens = True
        with open(file, encoding="utf-8") as source:
            config = json.load(source)
        byte_of, added = _byte_characters(), {t["content"] for t in config["added_tokens"]}
        vocabulary = self.tokenizer.get_vocab()
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            if token not in added and all(c in byte_of for c in token):
                self.bytes[i] = bytes(byte_of[c] for c in token)
        self.fast = None
        if self._ranked(config):
            ranks = {b: i for i, b in enumerate(self.bytes) if b}
            self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _ranked(self, config: dict) -> bool:
        model, before = config["model"], config["pre_tokenizer"] or {}
        plain = (
            model.get("type") == "BPE" and not config["normalizer"] and before.get("type") == "ByteLevel"
            and before.get("use_regex") and not before.get("add_prefix_space")
            and not any(model.get(k) for k in (
                "dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        )
        if not plain or not {bytes([b]) for b in range(256)} <= set(self.bytes):
            return False
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [model["vocab"][left + right] for left, right in merges]
        return made == sorted(made)

    def encode(self, text: str) -> list[int]:
        long = len(text) >= LONG_RUN and (
            max(map(len, text.split()), default=0) >= LONG_RUN or _LONG_SPACE.search(text))
        if self.fast is None or long:
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


class Pair:
    """A byte-level tokenizer (A) and a SentencePiece model (B).

    Texts are cut before spaces that follow no white space. A never has a token across such a
    place, nor has B if none of its pieces holds its word mark after another character. So the
    parts are encoded and aligned one by one, and remembered: words repeat. Where the model
    allows no cuts, a text is one part.
    """

    def __init__(self, byte_file: str, piece_file: str):
        self.a = ByteLevel(byte_file)
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.a_bytes, self.b_bytes = self.a.bytes, [self._piece(name) for name in names]
        self.a_sizes, self.b_sizes = [len(b) for b in self.a_bytes], [len(b) for b in self.b_bytes]
        self.a_sizes_np, self.b_sizes_np = np.array(self.a_sizes, np.int64), np.array(self.b_sizes, np.int64)
        plain = all(self.b.normalize(t) == MARK + t.replace(" ", MARK) for t in ("  a  b ", "Ａ½", "é"))
        crossed = any(re.search(f"[^{MARK}]{MARK}", name) for name in names)
        self.cut = self.a.fast is not None and plain and not crossed
        self.new: dict[str, tuple] = {}
        self.old: dict[str, tuple] = {}

    @staticmethod
    def _piece(piece: str) -> bytes:
        code = re.fullmatch("<0x([0-9A-F]{2})>", piece)
        return bytes.fromhex(code[1]) if code else piece.replace(MARK, " ").encode()

    def encode(self, spaced: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        """The ids by A and by B of texts after a space; none if they do not give its bytes."""
        if not spaced:
            return
        every_b = self.b.encode([t[1:] for t in spaced], num_threads=1)
        every_a = [self.a.encode(text) for text in spaced]
        wholes = [text.encode() for text in spaced]
        whole = b"".join(wholes)
        if b"".join(map(self.a_bytes.__getitem__, chain.from_iterable(every_a))) == whole \
                == b"".join(map(self.b_bytes.__getitem__, chain.from_iterable(every_b))):
            # all bytes agree; so does each part's if its tokens cover as many as it has
            sizes = np.cumsum(np.fromiter(map(len, wholes), np.int64, len(wholes)))
            if all(np.array_equal(np.cumsum(self._sizes_of(every, table))[np.cumsum(counts) - 1], sizes)
                   for every, table, counts in ((every_a, self.a_sizes_np, list(map(len, every_a))),
                                                (every_b, self.b_sizes_np, list(map(len, every_b))))):
                yield from zip(every_a, every_b)
                return
        for text, ids_a, ids_b, whole in zip(spaced, every_a, every_b, wholes):
            if b"".join([self.a_bytes[i] for i in ids_a]) != whole \
                    or b"".join([self.b_bytes[i] for i in ids_b]) != whole:
                yield [], []
            else:
                yield ids_a, ids_b

    @staticmethod
    def _sizes_of(lists: list, table: np.ndarray) -> np.ndarray:
        return table[np.fromiter(chain.from_iterable(lists), np.int64)]

    def slices(self, ids_a: list[int], ids_b: list[int]) -> list[tuple[int, int]]:
        """Where each group ends in both lists."""
        at_a = dict(zip(accumulate(map(self.a_sizes.__getitem__, ids_a)), count(1)))
        at_b = dict(zip(accumulate(map(self.b_sizes.__getitem__, ids_b)), count(1)))
        return [(at_a[end], at_b[end]) for end in sorted(at_a.keys() & at_b.keys())]

    def links(self, a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
        """The overlapping pairs of one slice."""
        if len(a) == 1 or len(b) == 1:
            return [(x, y) for x in a for y in b]
        found, i, j = [], 0, 0
        end_a, end_b = self.a_sizes[a[0]], self.b_sizes[b[0]]
        while True:
            found.append((a[i], b[j]))
            if end_a < end_b:
                i += 1
                end_a += self.a_sizes[a[i]]
            elif end_b < end_a:
                j += 1
                end_b += self.b_sizes[b[j]]
            else:  # the end of the slice: no other end is common
                return found

    def aligned(self, ids_a: list[int], ids_b: list[int]) -> tuple[list[str], list[int]]:
        """The groups as text, and the links as numbers."""
        groups, links, i, j = [], [], 0, 0
        for k, m in self.slices(ids_a, ids_b):
            if k - i == m - j == 1:  # most slices are one token on each side
                a, b = ids_a[i], ids_b[j]
                groups.append(f"{a}|{b}")
                links.append(a * WIDTH + b)
            else:
                left, right = ids_a[i:k], ids_b[j:m]
                groups.append(f"{','.join(map(str, left))}|{','.join(map(str, right))}")
                links += [a * WIDTH + b for a, b in self.links(left, right)]
            i, j = k, m
        return groups, links

    def learn(self, parts: set[str]) -> None:
        """Remember parts: numbers of A's tokens, B's tokens and groups, the groups joined,
        and the links."""
        fresh = []
        for part in parts:
            if part in self.old:
                self.new[part] = self.old[part]
            else:
                fresh.append(part)
        found = list(self.encode(fresh))
        sizes_a = self.a_sizes_np[np.fromiter(chain.from_iterable(a for a, _ in found), np.int64)]
        sizes_b = self.b_sizes_np[np.fromiter(chain.from_iterable(b for _, b in found), np.int64)]
        if sizes_a.all() and sizes_b.all():
            self.new.update(zip(fresh, self._learned(found, sizes_a, sizes_b)))
            return
        for part, (ids_a, ids_b) in zip(fresh, found):  # a token without bytes
            groups, links = self.aligned(ids_a, ids_b)
            self.new[part] = len(ids_a), len(ids_b), len(groups), ";".join(groups), links

    def _learned(self, found: list, sizes_a: np.ndarray, sizes_b: np.ndarray) -> Iterator[tuple]:
        """What ``aligned`` gives, for many parts at once. Both lists of all parts end at
        each part's end, so their common ends are the groups' ends of all parts, and every
        end of either list ends one link: that of the two tokens over the byte before it."""
        ids_a = np.fromiter(chain.from_iterable(a for a, _ in found), np.int64, len(sizes_a))
        ids_b = np.fromiter(chain.from_iterable(b for _, b in found), np.int64, len(sizes_b))
        ends_a, ends_b = np.cumsum(sizes_a), np.cumsum(sizes_b)
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        every = np.union1d(ends_a, ends_b)
        links = ids_a[np.searchsorted(ends_a, every)] * WIDTH + ids_b[np.searchsorted(ends_b, every)]
        # each token's group; a group's A tokens, then its B tokens, in order
        last_a, last_b = np.searchsorted(ends_a, common), np.searchsorted(ends_b, common)
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        before_b = np.concatenate([[0], last_b[:-1] + 1])
        text = [""] * (2 * (len(ids_a) + len(ids_b)))
        for at, ids, last, mark in ((2 * (np.arange(len(ids_a)) + before_b[group_a]), ids_a, last_a, "|"),
                                    (2 * (np.arange(len(ids_b)) + last_a[group_b] + 1), ids_b, last_b, ";")):
            separators = np.full(len(ids), ",", object)
            separators[last] = mark
            for k, value, sep in zip(at.tolist(), map(str, ids.tolist()), separators.tolist()):
                text[k] = value
                text[k + 1] = sep
        n_a = np.fromiter((len(a) for a, _ in found), np.int64, len(found))
        n_b = np.fromiter((len(b) for _, b in found), np.int64, len(found))
        part_ends = np.zeros(len(found), np.int64)
        part_ends[n_a > 0] = ends_a[np.cumsum(n_a)[n_a > 0] - 1]
        groups_to = np.searchsorted(common, part_ends, "right")
        links_to = np.searchsorted(every, part_ends, "right")
        text_to = 2 * np.cumsum(n_a + n_b)
        g = l = t = 0
        for a, b, g_end, l_end, t_end in zip(n_a.tolist(), n_b.tolist(), groups_to.tolist(),
                                             links_to.tolist(), text_to.tolist()):
            if not a:
                yield 0, 0, 0, "", []
                continue
            yield a, b, g_end - g, "".join(text[t : t_end - 1]), links[l:l_end].tolist()
            g, l, t = g_end, l_end, t_end

    def document(self, text: str) -> tuple:
        """What ``learn`` finds, for a whole text; zeros if its tokens do not give its bytes."""
        return self.documents([text])[0]

    def documents(self, texts: list) -> list[tuple]:
        """``document`` of each text; the parts new to all of them are learnt together."""
        if len(self.new) >= REMEMBERED:
            self.old, self.new = self.new, {}
        cut = [(_PARTS.findall(" " + text) if self.cut else [" " + text]) if text else () for text in texts]
        new = self.new
        if missing := {part for parts in cut for part in parts if part not in new}:
            self.learn(missing)
        found = []
        for parts in cut:
            if not parts:
                found.append((0, 0, 0, "", []))
                continue
            a, b, n, groups, links = zip(*map(new.__getitem__, parts))
            if not all(a):
                found.append((0, 0, 0, "", []))
            else:
                found.append((sum(a), sum(b), sum(n), ";".join(groups), list(chain.from_iterable(links))))
        for part in missing:
            if len(part) > REMEMBERED_CHARACTERS:
                del new[part]
        return found


_BLOCKS = """block long, doc_id {id}, n_a long, n_b long, n_groups long, n_links long,
    groups_sha256 string, groups string, at array<int>, times array<long>,
    pairs array<long>, uses array<long>"""


class _Block:
    """Documents whose pairs are counted together."""

    def __init__(self, number: int):
        self.number, self.rows, self.size = number, [], 0

    def add(self, doc_id, found: tuple, keep: bool) -> None:
        *numbers, groups, links = found
        pairs, times = np.unique(np.array(links, np.int64), return_counts=True)
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        self.rows.append((doc_id, *numbers, len(links), digest, groups if keep else None, pairs, times))
        self.size += len(pairs)

    def batches(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """A row per document with the places of its pairs among the block's sorted pairs,
        then these pairs, many to a row."""
        every = np.concatenate([r[7] for r in self.rows])
        pairs, at = np.unique(every, return_inverse=True)
        uses = np.bincount(at, np.concatenate([r[8] for r in self.rows]), len(pairs)).astype(np.int64)
        ends = np.cumsum([len(r[7]) for r in self.rows])
        columns = [list(c) for c in zip(*self.rows)]
        documents = [[self.number] * len(self.rows), *columns[:7], np.split(at.astype(np.int32), ends[:-1]), columns[8]]
        nothing = [None] * len(self.rows)
        yield _batch([*documents, nothing, nothing], schema)
        starts = range(0, len(pairs), _ROW_PAIRS)
        cut = [[part[s : s + _ROW_PAIRS] for s in starts] for part in (pairs, uses)]
        nothing = [None] * len(starts)
        yield _batch([[self.number] * len(starts), *[nothing] * 9, *cut], schema)


def _batch(columns: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _blocks(docs: DataFrame, byte_file: str, piece_file: str, keep_groups: bool) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = Pair(byte_file, piece_file)
        number = TaskContext.get().partitionId() << 32
        block, schema = _Block(number), None
        for batch in batches:
            schema = schema or _arrow_schema(batch.schema.field("doc_id").type)
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for start in range(0, len(texts), _LEARNT_TOGETHER):
                found = pair.documents(texts[start : start + _LEARNT_TOGETHER])
                for doc_id, one in zip(ids[start : start + _LEARNT_TOGETHER], found):
                    block.add(doc_id, one, keep_groups)
                    if block.size >= BLOCK_PAIRS:
                        yield from block.batches(schema)
                        number += 1
                        block = _Block(number)
        if block.rows:
            yield from block.batches(schema)

    return docs.select("doc_id", "text").mapInArrow(of, _BLOCKS.format(id=kind))


def _arrow_schema(doc_id: pa.DataType) -> pa.Schema:
    whole, text = pa.int64(), pa.string()
    return pa.schema([
        ("block", whole), ("doc_id", doc_id), ("n_a", whole), ("n_b", whole), ("n_groups", whole),
        ("n_links", whole), ("groups_sha256", text), ("groups", text), ("at", pa.list_(pa.int32())),
        ("times", pa.list_(whole)), ("pairs", pa.list_(whole)), ("uses", pa.list_(whole)),
    ])


def _counted(uses: DataFrame) -> DataFrame:
    """Rows (pair, count, best, blocks): the links of each pair of ids in all documents, and
    whether no other first id has more with the same second id."""
    counts = materialize(
        uses.groupBy("pair").agg(F.sum("uses").alias("count"), F.count("*").alias("blocks")), "pair-counts")
    second = F.col("pair") % WIDTH
    most = counts.groupBy(second.alias("second")).agg(F.max("count").alias("most"))
    joined = counts.withColumn("second", second).join(F.broadcast(most), "second")  # a row per piece
    return joined.select("pair", "count", (F.col("count") == F.col("most")).alias("best"), "blocks")


def _fetched(uses: DataFrame, counts: DataFrame) -> DataFrame:
    """Each block's pairs with their counts."""
    total = counts.agg(F.sum("blocks")).first()[0] or 0
    hot = F.broadcast(counts.where(F.col("blocks") > total / HOT_PARTS))  # under HOT_PARTS rows
    cold = counts.where(F.col("blocks") <= total / HOT_PARTS)
    asked = uses.select(F.col("block").alias("holder"), "pair")
    rare = asked.join(hot.select("pair"), "pair", "left_anti").join(cold, "pair")
    kept = ["holder", "pair", "count", "best"]
    return asked.join(hot, "pair").select(*kept).unionByName(rare.select(*kept))


def alignments(
    docs: DataFrame, byte_file: str, piece_file: str,
    doc_id: str = "doc_id", text: str = "text", keep_groups: bool = False,
) -> DataFrame:
    """Rows (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), with
    ``keep_groups`` also the ``groups`` (``a1,a2|b1;a3|b2``). The files must be readable on
    executors."""
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    blocks = materialize(_blocks(rows, byte_file, piece_file, keep_groups), "alignment")
    uses = blocks.where("pairs IS NOT NULL").select(
        "block", F.explode(F.arrays_zip("pairs", "uses")).alias("use")
    ).select("block", F.col("use.pairs").alias("pair"), F.col("use.uses").alias("uses"))
    counts = materialize(_counted(uses), "pair-bests")
    documents = blocks.where("at IS NOT NULL").drop("pairs", "uses")
    kind = rows.schema["doc_id"].dataType.simpleString()
    result = f"""doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long,
        count_sum long, groups_sha256 string"""

    def scored(members: pa.Table, answers: pa.Table) -> pa.Table:
        order = np.argsort(answers["pair"].to_numpy())
        count = answers["count"].to_numpy()[order]
        best = answers["best"].to_numpy().astype(np.int64)[order]
        at = np.concatenate([np.zeros(0, np.int64), *_chunks(members["at"])])
        times = np.concatenate([np.zeros(0, np.int64), *_chunks(members["times"])])
        ends = np.concatenate([[0], np.cumsum(members["at"].combine_chunks().value_lengths().to_numpy())])

        def summed(values: np.ndarray) -> pa.Array:
            running = np.concatenate([[0], np.cumsum(values)])
            return pa.array(running[ends[1:]] - running[ends[:-1]], pa.int64())

        members = members.append_column("n_best", summed(times * best[at]))
        members = members.append_column("count_sum", summed(times * count[at]))
        names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
        return members.select(names + (["groups"] if keep_groups else []))

    both = documents.groupBy("block").cogroup(_fetched(uses, counts).groupBy("holder"))
    return both.applyInArrow(scored, result + (", groups string" if keep_groups else ""))


def _chunks(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [chunk.flatten().to_numpy() for chunk in column.chunks]
