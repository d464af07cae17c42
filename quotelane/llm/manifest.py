"""A Merkle manifest of a table: leaves, one tree per key, one root, and inclusion proofs.

The rows of a key (here: a language) are the leaves of its tree, in the order of their ids.
While a tree has more than one node, every ``FANOUT`` consecutive ones become one. The roots
of these trees, in the order of the keys, are the leaves of one more such tree.

Checkpoint and recompute: only every ``STEP``-th level is stored, as one row per aligned
subtree of ``SUBTREE`` nodes of that level. A proof needs the levels between too. They are
regenerated, one stored row at a time, from the nodes in it; the siblings of all its nodes
are emitted, and the regenerated nodes are dropped. What lies above a subtree is the proof of
its top, found the same way in the next stored level, and joined once per subtree.

Places in a tree are row numbers within range partitions plus the counts of earlier ones, so
a key with a third of all rows is spread over many tasks. Stored rows hold at most
``SUBTREE`` hashes. The driver sees no rows, only whether a tree goes on.

Defined results: null keys are a tree of their own, which comes first; null ids come first;
repeated ids are leaves of their own, ordered by their hashes; a null field is hashed as
``-``, unlike an empty one; a very long text is hashed whole; an empty table has no
proofs. Other columns of the table play no part, whatever their names.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotelane.llm.columns import sha256_hex
from quotelane.session import materialize

FANOUT = 8
#: Levels from one stored level to the next, and the nodes below one node so far up.
STEP = 3
SUBTREE = FANOUT**STEP
#: The fields of a leaf in their order, and the characters of a digest.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_HEX = 64


def field(value: Column) -> Column:
    """A value as its UTF-8 byte count, a colon and itself; a hyphen if it is null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return sha256_hex(F.concat(*[field(v) for v in values]))


def _placed(nodes: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """``nodes`` with their ``place`` in their ``tree`` (from 0) and its ``size``.

    Rows that are equal in ``order`` are split too, by where they were read.
    """
    order = ["tree", *order, "read"]
    dealt = materialize(
        nodes.withColumn("read", F.monotonically_increasing_id())
        .repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("read", F.monotonically_increasing_id()),  # the partition and the row in it
        label,
    )
    part = F.shiftright("read", 33)
    tree = Window.partitionBy("tree")
    earlier = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = (
        dealt.groupBy("tree", part.alias("part"))
        .agg(F.min("read").alias("first"), F.count("*").alias("n"))
        .select("tree", "part", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
                F.sum("n").over(tree).alias("size"))
    )
    return (
        dealt.withColumn("part", part).join(runs, ["tree", "part"])
        .withColumn("place", F.col("read") + F.col("shift")).drop("part", "read", "shift")
    )


def _subtrees(nodes: DataFrame) -> DataFrame:
    """One row (tree, subtree, size, members) per aligned run of ``SUBTREE`` nodes."""
    rest = [c for c in nodes.columns if c not in ("tree", "size", "place")]
    members = F.sort_array(F.collect_list(F.struct("place", *rest)))
    subtree = F.expr(f"place div {SUBTREE}").alias("subtree")
    return nodes.groupBy("tree", subtree, "size").agg(members.alias("members"))


def _joined_runs(level: Column) -> Column:
    """Every ``FANOUT`` consecutive digests of an array, joined."""
    starts = F.sequence(F.lit(1), F.size(level), F.lit(FANOUT))
    return F.transform(starts, lambda at: F.array_join(F.slice(level, at, F.lit(FANOUT)), ""))


def _regenerated(stored: DataFrame) -> DataFrame:
    """Stored subtrees with their ``steps`` upwards, the hash of their ``top``, and in
    ``runs0``, ``runs1``, ... the digests below each node of the levels between, joined."""
    steps = F.lit(STEP)
    for k in reversed(range(STEP)):
        steps = F.when(F.col("size") <= FANOUT**k, k).otherwise(steps)
    out = stored.withColumn("steps", steps).withColumn("level0", F.col("members.hash"))
    for k in range(STEP):
        level, above = F.col(f"level{k}"), F.col("steps") > k
        out = out.withColumn(f"runs{k}", F.when(above, _joined_runs(level)))
        out = out.withColumn(f"level{k + 1}", F.when(above, F.transform(f"runs{k}", sha256_hex)).otherwise(level))
    top = F.get(F.col(f"level{STEP}"), F.lit(0)).alias("top")
    return out.select(*stored.columns, "steps", top, *[f"runs{k}" for k in range(STEP)])


def _own_siblings(place: Column) -> Column:
    """The siblings of a node and of its ancestors up to the top of its subtree."""
    found = []
    for k in range(STEP):
        run = F.get(F.col(f"runs{k}"), F.floor(place / FANOUT ** (k + 1)).cast("int"))
        at = F.floor(place / FANOUT**k).cast("int") % FANOUT * _HEX
        left, right = F.substring(run, F.lit(1), at), F.substring(run, at + _HEX + 1, F.lit(FANOUT * _HEX))
        found.append(F.struct(left.alias("left"), right.alias("right")))
    return F.slice(F.array(*found), F.lit(1), F.col("steps"))


class Forest:
    """The stored levels of one or more trees of (tree, place, size, hash, ...) nodes."""

    def __init__(self, nodes: DataFrame, label: str):
        self.levels: list[DataFrame] = []
        self.tops: list[DataFrame] = []
        while True:
            stored = materialize(_subtrees(nodes), f"{label}-{len(self.levels)}")
            self.levels.append(stored)
            above = _regenerated(stored).select(
                "tree", F.col("subtree").alias("place"),
                F.ceil(F.col("size") / SUBTREE).cast("long").alias("size"), F.col("top").alias("hash"),
            )
            self.tops.append(above.where("size = 1"))
            if stored.where(F.col("size") > SUBTREE).isEmpty():
                break
            nodes = above.where("size > 1")

    def roots(self) -> DataFrame:
        """Rows (tree, level, hash): the root of each tree and the last of its stored levels."""
        found = [t.select("tree", F.lit(k).alias("level"), "hash") for k, t in enumerate(self.tops)]
        out = found[0]
        for more in found[1:]:
            out = out.unionByName(more)
        return out

    def paths(self, above: DataFrame) -> DataFrame:
        """The members of the lowest level, each with the ``path`` of its siblings upwards.

        ``above`` continues each tree: rows (tree, level, path, ...) for its root. Its other
        columns are handed down.
        """
        handed = [c for c in above.columns if c not in ("tree", "level", "path")]
        members = None
        for k in reversed(range(len(self.levels))):
            ends = above.where(F.col("level") == k).select(
                "tree", F.lit(0).cast("long").alias("subtree"), "path", *handed)
            if members is not None:
                ends = ends.unionByName(members.select(
                    "tree", F.col("member.place").alias("subtree"), "path", *handed))
            rows = _regenerated(self.levels[k]).join(ends, ["tree", "subtree"])
            one = F.transform("members", lambda m: F.struct(
                m.alias("member"), _own_siblings(m["place"] % SUBTREE).alias("own")))
            members = rows.select("tree", "path", *handed, F.explode(one).alias("one")).select(
                "tree", "one.member", F.concat("one.own", "path").alias("path"), *handed)
        return members


def folded(value: Column, path: Column) -> Column:
    """The root that a leaf's hash and the siblings on its way up lead to."""
    return F.aggregate(path, value, lambda hashed, s: sha256_hex(F.concat(s["left"], hashed, s["right"])))


class Manifest:
    """The trees of a table of documents, one per ``key``, under one root.

    ``beside`` are columns of ``docs`` that go with each leaf to its proof.
    """

    def __init__(self, docs: DataFrame, fields: Sequence[str] = FIELDS, key: str = "lang",
                 doc_id: str = "doc_id", beside: dict[str, Column] | None = None):
        self.beside = list(beside or {})
        # Keys sort as their bytes do; the null key comes before all, the empty one included.
        tree = F.coalesce(F.concat(F.lit("="), docs[key].cast("string")), F.lit(""))
        leaves = docs.select(
            tree.alias("tree"), docs[doc_id].alias("doc_id"), leaf(*[docs[f] for f in fields]).alias("hash"),
            F.struct(F.lit(0).alias("none"), *[c.alias(n) for n, c in (beside or {}).items()]).alias("beside"),
        )
        self.trees = Forest(_placed(leaves, ["doc_id", "hash"], "manifest-leaves"), "manifest")
        subroots = self.trees.roots().select(
            F.lit("").alias("tree"), F.col("tree").alias("key"), "level", "hash")
        self.whole = Forest(_placed(subroots, ["key"], "manifest-subroots"), "manifest-whole")

    def root(self) -> DataFrame:
        """One row with the ``root``; none for an empty table."""
        return self.whole.roots().select(F.col("hash").alias("root"))

    def proofs(self) -> DataFrame:
        """Rows (doc_id, leaf, subroot, root, path, ...): for every document the siblings
        left and right of each node on its way to the root, and the ``beside`` columns."""
        nothing = F.array().cast("array<struct<left:string,right:string>>")
        whole = self.whole.roots().select("tree", "level", nothing.alias("path"), F.col("hash").alias("root"))
        above = self.whole.paths(whole).select(
            F.col("member.key").alias("tree"), F.col("member.level").alias("level"), "path",
            F.col("member.hash").alias("subroot"), "root")
        return self.trees.paths(above).select(
            F.col("member.doc_id").alias("doc_id"), F.col("member.hash").alias("leaf"), "subroot", "root", "path",
            *[F.col(f"member.beside.`{n}`").alias(n) for n in self.beside])


def tamper_report(docs: DataFrame) -> DataFrame:
    """Each document's proof, checked after a third of the texts were changed.

    Documents whose unsigned crc32 of the decimal id is divisible by 3 have the letters A-Z
    of their text in lower case; null ids are left alone.
    """
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered = F.translate(docs["text"], letters, letters.lower())
    hit = F.coalesce(F.crc32(docs["doc_id"].cast("string").cast("binary")) % 3 == 0, F.lit(False))
    changed = [lowered if f == "text" else docs[f] for f in FIELDS]
    proofs = Manifest(docs, beside={"tampered": F.when(hit, leaf(*changed))}).proofs()
    siblings = F.array_join(F.flatten(F.transform("path", lambda s: F.array(s["left"], s["right"]))), "")
    checked = proofs.select(
        "doc_id", "leaf", "subroot", "root", sha256_hex(siblings).alias("proof_sha256"),
        folded(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root"))
    return checked.withColumn("verified", F.col("folded_root") == F.col("root"))
