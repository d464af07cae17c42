"""Secret scans: base patterns, and character Markov models for random strings.

Two first-order Markov models over characters are trained from labelled samples of the
scanned documents themselves: the strings that the base patterns find are examples of
random strings, all other long tokens are examples of ordinary identifiers. A long token
with letters and digits is a secret if its log-likelihood ratio per character is above
``RATIO``. Both models are smoothed, so unseen transitions count as rare, not impossible.

The samples are the labelled strings of about ``SAMPLE_DOCUMENTS`` documents, those with
the smallest hashes; the scan itself covers all texts. The models are one table of 128 x
128 numbers. Spark expressions only.

Positions are code points, from 0, with exclusive ends. Defined results: a null text
counts as empty; a text without secrets has no spans; spans of different kinds may
overlap; repeated rows are scanned alike; an empty table gives an empty result.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelane.llm.columns import sha256_hex, unpacked

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: The base patterns, in the order that breaks ties of a start. Where a
#: shorter match is dropped, the pattern asks for the length itself, with equal matches.
PATTERNS = {
    "assign": ASSIGN,
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"(?<![0-9a-f])[0-9a-f]{24,}",
}
ASSIGNED = 6
#: Tokens that the models judge: long, with a digit and a letter.
TOKEN = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_=-]{20,}"
MODEL_KIND = "markov"
#: Ordinary tokens for training.
IDENTIFIER = r"[A-Za-z0-9+/_=-]{8,}"
SAMPLE_DOCUMENTS = 20_000
RATIO = 1.0
SMOOTHING = 1.0
MASK = "[SECRET]"

_CHUNK = 512


def _before(lengths: Column) -> Column:
    """For each length the sum of those before it, in chunks, so long arrays stay cheap."""

    def running(values: Column) -> Column:
        start = F.array(F.lit(0).cast("long"))
        return F.aggregate(
            values, start, lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x))
        )

    chunks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _CHUNK).cast("int")),
        lambda c: running(F.slice(lengths, c * _CHUNK + 1, F.lit(_CHUNK))),
    )
    base = running(F.transform(chunks, lambda c: F.element_at(c, -1)))
    shifted = F.transform(
        F.arrays_zip(chunks.alias("c"), F.slice(base, F.lit(1), F.size(chunks)).alias("b")),
        lambda z: F.transform(F.slice(z["c"], F.lit(1), F.size(z["c"]) - 1), lambda v: v + z["b"]),
    )
    return F.flatten(shifted)


def _located(df: DataFrame, text: str, pattern: str, name: str) -> DataFrame:
    """Add array ``name`` of (start, stop, match) for all matches of ``pattern``."""
    df = df.withColumn("_matches", F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    some = F.size("_matches") > 0
    df = df.withColumn("_gaps", F.when(some, F.split(text, pattern, -1)))
    n = F.size("_matches")
    df = df.withColumn("_lengths", F.when(some, F.zip_with(
        F.slice("_gaps", F.lit(1), n), "_matches",
        lambda g, m: (F.length(g) + F.length(m)).cast("long"))))
    df = df.withColumn("_before", F.when(some, _before(F.col("_lengths"))))
    found = F.transform("_matches", lambda m, k: F.struct(
        (F.get("_before", k) + F.length(F.get("_gaps", k))).alias("start"),
        (F.get("_before", k) + F.get("_lengths", k)).alias("stop"),
        m.alias("match")))
    df = df.withColumn(name, F.when(some, found).otherwise(F.array().cast(
        "array<struct<start:bigint,stop:bigint,match:string>>")))
    return df.drop("_matches", "_gaps", "_lengths", "_before")


def _base(df: DataFrame, text: str) -> DataFrame:
    for kind, pattern in PATTERNS.items():
        df = _located(df, text, pattern, kind)
    value = lambda m: F.regexp_extract(m, "^(?:" + ASSIGN + ")$", 2)
    return df.withColumn("assign", F.filter("assign", lambda s: F.length(value(s["match"])) >= ASSIGNED))


def log_ratios(docs: DataFrame, text: str = "text") -> list[float]:
    """For each pair of ASCII characters (128 * first + second): log of its probability in
    random strings over that in ordinary identifiers."""
    rows = docs.select(F.coalesce(docs[text], F.lit("")).alias("text"))
    share = SAMPLE_DOCUMENTS / max(rows.count(), 1)
    if share < 1:
        rows = rows.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int(share * (1 << 30)))
    rows = _base(rows, "text").select(
        "text",
        F.transform("assign", lambda s: F.regexp_extract(s["match"], ASSIGN, 2)).alias("assigned"),
        F.concat("access.match", "hex.match").alias("named"),
    )
    rows = rows.select("text", F.concat("assigned", "named").alias("random"))
    other = F.filter(
        F.regexp_extract_all("text", F.lit(IDENTIFIER), F.lit(0)),
        lambda t: ~F.exists("random", lambda r: r.contains(t)),
    )
    labelled = rows.select(F.explode(F.transform("random", lambda t: F.struct(F.lit(True).alias("random"), t.alias("token")))).alias("x"))
    ordinary = rows.select(F.explode(F.transform(other, lambda t: F.struct(F.lit(False).alias("random"), t.alias("token")))).alias("x"))
    tokens = labelled.unionByName(ordinary).select("x.*").where(F.length("token") > 1)
    pairs = tokens.select("random", F.explode(F.transform(
        F.sequence(F.lit(1), F.length("token") - 1), lambda i: F.substring("token", i, F.lit(2)))).alias("pair"))
    counts = {(r["random"], r["pair"]): r["n"] for r in
              pairs.groupBy("random", "pair").agg(F.count("*").alias("n")).collect()}

    def conditional(label: bool) -> dict[tuple[int, int], float]:
        seen = {(ord(p[0]), ord(p[1])): n for (is_random, p), n in counts.items() if is_random is label and p.isascii()}
        firsts: dict[int, int] = {}
        for (a, _), n in seen.items():
            firsts[a] = firsts.get(a, 0) + n
        return {
            (a, b): math.log((seen.get((a, b), 0) + SMOOTHING) / (firsts.get(a, 0) + 128 * SMOOTHING))
            for a in range(128) for b in range(128)
        }

    random, ordinary = conditional(True), conditional(False)
    return [random[a, b] - ordinary[a, b] for a in range(128) for b in range(128)]


def _ratio(token: Column, table: Column) -> Column:
    """The log-likelihood ratio of a token, per transition."""
    codes = F.transform(F.split(token, ""), F.ascii)
    score = lambda c, k: F.get(table, F.get(codes, k) * 128 + F.get(codes, k + 1))
    total = F.aggregate(
        F.transform(F.slice(codes, F.lit(1), F.size(codes) - 1), score), F.lit(0.0), lambda a, x: a + x
    )
    return total / (F.size(codes) - 1)


def scanned(docs: DataFrame, text: str = "text", ratios: list[float] | None = None) -> DataFrame:
    """The rows of ``docs`` as ``row`` with ``text`` and ``spans``: (start, order, stop,
    kind, match), in order of start and kind. ``ratios`` may come from another table."""
    ratios = log_ratios(docs, text) if ratios is None else ratios
    table = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")
    rows = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
        F.coalesce(docs[text], F.lit("")).alias("text"),
    )
    rows = _located(_base(rows, "text"), "text", TOKEN, MODEL_KIND)
    letters = lambda t: t.rlike("[A-Za-z]")
    rows = rows.withColumn(MODEL_KIND, F.filter(
        MODEL_KIND, lambda s: letters(s["match"]) & (_ratio(s["match"], table) > RATIO)))

    def named(k: int, kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(
            s["start"].alias("start"), F.lit(k).alias("order"), s["stop"].alias("stop"),
            F.lit(kind).alias("kind"), s["match"].alias("match")))

    spans = F.concat(*[named(k, kind) for k, kind in enumerate([*PATTERNS, MODEL_KIND])])
    return rows.select("row", "text", F.sort_array(spans).alias("spans"))


def span_list(spans: Column) -> Column:
    """Spans as text, kind:start:end joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def span_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: counts by base kind, digest of base spans, all spans."""
    found = scanned(docs, text)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] != MODEL_KIND)
    return found.select(
        F.col(f"row.`{doc_id}`").alias("doc_id"),
        *[count(kind).alias(f"n_{kind}") for kind in PATTERNS],
        sha256_hex(span_list(base)).alias("base_sha256"),
        span_list(F.col("spans")).alias("spans"),
    )


def masked(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with every secret replaced by ``MASK``; a length in
    ``n_chars`` follows the text. Overlapping spans are masked once."""
    found = scanned(docs, text)
    joined = F.aggregate(
        "spans",
        F.array().cast("array<struct<start:bigint,stop:bigint>>"),
        lambda a, s: F.when(
            (F.size(a) > 0) & (s["start"] < F.element_at(a, -1)["stop"]),
            F.concat(F.slice(a, F.lit(1), F.size(a) - 1), F.array(F.struct(
                F.element_at(a, -1)["start"].alias("start"),
                F.greatest(F.element_at(a, -1)["stop"], s["stop"]).alias("stop")))),
        ).otherwise(F.concat(a, F.array(F.struct(s["start"], s["stop"])))),
    )
    found = found.withColumn("joined", F.when(F.size("spans") > 0, joined))
    kept = F.transform("joined", lambda s, k: F.expr("text").substr(
        (F.coalesce(F.get("joined", k - 1)["stop"], F.lit(0)) + 1).cast("int"),
        (s["start"] - F.coalesce(F.get("joined", k - 1)["stop"], F.lit(0))).cast("int")))
    tail = F.col("text").substr((F.element_at("joined", -1)["stop"] + 1).cast("int"), F.length("text"))
    found = found.withColumn("clean", F.when(
        F.size("spans") > 0, F.concat(F.array_join(F.transform(kept, lambda p: F.concat(p, F.lit(MASK))), ""), tail)))
    changed = F.col("clean").isNotNull()
    replaced = {text: F.coalesce("clean", f"row.`{text}`")}
    if "n_chars" in docs.columns:
        replaced["n_chars"] = F.when(changed, F.length("clean").cast("long")).otherwise(F.col("row.n_chars"))
    return unpacked(found, docs.columns, **replaced)
