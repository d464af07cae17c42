"""Quality rules: how far a text's histograms lie from those of its language.

Two histograms are compared with a reference by Jensen-Shannon distance (base 2, so from
0 to 1): shares of character classes, and shares of the language's commonest words with
all other words as one class. The references are pooled counts over all documents of a
language. Guards: a language with too few words, an unknown one and those beyond the
``LANGUAGES`` largest are compared with the pool of all documents instead; a text with too
few words for a histogram is not judged by it.

Spark expressions only. The references are at most ``LANGUAGES`` + 1 rows of about one
kilobyte each, so they are broadcast.

Defined results: a null or blank text has no words and fails the base rule; a null
language is unknown; repeated rows are judged alike; an empty table gives an empty result.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotelane.llm.columns import SPACES, unpacked
from quotelane.session import materialize

COMMON_WORDS = 32
PARTS = 64
LANGUAGES = 1000
#: Words that a language must have in all, to be a reference of its own.
REFERENCE_WORDS = 2000
#: Words that a text must have, to be judged by its histograms.
CLASS_GUARD = 50
WORD_GUARD = 50
#: Largest distances of kept texts.
CLASS_DISTANCE = 0.3
WORD_DISTANCE = 0.45

CLASSES = ["lower", "upper", "digit", "space", "mark", "symbol", "other"]
#: Characters counted as symbols.
SYMBOLS = r"[#*$%&|<>]+"


def _measured(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """The rows of ``docs`` as ``row`` with their words and counts of characters."""
    rows = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
        docs[lang].cast("string").alias("lang"),
        F.coalesce(docs[text], F.lit("")).alias("text"),
    )
    rows = rows.select("*", F.regexp_replace("text", "[a-z]+", "").alias("no_lower"))
    rows = rows.select("*", F.regexp_replace("no_lower", SPACES, "").alias("rest"))
    less = lambda pattern: F.length("rest") - F.length(F.regexp_replace("rest", pattern, ""))
    counted = rows.select(
        "row", "lang", "text",
        (F.length("text") - F.length("no_lower")).cast("long").alias("lower"),
        less("[A-Z]+").cast("long").alias("upper"),
        less("[0-9]+").cast("long").alias("digit"),
        (F.length("no_lower") - F.length("rest")).cast("long").alias("space"),
        less(r"""[.,;:!?'"()-]+""").cast("long").alias("mark"),
        less(SYMBOLS).cast("long").alias("symbol"),
        F.length("text").cast("long").alias("chars"),
        F.array_remove(F.split("text", SPACES), "").alias("words"),
    )
    known = sum((F.col(c) for c in CLASSES[:-1]), F.lit(0))
    return counted.withColumn("other", F.col("chars") - known)


def references(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Rows (lang, classes, words, shares): one per language, and a null one for all.

    ``classes`` are shares of character classes, ``words`` the commonest words in lower
    case and ``shares`` their shares of all words; ties go to the smaller word.
    """
    measured = _measured(docs, text, lang)
    sums = [F.sum(c).alias(c) for c in [*CLASSES, "chars"]]
    classes = materialize(
        measured.groupBy("lang").agg(*sums, F.sum(F.size("words")).alias("n")), "classes"
    )
    # The counts per task come first, so a common word is one row of each task.
    counts = materialize(
        measured.select("lang", F.explode("words").alias("word"))
        .groupBy("lang", F.lower("word").alias("word")).agg(F.count("*").alias("n"))
        .where("n > 1"),  # a word seen once is no common word
        "word-counts",
    )
    chosen = classes.where(F.col("lang").isNotNull() & (F.col("n") >= REFERENCE_WORDS))
    chosen = chosen.orderBy(F.desc("n"), "lang").limit(LANGUAGES)
    whole = classes.agg(*[F.sum(c).alias(c) for c in [*CLASSES, "chars", "n"]])
    totals = chosen.unionByName(whole.withColumn("lang", F.lit(None).cast("string")))
    # One row per language and word at most: ranks are kept while counting.
    own = counts.where(F.col("lang").isNotNull())
    everywhere = counts.groupBy("word").agg(F.sum("n").alias("n"))
    everywhere = everywhere.select(F.lit(None).cast("string").alias("lang"), "word", "n")
    top = _commonest(own).unionByName(_commonest(everywhere)).withColumnRenamed("n", "uses")
    joined = totals.join(top, totals["lang"].eqNullSafe(top["lang"]), "left").drop(top["lang"])
    listed = joined.groupBy("lang", "n", "chars", *CLASSES).agg(
        F.sort_array(F.collect_list(F.when(F.col("word").isNotNull(), F.struct("word", "uses")))).alias("top")
    )
    share = lambda c, total: F.col(c) / F.greatest(F.col(total), F.lit(1))
    return materialize(
        listed.select(
            "lang",
            F.array(*[share(c, "chars") for c in CLASSES]).alias("classes"),
            F.col("top.word").alias("words"),
            F.array_max(F.transform("top", lambda t: F.octet_length(t["word"]))).alias("longest"),
            F.transform("top", lambda t: t["uses"] / F.greatest(F.col("n"), F.lit(1))).alias("shares"),
        ),
        "references",
    )


def _commonest(counts: DataFrame) -> DataFrame:
    """The commonest words of each language, first of each of a few parts of its words."""
    part = F.pmod(F.xxhash64("word"), F.lit(PARTS))
    for keys in (["lang", part], ["lang"]):
        order = Window.partitionBy(*keys).orderBy(F.desc("n"), "word")
        ranked = counts.withColumn("rank", F.row_number().over(order))
        counts = ranked.where(F.col("rank") <= COMMON_WORDS).drop("rank")
    return counts


def _half(p: Column, q: Column) -> Column:
    """p's part of the divergence of p and q in one class, in bits."""
    return F.when(p > 0, p * F.log2(2 * p / (p + q)) / 2).otherwise(F.lit(0.0))


def _divergence(p: Column, q: Column) -> Column:
    return _half(p, q) + _half(q, p)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _with_repeats(rows: DataFrame) -> DataFrame:
    """Add ``n_repeat_words``: words in windows of three that occur twice or more.

    Most texts repeat no window, which one hash per window tells. In the others windows
    are sorted by two hashes (96 bits) within the row; equal neighbours repeat.
    """
    at = lambda k: F.get("words", k)
    n = F.size("words")
    numbers = F.sequence(F.lit(0), n - 3)
    hashes = F.transform(numbers, lambda i: F.xxhash64(at(i), at(i + 1), at(i + 2)))
    rows = rows.withColumn("hashes", F.when(n >= 3, hashes))
    window = lambda i: F.struct(
        F.get("hashes", i).alias("a"), F.hash(at(i), at(i + 1), at(i + 2)).alias("b"), i.alias("i"))
    some = F.size(F.array_distinct("hashes")) < F.size("hashes")
    rows = rows.withColumn("windows", F.when(some, F.sort_array(F.transform(numbers, window))))
    same = lambda x, y: (x["a"] == y["a"]) & (x["b"] == y["b"])
    near = lambda x, k: F.coalesce(same(x, F.get("windows", k)), F.lit(False))
    repeated = F.filter("windows", lambda x, k: near(x, k - 1) | near(x, k + 1))
    rows = rows.withColumn("starts", F.sort_array(F.transform(repeated, lambda x: x["i"])))
    covered = F.transform(
        "starts", lambda s, k: F.least(F.lit(3), F.coalesce(F.get("starts", k + 1) - s, F.lit(3)))
    )
    total = F.aggregate(covered, F.lit(0), lambda a, x: a + x)
    rows = rows.withColumn("n_repeat_words", F.coalesce(total, F.lit(0)).cast("long"))
    return rows.drop("hashes", "windows", "starts")


def judged(
    docs: DataFrame, text: str = "text", lang: str = "lang", refs: DataFrame | None = None
) -> DataFrame:
    """The rows of ``docs`` as ``row`` with base counts, both distances and ``kept``.

    A distance is null where its guard applies. ``refs`` may come from another table.
    """
    refs = references(docs, text, lang) if refs is None else refs
    refs = refs.select(
        F.col("lang").alias("ref_lang"), F.struct("classes", "words", "shares", "longest").alias("ref")
    )
    rows = _measured(docs, text, lang)
    own = F.broadcast(refs.where(F.col("ref_lang").isNotNull()))
    pool = F.broadcast(refs.where(F.col("ref_lang").isNull()).select(
        F.lit(True).alias("always"), F.col("ref").alias("pool")))
    rows = rows.join(own, rows["lang"] == own["ref_lang"], "left")
    rows = rows.withColumn("always", F.lit(True)).join(pool, "always", "left")
    rows = rows.withColumn("ref", F.coalesce("ref", "pool")).drop("ref_lang", "pool", "always")
    rows = _with_repeats(rows)

    share = lambda c: F.col(c) / F.greatest(F.col("chars"), F.lit(1))
    classes = sum(
        (_divergence(share(c), F.col("ref.classes")[k]) for k, c in enumerate(CLASSES)), F.lit(0.0)
    )
    # The common words of the text in order, and where each of them begins.
    common_word = lambda w: (
        (F.octet_length(w) <= F.col("ref.longest")) & F.array_contains(F.col("ref.words"), F.lower(w)))
    rows = rows.withColumn(
        "hits", F.sort_array(F.transform(F.filter("words", common_word), F.lower)))
    rows = rows.withColumn("seen", F.array_distinct("hits"))
    rows = rows.withColumn("starts", F.transform("seen", lambda w: F.array_position("hits", w)))
    n = F.size("words")
    uses = lambda k: F.coalesce(F.get("starts", k + 1), F.size("hits") + 1) - F.get("starts", k)
    ref_share = lambda w: F.element_at("ref.shares", F.array_position(F.col("ref.words"), w).cast("int"))
    rows = rows.withColumn("pairs", F.transform("seen", lambda w, k: F.struct(
        (uses(k) / n).alias("p"), ref_share(w).alias("q"))))
    common = _sum(F.col("ref.shares"))
    met = _sum(F.transform("pairs", lambda x: x["q"]))
    words = (
        _sum(F.transform("pairs", lambda x: _divergence(x["p"], x["q"])))
        + (common - met) / 2  # common words that the text lacks
        + _divergence(1 - F.size("hits") / n, F.greatest(1 - common, F.lit(0.0)))
    )
    root = lambda d: F.sqrt(F.greatest(d, F.lit(0.0)))
    rows = rows.select(
        "row",
        n.cast("long").alias("n_words"),
        (F.col("chars") - F.col("space")).alias("word_chars"),
        F.col("symbol").alias("n_symbols"),
        _repeated_lines(F.col("text")).alias("n_dup_lines"),
        "n_repeat_words",
        F.when(n >= CLASS_GUARD, root(classes)).alias("class_distance"),
        F.when(n >= WORD_GUARD, root(words)).alias("word_distance"),
    )
    rows = rows.withColumn(
        "base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    )
    near = lambda c, limit: F.coalesce(F.col(c) <= limit, F.lit(True))
    return rows.withColumn(
        "kept",
        ~F.col("base_failed") & near("class_distance", CLASS_DISTANCE) & near("word_distance", WORD_DISTANCE),
    )


def _repeated_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def kept_documents(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` that pass the rules, in full."""
    rows = judged(docs, text, lang)
    # Always true, but not foldable: else the verdict's whole expression, its inputs many
    # times over, would be copied into filters below.
    once = F.monotonically_increasing_id() >= 0
    rows = rows.select("row", (F.col("kept") & once).alias("kept")).where("kept")
    return unpacked(rows, docs.columns)
