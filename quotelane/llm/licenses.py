"""License scans: notice phrases, identifier tags and the licence expressions behind them.

A text is read as words (letters, digits and characters beyond ASCII; A-Z count as a-z). One
Aho-Corasick automaton over the words, joined by single spaces, finds every notice phrase and
every identifier tag, overlapping ones too, in one pass. What follows a tag on its line is a
licence expression such as ``(MIT OR GPL-2.0-only WITH Classpath-exception-2.0) AND Zlib``.
A shunting-yard parser reads its longest complete beginning, ``with`` binding before ``and``
before ``or``, and evaluates it on two stacks: the licences it names, how freely the text may
be used (the freest choice of an ``or``, the strictest part of an ``and``, one class freer by
an exception), and its normal form. It needs no recursion, and time in proportion to the line.

``score`` says how surely a licence is stated: 1 with a tag and its expression, else 1 minus
the product of (1 - weight) over the distinct phrases found, 0 without any.

Defined results: a null text counts as empty; a text without finds has no labels, null
places and score 0; equal finds count once each; a tag without a readable expression says
nothing; an identifier that is not known is labelled ``other`` and counts as the strictest
class; a very long text costs time in proportion to its length; repeated rows are scanned
alike; an empty table gives an empty result.
"""

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
BASE_WEIGHT = 0.9
#: Further notice phrases: label and weight.
NOTICES = {
    "gnu gpl": ("gpl", 0.8),
    "gnu lesser general public license": ("lgpl", 0.95),
    "gnu library general public license": ("lgpl", 0.95),
    "gnu affero general public license": ("agpl", 0.95),
    "mozilla public license": ("mpl", 0.95),
    "eclipse public license": ("epl", 0.95),
    "apache software license": ("apache", 0.9),
    "bsd license": ("bsd", 0.9),
    "bsd 2 clause": ("bsd", 0.9),
    "bsd 3 clause": ("bsd", 0.9),
    "redistribution and use in source and binary forms": ("bsd", 0.95),
    "isc license": ("isc", 0.9),
    "boost software license": ("bsl", 0.95),
    "permission is hereby granted free of charge to any person obtaining a copy": ("mit", 0.95),
    "permission to use copy modify and or distribute this software": ("isc", 0.95),
    "creative commons attribution sharealike": ("cc-by-sa", 0.95),
    "creative commons attribution share alike": ("cc-by-sa", 0.95),
    "creative commons attribution noncommercial": ("cc-by-nc", 0.95),
    "creative commons attribution": ("cc-by", 0.9),
    "cc by sa": ("cc-by-sa", 0.9),
    "cc by nc": ("cc-by-nc", 0.9),
    "cc by nd": ("cc-by-nd", 0.9),
    "creative commons zero": ("cc0", 0.9),
    "cc0 1 0 universal": ("cc0", 0.95),
    "this is free and unencumbered software released into the public domain": ("unlicense", 0.95),
}
#: Tags, as words; an expression follows on the same line.
TAGS = ("spdx license identifier", "license expression")
#: Classes of use, the strictest first: unknown or strong copyleft, weak copyleft, notice, free.
STRICT, WEAK, NOTICE, FREE = range(4)
USES = ("strict", "weak", "notice", "free")
#: Families of identifiers: what stands before the version.
FAMILIES = {
    "gpl": STRICT, "agpl": STRICT, "cc-by-nc": STRICT, "cc-by-nd": STRICT, "cc-by-nc-sa": STRICT,
    "cc-by-nc-nd": STRICT, "lgpl": WEAK, "mpl": WEAK, "epl": WEAK, "cddl": WEAK, "eupl": WEAK, "cc-by-sa": WEAK,
    "apache": NOTICE, "mit": NOTICE, "bsd": NOTICE, "isc": NOTICE, "zlib": NOTICE, "bsl": NOTICE,
    "cc-by": NOTICE, "artistic": NOTICE, "psf": NOTICE, "python": NOTICE, "ofl": NOTICE, "x11": NOTICE,
    "cc0": FREE, "unlicense": FREE, "0bsd": FREE, "wtfpl": FREE, "mit-0": FREE,
}
OTHER = "other"
_PRECEDENCE = {"or": 1, "and": 2, "with": 3}
_TOKEN = re.compile(rb"[ \t]*([()]|[A-Za-z0-9][A-Za-z0-9.+:-]*)")
#: What may stand between a tag and its expression.
_GAP = re.compile(rb"""[:= \t"']*""")
_IDENTIFIER = re.compile(r"(.*?)(?:-v?[0-9][0-9.]*(?:-(?:only|or-later|clause|universal|clear))?\+?)?\+?")
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Bytes as characters of words, with capitals lowered, or as spaces.
_FLAT = bytes(
    ord(chr(b).lower()) if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)
)

STRUCT = """struct<n_words:bigint,n_base:bigint,first_word:bigint,last_word:bigint,base_labels:string,
    labels:string,score:double,expressions:array<string>,uses:string>"""


def family(identifier: str) -> str:
    """The family of a licence identifier, ``other`` if it is not known."""
    lowered = identifier.lower()
    if lowered in FAMILIES:
        return lowered
    name = _IDENTIFIER.fullmatch(lowered)[1]
    return name if name in FAMILIES else OTHER


def _is_licence(token: str) -> bool:
    """Whether a token may be the name of a licence: a known one or one with a version or a
    reference."""
    return family(token) != OTHER or "ref-" in token.lower() or ("-" in token and any(c.isdigit() for c in token))


class _Reading:
    """The stacks of one expression; an operand is the licences it names and their use."""

    def __init__(self):
        self.operands: list[tuple[frozenset, int]] = []
        self.operators: list[str] = []

    def take(self, token: str) -> None:
        word = token.lower()
        if token == "(":
            self.operators.append(token)
        elif token == ")":
            self.reduce(0)
            self.operators.pop()
        elif word in _PRECEDENCE:
            self.reduce(_PRECEDENCE[word])
            self.operators.append(word)
        else:
            label = family(token)
            self.operands.append((frozenset([label]), FAMILIES.get(label, STRICT)))

    def reduce(self, least: int) -> None:
        """Apply the operators on top that bind at least so strongly."""
        while self.operators and self.operators[-1] != "(" and _PRECEDENCE[self.operators[-1]] >= least:
            operator = self.operators.pop()
            (right, right_use), (left, use) = self.operands.pop(), self.operands.pop()
            if operator == "with":  # the right side is the name of an exception
                self.operands.append((left, min(use + 1, FREE)))
            else:
                freer = max if operator == "or" else min
                self.operands.append((left | right, freer(use, right_use)))


def _complete(text: bytes, at: int) -> list[str]:
    """The tokens of the longest complete expression at a place, none if there is none."""
    tokens: list[str] = []
    opened = complete = 0
    operand, exception = True, False  # whether an operand is due, and the name of an exception
    while found := _TOKEN.match(text, at):
        token, at = found[1].decode(), found.end()
        word = token.lower()
        if operand:
            if token == "(" and not exception:
                opened += 1
            elif token in "()" or word in _PRECEDENCE or not (exception or _is_licence(token.rstrip("."))):
                break
            else:
                operand = exception = False
                token = token.rstrip(".")
        elif token == ")" and opened:
            opened -= 1
        elif word in _PRECEDENCE and not (word == "with" and tokens[-1] == ")"):
            operand, exception, token = True, word == "with", token.upper()
        else:
            break
        tokens.append(token)
        if not operand and not opened:
            complete = len(tokens)
    return tokens[:complete]


def evaluate(text: bytes, at: int = 0) -> tuple[frozenset, int, str] | None:
    """The labels, class of use and normal form of the longest complete licence expression
    that ``text`` has at a place, None if there is none."""
    tokens = _complete(text, at)
    if not tokens:
        return None
    reading = _Reading()
    for token in tokens:
        reading.take(token)
    reading.reduce(0)
    labels, use = reading.operands[0]
    return labels, use, " ".join(tokens).replace("( ", "(").replace(" )", ")")


class Scanner:
    """Scans texts given as UTF-8 bytes."""

    def __init__(self):
        self.automaton = ahocorasick.Automaton()
        for phrase, label in BASE.items():
            self.automaton.add_word(f" {phrase} ", (len(phrase) + 1, label, BASE_WEIGHT, True))
        for phrase, (label, weight) in NOTICES.items():
            self.automaton.add_word(f" {phrase} ", (len(phrase) + 1, label, weight, False))
        for tag in TAGS:
            self.automaton.add_word(f" {tag} ", (len(tag) + 1, None, 1.0, False))
        self.automaton.make_automaton()

    def scan(self, text: bytes) -> dict:
        words = text.translate(_FLAT).split()
        flat = b" " + b" ".join(words) + b" "
        base, tags, labels, doubt, seen = [], [], set(), 1.0, set()
        counted, word = 0, 0  # the words that begin before `counted`
        for last, (length, label, weight, is_base) in self.automaton.iter(flat.decode("latin-1")):
            start = last - length
            if label is None:
                # An expression follows the last word of the tag.
                word += flat.count(b" ", counted, last)
                counted = last
                tags.append(word - 1)
                continue
            if is_base:
                base.append((start, label))
            labels.add(label)
            if (length, label) not in seen:
                seen.add((length, label))
                doubt *= 1.0 - weight
        places = self._places(flat, [start for start, _ in base])
        found = self._expressions(text, tags)
        base_labels = sorted({label for _, label in base})
        for expression in found:
            labels |= expression[0]
        return {
            "n_words": len(words),
            "n_base": len(base),
            "first_word": min(places, default=None),
            "last_word": max(places, default=None),
            "base_labels": ",".join(base_labels),
            "labels": ",".join(sorted(labels)),
            "score": 1.0 if found else 1.0 - doubt,
            "expressions": [text for _, _, text in found],
            "uses": USES[min(use for _, use, _ in found)] if found else None,
        }

    @staticmethod
    def _places(flat: bytes, starts: list[int]) -> list[int]:
        """The numbers of the words that begin after the spaces at ``starts``; the first and
        the last suffice."""
        if not starts:
            return []
        first, last = min(starts), max(starts)
        before = flat.count(b" ", 0, first)
        return [before, before + flat.count(b" ", first, last)]

    @staticmethod
    def _expressions(text: bytes, tags: list[int]) -> list[tuple[frozenset, int, str]]:
        """The different expressions behind the tags whose last words have these numbers."""
        found: dict[str, tuple[frozenset, int, str]] = {}
        wanted = iter(sorted(set(tags)))
        due = next(wanted, None)
        if due is None:
            return []
        for number, word in enumerate(_WORD.finditer(text.lower())):
            if number == due:
                read = evaluate(text, _GAP.match(text, word.end()).end())
                if read is not None:
                    found.setdefault(read[2], read)
                due = next(wanted, None)
                if due is None:
                    break
        return list(found.values())


def licences(text: Column) -> Column:
    """A struct of what the scan of a text finds."""

    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = Scanner()
        kind = pa.struct([
            *[(n, pa.int64()) for n in ("n_words", "n_base", "first_word", "last_word")],
            ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
            ("expressions", pa.list_(pa.string())), ("uses", pa.string()),
        ])
        for texts in batches:
            yield pa.array([scanner.scan(t.as_buffer().to_pybytes()) for t in texts], kind)

    of.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(of, STRUCT)(F.coalesce(text, F.lit("")).cast("binary"))


def license_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score,
    expressions, uses), one per row of ``docs``."""
    return docs.select(docs[doc_id].alias("doc_id"), licences(docs[text]).alias("found")).select("doc_id", "found.*")
