"""Encoding with a SentencePiece BPE model by backtracking, and decoding.

BPE merges the best-scored adjacent pair first. A sequence of pieces is its result exactly
if every two neighbours are compatible: merging their joint text anew gives the two of
them again. So the encoder takes, from left to right, the longest piece that begins at a
position and is compatible with the piece before; if none is left it steps back and tries the
next shorter one. One pass of an Aho-Corasick automaton finds the longest at every position.
A bit field marks the positions from which the rest was already found impossible. Time grows
in proportion to a text, however long a part of it has no place to cut.

Texts are cut where no piece can cross: before a run of word marks, and around characters
that no longer piece holds, such as a line end. Each cut part is encoded once and
remembered. Whether the model allows this is read from its pieces, not assumed: cuts that
some piece crosses are not made.

Defined results: a null text counts as empty and has no pieces; characters without a
piece become their UTF-8 bytes (or the unknown piece, where a model has no byte pieces).
Models with normalisation rules other than the plain word mark are refused.
"""

import re
from array import array
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column
from pyspark.sql import functions as F

MARK = "▁"
NEVER = float("-inf")
#: Texts that are held as Python objects at a time.
PART_ROWS = 256
#: So many parts are remembered at a time, and as many from before.
REMEMBERED = 200_000
#: Longer parts are not remembered.
REMEMBERED_CHARACTERS = 200


class _Prefixes(dict):
    def __missing__(self, character: str) -> tuple[str, ...]:
        return (character,)


class Encoder:
    """Encodes texts as the library does, without begin or end ids."""

    def __init__(self, model_file: str):
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        for probe in ("  a  b ", "Ａ½", "é"):
            if model.normalize(probe) != MARK + probe.replace(" ", MARK):
                raise ValueError("only models without normalisation rules are supported")
        ids = range(model.get_piece_size())
        plain = [i for i in ids if not (model.is_control(i) or model.is_unknown(i)
                                        or model.is_byte(i) or model.is_unused(i))]
        self.ids = {model.id_to_piece(i): i for i in plain}
        self.scores = {piece: model.get_score(i) for piece, i in self.ids.items()}
        self.bytes = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.byte_fallback = model.is_byte(self.bytes[0])
        self.unknown = model.unk_id()
        long = [p for p in self.ids if len(p) > 1]
        self.inside = set("".join(long))  # characters of longer pieces
        crossed = any(re.search(f"[^{MARK}]{MARK}", p) for p in long)
        alone = "" if "\n" in self.inside else "\n"
        self.parts = re.compile(
            (f"{alone}|" if alone else "")
            + (f"[^{alone}]+" if crossed else f"{MARK}*[^{MARK}{alone}]+|{MARK}+")
        )
        # A piece that merging its own text does not give can never be part of a result.
        reached = {p for p in self.ids if len(p) == 1 or self.merged(p) == [p]}
        #: A piece and those that it begins with, the longest first; a character alone is
        #: always one.
        self.shorter = _Prefixes(
            (piece, tuple(piece[:n] for n in range(len(piece), 0, -1) if n == 1 or piece[:n] in reached))
            for piece in reached
        )
        self.automaton = ahocorasick.Automaton()
        for piece in reached:
            self.automaton.add_word(piece, len(piece) - 1)
        self.automaton.make_automaton()
        self.piece_of = {i: p for p, i in self.ids.items()}
        self.closing = {p: array("i", [i]).tobytes() for p, i in self.ids.items() if len(p) == 1}
        self.fit: dict[str, dict[str, bool]] = defaultdict(dict)
        self.known_fits = 0
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """Merge a short text pair by pair, best score first, leftmost on ties."""
        parts, scores = list(text), self.scores
        found = [scores.get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while found and (best := max(found)) > NEVER:
            k = found.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del found[k]
            if k:
                found[k - 1] = scores.get(parts[k - 1] + parts[k], NEVER)
            if k < len(found):
                found[k] = scores.get(parts[k] + parts[k + 1], NEVER)
        return parts

    def compatible(self, left: str, right: str) -> bool:
        if self.known_fits >= 300_000:
            self.fit.clear()
            self.known_fits = 0
        self.known_fits += 1
        fits = self.merged(left + right) == [left, right]
        self.fit[left][right] = fits
        return fits

    def split(self, text: str) -> list[str]:
        """The pieces of a text; characters without a piece stand for themselves."""
        end = len(text)
        # One pass for the longest piece that begins at each position: the matches come in
        # the order of their ends, so the longest stays.
        to = list(range(1, end + 1))
        for last, before_last in self.automaton.iter(text):
            to[last - before_last] = last + 1
        shorter, fit, compatible = self.shorter, self.fit, self.compatible
        failed = None  # a bit for each position that leads nowhere, once there is one
        at, before, tried = 0, "", 0
        out, tries = [], []
        while at < end:
            found = shorter[text[at : to[at]]]
            if tried:
                found = found[tried:]
            fits = fit[before]
            for piece in found:
                tried += 1
                if failed:
                    after = at + len(piece)
                    if failed[after >> 3] >> (after & 7) & 1:
                        continue
                if before:
                    known = fits.get(piece)
                    if known is None:
                        known = compatible(before, piece)
                    if not known:
                        continue
                out.append(piece)
                tries.append(tried)
                before, tried = piece, 0
                at += len(piece)
                break
            else:  # no piece fits here: step back and forbid this position
                if not out:
                    raise ValueError(f"no encoding for {text[:100]!r}")
                failed = failed or bytearray(end // 8 + 1)
                failed[at >> 3] |= 1 << (at & 7)
                at -= len(out.pop())
                tried = tries.pop()
                before = out[-1] if out else ""
        return out

    def pieces_to_ids(self, pieces: list[str]) -> list[int]:
        out: list[int] = []
        for piece in pieces:
            known = self.ids.get(piece)
            if known is not None:
                out.append(known)
            elif self.byte_fallback:
                out.extend(self.bytes[b] for b in piece.encode("utf-8"))
            else:
                out.append(self.unknown)
        return out

    def extended(self, text: str) -> bytes | None:
        """The ids of a remembered part plus one more character, if that is compatible
        with its last piece: neighbours that fit make the result."""
        shorter, last = text[:-1], text[-1]
        ids, own = self.new.get(shorter), self.closing.get(last)
        if not ids or own is None:
            return None
        before = self.piece_of.get(int.from_bytes(ids[-4:], "little"))
        if before is None:  # a byte of a character without a piece
            return None
        fits = self.fit[before].get(last)
        if fits is None:
            fits = self.compatible(before, last)
        return ids + own if fits else None

    def part(self, text: str) -> bytes:
        """The ids of one part, as 32-bit numbers."""
        ids = self.new.get(text)
        if ids is None:
            ids = self.old.get(text) or self.extended(text)
            if ids is None:
                ids = array("i", self.pieces_to_ids(self.split(text))).tobytes()
            if len(text) <= REMEMBERED_CHARACTERS:
                if len(self.new) >= REMEMBERED:
                    self.old, self.new = self.new, {}
                self.new[text] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        part, known = self.part, self.new.get
        return b"".join([known(p) or part(p) for p in self.parts.findall(MARK + text.replace(" ", MARK))])


def _lists(rows: list[bytes]) -> pa.Array:
    ends = np.cumsum([0] + [len(r) // 4 for r in rows])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(rows), np.int32)))


def _texts(model, rows: list[np.ndarray]) -> pa.Array:
    return pa.array([model.decode(r.tolist()) if len(r) else "" for r in rows], pa.string())


def _udf(of, kind: str, column: Column) -> Column:
    of.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(of, kind)(column)


def encoded(text: Column, model_file: str) -> Column:
    """The ids of a text as an array; ``model_file`` must be readable on executors."""

    def of(batches):
        encoder = Encoder(model_file)
        for texts in batches:
            yield _lists([encoder.encode(t) for t in texts.to_pylist()])

    return _udf(of, "array<int>", F.coalesce(text, F.lit("")))


def decoded(ids: Column, model_file: str) -> Column:
    """The text of an array of ids, as the library's ``decode(ids)`` gives it."""

    def of(batches):
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        for rows in batches:
            ends = np.cumsum(rows.value_lengths().to_numpy())
            yield _texts(model, np.split(rows.flatten().to_numpy(), ends[:-1]) if len(rows) else [])

    return _udf(of, "string", ids)


def coded(text: Column, model_file: str) -> Column:
    """A struct of ``encoded`` ids and the text ``decoded`` from them, by one worker."""

    def of(batches):
        encoder = Encoder(model_file)
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        for texts in batches:
            made = []
            for at in range(0, len(texts), PART_ROWS):
                rows = [encoder.encode(t) for t in texts.slice(at, PART_ROWS).to_pylist()]
                back = _texts(model, [np.frombuffer(r, np.int32) for r in rows])
                made.append(pa.StructArray.from_arrays([_lists(rows), back], ["ids", "decoded"]))
            kind = pa.struct([("ids", pa.list_(pa.int32())), ("decoded", pa.string())])
            yield pa.concat_arrays(made) if made else pa.array([], kind)

    return _udf(of, "struct<ids:array<int>,decoded:string>", F.coalesce(text, F.lit("")))
