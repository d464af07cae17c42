"""Format-preserving pseudonyms for personal data, by keyed Feistel permutations.

Numbers and dates are found by pattern, validated (check digits, octets, calendar), and
replaced by another valid value of the same format: a keyed Feistel network permutes all
values of the format, walking until the result is one of them. Equal values get equal
pseudonyms in every document, whatever their separators; different values stay different.

| kind | validated by | permuted | kept |
| --- | --- | --- | --- |
| email | pattern, at most 64 characters before the @ and 255 after it | letters and digits before the @, each within its kind | all else |
| ip | octets to 255 | the 32 bits | dots |
| iban | check digits modulo 97 | account part, check digits renewed | country |
| card | check digit (Luhn), 13 to 19 digits | digits, check digit renewed | separators |
| ssn | assigned areas | nine digits, within assigned areas | dashes |
| date | calendar, years 1900 to 2099 | the day among all days of these years | order, separators |
| phone | pattern, with a country code 8 to 15 digits | digits after the country code | code, separators |

Where kinds overlap the earlier one in this table wins. Groups of digits beside a number may
look like a part of it, so cards, IBANs and phones are sought at all borders of groups within
such a run. Numbers that fail validation everywhere are left alone. Defined results: a null
text stays null and has no finds; a very long text takes time in proportion to its length,
whatever its runs of letters and digits; repeated rows are treated alike; an empty table gives
an empty result.
"""

import datetime
import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: For tests and examples. Use a secret key of your own in production.
EXAMPLE_KEY = b"quotelane example key"

PATTERNS = {
    "ip": r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\w)",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?= ?[A-Z0-9])",
    "card": r"(?<![\w.+-])\d++(?:[ -]\d++)*(?![\w-])",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "date": r"(?<![\w./-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{1,2}/\d{1,2}|\d{1,2}[./]\d{1,2}[./]\d{4})"
            r"(?:(?![\w/-])|(?=T\d{2}))",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\)|\d{3})[ .-]\d{3}[ .-]\d{4}(?!\w)"
             r"|(?<![\w+])\+\d++(?:[ ./-]?(?:\(\d++\)|(?<!\d)\d++))*",
}
#: What stands before and after the @ of an address, and the most characters of each.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL_MOST, DOMAIN_MOST = 64, 255
#: Lengths of IBANs.
IBAN_LENGTHS = {
    length: set(countries.split()) for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
        21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
        24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
        27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA",
        30: "JO KW MU", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()}
#: Country codes of one and of two digits; all others have three.
SHORT_CODES = re.compile(r"[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]")
FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
DAYS = datetime.date(2100, 1, 1).toordinal() - FIRST_DAY


def permuted(value: int, size: int, key: bytes, kind: str, back: bool = False) -> int:
    """A keyed permutation of range(size), another one for each kind and size."""
    bits = max(1, ((size - 1).bit_length() + 1) // 2)
    mask, label = (1 << bits) - 1, f"{kind}:{size}:".encode()

    def mix(turn: int, half: int) -> int:
        data = label + turn.to_bytes(1, "big") + half.to_bytes((bits + 7) // 8, "big")
        digest = hashlib.blake2b(data, key=key[:64], digest_size=min(64, (bits + 7) // 8 + 8))
        return int.from_bytes(digest.digest(), "big") & mask

    while True:
        left, right = value >> bits, value & mask
        for turn in range(ROUNDS - 1, -1, -1) if back else range(ROUNDS):
            if back:
                left, right = right ^ mix(turn, left), left
            else:
                left, right = right, left ^ mix(turn, right)
        value = left << bits | right
        if value < size:
            return value


def luhn(digits: str) -> int:
    """The check digit for the digits before it."""
    doubled = [int(d) * (2 - k % 2) for k, d in enumerate(reversed(digits))]
    return -sum(d // 10 + d % 10 for d in doubled) % 10


def _refill(shape: str, digits: str) -> str:
    """Put digits in the places of the digits of ``shape``."""
    left = iter(digits)
    return "".join(next(left) if c.isdigit() else c for c in shape)


def _email(found: str, key: bytes) -> str | None:
    local, domain = found.split("@", 1)
    radix = [(48, 10) if c.isdigit() else (97, 26) if c.islower() else (65, 26) for c in local if c.isalnum()]
    value, size = 0, 1
    for c, (first, n) in zip((c for c in local if c.isalnum()), radix):
        value, size = value * n + ord(c) - first, size * n
    shape = re.sub("[A-Z]", "A", re.sub("[a-z]", "a", re.sub("[0-9]", "0", local)))
    value = permuted(value, size, key, "email:" + shape)
    out = []
    for first, n in reversed(radix):
        value, k = divmod(value, n)
        out.append(chr(first + k))
    new = iter(reversed(out))
    return "".join(next(new) if c.isalnum() else c for c in local) + "@" + domain


def _ip(found: str, key: bytes) -> str | None:
    octets = [int(x) for x in found.split(".")]
    if max(octets) > 255:
        return None
    return ".".join(str(b) for b in permuted(int.from_bytes(bytes(octets), "big"), 1 << 32, key, "ip").to_bytes(4, "big"))


def _iban(found: str, key: bytes) -> str | None:
    plain = found.replace(" ", "")
    number = lambda s: int("".join(str(int(c, 36)) for c in s))
    if not 15 <= len(plain) <= 34 or number(plain[4:] + plain[:4]) % 97 != 1:
        return None
    body, value, size = plain[4:], 0, 1
    for c in body:
        n, k = (10, int(c)) if c.isdigit() else (26, ord(c) - 65)
        value, size = value * n + k, size * n
    value, out = permuted(value, size, key, "iban:" + plain[:2] + re.sub(r"\d", "0", re.sub("[A-Z]", "A", body))), []
    for c in reversed(body):
        value, k = divmod(value, 10 if c.isdigit() else 26)
        out.append(str(k) if c.isdigit() else chr(65 + k))
    body = "".join(reversed(out))
    new = iter(plain[:2] + f"{98 - number(body + plain[:2] + '00') % 97:02d}" + body)
    return "".join(c if c == " " else next(new) for c in found)


def _card(found: str, key: bytes) -> str | None:
    digits = re.sub(r"\D", "", found)
    if luhn(digits[:-1]) != int(digits[-1]):
        return None
    body = str(permuted(int(digits[:-1]), 10 ** (len(digits) - 1), key, "card")).zfill(len(digits) - 1)
    return _refill(found, body + str(luhn(body)))


def _ssn(found: str, key: bytes) -> str | None:
    def valid(n: str) -> bool:
        return n[:3] not in ("000", "666") and n[0] != "9" and n[3:5] != "00" and n[5:] != "0000"

    digits = found.replace("-", "")
    if not valid(digits):
        return None
    while True:  # walk on until an assigned number
        digits = str(permuted(int(digits), 10**9, key, "ssn")).zfill(9)
        if valid(digits):
            return _refill(found, digits)


def _date(found: str, key: bytes) -> str | None:
    a, b, c = re.split("[./-]", found)
    year, month, day = (a, b, c) if len(a) == 4 else (c, b, a)
    swapped = len(a) != 4 and int(month) > 12  # month before day
    if swapped:
        month, day = day, month
    try:
        at = datetime.date(int(year), int(month), int(day)).toordinal() - FIRST_DAY
    except ValueError:
        return None
    if not 0 <= at < DAYS:
        return None
    while True:
        at = permuted(at, DAYS, key, "date")
        new = datetime.date.fromordinal(FIRST_DAY + at)
        # A date that reads as day and month only one way stays one.
        if swapped and new.day <= 12:
            continue
        if len(a) == 4:
            return f"{new.year:04d}{found[4]}{new.month:0{len(b)}d}{found[4]}{new.day:0{len(c)}d}"
        first, second = (new.month, new.day) if swapped else (new.day, new.month)
        return f"{first:0{len(a)}d}{found[len(a)]}{second:0{len(b)}d}{found[len(a) + 1 + len(b)]}{new.year:04d}"


def _phone(found: str, key: bytes) -> str | None:
    lead = re.match(r"\+(\d+)", found)
    at = 0
    if lead:
        digits = lead.group(1)
        short = SHORT_CODES.match(digits)
        at = 1 + (len(digits) if len(digits) <= 3 else len(short.group()) if short else 3)
    digits = re.sub(r"\D", "", found[at:])
    new = str(permuted(int(digits), 10 ** len(digits), key, "phone")).zfill(len(digits))
    return found[:at] + _refill(found[at:], new)


REPLACE: dict[str, Callable[[str, bytes], str | None]] = {
    "email": _email, "ip": _ip, "iban": _iban, "card": _card, "ssn": _ssn, "date": _date, "phone": _phone}


def _iban_spans(text: str, start: int, stop: int) -> list[tuple[int, int]]:
    """Ends at borders; the country's own length first, then the longest."""
    ends, plain, at = [], 4, stop
    while plain < 34:
        at += text[at : at + 1] == " "
        if not (c := text[at : at + 1]).isascii() or not (c.isdigit() or c.isupper()):
            break
        plain, at = plain + 1, at + 1
        if plain >= 15 and not re.match("[A-Za-z0-9]", text[at : at + 1]):
            ends.append((text[start : start + 2] not in IBAN_LENGTHS.get(plain, ()), -plain, at))
    return [(start, end) for _, _, end in sorted(ends)]


def _card_spans(text: str, start: int, stop: int) -> list[tuple[int, int]]:
    """Neighbouring groups of 13 to 19 digits with a right check digit; usual groupings
    first, then the longest."""
    groups = [(m.start(), m.end()) for m in re.compile(r"\d+").finditer(text, start, stop)]
    digits = [int(c) for a, b in groups for c in text[a:b]]
    # Sums of the digits so far, those at even or at odd places doubled.
    doubled = [[0, *accumulate(d * 2 // 10 + d * 2 % 10 if k % 2 == odd else d for k, d in enumerate(digits))]
               for odd in (0, 1)]
    ends = list(accumulate(b - a for a, b in groups))
    out = []
    for i, (first, last) in enumerate(groups):
        before = ends[i] - (last - first)
        for j in range(i, min(i + 19, len(groups))):
            end = ends[j]
            n = end - before
            if n > 19:
                break
            sums = doubled[end % 2]  # the last digit counts once, the one before it twice
            if n >= 13 and (sums[end] - sums[before]) % 10 == 0:
                sizes = [b - a for a, b in groups[i : j + 1]]
                usual = len(sizes) == 1 or set(sizes[:-1]) == {4} and sizes[-1] <= 4 or sizes == [4, 6, 5]
                out.append((not usual, -n, first, groups[j][1]))
    return [(first, end) for _, _, first, end in sorted(out)]


def _phone_spans(text: str, start: int, stop: int) -> list[tuple[int, int]]:
    """Without a code, or in groups of 3, 3 and 4, the match; else 8 to 15 digits."""
    if text[start] != "+" or re.fullmatch(r"\+\d{1,3}[ .-]?(?:\(\d{3}\)|\d{3})[ .-]\d{3}[ .-]\d{4}", text[start:stop]):
        return [(start, stop)]
    ends, digits = [], 0
    for m in re.compile(r"\d+\)?").finditer(text, start, stop):
        digits += len(m.group().rstrip(")"))
        if digits > 15:
            break
        if digits >= 8 and not re.match(r"\w", text[m.end() : m.end() + 1]):
            ends.append((start, m.end()))
    return ends[::-1]


SPANS: dict[str, Callable[[str, int, int], list[tuple[int, int]]]] = {
    "iban": _iban_spans, "card": _card_spans, "phone": _phone_spans}


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Addresses in order, each from its @ to the left and to the right."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1)
        if domain and at - start <= LOCAL_MOST and domain.end() - at - 1 <= DOMAIN_MOST \
                and any(c.isalnum() for c in text[start:at]):
            yield start, domain.end()
            free = domain.end()
        else:
            free = at + 1
        at = text.find("@", free)


def _candidates(text: str) -> Iterator[tuple[str, int, int]]:
    """Places that may hold a value, those of earlier kinds first."""
    for start, end in _emails(text):
        yield "email", start, end
    if re.search(r"\d", text) is None:
        return
    for kind, pattern in PATTERNS.items():
        for match in re.finditer(pattern, text):
            spans = SPANS[kind](text, *match.span()) if kind in SPANS else [match.span()]
            for start, end in spans:
                yield kind, start, end


def found_in(text: str, key: bytes) -> list[tuple[int, int, str, str]]:
    """Finds of a text in order: (start, end, kind, pseudonym)."""
    out: list[tuple[int, int, str, str]] = []
    taken = bytearray(len(text))
    for kind, start, end in _candidates(text):
        if taken.find(1, start, end) < 0:
            new = REPLACE[kind](text[start:end], key)
            if new is not None:
                out.append((start, end, kind, new))
                taken[start:end] = b"\1" * (end - start)
    return sorted(out)


def replaced(text: str | None, key: bytes) -> tuple[str | None, list]:
    if text is None:
        return None, []
    finds, parts, at = found_in(text, key), [], 0
    for start, end, _, new in finds:
        parts += [text[at:start], new]
        at = end
    return "".join([*parts, text[at:]]), finds


def pseudonymised(
    docs: DataFrame, key: bytes = EXAMPLE_KEY, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Rows (doc_id, text, n_replaced, spans): spans are kind:start:end of the old text, in
    code points, joined by commas."""

    def of(texts: pa.Array) -> pa.Array:
        rows = []
        for t in texts.to_pylist():
            new, finds = replaced(t, key)
            spans = ",".join(f"{kind}:{start}:{end}" for start, end, kind, _ in finds)
            rows.append({"text": new, "n_replaced": len(finds), "spans": spans})
        return pa.array(rows, pa.struct([("text", pa.string()), ("n_replaced", pa.int64()), ("spans", pa.string())]))

    made = F.arrow_udf(of, "struct<text:string,n_replaced:long,spans:string>")(docs[text])
    return docs.select(docs[doc_id].alias("doc_id"), made.alias("made")).select("doc_id", "made.*")
