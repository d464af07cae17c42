import random
import re
import time

import pytest

from quotelane.llm import pseudonyms
from quotelane.llm import pseudonyms as p

KEY = b"k"


@pytest.mark.parametrize("size", [1, 2, 7, 100, 1000])
def test_permutations(size):
    out = [p.permuted(i, size, KEY, "x") for i in range(size)]
    assert sorted(out) == list(range(size))
    assert [p.permuted(v, size, KEY, "x", back=True) for v in out] == list(range(size))


@pytest.mark.parametrize("text,kind,shape", [
    ("4111 1111 1111 1111", "card", r"\d{4} \d{4} \d{4} \d{4}"),
    ("DE89 3704 0044 0532 0130 00", "iban", r"DE\d\d( \d{4}){4} \d\d"),
    ("2024-02-29", "date", r"\d{4}-\d\d-\d\d"), ("31.12.1999", "date", r"\d\d\.\d\d\.\d{4}"),
    ("12/25/2001", "date", r"\d\d/\d\d/\d{4}"), ("+1 (980) 555-2833", "phone", r"\+1 \(\d{3}\) \d{3}-\d{4}"),
    ("078-05-1120", "ssn", r"\d{3}-\d\d-\d{4}"), ("10.1.2.3", "ip", r"\d+(\.\d+){3}"),
    ("Bob.Smith42@mail.example.com", "email", r"[A-Z][a-z]{2}\.[A-Z][a-z]{4}\d\d@mail\.example\.com"),
])
def test_formats_and_validity_stay(text, kind, shape):
    new, finds = p.replaced(f"x {text}, y", KEY)
    assert [f[2] for f in finds] == [kind] and text not in new
    value = new[2:-3]
    assert re.fullmatch(shape, value)
    again, finds = p.replaced(value, KEY)  # the pseudonym is valid too
    assert [f[2] for f in finds] == [kind] and again != value


@pytest.mark.parametrize("text", ["4111-1111-1111-1112", "10.0.0.256", "2024-02-30", "000-12-3456", "1.2.3.4.5",
                                  "DE89 3704 0044 0532 0130 02", "2.0.", "no digits at all", ""])
def test_what_is_not_valid_stays(text):
    assert p.replaced(text, KEY) == (text, [])


CARD, IBAN = "4111111111111111", "DE89 3704 0044 0532 0130 00"


@pytest.mark.parametrize("text,value,kind", [
    (f"order 12 {CARD} paid", CARD, "card"), (f"{CARD} 12 items", CARD, "card"),
    (f"{CARD} 12/27 123", CARD, "card"), ("4111 1111 1111 1111 737", "4111 1111 1111 1111", "card"),
    (f"1234567890 1234 {CARD}", CARD, "card"), (f"{IBAN} {CARD}", CARD, "card"),
    (f"{IBAN} EUR 5", IBAN, "iban"), ("DE89370400440532013000 BIC COBADEFF", "DE89370400440532013000", "iban"),
    (f"AB12 {IBAN}", IBAN, "iban"),
    ("call +44 20 7946 0958 now", "+44 20 7946 0958", "phone"), ("+49 170 1234567.", "+49 170 1234567", "phone"),
    ("+442079460958", "+442079460958", "phone"), ("+49 170 1234567 2024-05-06", "+49 170 1234567", "phone"),
    ("at 2024-05-06T10:00:00Z", "2024-05-06", "date"), ("on 2024/05/06, late", "2024/05/06", "date"),
])
def test_values_beside_other_numbers_are_found(text, value, kind):
    new, finds = p.replaced(text, KEY)
    assert (text.index(value), text.index(value) + len(value), kind) in [f[:3] for f in finds]
    assert value not in new and len(new) == len(text)
    assert p.replaced(new, KEY)[0] != new  # the pseudonym is valid too


def test_phones_stay_linked_whatever_their_separators():
    one, _ = p.replaced("+44 20 7946 0958 or +442079460958", KEY)
    first, second = one.split(" or ")
    assert first.replace(" ", "") == second and first.startswith("+44 ")


def test_equal_values_stay_linked_and_keys_matter():
    one, _ = p.replaced("4111111111111111 and 4111-1111-1111-1111", KEY)
    first, second = one.split(" and ")
    assert first == second.replace("-", "")
    assert p.replaced("4111111111111111", b"other")[0] != first


def test_frame(spark):
    rows = [(1, None), (2, ""), (3, "mail a.b@c.de or 10.1.2.3 🙂"), (3, "mail a.b@c.de or 10.1.2.3 🙂"), (None, "x " * 50_000)]
    docs = spark.createDataFrame([(i, t, 1, "s") for i, t in rows], "doc_id long, text string, n_replaced int, spans string")
    found = sorted(p.pseudonymised(docs).collect(), key=str)
    assert len(found) == 5 and sum(r["n_replaced"] for r in found) == 4
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[1]["text"] is None and by_id[2]["text"] == "" and by_id[None]["text"] == "x " * 50_000
    assert by_id[3]["spans"] == "email:5:13,ip:17:25" and "a.b@" not in by_id[3]["text"]
    assert p.pseudonymised(docs.where("false")).collect() == []


def slow_finds(text):
    """Finds by trying every candidate against every other, as the table of kinds says."""
    email = r"[A-Za-z0-9._%+-]*[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
    places = [("email", *m.span()) for m in re.finditer(email, text)]
    for kind, pattern in pseudonyms.PATTERNS.items():
        for m in re.finditer(pattern, text):
            if kind != "card":
                own = pseudonyms.SPANS[kind](text, *m.span()) if kind in pseudonyms.SPANS else [m.span()]
                places += [(kind, *span) for span in own]
                continue
            groups = [g.span() for g in re.compile(r"\d+").finditer(text, *m.span())]
            cards = []
            for i in range(len(groups)):
                for j in range(i, len(groups)):
                    sizes = [b - a for a, b in groups[i : j + 1]]
                    if 13 <= sum(sizes) <= 19:
                        usual = len(sizes) == 1 or set(sizes[:-1]) == {4} and sizes[-1] <= 4 or sizes == [4, 6, 5]
                        cards.append((not usual, -sum(sizes), groups[i][0], groups[j][1]))
            places += [("card", a, b) for _, _, a, b in sorted(cards)]
    out = []
    for kind, start, end in places:
        if not any(a < end and start < b for a, b, _, _ in out):
            new = pseudonyms.REPLACE[kind](text[start:end], b"k")
            if new is not None:
                out.append((start, end, kind, new))
    return sorted(out)


@pytest.mark.parametrize("letters", ["0123456789 -", "ab1@.-%", "0123456789 +()-.", "DE0123 ", ("2024", "12", "1", "/", "/", "-", "-", "T10", " ")])
def test_finds_equal_those_of_trying_everything(letters):
    rng = random.Random(len(letters))
    some = 0
    for _ in range(1500):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))
        found = pseudonyms.found_in(text, b"k")
        assert found == slow_finds(text), repr(text)
        some += len(found)
    assert some


@pytest.mark.parametrize(
    "text",
    ["a" * 1_000_000 + "@", "a" * 1_000_000 + "@b.c", "@" * 300_000, "a@" * 300_000, "a@b." * 200_000, "7" * 1_000_000,
     "7 " * 500_000, "12-" * 300_000, "4111 1111 1111 1111 " * 10_000, "+1" * 300_000, "+49 " + "1 " * 300_000,
     "a.b" * 300_000 + "@" + "c." * 300_000],
)
def test_long_runs_take_linear_time(text):
    started = time.monotonic()
    pseudonyms.found_in(text, b"k")
    assert time.monotonic() - started < 20
