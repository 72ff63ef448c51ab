"""Pseudonyms: permutations, formats, links and the inverse."""

import random
import re
from datetime import date, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from idweave.llm import feistel as fp

KEY = b"k" * 16


@pytest.mark.parametrize("size", [1, 2, 3, 10, 97, 1000, 4096])
def test_permutes_the_domain(size):
    net = fp.Permutation(KEY, "t", size)
    image = [net.forward(x) for x in range(size)]
    assert sorted(image) == list(range(size))
    assert [net.backward(y) for y in image] == list(range(size))


def card(rng, n):
    body = "".join(str(rng.randrange(10)) for _ in range(n - 1))
    return body + str(fp.luhn_digit(body))


def values(rng):
    day = date(1900, 1, 1) + timedelta(rng.randrange(73000))
    rest = "".join(str(rng.randrange(10)) for _ in range(18))
    c = card(rng, 16)
    return {
        "card": [c, " ".join(c[i : i + 4] for i in range(0, 16, 4)), card(rng, 13)],
        "iban": [f"DE{fp.iban_check('DE', rest):02d}{rest}"],
        "ssn": [f"{rng.randrange(1, 600):03d}-{rng.randrange(1, 100):02d}-{rng.randrange(1, 10000):04d}"],
        "phone": [f"+1 ({rng.randrange(1000):03d}) {rng.randrange(1000):03d}-{rng.randrange(10000):04d}"],
        "ip": [".".join(str(rng.randrange(256)) for _ in range(4))],
        "date": [day.isoformat(), f"{day.month}/{day.day}/{day.year}", f"{day.day:02d}.{day.month:02d}.{day.year}"],
        "email": [f"ab.{rng.randrange(100)}x@mail{rng.randrange(9)}.example.com"],
    }


def test_values_keep_kind_and_format_and_can_be_restored():
    rng = random.Random(3)
    names, back = fp.Pseudonyms(KEY), fp.Pseudonyms(KEY, inverse=True)
    for _ in range(60):
        for kind, texts in values(rng).items():
            for text in texts:
                new, found = names.replace(f"see {text}, ok")
                assert [k for k, _ in found] == [kind], (kind, text)
                out = found[0][1]
                assert out in new and fp.Pseudonyms(KEY).replace(out)[1][0][0] == kind
                if kind != "date" and kind != "ip":
                    assert re.sub(r"[0-9]", "9", out).lower().translate(str.maketrans("abcdefghijklmnopqrstuvwxyz", "a" * 26)) == re.sub(
                        r"[0-9]", "9", text
                    ).lower().translate(str.maketrans("abcdefghijklmnopqrstuvwxyz", "a" * 26))
                restored = back.replace(out)[0]
                same = re.sub(r"(?<![0-9])0", "", restored) == re.sub(r"(?<![0-9])0", "", text)
                assert restored == text or (kind == "date" and same)


def test_equal_values_stay_linked_over_layouts():
    names = fp.Pseudonyms(KEY)
    digits = lambda s: re.sub(r"\D", "", s)
    assert digits(names.card("4111111111111111")) == digits(names.card("4111 1111 1111 1111"))
    iso, german = names.date("2020-02-29"), names.date("29.02.2020")
    assert iso == "-".join(reversed(german.split(".")))
    assert names.card("4111111111111111") != fp.Pseudonyms(b"other").card("4111111111111111")


@pytest.mark.parametrize(
    "text",
    ["4111111111111112", "2021-02-29", "31.04.2020", "999.1.1.1", "01.2.3.4", "000-12-3456", "666-12-3456", "123-00-1234",
     "DE00370400440532013000", "1234", "no numbers", "", "v1.2.3.4.5"],
)
def test_what_fails_its_check_stays(text):
    assert fp.Pseudonyms(KEY).replace(text) == (text, [])


def test_table(spark):
    docs = [(1, "card 4111111111111111 and 10.0.0.1", "a"), (None, "4111 1111 1111 1111", None), (3, None, "b"), (4, "", "c"),
            (1, "card 4111111111111111 and 10.0.0.1", "a"), (5, "x" * 300_000 + " 10.0.0.1", "d")]
    df = spark.createDataFrame(docs, "doc_id long, text string, n_values string")
    rows = fp.pseudonymised(df, KEY).collect()
    assert len(rows) == 6
    first = next(r for r in rows if r.doc_id == 1)
    assert (first.n_values, first.n_card, first.n_ip) == (2, 1, 1)
    assert "4111111111111111" not in first.text and "10.0.0.1" not in first.text
    spaced = next(r for r in rows if r.doc_id is None)
    assert spaced.pseudonyms[0].replace(" ", "") == first.pseudonyms[0]
    assert next(r for r in rows if r.doc_id == 5).pseudonyms == [first.pseudonyms[1]]
    assert next(r for r in rows if r.doc_id == 3).text is None
    assert fp.pseudonymised(df.limit(0), KEY).collect() == []


@pytest.mark.parametrize("card", ["4111111111111111", "4111 1111 1111 1111", "4111-1111-1111-1111"])
@pytest.mark.parametrize(
    "around",
    ["{} 12/27", "{} 123", "{} 12 boxes", "{}-123", "12/27 {}", "27 {} 123", "{} 4111111111111111", "{} 7x", "12-{}", "{} 9 8 7"],
)
def test_card_beside_other_digits(card, around):
    names = fp.Pseudonyms(KEY)
    new, found = names.replace(around.format(card))
    want = names.card(card)
    assert found[0] == ("card", want) and new.startswith(around.format(want)[: around.index("{") + len(want)])
    assert fp.Pseudonyms(KEY, inverse=True).replace(new)[0] == around.format(card)


def test_later_values_are_still_seen():
    names = fp.Pseudonyms(KEY)
    kinds = lambda t: [k for k, _ in names.replace(t)[1]]
    assert kinds("4111111111111111 192.168.0.1") == ["card", "ip"]
    assert kinds("4111111111111112 192.168.0.1") == ["ip"]
    assert kinds("DE89370400440532013000 1234 5678") == ["iban"]
    for cvc in range(1000):  # also where the longer run passes Luhn by chance
        assert names.replace(f"4111 1111 1111 1111 {cvc:03d}")[1] == [("card", names.card("4111 1111 1111 1111"))]


def test_telephone_layouts_are_linked():
    names, back = fp.Pseudonyms(KEY), fp.Pseudonyms(KEY, inverse=True)
    texts = ["555 234 5678", "5552345678", "+15552345678", "+1 555 234 5678", "1-555-234-5678", "(555)234-5678", "555.234.5678"]
    seen = set()
    for text in texts:
        new, found = names.replace(f"call {text}.")
        assert [k for k, _ in found] == ["phone"], text
        assert back.replace(new)[0] == f"call {text}."
        seen.add(re.sub(r"\D", "", new)[-10:])
    assert len(seen) == 1
    for text in ("1700000000", "100 200 3000"):
        assert names.replace(text) == (text, [])


@settings(max_examples=200, deadline=None)
@given(
    st.dates(date(1900, 1, 1), date(2099, 12, 31)),
    st.sampled_from(["{m}/{d}/{y}", "{d}.{m}.{y}", "{m:02d}/{d:02d}/{y}", "{d:02d}.{m}.{y}", "{y}-{m:02d}-{d:02d}"]),
)
def test_dates_keep_their_digits_and_are_inverted(day, layout):
    text = layout.format(d=day.day, m=day.month, y=day.year)
    new, found = fp.Pseudonyms(b"k").replace(text)
    assert [k for k, _ in found] == ["date"]
    assert re.sub("[0-9]", "0", new) == re.sub("[0-9]", "0", text)
    assert fp.Pseudonyms(b"k", inverse=True).replace(new)[0] == text


def test_a_date_is_linked_in_every_layout():
    got = {fp.Pseudonyms(b"k").replace(t)[0] for t in ("2024-01-02", "1/2/2024", "01/02/2024", "2.1.2024", "02.01.2024")}
    as_dates = set()
    for t in got:
        parts = [int(x) for x in re.split("[-/.]", t)]
        y, m, d = parts if "-" in t else (parts[2], *parts[:2]) if "/" in t else (parts[2], parts[1], parts[0])
        as_dates.add((y, m, d))
    assert len(as_dates) == 1 and as_dates != {(2024, 1, 2)}


@pytest.mark.parametrize(
    "text",
    ["+44 20 7946 0958", "+442079460958", "+44 (0)20 7946 0958", "020 7946 0958", "(020) 7946 0958", "0171 1234567",
     "+49 30 1234567", "+33 1 23 45 67 89", "+353 1 234 5678", "+1 555 123 4567", "+7 912 345 67 89", "0800-123-4567"],
)
def test_international_and_trunk_numbers(text):
    new, found = fp.Pseudonyms(b"k").replace(f"call {text}, or write")
    assert [k for k, _ in found] == ["phone"] and new != f"call {text}, or write"
    assert re.sub("[0-9]", "0", new) == re.sub("[0-9]", "0", f"call {text}, or write")
    assert fp.Pseudonyms(b"k", inverse=True).replace(new)[0] == f"call {text}, or write"


def test_a_number_is_linked_with_and_without_its_country_code():
    digits = lambda t: re.sub("[^0-9]", "", fp.Pseudonyms(b"k").replace(t)[0])
    assert digits("+44 20 7946 0958")[2:] == digits("020 7946 0958")[1:] == digits("+44 (0)20 7946 0958")[3:]


@pytest.mark.parametrize("text", ["0.123 456", "see 10 20 30", "+5", "+1 2", "007", "0 12 34", "01 02", "1+2 345 678", "00123 456 789"])
def test_no_telephone_numbers(text):
    assert fp.Pseudonyms(b"k").replace(text) == (text, [])


def test_every_byte_of_a_long_key_counts():
    one, two = b"x" * 64 + b"a", b"x" * 64 + b"b"
    assert len({fp.Pseudonyms(k).replace("2024-01-02")[0] for k in (one, two, b"x" * 64)}) == 3


def test_very_long_texts(spark):
    text = "word 4111 1111 1111 1111 word\n" * 20_000
    (r,) = fp.pseudonymised(spark.createDataFrame([(1, text)], "doc_id long, text string"), b"k").collect()
    assert r["n_card"] == 20_000 and len(set(r["pseudonyms"])) == 1 and len(r["text"]) == len(text)
