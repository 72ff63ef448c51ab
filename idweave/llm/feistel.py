"""Format-preserving pseudonyms of personal numbers and dates by keyed Feistel networks.

Found and validated: payment card numbers (13 to 19 digits, Luhn), IBANs (mod 97), social
security numbers (their excluded ranges), telephone numbers (below), IPv4
addresses (four octets), calendar dates (ISO, and day or month first with slashes or
dots), and e-mail addresses (their local part). What fails its check is no such value
and stays.

A value is a number in the domain of its kind: the digits of a card but the last, the day
number of a date in a span of years, the 32 bits of an address. An alternating Feistel
network keyed by the secret and the kind permutes that domain; a result outside the
valid set is sent through again, which ends inside it and stays a permutation of it. Check
digits are computed anew. So pseudonyms are valid values of the same format and length,
equal values have equal pseudonyms in every document and layout, different values have
different ones, and the owner of the key can invert them.

A run of digit groups is cut at group borders only. Of the stretches that pass, an
unbroken one is taken first, then one in a card's usual layout, then the issuer's usual
length, then the shortest; where a match fails, later kinds are tried at its place and the
scan goes on after its first group.

Telephone numbers are ten digits in the usual groups, with or without a country code;
any number of 6 to 13 digits after a plus sign and a country code; and ten or eleven
digits in groups that begin with a single 0 for long distance. Ten digits that are
unbroken or only spaced, with neither, count only if area and exchange begin with 2 to 9.
The country code and the leading 0 stay, so a number has one pseudonym with either.

A date's day and month stay below ten, or not, so every layout keeps its number of digits.

Text is scanned by one pattern, only where it has a digit or an @. Defined cases: null
text stays null; empty text and text without values are unchanged; very long texts are
read whole; repeated rows give equal results; other columns pass through; columns named
like the added ones are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from datetime import date
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

KINDS = ("card", "iban", "ssn", "phone", "ip", "date", "email")
ADDED = ("text", "n_values", *(f"n_{k}" for k in KINDS), "pseudonyms")
ROUNDS = 10
FIRST_DAY, LAST_DAY = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()

_PATTERN = re.compile(
    r"(?P<email>(?<![\w.+-])[A-Za-z0-9](?:[A-Za-z0-9._+-]*[A-Za-z0-9])?@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)"
    r"|(?P<iban>(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))"
    r"|(?P<ip>(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?\w))"
    r"|(?P<date>(?<![\w/.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})(?![\w/-]))"
    r"|(?P<ssn>(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-]))"
    r"|(?P<phone>(?<![\w+])(?:\+[0-9]{1,3}[ .-]?|1[ .-])?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-]?)[0-9]{3}[ .-]?[0-9]{4}(?!\w)"
    r"|(?<![\w+])\+[1-9][0-9]{0,2}[ .-]?(?:\(0\)[ .-]?)?(?:\([0-9]{1,5}\)|[0-9]{1,13})(?:[ .-][0-9]{2,8}){0,4}(?!\w|[ .-]?[0-9])"
    r"|(?<![\w+.-])(?:\(0[1-9][0-9]{1,4}\) ?|0[1-9][0-9]{1,4}[ -])[0-9]{3,8}(?:[ -][0-9]{3,4})?(?![\w-]| [0-9]))"
    r"|(?P<card>(?<!\w)(?<![^\W\d]-)[0-9](?:[ -]?[0-9]){12,18}(?!\w))"
)
#: The pattern of each kind by itself, in the order of trial.
_SINGLE = [(k, re.compile(x)) for k, x in ((x.split(">", 1)[0][4:], x) for x in re.split(r"\|(?=\(\?P<)", _PATTERN.pattern))]
KIND_ORDER = {k: n for n, (k, _) in enumerate(_SINGLE)}
_GROUP = re.compile(r"[0-9A-Za-z]+")
_CARD_RUN = re.compile(r"[0-9]+(?:[ -][0-9]+)*")
_CARD_LAYOUTS = {(4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 4, 4, 4, 3)}
# Country calling codes of one and of two digits; all others have three.
_ONE_DIGIT_CODES = {"1", "7"}
_TWO_DIGIT_CODES = set(
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 "
    "81 82 84 86 90 91 92 93 94 95 98".split()
)
_LETTERS = "abcdefghijklmnopqrstuvwxyz"


def _fitting(key: bytes) -> bytes:
    """A key of at most 64 bytes; longer ones are hashed."""
    return key if len(key) <= 64 else hashlib.blake2b(key, digest_size=64).digest()


class Permutation:
    """A keyed bijection of 0..size-1 by an alternating Feistel network and cycle walking."""

    def __init__(self, key: bytes, kind: str, size: int) -> None:
        self.size = size
        self.a = isqrt(size - 1) + 1 if size > 1 else 1
        self.b = -(-size // self.a)
        self.seed = hashlib.blake2b(f"{kind}:{size}".encode(), key=_fitting(key), digest_size=32).digest()

    def _round(self, n: int, value: int) -> int:
        data = n.to_bytes(1, "little") + value.to_bytes(32, "little")
        return int.from_bytes(hashlib.blake2b(data, key=self.seed, digest_size=32).digest(), "little")

    def _once(self, x: int) -> int:
        left, right = x % self.a, x // self.a
        for n in range(0, ROUNDS, 2):
            left = (left + self._round(n, right)) % self.a
            right = (right + self._round(n + 1, left)) % self.b
        return right * self.a + left

    def _back(self, x: int) -> int:
        left, right = x % self.a, x // self.a
        for n in range(ROUNDS - 2, -1, -2):
            right = (right - self._round(n + 1, left)) % self.b
            left = (left - self._round(n, right)) % self.a
        return right * self.a + left

    def forward(self, x: int, valid: Callable[[int], bool] = lambda _: True) -> int:
        while True:
            x = self._once(x)
            if x < self.size and valid(x):
                return x

    def backward(self, x: int, valid: Callable[[int], bool] = lambda _: True) -> int:
        while True:
            x = self._back(x)
            if x < self.size and valid(x):
                return x


def luhn_digit(digits: str) -> int:
    """The check digit to follow ``digits``."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 == 0 else 1)
        total += n - 9 if n > 9 else n
    return -total % 10


def _usual_length(digits: str) -> int:
    """Of the issuer's cards, by their first digits."""
    return 15 if digits[:2] in ("34", "37") else 14 if digits[:2] in ("30", "36", "38", "39") else 16


def _cards_from(groups: list[str], first: int) -> list[tuple[tuple, int]]:
    """(rank, last group) of the stretches of digit groups from ``first`` that pass Luhn; best first."""
    out, digits = [], ""
    for last in range(first, len(groups)):
        digits += groups[last]
        if len(digits) > 19:
            break
        if len(digits) >= 13 and luhn_digit(digits[:-1]) == int(digits[-1]):
            layout = tuple(map(len, groups[first : last + 1]))
            kind = 0 if first == last else 1 if layout in _CARD_LAYOUTS else 2
            out.append(((kind, len(digits) != _usual_length(digits), len(digits)), last))
    return sorted(out)


def card_end(text: str, start: int) -> int | None:
    """Where the card that begins at ``start`` ends, or None if there is none."""
    run = _CARD_RUN.match(text, start, start + 80)  # twice the longest card
    if not run:
        return None
    spans = [m.span() for m in _GROUP.finditer(text, start, run.end())]
    if text[run.end() : run.end() + 1].isalnum() or text[run.end() : run.end() + 1] == "_":
        spans.pop()  # the last group goes on as a word
    groups = [text[a:b] for a, b in spans]
    found = _cards_from(groups, 0)
    if not found:
        return None
    rank, last = found[0]
    # digits before a card can pass with a part of it by chance
    for later in range(1, last + 1 if rank[0] == 2 else 0):
        if any(r[0] < 2 for r, _ in _cards_from(groups, later)):
            return None
    return spans[last][1]


def iban_check(country: str, rest: str) -> int:
    moved = "".join(str(int(c, 36)) for c in rest + country + "00")
    return 98 - int(moved) % 97


def _refill(layout: str, chars: str, of: Callable[[str], bool] = str.isdigit) -> str:
    """``layout`` with the characters that ``of`` accepts replaced in order."""
    new = iter(chars)
    return "".join(next(new) if of(c) else c for c in layout)


def _ssn_valid(n: int) -> bool:
    area, group, serial = n // 1_000_000, n // 10_000 % 100, n % 10_000
    return 0 < area < 900 and area != 666 and group > 0 and serial > 0


def _phone_usual(n: int) -> bool:
    """Whether area and exchange begin with 2 to 9."""
    return n // 10**9 > 1 and n // 10**4 % 1000 > 199


def _mixed_radix(chars: str) -> tuple[int, int]:
    """The value and the size of strings with the same letter and digit places."""
    value, size = 0, 1
    for c in chars:
        base = 10 if c.isdigit() else 26
        value = value * base + (int(c) if c.isdigit() else _LETTERS.index(c.lower()))
        size *= base
    return value, size


def _from_radix(value: int, chars: str) -> str:
    out = []
    for c in reversed(chars):
        if c.isdigit():
            value, d = divmod(value, 10)
            out.append(str(d))
        else:
            value, d = divmod(value, 26)
            out.append(_LETTERS[d].upper() if c.isupper() else _LETTERS[d])
    return "".join(reversed(out))


class Pseudonyms:
    """Replaces values under one key; ``inverse`` undoes it."""

    def __init__(self, key: bytes, inverse: bool = False) -> None:
        self.key, self.inverse = key, inverse
        self.nets: dict[tuple[str, int], Permutation] = {}

    def _permute(self, kind: str, x: int, size: int, valid: Callable[[int], bool] = lambda _: True) -> int:
        net = self.nets.get((kind, size))
        if net is None:
            net = self.nets[kind, size] = Permutation(self.key, kind, size)
        return net.backward(x, valid) if self.inverse else net.forward(x, valid)

    def card(self, text: str) -> str | None:
        digits = re.sub(r"\D", "", text)
        if luhn_digit(digits[:-1]) != int(digits[-1]):
            return None
        n = len(digits) - 1
        new = f"{self._permute('card', int(digits[:-1]), 10**n):0{n}d}"
        return _refill(text, new + str(luhn_digit(new)))

    def iban(self, text: str) -> str | None:
        plain = text.replace(" ", "")
        country, rest = plain[:2], plain[4:]
        if int("".join(str(int(c, 36)) for c in rest + plain[:4])) % 97 != 1:
            return None
        value, size = _mixed_radix(rest)
        new = _from_radix(self._permute(f"iban-{country}", value, size), rest)
        return _refill(text, f"{country}{iban_check(country, new):02d}{new}", str.isalnum)

    def ssn(self, text: str) -> str | None:
        n = int(text.replace("-", ""))
        if not _ssn_valid(n):
            return None
        return _refill(text, f"{self._permute('ssn', n, 10**9, _ssn_valid):09d}")

    def phone(self, text: str) -> str | None:
        digits = re.sub(r"\D", "", text)
        if text[0] == "+":
            head = 1 if digits[0] in _ONE_DIGIT_CODES else 2 if digits[:2] in _TWO_DIGIT_CODES else 3
            head += digits[head : head + 1] == "0"
        elif digits[0] == "0" and len(digits) in (10, 11):
            head = 1
        else:
            head = len(digits) - 10
        own = digits[max(0, head) :]
        if head < 0 or not 6 <= len(own) <= 13 or own[0] == "0":
            return None
        number = int(own)
        # numbers keep to their class, so that each layout is found again and equal numbers stay equal
        if len(own) == 10:
            usual = _phone_usual(number)
            if not usual and head == 0 and not re.search(r"[^0-9 ]", text):
                return None
            new = self._permute("phone", number, 10**10, lambda x: x >= 10**9 and _phone_usual(x) == usual)
        else:
            new = self._permute(f"phone-{len(own)}", number, 10 ** len(own), lambda x: x >= 10 ** (len(own) - 1))
        return _refill(text, f"{digits[:head]}{new}")

    def ip(self, text: str) -> str | None:
        octets = [int(x) for x in text.split(".")]
        if max(octets) > 255 or any(len(x) > 1 and x[0] == "0" for x in text.split(".")):
            return None
        new = self._permute("ip", int.from_bytes(bytes(octets), "big"), 1 << 32)
        return ".".join(str(b) for b in new.to_bytes(4, "big"))

    def date(self, text: str) -> str | None:
        parts = re.split(r"[-/.]", text)
        if text[4:5] == "-":
            year, month, day = map(int, parts)
        elif "/" in text:
            month, day, year = map(int, parts)
        else:
            day, month, year = map(int, parts)
        try:
            ordinal = date(year, month, day).toordinal()
        except ValueError:
            return None
        if not FIRST_DAY <= ordinal <= LAST_DAY:
            return None
        short = (day < 10, month < 10)

        def as_short(x: int) -> bool:
            d = date.fromordinal(FIRST_DAY + x)
            return (d.day < 10, d.month < 10) == short

        span = LAST_DAY - FIRST_DAY + 1
        new = date.fromordinal(FIRST_DAY + self._permute("date", ordinal - FIRST_DAY, span, as_short))
        if text[4:5] == "-":
            return new.isoformat()
        first, second = (new.month, new.day) if "/" in text else (new.day, new.month)
        sign = "/" if "/" in text else "."
        return sign.join([f"{first:0{len(parts[0])}d}", f"{second:0{len(parts[1])}d}", str(new.year)])

    def email(self, text: str) -> str | None:
        local, _, domain = text.partition("@")
        plain = "".join(c for c in local if c.isalnum())
        value, size = _mixed_radix(plain)
        new = _from_radix(self._permute("email-" + "".join("d" if c.isdigit() else "a" for c in plain), value, size), plain)
        return f"{_refill(local, new, str.isalnum)}@{domain}"

    def replace(self, text: str) -> tuple[str, list[tuple[str, str]]]:
        """The text with its values replaced, and (kind, pseudonym) of each in order."""
        found: list[tuple[str, str]] = []
        out, done, at = [], 0, 0
        while m := _PATTERN.search(text, at):
            hit = self._at(text, m.start(), m.lastgroup)
            if hit is None:
                group = _GROUP.match(text, m.start())
                at = group.end() if group else m.start() + 1
                continue
            kind, end, new = hit
            out += (text[done : m.start()], new)
            found.append((kind, new))
            done = at = end
        return "".join(out) + text[done:], found

    def _at(self, text: str, start: int, kind: str) -> tuple[str, int, str] | None:
        """(kind, end, pseudonym) of the first kind from ``kind`` on with a valid value at ``start``."""
        for k, pattern in _SINGLE[KIND_ORDER[kind] :]:
            m = pattern.match(text, start)
            for end in self._ends(k, text, m) if m else ():
                new = getattr(self, k)(text[start:end])
                if new is not None:
                    return k, end, new
        return None

    @staticmethod
    def _ends(kind: str, text: str, m: re.Match) -> list[int]:
        """Where the value of a match may end: for cards and IBANs at its group borders."""
        if kind == "card":
            end = card_end(text, m.start())
            return [] if end is None else [end]
        if kind != "iban":
            return [m.end()]
        ends = [g.end() for g in _GROUP.finditer(text, m.start(), m.end())]
        return [e for e in ends if len(text[m.start() : e].replace(" ", "")) >= 15]


def pseudonymised(docs: DataFrame, key: bytes) -> DataFrame:
    """``docs`` with the new text, counts by kind, and the pseudonyms in order of reading."""
    keep = [c for c in docs.columns if c not in ADDED]
    schema = docs.select(*keep, "text").schema
    schema = schema.add("n_values", "long")
    for k in KINDS:
        schema = schema.add(f"n_{k}", "long")
    schema = schema.add("pseudonyms", T.ArrayType(T.StringType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Pseudonyms(key)
        for batch in batches:
            texts, values, counts = [], [], {k: [] for k in KINDS}
            for text in batch.column("text").to_pylist():
                new, found = names.replace(text) if text and _CUE.search(text) else (text, [])
                texts.append(new)
                values.append([v for _, v in found])
                kinds = [k for k, _ in found]
                for k in KINDS:
                    counts[k].append(kinds.count(k))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in keep),
                    pa.array(texts, pa.string()),
                    pa.array([len(v) for v in values], pa.int64()),
                    *(pa.array(counts[k], pa.int64()) for k in KINDS),
                    pa.array(values, pa.list_(pa.string())),
                ],
                names=[*keep, "text", "n_values", *(f"n_{k}" for k in KINDS), "pseudonyms"],
            )

    return docs.select(*keep, "text").mapInArrow(run, schema)


_CUE = re.compile(r"[0-9@]")
