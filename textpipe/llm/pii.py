"""Personal data as format-preserving pseudonyms.

Numbers and dates that are valid as what they look like (check digits, calendar, address ranges)
are replaced by another valid value of the same format: the value is numbered within its format,
the number is permuted by a keyed Feistel network, and the value with the new number is written
with the old separators. Equal values get equal pseudonyms in every document, whatever separators
they are written with, and no table of them is kept. What fails validation stays as it is.

Only texts with a digit are handed to Python; nothing is shuffled.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from datetime import date
from hashlib import blake2b
from math import isqrt

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textpipe.llm.common import free_names

ROUNDS = 10
_DIGITS = "0123456789"
_FIRST, _LAST = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()


class Feistel:
    """Keyed permutations of the numbers below any bound, one for each name of a format."""

    def __init__(self, key: bytes) -> None:
        self.key = key

    def _mix(self, name: str, n: int, step: int, value: int) -> int:
        data = f"{name}|{n}|{step}|{value}".encode()
        return int.from_bytes(blake2b(data, key=self.key, digest_size=16).digest())

    def permute(self, name: str, n: int, value: int) -> int:
        """Where ``value`` below ``n`` goes. Values beyond ``n`` are walked until one is below."""
        a = isqrt(n - 1) + 1 if n > 1 else 1
        b = -(-n // a)
        while True:
            left, right = divmod(value, b)
            for step in range(0, ROUNDS, 2):
                left = (left + self._mix(name, n, step, right)) % a
                right = (right + self._mix(name, n, step + 1, left)) % b
            value = left * b + right
            if value < n:
                return value

    def restore(self, name: str, n: int, value: int) -> int:
        """The value that goes to ``value``: who has the key can link pseudonyms back."""
        a = isqrt(n - 1) + 1 if n > 1 else 1
        b = -(-n // a)
        while True:
            left, right = divmod(value, b)
            for step in range(ROUNDS - 2, -1, -2):
                right = (right - self._mix(name, n, step + 1, left)) % b
                left = (left - self._mix(name, n, step, right)) % a
            value = left * b + right
            if value < n:
                return value

    def characters(self, name: str, text: str) -> str:
        """Digits go to digits and letters to letters of their case; others stay."""
        radix = [10 if c in _DIGITS else 26 for c in text if c.isascii() and c.isalnum()]
        number, bound = 0, 1
        for c, r in zip((c for c in text if c.isascii() and c.isalnum()), radix):
            number = number * r + (int(c) if r == 10 else ord(c.lower()) - 97)
            bound *= r
        if not radix:
            return text
        number = self.permute(f"{name}{text_format(text)}", bound, number)
        made = []
        for r in reversed(radix):
            number, d = divmod(number, r)
            made.append(_DIGITS[d] if r == 10 else chr(97 + d))
        fresh = iter(reversed(made))
        out = [next(fresh) if c.isascii() and c.isalnum() else c for c in text]
        return "".join(o.upper() if c.isupper() else o for c, o in zip(text, out))


def text_format(text: str) -> str:
    """Digits as 9 and letters as a."""
    return re.sub(r"[a-z]", "a", re.sub(r"\d", "9", text.lower()))


def luhn_digit(digits: str) -> str:
    """The check digit that follows these digits."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _written_as(pattern: str, characters: str) -> str:
    """The characters in the places of the letters and digits of the pattern."""
    fresh = iter(characters)
    return "".join(next(fresh) if c.isalnum() else c for c in pattern)


def _plain(text: str) -> str:
    return "".join(c for c in text if c.isalnum())


def card(f: Feistel, text: str) -> str | None:
    """Payment cards: 13 to 19 digits with a right check digit."""
    digits = _plain(text)
    body = digits[:-1]
    if not 13 <= len(digits) <= 19 or luhn_digit(body) != digits[-1] or len(set(digits)) == 1:
        return None
    made = f"{f.permute(f'card{len(digits)}', 10 ** len(body), int(body)):0{len(body)}d}"
    return _written_as(text, made + luhn_digit(made))


def iban(f: Feistel, text: str) -> str | None:
    """Bank accounts: the remainder by 97 is right; the country stays."""
    plain = _plain(text).upper()

    def number(s: str) -> int:
        return int("".join(str(int(c, 36)) for c in s))

    if not 15 <= len(plain) <= 34 or number(plain[4:] + plain[:4]) % 97 != 1:
        return None
    body = f.characters("iban" + plain[:2], plain[4:]).upper()
    check = 98 - number(body + plain[:2] + "00") % 97
    return _written_as(text, f"{plain[:2]}{check:02d}{body}")


def ssn(f: Feistel, text: str) -> str | None:
    """Social security numbers with an area, group and serial that can be given out."""
    area, group, serial = int(text[:3]), int(text[4:6]), int(text[7:])
    if area in (0, 666) or area > 899 or not group or not serial:
        return None
    place = area - 1 - (area > 666)
    n = f.permute("ssn", 898 * 99 * 9999, (place * 99 + group - 1) * 9999 + serial - 1)
    rest, serial = divmod(n, 9999)
    place, group = divmod(rest, 99)
    area = place + 1 + (place >= 665)
    return f"{area:03d}{text[3]}{group + 1:02d}{text[6]}{serial + 1:04d}"


def phone(f: Feistel, text: str) -> str | None:
    """Phone numbers of 8 to 15 digits with a country code, or of 10 digits in the usual groups."""
    digits = _plain(text)
    code = re.match(r"\+(\d{1,3})(?=[ .(-])", text)
    keep = len(code[1]) if code else 0
    if text[0] == "+" and not 8 <= len(digits) <= 15:
        return None
    body = digits[keep:]
    made = f"{f.permute(f'phone{digits[:keep]}/{len(body)}', 10 ** len(body), int(body)):0{len(body)}d}"
    return _written_as(text, digits[:keep] + made)


def address(f: Feistel, text: str) -> str | None:
    """IPv4 addresses."""
    parts = [int(p) for p in text.split(".")]
    if any(p > 255 for p in parts) or any(p != str(int(p)) for p in text.split(".")):
        return None
    n = int.from_bytes(bytes(parts))
    return ".".join(map(str, f.permute("ipv4", 1 << 32, n).to_bytes(4)))


def _day(f: Feistel, year: int, month: int, day: int) -> date | None:
    try:
        found = date(year, month, day).toordinal()
    except ValueError:
        return None
    if not _FIRST <= found <= _LAST:
        return None
    return date.fromordinal(_FIRST + f.permute("date", _LAST - _FIRST + 1, found - _FIRST))


def day(f: Feistel, text: str) -> str | None:
    """Dates from 1900 to 2099: year-month-day, day.month.year, or month/day/year."""
    a, b, c = re.split(r"[-./]", text)
    if len(a) == 4:
        made = _day(f, int(a), int(b), int(c))
        return made and f"{made.year:04d}{text[4]}{made.month:02d}{text[7]}{made.day:02d}"
    if "." in text:
        made = _day(f, int(c), int(b), int(a))
        return made and f"{made.day:02d}.{made.month:02d}.{made.year:04d}"
    made = _day(f, int(c), int(a), int(b))
    return made and f"{made.month:02d}/{made.day:02d}/{made.year:04d}"


def mail(f: Feistel, text: str) -> str | None:
    """Mail addresses: what stands before the ``@``."""
    name, _, host = text.partition("@")
    made = f.characters("mail", name)
    return f"{made}@{host}"


def token(f: Feistel, text: str) -> str | None:
    """Hexadecimal tokens of 128 bits or more with letters and digits, as hexadecimal digits."""
    low = text.lower()
    if low.isdigit() or low.isalpha():
        return None
    n = f.permute(f"hex{len(text)}", 16 ** len(text), int(low, 16))
    made = f"{n:0{len(text)}x}"
    return made.upper() if text.isupper() else made


# What a value looks like, and who validates and permutes it; the first that fits is taken. The
# bounds keep a pattern from matching inside a longer number or word.
Kind = tuple[str, str, Callable[[Feistel, str], str | None]]
KINDS: list[Kind] = [
    ("token", r"(?<!\w)[0-9a-fA-F]{32,}(?!\w)", token),
    ("iban", r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)", iban),
    ("date", r"(?<![\w./-])(?:\d{4}([-/.])\d\d\1\d\d|\d\d([./])\d\d\2\d{4})(?=T\d|(?![\w/-]|\.\d))", day),
    ("ssn", r"(?<![\w-])\d{3}([- ])\d\d\1\d{4}(?![\w-])", ssn),
    ("phone", r"(?<![\w+])\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){1,4}(?!\w)", phone),
    ("card", r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?!\w|-\d)", card),
    ("phone", r"(?<!\w)(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\w)", phone),
    ("ipv4", r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)", address),
]
_PATTERNS = [(name, re.compile(pattern, re.ASCII), made) for name, pattern, made in KINDS]
# A mail address is found by its end, and its name by walking back, so that long words cost nothing.
_HOST = re.compile(r"@[A-Za-z0-9][A-Za-z0-9-]*(?:\.[A-Za-z0-9][A-Za-z0-9-]*)+")
Found = tuple[int, int, str, str]


def _mails(text: str, f: Feistel) -> Iterator[Found]:
    for m in _HOST.finditer(text):
        begin = m.start()
        while begin and (text[begin - 1].isalnum() or text[begin - 1] in "._%+-"):
            begin -= 1
        while begin < m.start() and text[begin] in "._%+-":
            begin += 1
        if begin < m.start() and text[m.start() - 1] != ".":
            yield begin, m.end(), "mail", mail(f, text[begin : m.end()])


def found(text: str, f: Feistel) -> list[Found]:
    """Begin, end, kind and pseudonym of each value, without overlaps."""
    taken: list[Found] = list(_mails(text, f)) if "@" in text else []
    for name, pattern, make in _PATTERNS:
        held = sorted(taken)
        starts = [t[0] for t in held]
        for m in pattern.finditer(text):
            k = bisect_left(starts, m.end())
            if k and held[k - 1][1] > m.start():
                continue
            made = make(f, m.group())
            if made is not None:
                taken.append((m.start(), m.end(), name, made))
    return sorted(taken)


def pseudonymized(text: str, f: Feistel) -> tuple[str, list[str]]:
    """The text with its values replaced, and their kinds in order."""
    out, kinds, done = [], [], 0
    for begin, end, name, made in found(text, f):
        out += [text[done:begin], made]
        kinds.append(name)
        done = end
    return "".join([*out, text[done:]]), kinds


def pseudonyms(text: Column, key: bytes) -> Column:
    """A struct of the new ``text`` and the ``kinds`` of its values; null for a null text."""

    @F.pandas_udf("text string, kinds array<string>")
    def made(texts: pd.Series) -> pd.DataFrame:
        f = Feistel(key)
        rows = [(None, []) if t is None else pseudonymized(t, f) for t in texts]
        return pd.DataFrame(rows, columns=["text", "kinds"])

    return made(text)


def pseudonymize(docs: DataFrame, key: bytes) -> DataFrame:
    """``docs`` with the new ``text`` and ``kinds``, the kinds of the values that were replaced.

    All rows and columns are kept; ``kinds`` gets a ``_`` in front where the name is taken. A null
    text stays null. An empty table gives no rows. Texts of any length are read whole.
    """
    if not 1 <= len(key) <= 64:
        raise ValueError("The key must have 1 to 64 bytes")
    kinds, made = free_names(docs, "kinds", "made")
    # Every kind of value has a digit or an at sign; other texts stay on the JVM.
    some = F.when(F.col("text").rlike("[0-9@]"), F.col("text"))
    text = F.coalesce(F.col(made)["text"], F.col("text"))
    return docs.withColumn(made, pseudonyms(some, key)).select(
        *[text.alias(c) if c == "text" else F.col(c) for c in docs.columns],
        F.col(made)["kinds"].alias(kinds),
    )
