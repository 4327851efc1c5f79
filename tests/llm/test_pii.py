"""Pseudonyms: permutations, formats, links between documents, odd rows."""

from __future__ import annotations

import re
from datetime import date

import pytest
from conftest_llm import SF
from hypothesis import given, settings
from hypothesis import strategies as st

from textpipe.llm import pii
from textpipe.llm.pii import Feistel, luhn_digit, pseudonymized
from textpipe.llm.queries import QUERIES

F1, F2 = Feistel(b"one key"), Feistel(b"another key")


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000])
def test_a_permutation(n):
    images = [F1.permute("x", n, v) for v in range(n)]
    assert sorted(images) == list(range(n))
    assert [F1.restore("x", n, v) for v in images] == list(range(n))
    if n >= 97:
        assert images != [F2.permute("x", n, v) for v in range(n)]
        assert images != [F1.permute("y", n, v) for v in range(n)]


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 10**18), st.data())
def test_restored(n, data):
    v = data.draw(st.integers(0, n - 1))
    assert F1.restore("x", n, F1.permute("x", n, v)) == v


def only(text: str, kind: str) -> str:
    new, kinds = pseudonymized(f"before {text}, after", F1)
    assert kinds == [kind] and new.startswith("before ") and new.endswith(", after")
    made = new[7:-7]
    assert made != text and pii.text_format(made) == pii.text_format(text) or kind in ("ipv4", "token")
    return made


@settings(max_examples=100, deadline=None)
@given(st.text("0123456789", min_size=12, max_size=18).filter(lambda s: len(set(s)) > 1))
def test_cards(body):
    number = body + luhn_digit(body)
    new, kinds = pseudonymized(f"card {number}", F1)
    if kinds == ["card"]:
        made = new[5:]
        assert len(made) == len(number) and luhn_digit(made[:-1]) == made[-1]
    wrong = body + str((int(luhn_digit(body)) + 1) % 10)
    assert "card" not in pseudonymized(f"card {wrong}", F1)[1]


def test_separators_do_not_break_links():
    plain, spaced, dashed = (only(c, "card") for c in ("4111111111111111", "4111 1111 1111 1111", "4111-1111-1111-1111"))
    assert plain == spaced.replace(" ", "") == dashed.replace("-", "")
    a, b, c = only("1984-02-29", "date"), only("29.02.1984", "date"), only("02/29/1984", "date")
    y, m, d = a.split("-")
    assert b == f"{d}.{m}.{y}" and c == f"{m}/{d}/{y}"
    assert date.fromisoformat(a)


def test_formats_stay_valid():
    for number in ("DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"):
        made = only(number, "iban").replace(" ", "")
        assert made[:2] == number[:2] and int("".join(str(int(c, 36)) for c in made[4:] + made[:4])) % 97 == 1
    made = only("123-45-6789", "ssn")
    assert made[:3] not in ("000", "666") and made[:3] < "900" and made[4:6] != "00" and made[7:] != "0000"
    assert only("+1 (017) 555-7713", "phone").startswith("+1 (")
    only("(212) 555-0199", "phone")
    made = only("233.254.104.120", "ipv4")
    assert all(0 <= int(p) <= 255 and p == str(int(p)) for p in made.split("."))
    assert only("jo.Doe.84@mail4.example.com", "mail").endswith("@mail4.example.com")
    made = only("08813ad77930c5f691325605b62c9dfd1b40aaaa", "token")
    assert re.fullmatch("[0-9a-f]{40}", made)


@pytest.mark.parametrize(
    "text",
    ["4111111111111112", "1983-02-29", "31/12/1999", "256.1.1.1", "01.2.3.4", "1.2.3.4.5", "000-12-3456", "666-12-3456",
     "version 3.0.1", "12345", "1900000000001", "DE00 3704 0044 0532 0130 00", "x@y", "a@b@c", "@example.com", "2024-13-01",
     "ISBN 978-3-16-148410-0 is no card", "a1111111111111117b"],
)
def test_invalid_values_stay(text):
    assert pseudonymized(text, F1) == (text, [])


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op9_pii"](spark, SF).collect()}
    assert got.keys() == docs.keys()
    from textpipe.llm.queries import PII_KEY

    f = Feistel(PII_KEY)
    assert all((got[i].text, got[i].kinds or []) == pseudonymized(t, f) for i, t in docs.items())
    kinds = {k for r in got.values() for k in r.kinds or []}
    assert kinds == {"mail", "phone", "ipv4", "card", "token"}
    for i, text in docs.items():
        for m in re.finditer(r"(?<!\w)\d{16}(?!\w)|\+1 \(\d{3}\) \d{3}-\d{4}|\w+\.\d\d@mail\d\.example\.com", text):
            valid = not m.group().isdigit() or luhn_digit(m.group()[:-1]) == m.group()[-1]
            assert (m.group() in got[i].text) != valid


def test_odd_rows(spark, odd):
    extra = odd.limit(1).selectExpr("doc_id", "'mail me@example.org twice me@example.org' AS text", "'x' AS kinds", "1 AS made")
    got = pii.pseudonymize(extra, b"k")
    assert got.columns == ["doc_id", "text", "kinds", "made", "_kinds"]
    row = got.first()
    assert row._kinds == ["mail", "mail"] and len(set(re.findall(r"\w+@example.org", row.text))) == 1
    same = pii.pseudonymize(odd, b"k")
    assert sorted((r.text or "") for r in same.collect())[:3] == sorted((r.text or "") for r in odd.collect())[:3]
    assert same.count() == odd.count() and same.filter("text is null").count() == 2
    assert pii.pseudonymize(odd.limit(0), b"k").count() == 0
    with pytest.raises(ValueError):
        pii.pseudonymize(odd, b"")
