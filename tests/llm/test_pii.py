import random
import re
import time

import cases
import pytest

from txlake.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0


def fits(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 8 <= len(digits) <= 15


def base(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if fits(k, m.group())]


def card(rng, n=16):
    body = "".join(rng.choice("0123456789") for _ in range(n - 1))
    return next(body + c for c in "0123456789" if luhn(body + c))


def soup(rng):
    """Texts made of the characters that patterns are about."""
    parts = ["a@b.c", "@", "x.y@z", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "+1 (234) 555-6789", "+", "007", "12-34", " ", "é", "\U0001f600", ".", "-", "_", "%", "a", "9" * 16, "\n"]
    return "".join(rng.choice([*parts, card(rng), card(rng, 19), card(rng)[:8] + " " + card(rng)[8:]]) for _ in range(rng.randint(0, 30)))


def test_base_equals_brute_force(spark):
    rng = random.Random(3)
    rows = cases.documents() + [(1000 + i, soup(rng), None, None, None) for i in range(400)]
    got = pii.find_personal_data(cases.clashing(spark, rows)).collect()
    assert len(got) == len(rows)
    want = sorted(((i, t, base(t)) for i, t, *_ in rows), key=repr)
    assert sorted(((r["doc_id"], r["text"], [(s["kind"], s["start"], s["end"]) for s in r["base_spans_"]]) for r in got), key=repr) == want
    for r in got:
        assert r["spans_"][: len(r["base_spans_"])] == r["base_spans_"]
        assert (r["spans"], r["base_spans"]) == ("keep", "keep")


@pytest.mark.parametrize(
    "text, want",
    [
        ("pay to DE89 3704 0044 0532 0130 00 now", [("iban", 7, 34)]),
        ("pay to DE89 3704 0044 0532 0130 01 now", []),
        ("GB82WEST12345698765432", [("iban", 0, 22)]),
        ("ES91 2100 0418 4502 0005 1332 BIC CAIXESBB", [("iban", 0, 29)]),
        ("to PL61 1090 1014 0000 0712 1981 2874 USD", [("iban", 3, 37)]),
        ("é BE68 5390 0754 7034 EUR 12, BE68539007547034 A", [("iban", 2, 21), ("iban", 30, 46)]),
        ("NO93 8601 11 17947 NOK", [("iban", 0, 18)]),
        ("code BE12 DE89 3704 0044 0532 0130 00", [("iban", 10, 37)]),
        ("BE68 5390 0754 7034X", []),
        ("ssn 123-45-6789", [("ssn", 4, 15)]),
        ("part 123-45-6789", []),
        ("call (555) 123-4567 today", [("local_phone", 5, 19)]),
        ("no. 555 123 4567 today", []),
        ("call +1 (555) 123-4567 today", [("phone", 5, 22)]),
    ],
)
def test_more_kinds(spark, text, want):
    got = pii.find_personal_data(cases.frame(spark, [(1, text, None, None, None)])).first()
    assert [(s["kind"], s["start"], s["end"]) for s in got["spans"]] == want


def test_accounts_of_many_countries(spark):
    """Examples of the registry, written together, in fours and before a word in capitals."""
    accounts = (
        "TR330006100519786457841326 SA0380000000608010167519 AE070331234567890123456 IL620108000000099999999 BR1800360305000010009795493C1 "
        "PK36SCBL0000001123456702 AT611904300234573201 CY17002001280000001200527600 CZ6508000000192000145399 HU42117730161111101800000000 "
        "SE4550000000058398257466 SK3112000000198742637541 RO49AAAA1B31007593840000 LC55HEMM000100010012001200023015 NO9386011117947 MT84MALT011000012345MTLCAST001S"
    ).split()
    rows = []
    for a in accounts:
        fours = " ".join(re.findall(".{1,4}", a))
        rows += [(len(rows), t, None, None, None) for t in (a, fours, f"{fours} USD", f"{a} A1 {fours} BIC")]
    want = {i: [m.span() for m in re.finditer("|".join(f"{a}|{' '.join(re.findall('.{1,4}', a))}" for a in accounts), r[1])] for i, r in enumerate(rows)}
    rows = [(i, *r[1:]) for i, r in enumerate(rows)]
    got = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"] if s["kind"] == "iban"] for r in pii.find_personal_data(cases.frame(spark, rows)).collect()}
    assert got == want
    assert {len(v) for v in want.values()} == {1, 2}


def test_context_moves_the_score(spark):
    rows = [(1, "card 4111111111111111", None, None, None), (2, "form 4111111111111111", None, None, None)]
    got = {r["doc_id"]: r["spans"][0]["score"] for r in pii.find_personal_data(cases.frame(spark, rows)).collect()}
    assert got[1] > got[2] > 0.5


def test_many_matches_and_long_runs(spark):
    texts = ["a@b.cc " * 5000, "9" * 100_000, "a" * 100_000 + "@", "1." * 50_000, "+" * 50_000, "@a." * 30_000, "1 " * 50_000]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["base_spans"]] for r in pii.find_personal_data(cases.frame(spark, rows)).collect()}
    assert len(got[0]) == 5000 and got[0][-1] == ("email", 7 * 4999, 7 * 5000 - 1)
    assert got[2] == got[4] == []


def test_context_from_every_place(spark):
    """Context words at every distance, over borders of strides, after other matches and characters of two units."""
    rng = random.Random(8)
    rows = []
    for i in range(300):
        filler = "".join(rng.choice(["x ", "é", "\U0001f600", "call ", " ssn", "12.5 ", "\n"]) for _ in range(rng.randint(0, 60)))
        rows.append((i, f"{filler} tel{' ' * rng.randint(1, 50)}555 123 4567, {filler}123-45-6789", None, None, None))
    got = {r["doc_id"]: r["spans"] for r in pii.find_personal_data(cases.frame(spark, rows)).collect()}
    words = {"ssn": r"\b(?:ssn|social security)\b", "local_phone": r"\b(?:phone|telephone|tel|call|fax|mobile)\b"}
    for i, text, *_ in rows:
        spans = [s for s in got[i] if s["kind"] in words]
        assert all(re.search(words[s["kind"]], text[max(0, s["start"] - pii.NEAR) : s["start"]].lower()) for s in spans)
        (phone,) = [m.start() for m in re.finditer("555 123 4567", text)]
        near = bool(re.search(words["local_phone"], text[max(0, phone - pii.NEAR) : phone].lower()))
        assert near == any(s["start"] == phone for s in spans)


def test_two_hundred_thousand_matches(spark):
    began = time.monotonic()
    rows = [(1, "a@b.cc " * 200_000, None, None, None), (2, "tel 555 123 4567, " * 50_000, None, None, None)]
    got = {r["doc_id"]: r["n"] for r in pii.find_personal_data(cases.frame(spark, rows)).selectExpr("doc_id", "size(spans) n").collect()}
    assert got == {1: 200_000, 2: 50_000}
    assert time.monotonic() - began < 100


def test_many_heads_of_accounts(spark):
    rows = [(1, "BE12 " * 20_000, None, None, None), (2, "DE89" * 25_000, None, None, None), (3, "BE68 5390 0754 7034 " * 5000, None, None, None)]
    got = {r["doc_id"]: [s["start"] for s in r["spans"] if s["kind"] == "iban"] for r in pii.find_personal_data(cases.frame(spark, rows)).collect()}
    assert got[2] == [] and got[3] == list(range(0, 100_000, 20))


def test_empty_table(spark):
    assert pii.find_personal_data(cases.frame(spark, [])).count() == 0
