"""Personal data in texts: patterns propose, checksums confirm, context words move the score.

Everything is expressions on the text inside one projection. Positions come from cutting a text at the
matches of a pattern: the pieces between are as long as the way from match to match. Patterns are
written so that a search takes linear time on any text (possessive runs, starts only at the beginning
of a run), and a text without the character that a kind needs is not searched at all.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlake.llm.common import bind, column, fresh, text_of

# IBAN lengths of all registered countries.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27,
    "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DJ": 27, "DK": 18, "DO": 28,
    "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FK": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23,
    "GL": 18, "GR": 27, "GT": 28, "HN": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26,
    "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21,
    "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28,
    "NL": 18, "NO": 15, "OM": 23, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22,
    "RU": 33, "SA": 24, "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "SO": 23, "ST": 25,
    "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20, "YE": 30,
}
ACCEPTED = 0.5
NEAR = 40
STRIDE = 64
SPAN = "array<struct<kind:string,start:int,end:int,score:double>>"


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """The checksum of card numbers."""

    def add(total: Column, i: Column) -> Column:
        x = F.substr(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, x).otherwise(2 * x - F.when(x > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def mod_97(account: Column) -> Column:
    """The checksum of IBANs: the first four characters to the end, letters as 10 to 35, one modulo 97."""
    moved = F.concat(F.substr(account, F.lit(5)), F.substr(account, F.lit(1), F.lit(4)))

    def add(total: Column, i: Column) -> Column:
        code = F.ascii(F.substr(moved, i, F.lit(1)))
        return F.when(code < 65, (total * 10 + code - 48) % 97).otherwise((total * 100 + code - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), add) == 1


def _card(m: Column) -> Column:
    return bind(digits_of(m), lambda d: F.when(F.length(d).between(16, 19), luhn(d)).otherwise(F.lit(False)))


_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2}|)"


def _ip(m: Column) -> Column:
    return m.rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$")


def _phone(m: Column) -> Column:
    return F.length(digits_of(m)).between(8, 15)


def _iban(m: Column) -> Column:
    lengths = F.create_map(*[F.lit(x) for pair in IBAN_LENGTHS.items() for x in pair])
    return bind(
        F.replace(m, F.lit(" ")),
        lambda a: F.when(F.try_element_at(lengths, F.substr(a, F.lit(1), F.lit(2))) == F.length(a), mod_97(a)).otherwise(F.lit(False)),
    )


def _any(m: Column) -> Column:
    return F.lit(True)


@dataclass(frozen=True)
class Kind:
    """``needs``: a cheap pattern every text with a match fulfils; ``prior``: the score of a confirmed
    match; ``context``: words before it that add ``gain``. Base kinds stay whatever their score.

    With ``head``, a pattern takes that many characters of the text and has the whole match, looked
    ahead at, as its group: a match that is not confirmed then hides none that begins within it."""

    name: str
    pattern: str
    needs: str
    confirms: Callable[[Column], Column] = field(default=_any)
    prior: float = 0.3
    context: str = ""
    gain: float = 0.3
    base: bool = False
    head: int = 0


_LOCAL = "A-Za-z0-9._%+-"
BASE = (
    # A match starts at the beginning of a run or right after the match before: all starts within a
    # run stand or fall together.
    Kind("email", rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", _any, 0.9, "e-?mail|contact|write", 0.1, True),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", r"[0-9]\.[0-9]", _ip, 0.5, "ip|host|server|address", 0.3, True),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", "[0-9]{2}|[0-9][ -][0-9]", _card, 0.8, "card|visa|credit|karte|carte|tarjeta", 0.2, True),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", _phone, 0.7, "phone|tel|call|fax|mobile", 0.2, True),
)
# The number of characters follows from the country, so that a word after the account is not taken with it.
_IBANS = "|".join(
    rf"(?:{'|'.join(c for c, n in IBAN_LENGTHS.items() if n == length)})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{length - 4}}}"
    for length in sorted(set(IBAN_LENGTHS.values()))
)
MORE = (
    Kind("iban", rf"(?<![A-Za-z0-9])(?=((?:{_IBANS})(?![A-Za-z0-9])))[A-Z]{{2}}[0-9]{{2}}", "[A-Z]{2}[0-9]{2}", _iban, 0.8, "iban|account|konto|compte|cuenta", 0.2, head=4),
    Kind("ssn", r"(?<![0-9])(?<![0-9][ -])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![ -]?[0-9])", "[0-9]{3}-[0-9]{2}-", _any, 0.3, "ssn|social security", 0.4),
    Kind("local_phone", r"(?<![0-9+])(?<!\+[0-9]{1,3}[\x20.-])(?<![0-9][\x20-])(?:\([0-9]{3}\)|(?<!\()[0-9]{3})[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![\x20-]?[0-9])", "[0-9]{3}[ .-][0-9]{4}", _any, 0.3, "phone|telephone|tel|call|fax|mobile", 0.3),
)


def running_sums(lengths: Column) -> Column:
    """Inclusive running sums of an array in log2(n) passes."""
    passes = F.sequence(F.lit(0), F.ceil(F.log2(F.size(lengths) + 1)).cast("int"))

    def double(sums: Column, k: Column) -> Column:
        back = F.lit(2).cast("int")
        step = F.pow(back, k).cast("int")
        return F.transform(sums, lambda x, i: x + F.coalesce(F.get(sums, i - step), F.lit(0)))

    return F.aggregate(passes, lengths, double)


def _located(text: Column, kind: Kind) -> Column:
    """All matches of a kind with their places, confirmed and scored."""
    pattern = F.lit(kind.pattern if kind.head else f"({kind.pattern})")
    found = F.regexp_extract_all(text, pattern, F.lit(1))

    def taken(m: Column) -> Column:
        return F.lit(kind.head) if kind.head else F.length(m)

    between = F.split(text, kind.pattern, -1)
    steps = F.zip_with(found, F.slice(between, F.lit(1), F.size(found)), lambda m, gap: taken(m) + F.length(gap))

    def with_ends(pair: Column) -> Column:
        return F.transform(
            pair["found"],
            lambda m, i: F.struct(
                m.alias("match"), (F.get(pair["ends"], i) - taken(m)).alias("start"),
                (F.get(pair["ends"], i) - taken(m) + F.length(m)).alias("end"),
            ),
        )

    none = F.array().cast(SPAN)

    def scored(s: Column, strides: Column) -> Column:
        # Two strides hold the characters before a match: no search through the text per match.
        begin = F.greatest(s["start"] - NEAR, F.lit(0))
        first = F.floor(begin / STRIDE).cast("int")
        around = F.concat(F.coalesce(F.get(strides, first), F.lit("")), F.coalesce(F.get(strides, first + 1), F.lit("")))
        near = F.lower(F.substr(around, begin - first * STRIDE + 1, s["start"] - begin))
        bonus = F.when(near.rlike(rf"\b(?:{kind.context})\b"), F.lit(kind.gain)).otherwise(F.lit(0.0))
        return F.struct(
            F.lit(kind.name).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
            (F.lit(kind.prior) + bonus).alias("score"),
        )

    def with_scores(confirmed: Column) -> Column:
        strides = F.regexp_extract_all(text, F.lit(f"(?s)(.{{1,{STRIDE}}})"), F.lit(1))
        return F.when(F.size(confirmed) == 0, none).otherwise(
            bind(strides, lambda cut: F.transform(confirmed, lambda s: scored(s, cut)))
        )

    placed = bind(F.struct(found.alias("found"), running_sums(steps).alias("ends")), with_ends)
    confirmed = bind(F.filter(placed, lambda s: kind.confirms(s["match"])), with_scores)
    accepted = confirmed if kind.base else F.filter(confirmed, lambda s: s["score"] > ACCEPTED)
    # The test with the whole pattern stops at the first match; most texts have none.
    return F.when(text.rlike(kind.needs), F.when(text.rlike(kind.pattern), accepted).otherwise(none)).otherwise(none)


def find_personal_data(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``base_spans`` and ``spans``: arrays of (kind, start, end, score).

    Places count code points, the end is exclusive. Spans come by kind (email, ip, card, phone, then
    iban, ssn, local_phone), then by place. The base kinds are leftmost matches that do not overlap,
    less those whose check fails; iban needs its country's length, with at most one space between two
    characters, and its checksum (two that overlap are both given); ssn and local_phone need a
    context word at most 40 characters before. Null and empty texts have none; repeated rows get the
    same spans each; if ``docs`` has columns of these names, the new ones end in an underscore. An empty
    table gives an empty one. A very long text takes time in proportion to its length and, by a
    logarithm more, to its matches.
    """
    base_name, all_name, text_name = fresh(docs, "base_spans", "spans", "pii_text")
    kept = [column(docs, c) for c in docs.columns]
    base = docs.select(*kept, text_of(column(docs, text_col)).alias(text_name))
    found = base.select(*[column(base, c) for c in base.columns], F.concat(*[_located(column(base, text_name), k) for k in BASE]).alias(base_name))
    return found.select(
        *[column(found, c) for c in docs.columns], column(found, base_name),
        F.concat(column(found, base_name), *[_located(column(found, text_name), k) for k in MORE]).alias(all_name),
    )


def spans_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
