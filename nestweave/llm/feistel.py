"""PII (3): format-preserving Feistel pseudonyms, in built-in functions only.

Candidates are found by one pattern and validated by kind; what is not valid stays as it is. A valid
value is a number pair (a, b) below (A, B), with A * B the number of valid values of its kind, and
some rounds add a keyed hash of one half to the other, modulo its size. That is a permutation of the
valid values: no two get the same pseudonym, equal values get equal ones in every document, and who
has the key can undo it. The pseudonym is written in the format of the original: separators,
brackets and the order of a date stay.

Kinds: card numbers (13 to 19 digits, Luhn; the check digit is computed anew), telephone numbers
(ten digits in a North American way of writing, which alone makes them valid: numbers that no exchange gives out are
personal too; the country code stays), US social security numbers, IPv4 addresses, dates from 1800 to
2199 (2024-02-29, 2024/02/29, 29.02.2024, 02/29/2024), and the local part of mail addresses (letters
stay letters, digits digits; the domain stays).

Defined results: a null or empty text gives an empty text and no findings; rows that repeat a
``doc_id`` or have none are rewritten one by one; a very long text is one row, its findings rewritten one by one; a
candidate that fits several kinds is of the first in the order of KINDS; a local part of more than 64 characters is no
mail address; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestweave.llm.common import texts

ROUNDS = 8
#: Days from 1800-01-01 to 2199-12-31, which are 5411 * 27.
DAYS = 146_097

KINDS = ("email", "date", "ip", "ssn", "phone", "card")

_MAIL = r"[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]++\.)++[A-Za-z]{2,}"
_DATE = r"\d{4}([-/])\d{2}\1\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4}"
_IP = r"\d{1,3}(?:\.\d{1,3}){3}"
_SSN = r"\d{3}-\d{2}-\d{4}"
_PHONE = r"(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}"
_CARD = r"\d(?:[ -]?\d){12,18}"
_SHAPES = dict(zip(KINDS, (_MAIL, _DATE, _IP, _SSN, _PHONE, _CARD), strict=True))

#: One pattern for all candidates; a number may not touch other letters or digits.
CANDIDATE = (
    rf"(?<![A-Za-z0-9._%+-]){_MAIL}"
    rf"|(?<![\w.+/-])(?:{_DATE.replace(chr(92) + '1', '[-/]')}|{_IP}|{_SSN})(?![\w/-]|\.\d)"
    rf"|(?<![\w+]){_PHONE}(?!\w)|(?<!\w){_CARD}(?!\w)"
)


def _long(text: Column) -> Column:
    return text.cast("long")


def _keyed(key: str, *parts: Column) -> Column:
    """A number below 2^60 from a secret key and the parts."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), *[p.cast("string") for p in parts]), 256)
    return _long(F.conv(F.substring(digest, 1, 15), 16, 10))


def permuted(a: Column, b: Column, size_a: Column, size_b: Column, key: str, kind: str) -> Column:
    """(a, b) after ROUNDS rounds as a struct; a permutation of all pairs below the sizes."""

    def turn(s: Column, r: Column) -> Column:
        new_a = F.pmod(s["a"] + _keyed(key, F.lit(kind), r, s["b"]), size_a)
        new_b = F.pmod(s["b"] + _keyed(key, F.lit(kind), r, s["a"]), size_b)
        even = r % 2 == 0
        return F.struct(
            F.when(even, new_a).otherwise(s["a"]).alias("a"), F.when(even, s["b"]).otherwise(new_b).alias("b")
        )

    start = F.struct(_long(a).alias("a"), _long(b).alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def _with(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), lambda x: use(x)), 1)


def _part(text: Column, start: int, length: int) -> Column:
    return F.substring(text, start, length)


def _padded(number: Column, width: Column | int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def _refilled(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced by ``digits`` one after the other."""

    def at(i: Column) -> Column:
        char = F.substring(shape, i, F.lit(1))
        nth = F.length(F.regexp_replace(F.substring(shape, F.lit(1), i), "[^0-9]", ""))
        return F.when(char.rlike("[0-9]"), F.substring(digits, nth, F.lit(1))).otherwise(char)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(shape)), at), "")


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn_digit(payload: Column) -> Column:
    """The check digit that Luhn's rule puts behind ``payload``."""

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(payload, F.length(payload) - i + 1, F.lit(1)).cast("int")
        twice = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 1, twice).otherwise(digit)

    total = F.aggregate(F.sequence(F.lit(1), F.length(payload)), F.lit(0), add)
    return F.pmod(F.lit(10) - total % 10, F.lit(10)).cast("string")


def _card(text: Column, key: str) -> Column:
    def of(digits: Column) -> Column:
        size = F.length(digits) - 1
        payload, half = F.substring(digits, F.lit(1), size), (size / 2).cast("int")
        ten = F.lit(10.0)
        new = permuted(
            F.substring(payload, F.lit(1), half), F.substring(payload, half + 1, size),
            _long(F.pow(ten, half)), _long(F.pow(ten, size - half)), key, "card",
        )
        body = _with(new, lambda s: F.concat(_padded(s["a"], half), _padded(s["b"], size - half)))
        written = _with(body, lambda p: F.concat(p, luhn_digit(p)))
        valid = luhn_digit(payload) == F.substring(digits, size + 1, F.lit(1))
        return F.when(valid, _refilled(text, written)).otherwise(text)

    return _with(_digits(text), of)


def _phone(text: Column, key: str) -> Column:
    def of(digits: Column) -> Column:
        country = F.substring(digits, F.lit(1), F.length(digits) - 10)
        own = F.substring(digits, F.length(digits) - 9, F.lit(10))
        new = permuted(_part(own, 1, 6), _part(own, 7, 4), F.lit(1_000_000), F.lit(10_000), key, "phone")
        number = _with(new, lambda s: F.concat(country, _padded(s["a"], 6), _padded(s["b"], 4)))
        return _refilled(text, number)

    return _with(_digits(text), of)


def _ssn(text: Column, key: str) -> Column:
    area, group, serial = (_long(_part(text, i, n)) for i, n in ((1, 3), (5, 2), (8, 4)))
    nth = area - F.when(area > 666, 2).otherwise(1)
    new = permuted(nth * 99 + group - 1, serial - 1, F.lit(898 * 99), F.lit(9999), key, "ssn")

    def written(s: Column) -> Column:
        n = F.floor(s["a"] / 99)
        return F.concat_ws("-", _padded(n + F.when(n >= 665, 2).otherwise(1), 3), _padded(s["a"] % 99 + 1, 2), _padded(s["b"] + 1, 4))

    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    return F.when(valid, _with(new, written)).otherwise(text)


def _ip(text: Column, key: str) -> Column:
    octets = [_long(F.get(F.split(text, r"\."), F.lit(i))) for i in range(4)]
    new = permuted(octets[0] * 256 + octets[1], octets[2] * 256 + octets[3], F.lit(65536), F.lit(65536), key, "ip")
    written = _with(new, lambda s: F.concat_ws(".", *[x.cast("string") for h in "ab" for x in (F.floor(s[h] / 256), s[h] % 256)]))
    valid = ~text.rlike(r"(^|\.)0\d") & (F.greatest(*octets) < 256)
    return F.when(valid, written).otherwise(text)


def _date(text: Column, key: str) -> Column:
    orders = (  # pattern, places of year, month and day
        (r"^\d{4}", (1, 6, 9)),
        (r"^..\.", (7, 4, 1)),
        (r"^../", (7, 1, 4)),
    )

    def iso(places: tuple[int, int, int]) -> Column:
        y, m, d = places
        return F.concat_ws("-", _part(text, y, 4), _part(text, m, 2), _part(text, d, 2))

    def formatted(places: tuple[int, int, int], day: Column) -> Column:
        y, m, d = places
        pieces = {y: F.date_format(day, "yyyy"), m: F.date_format(day, "MM"), d: F.date_format(day, "dd")}
        last = {y: 4, m: 2, d: 2}
        out = []
        for at in sorted(pieces):
            out += [pieces[at], _part(text, at + last[at], 1)]
        return F.concat(*out[:-1])

    result = text
    for pattern, places in orders:
        day = F.try_to_date(iso(places), "yyyy-MM-dd")
        nth = F.datediff(day, F.lit("1800-01-01").cast("date")).cast("long")
        new = permuted(F.floor(nth / 27), nth % 27, F.lit(5411), F.lit(27), key, "date")
        moved = _with(new, lambda s: F.date_add(F.lit("1800-01-01").cast("date"), (s["a"] * 27 + s["b"]).cast("int")))
        valid = text.rlike(pattern) & F.coalesce((nth >= 0) & (nth < DAYS), F.lit(False))
        written = _with(moved, partial(formatted, places))
        result = F.when(valid, written).otherwise(result)
    return result


def _mail(text: Column, key: str) -> Column:
    """The local part by a Feistel network over its two halves, letter by letter."""
    local, domain = F.substring_index(text, "@", 1), F.substring_index(text, "@", -1)
    half = (F.length(local) / 2).cast("int")

    def shifted(part: Column, stream: Column) -> Column:
        def at(i: Column) -> Column:
            char = F.substring(part, i, F.lit(1))
            by = _long(F.conv(F.substring(stream, i * 2 - 1, F.lit(2)), 16, 10))
            out = char
            for pattern, first, size in (("[0-9]", 48, 10), ("[a-z]", 97, 26), ("[A-Z]", 65, 26)):
                moved = F.chr(F.lit(first) + (F.ascii(char) - first + by) % size)
                out = F.when(char.rlike(pattern), moved).otherwise(out)
            return out

        places = F.when(F.length(part) > 0, F.sequence(F.lit(1), F.length(part)))
        return F.coalesce(F.array_join(F.transform(places, at), ""), F.lit(""))

    def turn(s: Column, r: Column) -> Column:
        def stream(other: Column) -> Column:
            return F.sha2(F.concat_ws("|", F.lit(key), F.lit("mail"), r.cast("string"), other), 512)

        even = r % 2 == 0
        return F.struct(
            F.when(even, shifted(s["a"], stream(s["b"]))).otherwise(s["a"]).alias("a"),
            F.when(even, s["b"]).otherwise(shifted(s["b"], stream(s["a"]))).alias("b"),
        )

    start = F.struct(F.substring(local, F.lit(1), half).alias("a"), F.substring(local, half + 1, F.length(local)).alias("b"))
    new = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)
    return _with(new, lambda s: F.concat(s["a"], s["b"], F.lit("@"), domain))


_PSEUDONYMS = dict(zip(KINDS, (_mail, _date, _ip, _ssn, _phone, _card), strict=True))


def kind_of(value: Column) -> Column:
    """The kind whose form a candidate has."""
    out = F.lit(None).cast("string")
    for kind in reversed(KINDS):
        out = F.when(value.rlike(f"^(?:{_SHAPES[kind]})$"), F.lit(kind)).otherwise(out)
    return out


def pseudonym(value: Column, key: str) -> Column:
    """(kind, value): the pseudonym of a candidate; kind null and the value itself if it isn't valid."""

    def of(kind: Column) -> Column:
        new = value
        for name, function in _PSEUDONYMS.items():
            new = F.when(kind == name, function(value, key)).otherwise(new)
        return F.struct(kind.alias("kind"), new.alias("new"))

    valid = {"card", "phone", "ssn", "ip", "date", "email"}
    named = _with(kind_of(value), of)

    def checked(s: Column) -> Column:
        # A permutation may leave a valid value as it is, which is rare; validity is what counts.
        known = s["kind"].isin(*valid) & (is_valid(value, s["kind"]))
        return F.struct(F.when(known, s["kind"]).alias("kind"), s["new"].alias("new"))

    return _with(named, checked)


def is_valid(value: Column, kind: Column) -> Column:
    """Whether a candidate of a kind is a valid value of it."""
    digits = _digits(value)
    octets = F.transform(F.split(value, r"\."), lambda x: x.try_cast("int"))
    day = F.coalesce(
        F.try_to_date(F.regexp_replace(value, r"^(\d{4}).(\d{2}).(\d{2})$", "$1-$2-$3"), "yyyy-MM-dd"),
        F.try_to_date(F.regexp_replace(value, r"^(\d{2})\.(\d{2})\.(\d{4})$", "$3-$2-$1"), "yyyy-MM-dd"),
        F.try_to_date(F.regexp_replace(value, r"^(\d{2})/(\d{2})/(\d{4})$", "$3-$1-$2"), "yyyy-MM-dd"),
    )
    card = luhn_digit(F.substring(digits, F.lit(1), F.length(digits) - 1)) == F.substring(digits, F.length(digits), F.lit(1))
    return (
        F.when(kind == "email", F.lit(True))
        .when(kind == "date", F.coalesce(F.year(day).between(1800, 2199), F.lit(False)))
        .when(kind == "ip", ~value.rlike(r"(^|\.)0\d") & (F.array_max(octets) < 256))
        .when(kind == "ssn", value.rlike(r"^(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}$"))
        .when(kind == "phone", F.lit(True))
        .when(kind == "card", card)
        .otherwise(F.lit(False))
    )


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """(doc_id, text, n_email, ..., n_card) of every row: the rewritten text and what was replaced."""
    rows = texts(docs).withColumn("found", F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)))
    # Most texts hold nothing and are passed on as they are.
    rows = rows.withColumn("new", F.transform("found", lambda x: pseudonym(x, key)))
    gaps = F.split("text", CANDIDATE, -1)
    pieces = F.flatten(F.transform(gaps, lambda g, i: F.array(g, F.coalesce(F.get(F.col("new"), i)["new"], F.lit("")))))
    text = F.when(F.size("found") == 0, F.col("text")).otherwise(F.array_join(pieces, ""))

    def count(kind: str) -> Column:
        return F.size(F.filter("new", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in KINDS]
    return rows.select("doc_id", text.alias("text"), *counts)
