"""Replacement values as Column expressions.

Every surrogate is a pure function of (key, label, value): the same value always gets the
same surrogate, on any cluster, in batch and in streams, without a lookup table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from maskwright.functions.catalog import FAMILY_NAMES, GIVEN_NAMES, ORGANIZATIONS
from maskwright.functions.spans import let

# sha-256 yields 32 bytes; one byte decides one character of a class-preserving surrogate.
BYTES_PER_DIGEST = 32


def keyed_digest(key: str, label: Column, value: Column) -> Column:
    return F.sha2(F.concat(F.lit(key), F.lit("|"), label, F.lit("|"), value), 256)


def keyed_hash(key: str, label: Column, value: Column) -> Column:
    """60-bit non-negative hash."""
    return F.conv(F.substring(keyed_digest(key, label, value), 1, 15), 16, 10).cast("long")


def canonical(value: Column) -> Column:
    """Form shared by the surface variants of one value (case, spacing, punctuation)."""
    return let(
        F.lower(F.regexp_replace(value, r"[^\p{L}\p{N}]", "")),
        lambda c: F.when(c == "", value).otherwise(c),
    )


def _div(number: Column, by: int) -> Column:
    """Integer division; a double would lose digits of a 60-bit hash."""
    return F.call_function("div", number, F.lit(by))


def _digits(number: Column, width: int) -> Column:
    return F.lpad((number % 10**width).cast("string"), width, "0")


def _from_pool(pool: Sequence[str], h: Column) -> Column:
    names = F.split(F.lit("\n".join(pool)), "\n")
    return F.get(names, (h % len(pool)).cast("int"))


def redaction(label: Column) -> Column:
    return F.concat(F.lit("["), label, F.lit("]"))


def scramble(key: str, label: Column, value: Column) -> Column:
    """Keeps length and the class of every character: digit, lower case, upper case, other."""

    def drawn(first: str, count: int, byte: Column) -> Column:
        made = F.lit([chr(ord(first) + i % count) for i in range(256)])
        return F.get(made, F.ascii(byte))

    def swap(ch: Column, byte: Column) -> Column:
        return (
            F.when(ch.between("0", "9"), drawn("0", 10, byte))
            .when(ch.between("a", "z"), drawn("a", 26, byte))
            .when(ch.between("A", "Z"), drawn("A", 26, byte))
            .otherwise(ch)
        )

    def block(b: Column) -> Column:
        return keyed_digest(key, label, F.concat(value, F.lit("#"), b.cast("string")))

    # Most values have one block.
    digests = F.when(F.length(value) < BYTES_PER_DIGEST, block(F.lit(0))).otherwise(F.array_join(
        F.transform(F.sequence(F.lit(0), _div(F.length(value), BYTES_PER_DIGEST).cast("int")), block), ""))
    # A character per byte, as many as the value has.
    per_byte = F.substring(F.decode(F.unhex(digests), "ISO-8859-1"), F.lit(1), F.length(value))
    return F.when(value == "", value).otherwise(
        F.array_join(F.zip_with(F.split(value, ""), F.split(per_byte, ""), swap), ""))


def email(h: Column) -> Column:
    return F.concat(F.lit("user"), h.cast("string"), F.lit("@example.com"))


def name(label: Column, h: Column) -> Column:
    given = _from_pool(GIVEN_NAMES, h)
    family = _from_pool(FAMILY_NAMES, _div(h, 1000))
    return (
        F.when(label == "NAME_GIVEN", given)
        .when(label == "NAME_FAMILY", family)
        .otherwise(F.concat(given, F.lit(" "), family))
    )


def ssn(h: Column) -> Column:
    """Area numbers of the 9xx range are never issued."""
    return F.concat(
        (h % 100 + 900).cast("string"),
        F.lit("-"),
        _digits(_div(h, 100), 2),
        F.lit("-"),
        _digits(_div(h, 10_000), 4),
    )


def credit_card(h: Column) -> Column:
    """Sixteen digits with a valid check digit."""

    def checked(payload: Column) -> Column:
        total = F.aggregate(
            F.transform(
                F.filter(F.split(payload, ""), lambda c: c != ""),
                lambda c, i: let(
                    c.cast("int") * F.when(i % 2 == 0, 2).otherwise(1),
                    lambda d: F.when(d > 9, d - 9).otherwise(d),
                ),
            ),
            F.lit(0),
            lambda a, d: a + d,
        )
        return F.concat(payload, ((F.lit(10) - total % 10) % 10).cast("string"))

    return let(F.concat(F.lit("4"), _digits(h, 14)), checked)


def phone_number(h: Column) -> Column:
    """Line numbers 555-0100 to 555-0199 are reserved for fiction."""
    return F.concat(
        F.lit("("), (h % 800 + 200).cast("string"), F.lit(") 555-01"), _digits(_div(h, 1000), 2)
    )


def date_time(key: str, label: Column, value: Column, h: Column) -> Column:
    """Shifts an ISO date by up to 30 days either way, and keeps the time after it; anything else
    is scrambled."""
    day = F.substring(value, 1, 10).try_cast("date")
    return F.when(
        day.isNotNull(),
        F.concat(F.date_format(F.date_add(day, (h % 61 - 30).cast("int")), "yyyy-MM-dd"),
                 F.substring(value, F.lit(11), F.length(value))),
    ).otherwise(scramble(key, label, value))


def ip_address(h: Column) -> Column:
    octets = [(_div(h, 256**i) % 256).cast("string") for i in range(3)]
    return F.concat_ws(".", F.lit("10"), *octets)


def url(h: Column) -> Column:
    return F.concat(F.lit("https://example.com/"), h.cast("string"))


def organization(h: Column) -> Column:
    return _from_pool(ORGANIZATIONS, h)


GENERATORS = (
    "Scramble", "Email", "Name", "Ssn", "CreditCard", "PhoneNumber", "DateTime",
    "IpAddress", "Url", "Organization",
)


HASHED_ONCE = ("Email", "CreditCard", "DateTime", "Url", "Organization")


def generate(generator: str, key: str, label: Column, value: Column) -> Column:
    """Surrogate of ``value`` by a named generator."""
    if generator not in GENERATORS:
        raise ValueError(f"unknown generator {generator!r}; known: {', '.join(GENERATORS)}")
    if generator == "Scramble":
        return scramble(key, label, value)
    by_hash = {
        "Email": email,
        "Name": lambda h: name(label, h),
        "Ssn": ssn,
        "CreditCard": credit_card,
        "PhoneNumber": phone_number,
        "DateTime": lambda h: date_time(key, label, value, h),
        "IpAddress": ip_address,
        "Url": url,
        "Organization": organization,
    }[generator]
    h = keyed_hash(key, label, value)
    # A value that is used once needs no name; inside lambdas a name costs as much as the hash.
    return by_hash(h) if generator in HASHED_ONCE else let(h, by_hash)
