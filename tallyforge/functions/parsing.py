"""Amounts, dates and identifiers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyforge.plans.schema import MISSING, SALT

NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
CURRENCY_SIGNS = "[$€£₹¥]"
CURRENCY_CODES = r"(?i)\b(?:USD|EUR|GBP|INR|JPY|CAD|AUD|CHF)\b"
#: Direction values that make an amount negative.
DEBIT = ["DR", "DEBIT", "D", "-"]


def _stripped(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def present(c: Column) -> Column:
    """Null where a CSV reader would see a missing value."""
    return F.when(~c.isin(MISSING), c)


def bind(value: Column, f) -> Column:
    """``f`` of a value that is computed once, however often ``f`` uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def to_number(c: Column) -> Column:
    """A finite double, or null. Words such as inf, NaN or 5d are no numbers."""
    plain = bind(_stripped(c), lambda x: F.when(x.rlike(NUMBER), x).try_cast("double"))
    return bind(plain, lambda x: F.when(F.abs(x) < F.lit(float("inf")), x))


def _decimal_point(signed: Column) -> Column:
    """Of point and comma the later one is the decimal mark; a comma alone is one before exactly two digits."""
    point, comma = F.locate(".", F.reverse(signed)), F.locate(",", F.reverse(signed))  # counted from the end; 0: none
    without = lambda mark: F.replace(signed, F.lit(mark), F.lit(""))
    comma_decimal = ((point > 0) & (comma < point)) | ((point == 0) & signed.rlike(r"^-?\d+,\d{2}$"))
    return F.when(comma == 0, signed).when(comma_decimal, F.replace(without("."), F.lit(","), F.lit("."))).otherwise(without(","))


def amount_text(raw: Column) -> Column:
    """An amount as plain decimal text: no currency, the sign in front, a point as decimal mark; null if blank."""
    bare = _stripped(F.regexp_replace(F.regexp_replace(_stripped(raw), CURRENCY_SIGNS, ""), CURRENCY_CODES, ""))
    accounting = F.regexp_replace(bare, r"^\((.*)\)$", "-$1")
    signed = _stripped(F.regexp_replace(accounting, r"^(.*)-$", "-$1"))
    return bind(signed, lambda x: F.when(F.length(x) > 0, _decimal_point(x)))


def amount(raw: Column, cents: bool = False, direction: Column | None = None) -> Column:
    """A parsed amount; in base units, and signed by the direction if there is one (all but debits are positive)."""
    value = to_number(amount_text(raw))
    if cents:
        value = value / 100.0
    if direction is not None:
        debit = F.coalesce(F.upper(_stripped(direction)).isin(DEBIT), F.lit(False))
        value = F.when(debit, -F.abs(value)).otherwise(F.abs(value))
    return value


TIME = r"([ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?)?$"
ISO = r"^\d{4}-\d{1,2}-\d{1,2}" + TIME
ISO_ZONE = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2}(\.\d+)?)?\s?(Z|[+-]\d{2}:?\d{2})$"
YEAR_FIRST = r"^\d{4}[/.]\d{1,2}[/.]\d{1,2}" + TIME
NUMERIC = r"^\d{1,2}[/.-]\d{1,2}[/.-]\d{4}" + TIME
NUMERIC_SHORT = r"^\d{1,2}[/.-]\d{1,2}[/.-]\d{2}" + TIME
DAY_NAME = r"^\d{1,2}[ -][A-Za-z]{3,9}[ -]\d{4}" + TIME
NAME_DAY = r"^[A-Za-z]{3,9} \d{1,2},? \d{4}" + TIME
CLOCK = "[ H:mm[:ss]]"


def _parsed(c: Column, pattern: str) -> Column:
    return F.try_to_timestamp(c, F.lit(pattern)).cast("timestamp_ntz")


def _full_year(dashed: Column) -> Column:
    """Two-digit years from 69 on are of the last century."""
    year = F.regexp_extract(dashed, r"^\d+-\d+-(\d{2})", 1).try_cast("int")
    century = F.when(year >= 69, "$1-19$2").otherwise("$1-20$2")
    return F.regexp_replace(dashed, F.lit(r"^(\d+-\d+)-(\d{2})"), century)


def _dated(x: Column, day_first: bool) -> Column:
    dashed = F.regexp_replace(F.regexp_replace(F.regexp_replace(x, r"^(\d+)[/.](\d+)[/.](\d+)", "$1-$2-$3"), r"(\d)T(\d)", "$1 $2"), r"(:\d+)\.\d+$", "$1")
    orders = [f"d-M-yyyy{CLOCK}", f"M-d-yyyy{CLOCK}"][:: 1 if day_first else -1]
    either = lambda c: bind(c, lambda y: F.coalesce(*[_parsed(y, p) for p in orders]))
    named = F.initcap(F.regexp_replace(F.translate(x, ",-", "  "), r"\s+|(?<=\d)T(?=\d)", " "))
    name = lambda p: bind(named, lambda y: F.coalesce(*[_parsed(y, q + CLOCK) for q in p]))
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), x.try_cast("timestamp").cast("timestamp_ntz"))
    return (
        F.when(x.rlike(ISO), F.coalesce(x.try_cast("timestamp_ntz"), _parsed(dashed, f"yyyy-M-d{CLOCK}")))
        .when(x.rlike(ISO_ZONE), utc)
        .when(x.rlike(YEAR_FIRST), _parsed(dashed, f"yyyy-M-d{CLOCK}"))
        .when(x.rlike(NUMERIC), either(dashed))
        .when(x.rlike(NUMERIC_SHORT), either(_full_year(dashed)))
        .when(x.rlike(DAY_NAME), name(["d MMM yyyy", "d MMMM yyyy"]))
        .when(x.rlike(NAME_DAY), name(["MMM d yyyy", "MMMM d yyyy"]))
    )


def timestamp(raw: Column, day_first: bool = True) -> Column:
    """A naive timestamp, or null. Each value is parsed by its own layout; values with an offset are brought to UTC,
    numbers alone (epochs, serial dates) are no dates. Of numeric dates the preferred reading is tried first."""
    return bind(F.regexp_replace(_stripped(raw), r"\s+", " "), lambda x: _dated(x, day_first))


_LETTERS = "".join(chr(c) for c in [*range(65, 91), *range(97, 123)])


def mask(raw: Column) -> Column:
    """The layout of a value: each run of digits a 9, each run of letters an a, of white space a space, all else as it is."""
    plain = F.translate(F.regexp_replace(_stripped(raw), r"\s+", " "), "0123456789" + _LETTERS, "9" * 10 + "a" * 52)
    return F.regexp_replace(plain, "(9)9*|(a)a*", "$1$2")


def only_as(raw: Column, day_first: bool) -> Column:
    """Whether a numeric date can be read this way and not the other."""

    def judge(x: Column) -> Column:
        first, second = (F.regexp_extract(x, r"^(\d+)[/.-](\d+)", i).try_cast("int") for i in (1, 2))
        large, small = (first, second) if day_first else (second, first)
        return F.coalesce((x.rlike(NUMERIC) | x.rlike(NUMERIC_SHORT)) & large.between(13, 31) & small.between(1, 12), F.lit(False))

    return bind(_stripped(raw), judge)


def pseudonym(value: Column, salt: str = SALT) -> Column:
    """The first 16 hex digits of the salted SHA-256; null stays null."""
    return F.substring(F.sha2(F.concat(F.lit(salt + ":"), value.cast("string")), 256), 1, 16)


def portable_hash(*parts: Column) -> Column:
    """A number from 0 to 2^32 - 1 that other SQL engines can compute as well."""
    digits = F.substring(F.md5(F.concat_ws("|", *[p.cast("string") for p in parts])), 1, 8)
    return F.conv(digits, 16, 10).cast("bigint")


def money(c: Column) -> Column:
    """Exact to add up in any order."""
    return c.cast("decimal(20,4)")
