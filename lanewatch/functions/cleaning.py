"""Column builders for dirty-record cleaning (C2–C21); all native expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lanewatch import constants as K
from lanewatch.functions.columns import col_, let, lookup


def null_tokens(c, tokens=None) -> Column:
    """Exact-match missing-value tokens -> NULL (before any trimming)."""
    c = col_(c)
    return F.when(c.isin(list(tokens or K.NULL_TOKENS)), F.lit(None).cast("string")).otherwise(c)


def date_text(c) -> Column:
    """C5 step 1: trim, Italian month tokens -> English (project once, then parse)."""
    s = F.trim(col_(c).cast("string"))
    for it, en in K.ITALIAN_MONTHS_EN.items():
        s = F.replace(s, F.lit(it), F.lit(en))
    return s


# Rewrites of each accepted numeric shape to "y-M-d H:m:s" (anchored, so a value is
# rewritten by at most one rule and every output has the canonical shape), filed under
# the separators that a value must have for any of them to fit: a value is tried
# against the rules of the first test that it passes.
_CANONICAL = [
    (("/", ":"), [
        (r"^(\d{1,2})/(\d{1,2})/(\d{4}) (\d{1,2}):(\d{1,2})$", "$3-$2-$1 $4:$5:0"),
        (r"^(\d{1,2})/(\d{1,2})/(\d{4}) (\d{1,2}:\d{1,2}:\d{1,2})$", "$3-$2-$1 $4"),
    ]),
    (("/",), [
        (r"^(\d{4})/(\d{1,2})/(\d{1,2})$", "$1-$2-$3 0:0:0"),
        (r"^(\d{1,2})/(\d{1,2})/(\d{4})$", "$3-$2-$1 0:0:0"),
    ]),
    ((".",), [
        (r"^(\d{1,2})\.(\d{1,2})\.(\d{4})$", "$3-$2-$1 0:0:0"),
    ]),
    (("T",), [
        (r"^(\d{4})-(\d{1,2})-(\d{1,2})T(\d{1,2}:\d{1,2}:\d{1,2})$", "$1-$2-$3 $4"),
    ]),
    ((":",), []),  # canonical already, or no date
    (("-",), [
        (r"^(\d{4})-(\d{1,2})-(\d{1,2})$", "$1-$2-$3 0:0:0"),
        (r"^(\d{1,2})-(\d{1,2})-(69|[7-9]\d)$", "19$3-$2-$1 0:0:0"),  # two-digit years 69-99
        (r"^(\d{1,2})-(\d{1,2})-([0-5]\d|6[0-8])$", "20$3-$2-$1 0:0:0"),  # two-digit years 00-68
        (r"^(\d{1,2})-(\d{1,2})-(\d{4})$", "$3-$2-$1 0:0:0"),
    ]),
    ((), [
        (r"^(\d{1,2}) (\d{1,2}) (\d{4})$", "$3-$2-$1 0:0:0"),
    ]),
]
_CANONICAL_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"
_MONTH_NAME_SHAPE = r"^[A-Za-z]{3} \d{1,2} \d{4}$"


def canonical_date_text(s) -> Column:
    """C5 step 2: rewrite the value's shape to the canonical y-M-d H:m:s layout."""
    s, out = col_(s), F
    for separators, rules in _CANONICAL:
        canon = reduce(lambda c, rule: F.regexp_replace(c, *rule), rules, s)
        out = out.when(reduce(lambda a, b: a & b, [F.contains(s, F.lit(x)) for x in separators]), canon) \
            if separators else out.otherwise(canon)
    return out


def parse_canonical(canon, s) -> Column:
    """C5 step 3: one parse of the canonical text; month-name dates use their own format.
    Shapes are disjoint, so this equals trying the formats in order, without failed attempts."""
    canon, s = col_(canon), col_(s)
    return (F.when(canon.rlike(_CANONICAL_SHAPE), F.try_to_timestamp(canon, F.lit("y-M-d H:m:s")))
             .when(s.rlike(_MONTH_NAME_SHAPE), F.try_to_timestamp(s, F.lit("MMM d yyyy"))))


def parse_date_text(s) -> Column:
    """C5 steps 2-3 on a normalised date string."""
    return let(canonical_date_text(s), lambda canon: parse_canonical(canon, s))


def parse_date(c) -> Column:
    """Trim, Italian month tokens -> English, ordered formats, day-first fallback.

    One expression, each step computed once. It stays out of generated code, where it would make
    the methods of a cleaning projection too long for the JVM to compile.
    """
    return let(date_text(c), parse_date_text)


def extract_number(c) -> Column:
    """C7: '123 pax' -> 123, '~45' -> 45, '1,5' -> 1.5, '20 voli' -> 20, else NULL."""
    s = F.trim(col_(c).cast("string"))
    s = F.replace(s, F.lit(","), F.lit("."))
    for tok in ("~", "pax", "voli"):
        s = F.replace(s, F.lit(tok), F.lit(""))
    return F.trim(s).try_cast("double")


def count_domain(x) -> Column:
    """Negative, non-integer or > 9999 -> NULL."""
    x = col_(x)
    return F.when((x < 0) | (x != F.rint(x)) | (x > 9999), F.lit(None).cast("double")).otherwise(x)


def non_negative(x) -> Column:
    """C9."""
    x = col_(x)
    return F.when(x < 0, F.lit(None).cast("double")).otherwise(x)


def at_most(b, a) -> Column:
    """B if b <= a; a NULL comparand keeps b (comparison with NULL is not 'greater')."""
    b, a = col_(b), col_(a)
    return F.when(b > a, F.lit(None).cast("double")).otherwise(b)


def allowed(c, values) -> Column:
    """C11 / C13-style allowed-set filter."""
    c = col_(c)
    return F.when(c.isin(list(values)), c).otherwise(F.lit(None).cast("string"))


def year_repair(c) -> Column:
    """Known year encodings, then numeric."""
    c = col_(c)
    return F.coalesce(lookup(K.YEAR_REPAIRS, c), c).try_cast("double")


def month_number(c) -> Column:
    """C4: Italian month abbreviation or number -> int."""
    c = col_(c)
    return F.coalesce(lookup(K.ITALIAN_MONTHS, c).cast("string"), c).try_cast("double").cast("int")


def zone(c) -> Column:
    """C11: zone '1'..'9' -> int, else NULL."""
    z = F.trim(col_(c).cast("string"))
    return F.when(z.isin(K.ZONES), z.cast("int"))


def gender(c) -> Column:
    """C14: F / M / NULL ('1', '2' and other codes -> NULL)."""
    v = F.lower(F.trim(col_(c)))
    return (F.when(v.isin(K.FEMALE_VALUES), F.lit("F"))
             .when(v.isin(K.MALE_VALUES), F.lit("M")))


def age_band(c) -> Column:
    """Repair text labels, then keep only valid bands."""
    c = col_(c)
    repaired = F.when(c.isin(list(K.AGE_BAND_REPAIRS)), lookup(K.AGE_BAND_REPAIRS, c)).otherwise(c)
    return allowed(repaired, K.AGE_BANDS)


def airport(c) -> Column:
    """C15."""
    return F.upper(F.trim(col_(c)))


def iso3(c) -> Column:
    """ISO2 -> ISO3 after trim+upper; unknown codes pass through."""
    v = F.upper(F.trim(col_(c)))
    return F.coalesce(lookup(K.ISO2_TO_ISO3, v), v)


def nationality(c) -> Column:
    """C17: C16 then NULL unless three letters."""
    v = iso3(c)
    return F.when(F.length(v) == 3, v)


def route_key(dep, arr) -> Column:
    """Entity key dep-arr; NULL when either side is NULL."""
    return F.concat(F.upper(col_(dep)), F.lit("-"), F.upper(col_(arr)))
