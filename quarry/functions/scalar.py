"""Column helpers (all built-in expressions: they stay inside whole-stage codegen)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions._util import col

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference for equal results.
# Review cleaning: the two character classes replaced by a space, in the
# order applied, and the token separators (space, double quote, comma,
# parentheses, asterisk; tab and newline are not separators).
REVIEW_PUNCT_CLASS = r"[@'\^!?,.]"
REVIEW_DIGIT_CLASS = r"[0-9%\-?+/&:~<>=]"
TOKEN_SEPARATORS = r'[ ",()*]+'
# Age-band labels. Upper-inclusive bands (<=18, <=35, <=50, >50):
AGE_LABELS_RIGHT = ("0-18", "18-35", "35-50", "50+")
# Lower-inclusive bands (<18, <35, <50, >=50), labels spelled as recorded:
AGE_LABELS_LEFT = ("0 - 18", "18 - 35", "35 -50", "50+")
AGE_EDGES = (18, 35, 50)
# ---------------------------------------------------------------------------

# Characters up to U+0020, the set a Java `String.trim` removes.
JAVA_TRIM_CHARS = "".join(chr(i) for i in range(0x21))
# A plain decimal number: what the text parsers accept as a number.
_PLAIN_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)\s*$"


def java_trim(c: Column | str) -> Column:
    """Strip every control character and space at both ends (Java `trim`)."""
    return F.trim(col(c), F.lit(JAVA_TRIM_CHARS))


def normalize_label(c: Column | str) -> Column:
    """`LOWER(TRIM(x))` as used to compare labels."""
    return F.lower(java_trim(c))


def _fused_token_class() -> str:
    """One character class equal to: blank the two cleaning classes, then
    split on the separators. Every blanked character becomes a space, and a
    space is a separator, so splitting once on the union gives the same
    tokens as the three passes, with one regex scan instead of three."""
    members = REVIEW_PUNCT_CLASS[1:-1] + REVIEW_DIGIT_CLASS[1:-1] + TOKEN_SEPARATORS[1:-2]
    return "[" + members + "]+"


REVIEW_TOKEN_SPLIT = _fused_token_class()


def review_tokens(c: Column | str) -> Column:
    """Tokens of a review: lower-case, cleaned, split (empty pieces remain;
    filter them after exploding)."""
    return F.split(F.lower(col(c)), REVIEW_TOKEN_SPLIT)


def split_list(c: Column | str, sep: str = "|", trim: bool = True, trailing_empty: bool = True) -> Column:
    """A delimited list in one string as an array (`a|b|c`). Empty items after
    the last non-empty one are items too, or (`trailing_empty=False`) dropped;
    a text of separators alone then has no items, an empty text still has one."""
    pattern = "[" + sep.replace("\\", "\\\\").replace("]", "\\]").replace("^", "\\^") + "]"
    text = col(c)
    parts = F.split(text, pattern)
    if not trailing_empty:
        kept = F.regexp_replace(text, pattern + "+$", "")
        parts = F.when((kept == "") & (text != ""), F.array().cast("array<string>")).otherwise(F.split(kept, pattern))
    return F.transform(parts, lambda x: java_trim(x)) if trim else parts


def age_band(
    age: Column | str,
    closed: str = "right",
    labels: Sequence[str] | None = None,
    edges: Sequence[int] = AGE_EDGES,
) -> Column:
    """Band an age. closed='right': upper edge inclusive (<=18, <=35, ...);
    closed='left': lower edge inclusive (<18, <35, ...). Null age -> null."""
    if closed not in ("right", "left"):
        raise ValueError("closed must be 'right' or 'left'")
    if labels is None:
        labels = AGE_LABELS_RIGHT if closed == "right" else AGE_LABELS_LEFT
    if len(labels) != len(edges) + 1:
        raise ValueError("need one label more than edges")
    a = col(age)
    expr = None
    for edge, label in zip(edges, labels):
        cond = a <= edge if closed == "right" else a < edge
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return F.when(a.isNull(), F.lit(None).cast("string")).otherwise(expr.otherwise(labels[-1]))


def parse_int(c: Column | str, on_bad: str = "null") -> Column:
    """String -> int. on_bad='null': unparsable gives null (`try_cast`);
    on_bad='fail': ANSI cast, the query fails on the first bad value."""
    if on_bad == "fail":
        return col(c).cast("int")
    return col(c).try_cast("int")


def parse_double(c: Column | str, on_bad: str = "null") -> Column:
    """String -> double accepting plain decimal spellings only (no `1e3`,
    `NaN`, `4d`). on_bad='fail' raises on anything else."""
    x = col(c)
    if on_bad == "fail":
        return F.when(x.rlike(_PLAIN_NUMBER) | x.isNull(), x.cast("double")).otherwise(
            F.raise_error(F.concat(F.lit("not a number: "), x))
        )
    return F.when(x.rlike(_PLAIN_NUMBER), x.try_cast("double"))


def round_half_up(c: Column | str, digits: int = 2) -> Column:
    """Half-up rounding on the shortest decimal form (Java `%.2f` digits)."""
    return F.round(col(c), digits)


def round_python(c: Column | str, digits: int = 2) -> Column:
    """Python's `round(x, digits)` of a double: the exact binary value is rounded
    to the nearest decimal, an exact tie to the even one (0.125 -> 0.12,
    2.675 -> 2.67, since the double nearest to 2.675 is below it).

    All in whole numbers: x = m / 2^s with m below 2^55, so 10^digits * m is a
    long; its quotient by 2^s and the remainder decide, and the quotient over
    10^digits is the double nearest to that decimal. Null, NaN and infinities
    stay, and so does a double that lies further from its neighbours than the
    step of the last digit (from 2^46 on with two digits)."""
    if digits not in (0, 1, 2):
        raise ValueError("digits must be 0, 1 or 2")
    x = col(c).cast("double")
    scale, size = 10**digits, F.abs(x)
    # log2 may be one off at a power of two; m keeps a bit to spare both ways
    shift = F.lit(53) - F.floor(F.log2(size)).cast("int")
    unit = _two_to(shift)
    m = (size * unit.cast("double")).cast("bigint")
    whole = _shifted_right(m * F.lit(scale), shift)
    rest = m * F.lit(scale) - whole * unit
    half = _two_to(shift - 1)
    up = (rest > half) | ((rest == half) & (whole % 2 == 1))
    rounded = (whole + up.cast("bigint")).cast("double") / F.lit(float(scale))
    # below 2^-8 all is nearer to zero than to half a step of the last digit
    value = F.when(size < F.lit(2.0**-8), F.lit(0.0)).otherwise(rounded)
    signed = F.when((x < 0) | (F.signum(x) < 0), -value).otherwise(value)
    plain = x.isNull() | F.isnan(x) | (size >= F.lit(2.0 ** (52 - 3 * digits)))
    return F.when(plain, x).when(size == 0, x).otherwise(signed)


def _two_to(n: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), n)


def _shifted_right(x: Column, n: Column) -> Column:
    return F.call_function("shiftright", x, n)


ROUNDINGS = {"half_up": round_half_up, "python": round_python}


def rounded(c: Column | str, digits: int = 2, rounding: str = "half_up") -> Column:
    """`round_half_up` or `round_python`, by name."""
    if rounding not in ROUNDINGS:
        raise ValueError(f"rounding must be one of {', '.join(ROUNDINGS)}")
    return ROUNDINGS[rounding](c, digits)


def money_to_double(c: Column | str, digits: int = 2) -> Column:
    """Round an exact decimal sum and hand it out as double."""
    return F.round(col(c), digits).cast("double")


def epoch_utc_year(c: Column | str) -> Column:
    """Year (UTC) of epoch seconds, independent of the session time zone."""
    return F.year(F.date_from_unix_date(F.floor(col(c) / 86400).cast("int"))).cast("bigint")


def to_epoch_seconds(c: Column | str) -> Column:
    """timestamp_ntz -> epoch seconds (UTC wall clock), session-zone free."""
    x = col(c)
    day = F.unix_date(F.to_date(x)).cast("bigint")
    secs = F.hour(x) * 3600 + F.minute(x) * 60 + F.floor(F.second(x))
    return day * 86400 + secs


def year_range(c: Column | str, year: int) -> Column:
    """`year(ts) == y` written as a range so parquet row groups can be skipped."""
    x = col(c)
    return (x >= F.make_date(F.lit(year), F.lit(1), F.lit(1))) & (
        x < F.make_date(F.lit(year + 1), F.lit(1), F.lit(1))
    )


def days_between(end: Column | str, start: Column | str) -> Column:
    """Whole days from start to end, both truncated to dates."""
    return F.datediff(col(end).cast("date"), col(start).cast("date")).cast("bigint")


def fmt2(c: Column | str, digits: int = 2) -> Column:
    """Fixed-point text with `digits` decimals (`%.2f`)."""
    return F.format_string(f"%.{digits}f", col(c))


def pad_right(c: Column | str, width: int) -> Column:
    """Left-justify to `width` characters without ever truncating (`{:<n}`)."""
    x = col(c).cast("string")
    return F.rpad(x, F.greatest(F.length(x), F.lit(width)), " ")


def bag_to_string(arr: Column | str, fields: Sequence[str]) -> Column:
    """Render an array of structs as a bag: `{(a,1),(b,2)}`; null/empty -> `{}`."""

    def render(x: Column) -> Column:
        items = [x[f].cast("string") for f in fields]
        inner = [items[0]]
        for item in items[1:]:
            inner += [F.lit(","), item]
        return F.concat(F.lit("("), *inner, F.lit(")"))

    body = F.array_join(F.transform(F.coalesce(col(arr), F.array()), render), ",")
    return F.concat(F.lit("{"), body, F.lit("}"))
