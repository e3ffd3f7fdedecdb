"""Column functions for values, dates and null-aware comparisons."""

from pyspark.sql import Column, functions as F


def differs(c: Column, value) -> Column:
    """Inequality that keeps nulls, unlike SQL's ``<>``."""
    return ~c.eqNullSafe(F.lit(value))


def not_in(c: Column, values) -> Column:
    """Negated membership that keeps nulls."""
    return F.coalesce(~c.isin(list(values)), F.lit(True))


def is_quantitative(value: Column, numeric: str = "digits") -> Column:
    """True for texts made of digits only; ``numeric='any'`` accepts whatever casts to a number."""
    text = value.cast("string")
    if numeric == "digits":
        return F.coalesce(text.rlike(r"^[0-9]+\z"), F.lit(False))
    if numeric == "any":
        return text.try_cast("double").isNotNull()
    raise ValueError(f"numeric must be 'digits' or 'any', not {numeric!r}")


def yes_no(value: Column, when: Column) -> Column:
    """Turn boolean text into Yes / No on the rows where ``when`` holds."""
    text = F.lower(value)
    return (F.when(when & (text == "true"), F.lit("Yes"))
            .when(when & (text == "false"), F.lit("No"))
            .otherwise(value))


def rounded_percentage(part: Column, whole: Column) -> Column:
    """100 x the half-even rounded ratio: rounding comes before scaling. A zero denominator gives null."""
    return F.lit(100.0) * F.bround(F.try_divide(part.cast("double"), whole.cast("double")), 0)


def timestamp_or_null(c: Column, sentinel: str = None, pattern: str = "yyyy-MM-dd'T'HH:mm:ss'Z'") -> Column:
    """Parse a fixed-format timestamp text after turning the sentinel into null; bad text raises."""
    text = F.nullif(c, F.lit(sentinel)) if sentinel is not None else c
    return F.to_timestamp_ntz(text, F.lit(pattern))


def strict_number(c: Column) -> Column:
    """Text to INT the strict way: non-numeric text raises, ``2011.0`` is accepted."""
    return c.cast("double").cast("int")


def year_of(as_of=None) -> Column:
    """The current year, or the year of ``as_of`` ('yyyy-MM-dd') to make runs repeatable."""
    return F.year(F.current_date() if as_of is None else F.to_date(F.lit(str(as_of))))


def as_text(value: Column, kind) -> Column:
    """Text of a value of the given type. Floating-point numbers are written in full, without an exponent and with one
    zero after the point at least, wherever that is exact; other types are cast."""
    if kind.typeName() not in ("double", "float"):
        return value.cast("string")
    number = value.cast("string").cast("double")
    exact = number.try_cast("decimal(38,17)")
    written = F.regexp_replace(exact.cast("string"), r"(\.\d+?)0+$", "$1")
    return F.when(F.coalesce(exact.cast("double") == number, F.lit(False)), written).otherwise(value.cast("string"))
