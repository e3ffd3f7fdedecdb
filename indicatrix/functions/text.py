"""Column functions for names, lists and free text. All are JVM-side expressions."""

import re

from pyspark.sql import Column, functions as F

# The characters that count as whitespace, non-breaking and other Unicode blanks included.
WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
              "\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
_BLANKS = f"[{WHITESPACE}]+"


def strip(c: Column) -> Column:
    """Remove leading and trailing whitespace of any kind; inner whitespace stays."""
    return F.trim(c, F.lit(WHITESPACE))


def normalise(c: Column) -> Column:
    """Strip and collapse every run of whitespace to one space."""
    return F.trim(F.regexp_replace(c, _BLANKS, " "))


def match_key(c: Column) -> Column:
    """The key under which names are compared: normalised and lower-cased."""
    return F.lower(normalise(c))


def split_list(c: Column, unify_semicolons: bool = True) -> Column:
    """Delimited text to an array of stripped, non-blank elements."""
    text = F.translate(c, ";", ",") if unify_semicolons else c
    return F.filter(F.transform(F.split(text, ","), strip), lambda x: x != "")


def join_list(c: Column, separator: str = ", ") -> Column:
    return F.array_join(c, separator)


def clean_list(c: Column, unwanted) -> Column:
    """Strip each element and drop nulls and the unwanted ones (compared without case)."""
    unwanted = [u.lower() for u in unwanted]
    stripped = F.transform(c, strip)
    return F.filter(stripped, lambda x: x.isNotNull() & ~F.lower(x).isin(unwanted))


def recode_list(c: Column, mapping: dict) -> Column:
    """Replace whole elements by a small dictionary; other elements stay."""
    def recode(x):
        out = x
        for old, new in reversed(list(mapping.items())):
            out = F.when(x == F.lit(old), F.lit(new)).otherwise(out)
        return out
    return F.transform(c, recode)


def replace_in_order(c: Column, replacements: dict) -> Column:
    """Substring replacements applied one after the other, in the given order."""
    for old, new in replacements.items():
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def header_name(name: str, numbered: bool = False) -> str:
    """Tidy one header cell; ``numbered`` also removes a leading digit with the character after it."""
    name = name.replace("\ufeff", "").strip()
    if numbered:
        name = re.sub(r"^\d.", "", name).strip().replace("\n", " ")
    return name
