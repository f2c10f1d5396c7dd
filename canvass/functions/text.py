"""Text expressions for codes, labels and free-text names."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .missing import as_col

# The characters with the Unicode property White_Space.
WHITE_SPACE = (
    "\t\n\x0b\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def trimmed(c: str | Column) -> Column:
    """Without white space at both ends, including no-break and wide spaces."""
    return F.trim(as_col(c), F.lit(WHITE_SPACE))


def without_words(c: str | Column, words: Sequence[str]) -> Column:
    """Remove every given word, ignoring case, then trim the rest."""
    if not words:
        return trimmed(c)
    pattern = "(?iu)" + "|".join(re.escape(w) for w in words)
    return trimmed(F.regexp_replace(as_col(c), pattern, ""))


def plain_code(c: str | Column) -> Column:
    """Exported codes carry three underscores where the form has one."""
    return F.replace(as_col(c), F.lit("___"), F.lit("_"))


def spoken_code(c: str | Column) -> Column:
    """Short display label of a code: andere_person gives Andere Person."""
    return F.initcap(F.translate(as_col(c), "_", " "))


def weekday_name(c: str | Column) -> Column:
    """Weekday of an hours column path, or of a bare weekday code."""
    return F.initcap(F.regexp_replace(as_col(c), r"^(?:.*/)?([^/]+?)_[sS]tunden$", "$1"))


def without_number_suffix(name: str) -> str:
    return re.sub(r"_[0-9]+$", "", name)


def option_of_rule(c: str | Column, default: str = "insgesamt") -> Column:
    """Quoted option code of a skip rule; a question without rule is the overall one."""
    code = F.nullif(F.regexp_extract(as_col(c), "'([^']+)'", 1), F.lit(""))
    return F.coalesce(code, F.lit(default))


def scale_label(c: str | Column, intro: str) -> Column:
    """Ends of a scale from its question text, with one uniform separator."""
    text = F.regexp_replace(as_col(c), intro, "")
    text = F.regexp_replace(text, '[:"]', "")
    text = F.regexp_replace(text, "bis|und", "SEP")
    return F.regexp_replace(text, "von|zwischen", "")


def swap_scale_ends(c: str | Column) -> Column:
    """Trailing (1) and (6) trade places; other labels stay."""
    c = as_col(c)
    return (
        F.when(c.endswith("(1)"), F.regexp_replace(c, r"\(1\)$", "(6)"))
        .when(c.endswith("(6)"), F.regexp_replace(c, r"\(6\)$", "(1)"))
        .otherwise(c)
    )


def dotted_number(c: str | Column) -> Column:
    """Whole number with a dot between thousands."""
    return F.translate(F.format_number(as_col(c), 0), ",", ".")


def comma_percent(c: str | Column, digits: int = 1) -> Column:
    """0.1234 gives 12,3%."""
    rounded = F.bround(as_col(c) * 100, digits)
    return F.concat(F.translate(F.format_string(f"%.{digits}f", rounded), ".", ","), F.lit("%"))


def titled(c: str | Column, titles: Mapping[str, str], default: str | Column | None = None) -> Column:
    """Display title of a key, else the default, else the key itself."""
    c = as_col(c)
    fallback = c if default is None else as_col(default)
    if not titles:
        return fallback
    table = F.create_map(*[F.lit(x) for pair in titles.items() for x in pair])
    return F.coalesce(F.try_element_at(table, c), fallback)
