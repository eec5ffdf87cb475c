"""Text building blocks as Column expressions.

Patterns are Java's; (?U) makes classes and case Unicode-aware.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def stripped(c: Column | str) -> Column:
    """Unicode white space off both ends; null becomes empty."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.regexp_replace(c.cast("string"), r"(?U)^\s+|\s+$", ""), F.lit(""))


def lowered(c: Column | str) -> Column:
    return F.lower(stripped(c))


def null_if_blank(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.trim(c) != "", F.trim(c))


def default_if_blank(c: Column | str, default: str) -> Column:
    return F.coalesce(null_if_blank(c), F.lit(default))


def one_space(c: Column) -> Column:
    return stripped(F.regexp_replace(c, r"(?U)\s+", " "))


def any_of(words: Iterable[str]) -> str:
    """Pattern that finds any of the words as they stand."""
    return "(?:" + "|".join(re.escape(w) for w in words) + ")"


def between_non_words(words: Iterable[str]) -> str:
    return r"(?U)(?:^|\W)" + any_of(words) + r"(?:$|\W)"


def first_label(text: Column, ladder: list[tuple[str, str]], default: str | None = None) -> Column:
    """The label of the first pattern found, in the ladder's order.

    One alternation of all patterns stands before the ladder: most texts match
    none, and finding that out once is several times cheaper than rung by rung.
    """
    out = F.lit(default).cast("string")
    if not ladder:
        return out
    for label, pattern in reversed(ladder):
        out = F.when(text.rlike(pattern), F.lit(label)).otherwise(out)
    gate = "|".join(f"(?:{p})" for _, p in ladder)
    return F.when(text.rlike(gate), out).otherwise(F.lit(default).cast("string"))


def _accents() -> tuple[str, str]:
    """Each accented Latin letter and the ASCII letter it decomposes to."""
    pairs = [("đ", "d"), ("Đ", "D")]
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base = unicodedata.normalize("NFKD", chr(code))[0]
        if base.isascii() and base.isalpha():
            pairs.append((chr(code), base))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


ACCENTED, PLAIN = _accents()


def without_accents(c: Column) -> Column:
    return F.regexp_replace(F.translate(c, ACCENTED, PLAIN), r"\p{Mn}", "")


def numbers(c: Column, pattern: str = r"\d+(?:\.\d+)?") -> Column:
    return F.transform(F.regexp_extract_all(c, F.lit(f"({pattern})"), F.lit(1)), lambda x: x.cast("double"))


def entities(c: Column) -> Column:
    """The common character references, decoded."""
    for name, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        c = F.replace(c, F.lit(name), F.lit(char))
    return c


def without_tags(c: Column) -> Column:
    return one_space(entities(F.regexp_replace(c, "<[^>]*>", " ")))


def url_without_query(c: Column) -> Column:
    return F.regexp_replace(c, r"[?#].*$", "")


def url_id(c: Column, argument: str = "id") -> Column:
    """Trailing digits of the path, else the digits of a query argument."""
    path = F.regexp_extract(url_without_query(c), r"(\d+)(?:\.html?)?/?$", 1)
    given = F.regexp_extract(c, rf"[?&]{re.escape(argument)}=(\d+)", 1)
    return F.when(path != "", path).when(given != "", given)


def cut_to(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


def cleaned_value(c: Column, n: int | None = None) -> Column:
    """NaN and the word "nan" to null; at most `n` characters."""
    c = F.when(~F.lower(c.cast("string")).isin("nan"), c.cast("string"))
    return cut_to(c, n) if n else c
