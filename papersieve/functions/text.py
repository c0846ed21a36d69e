"""String functions as Column -> Column expressions (no Python in the data path)."""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterable, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as str.strip() and str.split() see it. Spark's trim() only knows
# the space character and Java's \s is ASCII, so the class is spelled out.
SPACE = r"\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE_CHARACTERS = "".join(
    chr(c)
    for low, high in ((0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
                      (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F),
                      (0x3000, 0x3000))
    for c in range(low, high + 1)
)
WORD = r"\p{L}\p{N}_"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(col: Column) -> Column:
    """Trim white space of any kind; looks at the ends of the text only."""
    return F.btrim(col, F.lit(SPACE_CHARACTERS))


def blank_to_null(col: Column) -> Column:
    return F.when(strip(col) != "", col)


def portable_pattern(pattern: str) -> str:
    """Give a search pattern Unicode word boundaries and classes under Java.

    Lines end at \\n only (?d), case folds beyond ASCII (?iu), and \\b \\w \\d \\s
    follow the Unicode categories rather than ASCII.
    """
    boundary = f"(?:(?<=[{WORD}])(?![{WORD}])|(?<![{WORD}])(?=[{WORD}]))"
    classes = {
        r"\b": boundary,
        r"\w": f"[{WORD}]",
        r"\W": f"[^{WORD}]",
        r"\d": r"\p{Nd}",
        r"\s": f"[{SPACE}]",
        r"\S": f"[^{SPACE}]",
    }
    out, inside_class, i = [], False, 0
    while i < len(pattern):
        token = pattern[i : i + 2] if pattern[i] == "\\" else pattern[i]
        if token == "[":
            inside_class = True
        elif token == "]":
            inside_class = False
        if token in classes and not (inside_class and token == r"\b"):
            mapped = classes[token]
            # inside [...] a nested class is legal Java, so the mapping still holds
            out.append(mapped)
        else:
            out.append(token)
        i += len(token)
    return "(?iud)" + "".join(out)


def search(col: Column, pattern: str) -> Column:
    return col.rlike(portable_pattern(pattern))


def search_any(col: Column, patterns: Sequence[str]) -> Column:
    """True if any pattern is found; one alternation, compiled once per task."""
    cleaned = [p.strip() for p in patterns if p and p.strip()]
    if not cleaned:
        return F.lit(False)
    return search(col, "|".join(f"(?:{p})" for p in cleaned))


def literals_pattern(terms: Iterable[str]) -> str:
    """Pattern that is found where any of the terms occurs, as a prefix tree.

    Terms with a common beginning share it, so a position of the text costs a
    few character tests instead of one per term. Existence is all that counts:
    behind a complete term nothing longer is tried.
    """
    heads: dict[str, list[str]] = {}
    for term in terms:
        heads.setdefault(term[:1], []).append(term[1:])
    branches = [
        escape_java(head) + ("" if "" in tails else literals_pattern(tails))
        for head, tails in heads.items()
    ]
    return branches[0] if len(branches) == 1 else f"(?:{'|'.join(branches)})"


def contains_any(col: Column, terms: Sequence[str]) -> Column:
    """True if any term occurs as a plain substring (both sides already folded)."""
    return col.rlike(literals_pattern(terms)) if terms else F.lit(False)


def starts_with_any(col: Column, prefixes: Sequence[str]) -> Column:
    usable = [p for p in prefixes if p]
    return col.rlike("^" + literals_pattern(usable)) if usable else F.lit(False)


def word_count(col: Column) -> Column:
    return F.regexp_count(col, F.lit(f"[^{SPACE}]+"))


def normalize_title(title: Column) -> Column:
    """Lower case; every run of characters that are no word characters is one space.

    Punctuation and white space both end up as a single space, so one pass with
    the complement of the word class does the work of three.
    """
    folded = F.regexp_replace(F.lower(F.coalesce(title, F.lit(""))), f"[^{WORD}]+", " ")
    return F.trim(folded)


def sanitize(col: Column) -> Column:
    """Text safe for a CSV cell: no nulls, no 'nan', no lone carriage return."""
    value = F.coalesce(col.cast("string"), F.lit(""))
    unified = F.replace(F.replace(value, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit(" "))
    return F.when(F.lower(value) == "nan", F.lit("")).otherwise(unified)


def truncate(col: Column, length: int) -> Column:
    return F.substring(sanitize(col), 1, length)


def keyword_hits(text: Column, keywords: Sequence[str]) -> Column:
    """Keywords that stand alone between spaces, in list order and list spelling."""
    usable = [k for k in keywords if k.strip()]
    if not usable:
        return F.array().cast("array<string>")
    listed = F.array(*[F.lit(k) for k in usable])
    return let(
        F.concat(F.lit(" "), F.lower(text), F.lit(" ")),
        lambda padded: F.filter(
            listed,
            lambda k: F.contains(padded, F.concat(F.lit(" "), F.trim(F.lower(k)), F.lit(" "))),
        ),
    )


def one_of(col: Column, domain: Sequence[str]) -> Column:
    """Lower-cased value if it belongs to the domain, else the empty string."""
    value = F.lower(strip(F.coalesce(col, F.lit(""))))
    return F.when(value.isin(*domain), value).otherwise(F.lit(""))


def strip_code_fence(reply: Column) -> Column:
    """Drop a leading ``` or ```json fence and the closing fence."""
    body = strip(reply)
    opened = F.regexp_replace(body, r"^```(?:(?i)json)?\s*", "")
    closed = F.regexp_replace(opened, r"\s*```$", "")
    return strip(F.when(F.startswith(body, F.lit("```")), closed).otherwise(body))


def label_of(col: Column, labels: dict[str, str], default: str) -> Column:
    value = F.lower(strip(F.coalesce(col, F.lit(""))))
    out = F.lit(default)
    for key, label in labels.items():
        out = F.when(value == key, F.lit(label)).otherwise(out)
    return out


def search_block(terms: Column, field: str = "Title/Abstract") -> Column:
    """``a[Title/Abstract] OR b[Title/Abstract]`` from an array of terms."""
    return F.array_join(F.transform(terms, lambda t: F.concat(t, F.lit(f"[{field}]"))), " OR ")


def html_unescape(col: Column) -> Column:
    """Decode HTML entities.

    The full HTML5 table has no JVM built-in, so the standard library decodes
    inside an Arrow UDF. Cells without an ampersand are sent as null, which
    keeps the transfer to the few cells that need work.
    """
    @F.pandas_udf("string")
    def decode(values: pd.Series) -> pd.Series:
        return values.map(html.unescape, na_action="ignore")

    return F.coalesce(decode(F.when(F.contains(col, F.lit("&")), col)), col)


def escape_java(literal: str) -> str:
    """Regex-quote a literal so that Java and RE2 read it alike."""
    return re.sub(r"([^0-9A-Za-z\u0080-\U0010ffff])", r"\\\1", literal)
