"""Text clean-up expressions. Everything here stays inside the JVM."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -------------------------------------------------------------------------------
# Strings that a loader treats as "no value".
NULL_SPELLINGS = ("", "\\", "NULL")
# Characters that count as white space at either end of a value.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# Legal-form endings of company names, after lower-casing and removal of punctuation.
LEGAL_SUFFIXES = (
    "ab", "ag", "aps", "as", "asa", "bhd", "bv", "bvba", "co", "co kg", "co ltd", "company",
    "corp", "corporation", "cv", "doo", "eurl", "gmbh", "gmbh co kg", "holding", "holdings",
    "inc", "incorporated", "kft", "kg", "kgaa", "kk", "limited", "llc", "llp", "lp", "ltd",
    "ltda", "mbh", "nv", "ohg", "oy", "oyj", "plc", "private limited", "pte", "pte ltd", "pty",
    "pty ltd", "pvt", "pvt ltd", "sa", "sa de cv", "sarl", "sas", "sdn bhd", "se", "sl", "snc",
    "sp z oo", "spa", "srl", "sro", "ug", "zrt",
)
# English stop words.
STOP_WORDS = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours",
    "yourself", "yourselves", "he", "him", "his", "himself", "she", "her", "hers", "herself",
    "it", "its", "itself", "they", "them", "their", "theirs", "themselves", "what", "which",
    "who", "whom", "this", "that", "these", "those", "am", "is", "are", "was", "were", "be",
    "been", "being", "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an",
    "the", "and", "but", "if", "or", "because", "as", "until", "while", "of", "at", "by", "for",
    "with", "about", "against", "between", "into", "through", "during", "before", "after",
    "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over", "under",
    "again", "further", "then", "once", "here", "there", "when", "where", "why", "how", "all",
    "any", "both", "each", "few", "more", "most", "other", "some", "such", "no", "nor", "not",
    "only", "own", "same", "so", "than", "too", "very", "s", "t", "can", "will", "just", "don",
    "should", "now",
)
# Word tokens: maximal runs of at least two letters, digits or underscores.
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"
# --- end of fixed values ------------------------------------------------------------------------


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def normalize_scalar(c: Column, lower: bool = True) -> Column:
    """NULL spellings become NULL, other strings are stripped and lower-cased.

    A blank string such as ``" "`` ends up empty, not NULL.
    """
    value = c.cast("string")
    cleaned = F.lower(strip(value)) if lower else strip(value)
    return F.when(value.isin(*NULL_SPELLINGS), F.lit(None)).otherwise(cleaned)


def normalize_array(c: Column) -> Column:
    """Empty items go, the rest are stripped (case is kept); nothing left means NULL."""
    kept = F.transform(F.filter(c, lambda item: item != ""), strip)
    return F.when(F.size(kept) > 0, kept)


def normalize_for_copy(c: Column) -> Column:
    """The older, case-preserving variant: escape backslashes and flatten line structure."""
    value = c.cast("string")
    flat = F.replace(value, F.lit("\\"), F.lit("\\\\"))
    flat = F.translate(flat, "\t\n\r", "  ")
    return F.when(value.isin("", "\\"), F.lit(None)).otherwise(flat)


def drop_trailing_backslashes(c: Column) -> Column:
    return F.rtrim(c, F.lit("\\"))


def canonical_text(c: Column) -> Column:
    """Non-alphanumerics to single spaces, trimmed, lower-cased; nothing left means NULL."""
    # the same class as [^a-zA-Z0-9], for which Java took some ten times as long
    spaced = F.regexp_replace(c.cast("string"), r"[\W_]+", " ")
    return F.nullif(F.lower(F.trim(spaced)), F.lit(""))


@lru_cache(maxsize=1)
def _ascii_foldings() -> tuple[str, str, dict[str, str]]:
    """Compatibility decompositions of all code points that leave ASCII text behind."""
    single_from, single_to, several = [], [], {}
    for code in range(0x80, sys.maxunicode + 1):
        char = chr(code)
        if not unicodedata.decomposition(char):
            continue
        folded = unicodedata.normalize("NFKD", char).encode("ascii", "ignore").decode()
        if len(folded) == 1:
            single_from.append(char)
            single_to.append(folded)
        elif folded:
            several[char] = folded
    return "".join(single_from), "".join(single_to), several


def _char_class(chars: list[str]) -> str:
    """A regular-expression class with neighbouring characters as ranges."""
    spans: list[list[int]] = []
    for code in sorted(map(ord, chars)):
        if spans and spans[-1][1] == code - 1:
            spans[-1][1] = code
        else:
            spans.append([code, code])
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in spans) + "]"


def ascii_fold(c: Column) -> Column:
    """Compatibility decomposition followed by dropping what is not ASCII, without Python.

    Decomposition works per code point, so a per-character substitution is exact. Pure ASCII values
    skip all of it, and only values that hold a character with a longer replacement are split up.
    """
    single_from, single_to, several = _ascii_foldings()
    longer = F.str_to_map(
        F.lit("\x01".join(f"{k}\x02{v}" for k, v in several.items())), F.lit("\x01"), F.lit("\x02")
    )
    has_longer = c.rlike(_char_class(list(several)))
    split = F.regexp_extract_all(c, F.lit("(?s)."), F.lit(0))
    expanded = F.array_join(
        F.transform(split, lambda ch: F.coalesce(F.try_element_at(longer, ch), ch)), ""
    )
    replaced = F.translate(F.when(has_longer, expanded).otherwise(c), single_from, single_to)
    return F.when(
        c.rlike(r"[^\x00-\x7F]"), F.regexp_replace(replaced, r"[^\x00-\x7F]", "")
    ).otherwise(c)


def company_key(c: Column) -> Column:
    """Comparable form of a company or device name; NULL becomes the empty string."""
    lowered = F.lower(strip(F.coalesce(c.cast("string"), F.lit(""))))
    words = F.regexp_replace(ascii_fold(lowered), r"[^A-Za-z0-9_\s]", "")
    words = F.trim(F.regexp_replace(words, r"\s+", " "))
    endings = "|".join(sorted(LEGAL_SUFFIXES, key=len, reverse=True))
    return F.trim(F.regexp_replace(words, rf"(?:(?:^| )(?:{endings}))+$", ""))


def tokens(c: Column) -> Column:
    """Lower-cased word tokens of at least two characters."""
    return F.regexp_extract_all(F.lower(c), F.lit(TOKEN_PATTERN), F.lit(0))


def content_words(c: Column) -> Column:
    """Lower-cased words without stop words, joined by single spaces.

    Punctuation and contraction endings are cut off words, but commas and colons inside numbers
    stay. What is not purely letters and digits afterwards is dropped.
    """
    text = F.lower(F.coalesce(c, F.lit("")))
    text = F.regexp_replace(text, r"(n't|'(?:s|re|ve|ll|d|m))(\s|$)", " ")
    text = F.regexp_replace(text, r"[,:]([^0-9]|$)", " $1")
    text = F.regexp_replace(text, r"[;@#$%&?!\"()\[\]{}<>]|\.(\s|$)", " ")
    words = F.filter(
        F.split(text, r"\s+"), lambda w: w.rlike(r"^[\p{L}\p{N}]+$") & ~w.isin(*STOP_WORDS)
    )
    return F.array_join(words, " ")


def first_number(c: Column) -> Column:
    """The first run of digits after removal of thousands separators."""
    digits = F.regexp_extract(F.replace(c, F.lit(","), F.lit("")), r"([0-9]+)", 1)
    return digits.try_cast("bigint")


def number_or_zero(c: Column) -> Column:
    return F.coalesce(c.try_cast("double"), F.lit(0.0))


def array_to_csv(c: Column) -> Column:
    return F.array_join(c, ",")


def matches_anywhere(c: Column, pattern: str) -> Column:
    """Case-insensitive regular-expression search; NULL never matches."""
    return F.coalesce(c.rlike("(?i)" + pattern), F.lit(False))
