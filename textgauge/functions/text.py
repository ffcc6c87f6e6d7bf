"""Text expressions.

Everything here is a built-in column expression without lambdas, so that it stays
inside generated code.  Character classes are spelled out because the engine's
``\\s`` and ``\\w`` are ASCII-only while the corpus is not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Unicode white space and word characters.
#
# Single Latin characters come first and one by one: the regex engine tests those with a table lookup.
# The rest sits behind one range test, so that ordinary text costs two comparisons per character.
_LATIN_SPACE = r"\x09\x0A\x0B\x0C\x0D\x1C\x1D\x1E\x1F\x85\xA0"
_OTHER_SPACE = r"[\x{1680}-\x{3000}&&[\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]]"
SPACE_NOT_BLANK = _LATIN_SPACE + _OTHER_SPACE
SPACE = r"\x20" + SPACE_NOT_BLANK
SPACE_CHARACTERS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
WORD = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_" + r"\p{L}\p{N}"
KEPT_PUNCTUATION = r""".,!?;:"'\-"""

SPACE_RUN = f"[{SPACE}]++"
NON_SPACE_RUN = f"[^{SPACE}]++"
# White space that is not already one blank; leaves the frequent single blanks alone.
UNEVEN_SPACE = f"[{SPACE_NOT_BLANK}][{SPACE}]*+| [{SPACE}]++"
TOKEN = f"[{WORD}]++|[^{WORD}{SPACE}]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns so that a later filter on them does not compute them a second time.

    A filter moves below an ordinary projection and takes a copy of the expression along; it does not
    move below a generator.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def strip(text: Column | str) -> Column:
    """Drop white space at both ends; only the ends are looked at."""
    return F.trim(_col(text), F.lit(SPACE_CHARACTERS))


def is_blank(text: Column | str) -> Column:
    """Null, empty or only white space."""
    return F.coalesce(~_col(text).rlike(f"[^{SPACE}]"), F.lit(True))


def clean(
    text: Column | str, *, drop_special: bool = False, lowercase: bool = False, punctuation: bool = True
) -> Column:
    """Collapse white space, optionally drop special characters, shorten runs of ``.``, ``!``, ``?``.

    Null becomes the empty string.  White space is collapsed to blanks first, so a plain trim
    of blanks at the end is a full strip.
    """
    out = F.regexp_replace(_col(text), UNEVEN_SPACE, " ")
    if drop_special:
        out = F.regexp_replace(out, f"[^{KEPT_PUNCTUATION}{WORD}{SPACE}]++", "")
    if punctuation:
        out = F.regexp_replace(out, r"([.!?])\1++", "$1")
    if lowercase:
        out = F.lower(out)
    return F.coalesce(F.trim(out), F.lit(""))


def clean_light(text: Column | str) -> Column:
    """The cleaning used before scoring: white space only, runs of punctuation stay."""
    return clean(text, punctuation=False)


def words(text: Column | str) -> Column:
    """Array of white-space separated words (may hold one empty string at either end)."""
    return F.split(_col(text), SPACE_RUN)


def word_count(text: Column | str) -> Column:
    return F.regexp_count(_col(text), F.lit(NON_SPACE_RUN)).cast("bigint")


def word_count_of_clean(text: Column | str) -> Column:
    """Words of a text whose white space is single blanks: one more than the blanks."""
    text = _col(text)
    return F.when(text == "", 0).otherwise(count_of(text, " ") + 1).cast("bigint")


def char_count(text: Column | str) -> Column:
    return F.length(_col(text)).cast("bigint")


def count_of(text: Column | str, mark: str) -> Column:
    """How often a single character occurs."""
    text = _col(text)
    return (F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))).cast("bigint")


def sentence_count(text: Column | str) -> Column:
    """A sentence ends with a run of ``.!?`` before white space or the end; a tail counts too."""
    body = strip(text)
    # The last mark of a run is the one before white space or the end: one look ahead per mark, no backtracking.
    ended = F.regexp_count(body, F.lit(rf"[.!?](?=[{SPACE}]|\z)"))
    tail = F.when((body != "") & ~F.substring(body, -1, 1).isin(".", "!", "?"), 1).otherwise(0)
    return F.coalesce((ended + tail).cast("bigint"), F.lit(0).cast("bigint"))


def words_per_sentence(text: Column | str) -> Column:
    sentences = sentence_count(text)
    return F.when(sentences > 0, word_count(text).cast("double") / sentences).otherwise(F.lit(0.0))


def token_count(text: Column | str) -> Column:
    """Words and single punctuation marks."""
    return F.coalesce(F.regexp_count(_col(text), F.lit(TOKEN)), F.lit(0)).cast("bigint")


def tokens(text: Column | str, limit: int | None = None) -> Column:
    """Lower-cased tokens, at most ``limit`` of them (the model's input window)."""
    found = F.regexp_extract_all(F.lower(_col(text)), F.lit(TOKEN), F.lit(0))
    return F.slice(found, 1, limit) if limit else found


def excerpt(text: Column | str, size: int = 100) -> Column:
    """The text, or its first ``size`` characters and an ellipsis."""
    text = _col(text)
    return F.when(F.length(text) > size, F.concat(F.substring(text, 1, size), F.lit("..."))).otherwise(text)
