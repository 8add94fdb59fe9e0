"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space that text cleaning collapses (Unicode white space and the
# four separator control characters), the keyword list and the email pattern.
SPACE = r"(?U)[\s\x1c-\x1f]"
TECH_KEYWORDS = ("python", "java", "javascript", "sql", "machine learning", "ai", "data science")
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"^{SPACE}+|{SPACE}+$", "")


def collapse_space(c: Column) -> Column:
    """Every run of white space becomes one blank; none is left at the ends."""
    return strip(F.regexp_replace(c, rf"{SPACE}+", " "))


def clean_text(c: Column) -> Column:
    """Collapsed text; the literal ``nan`` is a null."""
    return F.nullif(collapse_space(c.cast("string")), F.lit("nan"))


def title_case(c: Column) -> Column:
    """Upper-case every letter that follows a non-letter, lower-case the others.

    ``initcap`` starts a word after a blank only. So each non-letter gets a marked blank behind
    it, and the marks go again afterwards.
    """
    mark = "\u0001 "
    marked = F.regexp_replace(F.lower(c), r"([^\p{Lu}\p{Ll}\p{Lt}])", f"$1{mark}")
    return F.replace(F.initcap(marked), F.lit(mark), F.lit(""))


def word_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(r"(?U)[^\s\x1c-\x1f]+"))


def email_or_null(c: Column) -> Column:
    address = strip(F.lower(c.cast("string")))
    return F.when(address.rlike(EMAIL_PATTERN), address)


def has_keyword(c: Column, keyword: str) -> Column:
    """Substring match on the lower-cased text: ``java`` is found in ``javascript``."""
    return F.coalesce(F.contains(F.lower(c.cast("string")), F.lit(keyword)), F.lit(False))


def fold_accents(name: str) -> str:
    """Plain-letter form of a column name: ``años`` and ``anos`` name the same field."""
    import unicodedata

    return "".join(ch for ch in unicodedata.normalize("NFD", name) if not unicodedata.combining(ch))
