"""Text functions as Column builders. White space means Unicode's, as in the texts' origin."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


#: All characters that are white space.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: A character beyond U+024F, mathematical letters aside.
BEYOND_LATIN = r"[^\x{0000}-\x{024F}\x{1D400}-\x{1D7FF}]"


def strip(c: Column | str) -> Column:
    """Without white space at either end."""
    return F.btrim(F.col(c) if isinstance(c, str) else c, F.lit(WHITE))


def text_or_empty(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def words(c: Column) -> Column:
    """The words between white space; none for a blank text."""
    return F.filter(F.split(strip(c), r"(?U)\s+"), lambda w: w != "")


def present(c: Column) -> Column:
    """The text, or null where it's blank."""
    return F.when(F.length(strip(c)) > 0, c)


def number(c: Column | str) -> Column:
    """A double from text; null for blanks, junk and Java's suffixes, as 0.5f."""
    t = strip(c)
    return F.when(~F.lower(t).rlike("[fd]$"), t.try_cast("double"))


def iso_time(c: Column | str) -> Column:
    """A timestamp from ISO 8601 text: a whole date with or without dashes, any one sign, a time down to hours at least, a zone or none, which is that
    of the session. Null for anything else, so that a bare year or month is no date; dates by week are not read."""
    c = F.col(c) if isinstance(c, str) else c
    day, clock, zone = r"(\d{4})-?(\d{2})-?(\d{2})", r"(\d{2}):?(\d{2})?:?(\d{2})?(?:[.,](\d{1,9}))?", r"(Z|[+-]\d{2}:?\d{2})?"
    whole = rf"^{day}(?:\D{clock}{zone})?$"
    part = lambda k: F.regexp_extract(c, whole, k)
    two = lambda k: F.when(part(k) == "", "00").otherwise(part(k))
    text = F.concat(part(1), F.lit("-"), part(2), F.lit("-"), part(3), F.lit("T"), two(4), F.lit(":"), two(5), F.lit(":"), two(6), F.lit("."), F.rpad(F.substring(part(7), 1, 6), 6, "0"), F.regexp_replace(part(8), r"^([+-]\d{2})(\d{2})$", "$1:$2"))
    return F.when(c.rlike(whole), text).try_cast("timestamp")


def non_latin_share(c: Column) -> Column:
    """The share of words that hold a character beyond U+024F (mathematical letters aside); null below one word."""
    w = words(c)
    foreign = F.size(F.filter(w, lambda x: x.rlike(BEYOND_LATIN)))
    return F.when(F.size(w) > 0, foreign / F.size(w))


def one_decimal(c: Column) -> Column:
    """Rounded half to even at one decimal."""
    return F.bround(c, 1)


#: The stop lists of the token kinds. Fixed values.
CLEANUP_STOP = ("a", "an", "the", "for", "of", "in", "on", "to", "and", "or", "with", "vs", "via", "using", "use", "uses", "new", "best", "top")
CLEANUP_SHORT = ("ai", "ml", "ux", "ui", "qa", "vc", "ar", "vr", "os", "ci", "cd")
SMALL_STOP = ("and", "or", "in", "of", "the", "a", "an", "for", "to", "with", "on", "at", "by", "from", "as", "into", "about", "is", "are", "its", "their", "our", "this", "that", "vs", "via", "per")
WIDE_STOP = SMALL_STOP + (
    "use", "using", "used", "uses", "based", "driven", "related", "best", "practices", "challenges", "strategies", "approaches", "trends", "issues", "impact", "overview", "discussion", "review", "analysis", "update", "updates", "adoption", "implementation",
    "management", "development", "tools", "tooling", "platform", "systems", "system", "process", "processes", "methods", "solutions", "solution", "features", "feature", "support", "integration", "benefits", "risks", "risk", "concerns", "insights",
)


def tokens(c: Column, kind: str) -> Column:
    """The sorted set of tokens of a label. Kinds: plain, cleanup, wide, small; they differ in pattern, stop list and least length."""
    dotted = kind in ("wide", "small")
    found = F.regexp_extract_all(F.lower(c), F.lit(r"[a-z0-9]+(?:\.[a-z0-9]+)*" if dotted else r"[a-z0-9]+"), 0)
    if kind == "cleanup":
        found = F.filter(found, lambda t: ~t.isin(*CLEANUP_STOP) & ((F.length(t) > 2) | t.isin(*CLEANUP_SHORT)))
    elif kind == "wide":
        found = F.filter(found, lambda t: ~t.isin(*WIDE_STOP) & (F.length(t) > 2))
    elif kind == "small":
        found = F.filter(found, lambda t: ~t.isin(*SMALL_STOP) & (F.length(t) > 1))
    elif kind != "plain":
        raise ValueError(kind)
    return F.array_sort(F.array_distinct(found))


def jaccard(a: Column, b: Column) -> Column:
    """The share of common tokens of two sets; 0 if either is empty."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), both / (F.size(a) + F.size(b) - both)).otherwise(F.lit(0.0))
