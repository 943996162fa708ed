"""Small Column helpers shared by all operators (no UDFs)."""

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def c(x):
    """A Column from a column name or a Column."""
    return F.col(x) if isinstance(x, str) else x


def text(x):
    """NULL-safe string: the engine treats a missing text as ''."""
    return F.coalesce(c(x).cast("string"), F.lit(""))


def nz(x):
    """'' becomes NULL, so that coalesce() skips it."""
    return F.nullif(c(x), F.lit(""))


def first_filled(*cols):
    """First non-empty string, else ''."""
    return F.coalesce(*[nz(x) for x in cols], F.lit(""))


def quote(s):
    """Escape a literal for a Java (and RE2) pattern."""
    return re.sub(r"([\\.^$|?*+()\[\]{}\-])", r"\\\1", s)


def any_of(words):
    return "|".join(quote(w) for w in words)


WHITE = "\t\n\x0b\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(x):
    """Trim all Unicode white space (trim() alone leaves U+3000); a pattern would look at every character."""
    return F.btrim(c(x), F.lit(WHITE))


def strip_set(x, chars):
    k = "".join(quote(ch) for ch in chars)
    return F.regexp_replace(c(x), f"^[{k}]+|[{k}]+$", "")


def rstrip_set(x, chars):
    return F.regexp_replace(c(x), f"[{''.join(quote(ch) for ch in chars)}]+$", "")


def head(x, n):
    return F.substring(c(x), 1, n)


def has(x, word):
    return F.contains(c(x), F.lit(word))


def has_any(x, words):
    return reduce(lambda a, b: a | b, [has(x, w) for w in words]) if words else F.lit(False)


def count_hits(x, words):
    """How many of the words occur in x."""
    return reduce(lambda a, b: a + b, [has(x, w).cast("int") for w in words]) if words else F.lit(0)


def hits(x, words):
    """The words that occur in x, in list order."""
    return F.array_compact(F.array(*[F.when(has(x, w), F.lit(w)) for w in words]))


def let(value: Column, body):
    """Evaluate value once and use it several times inside body."""
    return F.transform(F.array(value), body)[0]



def pos(x, needle):
    """1-based position of a Column needle in x; 0 when absent."""
    return F.position(c(needle), c(x))


def lines(x):
    """Stripped, non-blank lines."""
    return F.filter(F.transform(F.split(c(x), "\n"), strip), lambda l: l != "")


def lit_array(words):
    return F.array(*[F.lit(w) for w in words]) if words else F.array().cast("array<string>")


def lit_map(d):
    return F.create_map(*[F.lit(v) for kv in d.items() for v in kv])


def field(m, key):
    """Map value or ''."""
    return F.coalesce(F.try_element_at(c(m), F.lit(key)), F.lit(""))


def first_match(x, patterns, group=1):
    """First non-empty capture over ordered patterns, else ''."""
    return first_filled(*[F.regexp_extract(c(x), p, group) for p in patterns])


def case(pairs, default=None):
    """CASE WHEN from [(condition, value)]."""
    e = None
    for cond, value in pairs:
        value = value if isinstance(value, Column) else F.lit(value)
        e = F.when(cond, value) if e is None else e.when(cond, value)
    if default is None:
        return e
    return e.otherwise(default if isinstance(default, Column) else F.lit(default))
