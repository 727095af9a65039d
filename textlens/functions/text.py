"""Scalar text functions as Column expressions (JVM side, codegen friendly).

Java's ``\\w``/``\\s``/``\\S`` are ASCII-only while the behaviour reproduced
uses Python's Unicode classes, so the classes are spelled out explicitly.
The same literals are valid in Java regex and in RE2 (DuckDB).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# FIXED VALUES: the characters Python's ``str.isspace`` / Unicode ``\s`` accept.
WS_CLASS = (r"\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
            r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
URL_RE = rf"https?://[^{WS_CLASS}]+"
MENTION_RE = r"@[\p{L}\p{N}_]+"
WS_RUN_RE = rf"[{WS_CLASS}]+"
EDGE_WS_RE = rf"^[{WS_CLASS}]+|[{WS_CLASS}]+$"
# a word token: a run of two or more Unicode word characters
WORD_TOKEN_RE = r"[\p{L}\p{N}_]{2,}"
# near-duplicate normal form keeps only these characters
NEAR_DUP_DROP_RE = r"[^a-z0-9# ]+"
NEAR_DUP_SPLIT_RE = r"[^a-z0-9]+"
NEAR_DUP_TOKEN_RE = r"[a-z0-9]{2,}"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c: Column | str) -> Column:
    """Drop URLs, then @mentions, collapse whitespace runs, strip."""
    s = F.regexp_replace(_c(c), URL_RE, "")
    s = F.regexp_replace(s, MENTION_RE, "")
    s = F.regexp_replace(s, WS_RUN_RE, " ")
    return F.trim(s)


def strip_ws(c: Column | str) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace."""
    return F.regexp_replace(_c(c), EDGE_WS_RE, "")


def capitalize(c: Column | str) -> Column:
    """First character upper, the rest lower (Python ``str.capitalize``)."""
    s = _c(c)
    return F.concat(F.upper(F.substring(s, 1, 1)), F.lower(F.substring(s, 2, 2147483647)))


def word_count(cleaned: Column | str) -> Column:
    """Words of an already cleaned text (single spaces, stripped)."""
    s = _c(cleaned)
    return F.when(s == "", F.lit(0)).otherwise(F.size(F.split(s, " ")))


def dedup_key(cleaned: Column | str) -> Column:
    """C4: case-insensitive key for exact copies."""
    return F.lower(_c(cleaned))


def near_dup_form(c: Column | str) -> Column:
    """Lower; anything but [a-z0-9# ] becomes a space; collapse; strip."""
    s = F.regexp_replace(F.lower(_c(c)), NEAR_DUP_DROP_RE, " ")
    s = F.regexp_replace(s, " +", " ")
    return F.trim(s)


def near_dup_tokens(form: Column | str) -> Column:
    """C6 on a C5 form: alphanumeric runs of length >= 2 ('#' separates)."""
    return F.filter(F.split(_c(form), NEAR_DUP_SPLIT_RE), lambda t: F.length(t) >= 2)


def explode_ngrams(df, form: str, keep: list[str], out: str = "term"):
    """Rows ``keep..., out`` with every 1-gram and 2-gram of a C5 form.

    Lambda-free on purpose (higher-order functions are interpreted per
    element): tokens are ``regexp_extract_all`` runs of >= 2 alphanumerics,
    and ``arrays_zip(t, t[2:])`` pairs each token with its successor (the
    last one with null), giving the unigram and, where present, the bigram.
    """
    t = F.regexp_extract_all(F.col(form), F.lit(NEAR_DUP_TOKEN_RE), 0)
    # outer: for a plain explode Spark infers a filter on the list's size, which makes the tokens once more
    pairs = df.select(*keep, F.explode_outer(F.arrays_zip(t.alias("a"), F.slice(t, 2, 1 << 30).alias("b")))
                      .alias("_p"))
    grams = F.array(F.col("_p.a"), F.when(F.col("_p.b").isNotNull(),
                                          F.concat_ws(" ", F.col("_p.a"), F.col("_p.b"))))
    return pairs.select(*keep, F.explode_outer(grams).alias(out)).filter(F.col(out).isNotNull())


def has_token(form: Column | str) -> Column:
    """A C5 form has a token iff it holds two consecutive alphanumerics."""
    return _c(form).rlike(NEAR_DUP_TOKEN_RE)


def word_tokens(c: Column | str) -> Column:
    """C6 (Unicode): runs of >= 2 word characters of a lower-cased text."""
    return F.regexp_extract_all(_c(c), F.lit(WORD_TOKEN_RE), 0)


def with_bigrams(tokens: Column) -> Column:
    """1- and 2-grams of a token array (bigram = 'a b').

    Built with ``zip_with`` over two slices: a lambda indexing the array
    would re-evaluate the token expression per element.
    """
    n = F.size(tokens)
    bigrams = F.when(
        n >= 2,
        F.zip_with(F.slice(tokens, 1, n - 1), F.slice(tokens, 2, n - 1),
                   lambda a, b: F.concat_ws(" ", a, b)),
    ).otherwise(F.array().cast("array<string>"))
    return F.concat(tokens, bigrams)


# slots of a hashed vocabulary: a fixed size, whatever the corpus
SLOT_BITS = 18
N_SLOTS = 1 << SLOT_BITS


def hashed_slots(terms: Column) -> Column:
    """The slot (0 to N_SLOTS - 1) of each term: the leading bits of its md5."""
    return F.transform(terms, lambda t: F.shiftright(F.conv(F.substring(F.md5(t), 1, 5), 16, 10).cast("int"), 20 - SLOT_BITS))


def is_integer_string(c: Column | str) -> Column:
    """Digits with an optional leading minus."""
    return _c(c).rlike(r"^-?[0-9]+$")
