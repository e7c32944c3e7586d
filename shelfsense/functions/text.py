"""Text clean-up and tokenising as column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfsense.functions.wordlists import LEMMA_KEEP, LEMMA_MIN_LENGTH, LEMMA_RULES, STOP_WORDS

# Character classes that mean the same in Spark (Java regex) and in SQL engines
# built on RE2. A bare \w would be ASCII-only in both and would destroy accented words.
WORD = r"\p{L}\p{N}_"
SPACE = r"\s\x0b\x1c-\x1f\x85\p{Z}"
PUNCTUATION_RUN = f"[^{WORD}{SPACE}]+"
WORD_RUN = f"[{WORD}]+"
VECTOR_WORD = f"[{WORD}]{{2,}}"
NON_SPACE_RUN = f"[^{SPACE}]+"


def strip_punctuation(text: Column) -> Column:
    """Lower-cased text without punctuation; null becomes the empty string."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), PUNCTUATION_RUN, "")


def tokens(text: Column) -> Column:
    """Search tokens: punctuation is deleted first, so `don't` is the one token `dont`."""
    return F.regexp_extract_all(strip_punctuation(text), F.lit(WORD_RUN), F.lit(0))


def vector_tokens(text: Column) -> Column:
    """Vectoriser tokens: runs of two or more word characters, so `don't` gives `don`."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(VECTOR_WORD), F.lit(0))


def relevance_tokens(text: Column) -> Column:
    """Word runs of three or more characters, used to judge titles against a query."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD_RUN), F.lit(0))
    return F.filter(words, lambda word: F.length(word) > 2)


def without_stop_words(words: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    return F.filter(words, lambda word: ~word.isin(list(stop_words)))


def is_content_word(token: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """True for a token that is no stop word and has more than two characters."""
    return (F.length(token) > 2) & ~token.isin(list(stop_words))


def lemma(token: Column) -> Column:
    """Singular form of an English noun by suffix rules; other tokens stay as they are."""
    keep = reduce(lambda a, b: a | b, [token.endswith(suffix) for suffix in LEMMA_KEEP])
    rule = F.when(keep, token)
    for suffix, replacement in LEMMA_RULES:
        stem = F.substring(token, F.lit(1), F.length(token) - len(suffix))
        rule = rule.when(
            token.endswith(suffix) & (F.length(token) >= LEMMA_MIN_LENGTH + len(suffix) - len(replacement)),
            F.concat(stem, F.lit(replacement)),
        )
    return rule.otherwise(token)


def content_words(text: Column, lemmatize: bool = True, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """Array of cleaned tokens without stop words and short words, optionally as lemmas."""
    kept = F.filter(tokens(text), lambda token: is_content_word(token, stop_words))
    return F.transform(kept, lemma) if lemmatize else kept


def preprocess(text: Column, lemmatize: bool = True, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    return F.array_join(content_words(text, lemmatize, stop_words), " ")


def ngrams(words: Column, n: int) -> Column:
    """All runs of `n` neighbouring words; an array shorter than `n` gives none."""
    if n == 1:
        return words
    starts = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - (n - 1)))
    grams = F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " "))
    return F.coalesce(grams, F.array().cast("array<string>"))


def word_count(text: Column) -> Column:
    """Number of pieces between white space."""
    return F.size(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(NON_SPACE_RUN), F.lit(0)))


def char_count(text: Column) -> Column:
    return F.length(F.coalesce(text, F.lit("")))


def lines(text: Column) -> Column:
    """Trimmed lines of a text without the blank ones."""
    trimmed = F.transform(F.split(F.coalesce(text, F.lit("")), r"\r\n|\r|\n"), lambda line: F.trim(line))
    return F.filter(trimmed, lambda line: line != "")
