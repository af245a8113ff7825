"""Text column expressions; all of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from chatterscope.constants import MIN_WORD_LENGTH

PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
ENTITY_WORD = r"[\p{L}\p{N}]+(?:[-&'.][\p{L}\p{N}]+)*"

#: An entity word, or what ends a sentence or a line.
ENTITY_TOKEN = ENTITY_WORD + r"|[.!?]+(?:\s|$)|[\r\n]+"


def strip(text: Column) -> Column:
    """Remove white space, line ends included, from both ends."""
    return F.btrim(text, F.lit(" \t\n\x0b\f\r"))


def is_blank(text: Column) -> Column:
    return F.coalesce(~text.rlike(r"\S"), F.lit(True))


def joined(title: Column, body: Column, separator: str) -> Column:
    """Title and body with a separator that stays even when one side is missing."""
    empty = F.lit("")
    return F.concat(F.coalesce(title, empty), F.lit(separator), F.coalesce(body, empty))


def sentiment_text(title: Column, body: Column) -> Column:
    return strip(joined(title, body, ". "))


def post_text(title: Column, body: Column) -> Column:
    return joined(title, body, " ")


def clean(text: Column) -> Column:
    """Lower case, links removed, letters only, single spaces."""
    unlinked = F.regexp_replace(F.lower(text), r"(?U)https?://\S+", " ")
    return F.trim(F.regexp_replace(unlinked, "[^a-z]+", " "))


def words(cleaned: Column) -> Column:
    """All words of a cleaned text, in order, repeats kept."""
    return F.filter(F.split(cleaned, " "), lambda w: F.length(w) > 0)


def keep_words(cleaned: Column, stopwords: list[str]) -> Column:
    """Words of at least three letters that are no stop words, in order, repeats kept."""
    return F.filter(
        F.split(cleaned, " "),
        lambda w: (F.length(w) >= MIN_WORD_LENGTH) & ~w.isin(stopwords),
    )


def drop_words(tokens: Column, stopwords: list[str]) -> Column:
    return F.filter(tokens, lambda w: ~w.isin(stopwords))


def bigrams(tokens: Column) -> Column:
    """Neighbouring pairs; the last word pairs with null, which the filter drops."""
    shifted = F.slice(tokens, F.lit(2), F.size(tokens))
    pairs = F.zip_with(tokens, shifted, lambda a, b: F.concat(a, F.lit(" "), b))
    return F.filter(pairs, lambda p: p.isNotNull())


def title_case(text: Column) -> Column:
    """Capitalise after every non-letter ("gpt-5 pro-max" becomes "Gpt-5 Pro-Max")."""
    runs = F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def is_shouted(word: Column) -> Column:
    """All cased letters are capitals, and there is at least one."""
    return (word != F.lower(word)) & (word == F.upper(word))


def count_char(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))
