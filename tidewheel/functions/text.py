"""Columns for text matching: phrases, edit distance, similarity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN = "[^0-9a-z]+"


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits (ASCII), in order, without empty ones."""
    return F.filter(F.split(F.lower(text), TOKEN), lambda t: t != "")


def has_phrase(text: Column, phrase: str) -> Column:
    return F.lower(text).contains(phrase.lower())


def near_token(text: Column, word: str, distance: int = 2) -> Column:
    """Some token is within an edit distance of word."""
    return F.exists(tokens(text), lambda t: F.levenshtein(t, F.lit(word.lower()), distance) >= 0)


def near_in_any(fields: list[Column], word: str, distance: int = 2) -> Column:
    """Some token of some field is within an edit distance of word; null fields hold none."""
    out = F.lit(False)
    for f in fields:
        out = out | F.coalesce(near_token(f.cast("string"), word, distance), F.lit(False))
    return out


def near_phrase(text: Column, phrase: str, slop: int = 1, distance: int = 1) -> Column:
    """The phrase's words occur in order, each within an edit distance, with at most slop other tokens between.

    One walk over the tokens, which keeps for each word but the last the latest place where the phrase so far may end: an
    earlier one reaches no further. The phrase is found where its last word follows in reach.
    """
    words = phrase.lower().split()
    last = len(words) - 1
    is_word = lambda t, w: (F.length(t) >= len(w) - distance) & (F.length(t) <= len(w) + distance) & (F.levenshtein(t, F.lit(w), distance) >= 0)

    def step(s: Column, t: Column) -> Column:
        """s: the token's place, the latest places, and whether the phrase has been found."""
        ends = [is_word(t, w) if k == 0 else (s[f"p{k - 1}"] >= s["at"] - 1 - slop) & is_word(t, w) for k, w in enumerate(words)]
        places = [F.when(ends[k], s["at"]).otherwise(s[f"p{k}"]).alias(f"p{k}") for k in range(last)]
        return F.struct((s["at"] + 1).alias("at"), *places, (s["found"] | ends[last]).alias("found"))

    start = F.struct(F.lit(0).alias("at"), *(F.lit(-2 - slop).alias(f"p{k}") for k in range(last)), F.lit(False).alias("found"))
    return F.aggregate(tokens(text), start, step)["found"]


def similarity(a: Column, b: Column) -> Column:
    """0 to 100: one minus the edit distance over the longer length. Two empty texts are alike."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, 100.0).otherwise((1 - F.levenshtein(a, b) / longest) * 100)


def partial_similarity(term: Column, text: Column) -> Column:
    """The best similarity of term with any stretch of text of its length (or with all of a shorter text)."""
    n = F.length(term)
    last = F.greatest(F.length(text) - n, F.lit(0))
    scores = F.transform(F.sequence(F.lit(0), last), lambda i: similarity(term, F.substring(text, i + 1, n)))
    return F.when(text.contains(term), 100.0).otherwise(F.array_max(scores))
