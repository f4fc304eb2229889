"""Where a word may be broken, by rule tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Vowels, and pairs that stay together.
VOWELS = "aeiou"
DIGRAPHS, DIPHTHONGS = ["ch", "sh", "qu"], ["au", "eu"]


def breaks(folded: Column, together: list[str] = DIGRAPHS + DIPHTHONGS, vowels: str = VOWELS) -> Column:
    """Positions after which a folded word (lower case, no accents) may be broken: a vowel on both sides, and no pair that stays together is split. None for what is not all letters."""
    ok = lambda i: ~F.substring(folded, i, F.lit(2)).isin(together) & F.substring(folded, F.lit(1), i).rlike(f"[{vowels}]") & F.substring(folded, i + 1, F.lit(1 << 30)).rlike(f"[{vowels}]")
    all_of = F.filter(F.sequence(F.lit(1), F.greatest(F.length(folded) - 1, F.lit(1))), ok)
    return F.when(folded.rlike(r"(?U)^\p{L}+$") & (F.length(folded) > 1), all_of).otherwise(F.array().cast("array<int>"))


def fault(left: Column, right: Column, together: list[str] = DIGRAPHS + DIPHTHONGS, vowels: str = VOWELS) -> Column:
    """Why the break left|right (folded) is not allowed; null if it is."""
    pair = F.concat(F.substring(left, -1, 1), F.substring(right, 1, 1))
    return (
        F.when((left == "") | (right == ""), "empty part")
        .when(~left.rlike(f"[{vowels}]"), "no vowel on the left")
        .when(~right.rlike(f"[{vowels}]"), "no vowel on the right")
        .when(pair.isin(together), F.concat(F.lit("splits "), pair))
    )


def hyphenated(word: Column, folded: Column) -> Column:
    """The word with a hyphen at every break."""
    at = F.concat(F.array(F.lit(0)), breaks(folded), F.array(F.length(word)))
    parts = F.transform(F.sequence(F.lit(1), F.size(at) - 1), lambda i: F.substring(word, F.element_at(at, i) + 1, F.element_at(at, i + 1) - F.element_at(at, i)))
    return F.array_join(parts, "-")
