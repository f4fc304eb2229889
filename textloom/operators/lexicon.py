"""Word lists, a classifier by lists, and its measurement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import WORD, words
from . import joins, tables


def tokens(rows: DataFrame, keep: list[str], pattern: str = WORD, text: str = "text") -> DataFrame:
    """(keep, k, word): the words of a text in order, lower-cased."""
    return rows.select(*keep, F.posexplode(words(F.lower(F.col(text)), pattern)).alias("k", "word"))


def lexicon(tokens: DataFrame, by: list[str] = [], doc: str | None = None) -> DataFrame:  # noqa: B006
    """(by, word, n), and with doc also in how many documents."""
    more = [F.count_distinct(doc).alias("docs")] if doc else []
    return tokens.groupBy(*by, "word").agg(F.count("*").alias("n"), *more)


def counted(rows: DataFrame, keep: list[str], pattern: str = WORD, text: str = "text") -> DataFrame:
    """(keep, word, n): each distinct word of a text with its count, found inside the row: sorted words, and where runs of equal ones begin. No filter looks at the words before they are taken apart: Spark would push it below them and cut the text twice."""
    d = rows.select(*keep, F.sort_array(words(F.lower(F.col(text)), pattern)).alias("_w"))
    begins = F.filter(F.sequence(F.lit(0), F.greatest(F.size("_w") - 1, F.lit(0))), lambda i: (i == 0) | (F.col("_w")[i] != F.col("_w")[F.greatest(i - 1, F.lit(0))]))
    d = d.withColumn("_b", F.when(F.size("_w") > 0, begins))
    runs = F.transform("_b", lambda b, i: F.struct(F.col("_w")[b].alias("word"), (F.coalesce(F.try_element_at("_b", i + 2), F.size("_w")) - b).cast("long").alias("n")))
    return d.select(*keep, F.explode(runs).alias("_r")).select(*keep, "_r.*")


def of_documents(rows: DataFrame, by: list[str] = [], pattern: str = WORD) -> DataFrame:  # noqa: B006
    """(by, word, n, docs) of documents, a row each: words are counted inside the row, so that one exchange of sums is left, and a word that all hold is one row a task."""
    return counted(rows, by, pattern).groupBy(*by, "word").agg(F.sum("n").alias("n"), F.count("*").alias("docs"))


def leave_one_out(rows: DataFrame, doc: str, truth: str, text: str = "text") -> DataFrame:
    """For each document (a row) and class: how many of its distinct words other documents of that class hold. The lexicon is built once, a row for each word with the counts of all classes; what the document itself adds is taken off. Frequent words, which most documents hold, are looked up in a bounded map and are never dealt out."""
    once = rows.select(doc, truth, F.explode(F.array_distinct(words(F.lower(F.col(text))))).alias("word"))
    by = once.groupBy("word", F.col(truth).alias("cls")).agg(F.count("*").alias("n"))
    by = by.groupBy("word").agg(F.collect_list(F.struct("cls", "n")).alias("_by"), F.sum("n").alias("_docs"))  # as many entries as there are classes
    by = tables.written(by, tables.folder(rows.sparkSession, "lexicon"))
    d = joins.looked_up(once, by.drop("_docs"), ["word"], by.select("word", F.col("_docs").alias("n")))
    d = d.select(doc, truth, F.explode("_by").alias("_c")).select(doc, truth, "_c.*")
    return d.groupBy(doc, truth, "cls").agg(F.count_if(F.col("n") - (F.col(truth) == F.col("cls")).cast("long") > 0).alias("known"))


def predicted(votes: DataFrame, doc: str, truth: str) -> DataFrame:
    """The class with the most known words; ties go to the first by name."""
    best = F.min(F.struct((-F.col("known")).alias("k"), "cls"))["cls"]
    return votes.groupBy(doc, F.col(truth).alias("truth")).agg(best.alias("predicted"))


def confusion(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("truth", "predicted").agg(F.count("*").alias("n"))


def measured(pairs: DataFrame) -> DataFrame:
    """One row: n, right, accuracy, and the accuracy of always naming the most frequent class."""
    by = pairs.groupBy("truth").agg(F.count("*").alias("n"), F.count_if(F.col("truth") == F.col("predicted")).alias("ok"))
    return by.agg(F.sum("n").alias("n"), F.sum("ok").alias("right"), F.max("n").alias("most")).select("n", "right", F.round(F.col("right") / F.col("n"), 6).alias("accuracy"), F.round(F.col("most") / F.col("n"), 6).alias("baseline"))


def neighbours(rows: DataFrame, keep: list[str], pattern: str = WORD, text: str = "text") -> DataFrame:
    """(keep, k, word, prev, next): the words of a text in order with those beside them, '' at the ends. Neighbours are looked up inside the row, without a shuffle."""
    d = rows.select(*keep, words(F.lower(F.col(text)), pattern).alias("_w"))
    beside = lambda i: F.coalesce(F.try_element_at("_w", F.nullif(i, F.lit(0))), F.lit(""))
    each = F.transform("_w", lambda w, i: F.struct(w.alias("word"), beside(i).alias("prev"), beside(i + 2).alias("next")))
    return d.select(*keep, F.posexplode(each).alias("k", "_x")).select(*keep, "k", "_x.*")


def rule(own: Column, foreign: Column, before: Column, after: Column, marked: Column) -> Column:
    """The class of a ``word`` by ordered rules. before: a language's name stands next; after: it stands before the word; marked: it or a marker does. Before a language's name a word is foreign; so is one that only the foreign list has; an unknown one after a language or marker, or longer than two letters, is foreign, else bold; a single letter is bold, after a language foreign; all others are roman."""
    return (
        F.when(before, "foreign").when(foreign & ~own, "foreign").when(~own & marked, "foreign")
        .when(~own, F.when(F.length("word") > 2, "foreign").otherwise("bold")).when(F.length("word") == 1, F.when(after, "foreign").otherwise("bold")).otherwise("roman")
    )


def _beside(languages: list[str], markers: list[str]) -> dict[str, Column]:
    return {"_before": F.col("next").isin(languages), "_after": F.col("prev").isin(languages), "_marked": F.col("prev").isin(languages + markers)}


def classified(near: DataFrame, own: Column, foreign: Column, languages: list[str], markers: list[str]) -> DataFrame:
    """near (see neighbours) with ``cls``, by the rule; own and foreign say which lists have the word."""
    d = near.withColumns(_beside(languages, markers))
    return d.withColumn("cls", rule(own, foreign, F.col("_before"), F.col("_after"), F.col("_marked"))).drop("_before", "_after", "_marked")


def class_counts(near: DataFrame, lists: DataFrame, languages: list[str], markers: list[str]) -> DataFrame:
    """(cls, n): how many words of near (see neighbours) have each class. lists: (word, own, foreign), a row a word. Equal words with the same kind of neighbours are counted before the lists are asked, so a frequent word is some few rows."""
    d = near.withColumns(_beside(languages, markers)).groupBy("word", "_before", "_after", "_marked").agg(F.count("*").alias("_n"))
    d = d.join(lists, "word").withColumn("cls", rule(F.col("own"), F.col("foreign"), F.col("_before"), F.col("_after"), F.col("_marked")))
    return d.groupBy("cls").agg(F.sum("_n").alias("n"))
