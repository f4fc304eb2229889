"""Search over an index of trigrams: posting lists, their intersection, and the hits among the candidates.

An index is three tables in one folder. ``texts`` has every row's key, its text
as shown, and its text in lower case, in the order of keys. ``postings`` has,
for each trigram and stretch of keys, the sorted keys whose lower-case text
holds it, in the order of trigrams, so that a query reads the row groups of its
own trigrams only. ``grams`` says how many texts hold each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import snippet, u
from . import tables

#: Keys of one stretch, whose trigrams' lists meet in one row; characters of an entry; the mark behind a text's end, so that its last two characters begin an entry too.
STRETCH, SIZE, END = 1 << 14, 3, "\x00"
#: Candidates up to so many are asked for by their keys, which the scan of the texts skips by; more are joined.
BY_KEY = 1024


@dataclass
class Index:
    folder: str
    texts: DataFrame
    postings: DataFrame
    grams: DataFrame


def _lists(keys: np.ndarray, texts: list[str], stretch: int) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """The trigrams of some texts and the mark behind each: (gram, stretch, begin) of each list, and the lists' keys one behind the other."""
    order = np.argsort(keys, kind="stable")
    keys, texts = keys[order], [texts[i] for i in order]
    size = np.array([len(t) + 1 for t in texts])
    c = np.frombuffer((END.join(texts) + END).encode("utf-32-le"), "<u4").astype(np.int64)
    own = np.repeat(np.arange(len(texts)), size)
    at = np.flatnonzero(np.arange(len(c)) + SIZE <= np.cumsum(size)[own])
    code, own = c[at] << 42 | c[at + 1] << 21 | c[at + 2], own[at]
    order = np.argsort(code, kind="stable")  # texts stay in order
    code, own = code[order], own[order]
    part = keys[own] // stretch
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (own[1:] != own[:-1])
    code, own, part = code[new], own[new], part[new]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (part[1:] != part[:-1])
    begin = np.flatnonzero(new)
    letters = np.stack([code[begin] >> 42, code[begin] >> 21 & 0x1FFFFF, code[begin] & 0x1FFFFF], 1).astype("<u4").tobytes().decode("utf-32-le")
    return [letters[i : i + SIZE] for i in range(0, len(letters), SIZE)], part[begin], begin, keys[own]


def _posted(texts: DataFrame, stretch: int, most: int = 1 << 21) -> DataFrame:
    """(gram, part, keys) of texts (key, lowered): a list for each trigram and stretch of some neighbouring texts, about ``most`` characters of them or a longer one, so that a trigram of most texts is a few rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def listed(keys: list[int], texts: list[str]) -> pa.RecordBatch:
            grams, parts, begin, own = _lists(np.array(keys, np.int64), texts, stretch)
            offsets = np.append(begin, len(own)).astype(np.int32)
            return pa.RecordBatch.from_arrays([pa.array(grams, pa.string()), pa.array(parts, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(own, pa.int64()))], names=["gram", "part", "keys"])

        keys, some, size = [], [], 0
        for b in batches:
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                keys.append(key)
                some.append(text)
                size += len(text)
                if size >= most:
                    yield listed(keys, some)
                    keys, some, size = [], [], 0
        if keys:
            yield listed(keys, some)

    return texts.select("key", "lowered").mapInArrow(run, "gram string, part long, keys array<long>")


def build(rows: DataFrame, key: str, folder: str | None = None, text: str = "text", stretch: int = STRETCH) -> Index:
    """The index of rows (key: a whole number, each once; text), written to folder. White space is collapsed; rows without text are left out.

    Lists of one trigram are cut by stretches of keys, so that a trigram of most
    texts is many bounded lists. Neighbouring texts' trigrams are listed together
    where the texts lie, so that lists are dealt out, not trigrams of texts.
    """
    spark = rows.sparkSession
    folder = folder or tables.folder(spark, "search")
    shown = F.trim(F.regexp_replace("text", u(r"\s+"), " "))
    d = rows.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).where("key is not null and text is not null").repartitionByRange("key")  # as they are: dealt out once, looked at behind that
    d = d.select("key", shown.alias("text")).where("text <> ''").withColumn("lowered", F.lower("text"))
    tables.written(d.sortWithinPartitions("key"), f"{folder}/texts")
    texts = spark.read.parquet(f"{folder}/texts")
    lists = _posted(texts, stretch).groupBy("gram", "part").agg(F.sort_array(F.flatten(F.collect_list("keys"))).alias("keys"))  # stretch keys at most
    postings = tables.written(lists.repartitionByRange("gram", "part").sortWithinPartitions("gram", "part"), f"{folder}/postings")
    n = tables.written(postings.groupBy("gram").agg(F.sum(F.size("keys")).alias("n")), f"{folder}/grams")
    return Index(folder, texts, postings, n)


def opened(spark: SparkSession, folder: str) -> Index:
    """An index that was built before."""
    return Index(folder, *[spark.read.parquet(f"{folder}/{k}") for k in ("texts", "postings", "grams")])


def pieces(query: str) -> list[str]:
    """The trigrams of a query in lower case, each once; of one of two characters itself."""
    q = query.lower()
    return list(dict.fromkeys(q[i : i + SIZE] for i in range(max(1, len(q) - SIZE + 1))))


def candidates(index: Index, query: str) -> DataFrame:
    """(key) of the texts that hold every trigram of query (of two characters: both in a row). Posting lists only are read, no text.

    The rarest trigram comes first: where it has no list, no other list is
    read. Lists of one stretch are intersected from the shortest on.
    """
    wanted = pieces(query)
    none = index.postings.select(F.explode("keys").alias("key")).where(F.lit(False))
    if len(query) < SIZE:
        begins = index.postings.where(F.col("gram").startswith(wanted[0]) & (F.col("gram") >= wanted[0]))
        return begins.select(F.explode("keys").alias("key")).distinct()
    n = {r["gram"]: r["n"] for r in index.grams.where(F.col("gram").isin(wanted)).collect()}  # as many rows as the query has characters
    if len(n) < len(wanted):
        return none
    rarest = sorted(wanted, key=lambda g: (n[g], g))
    own = index.postings.where(F.col("gram") == rarest[0])
    if len(rarest) > 1:
        others = index.postings.where(F.col("gram").isin(rarest[1:])).join(own.select("part"), "part", "left_semi")
        own = own.unionByName(others)
    lists = own.groupBy("part").agg(F.sort_array(F.collect_list(F.struct(F.size("keys").alias("n"), "gram", "keys"))).alias("ls")).where(F.size("ls") == len(rarest))
    both = F.aggregate(F.slice("ls", 2, len(rarest)), F.col("ls")[0]["keys"], lambda acc, x: F.array_intersect(acc, x["keys"]))
    return lists.select(F.explode(both).alias("key"))


def search(index: Index, query: str, shown: int = 300, least: int = 2) -> DataFrame:
    """(key, hit, at, total, candidates, snippet): the first hit of query in each text that has one, in the order of keys; the first ``shown`` only, a feature of the search, and how many there are. A query shorter than ``least`` finds nothing.

    Only candidates' texts are read: few ones by their keys, which the Parquet
    scan skips row groups by, more by a join.
    """
    q = query.lower()
    if len(query) < least:
        found, n = index.texts.where(F.lit(False)), 0
    else:
        among = candidates(index, query)
        few = [r["key"] for r in among.limit(BY_KEY + 1).collect()]
        if len(few) <= BY_KEY:
            found, n = index.texts.where(F.col("key").isin(few)) if few else index.texts.where(F.lit(False)), len(few)
        else:
            among = tables.written(among, tables.folder(among.sparkSession, "candidates"))
            found, n = index.texts.join(among, "key", "left_semi"), among.count()
    at = F.instr("lowered", q)
    found = found.where(at > 0)
    total = found.agg(F.count("*").alias("total"))
    top = found.orderBy("key").limit(shown).withColumn("hit", F.row_number().over(Window.orderBy("key")).cast("long"))
    return top.crossJoin(F.broadcast(total)).select("key", "hit", at.cast("long").alias("at"), "total", F.lit(n).cast("long").alias("candidates"), snippet(F.col("text"), at, F.lit(len(query))).alias("snippet"))  # total: one row
