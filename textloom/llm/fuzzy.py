"""Near-duplicates by SimHash fingerprints and Golay-code fuzzy hashing.

A fingerprint of 64 bits is cut into three segments. Two fingerprints that
differ in two bits at most leave one segment as it is, and of the two others
each one or one both: whichever it is, there is a segment without an error
whose predecessor (in a ring) has one error at most. So a key is a segment as
it stands, with the index of a Golay codeword near the segment before it;
fingerprints within the radius share a key. Keys that several fingerprints have
are buckets, whose pairs are verified.

Pairs are made in small buckets only. For the fingerprints of large ones there
is another exact way, whose work is in proportion to their number: two of them
differ in two bits at most if, and only if, some word is within one bit of
both, so each names its 65 words, and all that name the same word are linked to
the least of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import joins
from . import common, fingerprints, golay, graph

WIDTH = 3
#: The bits of the three segments, from the highest on, of which none is longer than a codeword.
SEGMENTS = (22, 21, 21)
#: The differing bits that link two fingerprints; segments and midpoints are made for this number.
RADIUS = 2
#: Distinct fingerprints of a bucket whose pairs are compared directly.
SMALL = 64
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shingle_hashes(text: Column) -> Column:
    """XXH64, with seed 42, of each run of three words joined by spaces, A-Z lower-cased; of fewer words, of all of them; of none, nothing."""
    words = F.filter(F.split(F.translate(text, _UPPER, _UPPER.lower()), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    two = lambda ws: F.zip_with(ws, F.slice(ws, 2, F.greatest(F.size(ws), F.lit(1))), lambda a, b: F.concat(a, F.lit(" "), b))
    three = lambda ws: F.zip_with(two(ws), F.slice(ws, 3, F.greatest(F.size(ws), F.lit(1))), lambda a, b: F.xxhash64(F.concat(a, F.lit(" "), b)))
    own = lambda ws: F.when(F.size(ws) >= WIDTH, F.slice(three(ws), 1, F.greatest(F.size(ws) - (WIDTH - 1), F.lit(1)))).when(F.size(ws) > 0, F.array(F.xxhash64(F.array_join(ws, " ")))).otherwise(F.array().cast("array<bigint>"))
    return F.element_at(F.transform(F.array(words), own), 1)  # the words are a lambda's variable, so they are cut once


def prints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every row; a null text counts as empty, without words the fingerprint is zero. A text's hashes are counted where it lies; a row of sums for each text and 16,384 shingles is shuffled."""
    rows = common.texts(docs).withColumn("_row", F.monotonically_increasing_id())
    return fingerprints.simhash(rows, ["_row", "doc_id"], of=shingle_hashes).select("doc_id", "fingerprint")


def fuzzy_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, key): the keys of fingerprints (64-bit integers without sign), with the fingerprint's place."""
    at, parts = 64, []
    for bits in SEGMENTS:
        at -= bits
        parts.append((words >> np.uint64(at)).astype(np.int64) & (1 << bits) - 1)
    out = []
    for t, fuzzy in enumerate(parts):
        exact = parts[(t + 1) % len(parts)]
        i, index = golay.keys(fuzzy)
        out.append((i, (t << max(SEGMENTS) | exact[i]) << golay.DATA | index))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        own = b.column("fingerprint").to_numpy()
        i, key = fuzzy_keys(own.view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(own[i]), pa.array(key)], ["fingerprint", "key"])


def links(distinct: DataFrame, folder: str, small: int = SMALL) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints (``fingerprint``) that differ in RADIUS bits at most: enough of them that all that are linked are connected."""
    spark = distinct.sparkSession
    common.ready(spark)
    keyed = common.written(distinct.select("fingerprint").mapInArrow(common.tidy(_keyed), "fingerprint long, key long"), f"{folder}/keys")
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    met = common.written(keyed.join(sizes, "key"), f"{folder}/buckets")
    common.removed(spark, f"{folder}/keys")
    near = lambda a, b: (b > a) & (F.bit_count(a.bitwiseXOR(b)) <= RADIUS)
    xs = F.collect_list("fingerprint")  # small at most
    pairs = F.flatten(F.transform("_x", lambda a: F.transform(F.filter("_x", lambda b: near(a, b)), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    verified = met.where(F.col("n") <= small).groupBy("key").agg(xs.alias("_x")).select(F.explode(pairs).alias("_p")).select("_p.*").distinct()
    crowd = met.where(F.col("n") > small).select("fingerprint").distinct()
    word = F.explode(F.concat(F.array("fingerprint"), F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.col("fingerprint").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))))).alias("word")
    named = crowd.select("fingerprint", word).groupBy("word").agg(F.collect_list("fingerprint").alias("_x")).where(F.size("_x") > 1)  # 65 at most
    stars = named.select(F.array_min("_x").alias("a"), F.explode("_x").alias("b")).where("a <> b").distinct()
    return verified.unionByName(stars)


def components(found: DataFrame, small: int = SMALL) -> DataFrame:
    """found (doc_id, fingerprint) with ``component_id``, the smallest doc_id that links lead to. Equal fingerprints are one, however many rows have them; frequent ones are looked up in a bounded map, so that no task holds all rows of one."""
    spark = found.sparkSession
    folder = common.shared_folder(spark)
    found = common.written(found, f"{folder}-prints")
    distinct = common.written(found.groupBy("fingerprint").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), f"{folder}/distinct")
    roots = graph.components(links(distinct, folder, small), f"{folder}/rounds").withColumnRenamed("node", "fingerprint")
    whole = distinct.join(roots, "fingerprint", "left").select("fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))
    of = whole.groupBy("root").agg(F.min("least").alias("component_id"))
    member = common.written(joins.looked_up(whole.select("fingerprint", "root"), of, ["root"]).drop("root"), f"{folder}/members")
    out = common.written(joins.looked_up(found, member, ["fingerprint"], distinct.select("fingerprint", "n")), f"{folder}-joined")
    for path in (folder, f"{folder}-prints"):
        common.removed(spark, path)
    return out


def join(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 lowercase hex digits) and component_id.

    A null text counts as empty; texts without words all have fingerprint zero
    and are linked like any others. Repeated rows and ids give a row each, by
    their own texts; a null id is never a component's, unless no row of it has
    an id. A very long text is one row, its sums come in parts. An empty table
    gives an empty result; other columns are not looked at.
    """
    text = F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint")
    return components(prints(docs)).select("doc_id", text, "component_id")
