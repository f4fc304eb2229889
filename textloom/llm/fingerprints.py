"""Document fingerprints by SimHash, in DataFrame functions only.

Terms are pairs of neighbouring words (and the last word by itself); a term
weighs as often as it occurs. Each term's 64-bit hash votes on every bit.
Votes are counted in four 16-bit lanes of one number, for at most 2**14 terms
at a time, so that sixteen sums count all 64 bits without overflow. Tables of
permuted blocks find every fingerprint within a Hamming radius.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations
from math import ceil, sqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

LANES, WIDE = 0x0001000100010001, 0x0000FFFF0000FFFF
#: Terms of one partial count; less than 2**15, so that no lane overflows.
SEGMENT = 14
RADIUS, BLOCKS = 3, 5
#: Ranges of a group are numbered below this.
_GROUP = 1 << 24


def terms(text: Column) -> Column:
    """The hashes of a text's pairs of neighbouring words, lower-cased, and of its last word."""
    words = F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.zip_with(hashes, F.slice(hashes, 2, F.greatest(F.size(hashes), F.lit(1))), lambda a, b: F.xxhash64(a, b))


def simhash(rows: DataFrame, keys: list[str], text: str = "text", of: Callable[[Column], Column] = terms) -> DataFrame:
    """keys and ``fingerprint`` (long) of rows with a text; keys tell the rows apart, of gives the hashes of a text's terms. A bit is set if more than half of the term weights set it; without terms, none is.

    If rows are dealt by some of the keys already, nothing is shuffled.
    """
    each = rows.select(*keys, F.posexplode_outer(of(F.col(text))).alias("_at", "_term"))
    each = each.withColumn("_segment", F.shiftright(F.col("_at"), SEGMENT))
    lanes = [F.sum(F.shiftrightunsigned("_term", i).bitwiseAND(F.lit(LANES))).alias(f"_s{i}") for i in range(16)]
    part = each.groupBy(*keys, "_segment").agg(F.count("_term").alias("_n"), *lanes)
    low = [F.sum(F.col(f"_s{i}").bitwiseAND(F.lit(WIDE))).alias(f"_a{i}") for i in range(16)]
    high = [F.sum(F.shiftrightunsigned(f"_s{i}", 16).bitwiseAND(F.lit(WIDE))).alias(f"_b{i}") for i in range(16)]
    whole = part.groupBy(*keys).agg(F.sum("_n").alias("_n"), *low, *high)
    bit = F.lit(0).cast("long")
    for i in range(16):
        for lane, source in enumerate((f"_a{i}", f"_b{i}", f"_a{i}", f"_b{i}")):
            votes = F.shiftrightunsigned(source, 32 * (lane // 2)).bitwiseAND(F.lit(0xFFFFFFFF))
            bit = bit.bitwiseOR(F.when(votes * 2 > F.col("_n"), F.shiftleft(F.lit(1).cast("long"), i + 16 * lane)).otherwise(F.lit(0).cast("long")))
    return whole.select(*keys, bit.alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """The cosine that the number of differing bits stands for, 0 at least: 1 for equal fingerprints, about 0 for texts without common terms."""
    return F.greatest(F.lit(0.0), F.cos(F.bit_count(a.bitwiseXOR(b)) * F.lit(3.141592653589793 / 64)))


def _ranges(d: DataFrame, per_bucket: int, most: int) -> DataFrame:
    """d with ``bucket`` and ``_next``: the range that ``_o`` is in, and at a range's largest id the range after it.

    Edges are ids that occur, found in two steps: quantiles of all ids make
    groups, quantiles in each group its ranges. Their number follows the table
    up to ``most``; the edges, 8 bytes each, go with the tasks, so they have at
    most 8 * most bytes.
    """
    k = max(1, min(most, ceil(d.count() / per_bucket)))
    step = max(1, ceil(sqrt(k)))
    at = [(i + 1) / step for i in range(step)]
    got = d.agg(F.percentile_approx("_o", at, max(10_000, 4 * step)).alias("p"), F.max("_o").alias("m")).first()
    groups = sorted({*(got["p"] or ()), *([] if got["m"] is None else [got["m"]])}) or [0]
    edges = F.array(*[F.lit(x).cast("long") for x in groups])
    below = lambda xs: F.size(F.filter(xs, lambda b: b < F.col("_o")))
    d = d.withColumn("_g", below(edges))
    inner = d.groupBy("_g").agg(F.array_sort(F.array_distinct(F.concat(F.percentile_approx("_o", at, max(1000, 4 * step)), F.array(F.max("_o"))))).alias("_edges"))
    d = d.join(F.broadcast(inner), "_g").withColumn("_i", below(F.col("_edges")))
    number = lambda g, i: g.cast("long") * _GROUP + i
    after = F.when(F.col("_i") + 1 < F.size("_edges"), number(F.col("_g"), F.col("_i") + 1)).otherwise(number((F.col("_g") + 1) % len(groups), F.lit(0)))
    edge = F.element_at("_edges", F.col("_i") + 1) == F.col("_o")
    return d.withColumn("bucket", number(F.col("_g"), F.col("_i"))).withColumn("_next", F.when(edge, after)).drop("_g", "_i", "_edges")


def with_next(docs: DataFrame, per_bucket: int = 400, most: int = 1 << 20) -> DataFrame:
    """(doc_id, text) with ``next_text``, the text that follows in descending order of ids, the first after the last; and ``bucket``, ``rank``, which tell the rows apart, and ``extra``.

    Ids are cut into ranges at ids that occur; the row with a range's largest
    id is copied into the next range as well (``extra``), so that one window
    for each range sees all neighbours, and no task sees all rows. Equal ids
    are ordered by their texts; a null id comes last.
    """
    d = common.texts(docs).withColumn("_o", F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)).cast("long")))
    d = _ranges(d, per_bucket, most)
    both = F.array(F.struct("bucket", F.lit(False).alias("extra")), F.struct(F.col("_next").alias("bucket"), F.lit(True).alias("extra")))
    d = d.select("doc_id", "text", "_o", F.explode(F.when(F.col("_next").isNotNull(), both).otherwise(F.slice(both, 1, 1))).alias("_p")).select("doc_id", "text", "_o", "_p.*")
    w = Window.partitionBy("bucket").orderBy("extra", F.desc("_o"), "text")
    return d.select("doc_id", "text", "bucket", "extra", F.row_number().over(w).alias("rank"), F.lead("text").over(w).alias("next_text"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint and edited_fingerprint (long), next_fingerprint.

    A null text counts as empty, an empty text has fingerprint 0; of equal ids
    each row counts by itself; an empty table gives an empty result; a single
    document is its own next; other columns are not looked at. The texts are
    shuffled once, by ranges of ids; everything else happens where they are. A
    very long text's terms are counted in segments; its row is in memory whole.
    """
    d = with_next(docs).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring("next_text", F.lit(1), half))
    d = d.withColumn("edited", F.when(F.col("extra"), F.lit("")).otherwise(F.coalesce(edited, F.lit(""))))
    own = ["bucket", "rank", "doc_id", "extra", "n_chars", "edited_sha256"]
    rows = d.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256)).select(*own, F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("text").alias("text")), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text")))).alias("_x")).select(*own, "_x.*")
    by = simhash(rows, [*own, "kind"]).groupBy(*own).agg(F.max(F.when(F.col("kind") == 0, F.col("fingerprint"))).alias("fingerprint"), F.max(F.when(F.col("kind") == 1, F.col("fingerprint"))).alias("edited_fingerprint"))
    w = Window.partitionBy("bucket").orderBy("rank")
    return by.withColumn("next_fingerprint", F.lead("fingerprint").over(w)).where(~F.col("extra")).drop("extra", "bucket", "rank")


def block_tables(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """prints (with ``fingerprint``) once for each choice of blocks - radius blocks: ``table``, and ``key``, the fingerprint with those blocks in front and the others cut off. Two fingerprints within the radius agree in some table's key. An empty table gives an empty result; repeated rows stay; a null fingerprint has null keys."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    rows = []
    for t, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum(((1 << (edges[b + 1] - edges[b])) - 1) << edges[b] for b in chosen)
        mask -= (1 << 64) * (mask >> 63)
        first = edges[chosen[0]]
        key = F.col("fingerprint").bitwiseAND(F.lit(mask))
        rows.append(F.struct(F.lit(t).alias("table"), F.shiftrightunsigned(key, first).bitwiseOR(F.shiftleft(key, (64 - first) % 64)).alias("key")))
    return prints.select("*", F.explode(F.array(*rows)).alias("_t")).select("*", "_t.*").drop("_t")


def blocks_for(prints: int, radius: int = RADIUS) -> int:
    """How many blocks to cut fingerprints into: so many that a key, of all but radius of them, has about as many values as there are fingerprints. More blocks make longer keys and more tables; all find the same."""
    blocks = radius + 2
    while 64 * (blocks - radius) // blocks < prints.bit_length() - 2:
        blocks += 1
    return blocks


def within(queries: DataFrame, prints: DataFrame, radius: int = RADIUS, blocks: int | None = None) -> DataFrame:
    """All pairs (query, fingerprint, distance) of distinct fingerprints within the radius: queries has ``query``, prints has ``fingerprint``. Equal fingerprints are one, so that a group of copies is one entry whatever its size; of empty tables there are no pairs; null fingerprints match nothing. Without a number of blocks it follows the number of prints."""
    blocks = blocks or blocks_for(prints.count(), radius)
    q = block_tables(queries.select(F.col("query").alias("fingerprint")).distinct(), radius, blocks).withColumnRenamed("fingerprint", "query")
    p = block_tables(prints.select("fingerprint").distinct(), radius, blocks)
    far = F.bit_count(F.col("query").bitwiseXOR(F.col("fingerprint")))
    return q.join(p, ["table", "key"]).where(far <= radius).select("query", "fingerprint", far.alias("distance")).distinct()
