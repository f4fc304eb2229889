"""Line dedup by chunks of two lines each, in DataFrame functions only.

A line ends at a newline, or at a full stop with a space behind it (texts may
have whole paragraphs without a newline); white space around a line does not
count. A hash of the hashes of two neighbouring lines names the chunk
of both. Every such window is a chunk: a sparser choice of boundaries, by
values of such a hash, misses passages that are shorter than its chunks,
and a passage's first and last lines. So a chunk depends on what is inside it
only, and a repeated passage of two lines or more is covered by its own chunks,
wherever it stands. Chunks that occur again anywhere are removed, all but the
first occurrence in the order of (doc_id, line), after a comparison of their
lines' bytes. A line goes only where the same line stands earlier, so the first
occurrence of every line stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Stands at the ends of lines while a text is cut.
_MARK = "\x00"
_WHITE = " \t\n\x0b\x0c\r"


def with_lines(rows: DataFrame, text: str) -> DataFrame:
    """rows with ``_lines``, the lines of the column text, each with the white space behind it; joined, they are the text. Blank lines belong to the one before. Cut in steps, so that no step is worked out twice."""
    cut = F.split(F.replace(F.replace(F.col(text), F.lit("\n"), F.lit("\n" + _MARK)), F.lit(". "), F.lit(". " + _MARK)), _MARK)
    d = rows.withColumn("_cut", cut)
    # texts with blank lines, or with the mark itself, are cut by a slower pattern; the last part is empty where the text ends with a line's end
    blank = F.exists(F.slice("_cut", 1, F.size("_cut") - 1), lambda x: _bare(x) == "")
    last = _bare(F.element_at("_cut", -1))
    kind = F.when(F.contains(text, F.lit(_MARK)) | blank | ((last == "") & (F.element_at("_cut", -1) != "")), 2).when(F.element_at("_cut", -1) == "", 1).otherwise(0)
    slow = F.filter(F.split(text, r"(?=\S)(?:(?<=\n[ \t]{0,16})|(?<=\. {1,16}))"), lambda x: x != "")
    d = d.withColumn("_kind", kind)
    return d.withColumn("_lines", F.when(F.col("_kind") == 2, slow).when(F.col("_kind") == 1, F.slice("_cut", 1, F.size("_cut") - 1)).otherwise(F.col("_cut"))).drop("_cut", "_kind")


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(_WHITE))


def chunks(docs: DataFrame) -> DataFrame:
    """(_id, _row, chunks): for each line of a row but the last, the hash of its and the next one's hash; null where one of them is blank."""
    d = with_lines(docs.select("_id", "_row", "_text"), "_text")
    d = d.select("_id", "_row", F.transform("_lines", lambda x: F.nullif(F.xxhash64(_bare(x)), F.xxhash64(F.lit("")))).alias("_h"))
    rolling = F.zip_with("_h", F.slice("_h", 2, F.greatest(F.size("_h"), F.lit(1))), lambda a, b: F.when(a.isNotNull() & b.isNotNull(), F.xxhash64(a, b)))
    return d.select("_id", "_row", rolling.alias("chunks"))


def _cut(spans: str) -> Column:
    """Of each repeated chunk its lines' bytes: the first line's, and the second one's unless it is the first line of a chunk to be removed itself, and compared there."""
    line = lambda i: _bare(F.try_element_at("_lines", i + 1))

    def one(c: Column, i: Column) -> Column:
        after = F.try_element_at(spans, i + 2)
        covered = F.coalesce((after["start"] == c["start"] + 1) & ~after["first"], F.lit(False))
        return F.struct(c["hash"].alias("hash"), c["start"].alias("start"), c["first"].alias("first"), line(c["start"]).alias("one"), F.when(c["first"] | ~covered, line(c["start"] + 1)).alias("two"))

    return F.transform(spans, one)


def dedup_lines(docs: DataFrame, drop_emptied: bool = False) -> DataFrame:
    """docs with repeated chunks taken out of text (and n_chars counted again, where there is that column); all columns and rows stay, but with drop_emptied not the rows of whose text only white space is left.

    The first occurrence in the order of (doc_id, line) stays; a null id comes
    first. Null and empty texts stay as they are. Rows equal in id and text
    are one document and keep the same chunks. An empty table gives an empty
    result. A very long text is one row, in memory whole; its lines are cut and
    put together in time that grows with their number. The texts are shuffled
    once for both joins; hashes are counted with partial sums, so a chunk that
    most rows hold is no hot key, and a hot chunk's occurrences meet its one
    first occurrence in a join that may be split.
    """
    spark = docs.sparkSession
    columns = docs.columns
    keys = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)).cast("long")).alias("_id"), F.coalesce(F.col("text"), F.lit("")).alias("_text"))
    keys = keys.select("_id", F.xxhash64("_text").alias("_row"), "_text")
    folder = common.shared_folder(spark)
    index = common.written(chunks(keys), f"{folder}/chunks")
    each = index.select("_id", "_row", F.posexplode("chunks").alias("start", "hash")).where("hash is not null")
    # hashes alone are counted first, so that only chunks that occur again carry their places to a first occurrence
    again = common.written(each.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"), f"{folder}/hashes")
    each = common.written(each.join(again, "hash"), f"{folder}/again")
    common.removed(spark, f"{folder}/chunks")
    common.removed(spark, f"{folder}/hashes")
    firsts = common.written(each.groupBy("hash").agg(F.min(F.struct("_id", "_row", "start")).alias("at")), f"{folder}/firsts")
    first = F.struct("_id", "_row", "start") == F.col("at")
    seen = each.join(firsts, "hash").select("_id", "_row", F.struct("start", "hash", first.alias("first")).alias("c"))
    seen = seen.groupBy("_id", "_row").agg(F.array_sort(F.collect_set("c")).alias("spans"))
    cut = with_lines(keys.join(seen, ["_id", "_row"]), "_text").select("_id", "_row", "_lines", "spans")
    cut = cut.select("_id", "_row", F.explode(_cut("spans")).alias("c")).select("_id", "_row", "c.*")
    kept = cut.where("first").select("hash", F.col("one").alias("_one"), F.col("two").alias("_two")).dropDuplicates(["hash"])
    gone = cut.where("not first").join(kept, "hash").where("one = _one and (two is null or two = _two)")
    at = F.explode(F.when(F.col("two").isNull(), F.array("start")).otherwise(F.array(F.col("start"), F.col("start") + 1)))
    gone = gone.select("_id", "_row", at.alias("at")).groupBy("_id", "_row").agg(F.array_sort(F.collect_set("at")).alias("gone"))
    # a byte for each line, 1 where it goes, so that lines are looked up in one step
    mask = F.array_join(F.transform("gone", lambda g, i: F.concat(F.repeat(F.lit("0"), g - F.coalesce(F.try_element_at("gone", F.nullif(i, F.lit(0))), F.lit(-1)) - 1), F.lit("1"))), "").cast("binary")
    out = keys.join(gone.select("_id", "_row", mask.alias("_mask")), ["_id", "_row"], "left")
    goes = lambda i: F.substring("_mask", i + 1, F.lit(1)) == F.lit(b"1")
    # where a removed stretch ends a line of its text, the newline stays, unless it is the text's begin
    ends = lambda x, i: F.endswith(x, F.lit("\n")) & ~goes(i + 1) & (i + 1 < F.size("_lines"))
    out = with_lines(out.withColumn("_cuttable", F.when(F.col("_mask").isNotNull(), F.col("_text"))), "_cuttable")
    rest = F.array_join(F.transform("_lines", lambda x, i: F.when(~goes(i), x).when(ends(x, i), F.lit("\n")).otherwise("")), "")
    rest = F.when(goes(F.lit(0)), F.regexp_replace(rest, r"^\n", "")).otherwise(rest)
    out = out.select("_id", "_row", F.when(F.col("_mask").isNull(), F.col("_text")).otherwise(rest).alias("_new"), F.col("_mask").isNotNull().alias("_cut")).dropDuplicates(["_id", "_row"])
    others = docs.select(F.struct(F.lit(0), *[F.col(f"`{c}`") for c in columns if c != "text"]).alias("_d"), F.col("text").isNull().alias("_null"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)).cast("long")).alias("_id"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("_row"))
    whole = others.join(out, ["_id", "_row"])
    if drop_emptied:
        whole = whole.where(~F.col("_cut") | F.col("_new").rlike(r"\S"))
    new = {"text": F.when(~F.col("_null"), F.col("_new")).alias("text"), "n_chars": F.when(~F.col("_null"), F.length("_new").cast("long")).alias("n_chars")}
    return whole.select(*[new.get(c, F.col("_d").getField(c).alias(c)) for c in columns])
