"""Checks of a corpus. Each is a function to findings (check, severity, page, line, message); a check that fails is a finding, and what cannot be judged is counted."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import syllables
from ..functions.text import WORD, strip
from . import joins, tables

FINDINGS = "check string, severity string, page long, line long, message string"
NO_START = {"space_before": ":;!?", "closing": ",.)]}»"}


def findings(rows: DataFrame, check: str, message: Column, severity: str = "failure") -> DataFrame:
    return rows.select(F.lit(check).alias("check"), F.lit(severity).alias("severity"), F.col("doc_id").cast("long").alias("page"), F.col("rank").cast("long").alias("line"), message.alias("message"))


def starts(lines: DataFrame, check: str, forbidden: str, row: Column | None = None) -> DataFrame:
    """Lines but a page's first, not empty and no rows of a table (for which ``row`` holds), that open with a forbidden character."""
    first = F.substring(F.ltrim("text"), 1, 1)
    bad = lines.where((F.col("rank") > 1) & (F.col("text") != "") & first.isin(list(forbidden)))
    bad = bad if row is None else bad.where(~F.coalesce(row, F.lit(False)))
    return findings(bad, check, F.concat(F.lit("opens with "), first))


def is_junk(t: Column) -> Column:
    """A character or none, asterisks, or no letter or digit unless all are dots."""
    return (F.length(t) <= 1) | t.rlike(r"^\*+$") | (~t.rlike(r"(?U)[\p{L}\p{N}]") & ~t.rlike(r"^[. ]+$"))


def junk(lines: DataFrame) -> DataFrame:
    """Lines that are junk."""
    return lines.where(is_junk(F.col("text")))


def text_pages(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, page, rank, text): the lines of a text whose pages end with form feeds, stripped, without junk (see junk); ranks and pages from 1, a rank for each line that stays. Pages are cut in the row; one without a line that stays is in no row."""
    pages = docs.select(doc, F.posexplode(F.split(text, "\f")).alias("page", "_t"))
    kept = F.filter(F.transform(F.split("_t", "\n"), strip), lambda t: ~is_junk(t))
    d = pages.select(doc, (F.col("page") + 1).cast("long").alias("page"), F.posexplode(kept).alias("rank", "text"))
    return d.withColumn("rank", (F.col("rank") + 1).cast("long"))


def seams(lines: DataFrame, physical: bool, by: list[str] = ["doc_id"], order: list[str] = ["rank"]) -> DataFrame:  # noqa: B006
    """lines with ``left`` and ``right``, the last word of each and the first of the next line within by: the physical next line, or the next that is not empty. A book's running text and its notes are two flows, which go on from page to page: by names book and flow, order page and line."""
    rows = lines if physical else lines.where("text <> ''")
    d = rows.withColumns({"left": F.regexp_extract("text", f"({WORD})$", 1), "_first": F.regexp_extract("text", f"^({WORD})", 1)})  # words, not texts, meet in the window
    nxt = F.lead("_first").over(Window.partitionBy(*by).orderBy(*order))
    return d.withColumn("right", F.coalesce(nxt, F.lit(""))).drop("_first")


def lost_hyphens(lines: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Line ends whose two words welded are a known word while one of them is rare (once at most). The lexicon is written once, as three look-ups read it. The welded word is looked up first, which few line ends pass; frequent words are looked up in a bounded map, so that no task gets all lines that end or begin with one."""
    s = seams(lines, True).where("left <> '' and right <> ''").withColumns({"left": F.lower("left"), "right": F.lower("right")}).withColumn("welded", F.concat("left", "right"))
    folder = tables.folder(lines.sparkSession, "hyphens")
    known = tables.written(lexicon.select("word", "n"), f"{folder}/lexicon")
    d = tables.written(s.join(known.select(F.col("word").alias("welded")), "welded", "left_semi"), f"{folder}/welded")
    for side in ("left", "right"):
        own = known.select(F.col("word").alias(side), F.col("n").alias(f"n_{side}"))
        d = joins.looked_up(d, own, [side], own.select(side, F.col(f"n_{side}").alias("n")))
    return d.where((F.coalesce("n_left", F.lit(0)) <= 1) | (F.coalesce("n_right", F.lit(0)) <= 1)).select("doc_id", "rank", "left", "right", "welded")


def bad_breaks(lines: DataFrame, broken: Column, by: list[str] = ["doc_id"], order: list[str] = ["rank"]) -> DataFrame:  # noqa: B006
    """Broken words (lines for which ``broken`` holds) divided where no break is allowed; a word goes on in the next line that is not empty, of the same flow, on a later page too (see seams)."""
    s = seams(lines, False, by, order).where(broken).withColumns({"left": F.lower("left"), "right": F.lower("right")})
    return s.withColumn("fault", syllables.fault(F.col("left"), F.col("right"))).where("fault is not null").select(*dict.fromkeys([*by, *order]), "left", "right", "fault")


def witnesses(rules: DataFrame, files: DataFrame) -> DataFrame:
    """rules (label, file, literal, least) against files (file, text): found, and a status of ok, too few, or missing file. A null literal only wants the file."""
    n = F.when(F.col("literal").isNull(), F.lit(0)).otherwise(F.floor((F.length("text") - F.length(F.replace("text", F.col("literal"), F.lit("")))) / F.length("literal"))).cast("long")
    d = rules.join(files, "file", "left").withColumn("found", n)
    status = F.when(F.col("text").isNull(), "missing file").when(F.col("literal").isNull() | (F.col("found") >= F.col("least")), "ok").otherwise("too few")
    return d.select("label", "file", F.coalesce("found", F.lit(0)).alias("found"), status.alias("status"))


def tolerated(checks: dict[str, Callable[[], DataFrame]], spark: SparkSession) -> DataFrame:
    """The findings of all checks, each run to a table of its own. One that fails, when it is built or when it runs, gives a finding of itself, and the others go on."""
    out, folder = spark.createDataFrame([], FINDINGS), tables.folder(spark, "findings")
    for i, (name, make) in enumerate(checks.items()):
        try:
            found = tables.written(make(), f"{folder}/{i}")
        except Exception as e:  # noqa: BLE001
            found = spark.createDataFrame([(name, "failure", None, None, f"{type(e).__name__}: {e}"[:200])], FINDINGS)
        out = out.unionByName(found)
    return out


def report(findings: DataFrame) -> DataFrame:
    return findings.groupBy("check", "severity").agg(F.count("*").alias("n"))


def lengths(lines: DataFrame, low: float, high: float) -> DataFrame:
    """(doc_id, judged, not_judged, odd): lines whose length is outside low to high times their document's median; documents with fewer than four lines are not judged, and say so."""
    g = lines.groupBy("doc_id").agg(F.median(F.length("text")).alias("m"), F.count("*").alias("n"))
    d = lines.join(g, "doc_id")
    odd = (F.length("text") < F.col("m") * low) | (F.length("text") > F.col("m") * high)
    return d.groupBy("doc_id").agg(F.count_if(F.col("n") >= 4).alias("judged"), F.count_if(F.col("n") < 4).alias("not_judged"), F.count_if(odd & (F.col("n") >= 4)).alias("odd"))


def edits(fragments: DataFrame, files: DataFrame) -> DataFrame:
    """fragments (file, old, new) as an edit list (file, pos, old, new, status), last position first within a file: applied if old occurs once, refused if not. Occurrences are counted without overlaps, so old may lie at several overlapping places: the first is taken or, where fragments say at which character they were found (at, from 1), that one."""
    n = F.floor((F.length("text") - F.length(F.replace("text", F.col("old"), F.lit("")))) / F.nullif(F.length("old"), F.lit(0)))
    d = fragments.join(files, "file", "left").withColumn("_n", F.coalesce(n, F.lit(0)))
    status = F.when(F.col("text").isNull(), "missing file").when(F.col("_n") == 1, "ok").when(F.col("_n") == 0, "absent").otherwise("not unique")
    first = F.call_function("instr", F.col("text"), F.col("old"))
    if "at" in fragments.columns:
        first = F.when(F.substring("text", F.col("at").cast("int"), F.length("old")) == F.col("old"), F.col("at")).otherwise(first)
    pos = F.when(F.col("_n") == 1, first).cast("long")
    return d.select("file", pos.alias("pos"), "old", "new", status.alias("status"))


def settled(listed: DataFrame) -> DataFrame:
    """An edit list (see edits) with what can be applied settled: of edits whose fragments overlap within a file the first by position (ties by the shorter fragment, then by old and new) stays ok, those that overlap one that stays are refused as ``overlap``. Fragments that touch do not overlap. One fold over a file's edits."""
    good = F.col("status") == "ok"
    own = F.struct("pos", F.length("old").alias("n"), "old", "new")
    begin = F.struct(F.lit(0).cast("bigint").alias("end"), F.array().cast("array<struct<pos:bigint,n:int,old:string,new:string,status:string>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        free = x["pos"] >= acc["end"]
        row = F.struct(x["pos"].alias("pos"), x["n"].alias("n"), x["old"].alias("old"), x["new"].alias("new"), F.when(free, "ok").otherwise("overlap").alias("status"))
        return F.struct(F.when(free, x["pos"] + x["n"]).otherwise(acc["end"]).alias("end"), F.concat(acc["out"], F.array(row)).alias("out"))

    d = listed.where(good).groupBy("file").agg(F.sort_array(F.collect_list(own)).alias("_xs"))
    d = d.select("file", F.explode(F.aggregate("_xs", begin, step)["out"]).alias("_x")).select("file", "_x.pos", "_x.old", "_x.new", "_x.status")
    return d.unionByName(listed.where(~good).select("file", "pos", "old", "new", "status"))


def applied(settled: DataFrame, files: DataFrame) -> DataFrame:
    """files (file, text) with the settled edits done: (file, text, applied, refused). The pieces between the fragments are taken from the text as it was, so no edit moves another; files without edits come back as they were."""
    own = settled.groupBy("file").agg(F.sort_array(F.collect_list(F.when(F.col("status") == "ok", F.struct("pos", F.length("old").alias("n"), "new")))).alias("_es"), F.count_if(F.col("status") == "ok").alias("applied"), F.count_if(F.col("status") != "ok").alias("refused"))
    d = files.join(own, "file", "left")
    begins = F.transform("_es", lambda e, i: F.when(i == 0, F.lit(1)).otherwise(F.get("_es", F.greatest(i - 1, F.lit(0)))["pos"] + F.get("_es", F.greatest(i - 1, F.lit(0)))["n"]))
    pieces = F.zip_with("_es", begins, lambda e, a: F.concat(F.substring("text", a.cast("int"), (e["pos"] - a).cast("int")), F.coalesce(e["new"], F.lit(""))))
    last = F.element_at("_es", -1)
    rest = F.substring("text", (last["pos"] + last["n"]).cast("int"), F.length("text"))
    text = F.when(F.size("_es") > 0, F.concat(F.array_join(pieces, ""), rest)).otherwise(F.col("text"))
    return d.select("file", text.alias("text"), F.coalesce("applied", F.lit(0)).cast("long").alias("applied"), F.coalesce("refused", F.lit(0)).cast("long").alias("refused"))


def compile_log(log: DataFrame) -> DataFrame:
    """Lines of a compile log (value) about boxes that are too full: (kind, points)."""
    m = lambda i: F.regexp_extract("value", r"Overfull \\(hbox|vbox) \((\d+(?:\.\d+)?)pt too (?:wide|high)\)", i)
    return log.where(m(1) != "").select(m(1).alias("kind"), m(2).cast("double").alias("points"))
