"""Queries over edits, split lines, caches and angles."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import align, audit, stats, tables
from ..sources import cache
from .queries import RAW, query, raw_lines, t

#: Fragments of each text, (begin, length): the second overlaps the first, the fourth touches the third, the last is the first again.
FRAGMENTS = [(5, 12), (12, 10), (30, 6), (36, 8), (5, 12)]


@query(f"""with f as (select doc_id, text, i, substring(text, b, n) as old, '<' || i || substring(text, b, n) || '>' as new from documents, (values {', '.join(f"({i}, {b}, {n})" for i, (b, n) in enumerate(FRAGMENTS))}) as v(i, b, n) where length(text) >= 48),
o as (select *, (length(text) - length(replace(text, old, ''))) // length(old) = 1 as ok, instr(text, old)::bigint as pos, length(old) as n from f),
e as (select doc_id, any_value(text) as text, max(case when i = 0 and ok then new end) as a, max(case when i = 1 and ok then new end) as b, max(case when i = 2 and ok then new end) as c, max(case when i = 3 and ok then new end) as d, count(*) filter (ok) as oks from o group by doc_id),
z as (select doc_id, text, a, case when a is null then b end as b, c, d from e)
select doc_id as file, md5(substring(text, 1, 4) || coalesce(a || substring(text, 17, 13), substring(text, 5, 7) || coalesce(b, substring(text, 12, 10)) || substring(text, 22, 8)) || coalesce(c, substring(text, 30, 6)) || coalesce(d, substring(text, 36, 8)) || substring(text, 44)) as digest,
((a is not null)::int + (b is not null)::int + (c is not null)::int + (d is not null)::int)::bigint as applied, (5 - ((a is not null)::int + (b is not null)::int + (c is not null)::int + (d is not null)::int))::bigint as refused from z
union all select doc_id, md5(text), 0, 0 from documents where length(text) < 48""")
def edits_applied(spark, sf):
    """Five fragments of each text put in brackets: those that occur once and do not overlap."""
    files = t(spark, sf, "documents").select(F.col("doc_id").alias("file"), "text")
    each = F.explode(F.array(*[F.struct(F.lit(b).alias("at"), F.substring("text", b, n).alias("old"), F.concat(F.lit(f"<{i}"), F.substring("text", b, n), F.lit(">")).alias("new")) for i, (b, n) in enumerate(FRAGMENTS)])).alias("e")
    fragments = files.where(F.length("text") >= 48).select("file", each).select("file", "e.*")
    done = audit.applied(audit.settled(audit.edits(fragments, files)), files)
    return done.select("file", F.md5(F.col("text").cast("binary")).alias("digest"), "applied", "refused")


@query(f"""with {RAW}, w as (select doc_id as page, rank, text from raw where text <> ''), n as (select *, row_number() over (partition by page order by rank) as k from w)
select page, count(*) as lines, count(*) filter ((page + rank) % 5 = 0 and length(text) > 8) as joined, 0::bigint as differences from n group by page""")
def split_lines_rejoined(spark, sf):
    """Every line of a document, each fifth cut in three, put together again and compared."""
    want = raw_lines(spark, sf).where("text <> ''").select(F.col("doc_id").alias("page"), "rank", "text")
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    cut = F.array(F.substring("text", F.lit(1), third), F.substring("text", third + 1, third + 1), F.substring("text", 2 * third + 2, n))
    pieces = F.posexplode(F.when(((F.col("page") + F.col("rank")) % 5 == 0) & (n > 8), cut).otherwise(F.array("text"))).alias("j", "text")
    have = want.select("page", "rank", pieces).select("page", (F.col("rank") * 4 + F.col("j")).alias("rank"), "text")
    got = align.rejoined(want, have, ["page"])
    own = want.withColumn("rank", F.row_number().over(Window.partitionBy("page").orderBy("rank")).cast("long"))
    compared = align.by_rank(own, got, ["page", "rank"])
    joined = got.groupBy("page").agg(F.count("*").alias("lines"), F.count_if(F.col("pieces") > 1).alias("joined"))
    return joined.join(compared.groupBy("page").agg(F.count_if(~F.col("same")).alias("differences")), "page").select("page", "lines", "joined", "differences")


@query("""select 1 as run, count(*) as computed, 0::bigint as kept, 0::bigint as removed, count(distinct page_id % 64) as rewritten from pages union all select 2, 0, count(*), 0, 0 from pages
union all select 3, count(*) filter (page_id % 90 = 7 and page_id % 50 <> 3), count(*) filter (page_id % 90 <> 7 and page_id % 50 <> 3), count(*) filter (page_id % 50 = 3), count(distinct case when page_id % 90 = 7 or page_id % 50 = 3 then page_id % 64 end) from pages""")
def leaf_cache(spark, sf):
    """Pages computed once, again without a change, and again after some were changed and some taken out: what each run did."""
    p, path = t(spark, sf, "pages").select("page_id", "url", "html"), tables.folder(spark, "leaves")
    compute = lambda d: d.select("page_id", F.length("html").alias("size"), F.md5(F.col("html").cast("binary")).alias("digest"))
    changed = p.where("page_id % 50 <> 3").withColumn("html", F.when(F.col("page_id") % 90 == 7, F.concat("html", F.lit("<p>more"))).otherwise(F.col("html")))
    runs = [tables.written(cache.refresh(x, "page_id", compute, path).select(F.lit(i).alias("run"), "*"), tables.folder(spark, "run")) for i, x in enumerate((p, p, changed), 1)]
    return runs[0].unionByName(runs[1]).unionByName(runs[2])


_HOUR = "(((event_id * 37) % 1440) / 4.0)"


@query(f"""with a as (select user_id, 12 * radians({_HOUR}) as z from events) select user_id, round(((degrees(atan2(sum(sin(z)), sum(cos(z)))) / 12) % 30 + 30) % 30, 3) as mean, round(sqrt(sum(cos(z)) ** 2 + sum(sin(z)) ** 2) / count(*), 5) as concentration, count(*) as n from a group by user_id""")
def circular_means(spark, sf):
    """Minutes of a day as angles, twelve times around."""
    d = t(spark, sf, "events").withColumn("angle", (F.col("event_id") * 37) % 1440 / F.lit(4.0))
    return stats.circular_mean(d, F.col("angle"), ["user_id"], 12).select("user_id", F.round("mean", 3).alias("mean"), F.round("concentration", 5).alias("concentration"), "n")


@query()
def extremes_apart(spark, sf):
    """For each type of event the six greatest values more than 25 degrees apart."""
    d = t(spark, sf, "events").withColumn("angle", (F.col("event_id") * 37) % 1440 / F.lit(4.0))
    return stats.apart(d, "angle", "value", ["event_type"])
