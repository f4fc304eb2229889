"""Queries over pages: what a reader of pages makes of them, notes, and words set off by braces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import audit, braces, corpus, machine
from .queries import LINES, lines, query, raw_lines, t


def page_events(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as pages of four lines: a text that goes on over ends of pages, with headings, skips, asterisms, rows and full lines here and there."""
    d = raw_lines(spark, sf)
    n, r = F.col("doc_id") + F.col("rank"), F.col("rank")
    text = F.trim("text")
    symbol = F.when(text == "", F.lit(machine.BLANK)).when(text.rlike(r"^[0-9]"), F.lit(machine.NUMBERED)).otherwise(F.lit(machine.TEXT))
    at = lambda when, s, x=None: F.when(when, F.struct(F.lit(s).alias("symbol"), (F.lit(None) if x is None else x).cast("string").alias("text")))
    own = F.array_compact(F.array(
        at(r % 4 == 1, machine.PAGE), at(n % 13 == 0, machine.ASTERISM), at(n % 11 == 0, machine.HEADING, F.substring(text, 1, 20)), at(n % 17 == 0, machine.CENTRED, F.lit("* * *")),
        at(n % 7 == 0, machine.SKIP), at(n % 10 == 3, machine.GOES_ON), at(n % 9 == 0, machine.ROW, F.substring(text, 1, 30)), F.struct(symbol.alias("symbol"), text.alias("text")),
        at(text.endswith("."), machine.BLANK), at((r % 4 == 0) & (n % 3 == 0), machine.FULL),
    ))
    every = d.select("doc_id", "rank", F.posexplode(own).alias("j", "e"))
    every = every.select("doc_id", (F.col("rank") * 16 + F.col("j")).alias("k"), F.floor((F.col("rank") - 1) / 4).alias("page"), "e.*")
    last = d.groupBy("doc_id").agg(F.max("rank").alias("rank")).select("doc_id", ((F.col("rank") + 1) * 16).alias("k"), F.floor((F.col("rank") - 1) / 4).alias("page"), F.lit(machine.PAGE).alias("symbol"), F.lit(None).cast("string").alias("text"))
    return every.unionByName(last)


@query()
def page_machine(spark, sf):
    return machine.pages(page_events(spark, sf))


@query(f"""with {LINES}, n as (select doc_id, rank as k, (rank - 1) // 6 as page, (rank - 1) % 6 = 0 as first, case when (doc_id + rank) % 4 = 0 then doc_id + rank end as mark, text from lines),
c as (select *, max(case when mark is not null then k end) over w as note from n window w as (partition by doc_id order by k)), p as (select *, max(case when mark is not null or not first then k end) over (partition by doc_id order by k) as para from c where note is not null),
s as (select *, lag(text) over (partition by doc_id, note, para order by k) as prev from p), g as (select doc_id, note, para, string_agg(case when prev is null then '' when regexp_matches(rtrim(prev), '[-‑]$') then '' else ' ' end || text, '' order by k) as text from s group by all)
select g.doc_id, note, (doc_id + note) as mark, count(*) as n_paras, string_agg(text, chr(10) || chr(10) order by para) as text from g group by g.doc_id, note""")
def page_notes(spark, sf):
    """Every line a paragraph of a note block, six a page; each fourth opens a note."""
    k = F.col("k")
    d = lines(spark, sf).withColumnRenamed("rank", "k")
    mark = F.when((F.col("doc_id") + k) % 4 == 0, F.col("doc_id") + k)
    return machine.page_notes(d.select("doc_id", "k", F.floor((k - 1) / 6).alias("page"), ((k - 1) % 6 == 0).alias("first"), mark.alias("mark"), "text"))


#: Shapes of marked words: nested, with braces that close more or less than was opened, and with other commands.
SHAPES = {0: (r"\VUgras{a \textit{b} c} d", "bold italic bold roman"), 1: (r"a } \textsc{b {c} d} c", "roman italic italic roman roman"), 2: (r"\textit {a \other{b} \} c", "italic italic roman")}
_LETTERS = {k: [x for x in shape.replace(r"\VUgras", " ").replace(r"\textit", " ").replace(r"\textsc", " ").replace(r"\other", " ") if x in "abcd"] for k, (shape, _) in SHAPES.items()}
_SHAPED = " ".join(f"when {k} then [{', '.join(f'''struct_pack(word := {x}, cls := '{c}')''' for x, c in zip(_LETTERS[k], SHAPES[k][1].split(), strict=True))}]" for k in SHAPES)


@query(f"""with {LINES}, w as (select doc_id, rank, regexp_extract_all(text, '[A-Za-zÀ-ÿ]+') as ws from lines), v as (select doc_id, rank, ws[1] as a, ws[2] as b, ws[3] as c, ws[4] as d from w where len(ws) > 3 and array_to_string(ws[1:4], '') not like '%×%' and array_to_string(ws[1:4], '') not like '%÷%'),
e as (select doc_id, rank, case rank % 3 {_SHAPED} end as es from v) select doc_id, rank, i::bigint as nth, x.word, x.cls from (select doc_id, rank, unnest(es) as x, generate_subscripts(es, 1) as i from e)""")
def braced_words(spark, sf):
    """The first four words of every line, marked in the shape of its turn."""
    ws = T.words(F.col("text"))
    d = lines(spark, sf).select("doc_id", "rank", ws.alias("ws")).where((F.size("ws") > 3) & ~F.array_join(F.slice("ws", 1, 4), "").rlike("[×÷]"))

    def marked(shape: str):
        parts = [F.col("ws")["abcd".index(x)] if x in "abcd" and (i == 0 or shape[i - 1] in " {") and (i + 1 == len(shape) or shape[i + 1] in " }{") else F.lit(x) for i, x in enumerate(shape)]
        return F.concat(*parts)

    text = F.when(F.col("rank") % 3 == 0, marked(SHAPES[0][0])).when(F.col("rank") % 3 == 1, marked(SHAPES[1][0])).otherwise(marked(SHAPES[2][0]))
    return d.select("doc_id", "rank", F.posexplode(T.emphasised_by_braces(text)).alias("nth", "e")).select("doc_id", "rank", (F.col("nth") + 1).cast("long").alias("nth"), "e.*")


def order_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as tables, a row for each line item: flags with dots behind them, braces as high as quantities have it, and one that closes; null where a cell is left out."""
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    d = t(spark, sf, "lineitem").withColumn("n", F.row_number().over(w))  # numbers of line items are not unique in the tables
    n, q = F.col("n"), F.col("l_quantity").cast("int")
    cell = lambda when, x, kind, text, height=F.lit(0.0), gap=F.lit(0.0): F.when(when, F.struct(F.lit(float(x)).alias("x"), F.lit(kind).cast("string").alias("kind"), height.cast("double").alias("height"), gap.cast("double").alias("gap"), text.alias("text")))
    brace = lambda when, x, kind: cell(when, x, kind, F.lit(""), (q % 4) * 4, F.col("l_partkey") % 3 * 2 - 2)
    word, dot, always = F.concat("l_returnflag", n.cast("string")), F.lit("."), F.lit(True)
    own = F.array(
        cell(always, 10, None, word), cell(q % 5 == 0, 12, None, dot), cell(q % 5 == 0, 14, None, dot), brace(n % 2 == 1, 20, braces.OPEN), cell(always, 30, None, F.col("l_linestatus")),
        brace(n % 3 == 2, 40, braces.OPEN), brace((n == 4) & (q % 2 == 0), 45, braces.UP), cell(always, 50, None, word), brace((n == 2) & (q % 2 == 0), 60, braces.CLOSE), cell(q % 3 > 0, 70, None, word),
    )
    return d.select(F.col("l_orderkey").alias("table"), (n - 1).alias("row"), own.alias("cells"))


@query()
def table_groups(spark, sf):
    found = braces.row_groups(order_rows(spark, sf), 4.0)
    return found.select("table", "row", "x", "kind", "title", "title_row", "parent", "closed_by", F.array_join(F.col("covered").cast("array<string>"), ",").alias("covered"))


@query(r"""with f as (select doc_id, replace(replace(text, '. ', '.' || chr(10)), chr(10) || chr(10), chr(12) || chr(10)) as t from documents), p as (select doc_id, unnest(string_split(t, chr(12))) as t, generate_subscripts(string_split(t, chr(12)), 1)::bigint as page from f),
l as (select doc_id, page, unnest(string_split(t, chr(10))) as x, generate_subscripts(string_split(t, chr(10)), 1) as i from p), s as (select doc_id, page, i, regexp_replace(x, '^\s+|\s+$', '', 'g') as text from l)
select doc_id, page, row_number() over (partition by doc_id, page order by i) as rank, text from s where length(text) > 1 and not regexp_matches(text, '^\*+$') and (regexp_matches(text, '[\p{L}\p{N}]') or regexp_matches(text, '^[. ]+$'))""")
def text_pages(spark, sf):
    """Documents with a line for each sentence and a page for each paragraph."""
    paged = F.replace(F.replace("text", F.lit(". "), F.lit(".\n")), F.lit("\n\n"), F.lit("\f\n"))
    return audit.text_pages(t(spark, sf, "documents").select("doc_id", paged.alias("text")))


@query(f"""with {LINES}, c as (select doc_id, rank, text, last_value(case when rank % 6 = 1 then rank // 6 + 1 end ignore nulls) over (partition by doc_id order by rank rows unbounded preceding) as leaf from lines)
select doc_id, rank, left(text, 30) as title, leaf from c where (doc_id + rank) % 11 = 0""")
def titles_on_leaves(spark, sf):
    """Lines as titles, each with the leaf whose mark was seen last."""
    r = F.col("rank")
    d = corpus.carried(lines(spark, sf), F.when(r % 6 == 1, F.floor(r / 6) + 1), ["doc_id"], "rank", "leaf")
    return d.where((F.col("doc_id") + r) % 11 == 0).select("doc_id", "rank", F.substring("text", 1, 30).alias("title"), "leaf")
