"""The queries of this subpackage, by name, and the SQL of the one that has any; the others' results are hashes of vocabularies, learned scores or searches over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, centroids, common, decontaminate, fingerprints, fuzzy, jaccard, language, linededup, lm, negatives, quality, secrets, store


def op1_simhash_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


def op2_quality_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    model = quality.learn(docs, common.table(spark, sf_dir, "labels"), common.fold(4) != 2)
    scored = quality.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", (common.fold(4) == 2).alias("held_out"), "score", "predicted")


def op3_jaccard_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(common.table(spark, sf_dir, "documents"))


def op4_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(common.table(spark, sf_dir, "documents"), common.fold(7) == 2)


def op5_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    return linededup.dedup_lines(docs).select("doc_id", "n_chars", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def op6_language_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    trees = language.learn(docs.select("doc_id", "text", "lang").where(common.fold(3) != 1))
    return language.identify(docs, trees, common.fold(3) == 1)


def op7_content_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{common.shared_folder(spark)}/store"
    store.write(common.table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"))
    return store.read(spark, folder)


def op8_bpe_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(common.table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """near_docs: for ids divisible by 100, how many other documents have a fingerprint within the radius."""
    docs = common.table(spark, sf_dir, "documents")
    prints = common.written(fingerprints.fingerprints(docs), f"{common.shared_folder(spark)}/fingerprints")
    asked = prints.where("doc_id % 100 = 0").select(F.col("fingerprint").alias("query"))
    sizes = prints.groupBy("fingerprint").agg(F.count("*").alias("n"))
    near = fingerprints.within(asked, prints).join(sizes, "fingerprint").groupBy("query").agg(F.sum("n").alias("n"))
    # rows that are no queries go past the join: they have no key, and would all meet in one task
    is_asked = F.coalesce(F.col("doc_id") % 100 == 0, F.lit(False))
    out = prints.where(is_asked).join(near.withColumnRenamed("query", "fingerprint"), "fingerprint", "left")
    out = out.unionByName(prints.where(~is_asked).withColumn("n", F.lit(None).cast("long")))
    text = lambda c: F.lower(F.lpad(F.hex(c), 16, "0")).alias(c)
    like = lambda c: fingerprints.likeness(F.col("fingerprint"), F.col(c))
    return out.select("doc_id", "n_chars", "edited_sha256", text("fingerprint"), text("edited_fingerprint"), like("edited_fingerprint").alias("near_edited"), like("next_fingerprint").alias("near_next"), (F.col("n") - 1).alias("near_docs"))


def op10_secret_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_documents(common.table(spark, sf_dir, "documents"))
    joined = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    base = F.filter("spans", lambda x: x["kind"].isin(*secrets.BASE))
    of = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    counts = [of(kind).alias(f"n_{kind}") for kind in secrets.BASE]
    return found.select("doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op11_dual_tree_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = common.table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mined(rows.select("vec_id", label.alias("label"), "embedding"), F.col("vec_id") % 100 == 0)


def op12_golay_fuzzy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy.join(common.table(spark, sf_dir, "documents"))


def op13_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clustered(common.table(spark, sf_dir, "embeddings"))


def edited_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can say of op9_simhash."""
    return fingerprints.fingerprints(common.table(spark, sf_dir, "documents")).select("doc_id", "n_chars", "edited_sha256")


def secret_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can say of op10_secret_automaton."""
    return op10_secret_automaton(spark, sf_dir).select("doc_id", "n_assign", "n_access", "n_hex")


def base_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can say of op4_deleted_interpolation."""
    return op4_deleted_interpolation(spark, sf_dir).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 6).alias("base_score"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}
    return own | {f.__name__: f for f in (edited_texts, secret_counts, base_scores)}


#: Pairs by shared shingles, links by the contract's rule, components by reachability.
OP3_SQL = r"""with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from documents),
s as (select distinct doc_id, unnest(case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')] else list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) end) as g from w),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as x, b.doc_id as y, count(*) as c from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by all),
e as (select x, y from p join n a on a.doc_id = x join n b on b.doc_id = y where 100 * c >= 75 * (a.n + b.n - c)),
both_ways as (select x, y from e union all select y, x from e),
reach(doc_id, other) as (select doc_id, doc_id from w union select reach.doc_id, b.y from reach join both_ways b on reach.other = b.x)
select w.doc_id, coalesce(n.n, 0)::bigint as n_shingles, r.component_id from w left join n using (doc_id) join (select doc_id, min(other) as component_id from reach group by doc_id) r using (doc_id)"""


#: Lines by the rule, pairs of neighbours that are not blank, the first of each by id and line; what others cover goes.
OP5_SQL = r"""with l as (select doc_id, regexp_extract_all(coalesce(text, ''), '(?s).*?(?:\n|\. )[ \t\n\x0b\x0c\r]*|.+$') as xs from documents),
e as (select doc_id, unnest(xs) as x, generate_subscripts(xs, 1) as i from l), t as (select *, trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as a from e),
p as (select *, lead(a) over (partition by doc_id order by i) as b from t),
q as (select doc_id, i, row_number() over (partition by a, b order by doc_id, i) as nth from p where a <> '' and b <> ''),
g as (select distinct doc_id, unnest([i, i + 1]) as i from q where nth > 1), m as (select e.*, g.i is not null as gone from e left join g on e.doc_id = g.doc_id and e.i = g.i),
w as (select *, coalesce(not lead(gone) over (partition by doc_id order by i), false) as stays, coalesce(sum((not gone)::int) over (partition by doc_id order by i rows between unbounded preceding and 1 preceding), 0) as before from m),
n as (select doc_id, string_agg(case when not gone then x when ends_with(x, chr(10)) and stays and before > 0 then chr(10) else '' end, '' order by i) as text from w group by doc_id)
select doc_id, length(coalesce(n.text, ''))::bigint as n_chars, sha256(coalesce(n.text, '')) as text_sha256 from l left join n using (doc_id)"""

EDITED_SQL = """with d as (select doc_id, coalesce(text, '') as text from documents), n as (select *, coalesce(lead(text) over w, first_value(text) over (order by doc_id desc rows between unbounded preceding and unbounded following)) as nxt, length(text) as n from d window w as (order by doc_id desc))
select doc_id, n::bigint as n_chars, sha256(left(text, n - n // 2) || left(nxt, n // 2)) as edited_sha256 from n"""

SECRET_SQL = r"""with d as (select doc_id, coalesce(text, '') as text from documents) select doc_id,
len(list_filter(regexp_extract_all(text, '((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2), lambda x: length(x) >= 12))::bigint as n_assign,
len(list_filter(regexp_extract_all(text, 'AKIA[A-Z0-9]+'), lambda x: length(x) >= 18))::bigint as n_access, len(list_filter(regexp_extract_all(text, '[0-9a-f]+'), lambda x: length(x) >= 16))::bigint as n_hex from d"""

#: All anchors with all rows, the windows of positives, and what falls into each.
OP11_SQL = """with v as (select vec_id, (case when vec_id % 7 = 0 then (label + 1) % 10 else label end)::bigint as label, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as a, b.vec_id as b, a.label = b.label as same, list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i]))::bigint as s from v a join v b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
p as (select a, b, s from s where same qualify row_number() over (partition by a order by s desc, b) <= 5)
select p.a as anchor_id, p.b as positive_id, (row_number() over (partition by p.a, p.b order by n.s desc, n.b))::int as rank, n.b as negative_id, p.s as positive_score, n.s as negative_score
from p join s n on p.a = n.a and not n.same and 80 * p.s <= 100 * n.s and 100 * n.s <= 100 * p.s qualify row_number() over (partition by p.a, p.b order by n.s desc, n.b) <= 5"""


def lloyd_sql(size: int = 64, centres: int = 40, rounds: int = 5, seed: str = "2") -> str:
    """Lloyd's rounds written out, one after the other, in whole numbers."""
    near = "(select vec_id, v, arg_min(k, (d, k)) as k, min(d) as d from (select vec_id, v, k, list_sum(list_transform(range(1, {size} + 1), lambda i: (v[i] - c[i]) * (v[i] - c[i])))::bigint as d from v, c{r}) group by vec_id, v)"
    out = f"""with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings where len(embedding) = {size} and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
c0 as (select row_number() over (order by sha256('{seed}:' || vec_id)) - 1 as k, v as c from v qualify k < {centres})"""
    for r in range(rounds):
        sums = "select k, i, sum(v[i])::bigint as s, count(*) as n from a{r}, (select unnest(range(1, {size} + 1)) as i) group by k, i"
        out += f""",\na{r} as materialized {near}, m{r} as (select k, list((s - ((s % n) + n) % n) // n order by i)::bigint[] as c from ({sums}) group by k),
c{r + 1} as materialized (select c{r}.k, coalesce(m{r}.c, c{r}.c) as c from c{r} left join m{r} using (k))""".format(r=r, size=size)
    last = near.format(r=rounds, size=size)
    return out + f""",\nz as materialized {last}
select vec_id, k::int as cluster, d as distance, (sum(d) over (partition by k))::bigint as cluster_inertia, (sum(d) over ())::bigint as inertia, sha256(array_to_string(c, ',')) as centroid_sha256 from z join c{rounds} using (k)"""


#: crc32 of the id's digits, bit by bit, as there is no function for it.
_CRC = "xor(list_reduce(list_concat([4294967295::bigint], list_transform(range(1, length(doc_id::varchar) + 1), lambda i: ascii(substring(doc_id::varchar, i, 1))::bigint)), lambda c, b: list_reduce(list_concat([xor(c, b)], [0::bigint for _ in range(8)]), lambda x, y: case when x % 2 = 1 then xor(x // 2, 3988292384::bigint) else x // 2 end)), 4294967295::bigint)"
BASE_SQL = rf"""with w as (select doc_id, {_CRC} % 7 = 2 as held_out, list_concat(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), [' ']) as ws from documents),
t as (select doc_id, held_out, unnest(ws) as word from w), c as (select word, count(*) as c from t where not held_out group by word), s as (select sum(c)::bigint as n, count(*) as v from c)
select doc_id, held_out, count(*) as n_tokens, count(c.c) as n_known, any_value(n) as train_tokens, round(sum(log10((coalesce(c.c, 0) + 1) / (n + v + 1))), 6) as base_score from t left join c using (word), s group by doc_id, held_out"""


def oracle_sql() -> dict[str, str]:
    return {"op3_jaccard_orders": OP3_SQL, "op5_line_chunks": OP5_SQL, "op11_dual_tree_negatives": OP11_SQL, "op13_lloyd": lloyd_sql(), "edited_texts": EDITED_SQL, "secret_counts": SECRET_SQL, "base_scores": BASE_SQL}
