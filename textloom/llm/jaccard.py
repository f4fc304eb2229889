"""N-gram Jaccard join by prefix filters under several global orders.

A document is the set of its five-word shingles. Two sets whose Jaccard
similarity reaches the threshold share a token among the first
n - ceil(t n) + 1 tokens of each, under any order of all tokens. The orders
used all begin with the tokens that only one document holds, which fill
prefixes without ever making a candidate, and go on by classes of document
frequency: single frequencies, factors of 4, factors of 16; within a class each
has its own random order. Candidates of every order come from its own lists of
prefix tokens; what all orders have in common is verified.

Components are found without making all pairs of a group: equal sets are one;
documents that agree in a minimum hash are put to leaders, in salted groups of
bounded size, by the same filters and the same verification, and the leaders
again under another hash. Of a large group of near copies many leaders remain
that only chains of others link, so its documents meet in new salted groups, where
components are joined. Then the lists give candidates among leaders, and at last
among all documents of different components.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common, graph, tokens

WIDTH, PERCENT = 5, 75
#: The orders: the factor of two whose powers bound a class of frequencies (0: each its own), and what mixes a class.
ORDERS = ((0, np.uint64(0x243F6A8885A308D3)), (2, np.uint64(0x13198A2E03707344)), (4, np.uint64(0xA4093822299F31D0)))
#: Documents of one salted group, on average, and how many minimum hashes are looked at together.
GROUP, HASHES = 64, 3
#: Words or shingles of a block that are worked on at a time, about (a longer document is whole), and sets.
STEP, SETS_STEP = 1 << 17, 256
#: Sets that a Python worker gets at a time.
BATCH = 1024
#: Words for each bucket of the table of sets, at most and at least, about.
BUCKET_WORDS = 1 << 22, 1 << 16


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def linked(common_tokens: int, a: int, b: int, percent: int = PERCENT) -> bool:
    return 100 * common_tokens >= percent * (a + b - common_tokens)


def _steps(first: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of documents that have about STEP entries together; first: where each one's begin, one more."""
    at = 0
    while at < len(first) - 1:
        to = max(at + 1, int(np.searchsorted(first, first[at] + STEP, "right")) - 1)
        yield at, to
        at = to


def _distinct(n: np.ndarray, h: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """How many distinct shingles each document has, of n words each, and the shingles."""
    per = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    begin = common.ragged(np.cumsum(n) - n, per)
    doc = np.repeat(np.arange(len(n)), per)
    size = np.minimum(n, width)[doc]
    out = size.astype(np.uint64)
    for i in range(width):
        at = np.minimum(begin + i, max(0, len(h) - 1))
        out = np.where(i < size, common.mix(out * np.uint64(0x9E3779B97F4A7C15) + (h[at] if len(h) else np.uint64(0))), out)
    order = np.lexsort((out, doc))
    doc, out = doc[order], out[order]
    keep = np.ones(len(out), bool)
    keep[1:] = (doc[1:] != doc[:-1]) | (out[1:] != out[:-1])
    return np.bincount(doc[keep], minlength=len(n)), out[keep]


def shingles(row: dict, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A block's document ids, where each one's shingles begin, and the shingles: distinct in a document, sorted. A document with fewer words has its whole sequence as one."""
    ids, _, first, distinct, index = tokens.read_block(row)
    n = np.diff(first)
    parts = [_distinct(n[a:b], distinct[index[first[a] : first[b]]], width) for a, b in _steps(first)]
    sizes, out = (np.concatenate([np.zeros(0, kind), *(p[i] for p in parts)]) for i, kind in enumerate((np.int64, np.uint64)))
    return ids, np.concatenate([[0], np.cumsum(sizes)]), out


def _ask(row: dict, width: int, bits: int):
    _, _, s = shingles(row, width)
    keys, count = np.unique(s >> np.uint64(64 - bits) << np.uint64(64 - bits), return_counts=True)
    return [(keys, count, np.zeros(len(keys)))]


def _prefix(shared: np.ndarray, df: np.ndarray, n: int, order: tuple[int, np.uint64], percent: int) -> np.ndarray:
    """The tokens of a prefix that another document may hold, in the order. shared: the set's tokens with a document frequency over one; the others come before them in every order."""
    fold, seed = order
    q = prefix_length(n, percent) - (n - len(shared))
    if q <= 0:
        return shared[:0]
    return shared[np.lexsort((common.mix(shared ^ seed), np.frexp(df)[1] // fold if fold else df))[:q]]


SETS = "doc_id long, n long, h1 long, h2 long, shared binary, df binary"


def _sets(row: dict, answer: dict, width: int, bits: int, percent: int) -> pa.Table:
    ids, begin, s = shingles(row, width)
    _, inverse = np.unique(s >> np.uint64(64 - bits), return_inverse=True)
    totals = answer[0][0] if len(s) else np.zeros(0, np.uint64)
    out = []
    for a, b in _steps(begin):
        at, part = begin[a : b + 1] - begin[a], s[begin[a] : begin[b]]
        df = totals[inverse[begin[a] : begin[b]]].astype(np.uint32)
        n = np.diff(at)
        sums = (np.concatenate([[np.uint64(0)], np.cumsum(common.mix(part + np.uint64(c)), dtype=np.uint64)]) for c in (1, 2))
        h1, h2 = ((x[at[1:]] - x[at[:-1]]).view(np.int64) for x in sums)
        shared, freq = [], []
        common_so_far = np.concatenate([[0], np.cumsum(df > 1)])
        alone = n - (common_so_far[at[1:]] - common_so_far[at[:-1]])
        for i in range(b - a):
            if n[i] and alone[i] < prefix_length(int(n[i]), percent):
                own = slice(at[i], at[i + 1])
                many = df[own] > 1
                shared.append(part[own][many].tobytes())
                freq.append(df[own][many].tobytes())
            else:
                shared.append(None)
                freq.append(None)
        out.append(pa.table({"doc_id": ids[a:b], "n": n.astype(np.int64), "h1": h1, "h2": h2, "shared": pa.array(shared, pa.binary()), "df": pa.array(freq, pa.binary())}))
    return pa.concat_tables(out)


def _arrays(row: dict) -> tuple[np.ndarray, np.ndarray, int]:
    return np.frombuffer(row["shared"], np.uint64), np.frombuffer(row["df"], np.uint32), row["n"]


POSTINGS = "order int, token long, class int, left long, doc_id long, n long, comp long"


def _postings(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """A row for each order and token of a prefix. left: how many of the set's tokens the order has from this one on; class: of two sets that can be linked, the larger one's is the same or the next."""
    step = np.log(105 / percent)
    for b in batches:
        for rows in (b.slice(i, SETS_STEP).to_pylist() for i in range(0, b.num_rows, SETS_STEP)):
            sets = [_arrays(r) for r in rows]
            n = np.array([x[2] for x in sets], np.int64)
            known = {"doc_id": np.array([r["doc_id"] for r in rows], np.int64), "n": n, "comp": np.array([r["comp"] for r in rows], np.int64), "class": np.floor(np.log(n) / step).astype(np.int32)}
            for i, order in enumerate(ORDERS):
                prefixes = [_prefix(*x, order, percent) for x in sets]
                size = [len(p) for p in prefixes]
                of = np.repeat(np.arange(len(rows)), size)
                columns = {k: v[of] for k, v in known.items()}
                columns["order"] = np.full(len(of), i, np.int32)
                columns["token"] = np.concatenate(prefixes).view(np.int64)
                columns["left"] = np.array([len(x[0]) for x in sets], np.int64)[of] - np.concatenate([np.arange(x) for x in size]).astype(np.int64)
                names = [x.split()[0] for x in POSTINGS.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(columns[k]) for k in names], names)


def _seed(i: int) -> np.uint64:
    return common.mix(np.array([0x082EFA98EC4E6C89 + i], np.uint64))[0]


def _least(batches: Iterator[pa.RecordBatch], first: int) -> Iterator[pa.RecordBatch]:
    """HASHES minimum hashes of each set's shared tokens, from the first-th on."""
    for b in (x.slice(i, SETS_STEP) for x in batches for i in range(0, x.num_rows, SETS_STEP)):
        sets = [np.frombuffer(x, np.uint64) for x in b.column("shared").to_pylist()]
        keys = [pa.array([int(common.mix(x ^ _seed(first + i)).min()) - (1 << 63) for x in sets], pa.int64()) for i in range(HASHES)]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), *keys], ["doc_id", *(f"k{i}" for i in range(HASHES))])


def _stars(group: pa.Table, percent: int) -> pa.Table:
    """One salted group: each document, in the order of ids, joins the first leader that it links to, or becomes one. Only leaders whose prefixes meet its own under every order are verified."""
    leaders, out = [], []
    for row in sorted(group.select(["doc_id", "n", "shared", "df"]).to_pylist(), key=lambda r: r["doc_id"]):
        a = _arrays(row)
        heads = [np.sort(_prefix(*a, order, percent)) for order in ORDERS]
        for b, others, leader in leaders:
            if 100 * min(a[2], b[2]) >= percent * max(a[2], b[2]) and all(map(common.shared, heads, others)) and linked(common.shared(a[0], b[0]), a[2], b[2], percent):
                out.append((row["doc_id"], leader))
                break
        else:
            leaders.append((a, heads, row["doc_id"]))
    common.give_back()
    return pa.table({"doc_id": pa.array([x for x, _ in out], pa.int64()), "comp": pa.array([y for _, y in out], pa.int64())})


def _chains(group: pa.Table, percent: int) -> pa.Table:
    """One salted group: links between its components, as many as it takes to join those that link in it. Documents of one component are not compared."""
    up, seen, out = {}, [], []

    def top(c: int) -> int:
        while (to := up.setdefault(c, c)) != c:
            c = to
        return c

    for row in sorted(group.select(["doc_id", "n", "shared", "df", "comp"]).to_pylist(), key=lambda r: r["doc_id"]):
        a = _arrays(row)
        heads = [np.sort(_prefix(*a, order, percent)) for order in ORDERS]
        for b, others, comp in seen:
            x, y = top(row["comp"]), top(comp)
            if x != y and 100 * min(a[2], b[2]) >= percent * max(a[2], b[2]) and all(map(common.shared, heads, others)) and linked(common.shared(a[0], b[0]), a[2], b[2], percent):
                up[max(x, y)] = min(x, y)
                out.append((row["comp"], comp))
        seen.append((a, heads, row["comp"]))
    common.give_back()
    return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})


def _verified(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Those of the pairs with both sets that are linked."""
    for b in (x.slice(i, SETS_STEP) for x in batches for i in range(0, x.num_rows, SETS_STEP)):
        out = []
        for r in b.to_pylist():
            x, y = (np.frombuffer(r[k], np.uint64) for k in ("shared", "shared_b"))
            if linked(common.shared(x, y), r["n"], r["n_b"], percent):
                out.append((r["comp"], r["comp_b"]))
        yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in out], pa.int64()) for i in (0, 1)], ["a", "b"])


def _candidates(post: DataFrame, percent: int) -> DataFrame:
    """The pairs (doc_id, doc_b) of different components whose prefixes meet under every order, from POSTINGS; neither side has a set yet.

    A pair is found from its smaller set's side. At the first token that two
    sets share, all that they can share is from there on, so the smaller one's
    token has to be near its set's begin (2 n t / (1 + t) tokens from there
    on). Lists are cut by classes of set sizes as well, so that a token that
    very many documents hold is no single group.
    """
    key = ["order", "token", "class"]
    # tokens of one component only make no candidates
    lists = post.groupBy("order", "token").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x < y").select("order", "token")
    post = post.join(lists, ["order", "token"], "left_semi")
    small = post.where(F.col("left") * (100 + percent) >= F.col("n") * (2 * percent))
    large = post.select("order", "token", F.explode(F.array(F.col("class"), F.col("class") - 1)).alias("class"), *[F.col(c).alias(c + "_b") for c in ("left", "doc_id", "n", "comp")])
    enough = F.least("left", "left_b") * (100 + percent) >= (F.col("n") + F.col("n_b")) * percent
    smaller = F.struct("n", "doc_id") < F.struct(F.col("n_b").alias("n"), F.col("doc_id_b").alias("doc_id"))
    pairs = small.join(large, key).where((F.col("comp") != F.col("comp_b")) & smaller & enough)
    met = pairs.groupBy("doc_id", F.col("doc_id_b").alias("doc_b")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1), F.col("order"))).alias("met"))
    return met.where(F.col("met") == (1 << len(ORDERS)) - 1).drop("met")


def _links(sets: DataFrame, percent: int, folder: str) -> DataFrame:
    """Links (a, b) between components, from all pairs of sets (doc_id, comp, n, shared, df) in different components that pass the filters."""
    spark = sets.sparkSession
    post = common.written(sets.mapInArrow(common.tidy(partial(_postings, percent=percent)), POSTINGS), f"{folder}-postings", ZSTD, BATCH)
    pairs = common.written(_candidates(post, percent), f"{folder}-pairs")
    common.removed(spark, f"{folder}-postings")
    right = sets.select(*[F.col(c).alias("doc_b" if c == "doc_id" else c + "_b") for c in ("doc_id", "n", "shared", "comp")])
    both = pairs.join(sets.select("doc_id", "n", "shared", "comp"), "doc_id").join(right, "doc_b").drop("doc_id", "doc_b")
    out = common.written(both.mapInArrow(common.tidy(partial(_verified, percent=percent)), "a long, b long").distinct(), f"{folder}-links", batch=BATCH)
    common.removed(spark, f"{folder}-pairs")
    return out


ZSTD = {"compression": "zstd"}


def _led(able: DataFrame, percent: int, folder: str) -> tuple[DataFrame, DataFrame]:
    """(a, b): documents and the leaders that they have joined; and the last table of minimum hashes.

    Each turn groups those that have not joined anyone by another minimum
    hash. There are HASHES turns at least, and more while groups are larger
    than GROUP and a good part of their members still joins: so of a group of
    near copies, whatever its size, few leaders remain.
    """
    spark = able.sparkSession
    members, keys, i = None, None, 0
    while True:
        if i % HASHES == 0:
            keys = common.written(able.select("doc_id", "shared").mapInArrow(common.tidy(partial(_least, first=i)), f"doc_id long, {', '.join(f'k{k} long' for k in range(HASHES))}"), f"{folder}/keys{i}", batch=BATCH)
        now = keys.select("doc_id", F.col(f"k{i % HASHES}").alias("key"))
        if members is not None:
            now = now.join(members.select(F.col("a").alias("doc_id")), "doc_id", "left_anti")
        sizes = common.written(now.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), f"{folder}/sizes{i}")
        now = now.join(sizes, "key").withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("size") / GROUP))).drop("size")
        stars = able.join(now, "doc_id").groupBy("key", "salt").applyInArrow(lambda g: _stars(g, percent), "doc_id long, comp long")
        stars = common.written(stars, f"{folder}/stars{i}").select(F.col("doc_id").alias("a"), F.col("comp").alias("b"))
        members = stars if members is None else members.unionAll(stars)
        i += 1
        if i >= HASHES:
            large = sizes.where(F.col("size") > GROUP).agg(F.sum("size")).first()[0] or 0
            if stars.count() * 4 < large or not large:
                return members, keys


def _chained(able: DataFrame, keys: DataFrame, comps: DataFrame, percent: int, folder: str) -> DataFrame:
    """comps (doc_id, comp), joined where documents link that have a minimum hash in common with more than GROUP components.

    All leaders of such a group would be candidates of each other, though chains
    through other members link most of them. Its documents, leaders or not, are
    dealt to salted groups anew in each turn; there are HASHES turns, and more
    while a good part of what is left joins. What still is apart is left to the
    lists.
    """
    i = 0
    while True:
        now = keys.select("doc_id", F.col(f"k{i % HASHES}").alias("key")).join(comps, "doc_id")
        each = now.groupBy("key", "comp").agg(F.count("*").alias("n"))
        many = common.written(each.groupBy("key").agg(F.sum("n").alias("size"), F.count("*").alias("comps")).where(F.col("comps") > GROUP), f"{folder}/many{i}")
        apart = many.agg(F.sum("comps")).first()[0] or 0
        joined = 0
        if apart:
            salt = F.pmod(F.xxhash64("doc_id", F.lit(i)), F.ceil(F.col("size") / GROUP))
            met = able.join(now.join(many, "key").select("doc_id", "comp", "key", salt.alias("salt")), "doc_id")
            links = common.written(met.groupBy("key", "salt").applyInArrow(lambda g: _chains(g, percent), "a long, b long").distinct(), f"{folder}/links{i}")
            roots = common.written(graph.components(links, f"{folder}/roots{i}"), f"{folder}/joined{i}").withColumnRenamed("node", "comp")
            joined = roots.count()
            comps = common.written(comps.join(roots, "comp", "left").select("doc_id", F.coalesce("root", "comp").alias("comp")), f"{folder}/comps{i}")
        i += 1
        if i >= HASHES and joined * 4 <= apart:
            return comps


def join(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Documents without words (null or empty texts) link with nothing. Rows with
    the same id count as linked, and so do those without one; a null id is the
    smallest and comes back as null. A very long text is one set, in memory
    whole. Repeated rows each give a row. An empty table gives an empty result;
    other columns are not looked at.
    """
    spark = docs.sparkSession
    folder = common.shared_folder(spark)
    table = tokens.blocks(common.texts(docs).withColumns({"kind": F.lit(0), "flag": F.lit(0)}), f"{folder}/blocks")
    total = int(table.agg(F.sum("n")).first()[0] or 0)
    bits = min(64, max(1, total).bit_length() + 12)  # frequencies may be of a few tokens together: then a token only counts as less rare
    told = tokens.totals(table, partial(_ask, width=width, bits=bits), [total], f"{folder}/totals")
    sets = common.written(tokens.answered(table, told, partial(_sets, width=width, bits=bits, percent=percent), SETS), f"{folder}/sets", ZSTD)
    for name in ("blocks", "totals"):
        common.removed(spark, f"{folder}/{name}")

    classes = sets.where("n > 0").groupBy("h1", "h2").agg(F.min("doc_id").alias("rep"))
    able = sets.where("shared is not null").join(classes.select("h1", "h2", F.col("rep").alias("doc_id")), ["doc_id", "h1", "h2"], "left_semi").dropDuplicates(["doc_id", "h1", "h2"])
    # every step below joins these sets by their ids, so they are dealt by them once
    most, least = BUCKET_WORDS
    buckets = max(1, total // most, min(int(spark.conf.get("spark.sql.shuffle.partitions")), total // least))
    able = common.bucketed(able.drop("h1", "h2"), f"{folder}/able", "doc_id", buckets, ZSTD)
    members, keys = _led(able, percent, folder)
    chains = graph.components(members, f"{folder}/chains").withColumnRenamed("node", "doc_id")
    comps = able.select("doc_id").distinct().join(chains, "doc_id", "left").select("doc_id", F.coalesce("root", "doc_id").alias("comp"))
    comps = _chained(able, keys, common.written(comps, f"{folder}/comps"), percent, f"{folder}/chained")

    # leaders with each other, then all documents of components that are still apart
    led = able.join(comps.where("comp = doc_id"), "doc_id")
    roots = graph.components(_links(led, percent, f"{folder}/a"), f"{folder}/leaders").withColumnRenamed("node", "comp")
    comps = common.written(comps.join(roots, "comp", "left").select("doc_id", F.coalesce("root", "comp").alias("comp")), f"{folder}/comps-led")
    last = graph.components(_links(able.join(comps, "doc_id"), percent, f"{folder}/b"), f"{folder}/components").withColumnRenamed("node", "comp")
    member = comps.join(last, "comp", "left").select(F.col("doc_id").alias("rep"), F.coalesce("root", "comp").alias("comp"))
    out = sets.select("doc_id", "n", "h1", "h2").join(classes.join(member, "rep", "left"), ["h1", "h2"], "left")
    real = lambda c: F.when(c != -(1 << 63), c)
    component = F.when(F.col("n") > 0, F.coalesce("comp", "rep")).otherwise(F.col("doc_id"))
    out = common.written(out.select(real(F.col("doc_id")).alias("doc_id"), F.col("n").alias("n_shingles"), real(component).alias("component_id")), f"{folder}-joined")
    common.removed(spark, folder)
    return out


def one_of_each(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The rows of docs, with all their columns, that have their component's smallest id; of rows with the same id that have words, one, by a hash of the text. Rows without words all stay; an empty table gives an empty result; a very long text is read whole. Of rows with one id each task keeps one before anything is shuffled, so that a repeated or null id is no hot key."""
    key = F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long"))
    found = join(docs, width, percent)
    stay = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("n_shingles") > 0)).select(key.alias("_key")).distinct()
    words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0d]"), F.lit(False))
    rows = docs.select(F.struct("*").alias("_d"), key.alias("_key"), words.alias("_words"), F.xxhash64("text").alias("_hash"))
    first = F.row_number().over(Window.partitionBy("_key").orderBy("_hash", F.col("_d.text")))
    one = rows.where("_words").withColumn("_at", first).where("_at = 1").join(stay, "_key")
    return one.select("_d.*").unionByName(rows.where("not _words").select("_d.*"))
