"""Line dedup, fingerprints, Jaccard join, decontamination."""

import hashlib
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from textloom.llm import common, decontaminate, fingerprints, graph, jaccard, linededup, queries, tokens

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text, width=5):
    w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def brute_components(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            both = len(a & b)
            if both and 100 * both >= 75 * (len(a) + len(b) - both):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in sets}


def test_jaccard_as_all_pairs(spark):
    words = [f"w{i}" for i in range(400)]
    passage = " ".join(words[300:340])
    rows = []
    for g in range(6):  # families with an edit each, a chain, copies, and a passage that all hold
        base = words[g * 40 : g * 40 + 40]
        rows += [(g * 50 + k, " ".join(base[:k] + [f"E{k}"] + base[k + 1 :] + [f"f{g}", f"h{g}"]).upper() if k % 2 else " ".join(base[k:] + base[:k])) for k in range(12)]
        rows += [(g * 50 + 20 + k, " ".join(base)) for k in range(5)]
        rows += [(g * 50 + 30 + k, passage + " " + " ".join(f"u{g}_{k}_{j}" for j in range(4 + k))) for k in range(6)]
    rows += [(900, ""), (901, None), (902, " \n"), (903, "a b"), (904, "A  b"), (905, "a b c")]
    got = {r["doc_id"]: (r["component_id"], r["n_shingles"]) for r in jaccard.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute_components(rows)
    assert got == {i: (want[i], len(shingles(t))) for i, t in rows}


def test_jaccard_over_documents(spark, sf, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert {r["doc_id"]: r["component_id"] for r in queries.op3_jaccard_orders(spark, sf).collect()} == brute_components(rows)


def test_jaccard_over_odd_rows(odd, empty):
    r = jaccard.join(odd).collect()
    assert len(r) == 12 and {x["component_id"] for x in r if x["doc_id"] == 6} == {6} and [x["n_shingles"] for x in r if x["doc_id"] == 3] == [0]
    assert jaccard.join(empty).count() == 0
    kept = jaccard.one_of_each(odd)
    assert kept.columns == odd.columns and kept.where("doc_id = 5").count() == 1 and kept.where("doc_id in (2, 3, 4)").count() == 3 and kept.where("doc_id is null").count() == 1


def test_near_copies_that_chains_link_are_no_pairs_of_leaders(spark, monkeypatch):
    """A tenth has one edit and links with the others, of three edits, which do not link with each other: nearly all of them are leaders."""
    draw, base = random.Random(3), [f"w{i}" for i in range(150)]
    rows = []
    for i in range(400):
        text = list(base)
        for k in draw.sample(range(150), 1 if i % 10 == 9 else 3):
            text[k] = f"e{i}_{k}"
        rows.append((i, " ".join(text)))
    made, plain = [], jaccard._candidates

    def counted(post, percent):
        pairs = plain(post, percent)
        made.append(pairs.count())
        return pairs

    monkeypatch.setattr(jaccard, "_candidates", counted)
    got = {r["doc_id"]: r["component_id"] for r in jaccard.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_components(rows) and sum(x == 0 for x in got.values()) > 380
    assert made[0] < len(rows)


def test_shingles_of_a_block_are_made_in_steps():
    """1.2 million words of 1,200 documents, two of which have the same words: beside the block's own arrays no large ones are held."""
    draw = np.random.default_rng(5)
    words = draw.integers(0, 50_000, 1_200_000).astype(np.uint32)
    words[1000:2000] = words[:1000]
    distinct = np.sort(common.mix(np.arange(50_000, dtype=np.uint64)))
    packed = {"ids": np.arange(1200), "flags": np.zeros(1200, np.int8), "words": np.full(1200, 1000, np.uint32), "index": words}
    row = {k: tokens.pack(v) for k, v in packed.items()} | {"distinct": tokens.pack_keys(distinct)}
    tracemalloc.start()
    ids, first, s = jaccard.shingles(row)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert ids.tolist() == list(range(1200)) and np.diff(first).tolist() == [996] * 1200
    assert (s[:996] == s[996:1992]).all() and len(np.unique(s)) == 996 * 1199
    assert peak < 60e6


def test_sets_are_not_dealt_again_for_a_join_by_id(spark, monkeypatch):
    draw = random.Random(8)
    rows = [(i, " ".join(draw.choices("abcdefghijkl", k=40))) for i in range(60)]
    rows += [(i + 60, t + " z") for i, t in rows]
    plans, plain = [], jaccard._links

    def looked(sets, percent, folder):
        plans.append(sets._jdf.queryExecution().executedPlan().toString())
        return plain(sets, percent, folder)

    monkeypatch.setattr(jaccard, "_links", looked)
    monkeypatch.setattr(jaccard, "BUCKET_WORDS", (1 << 22, 1 << 10), raising=False)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = {r["doc_id"]: r["component_id"] for r in jaccard.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == brute_components(rows)
    assert len(plans) == 2 and all("Bucketed: true" in p and p.count("Exchange") == 1 for p in plans)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("textloom_")]


def test_rows_without_words_never_stand_for_a_text(spark):
    text = "a text of more than five words that must stay"
    rows = [(1, None), (1, text), (1, " \n"), (1, ""), (2, ""), (2, "another text of words with the same id " * 3), (3, text)]
    for some in (rows, rows[::-1]):
        got = [tuple(r) for r in jaccard.one_of_each(spark.createDataFrame(some, "doc_id long, text string").coalesce(1)).collect()]
        assert sorted(map(repr, got)) == sorted(map(repr, rows[:6]))


def test_components_of_a_chain(spark, tmp_path):
    e = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r["node"]: r["root"] for r in graph.components(e, str(tmp_path / "c")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100}
    assert graph.components(e.where("false"), str(tmp_path / "d")).count() == 0


def plain_lines(text):
    """Lines by the rule, read character by character: up to a newline, or a full stop and a space, with all white space behind it."""
    out, at = [], 0
    for m in re.finditer(r"(?:\n|\. )[ \t\n\x0b\x0c\r]*", text):
        out.append(text[at : m.end()])
        at = m.end()
    return [*out, text[at:]] if text[at:] else out


def brute_dedup(rows):
    """What must be left of (doc_id, text): without each line that, with a neighbour, stands earlier just so."""
    docs = [(i, plain_lines(t or "")) for i, t in sorted(rows)]
    seen, out = set(), {}
    for i, ls in docs:
        bare = [x.strip(" \t\n\x0b\x0c\r") for x in ls]
        gone = set()
        for k, pair in enumerate(zip(bare, bare[1:])):  # noqa: B905
            if all(pair):
                gone |= {k, k + 1} if pair in seen else set()
                seen.add(pair)
        text = ""
        for k, x in enumerate(ls):
            if k not in gone:
                text += x
            elif x.endswith("\n") and k + 1 < len(ls) and k + 1 not in gone and set(range(k)) - gone:
                text += "\n"
        out[i] = text
    return out


def test_line_dedup_as_brute_force(spark, documents):
    docs = documents.select("doc_id", "text", "lang", "n_chars")
    out = {r["doc_id"]: r for r in linededup.dedup_lines(docs).collect()}
    assert {i: r["text"] for i, r in out.items()} == brute_dedup([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert all(r["n_chars"] == len(r["text"]) for r in out.values()) and sum(len(r["text"]) for r in out.values()) < docs.agg(F.sum(F.length("text"))).first()[0]


def test_lines_of_odd_texts(spark):
    texts = ["", "a", "\n", " \n\t ", "a\n", "a. b.  c\nd.\ne", "a\n\n b.\n\n\nc. \nd", "3.14 and U.S.A. x", "a\x00b. c\nd", "\n\na. b", ". . .", "é. 漢字\n\n"]
    got = [r["l"] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").transform(lambda d: linededup.with_lines(d, "t")).select(F.col("_lines").alias("l")).collect()]
    bare = lambda xs: [x.strip() for x in xs if x.strip()]
    assert ["".join(x) for x in got] == texts and [bare(x) for x in got] == [bare(plain_lines(t)) for t in texts]


@pytest.mark.parametrize("k", [2, 3, 4, 9, 20])
def test_repeated_passage_goes_whole(spark, k):
    """Passages between other texts, in two documents or more, at line ends or in the middle of paragraphs."""
    own = lambda d, p, end: "".join(f"{p} line {i} of text {d} and of no other.{end}" for i in range(3))
    rows, want = [], {}
    for p in range(30):
        end, copies = ("\n", " ", "\n\n")[p % 3], 2 + p % 3
        passage = "".join((f"{p}.{i} ab." if i % 4 == 1 else f"Passage {p} has this line {i} of {k}, said twice.") + end for i in range(k))
        for d in range(copies):
            i = 10 * p + d
            rows.append((i, own(i, "First", end) + passage + own(i, "Last", end)))
            want[i] = rows[-1][1] if d == 0 else own(i, "First", end) + ("\n" if "\n" in end else "") + own(i, "Last", end)
    out = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == want


def test_first_occurrence_of_every_line_stays(spark):
    rng = random.Random(5)
    rows = [(d, "".join(f"Line {rng.randrange(30)} of few that come again and again.\n" for _ in range(rng.randrange(2, 9)))) for d in range(60)]
    out = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {x for _, t in rows for x in t.splitlines()} == {x for t in out.values() for x in t.splitlines() if x}
    assert out[0] == rows[0][1] and sum(map(len, out.values())) < sum(len(t) for _, t in rows)


def test_line_dedup_over_odd_rows(odd, empty):
    out = linededup.dedup_lines(odd)
    assert out.count() == 12 and out.columns == odd.columns
    by = {}
    for r in out.collect():
        by.setdefault(r["doc_id"], []).append(r["text"])
    assert by[2] == [None] and by[3] == [""] and by[4] == [" \n\t "] and len(set(by[5])) == 1 and by[9][0].strip() == ""
    assert linededup.dedup_lines(odd, drop_emptied=True).where("doc_id = 9").count() == 0
    assert linededup.dedup_lines(empty).count() == 0


def simhash(text):
    """The definition, by another implementation of the hash."""
    signed = lambda n: n & 0xFFFFFFFFFFFFFFFF
    w = [x for x in re.split("[\x20\x09-\x0d]+", text.lower()) if x]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in w]
    terms = []
    for i, a in enumerate(h):
        seed = xxhash.xxh64_intdigest(a.to_bytes(8, "little"), 42)
        terms.append(xxhash.xxh64_intdigest(h[i + 1].to_bytes(8, "little"), seed) if i + 1 < len(h) else seed)
    return sum((2 * sum(t >> b & 1 for t in terms) > len(terms)) << b for b in range(64)) if terms else signed(0)


def test_fingerprints_as_defined(spark, sf, documents):
    rows = sorted(((r["doc_id"], r["text"]) for r in documents.collect()), reverse=True)
    got = {r["doc_id"]: r for r in queries.op9_simhash(spark, sf).collect()}
    prints = {i: simhash(t) for i, t in rows}
    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        edited = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
        g = got[i]
        assert (g["n_chars"], g["edited_sha256"], g["fingerprint"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest(), f"{prints[i]:016x}")
        assert g["edited_fingerprint"] == f"{simhash(edited):016x}"
        if i % 100 == 0:
            assert g["near_docs"] == sum((prints[i] ^ p).bit_count() <= fingerprints.RADIUS for p in prints.values()) - 1
    assert sum(g["near_edited"] for g in got.values()) > 3 * sum(g["near_next"] for g in got.values())


def test_fingerprints_over_odd_rows(odd, empty, spark):
    r = fingerprints.fingerprints(odd).collect()
    assert len(r) == 12 and len({x["fingerprint"] for x in r if x["doc_id"] == 5}) == 1 and all(x["fingerprint"] == 0 for x in r if x["doc_id"] in (2, 3, 4))
    assert fingerprints.fingerprints(empty).count() == 0
    one = fingerprints.fingerprints(spark.createDataFrame([(1, "abcd")], "doc_id long, text string")).first()
    assert one["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()


def test_long_texts_count_every_term(spark):
    text = " ".join(str(i) for i in range(40_000))
    assert fingerprints.simhash(spark.createDataFrame([(1, text)], "k int, text string"), ["k"]).first()["fingerprint"] & 0xFFFFFFFFFFFFFFFF == simhash(text)


def test_block_tables_find_all_within_the_radius(spark):
    import random

    rng = random.Random(1)
    base = [rng.getrandbits(63) for _ in range(20)]
    near = [b ^ sum(1 << x for x in rng.sample(range(63), rng.randint(0, 5))) for b in base for _ in range(10)]
    q, p = (spark.createDataFrame([(x,) for x in xs], f"{n} long") for xs, n in ((base, "query"), (near, "fingerprint")))
    got = {(r["query"], r["fingerprint"]) for r in fingerprints.within(q, p).collect()}
    assert got == {(a, b) for a in base for b in near if (a ^ b).bit_count() <= 3}


def weighted(a, b):
    both = sum((a & b).values())
    return both / max(1, sum(a.values()) + sum(b.values()) - both)


def counts(w):
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def test_decontamination_as_all_windows(spark, sf, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    items = [(r["item_id"], r["text"].lower().split()) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    rows += [(1000 + i, f"before it {' '.join(w).upper()} and behind it") for i, w in items] + [(2000 + i, " ".join(w[:-1] + ["other"])) for i, w in items if len(w) > 20]
    want = set()
    for d, t in rows:
        w = t.lower().split()
        have = set(w)
        for i, item in items:
            if len(have & set(item)) >= 0.8 * len(set(item)) and any(weighted(counts(item), counts(w[s : s + len(item)])) >= 0.75 for s in range(max(1, len(w) - len(item) + 1))):
                want.add((d, i))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find(docs, bench).collect()}
    assert got <= want and len(got) >= 0.98 * len(want) and {(d, i) for d, i in want if 1000 <= d < 2000} <= got
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.find(docs, bench, max_bytes=100_000).collect()} == got
    assert {r["doc_id"] for r in decontaminate.without(docs, bench).collect()} == {d for d, _ in rows} - {d for d, _ in got}


def test_decontamination_over_odd_rows(odd, empty, spark):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "no id here but some words"), (4, "x"), (4, "x")], "item_id long, text string")
    assert sorted((r["doc_id"] or 0, r["item_id"]) for r in decontaminate.find(odd, bench).collect()) == [(0, 3), (8, 4), (8, 4)]
    kept = decontaminate.without(odd, bench)
    assert kept.columns == odd.columns and kept.count() == 10
    assert decontaminate.find(empty, bench).count() == 0 and decontaminate.find(odd, bench.where("false")).count() == 0


def test_long_items_are_found_with_edits():
    """Items of 60 to 5,000 words with words changed, put in and left out: found wherever all windows of the text hold them, at a text's end too, and whatever stands beside the text."""
    rng = random.Random(11)
    word = lambda: f"w{rng.randrange(3000)}"
    hits = total = 0
    for n in (60, 61, 100, 333, 1000, 2047, 2100, 5000):
        items = [[word() for _ in range(n)] for _ in range(6)]
        index = decontaminate.build([(i, " ".join(w)) for i, w in enumerate(items)])
        texts, want = [], []
        for i, w in enumerate(items):
            for share in (0, 0.01, 0.02):
                w2 = list(w)
                for _ in range(round(share * n)):
                    k = rng.randrange(len(w2))
                    w2[k : k + 1] = rng.choice([[word()], [], [w2[k], word()]])
                for before, behind, cut in ((0, 0, 0), (37, 50, 0), (2, 0, 0), (21, 0, n // 20)):
                    text = [word() for _ in range(before)] + w2[: len(w2) - cut] + [word() for _ in range(behind)]
                    if any(weighted(counts(w), counts(text[s : s + n])) >= 0.78 for s in {before, max(0, len(text) - n)}):
                        want.append((len(texts), i))
                    texts.append(text)
        h = [decontaminate._hashes(" ".join(t)) for t in texts]
        import numpy as np

        got = {(d, i) for d, i, _, _ in decontaminate.leaks(index, np.concatenate(h), np.cumsum([0, *map(len, h)]))}
        alone = {(d, i) for d, x in enumerate(h) for _, i, _, _ in decontaminate.leaks(index, x, np.array([0, len(x)]))}
        assert got == alone
        hits, total = hits + len(got & set(want)), total + len(want)
    assert total > 300 and hits >= 0.98 * total


def test_find_and_without_lower_letters_alike(spark):
    """Capital sigmas at the ends of words, dotted capital I, sharp s, Cyrillic: what find reports, without leaves out."""
    item = " ".join(f"λόγος{i} ὁδός οἶκος strada{i} мир{i}" for i in range(12))
    rows = [(1, item), (2, item.upper()), (3, "İstanbul " + item.upper() + " İ"), (4, "ΟΔΟΣ ΟΙΚΟΣ alone"), (5, None)]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_lower0", F.lit(1)), spark.createDataFrame([(7, item)], "item_id long, text string")
    found = {r["doc_id"] for r in decontaminate.find(docs, bench).collect()}
    kept = decontaminate.without(docs, bench)
    assert found >= {1, 2} and {r["doc_id"] for r in kept.collect()} == {i for i, _ in rows} - found and kept.columns == docs.columns
