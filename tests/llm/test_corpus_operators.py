"""Language model, token store, pipeline."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import tiktoken.load
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from textloom.llm import bpe, common, decontaminate, fingerprints, jaccard, language, linededup, lm, quality, queries, secrets, store

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
WORDS = public_tokenizers.path("word_bpe_49k.json")


def toks(text):
    return re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER)) + [None]


def test_model_scores(spark, sf, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    got = {r["doc_id"]: r for r in queries.op4_deleted_interpolation(spark, sf).collect()}
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    c = Counter(w for i, t in rows if not held(i) for w in toks(t))
    n, v = sum(c.values()), len(c)
    for i, t in rows:
        g, w = got[i], toks(t)
        assert (g["held_out"], g["n_tokens"], g["n_known"], g["train_tokens"]) == (held(i), len(w), sum(c[x] > 0 for x in w), n)
        assert math.isclose(g["base_score"], sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), rel_tol=1e-9)
    assert sum(g["score"] - g["base_score"] for g in got.values() if g["held_out"]) > 0


def test_model_probabilities_are_those_of_the_formula(spark):
    """Each score is a product of the interpolated probabilities; weights are read off documents of one pair."""
    rows = [(i, t) for i, t in enumerate(["a b a b", "b a", "a b c", "c a b", "a"] * 8)]
    out = {r["doc_id"]: r for r in lm.score(spark.createDataFrame(rows, "doc_id long, text string"), F.lit(False)).collect()}
    pair, one = Counter(), Counter()
    ctx = Counter()
    for _, t in rows:
        w = toks(t)
        one.update(w)
        pair.update(zip(["<s>", *w], w))  # noqa: B905
        ctx.update(["<s>", *w[:-1]])
    n, v = sum(one.values()), len(one)
    for i, t in rows:
        w = toks(t)
        low = sum(math.log10(min(pair[a, b] / ctx[a], one[b] / n, 1 / (v + 1))) for a, b in zip(["<s>", *w], w))  # noqa: B905
        high = sum(math.log10(max(pair[a, b] / ctx[a], one[b] / n, 1 / (v + 1))) for a, b in zip(["<s>", *w], w))  # noqa: B905
        assert low - 1e-9 <= out[i]["score"] <= high + 1e-9


def test_weights_maximise_the_likelihood():
    cells = [(3, 20, 4, 10.0), (3, -10000, 8, 5.0), (3, 12, -10000, 3.0), (3, -10000, -10000, 2.0)]
    w = lm.learn_weights(cells, 400)[3]
    like = lambda a: sum(n * math.log2(a[0] * (p > -10000) * 2 ** (p / 4) + a[1] * (u > -10000) * 2 ** (u / 4) + a[2]) for _, p, u, n in cells)
    best = max(like((x / 100, y / 100, 1 - (x + y) / 100)) for x in range(1, 99) for y in range(1, 99 - x))
    assert abs(w.sum() - 1) < 1e-9 and like(w) >= best - 1e-3


def test_model_scores_by_the_formula(spark, sf, documents, tmp_path):
    """Every score from plain counts, with the model's own weights; and the weights from plain counts of the deleted documents."""
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    rows = {r["doc_id"]: ["<", *re.findall("[^\x20\x09-\x0d]+", (r["text"] or "").translate(low)), ">"] for r in documents.collect()}
    flags = {r["doc_id"]: (r["h"], r["d"]) for r in documents.select("doc_id", (common.fold(7) == 2).alias("h"), (F.pmod(F.xxhash64(F.lit("deleted"), "doc_id"), F.lit(lm.DELETED)) == 0).alias("d")).collect()}

    def counts(ids):
        one, two, context = Counter(), Counter(), Counter()
        for i in ids:
            one.update(rows[i][1:])
            context.update(rows[i][:-1])
            two.update(zip(rows[i], rows[i][1:]))  # noqa: B905
        return one, two, context

    model = lm.learn(documents, common.fold(7) == 2, str(tmp_path))
    train = [i for i, (h, _) in flags.items() if not h]
    one, two, context = counts(train)
    n, v = sum(one.values()), len(one)
    assert (model.tokens, model.vocabulary) == (n, v)
    got = {r["doc_id"]: r for r in lm.score(documents, common.fold(7) == 2).collect()}
    for i, w in rows.items():
        want = 0.0
        for a, b in zip(w, w[1:]):  # noqa: B905
            weight = model.weights[context[a].bit_length()]
            want += math.log10(weight[0] * (two[a, b] / context[a] if context[a] else 0) + weight[1] * one[b] / n + weight[2] / (v + 1))
        assert abs(got[i]["score"] - want) < 1e-6 * abs(want) and got[i]["train_tokens"] == n
    kept, deleted = [i for i in train if not flags[i][1]], [i for i in train if flags[i][1]]
    one, two, context = counts(kept)
    n, cells = sum(one.values()), {}
    for i in deleted:
        for a, b in zip(rows[i], rows[i][1:]):  # noqa: B905
            cells.setdefault(context[a].bit_length(), []).append((two[a, b] / context[a] if context[a] else 0, one[b] / n, 1 / (v + 1)))
    for bucket, parts in cells.items():
        if len(parts) < 200:
            continue
        parts, share = np.array(parts), np.array([1 / 3, 1 / 3, 1 / 3]) if bucket else np.array([0, 0.5, 0.5])
        for _ in range(40):
            each = parts * share
            share = (each / each.sum(1, keepdims=True)).mean(0)
        assert np.abs(share - model.weights[bucket]).max() < 0.03


def test_ten_megabytes_of_text(spark, tmp_path):
    """Every operator over a very long text among short ones, and a very long word."""
    rng = np.random.default_rng(1)
    words = np.array([f"wörd{i}" if i % 5 else f"Word{i}." for i in range(4000)])
    long = " ".join(words[rng.integers(0, 4000, 1_500_000)])
    rows = [(1, long), (2, "a short text. of some words"), (3, "x" * 2_000_000), (4, long[:400] + " benchmark passage with a good many words of its own in it")]
    docs = spark.createDataFrame([(*r, "en", len(r[1])) for r in rows], "doc_id long, text string, lang string, n_chars long").repartition(2)
    docs = common.written(docs, f"{tmp_path}/docs")
    assert len(long.encode()) > 10_000_000
    bench = spark.createDataFrame([(7, "benchmark passage with a good many words of its own in it")], "item_id long, text string")
    assert [(r["doc_id"], r["item_id"]) for r in decontaminate.find(docs, bench).collect()] == [(4, 7)]
    model = quality.learn(docs, spark.createDataFrame([(2, 1), (4, 0)], "doc_id long, quality int"))
    assert quality.score(docs, model).where("score between 0 and 1").count() == 4
    assert {r["component_id"] for r in jaccard.join(docs).collect()} == {1, 2, 3, 4}
    assert lm.score(docs, F.lit(False)).where("doc_id = 1").first()["n_tokens"] == 1_500_001
    from test_pair_operators import brute_dedup

    assert {r["doc_id"]: r["text"] for r in linededup.dedup_lines(docs).collect()} == brute_dedup(rows)
    assert {r["lang_pred"] for r in language.identify(docs, language.learn(docs.where("doc_id <> 3"))).collect()} == {"en"}
    t = Tokenizer.from_file(WORDS)
    store.write(docs, f"{tmp_path}/s", WORDS)
    assert {r["doc_id"]: r["n_tokens"] for r in store.read(spark, f"{tmp_path}/s").collect()}[4] == len(t.encode(rows[3][1], add_special_tokens=False).ids) + 1
    got = {r["doc_id"]: r for r in bpe.digests(docs.where("doc_id <> 3"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN).collect()}
    assert got[1]["decoded_sha256"] == hashlib.sha256(long.encode()).hexdigest()
    assert {r["n_chars"] for r in fingerprints.fingerprints(docs).collect()} == {len(t) for _, t in rows}
    assert secrets.scan_documents(docs).count() == 4


def test_model_over_odd_rows(odd, empty):
    r = lm.score(odd, common.fold(7) == 2).collect()
    assert len(r) == 12 and sorted(x["n_tokens"] for x in r if x["doc_id"] in (2, 3, 4)) == [1, 1, 1] and all(np.isfinite(x["score"]) for x in r)
    assert sum(x["doc_id"] is None for x in r) == 1
    assert lm.score(empty, F.lit(False)).count() == 0
    assert all(x["score"] == 0 and x["n_known"] == 0 for x in lm.score(odd, F.lit(True)).collect())


def test_store_gives_back_what_the_library_encodes(spark, documents, odd, empty, tmp_path):
    t = Tokenizer.from_file(WORDS)
    special = spark.createDataFrame([(5000, "hello <|endoftext|> there"), (5001, "<|startoftext|><|endoftext|>"), (5002, "a<|ENDOFTEXT|>b <|endoftext|")], "doc_id long, text string")
    docs = documents.select("doc_id", "text").unionAll(odd.where("doc_id is not null").select(F.col("doc_id") + 1000, "text")).unionAll(special)
    store.write(docs, f"{tmp_path}/s", WORDS)
    rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda x: x[0])
    ids = {}
    for i, x in rows:
        ids.setdefault(i, []).append(t.encode(x, add_special_tokens=False).ids + [store.END])
    got = store.read(spark, f"{tmp_path}/s").collect()
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == Counter((i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, xs in ids.items() for x in xs)
    assert [r["start"] for r in sorted(got, key=lambda r: r["start"])] == [r["start"] for r in sorted(got, key=lambda r: (r["doc_id"], r["start"]))]
    some = {(r["doc_id"], r["copy"]): r["ids"] for r in store.rebuilt(spark, f"{tmp_path}/s", F.col("doc_id") < 20).collect()}
    assert some == {(i, 0): xs[0] for i, xs in ids.items() if i < 20}
    store.write(empty, f"{tmp_path}/e", WORDS)
    assert store.read(spark, f"{tmp_path}/e").count() == 0


def test_store_stores_once_and_sees_damage(spark, tmp_path):
    text = " ".join(f"word{i}" for i in range(3000))
    d = spark.createDataFrame([(i, text) for i in range(5)] + [(9, "new words in front " + text)], "doc_id long, text string")
    store.write(d, f"{tmp_path}/s", WORDS)
    chunks = spark.read.parquet(f"{tmp_path}/s/chunks")
    kept = chunks.where("ids is not null")
    assert kept.count() == kept.select("hash").distinct().count() and kept.agg(F.sum("n")).first()[0] < 1.4 * store.read(spark, f"{tmp_path}/s").where("doc_id = 0").first()["n_tokens"]
    bad = chunks.withColumn("ids", F.when(F.col("ids").isNotNull(), F.concat(F.substring("ids", 1, 2), F.substring("ids", 1, 2), F.substring("ids", 5, 1 << 20))))
    common.written(bad, f"{tmp_path}/t/chunks")
    for part in ("recipes", "manifest"):
        common.written(spark.read.parquet(f"{tmp_path}/s/{part}"), f"{tmp_path}/t/{part}")
    with pytest.raises(Exception, match="hash"):
        store.read(spark, f"{tmp_path}/t").collect()
    for part in ("chunks", "manifest"):
        common.written(spark.read.parquet(f"{tmp_path}/s/{part}"), f"{tmp_path}/u/{part}")
    common.written(spark.read.parquet(f"{tmp_path}/s/recipes").where("doc_id <> 3"), f"{tmp_path}/u/recipes")
    with pytest.raises(Exception, match="manifest"):
        store.read(spark, f"{tmp_path}/u").collect()


def test_crc_of_pieces_and_merkle_subtrees(spark, monkeypatch):
    import random

    rng = random.Random(5)
    pieces = [rng.randbytes(rng.choice([0, 1, 2, 7, 4096, 100_003])) for _ in range(40)]
    first = np.array([0, 1, 4, 4 + 20, 40])
    crc, size = np.array([zlib.crc32(x) for x in pieces]), np.array([len(x) for x in pieces])
    assert store.joined_crc(crc, size, first).tolist() == [zlib.crc32(b"".join(pieces[a:b])) for a, b in zip(first[:-1], first[1:], strict=True)]
    assert store.joined_crc(crc[:0], size[:0], first[:1]).tolist() == []
    monkeypatch.setattr(store, "SUBTREE", 4)
    rows = [(p, i, rng.randbytes(32)) for p, n in enumerate((1, 3, 4, 5, 21)) for i in range(n)]
    got = store.manifest(spark.createDataFrame(rows, "part int, at long, root binary").withColumn("n_tokens", F.lit(2).cast("long"))).collect()
    assert {(r["part"], r["n_documents"], r["n_tokens"], bytes(r["root"])) for r in got} == {(p, n, 2 * n, store.merkle([x for q, _, x in rows if q == p])) for p, n in enumerate((1, 3, 4, 5, 21))}


def test_words_of_latin_letters_go_to_the_model_at_once(monkeypatch):
    """Each letter, pairs of them and words of them get the library's ids; only other words take all its steps."""
    import random

    import pyarrow as pa

    letters = [chr(c) for c in [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x100)]]
    draw = random.Random(1)
    words = [*letters, *(a + b for a in letters for b in letters), *("".join(draw.choices(letters, k=k)) for k in range(3, 40) for _ in range(20))]
    others = ["e\u0301a", "l'été", "a×b", "İx", "ΑΣ", "한국어", "a\x01b", "x²", "naïve—word"]
    texts = [" ".join(words), "", " ".join(others), *words[-200:], *others]
    marked, plain = [], store.Encoder._marked

    def seen(self, some):
        marked.extend(some)
        return plain(self, some)

    monkeypatch.setattr(store.Encoder, "_marked", seen)
    ids, begin = store.Encoder(WORDS).encode(pa.array(texts, pa.string()), store.END)
    want = [[*x.ids, store.END] for x in Tokenizer.from_file(WORDS).encode_batch_fast(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(begin[:-1], begin[1:], strict=True)] == want
    assert marked and not any(set(w) <= {*letters} - {*"×÷"} for w in marked)


def test_words_one_by_one_are_the_whole_text():
    import random

    import pyarrow as pa

    e, t = store.Encoder(WORDS), Tokenizer.from_file(WORDS)
    rng = random.Random(2)
    alpha = ["a", "The", " ", "\n", "é", "É", "ß", "漢字", "　", "\x85", "\x1c", "'s", "'LL", "'", "12", "²", "\U0001f642", "!!", "--", "_", "ing.", "x,", "\xa0", "İ", "ΑΣ", "é", "<|endoftext|>", "\x01", "\x00", "|", "…", "a…."]
    texts = ["".join(rng.choice(alpha) for _ in range(rng.randint(0, 12))) for _ in range(2000)]
    ids, begin = e.encode(pa.array(texts), 2)
    assert e.by_word and all(ids[begin[i] : begin[i + 1]].tolist() == t.encode(x, add_special_tokens=False).ids + [2] for i, x in enumerate(texts))


def test_pipeline_stages(spark, sf, documents):
    """Each stage against the plain reading of its rule, on what the stage before it gave."""
    docs, kept = documents, []
    for _, stage in corpus_pipeline.STAGES:
        docs = common.written(stage(spark, docs, sf), common.shared_folder(spark))
        kept.append(docs)
    ids = [{r["doc_id"] for r in d.select("doc_id").collect()} for d in kept]
    model = quality.learn(documents, spark.read.parquet(f"{sf}/labels.parquet"), common.fold(4) != 2)
    alone = {r["doc_id"]: float(model.score(*quality.passages(np.frombuffer(r["text"].encode(), np.uint8), np.array([0, len(r["text"].encode())])))[0]) for r in documents.collect()}
    assert ids[0] == {i for i, x in alone.items() if x >= quality.KEEP} and len(ids[0]) > 150
    from test_pair_operators import brute_components, brute_dedup

    left = brute_dedup([(r["doc_id"], r["text"]) for r in kept[0].collect()])
    was = {r["doc_id"]: r["text"] for r in kept[0].collect()}
    assert {r["doc_id"]: r["text"] for r in kept[1].collect()} == {i: t for i, t in left.items() if t == was[i] or t.strip()}

    comp = brute_components([(r["doc_id"], r["text"]) for r in kept[1].collect()])
    assert ids[2] == {i for i, c in comp.items() if i == c}
    items = [" ".join(r["text"].lower().split()) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    holds = {r["doc_id"] for r in kept[2].collect() if any(f" {i} " in f" {' '.join(r['text'].lower().split())} " for i in items)}
    assert not holds & ids[3] and ids[2] - ids[3] == {r["doc_id"] for r in decontaminate.find(kept[2], spark.read.parquet(f"{sf}/benchmark.parquet")).collect()}
    assert all(d.columns == documents.columns for d in kept[:4]) and ids[4] == ids[3]
    assert kept[4].where("n_tokens <> size(token_ids)").count() == 0
    encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=tiktoken.load.load_tiktoken_bpe(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    assert all(r["token_ids"] == encoding.encode_ordinary(r["text"]) for r in kept[4].collect())
    assert jaccard.PERCENT == 75
