"""Secret scans, language, quality, byte-level BPE."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from textloom.llm import bpe, common, language, quality, queries, secrets

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BASE = {
    "assign": (re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[2]) >= 12),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
    "hex": (re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 16),
}


def brute_secrets(text):
    hits = [(m.start(), i, m.end()) for i, (r, ok) in enumerate(BASE.values()) for m in r.finditer(text) if ok(m)]
    return [(secrets.BASE[i], s, e) for s, i, e in sorted(hits)]


PARTS = ["password", "PassWd", "token", "api_key", "apikey", "secret", "=", ":", " ", '"', "'", "==", "AKIA", "0123456789abcdef", "deadbeef", "ABCDEFGHIJKLMNOP", "x", "é", "\n", "abcdefghijkl", ".", "tok", "-", "A"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=14))
def test_secrets_as_regular_expressions_find_them(parts):
    text = "".join(parts)
    auto = secrets.compiled()
    got = [(auto.rules[i].name, s, e) for s, i, e in sorted((s, i, e) for i, s, e in secrets.found(text)) if auto.rules[i].name in secrets.BASE]
    assert got == brute_secrets(text)


def test_automaton_is_minimal():
    auto = secrets.compiled()
    label = {s: (auto.held[s], tuple(t < 0 for t in auto.rows[s])) for s in range(len(auto.rows))}
    for _ in range(len(auto.rows)):
        finer = {s: (label[s], tuple(label[t if t >= 0 else ~t] for t in auto.rows[s])) for s in label}
        ids = {v: k for k, v in enumerate(dict.fromkeys(finer.values()))}
        new = {s: ids[finer[s]] for s in finer}
        if len(set(new.values())) == len(set(label.values())):
            break
        label = new
    assert len(set(label.values())) == len(auto.rows)


def test_secret_rules_must_be_simple():
    with pytest.raises(ValueError):
        secrets.compiled((secrets.Rule("gap", r"ab(?:cd)?e?"),))


def test_secrets_over_odd_rows(odd, empty, spark, sf, documents):
    assert secrets.scan_documents(odd).count() == 12 and secrets.scan_documents(empty).count() == 0
    got = {r["doc_id"]: r for r in queries.op10_secret_automaton(spark, sf).collect()}
    for r in documents.collect():
        want = brute_secrets(r["text"] or "")
        assert got[r["doc_id"]]["base_sha256"] == secrets.sha256(secrets.listed(want))
        assert [got[r["doc_id"]][f"n_{k}"] for k in secrets.BASE] == [sum(x[0] == k for x in want) for k in secrets.BASE]


@pytest.fixture(scope="module")
def vocab():
    return bpe.vocabulary(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference(vocab):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocab.ranks, special_tokens={})


def test_bpe_as_the_library(vocab, reference, documents):
    rng = random.Random(3)
    alpha = ["a", "the", " ", "  ", "\n", "\t", "é", "ß", "漢字", "　", "\x85", "\x1c", "'s", "'ll", "'", "12", "²", "½", "Ⅷ", "\U0001f642", "!!", "--", "_", "ing", " x", "\xa0", "ª", "​", "×"]
    texts = ["".join(rng.choice(alpha) for _ in range(rng.randint(0, 12))) for _ in range(3000)] + [r["text"] for r in documents.limit(40).collect()]
    for t in texts:
        assert vocab.encode(t) == reference.encode_ordinary(t)
        assert vocab.decode(vocab.encode(t)) == t.encode()


def test_bpe_appends_and_edits(vocab):
    rng = random.Random(5)
    for _ in range(200):
        text = bytes(rng.choice(b"abcdehinrst ") for _ in range(rng.randint(1, 20)))
        last = vocab.last_tokens(text)
        for n in range(1, len(text) + 1):
            assert vocab.tokens(last, n) == vocab.tokens(vocab.last_tokens(text[:n]))
        assert vocab.last_tokens(text + b"ing", last) == vocab.last_tokens(text + b"ing")
        i = rng.randint(0, len(text))
        new, got = vocab.edited(text, last, i, min(len(text), i + 2), b"er")
        assert got == vocab.last_tokens(new)


def test_bpe_over_odd_rows(odd, empty, spark):
    assert bpe.digests(odd, PATH, public_tokenizers.PATTERN).count() == 12
    assert bpe.digests(empty, PATH, public_tokenizers.PATTERN).count() == 0
    back = {r["doc_id"]: r["text"] for r in bpe.decode(bpe.encode(odd.where("doc_id in (1, 7, 2, 3)"), PATH, public_tokenizers.PATTERN), PATH, public_tokenizers.PATTERN).collect()}
    assert back == {1: "A plain text of a few words. Nothing else.", 7: "Été 한국어 \U0001f600 ß", 2: "", 3: ""}
    staged = bpe.stage(odd, PATH, public_tokenizers.PATTERN)
    assert staged.columns == [*odd.columns, "n_tokens", "token_ids"]
    assert staged.where("n_tokens <> size(token_ids)").count() == 0


def test_known_pieces_as_the_library(vocab, reference, monkeypatch):
    """What is learned from pieces in the order of their bytes, with what one shares with the next, also after the cache has started afresh."""
    monkeypatch.setattr(bpe, "MAX_CACHE", 300)
    rng = random.Random(8)
    known, fresh = bpe.Known(vocab), 0
    for _ in range(30):
        group = {"".join(rng.choice(["a", "an", "ant", "anti", "é", "e", "ing", " ", "漢", "0", "xq"]) for _ in range(rng.randint(1, 9))) for _ in range(60)}
        before = len(known)
        known.learn(group)
        fresh += len(known) < before
        for p in group:
            ids = vocab.piece(p.encode())
            assert known[p] == (",".join(map(str, ids)), len(ids), p.encode()) and ids == reference._core_bpe.encode_single_piece(p.encode())
    assert fresh and len(known) <= 300
    text = " ".join(rng.choice(["word", "Wörter", "漢字", "12", "'s", "\n\n", "été"]) for _ in range(500))
    monkeypatch.setattr(bpe, "GROUP", 7)
    ids = reference.encode_ordinary(text)
    assert known.stream(text) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def naive_ppm(train, text, symbols):
    """Code length of text by the definition: counts of contexts of up to three symbols, method C, exclusion."""
    counts = {}
    for t in train:
        padded = [-1, -1, -1, *t]
        for i in range(3, len(padded)):
            for k in range(4):
                counts.setdefault(tuple(padded[i - k : i]), {}).setdefault(padded[i], 0)
                counts[tuple(padded[i - k : i])][padded[i]] += 1
    bits, padded = 0.0, [-1, -1, -1, *text]
    for i in range(3, len(padded)):
        s, out = padded[i], set()
        for k in range(3, -1, -1):
            here = counts.get(tuple(padded[i - k : i]))
            if not here:
                continue
            free = {x: n for x, n in here.items() if x not in out}
            if not free:
                out |= set(here)
                continue
            total = sum(free.values()) + len(free)
            if s in free:
                bits += np.log2(total / free[s])
                break
            bits += np.log2(total / len(free))
            out |= set(here)
        else:
            bits += np.log2(256 - len(out))
    return bits


def counted(texts):
    return np.unique(language.quadruples(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])), return_counts=True)


def test_many_languages_keep_all_contexts():
    """Twenty languages with trees of their own: every context stays, and code lengths are those of the definition."""
    rng = random.Random(9)
    speech = {f"l{k:02}": [" ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyzéß"[k % 9 : k % 9 + 15]) for _ in range(rng.randrange(1, 9))) for _ in range(500)).encode() for _ in range(2)] for k in range(20)}
    trees = language.train({lang: counted(texts) for lang, texts in speech.items()})
    for k, texts in enumerate(speech.values()):
        contexts = {bytes(b"\0" * max(0, 3 - i) + t[max(0, i - 3) : i]) for t in texts for i in range(len(t))}
        assert len(trees.levels[k][3].contexts) == len(contexts)
    print(f"{len(trees.langs)} languages, {sum(len(x[3].contexts) for x in trees.levels)} contexts of three bytes, {trees.nbytes / 1e6:.1f} MB")
    asked = [b"abc dabe fegh", "éß été".encode(), b"xyz"]
    got = language.code_lengths(trees, *common.utf8(pa.array([t.decode() for t in asked])))
    assert np.allclose(got, [[naive_ppm(texts, t, None) for texts in speech.values()] for t in asked])
    assert trees.nbytes < 20 << 20


def test_what_languages_are_learned_from(spark):
    rows = [(i, "word " * 10, "a") for i in range(40)] + [(i, "x" * 5000, "b") for i in range(5)] + [(100, "long " * 5000, "a"), (101, "c", "c"), (102, None, "d"), (103, "e", None), (None, "no id", "a"), (104, "", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert language.learn(df).langs == ["a", "b", "c"]
    few = language.learn(df, per_language=3, max_bytes=6000, languages=2)
    assert few.langs == ["a", "b"] and len(few.levels[1][0].seen) == 1
    whole = language.learn(df.repartition(5), per_language=7)
    again = language.learn(df.coalesce(1), per_language=7)
    assert all((x.seen == y.seen).all() and np.allclose(x.bits, y.bits) for p, q in zip(whole.levels, again.levels, strict=True) for x, y in zip(p, q, strict=True))


def test_code_lengths_are_exact():
    train = [b"abracadabra abracad", b"banana bandana", b"cab abra", b"once only"]
    trees = language.train({"x": counted(train)})
    texts = [b"abracadabra", b"banana", b"zebra!", b"", b"dada cabana", b"once more, only"]
    got = language.code_lengths(trees, *common.utf8(pa.array([t.decode() for t in texts])))[:, 0]
    assert np.allclose(got, [naive_ppm(train, t, None) for t in texts], rtol=1e-5)


def test_language(odd, empty, spark, sf, documents):
    got = queries.op6_language_ppm(spark, sf).join(documents.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.95 * len(got) and all(0 <= r["score"] <= 1 for r in got)
    trees = language.learn(odd)
    r = language.identify(odd, trees).collect()
    assert len(r) == 12 and all(x["lang_pred"] == "und" for x in r if x["doc_id"] in (2, 3, 4))
    assert language.identify(empty, trees).count() == 0
    assert {x["lang_pred"] for x in language.identify(odd, language.learn(empty)).collect()} == {"und"}


def test_quality(odd, empty, spark, sf, documents):
    got = queries.op2_quality_attention(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    assert sum((r["quality"] == 1) == (r["predicted"] == 1) for r in got) >= 0.9 * len(got)
    labels = spark.createDataFrame([(1, 1), (5, 0), (6, 1), (None, 1), (8, None), (99, 0)], "doc_id long, quality int")
    model = quality.learn(odd, labels)
    out = quality.score(odd, model)
    assert out.count() == 12 and set(out.columns) == {*odd.columns, "predicted"} and out.where("score is null").count() == 0
    assert quality.score(empty, model).count() == 0
    assert {r["score"] for r in quality.score(odd, quality.learn(odd, labels.where("quality = 1"))).collect()} == {1.0}
    assert {r["score"] for r in quality.score(odd, quality.learn(empty, labels)).collect()} == {0.5}


def test_attention_gradients_lower_the_loss():
    texts = ["good words here and there, as they are. " * 9, "***!!! ### $$$ %%% " * 9] * 30
    x, begin = quality.passages(*common.utf8(pa.array(texts)))
    y = np.array([1.0, 0.0] * 30)
    s = quality.fit(x, begin, y, epochs=20).score(x, begin)
    assert s[y == 1].min() > 0.9 and s[y == 0].max() < 0.1


def test_scores_by_the_formulas():
    """The forward pass written out for one document at a time, in plain numbers."""
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["good", "words", "here!", "X", "12", "###", "läuft."]) for _ in range(rng.choice([0, 3, 47, 48, 49, 200, 500]))) for _ in range(40)]
    x, begin = quality.passages(*common.utf8(pa.array(texts)))
    m = quality.fit(x, begin, np.array([float(len(t) % 2) for t in texts]), epochs=3)
    got, p = m.score(x, begin), {k: v.astype(float) for k, v in m.p.items()}
    for i in range(len(texts)):
        hidden, energy = [], []
        for row in x[begin[i] : begin[i + 1]].astype(float):
            h = [np.tanh(sum(a * b for a, b in zip((row - m.mean) * m.scale, p["enc"][:, j], strict=True)) + p["enc0"][j]) for j in range(p["enc"].shape[1])]
            gate = [np.tanh(np.dot(h, p["tanh"][:, j])) / (1 + np.exp(-np.dot(h, p["gate"][:, j]))) for j in range(p["att"].shape[0])]
            hidden.append(h)
            energy.append(np.exp(np.dot(gate, p["att"])))
        weight = [e / sum(energy) for e in energy]
        out = sum(w * np.dot(h, p["out"]) for w, h in zip(weight, hidden, strict=True)) + p["out0"][0]
        assert abs(1 / (1 + np.exp(-out)) - got[i]) < 1e-4
    assert [b - a for a, b in zip(begin, begin[1:])] == [max(1, -(-len(t.split()) // quality.PASSAGE)) for t in texts]  # noqa: B905


def test_a_long_text_in_sections_is_the_whole(monkeypatch):
    rng = random.Random(6)
    text = "  " + " ".join(rng.choice(["alpha", "Beta.", "γάμμα", "x" * 40, "\n"]) for _ in range(3000))
    buf, off = common.utf8(pa.array([text]))
    x, begin = quality.passages(buf, off)
    m = quality.fit(np.concatenate([x, x[:9]]), np.array([0, len(x), len(x) + 9]), np.array([1.0, 0.0]), epochs=2)
    key, n = counted([buf[:9000].tobytes()])
    trees = language.train({"a": (key, n), "b": (key[::3], n[::3])})
    want, bits = m.of_texts(buf, off), language.code_lengths(trees, buf, off)
    for size in (100, 997, 5000):
        monkeypatch.setattr(quality, "SECTION", size)
        monkeypatch.setattr(language, "STEP", size)
        parts = list(quality.sections(buf, limit=size))
        assert b"".join(p.tobytes() for p in parts) == buf.tobytes() and (len(parts) > 1)
        assert np.concatenate([quality.passages(p, np.array([0, len(p)]))[0] for p in parts]).shape == x.shape
        assert np.allclose(m.of_texts(buf, off), want, rtol=1e-5) and np.allclose(language.code_lengths(trees, buf, off), bits)
    assert [len(p) for p in quality.sections(np.frombuffer(b" " * 1000, np.uint8), limit=10)] == [1000]


def test_offsets_of_many_hits():
    text = "é password=abcdefghijkl1 ü " * 300 + "é"
    hits = [(secrets.compiled().rules[i].name, s, e) for i, s, e in secrets.found(text)]
    assert [h for h in sorted(hits, key=lambda h: h[1:]) if h[0] in secrets.BASE] == brute_secrets(text)
