"""Word hashes, packed keys and the key exchange."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textloom.llm import common, tokens

TEXT = st.text(st.sampled_from(list("abAB \t\n\x0b\x0c\r\x1c\x85éß漢'.,")), max_size=40)


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXT, max_size=6))
def test_words_and_hashes(texts):
    buf, off = common.utf8(pa.array(texts, pa.string()))
    buf = common.lower(buf)
    starts, ends, first = common.word_spans(buf, off)
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    want = [re.findall("[^\x20\x09-\x0d]+", t.translate(low)) for t in texts]
    raw = buf.tobytes()
    got = [[raw[starts[k] : ends[k]].decode() for k in range(first[i], first[i + 1])] for i in range(len(texts))]
    assert got == want
    h = common.span_hashes(buf, starts, ends).tolist()
    flat = [w for ws in want for w in ws]
    assert len(set(zip(flat, h, strict=True))) == len(set(flat)) == len(set(h))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, (1 << 64) - 1), max_size=50, unique=True), st.integers(0, 40))
def test_packed_keys(keys, zeros):
    a = np.array(sorted({k >> zeros << zeros for k in keys}), np.uint64)
    assert (tokens.unpack_keys(tokens.pack_keys(a)) == a).all()
    assert (tokens.unpack(tokens.pack(a), np.uint64) == a).all()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 50), st.integers(0, 5)), max_size=12))
def test_ragged(parts):
    starts, lens = (np.array([p[i] for p in parts], np.int64) for i in (0, 1))
    assert common.ragged(starts, lens).tolist() == [s + k for s, n in parts for k in range(n)]


@pytest.mark.parametrize(("digit", "fan", "keys"), [(8, 256, 1 << 20), (2, 4, 16), (2, 4, 2)])
def test_exchange_adds_up_over_blocks(spark, monkeypatch, tmp_path, digit, fan, keys):
    """In one step, in two and in four, with a second level of other sizes, of which the totals must be the same."""
    for name, value in (("DIGIT", digit), ("FAN", fan), ("BUCKET_KEYS", keys)):
        monkeypatch.setattr(tokens, name, value)
    texts = [f"common w{i} w{i % 7} w{i % 3}" for i in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(12)
    table = tokens.blocks(docs.withColumns({"kind": (F.col("doc_id") % 2).cast("int"), "flag": F.lit(0)}), f"{tmp_path}/b")

    def ask(row):
        *_, distinct, index = tokens.read_block(row)
        n = np.bincount(index, minlength=len(distinct))
        return [(distinct[:0], n[:0], n[:0]), (distinct, n, np.zeros(len(n))), (distinct[::2], n[::2], n[::2] > 1)]

    def use(row, answer):
        *_, distinct, _ = tokens.read_block(row)
        assert 0 not in answer and (answer[2][0] <= answer[1][0][::2]).all() and (answer[2][1] <= answer[2][0]).all()
        return pa.table({"key": distinct.view(np.int64), "n": answer[1][0].astype(np.int64)})

    assert len(tokens.digits_for(300)) == {1 << 20: 1, 16: 3, 2: 4}[keys]
    told = tokens.totals(table, ask, [0, 300, 20], f"{tmp_path}/t")
    assert told.where("receiver is not null").groupBy("level", "receiver").count().agg(F.max("count")).first()[0] <= fan
    got = {(r["key"], r["n"]) for r in tokens.answered(table, told, use, "key long, n long").collect()}
    want = Counter(w for t in texts for w in t.split())
    words = list(want)
    buf, off = common.utf8(pa.array(words))
    h = common.span_hashes(buf, off[:-1], off[1:]).view(np.int64).tolist()
    assert table.count() >= 2 and got == {(k, want[w]) for k, w in zip(h, words, strict=True)}
    assert told.where("level = 1").agg(F.sum("distinct")).first()[0] == len(words)
    assert {x.name for x in tmp_path.iterdir()} == {"b", "t"}
