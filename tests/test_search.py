"""The trigram index against a plain search of every text."""

import random

import pytest
from pyspark.sql import functions as F

from textloom.operators import concordance, search
from textloom.sources import files

TEXTS = ["the cat sat on the mat", "The  Cat\tsat", "", None, " \n", "a", "ab", "ÉTÉ à la mer", "été", "x" * 40, "abcabcabc", "bca abd", "The cat sat on the mat", "one\ntwo  three", "\U0001f600 smile \U0001f600\U0001f600"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(4)
    more = [" ".join(rng.choice(["the", "cat", "mat", "abc", "bca", "été", "tha", "het"]) for _ in range(rng.randrange(1, 12))) for _ in range(120)]
    return spark.createDataFrame([(i * 3, t, "c") for i, t in enumerate(TEXTS + more)], "key long, text string, lowered string")


@pytest.fixture(scope="module")
def index(rows):
    return search.build(rows, "key", stretch=50)


@pytest.mark.parametrize("query", ["the", "The c", "at", "ab", "t o", "été", "ÉTÉ À", "zz", "zzz", "abcab", "cat sat on", "x", "", "a", "😀", "😀😀", "xxxx", "two three"])
def test_as_a_plain_search(rows, index, query):
    shown = rows.withColumn("text", F.trim(F.regexp_replace("text", r"(?U)\s+", " "))).where("text <> ''").select("key", "text")
    want = [tuple(r) for r in concordance.search(shown, query, ["key"]).orderBy("hit").collect()]
    got = search.search(index, query).orderBy("hit").drop("candidates").collect()
    assert [tuple(r) for r in got] == want


def test_candidates_hold_every_trigram(index):
    low = {r["key"]: r["lowered"] for r in index.texts.collect()}
    for query in ("cat sat", "abcab", "th", "the mat", "nothing here"):
        want = {k for k, x in low.items() if all(g in x for g in search.pieces(query))}
        assert {r["key"] for r in search.candidates(index, query).collect()} == want
        assert {r["candidates"] for r in search.search(index, query).collect()} <= {len(want)}


def test_texts_are_asked_for_by_key(index, monkeypatch, tmp_path):
    plan = search.search(index, "cat sat on")._jdf.queryExecution().toString()
    assert "PushedFilters: [" in plan and "In(key" in plan.replace(" ", "")[:100_000]
    want = [tuple(r) for r in search.search(index, "the").orderBy("hit").collect()]
    monkeypatch.setattr(search, "BY_KEY", 3)  # more candidates than that are joined
    assert [tuple(r) for r in search.search(index, "the").orderBy("hit").collect()] == want


def test_only_the_first_are_shown(index):
    got = search.search(index, "the", shown=5).collect()
    assert len(got) == 5 and {r["total"] for r in got} == {search.search(index, "the").count()}


def test_an_index_can_be_opened_again(spark, index):
    again = search.opened(spark, index.folder)
    assert search.search(again, "cat").count() == search.search(index, "cat").count() > 0


def test_an_empty_index(spark, rows):
    assert search.search(search.build(rows.where("false"), "key"), "the").count() == 0


def test_what_a_page_is_searched_for(spark):
    html = '<body><div class="p">a <a class="fol">12</a>b <i>c</i> &amp; d<div class="noto">in <br>note</div></div><p class="x tit">T<span class="grupi">twice</span><span class="grupi sola">once</span></p><div class="menu">no</div><script class="p">s</script><div class="cen"> </div><p class="fer">open'
    got = files.searched_blocks(spark.createDataFrame([(1, html), (2, None), (3, "<div class='fol'><p class='p'>x</p></div>")], "page_id long, html string")).orderBy("page_id", "rank").collect()
    assert [tuple(r) for r in got] == [(1, 1, "p", "a b c & din note"), (1, 2, "noto", "in note"), (1, 3, "tit", "Tonce"), (1, 4, "fer", "open"), (3, 1, "p", "x")]


def test_files_in_order(spark):
    names = [f"n{i % 97}-{i}" for i in range(300)]
    got = files.by_name(spark.createDataFrame([(x,) for x in names], "name string").repartition(7), "name").orderBy("nth").collect()
    assert [(r["name"], r["nth"]) for r in got] == [(x, i) for i, x in enumerate(sorted(names), 1)]


def test_page_index_of_a_cut_reference(spark, tmp_path):
    from textloom.plans import queries, search as plans  # noqa: F401

    spark.createDataFrame([(1, "<h1>a &amp;&amp</h1><p>b &lt</p>")], "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert [r["text"] for r in queries.QUERIES["page_index"](spark, str(tmp_path)).collect()] == ["a &&amp"]
    assert [r["text"] for r in queries.QUERIES["class_blocks"](spark, str(tmp_path)).orderBy("rank").collect()][:2] == ["a &&amp", "b &lt *x* **y**"]


def test_lists_of_neighbouring_texts():
    import numpy as np

    texts = {70: "abcabc😀", 3: "ab", 64: "", 5: "bcab\x00ab", 130: "abc"}
    grams, parts, begin, keys = search._lists(np.array(list(texts)), list(texts.values()), 64)
    ends = [*begin[1:].tolist(), len(keys)]
    got = {(g, p): keys[a:z].tolist() for g, p, a, z in zip(grams, parts.tolist(), begin.tolist(), ends, strict=True)}
    want = {}
    for k in sorted(texts):
        t = texts[k] + search.END
        for g in {t[i : i + 3] for i in range(len(t) - 2)}:
            want.setdefault((g, k // 64), []).append(k)
    assert got == want
