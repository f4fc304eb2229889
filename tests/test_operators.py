import re

import numpy as np
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators import align, anchors, audit, concordance, corpus, glossary, layout, lexicon, notes, stats
from textloom.sources import sinks


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_blocks_ranks_and_sections(spark):
    d = spark.createDataFrame([("a", "intro\n\n12. — one\n\n \n\nmore\n\n140. – two\n\n13. - no")], "doc_id string, text string")
    s = corpus.sections(corpus.blocks(d))
    assert rows(s, "rank", "section") == [(1, None), (2, 12), (3, 12), (4, 140), (5, 140)]


def test_blocks_join_to_the_text(spark):
    d = spark.createDataFrame([(1, "a\n\nb c\n\nd"), (2, ""), (3, None)], "doc_id long, text string")
    back = corpus.blocks(d).groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_list(F.struct("rank", "text")))["text"], "\n\n").alias("t"))
    assert rows(back, "doc_id", "t") == [(1, "a\n\nb c\n\nd")]


def test_numbering(spark):
    d = spark.createDataFrame([(1, 5, "a"), (1, 8, "b"), (1, None, "ccc"), (2, None, "x")], "g int, number int, text string")
    assert rows(corpus.numbering(d, F.col("number"), F.length("text"), ["g"]), "g", "numbers", "absent", "unnumbered", "unnumbered_size") == [(1, 2, 2, 1, 3), (2, 0, None, 1, 1)]
    n = spark.createDataFrame([(1,), (3,), (70000,), (70002,), (None,)], "number long")
    got = {r["number"] for r in corpus.gaps(n).collect()}
    assert got == set(range(1, 70003)) - {1, 3, 70000, 70002}


def test_moved_and_reunited(spark):
    d = spark.createDataFrame([(1, i, t) for i, t in enumerate(["x", "add", "til", "z"], 1)], "doc_id int, rank int, text string")
    assert rows(corpus.moved(d, F.col("text") == "add", F.col("text") == "til", ["doc_id"]), "new_rank", "text") == [(1, "x"), (2, "til"), (3, "add"), (4, "z")]
    d = spark.createDataFrame([(1, 1, "a"), (1, 2, "b."), (1, 3, "c")], "doc_id int, rank int, text string")
    assert rows(corpus.reunited(d, F.endswith("text", F.lit(".")), ["doc_id"], "rank"), "paragraph", "text") == [(1, "a b."), (2, "c")]


def test_topics_match_many(spark):
    d = spark.createDataFrame([(1, 1, "Ō and the")], "doc_id int, rank int, text string")
    assert rows(concordance.topic_hits(d, {"a": "ō", "b": r"\bthe\b", "c": "x"}), "topic") == [("a",), ("b",)]


def test_search_counts_all_and_shows_some(spark):
    d = spark.createDataFrame([(i, f"Hit {i}") for i in range(5)], "doc_id int, text string")
    assert rows(concordance.search(d, "hit", ["doc_id"], shown=2), "doc_id", "hit", "total") == [(0, 1, 5), (1, 2, 5)]
    assert concordance.search(d, "h", ["doc_id"]).count() == 0


def test_glossary(spark):
    body = "lead\n***-uro** — what is made. Ex. : *piktar*, pikturo, skulturo.\n**-an-.** — of a place: **urbano**, Franca\n**ge-** — both: **gepatri**"
    cut = glossary.cut(spark.createDataFrame([(1, body)], "doc_id int, text string"))
    assert rows(cut, "nth", "head") == [(1, "-uro"), (2, "-an-"), (3, "ge-")]
    assert [r["example"] for r in glossary.entries(cut).orderBy("nth").collect()] == ["pikturo", "urbano", "gepatri"]


def test_anchors_avoid_every_taken_one(spark):
    d = spark.createDataFrame([(1, 1, "x"), (1, 2, "x"), (1, 3, "x-2"), (1, 4, "x"), (1, 5, "nt1")], "g int, pos int, base string")
    got = anchors.minted(d, F.col("base"), ["g"], ["pos"], spark.createDataFrame([(1, "nt1")], "g int, anchor string"))
    assert rows(got, "pos", "anchor") == [(1, "x"), (2, "x-3"), (3, "x-2"), (4, "x-4"), (5, "nt1-2")]
    assert anchors.faults(got, ["g"]).count() == 0


def test_kinship(spark):
    present = spark.createDataFrame([(1, "a"), (2, "b-c"), (3, "d-2"), (4, "e-f")], "pos int, id string")
    old = spark.createDataFrame([("a",), ("b",), ("d",), ("e-f-g-h",), ("zz",)], "anchor string")
    assert sorted(map(str, rows(anchors.kin(old, present), "anchor", "id", "rule"))) == sorted(map(str, [("a", "a", 1), ("b", "b-c", 2), ("d", "d-2", 3), ("e-f-g-h", "e-f", 4), ("zz", None, None)]))


def test_notes(spark):
    frag = spark.createDataFrame([(1, 10, "text <b c='x1'>word</b> x1"), (1, 11, "x1 again, see noto 9"), (1, 12, "end")], "leaf int, pos int, text string")
    n = spark.createDataFrame([(1, 1, "x1"), (1, 2, "1"), (1, 9, "zz"), (1, 8, "yy")], "leaf int, num int, call string")
    assert rows(notes.resolved(n, frag), "num", "block", "how") == [(1, 10, 1), (2, 10, 1), (8, 12, 4), (9, 11, 3)]


def test_nearest_tie_goes_to_the_lower(spark):
    d = spark.createDataFrame([(1, i) for i in range(1, 8)], "g int, at long")
    p = spark.createDataFrame([(1, 2, "a"), (1, 6, "b")], "g int, at long, value string")
    assert rows(layout.nearest(d, p, ["g"], "at"), "at", "value") == [(1, "a"), (2, "a"), (3, "a"), (4, "a"), (5, "b"), (6, "b"), (7, "b")]
    assert [v for _, v in sorted(rows(layout.before(d, p, ["g"], "at").fillna("-", ["value"]), "at", "value"))] == ["-", "a", "a", "a", "a", "b", "b"]


def test_matcher_on_the_worked_case():
    mid = lambda xs: np.array([(a + b) / 2 for a, b in xs])
    a, b = mid([(100, 130), (140, 170), (180, 210), (260, 290)]), mid([(105, 135), (145, 175), (185, 215), (222, 228), (265, 295)])
    assert align.matched(a, b) == [(0, 0), (1, 1), (2, 2), (3, 4)]


def test_matcher_is_the_cheapest():
    rng = np.random.default_rng(0)
    for _ in range(30):
        x, y = np.sort(rng.uniform(0, 300, rng.integers(2, 7))), np.sort(rng.uniform(0, 300, rng.integers(2, 7)))
        scale, offset = align.fit(x, y)
        best = {}

        def cost(i, j):
            if (i, j) not in best:
                if i == len(x) or j == len(y):
                    best[i, j] = align.GAP * (len(x) - i + len(y) - j)
                else:
                    d = abs(scale * x[i] + offset - y[j])  # noqa: B023
                    best[i, j] = min(cost(i + 1, j) + align.GAP, cost(i, j + 1) + align.GAP, (d if d <= align.FARTHEST else np.inf) + cost(i + 1, j + 1))
            return best[i, j]

        pairs = align.matched(x, y)
        own = sum(abs(scale * x[i] + offset - y[j]) for i, j in pairs) + align.GAP * (len(x) + len(y) - 2 * len(pairs))
        assert abs(own - cost(0, 0)) < 1e-6 and pairs == sorted(pairs)


def test_rank_join_and_error_rate(spark):
    a = spark.createDataFrame([(1, 1, "x"), (1, 2, "y")], "page int, rank int, text string")
    b = spark.createDataFrame([(1, 1, "x"), (1, 2, "z"), (1, 3, "w")], "page int, rank int, text string")
    c = align.by_rank(a, b, ["page", "rank"])
    assert rows(c, "rank", "same") == [(1, True), (2, False), (3, False)]
    assert align.first_difference(c, ["page"], "rank").first()["differences"] == 2
    p = spark.createDataFrame([(1, "kitten", "sitting"), (1, None, "abc")], "g int, r string, t string")
    assert align.error_rate(p, ["g"], F.col("r"), F.col("t")).where("g = 1").first()["distance"] == 6


def test_audits(spark):
    d = spark.createDataFrame([(1, 1, "ab sen"), (1, 2, "fingro x"), (1, 3, "; bad"), (1, 4, "*"), (1, 5, "....")], "doc_id long, rank long, text string")
    lex = spark.createDataFrame([("senfingro", 1), ("sen", 9), ("fingro", 1)], "word string, n long")
    assert rows(audit.lost_hyphens(d, lex), "rank", "welded") == [(1, "senfingro")]
    assert rows(audit.starts(d, "c", ":;!?"), "line") == [(3,)]
    assert rows(audit.junk(d), "rank") == [(4,)]

    def broken():
        raise ValueError("no page")

    late = lambda: audit.findings(d, "late", F.raise_error(F.lit("stop")).cast("string"))
    f = audit.tolerated({"starts": lambda: audit.starts(d, "starts", ";"), "broken": broken, "late": late}, spark)
    assert rows(audit.report(f), "check", "severity", "n") == [("broken", "failure", 1), ("late", "failure", 1), ("starts", "failure", 1)]
    assert rows(audit.starts(d, "c", ":;!?", F.col("text").contains("bad")), "line") == []


def test_lexicons_inside_rows(spark):
    d = spark.createDataFrame([(1, "A", "x Y x"), (2, "A", "x"), (3, "B", "y"), (4, "B", ""), (5, "B", None)], "doc_id int, lang string, text string")
    assert rows(lexicon.leave_one_out(d, "doc_id", "lang"), "doc_id", "cls", "known") == [(1, "A", 1), (1, "B", 1), (2, "A", 1), (3, "A", 1), (3, "B", 0)]
    assert rows(lexicon.counted(d, ["doc_id"]), "doc_id", "word", "n") == [(1, "x", 2), (1, "y", 1), (2, "x", 1), (3, "y", 1)]
    assert rows(lexicon.of_documents(d, ["lang"]), "lang", "word", "n", "docs") == [("A", "x", 3, 2), ("A", "y", 1, 1), ("B", "y", 1, 1)]
    near = lexicon.neighbours(d, ["doc_id"])
    assert rows(near.where("doc_id = 1"), "k", "prev", "word", "next") == [(0, "", "x", "y"), (1, "x", "y", "x"), (2, "y", "x", "")]
    lists = spark.createDataFrame([("x", True, False), ("y", False, True)], "word string, own boolean, foreign boolean")
    one = lexicon.classified(near.join(lists, "word"), F.col("own"), F.col("foreign"), ["y"], ["x"]).groupBy("cls").count()
    assert rows(lexicon.class_counts(near, lists, ["y"], ["x"]), "cls", "n") == rows(one, "cls", "count")


def test_gaps_of_any_width(spark):
    d = spark.createDataFrame([(1,), (3,), (3_000_000_000,), (None,)], "number long")
    assert rows(corpus.gap_ranges(d), "from", "to") == [(1, 3), (3, 3_000_000_000)]
    got = corpus.gaps(d.where("number is null or number < 4").union(spark.createDataFrame([(200_000,)], "number long")))
    assert (got.count(), got.distinct().count(), *got.agg(F.min("number"), F.max("number")).first()) == (199_997, 199_997, 2, 199_999)
    assert corpus.gaps(d).limit(70_000).agg(F.count("*")).first()[0] == 70_000 and corpus.gaps(d.where("number is null")).count() == 0


def test_heads_of_paragraphs(spark):
    cases = {
        "<b>Vorto</b> esas": ("Vorto", 12, True),
        '<a class="fol" href="#f">7</a> * 12bis. — <b>a</b>, <b>e &amp; o</b><b>n</b>. x': ("a, e & on", 76, True),
        "<i>kande</i> = when": ("kande", 12, False),
        "<i>kande</i>&#8212; when": ("kande", 12, False),
        "<i>kande</i> when": None,
        '<span class="pk">Noto</span>: x': ("Noto", 28, False),
        "<b>kande = Ilu venis hike</b> x": ("kande", 29, True),
        "<b>kande = when</b> x": None,
        "<b>Me dicas to</b>": None,
        "<b>plus Paris</b>": ("plus Paris", 17, True),
        "<b>Notez bone</b>": None,
        "<b>" + "a " * 13 + "</b>": None,
        "<b> </b> x": None,
        "plain": None,
        "": None,
    }
    d = spark.createDataFrame(list(enumerate(cases)), "i int, t string")
    got = {r["i"]: r["h"] and tuple(r["h"]) for r in d.select("i", T.headword(F.col("t")).alias("h")).collect()}
    assert {t: got[i] for i, t in enumerate(cases)} == cases


def test_lines_that_may_hide_another(spark):
    d = spark.createDataFrame([(1, k, 50.0 if k == 4 else 27.0) for k in range(9)] + [(2, k, 80.0) for k in range(3)], "p int, k int, h double")
    assert rows(stats.welded(d, "h", ["p"], ["k"]), "p", "k") == [(1, 4)]
    d = spark.createDataFrame([(1, 83.0), (2, 95.0), (3, 62.3), (4, 41.0), (5, 80.1)], "k int, pitch double").withColumn("usual", F.lit(41.5))
    assert rows(stats.suspects(d, "pitch", "usual"), "k", "exact") == [(1, True), (2, False), (5, True)]
    b, e = spark.createDataFrame([(k,) for k in range(4)], "k int"), spark.createDataFrame([(0, 24.8), (1, 8.0), (2, 3.1)], "k int, excess double")
    assert rows(stats.proposals(b, e, ["k"], 7.72), "k", "space") == [(0, 24.8), (2, 3.1 - 7.72), (3, -7.72)]


def test_topic_pages_in_pieces(spark, tmp_path):
    rng = np.random.default_rng(9)
    hits = [(f"t{rng.integers(2)}", int(d), int(r), f"s{rng.integers(2)}", f"block {d} {r}") for d in sorted(rng.choice(60, 25, replace=False)) for r in range(1, 4)]
    d = spark.createDataFrame(hits, "topic string, doc_id long, rank long, source string, text string")
    pieces = concordance.page_pieces(d, F.col("source"), ["topic"], "doc_id", ["rank"], stretch=8)
    want, before = [], {}
    for topic, doc, rank, source, text in sorted(hits, key=lambda x: x[:3]):
        want.append((topic, doc, rank, ("" if before.get(topic) == source else f"## {source}\n\n") + text))
        before[topic] = source
    assert rows(pieces, "topic", "doc_id", "rank", "piece") == want
    sinks.paged(pieces, f"{tmp_path}/pages", "topic", ["doc_id", "rank"])
    for topic in ("t0", "t1"):
        text = "".join(p.read_text() for p in sorted((tmp_path / "pages" / f"topic={topic}").glob("part-*")))
        assert text == "".join(f"{p}\n\n" for t, _, _, p in want if t == topic)


def test_quantiles_from_counts(spark):
    rng = np.random.default_rng(3)
    x = [(g, float(v)) for g in range(3) for v in rng.integers(0, 9, 4 + g)]
    got = {r["g"]: r for r in stats.quantiles(spark.createDataFrame([*x, (0, None)], "g int, v double"), "v", ["g"], {"a": 0.5, "b": 0.9, "c": 0.0}).collect()}
    for g in range(3):
        v = [b for a, b in x if a == g]
        assert np.allclose([got[g][k] for k in "abc"], np.quantile(v, [0.5, 0.9, 0.0])) and got[g]["_n"] == len(v)


def test_stats(spark):
    d = spark.createDataFrame([(1, i, float(v)) for i, v in enumerate([5, 1, 4, 2])], "g int, i int, v double")
    assert rows(stats.by_index(d, "v", ["g"], {"m": (1, 2), "first": (0, 1), "last": (3, 4)}), "m", "first", "last") == [(4.0, 1.0, 5.0)]
    assert rows(stats.rolling_median(d, "v", ["g"], ["i"]), "i", "rolled") == [(0, 3.0), (1, 4.0), (2, 2.0), (3, 3.0)]
    c = layout.clusters(d, F.col("v"), 1.5, ["g"], ["v"])
    assert rows(c, "v", "cluster") == [(1.0, 1), (2.0, 1), (4.0, 2), (5.0, 2)]
    b = spark.createDataFrame([(1, 1, 5), (1, 2, 3), (1, 6, 7), (1, 20, 21)], "g int, start int, end int")
    assert rows(layout.merged(b, 3, ["g"]), "start", "end", "n") == [(1, 7, 3), (20, 21, 1)]


def test_scored_match():
    a, b = np.array([100.0, 140, 180, 260]), np.array([105.0, 145, 185, 225, 265])
    assert align.scored(a, b) == [(0, 0), (1, 1), (2, 2), (3, 4)]
    assert align.scored(a, a[:0]) == []


def test_emphasis(spark):

    d = spark.createDataFrame([("**Bold two** and *it's* but ***no***",), ("",)], "t string")
    got = d.select(T.emphasised(F.col("t")).alias("x"), T.emphasis_share(F.col("t"), r"\*\*([^*]+)\*\*").alias("s")).collect()
    assert [(w["word"], w["cls"]) for w in got[0]["x"]][:3] == [("Bold", "bold"), ("two", "bold"), ("it's", "italic")] and got[1]["s"] == 0.0


def test_three_values(spark):
    d = spark.createDataFrame([(1, 2, 2), (2, 2, 3), (3, None, 3)], "p int, a int, b int")
    assert rows(stats.three_valued(d, ["p"], F.col("a"), F.col("b")), "p", "verdict") == [(1, "ok"), (2, "wrong"), (3, "not judged")]


def test_matcher_in_parts_is_that_of_the_whole_matrix():
    rng = np.random.default_rng(1)
    for _ in range(60):
        x, y = np.sort(rng.uniform(0, 900, rng.integers(1, 40))), np.sort(rng.uniform(0, 900, rng.integers(1, 40)))
        assert align.matched(x, y, cells=1) == align.matched(x, y, cells=60) == align.matched(x, y)
    ix = np.arange(6000)  # costs so large that a relative tolerance would take a wrong step
    assert align.matched(ix * 40.0, ix[ix % 7 != 3] * 40.0 + 5) == [(int(i), k) for k, i in enumerate(ix[ix % 7 != 3])]


def test_line_alignment_reads_all_documents(spark, tmp_path):
    from textloom.plans import queries

    d = [(i, "\n".join(f"line {k}" for k in range(i % 5 + 1))) for i in range(0, 1000, 50)]
    spark.createDataFrame(d, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = rows(queries.line_alignment(spark, str(tmp_path)).where("a is not null"), "page", "a")
    assert got == sorted((i, k + 1) for i, t in d for k in range(len(t.split("\n"))))


def test_ranks_of_all_pages_are_compared(spark, tmp_path):
    from textloom.plans import queries

    spark.createDataFrame([(1, "a b"), (70, "a b c")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(70, "a x"), (900, "z")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = rows(queries.rank_diff(spark, str(tmp_path)), "page", "rank", "expected", "obtained", "same")
    no = "<missing>"
    assert got == [(1, 1, "a", no, False), (1, 2, "b", no, False), (70, 1, "a", "a", True), (70, 2, "b", "x", False), (70, 3, "c", no, False), (900, 1, no, "z", False)]


def test_all_pages_turns_and_documents_are_read(spark, tmp_path):
    from textloom.plans import queries

    at = str(tmp_path)
    ids = [0, 1, 95, 113, 119, 2400]
    spark.createDataFrame([(i,) for i in ids], "page_id long").write.parquet(f"{at}/pages.parquet")
    spark.createDataFrame([(1, 1, "A b"), (1, 2, "C")], "conv_id long, turn long, text string").write.parquet(f"{at}/conversations.parquet")
    spark.createDataFrame([(7, "s", "en"), (50, "s", "de")], "doc_id long, source string, lang string").write.parquet(f"{at}/documents.parquet")
    assert rows(queries.words_zipped(spark, at), "turn", "rank", "truth", "read") == [(1, 1, "A", "a"), (1, 2, "b", "b"), (2, 1, "C", "c")]
    assert rows(queries.anchor_faults(spark, at).where("fault = 'encoded'"), "anchor") == [("#50",), ("#7",)]

    number = re.compile(r"-\d+$")
    present = [(i, f"p-{i % 40}" + ["-x", "-2", ""][i % 3]) for i in ids]
    want = []
    for old in {f"p-{i % 55}" + ("" if i % 2 else "-x-y") for i in ids}:
        c = [(1, 0, p, x) for p, x in present if x == old]
        c += [(2, 0, p, x) for p, x in present if x.startswith(old + "-") and not x[len(old) + 1 :].isdigit()]
        c += [(3, 0, p, x) for p, x in present if number.sub("", x) == number.sub("", old)]
        c += [(4, -len(x), p, x) for p, x in present if old.startswith(x + "-")]
        want.append((old, min(c)[3] if c else None, min(c)[0] if c else None))
    got = [(r["anchor"], r["id"], r["rule"]) for r in queries.anchor_kinship(spark, at).collect()]
    assert sorted(got) == sorted(want) and any(r for _, _, r in want)


def test_rows_of_deep_trees_are_covered(spark):
    parent = {0: None, 1: 0, 2: 1, 3: 2, 4: 3, 5: 4, 6: 5, 7: 2, 8: None}
    d = spark.createDataFrame([(i, p, [10 * i], 10 * i + 1) for i, p in parent.items()], "id long, parent long, rows array<long>, title long")
    above = {i: {i} for i in parent}
    for i in parent:
        p = parent[i]
        while p is not None:
            above[i].add(p)
            p = parent[p]
    got = {r["id"]: set(r["covered"]) for r in layout.covered(d).collect()}
    assert got == {i: {10 * k for k in a} for i, a in above.items()}
    got = {r["id"]: set(r["covered"]) for r in layout.covered(d, below=True).collect()}
    assert got == {i: {10 * k + x for k in parent if i in above[k] for x in (0, 1)} for i in parent}
    circle = spark.createDataFrame([(1, 2, [1]), (2, 1, [2])], "id long, parent long, rows array<long>")
    assert [sorted(r["covered"]) for r in layout.covered(circle).collect()] == [[1, 2], [1, 2]]


def test_headword_works_its_text_out_once(spark):
    d = spark.createDataFrame([("<b>kapo</b> texto",)], "t string").select(T.headword(F.concat("t", F.lit("MARK"))).alias("h"))
    assert d._jdf.queryExecution().optimizedPlan().toString().count("MARK") == 1
    assert tuple(d.first()["h"]) == ("kapo", 11, True)


def test_first_example_works_its_body_out_once(spark):
    d = spark.createDataFrame([("-ado", "***x*** — **kant*ado, not** and *paf-ado* Ex. : adoro, lern-ado.")], "affix string, body string")
    d = d.select(glossary.first_example(F.col("affix"), F.lit(True), F.concat("body", F.lit("MARK"))).alias("e"))
    assert d._jdf.queryExecution().optimizedPlan().toString().count("MARK") == 1 and d.first()["e"] == "paf-ado"
    assert spark.createDataFrame([(1,)], "i int").select(glossary.first_example(F.lit("-ad"), F.lit(True), F.lit("***x*** — Ex. : adoro, lern-ado.")).alias("e")).first()["e"] == "lern-ado"


def test_seams_deal_words_not_texts(spark):
    from textloom.operators import audit

    d = spark.createDataFrame([(1, 1, "a kon"), (1, 2, "sonanti b"), (1, 3, "")], "doc_id long, rank long, text string")
    s = audit.seams(d, True).select("doc_id", "rank", "left", "right")
    plan = s._jdf.queryExecution().optimizedPlan().toString()
    assert "text" not in next(x for x in plan.splitlines() if "lead(" in x)
    assert sorted(map(tuple, s.collect())) == [(1, 1, "kon", "sonanti"), (1, 2, "b", ""), (1, 3, "", "")]


def test_blocks_carry_columns_of_their_document(spark):
    d = spark.createDataFrame([(1, "a\n\nb", "s")], "doc_id long, text string, source string")
    assert sorted(map(tuple, corpus.blocks(d, "\n", more=["source"]).collect())) == [(1, 1, "a", "s"), (1, 2, "b", "s")]
