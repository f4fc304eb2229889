"""Properties over random inputs, many in one table so that Spark runs once."""

import random

from pyspark.sql import functions as F

from textloom.operators import anchors, corpus, layout

RNG = random.Random(11)


def test_ranks_are_dense_and_sections_stay_in_their_document(spark):
    parts = ["", "a", "b c", "12. — x", "7. – y", "   ", "9. - z"]
    docs = [(i, "\n\n".join(RNG.choice(parts) for _ in range(RNG.randint(0, 9)))) for i in range(60)]
    got = corpus.sections(corpus.blocks(spark.createDataFrame(docs, "doc_id long, text string"))).collect()
    for i, text in docs:
        want = [b.strip() for b in text.split("\n\n") if b.strip()]
        mine = sorted((r for r in got if r["doc_id"] == i), key=lambda r: r["rank"])
        assert [r["text"] for r in mine] == want and [r["rank"] for r in mine] == list(range(1, len(want) + 1))
        section, expected = None, []
        for b in want:
            head = b.split(".")[0]
            section = int(head) if head.isdigit() and b[len(head) + 2] in "—–" else section
            expected.append(section)
        assert [r["section"] for r in mine] == expected


def test_minted_anchors_are_unique_and_in_order(spark):
    rows, taken = [], {}
    for g in range(30):
        for pos in range(RNG.randint(0, 12)):
            rows.append((g, pos, RNG.choice(["a", "b", "a-2", "a-3", "b-2-2", "b-2"])))
    got = {(r["g"], r["pos"]): r["anchor"] for r in anchors.minted(spark.createDataFrame(rows, "g int, pos int, base string"), F.col("base"), ["g"], ["pos"]).collect()}
    for (g, pos), a in got.items():
        assert taken.setdefault((g, a), pos) == pos
    for g, pos, base in rows:
        first = min(p for h, p, b in rows if h == g and b == base)
        assert got[g, pos] == base if pos == first else got[g, pos].startswith(base + "-")


def test_nearest_as_brute_force(spark):
    rows = [(g, at) for g in range(10) for at in range(0, 40, RNG.randint(1, 5))]
    points = [(g, at, f"p{at}") for g in range(9) for at in sorted(RNG.sample(range(40), 4))]
    got = layout.nearest(spark.createDataFrame(rows, "g int, at long"), spark.createDataFrame(points, "g int, at long, value string"), ["g"], "at").collect()
    assert len(got) == len(rows)
    for r in got:
        own = [p for h, p, _ in points if h == r["g"]]
        assert r["near"] == (min(own, key=lambda p: (abs(p - r["at"]), p)) if own else None)
