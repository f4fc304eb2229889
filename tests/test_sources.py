from pyspark.sql import functions as F

from textloom import streaming
from textloom.sources import files, sinks


def test_chapters_are_files_of_one_folder(spark, tmp_path, monkeypatch):
    """A file for each conversation, one folder for all; a table without rows or with one conversation gives as many."""
    from textloom.plans import queries

    for k in (0, 1, 40):
        rows = [(i, turn, f"{i} says\n---\n{turn}") for i in range(k) for turn in range(3)]
        spark.createDataFrame(rows, "conv_id long, turn int, text string").write.parquet(f"{tmp_path}/{k}/conversations.parquet")
        folder = tmp_path / str(k) / "shared"
        monkeypatch.setattr(queries.tables, "folder", lambda spark, name, at=folder: str(at))
        got = {r["title"]: r["size"] for r in queries.chapters_read(spark, f"{tmp_path}/{k}").collect()}
        assert got == {f"Talk {i}": sum(len(x) for c, _, x in rows if c == i) + 4 for i in range(k)}
        assert not [x for x in folder.iterdir() if x.is_dir()] and len([x for x in folder.glob("part-*.txt") if x.stat().st_size]) == k


def test_markdown_chapters(spark, tmp_path):
    (tmp_path / "b.md").write_text("<!-- x -->\n# Title\n\nfrom\n\n---\n\nbody\n\nmore")
    (tmp_path / "a.md").write_text("no rule")
    (tmp_path / "index.md").write_text("| [One](one.md) | 3 |\n| [Two](two.md) | 4 |\n")
    got = {r["doc_id"]: (r["title"], r["body"].strip()) for r in files.markdown_chapters(spark, f"{tmp_path}/*.md").collect()}
    assert got == {"b": ("Title", "body\n\nmore"), "a": ("a", "no rule")}
    links = files.chapter_links(spark.read.text(f"{tmp_path}/index.md", wholetext=True))
    assert [(r["nth"], r["title"], r["href"]) for r in links.orderBy("nth").collect()] == [(1, "One", "one.md"), (2, "Two", "two.md")]


def test_tex_pages(spark, tmp_path):
    (tmp_path / "p.tex").write_text("\\begin{VUpage}[8]{1}\nfirst li\\cc\nne here\\nl\nend\n\nnew\n\\end{VUpage}\n\\begin{VUpage}[300]{9}\nx\n\\end{VUpage}\n")
    got = files.tex_pages(spark, f"{tmp_path}/*.tex", 8, 228).orderBy("line_ix").collect()
    assert [(r["leaf"], r["folio"], r["raw"], r["brk"]) for r in got] == [("8", "1", "first li", "cc"), ("8", "1", "ne here", "nl"), ("8", "1", "end", "pf"), ("8", "1", "new", None)]


def test_html_blocks_leave_scripts_out():
    html = "<html><body><script>var x = '</p>';</script><!-- <p>no</p> --><article><h1>A &amp; B</h1><p>one <b>two<p>three</article><p>four</p></body></html>"
    assert files.parse_blocks(html) == [("h1", "A & B"), ("p", "one two"), ("b", "two"), ("p", "three"), ("p", "four")]


def test_surveys(spark, tmp_path):
    (tmp_path / "f.json").write_text('{"1": {"folio": 3, "raw": "3", "nlines": 40, "skew": 0.5}, "2": {"folio": null, "raw": "", "nlines": 0}}')
    assert {r["leaf"]: r["folio"] for r in files.leaf_survey(spark, f"{tmp_path}/f.json").collect()} == {1: 3, 2: None}
    d = spark.createDataFrame([("\n\n 12 \ntext",), ("a\nb\nc\n12",)], "t string")
    assert [r[0] for r in d.select(files.folio_of(F.col("t"))).collect()] == [12, None]


def test_sinks(spark, tmp_path):
    d = spark.createDataFrame([(1, 1, "a\nb", True), (1, 2, "c", False)], "g int, rank int, text string, is_note boolean")
    r = sinks.chapters(d, ["g"]).first()
    assert (r["text"], r["size"]) == ("> a\n> b\n\nc", 10)
    ok = spark.createDataFrame([("ok",)], "status string")
    assert sinks.gated(d, ok, f"{tmp_path}/out") and not sinks.gated(d, ok.union(spark.createDataFrame([("too few",)], "status string")), f"{tmp_path}/no")
    sinks.partitioned(d, f"{tmp_path}/parts", "g")
    assert spark.read.parquet(f"{tmp_path}/parts").count() == 2


def test_opening_checks_as_a_stream(spark, tmp_path):
    d = spark.createDataFrame([(1, "a\n; b\n) c")], "doc_id long, text string")
    d.write.parquet(f"{tmp_path}/in")
    q = streaming.opening_counts(streaming.documents(spark, f"{tmp_path}/in", d.schema)).writeStream.format("memory").queryName("openings").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/c").start()
    q.awaitTermination()
    assert {r["check"]: r["n"] for r in spark.table("openings").collect()} == {"space_before": 1, "closing": 1}
