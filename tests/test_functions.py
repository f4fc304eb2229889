from pyspark.sql import functions as F

from textloom.functions import syllables
from textloom.functions import text as T


def one(spark, make, *values):
    d = spark.createDataFrame([values], ", ".join(f"c{i} string" for i in range(len(values))))
    return d.select(make(*[F.col(c) for c in d.columns]).alias("x")).first()["x"]


def test_markdown_joins_touching_emphasis(spark):
    assert one(spark, T.as_markdown, "<i>male</i><i>dukita</i>") == "*maledukita*"
    assert one(spark, T.as_markdown, '<b>a</b> <a class="fol" id="x">12</a>b<br/>c &amp; d') == "**a** b\nc & d"


def test_titles_and_spaces(spark):
    assert one(spark, T.chapter_title, "**A**  b *c*..") == "A b c"
    assert one(spark, T.chapter_title, "...") == "..."
    assert one(spark, T.strip, "\u00a0 a \n") == "a"
    assert one(spark, T.normalised, "\u201ca\u201d  b , ( c ) d ; e\u2014f ....... \u00abg\u00bb") == '"a" b, (c) d; e--f <<g>>'
    assert one(spark, T.french_spacing, "a ; b! \u00ab c \u00bb") == "a\u202f; b! \u00ab\u202fc\u202f\u00bb"
    assert one(spark, T.strip_comments, "a%x\n  % y\nb \\% c\n") == "ab \\% c\n"
    assert one(spark, T.without_short_tokens, "ab ..... c de") == "ab de"


def test_slug(spark):
    assert one(spark, T.slug, "Œuvre: l'été à Łódź!") == "oeuvre-l-ete-a-lodz"
    assert one(spark, T.slug, "a" * 30 + " " + "b" * 30) == "a" * 30
    assert one(spark, T.slug, "a" * 50) == "a" * 40


def test_lengths(spark):
    assert one(spark, T.millimetres, "2.5cm") == 25.0
    assert one(spark, T.millimetres, "7") == 7.0
    assert one(spark, T.millimetres, "wide") == 0.0


def test_sentences(spark):
    s = lambda c: T.is_sentence(c, ["as", "is"], ["plus"])
    assert one(spark, s, "Notas bone")
    assert not one(spark, s, "a Paris b plus")
    assert one(spark, s, "parolas")
    assert one(spark, s, "Fine. Nova")
    assert not one(spark, s, "dom -as")


def test_snippet(spark):
    at = lambda c: T.snippet(c, F.instr(c, "hit"), F.lit(3), 4, 4)
    assert one(spark, at, "0123456<hit>89abcdef") == "…456&lt;<mark>hit</mark>&gt;89a…"


def test_syllables(spark):
    b = syllables.breaks
    assert one(spark, b, "mustar") == [2, 3, 4]
    assert 3 in one(spark, b, "neutro") and 2 not in one(spark, b, "neutro")
    assert 2 in one(spark, b, "mashino") and 3 not in one(spark, b, "mashino")
    assert one(spark, b, "a1") == []
    assert one(spark, syllables.hyphenated, "mustar", "mustar") == "mu-s-t-ar"
    assert one(spark, syllables.fault, "mas", "hino") == "splits sh"
    assert one(spark, syllables.fault, "mu", "star") is None


def test_every_break_has_vowels_on_both_sides(spark):
    words = ["abo", "strengo", "ae", "qualeso", "xyz", "chauo", "b", ""]
    d = spark.createDataFrame([(w,) for w in words], "w string")
    for r in d.select("w", syllables.breaks(F.col("w")).alias("b")).collect():
        for i in r["b"]:
            assert set(r["w"][:i]) & set("aeiou") and set(r["w"][i:]) & set("aeiou") and r["w"][i - 1 : i + 1] not in syllables.DIGRAPHS + syllables.DIPHTHONGS


def test_references_without_semicolon_are_text(spark):
    assert one(spark, T.whole_references, "a&amp;&amp b&lt;&#12;&#x1F;&c & d;") == "a&amp;&amp;amp b&lt;&#12;&#x1F;&amp;c &amp; d;"
    assert one(spark, lambda c: T.as_markdown(T.whole_references(c)), "x&amp;&amp") == "x&&amp"


def test_capitals_are_one_letter(spark):
    head = lambda c: T.headword_case(c, F.lit(True))
    assert [one(spark, head, x) for x in ("ßung ber", "élan", "ŉa", "")] == ["ẞung ber", "Élan", "ŉa", ""]


def test_opening_verb_in_capitals(spark):
    s = lambda c: T.is_sentence(c, ["as", "is", "us"], ["plus"])
    assert one(spark, s, "ÑCOAS!!") and one(spark, s, "Paris")
    assert not any(one(spark, s, x) for x in ("a ÑCOAS", "PLUS", "a pLus", "-ÑCOAS", "as"))
    assert one(spark, s, "a plusus")
