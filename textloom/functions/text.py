"""String and markup functions as Columns. Patterns are Unicode-aware: Java's \\s, \\w and \\b are not, unless the pattern says so."""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

NARROW_SPACE = " "
#: Letters without a decomposition and what they become in a slug.
SLUG_LETTERS = {"æ": "ae", "œ": "oe", "ß": "ss", "ø": "o", "đ": "d", "ł": "l", "þ": "th", "ð": "d", "Æ": "AE", "Œ": "OE", "Ø": "O", "Đ": "D", "Ł": "L", "Þ": "Th", "Ð": "D"}
SLUG_LENGTH = 40
WORD = "[A-Za-zÀ-ÿ]+"
WORD_WITH_MARKS = "[A-Za-zÀ-ÿ][A-Za-zÀ-ÿ'-]*"


def u(pattern: str, fold_case: bool = False) -> str:
    """pattern with Unicode classes and, if asked for, letters of either case."""
    return f"(?U{'i' if fold_case else ''}){pattern}"


def _each(c: Column, steps: Iterable[tuple[str, str]]) -> Column:
    for pattern, to in steps:
        c = F.regexp_replace(c, pattern, to)
    return c


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, u(r"^\s+|\s+$"), "")


def escape(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def whole_references(c: Column) -> Column:
    """A fragment of HTML whose references without a semicolon are text: their ampersands are spelled out."""
    return F.regexp_replace(c, "&(?!(?:#[0-9]+|#[xX][0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);)", "&amp;")


def plain_text(c: Column) -> Column:
    """Text of an HTML fragment: no tags, the four basic entities decoded, stripped."""
    c = F.regexp_replace(c, "<[^>]+>", "")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(char))
    return strip(c)


def _python(each: Callable[[str], str]) -> Callable[[Column], Column]:
    """A function of texts that the JVM does not have, in Arrow batches; made when it is used, as it needs a session."""

    def over(s):
        return s.map(each, na_action="ignore")

    over.__annotations__ = {"s": pd.Series, "return": pd.Series}  # as objects: names would be looked up here
    return lambda c: F.pandas_udf(over, "string")(c)


def unescape(c: Column) -> Column:
    """All HTML entities decoded."""
    return _python(html.unescape)(c)


def as_markdown(c: Column) -> Column:
    """An HTML fragment as Markdown. The order of the steps matters: folio links go, runs of the same emphasis that touch are joined, then emphasis, breaks, other tags, entities, and white space."""
    steps = [(r'(?s)<a[^>]*class="fol"[^>]*>.*?</a>', ""), (r"</(i|em|b|strong)><\1>", "")]
    steps += [(rf"(?s)<{tag}>(.*?)</{tag}>", f"{mark}$1{mark}") for tag, mark in (("i", "*"), ("em", "*"), ("b", "**"), ("strong", "**"))]
    c = unescape(_each(c, [*steps, (r"<br\s*/?>", "  \n"), ("<[^>]+>", "")]))
    return strip(_each(c, [("[ \t ]+", " "), (r" *\n *", "\n")]))


def chapter_title(c: Column) -> Column:
    """Without emphasis marks and trailing dots, white space collapsed; as it was if nothing is left."""
    t = strip(_each(c, [(r"\*{1,2}([^*]*)\*{1,2}", "$1"), (u(r"\s+"), " "), (u(r"[\s.]+$"), "")]))
    return F.coalesce(F.nullif(t, F.lit("")), c)


def normalised(c: Column) -> Column:
    """For comparing two settings of a text: quotes, dashes, leader dots and the spaces around punctuation alike."""
    c = F.translate(c, " ’‘`“”", " '''\"\"")
    return strip(_each(c, [("[–—]", "--"), ("---", "--"), (u(r"\s+([,.)])"), "$1"), (u(r"\(\s+"), "("), (r"\.{6,}", " "), (u(r"\s+([;:!?])"), "$1"), ("«", "<<"), ("»", ">>"), (u(r"\s+"), " ")]))


def french_spacing(c: Column) -> Column:
    """A space before ; : ! ? and inside guillemets becomes a narrow one; none is added."""
    return _each(c, [(r" +([;:!?])", NARROW_SPACE + "$1"), ("« +", "«" + NARROW_SPACE), (" +»", NARROW_SPACE + "»"), ("  +", " ")])


def strip_comments(c: Column) -> Column:
    """TeX comments: a line of one vanishes, one at a line's end takes the newline with it, an escaped percent sign stays."""
    return _each(c, [(r"(?m)^[ \t]*%.*\n", ""), (r"(?<!\\)%.*\n", "")])


def without_short_tokens(c: Column) -> Column:
    """Dot runs as spaces, then only tokens of two characters or more, joined by a space."""
    return F.array_join(F.filter(F.split(F.regexp_replace(c, r"\.{2,}", " "), u(r"\s+")), lambda t: F.length(t) > 1), " ")


def _decomposed(s: str, form: str) -> str:
    return "".join(x for x in unicodedata.normalize(form, s) if not unicodedata.combining(x))


def fold_marks(c: Column) -> Column:
    """Lower case without accents."""
    return _python(lambda x: _decomposed(x.lower(), "NFD"))(c)


def _slug_letters(c: Column) -> Column:
    table = str.maketrans(SLUG_LETTERS)
    return _python(lambda x: _decomposed(unicodedata.normalize("NFKD", x).translate(table), "NFKD"))(c)


def slug(c: Column, length: int = SLUG_LENGTH) -> Column:
    """An address: ASCII letters and digits, hyphens between; cut at a hyphen when longer than length, or within the first word."""
    t = _each(F.lower(_slug_letters(F.coalesce(c, F.lit("")))), [("[^a-z0-9]+", "-"), ("^-+|-+$", "")])
    head = F.substring(t, 1, length)
    cut = F.when(F.instr(head, "-") > 1, F.regexp_replace(head, "-[^-]*$", "")).otherwise(head)
    return F.regexp_replace(F.when(F.length(t) > length, cut).otherwise(t), "^-+|-+$", "")


def cite(section: Column, title: Column, rank: Column) -> Column:
    """The section if there is one, else title and rank."""
    return F.when(section.isNotNull(), F.format_string("§ %d", section)).otherwise(F.format_string("%s — bloko %d", title, rank))


def words(c: Column, pattern: str = WORD) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), 0)


def is_sentence(c: Column, endings: list[str], exceptions: list[str]) -> Column:
    """Whether a verb by its ending occurs (two letters of root at least, not an exception, and not a capitalised word unless it opens the text, where it is read in lower case), or a full stop before a capital."""
    either = "|".join("".join(f"[{x.lower()}{x.upper()}]" if x.isalpha() else re.escape(x) for x in e) for e in exceptions)
    no = rf"(?!(?:{either})\b)" if exceptions else ""
    verb = rf"\w{{2,}}(?:{'|'.join(endings)})\b"
    opens = F.lower(F.regexp_extract(c, u(r"^\w+"), 0)).rlike(u(rf"^{no}{verb}"))
    return opens | c.rlike(u(rf"(?<![-\w‑]){no}(?!\p{{Lu}}){verb}")) | c.rlike(u(r"[.!?]\s+[A-ZÀ-Þ]"))


#: Verbal endings, the words that have them without being verbs, what stands before a head, the weights that set one off (with whether that is enough), what joins its pieces, the marks of a definition, and the largest head.
VERB_ENDINGS, NOT_VERBS = ["as", "is", "os", "us", "ez"], ["plus", "minus", "depos", "bis", "gratis"]
_CALL = "(?:(?:<a class=\"apelo\"[^>]*>.*?</a>|\\*)[\\s\u00a0\u202f]*)?"
_BEFORE_HEAD = rf'(?:<a class="fol"[^>]*>[^<]*</a>)?[ \t\n]*{_CALL}(?:\d+(?:\s*bis)?\.\s*[—–-]?\s*)?{_CALL}'
_WEIGHTS = (("<b>", "</b>", True), ("<i>", "</i>", False), ('<span class="pk">', "</span>", False))
_JOINER = "(?:, | |)"
_DEFINES, _DEFINES_INSIDE = "^[\\s\u00a0\u202f]*[=:.–—(\\[{«]", "[\\s\u00a0\u202f][=:–—][\\s\u00a0\u202f]"
HEAD_LENGTH, HEAD_WORDS = 80, 12
#: How a page may spell the marks of a definition, and the spaces before them.
_MARK_ENTITIES = [("&(?:nbsp|#160|#8239);", "\u00a0"), ("&(?:mdash|#8212);", "—"), ("&(?:ndash|#8211);", "–"), ("&(?:laquo|#171);", "«")]


def headword(c: Column) -> Column:
    """(text, end, bold) of the headword that an HTML paragraph opens with; null without one.

    A head is one run of pieces of one weight, the first that there is of bold,
    italics and small capitals, behind a folio link, a number and calls. A
    definition mark inside cuts it if a sentence follows, and makes it none if
    not. It is short and no sentence itself; other than in bold, a definition
    mark has to follow, or have cut it. end: where the run ends, 0-based.
    """
    # what later steps use several times is bound by a transform over one element, so that it is worked out once
    once = lambda x, f: F.transform(F.array(x), f)[0]
    sentence = lambda x: is_sentence(x, VERB_ENDINGS, NOT_VERBS)

    def opened(c: Column, begin: str, close: str, bold: bool) -> Column:
        piece = f"{begin}.*?{close}"
        whole = F.regexp_extract(c, f"^{_BEFORE_HEAD}{piece}(?:{_JOINER}{piece})*", 0)
        run = lambda w: F.regexp_extract(w, f"^{_BEFORE_HEAD}((?:{begin}).*)$", 1)
        there = lambda w: F.when(w != "", parts(c, run(w), F.length(w), F.lit(bold)))
        return F.when(F.contains(c, F.lit(begin)), once(whole, there))

    def parts(c: Column, run: Column, end: Column, bold: Column) -> Column:
        before, after = (lambda text, i=i: strip(F.regexp_extract(text, f"^(?s:(.*?)){_DEFINES_INSIDE}(?s:(.*))$", i)) for i in (1, 2))
        rest = _each(F.substring(c, end + 1, F.lit(1 << 30)), [("<[^>]+>", ""), *_MARK_ENTITIES])

        def told(text: Column, cut: Column) -> Column:
            return F.struct(F.when(cut, before(text)).otherwise(text).alias("text"), end.alias("end"), bold.alias("bold"), (~cut | sentence(after(text))).alias("good"), (bold | cut | rest.rlike(_DEFINES)).alias("proved"))

        return once(plain_text(run), lambda text: once(text.rlike(_DEFINES_INSIDE), lambda cut: told(text, cut)))

    def judged(f: Column) -> Column:
        short = (F.length(f["text"]) <= HEAD_LENGTH) & (F.size(F.split(f["text"], u(r"\s+"))) <= HEAD_WORDS)
        good = (f["text"] != "") & f["good"] & f["proved"] & short & ~sentence(f["text"])
        return F.when(good, F.struct(f["text"].alias("text"), f["end"].alias("end"), f["bold"].alias("bold")))

    first = lambda c: F.coalesce(*[opened(c, *w) for w in _WEIGHTS])
    return once(once(c, first), lambda f: F.when(f.isNotNull(), judged(f)))


def snippet(text: Column, at: Column, size: Column, before: int = 70, after: int = 110) -> Column:
    """The hit at (1-based) with text around it, each part escaped, the hit in <mark>, and an ellipsis where text is cut off."""
    start = F.greatest(at - before, F.lit(1))
    left, hit = F.substring(text, start, at - start), F.substring(text, at, size)
    right = F.substring(text, at + size, F.lit(after))
    dots = lambda cond: F.when(cond, F.lit("…")).otherwise(F.lit(""))
    return F.concat(dots(start > 1), escape(left), F.lit("<mark>"), escape(hit), F.lit("</mark>"), escape(right), dots(at + size + after <= F.length(text)))


def millimetres(c: Column) -> Column:
    """A length with unit in millimetres; without a unit the bare number, and 0 for what is no length."""
    n, unit = F.regexp_extract(c, r"^\s*(-?\d+(?:\.\d+)?)\s*(mm|pt|cm|in)?\s*$", 1), F.regexp_extract(c, r"(mm|pt|cm|in)\s*$", 1)
    scale = F.when(unit == "cm", 10.0).when(unit == "in", 25.4).when(unit == "pt", 25.4 / 72.27).otherwise(1.0)
    return F.when(n == "", 0.0).otherwise(n.try_cast("double") * scale)


def capital(c: Column) -> Column:
    """c with a capital first letter, one for one: that of ß is ẞ, a letter without a single capital stays."""
    first, rest = F.substring(c, 1, 1), F.substring(c, 2, 1 << 30)
    big = F.upper(first)
    return F.concat(F.when(first == "ß", F.lit("ẞ")).when(F.length(big) == 1, big).otherwise(first), rest)


def headword_case(c: Column, heading: Column, proper: list[str] = []) -> Column:  # noqa: B006
    """A heading opens with a capital; in a cited head each word but proper names opens with a small letter."""
    small = F.array_join(F.transform(F.split(c, "(?<=[ ,-])"), lambda w: F.when(F.regexp_replace(w, "[ ,-]+$", "").isin(list(proper)), w).otherwise(F.concat(F.lower(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30)))), "")
    return F.when(heading, capital(c)).otherwise(small)


def label(title: Column, is_note: Column) -> Column:
    """What a search result is listed under: the chapter, and that it is a note."""
    return F.concat(title, F.when(is_note, F.lit(" · noto")).otherwise(F.lit("")))


def emphasised(c: Column) -> Column:
    """(word, cls) of the words in bold and in italics of a Markdown text: bold runs first."""
    runs = lambda p: F.flatten(F.transform(F.regexp_extract_all(c, F.lit(p), 1), lambda r: words(r, WORD_WITH_MARKS)))
    as_cls = lambda xs, cls: F.transform(xs, lambda w: F.struct(w.alias("word"), F.lit(cls).alias("cls")))
    return F.concat(as_cls(runs(r"(?<!\*)\*\*([^*]+?)\*\*(?!\*)"), "bold"), as_cls(runs(r"(?<!\*)\*([^*]+?)\*(?!\*)"), "italic"))


#: The commands that set words off, by what they make of them, and what a word of a marked text is.
SET_OFF = {"VUgras": "bold", "textit": "italic", "textsc": "italic"}
MARKED_WORD = r"\p{L}[\p{L}'-]*"


def emphasised_by_braces(c: Column, commands: dict[str, str] = SET_OFF) -> Column:
    """(word, cls) of the words of a text with commands, by the innermost open one; roman outside.

    A stack is folded over the text's marks: a command with its brace puts its
    class on it, a closing brace takes the top off, whatever brace it closes, as
    an opening brace without a command puts nothing on. Other commands, and
    characters behind a backslash, are no words. The words between two marks are
    one piece of the fold, so that it takes a step a mark.
    """
    opens = rf"\\({'|'.join(commands)})\s*\{{"
    # a piece cannot begin inside a command: marks are tried first, and a piece ends before a backslash
    pieces = F.regexp_extract_all(c, F.lit(rf"(?s){opens}|\}}|\\(?:\p{{L}}+|.)?|[^\\}}]+"), 0)
    classes = F.create_map(*[F.lit(x) for kv in commands.items() for x in kv])

    def step(acc: Column, x: Column) -> Column:
        name = F.regexp_extract(x, f"^{opens}", 1)
        stack = F.when(name != "", F.concat(F.array(classes[name]), acc["stack"])).when(x == "}", F.slice(acc["stack"], 2, 1 << 30)).otherwise(acc["stack"])
        own = F.struct(x.alias("run"), F.coalesce(F.get(acc["stack"], F.lit(0)), F.lit("roman")).alias("cls"))
        out = F.when(F.substring(x, 1, 1).isin("\\", "}"), acc["out"]).otherwise(F.concat(acc["out"], F.array(own)))
        return F.struct(stack.alias("stack"), out.alias("out"))

    begin = F.struct(F.array().cast("array<string>").alias("stack"), F.array().cast("array<struct<run:string,cls:string>>").alias("out"))
    runs = F.aggregate(pieces, begin, step)["out"]
    each = lambda r: F.transform(words(r["run"], MARKED_WORD), lambda w: F.struct(w.alias("word"), r["cls"].alias("cls")))
    return F.flatten(F.transform(runs, each))


def emphasis_share(c: Column, pattern: str) -> Column:
    """The share of a line's characters in runs of the pattern's first group, 1 at most; 0 for an empty line."""
    inner = F.aggregate(F.regexp_extract_all(c, F.lit(pattern), 1), F.lit(0), lambda s, x: s + F.length(x))
    return F.when(F.length(c) == 0, 0.0).otherwise(F.least(F.lit(1.0), inner / F.length(c)))
