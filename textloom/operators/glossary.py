"""Sections of a glossary cut at their heads, and the first example under each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip, u

HEAD = r"\*{2,3}(-?[^\s*]+?)\.?\*\*\.?\s*[—–]\s"
#: The grammatical endings that may follow a suffix.
ENDINGS = ["", "o", "a", "e", "i", "ar", "ir", "or", "as", "is", "os", "us", "ez"]


def cut(docs: DataFrame, head: str = HEAD, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, nth, head, body): from each head at a line's begin to the next; what stands before the first goes, the last runs to the end."""
    parts = F.filter(F.split(F.col(text), rf"(?Um)(?=^{head})"), lambda p: p.rlike(u("^" + head)))
    rows = docs.select(doc, F.posexplode(parts).alias("nth", "body"))
    return rows.select(doc, (F.col("nth") + 1).cast("long").alias("nth"), F.regexp_extract("body", u("^" + head), 1).alias("head"), "body")


def first_example(affix: Column, suffix: Column, body: Column, head: str = HEAD, endings: list[str] = ENDINGS) -> Column:
    """The first word that shows the affix at its place: after ``Ex. :`` if there is one, then in bold, then in italics; '' without any. A suffix must be followed by an ending and not open the word; a prefix must open it."""
    # what later steps use several times is bound by a transform over one element, so that it is worked out once
    once = lambda x, f: F.transform(F.array(x), f)[0]
    runs = lambda rest, p: F.array_join(F.regexp_extract_all(rest, F.lit(p), 1), " , ")

    def fits(word: Column, core: Column) -> Column:
        def shown(bare: Column) -> Column:
            after = F.call_function("substring_index", bare, core, F.lit(-1))  # F.substring_index takes a literal only
            place = F.when(suffix, ~F.startswith(bare, core) & after.isin(endings)).otherwise(F.startswith(bare, core))
            return F.contains(bare, core) & (F.length(bare) > F.length(core)) & place & ~F.contains(word, F.lit(" ")) & F.replace(bare, F.lit("-"), F.lit("")).rlike(r"(?U)^\p{L}+$")

        return once(F.lower(F.regexp_replace(word, "^-+|-+$", "")), shown)

    def first(region: Column, core: Column) -> Column:
        """The first token of a region that fits; only those with the affix somewhere in them are looked at closely."""
        tokens = F.transform(F.split(region, u(r"[,;:()\s]|\s—\s")), lambda t: F.replace(t, F.lit("*"), F.lit("")))
        likely = F.filter(tokens, lambda t: F.contains(F.lower(t), core))
        words = F.transform(likely, lambda t: F.regexp_replace(t, r"^[ .,;:!?—–«»\n]+|[ .,;:!?—–«»\n]+$", ""))
        return F.try_element_at(F.filter(words, lambda w: fits(w, core)), F.lit(1))

    def among(rest: Column, core: Column) -> Column:
        marked = F.when(rest.rlike(u(r"Ex\.\s*:\s*")), F.regexp_replace(rest, u(r"^(?s:.*?)Ex\.\s*:\s*"), ""))
        regions = (marked, runs(rest, r"(?<!\*)\*\*([^*]+?)\*\*(?!\*)"), runs(rest, r"(?<!\*)\*([^*]+?)\*(?!\*)"))
        return F.coalesce(*[first(r, core) for r in regions], F.lit(""))

    core = F.lower(F.regexp_replace(affix, "^-+|-+$", ""))
    return once(F.regexp_replace(body, u("^" + head), ""), lambda rest: once(core, lambda c: among(rest, c)))


def entries(cuts: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Index rows: head, example and size in kibibytes (one at least) of each section; a head that ends with a hyphen only is a prefix."""
    suffix = F.startswith("head", F.lit("-"))
    size = F.greatest(F.floor(F.octet_length("body") / 1024), F.lit(1)).cast("long")
    return cuts.select(doc, "nth", "head", first_example(F.col("head"), suffix, F.col("body")).alias("example"), size.alias("kib"), strip(F.col("body")).alias("body"))
