"""Language identification by prediction by partial matching over bytes.

Each language has a tree of byte contexts of up to three bytes. A byte's code
length in a context is that of the longest context the tree holds; where the
byte was never seen there, an escape (method C, with exclusion of what the
longer context has seen) leads to the next shorter one, at last to all bytes
alike. The statistics are frozen after training. A tree keeps every context,
and of each only the bytes seen in it, with what an escape from it costs; what
a byte costs that was not seen is worked out from the context above when it is
asked for. So trees take memory in proportion to what was learned, and a batch
works out each run of four bytes once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: What is learned from: labelled documents of a language at most, the first ones by a hash of id and text; bytes of their texts; and languages, the most frequent ones. A model of more languages has to be asked for.
TRAIN_DOCS, TRAIN_BYTES, TRAIN_LANGS = 600, 4 << 20, 1024
#: Bytes of a context, the digits of its number, the digit of what stands before a text.
ORDER, BASE, EDGE = 3, 257, 256
#: Bytes of a long text that are looked at together.
STEP = 1 << 20
_LETTER = regex.compile(r"\p{L}")


@dataclass
class Level:
    """The contexts of one length: seen (context * BASE + byte, sorted) with the bits of each byte seen, and the bits of its count; contexts (sorted) with the bits of an escape, of what is left of the context above, and of an escape from that."""

    seen: np.ndarray
    bits: np.ndarray
    count_bits: np.ndarray
    contexts: np.ndarray
    escape: np.ndarray
    left: np.ndarray
    further: np.ndarray


@dataclass
class Trees:
    """langs, and for each its levels from no context to ORDER bytes, and the bits of a byte that the language never has."""

    langs: list[str]
    levels: list[list[Level]]
    unseen: list[float]

    @property
    def nbytes(self) -> int:
        return sum(x.nbytes for own in self.levels for level in own for x in vars(level).values())


def quadruples(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Each byte of all texts with the three before it in its text, as one number."""
    b = buf.astype(np.int64)
    place = np.arange(len(b)) - np.repeat(off[:-1], np.diff(off))
    out = b.copy()
    for d in range(1, ORDER + 1):
        before = np.full(len(b), EDGE, np.int64)
        before[d:] = np.where(place[d:] >= d, b[:-d], EDGE)
        out += before * BASE**d
    return out


def _tree(key: np.ndarray, n: np.ndarray) -> tuple[list[Level], float]:
    levels, above = [], None
    for order in range(ORDER + 1):
        seen, at = np.unique(key % BASE ** (order + 1), return_inverse=True)
        count = np.bincount(at, n)
        contexts, of = np.unique(seen // BASE, return_inverse=True)
        total, kinds = np.bincount(of, count), np.bincount(of).astype(np.float64)
        left, left_kinds = np.ones(len(contexts)), np.ones(len(contexts))
        if above:
            up_seen, up_count, up_contexts, up_total, up_kinds = above
            up = np.searchsorted(up_contexts, contexts % BASE ** (order - 1))
            shared = up_count[np.searchsorted(up_seen, seen % BASE**order)]
            left, left_kinds = up_total[up] - np.bincount(of, shared), up_kinds[up] - kinds
        some = left_kinds > 0
        level = Level(
            seen, np.log2((total + kinds)[of] / count), np.log2(count), contexts, np.log2((total + kinds) / kinds),
            np.log2(np.where(some, left + left_kinds, 1)), np.where(some, np.log2(np.where(some, (left + left_kinds) / np.maximum(left_kinds, 1), 1)), 0.0),
        )
        levels.append(level)
        above = seen, count, contexts, total, kinds
    return levels, float(np.log2(max(1, 256 - len(levels[0].seen))))


def train(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Trees:
    """Trees from each language's quadruples and their counts."""
    own = {lang: _tree(key, n.astype(np.float64)) for lang, (key, n) in sorted(counts.items()) if len(key)}
    return Trees(list(own), [t for t, _ in own.values()], [u for _, u in own.values()])


def _found(keys: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return keys[at] == asked, at


def _bits(levels: list[Level], unseen: float, quads: np.ndarray) -> np.ndarray:
    """The code length of each quadruple's last byte behind the others."""
    full = beyond = up_seen = up_bits = None
    for order, level in enumerate(levels):
        seen, at = _found(level.seen, quads % BASE ** (order + 1))
        known, of = _found(level.contexts, quads // BASE % BASE**order)
        if order == 0:
            beyond = np.full(len(quads), unseen)
            full = np.where(seen, level.bits[at], level.escape[of] + beyond)
        else:
            then = np.where(up_seen, level.left[of] - up_bits, level.further[of] + beyond)
            full = np.where(known, np.where(seen, level.bits[at], level.escape[of] + then), full)
            beyond = np.where(known, then, beyond)
        up_seen, up_bits = seen, level.count_bits[at]  # a context is in the tree only with all shorter ones
    return full


def _sums(trees: Trees, buf: np.ndarray, off: np.ndarray, skip: int = 0) -> np.ndarray:
    out = np.zeros((len(off) - 1, len(trees.langs)))
    quads, at = np.unique(quadruples(buf, off), return_inverse=True)
    some = np.flatnonzero(np.diff(off) > skip)
    for k, (levels, unseen) in enumerate(zip(trees.levels, trees.unseen, strict=True)):
        if len(some):
            out[some, k] = np.add.reduceat(_bits(levels, unseen, quads)[at], off[some] + skip)
    return out


def code_lengths(trees: Trees, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Bits of each text in each language: texts times languages. One long text goes through in steps, each with the bytes before it."""
    if len(off) == 2 and len(buf) > STEP:
        parts = ((buf[max(0, at - ORDER) : at + STEP], min(at, ORDER)) for at in range(0, len(buf), STEP))
        return sum(_sums(trees, part, np.array([0, len(part)]), skip) for part, skip in parts)
    return _sums(trees, buf, off)


def learn(labelled: DataFrame, per_language: int = TRAIN_DOCS, max_bytes: int = TRAIN_BYTES, languages: int = TRAIN_LANGS) -> Trees:
    """Trees learned from (doc_id, text, lang): per_language documents of each language at most, the first ones by a hash of id and text, as long as their whole texts have max_bytes together; of more than ``languages`` languages those with most documents. Rows without lang or text are left out, repeated ids count each by itself, an empty table gives trees of no language."""
    common.ready(labelled.sparkSession)
    rows = labelled.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    known = rows.groupBy("lang").agg(F.count("*").alias("_n")).orderBy(F.desc("_n"), "lang").limit(languages)
    drawn = rows.where(F.octet_length("text") <= max_bytes).join(F.broadcast(known), "lang")  # languages rows at most
    # half as many again as are wanted are drawn where they lie, so that few texts are shuffled
    drawn = drawn.withColumn("_h", F.xxhash64(F.lit("language"), "doc_id", "text"))
    drawn = drawn.where(F.pmod("_h", F.lit(1 << 30)) < F.lit((1 << 30) * 1.5 * per_language) / F.col("_n"))
    first = Window.partitionBy("lang").orderBy(F.pmod("_h", F.lit(1 << 30)), "doc_id", "text")
    drawn = drawn.withColumn("_nth", F.row_number().over(first)).where(F.col("_nth") <= per_language)
    drawn = drawn.withColumn("_sum", F.sum(F.octet_length("text")).over(Window.partitionBy("lang").orderBy("_nth"))).where(F.col("_sum") <= max_bytes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches, limit=1 << 20):
            langs = b.column("lang").dictionary_encode()
            for i, lang in enumerate(langs.dictionary.to_pylist()):
                key, n = np.unique(quadruples(*common.utf8(b.column("text").filter(pa.array(langs.indices.to_numpy() == i)))), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(key), pa.string()), pa.array(key), pa.array(n)], ["lang", "key", "n"])

    grams = drawn.select("lang", "text").mapInArrow(common.tidy(count), "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n")).toArrow()
    coded = grams.column("lang").combine_chunks().dictionary_encode()
    which, key, n = coded.indices.to_numpy(), grams.column("key").to_numpy(), grams.column("n").to_numpy()
    return train({lang: (key[which == i], n[which == i]) for i, lang in enumerate(coded.dictionary.to_pylist())})


SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double, bits_per_byte double"


def identify(docs: DataFrame, trees: Trees, held_out=None) -> DataFrame:
    """One row per document: the language of the shortest code, its share of the probability (2 to the power of minus the code lengths), and its bits per byte.

    A text that is null or has no letter, or with no language learned, is
    ``und`` with score 0. Ties go to the first language by name. Repeated rows
    give repeated rows; an empty table gives an empty result; of other columns
    none is looked at. A very long text goes through in steps. Map-only.
    """
    common.ready(docs.sparkSession)
    ascii_letter = np.zeros(256, bool)
    ascii_letter[[*range(65, 91), *range(97, 123)]] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*trees.langs, "und"], object)
        for b in common.slices(batches, limit=1 << 20):
            buf, off = common.utf8(b.column("text"))
            bits = code_lengths(trees, buf, off)
            letters = np.concatenate([[0], np.cumsum(ascii_letter[buf])])
            some = letters[off[1:]] > letters[off[:-1]]
            for i in np.flatnonzero(~some):
                some[i] = bool(_LETTER.search(b.column("text")[int(i)].as_py()))
            some &= bool(trees.langs)
            best = bits.argmin(1) if trees.langs else np.zeros(len(bits), int)
            least = bits.min(1) if trees.langs else np.zeros(len(bits))
            score = np.where(some, 1 / np.maximum(1, np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(1)), 0.0)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(names[np.where(some, best, -1)], pa.string()), pa.array(score), pa.array(np.where(some, least / np.maximum(1, np.diff(off)), 0.0))],
                ["doc_id", "held_out", "lang_pred", "score", "bits_per_byte"],
            )

    held = F.lit(False) if held_out is None else held_out
    return common.texts(docs).withColumn("held_out", held).mapInArrow(common.tidy(run), SCHEMA)
