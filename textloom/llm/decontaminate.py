"""Benchmark decontamination by SimHash windows.

Windows of an item's size slide over each document. A window's fingerprint is
the SimHash of its pairs of neighbouring words, taken from running vote
counts. Windows start at every STRIDE-th word of a document; an item has the
fingerprints of its words from STRIDE successive starts on, at its begin and
again up to its end, so that one of them is aligned with a window wherever the
passage stands; an item of more than LONGEST words has windows all over it. At
a document's end the windows are what is left of it, down to SIMILAR of their
size, so that short documents and cut passages are compared too. A multi-index
over blocks of the fingerprint finds every item fingerprint within the Hamming
radius; each candidate is then compared word by word: the multisets of
five-word shingles of item and window, by weighted Jaccard similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Largest number of differing bits, and the number of 16-bit blocks: some block of two such fingerprints differs in RADIUS // BLOCKS bits at most.
RADIUS, BLOCKS = 11, 4
STRIDE, WIDTH, SIMILAR = 4, 5, 0.75
#: Window sizes grow by this factor; an item has the largest that it holds with all its starts, LONGEST at most.
GROWTH, LONGEST = 1.15, 2048
#: Bytes of the items' part of an index, about (beside it are the block tables of some dozens of window sizes, a megabyte each). A larger benchmark is searched for in several passes.
MAX_BYTES = 48 << 20
#: Words whose votes are counted at once.
STEP = 1 << 15
_LANES = np.uint64(0x0001000100010001)


@dataclass
class Class:
    """Items of one window size: size and stride in words; fingerprints, their items and starts; heads and entries: for each block, where the list of each 16-bit value begins, and the fingerprints in it."""

    size: int
    stride: int
    prints: np.ndarray
    item: np.ndarray
    start: np.ndarray
    heads: list[np.ndarray]
    entries: list[np.ndarray]


@dataclass
class Index:
    """Of each item its id, its number of words, its multiset of shingles, and its different ones with their places; and the classes."""

    ids: list[int]
    sizes: list[int]
    shingles: list[np.ndarray]
    places: list[tuple[np.ndarray, np.ndarray]]
    classes: list[Class]

    def begin(self, item: int, region: np.ndarray, at: int, else_: int) -> int:
        """Where the item begins if most of the shingles that a region of a text, from the place at on, shares with it stand at their places."""
        known, place = self.places[item]
        i = np.minimum(np.searchsorted(known, region), len(known) - 1)
        same = np.flatnonzero(known[i] == region)
        if not len(same):
            return else_
        begins, n = np.unique(same + at - place[i[same]], return_counts=True)
        return int(begins[n.argmax()])


def _hashes(text: str) -> np.ndarray:
    buf, off = common.utf8(pa.array([text]))
    starts, ends, _ = common.word_spans(buf, off)
    return common.span_hashes(buf, starts, ends)


def pairs(h: np.ndarray) -> np.ndarray:
    """A hash for each word and the next one."""
    return common.mix(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:])


def shingle_hashes(h: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """A hash of each five words; of fewer words, one of the whole sequence."""
    k = min(len(h), width)
    out = np.full(len(h) - k + 1 if k else 0, k, np.uint64)
    for i in range(k):
        out = common.mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i : i + len(out)])
    return out


def multiset(s: np.ndarray) -> np.ndarray:
    """A sorted set that stands for the multiset s: what occurs again gets a hash of its own each time."""
    s = np.sort(s)
    place = np.arange(len(s))
    again = place - np.maximum.accumulate(np.where(np.diff(s, prepend=~s[:1]) != 0, place, 0))
    return np.sort(s + again.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) if again.any() else s


def weighted_similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two multisets."""
    both = common.shared(a, b)
    return both / max(1, len(a) + len(b) - both)


def window_prints(terms: np.ndarray, count: int, stride: int, counts: np.ndarray | None = None) -> np.ndarray:
    """SimHash fingerprints of count successive terms from every stride-th term on: a bit is set if more than half of the terms set it. counts: vote_counts(terms)."""
    c = vote_counts(terms) if counts is None else counts
    last = max(0, c.shape[1] - count)
    out = np.zeros(len(range(0, last, stride)), np.uint64)
    more = _LANES * np.uint64(0x8000 - count // 2 - 1)
    for i in range(16):
        out |= (c[i, count::stride] - c[i, :last:stride] + more >> np.uint64(15) & _LANES) << np.uint64(i)
    return out


def span_prints(counts: np.ndarray, begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """As window_prints, of n[i] terms from begin[i] on."""
    out = np.zeros(len(begin), np.uint64)
    more = _LANES * (0x8000 - n // 2 - 1).astype(np.uint64)
    for i in range(16):
        out |= (counts[i, begin + n] - counts[i, begin] + more >> np.uint64(15) & _LANES) << np.uint64(i)
    return out


def vote_counts(terms: np.ndarray) -> np.ndarray:
    """How many of the first n terms set each bit, for fewer than 2**15 terms a window and 2**16 in all: row i has the bits i, i + 16, i + 32 and i + 48 in four lanes."""
    out = np.zeros((16, len(terms) + 1), np.uint64)
    for i in range(16):
        np.cumsum(terms >> np.uint64(i) & _LANES, out=out[i, 1:])
    return out


def _near() -> np.ndarray:
    """All 16-bit numbers with RADIUS // BLOCKS bits at most."""
    return np.array([sum(1 << b for b in bits) for k in range(RADIUS // BLOCKS + 1) for bits in combinations(range(16), k)], np.uint64)


def window_starts(words: int) -> tuple[int, int, list[int]]:
    """An item's window size and stride, and the first starts of its windows: from its begin on, one after the other, and up to its end."""
    stride = STRIDE if words >= 4 * STRIDE else 1
    size, most = 1.0, min(words - stride + 1, LONGEST)
    while int(size * GROWTH + 1) <= most:
        size = int(size * GROWTH + 1)
    last = words - int(size) - stride + 1
    # a large window is much like those beside it: it moves by a 64th of its size or less, a power of two
    return int(size), max(stride, 1 << max(0, (int(size) // 64).bit_length() - 1)), sorted({*range(0, last + 1, int(size)), last})


def build(items: list[tuple[int, str]]) -> Index:
    """The index of (item_id, text); items without words are left out. Items of one word are compared by their word."""
    ids, words = [], []
    for i, text in items:
        h = _hashes(text or "")
        if len(h):
            ids.append(i)
            words.append(h)
    sizes: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for at, h in enumerate(words):
        size, stride, starts = window_starts(len(h))
        own = range(stride) if stride <= STRIDE else (0,)
        sizes.setdefault((size, stride), []).extend((at, x + o) for x in starts for o in own)
    near, classes = _near(), []
    for (size, stride), members in sorted(sizes.items()):
        members = sorted(set(members))
        p = np.array([int(words[at][o]) if size == 1 else int(window_prints(pairs(words[at][o : o + size]), size - 1, 1)[0]) for at, o in members], np.uint64)
        heads, entries = [], []
        for b in range(BLOCKS):
            value = ((p >> np.uint64(16 * b) & np.uint64(0xFFFF))[:, None] ^ near).ravel().astype(np.int64)
            order = np.argsort(value, kind="stable")
            heads.append(np.searchsorted(value[order], np.arange((1 << 16) + 1)).astype(np.int32))
            entries.append((order // len(near)).astype(np.int32))
        classes.append(Class(size, stride, p, *(np.array(x) for x in zip(*members, strict=True)), heads, entries))
    fives = [shingle_hashes(h) for h in words]
    return Index(ids, [len(h) for h in words], [multiset(x) for x in fives], [np.unique(x, return_index=True) for x in fives], classes)


def within(c: Class, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (window, item fingerprint) within the radius, each once."""
    found = []
    for b in range(BLOCKS):
        value = (prints >> np.uint64(16 * b) & np.uint64(0xFFFF)).astype(np.int64)
        n = c.heads[b][value + 1] - c.heads[b][value]
        some = np.flatnonzero(n)
        window = np.repeat(some, n[some])
        entry = c.entries[b][common.ragged(c.heads[b][value[some]], n[some])]
        ok = np.bitwise_count(prints[window] ^ c.prints[entry]) <= RADIUS
        found.append(window[ok] * len(c.prints) + entry[ok])
    both = np.unique(np.concatenate(found))
    return both // len(c.prints), both % len(c.prints)


def leaks(index: Index, h: np.ndarray, first: np.ndarray, similar: float = SIMILAR) -> list[tuple[int, int, float, int]]:
    """(document, item, similarity, first word of the window) for documents given by their word hashes one after the other and where each begins (one more entry); for each document and item the most similar window, the first of equals. A document's rows depend on itself only."""
    best: dict[tuple[int, int], tuple[float, int]] = {}
    done: set[tuple[int, int]] = set()
    longest = max((c.size for c in index.classes), default=0)
    # every document begins at a multiple of all strides
    grid = max((c.stride for c in index.classes), default=1)
    words = np.diff(first)
    room = -(-words // grid) * grid
    begins = np.concatenate([[0], np.cumsum(room)])
    g = np.zeros(int(begins[-1]), np.uint64)
    g[common.ragged(begins[:-1], words)] = h
    doc_of = np.repeat(np.arange(len(words)), room)
    left = np.repeat(begins[:-1] + words, room) - np.arange(len(g))  # words from here on in the document
    fives = shingle_hashes(g) if len(g) >= WIDTH else g[:0]
    for at in range(0, len(g), STEP):
        piece = g[at : at + STEP + longest]
        counts = vote_counts(pairs(piece))
        for c in index.classes:
            rest = left[at : at + STEP : c.stride]
            prints = piece[: len(rest)].copy() if c.size == 1 else np.zeros(len(rest), np.uint64)
            if c.size > 1:
                whole = window_prints(piece, c.size - 1, c.stride, counts)[: len(rest)]
                prints[: len(whole)] = whole
            short = np.flatnonzero((rest < c.size) & (rest >= max(2, similar * c.size)))
            prints[short] = span_prints(counts, short * c.stride, rest[short] - 1)
            use = np.flatnonzero((rest >= c.size) | (rest >= max(2, similar * c.size)))
            for w, e in zip(*(x.tolist() for x in within(c, prints[use])), strict=True):
                middle, item = at + int(use[w]) * c.stride, int(c.item[e])
                begin = middle - int(c.start[e])
                size, doc = index.sizes[item], int(doc_of[middle])
                low, high = int(begins[doc]), int(begins[doc] + words[doc])
                if c.stride > STRIDE:
                    a = max(low, begin - c.stride)
                    begin = index.begin(item, fives[a : max(a, min(high, begin + size + c.stride) - WIDTH + 1)], a, begin)
                if (begin, item) in done:
                    continue
                done.add((begin, item))
                for s in (begin, begin - 1, begin + 1):
                    s = min(max(s, low), max(low, high - size))
                    to = min(s + size, high)
                    own = fives[s : to - WIDTH + 1] if to - s >= WIDTH else shingle_hashes(g[s:to])
                    like = weighted_similarity(index.shingles[item], multiset(own))
                    if like >= similar and (like, low - s) > best.get((doc, item), (0.0, 0)):
                        best[doc, item] = like, low - s
        done = {(b, i) for b, i in done if b > at + STEP - longest} if len(done) < 1 << 20 else set()
    return [(d, i, like, -s) for (d, i), (like, s) in sorted(best.items())]


def _indexes(benchmark: DataFrame, max_bytes: int) -> Iterator[Index]:
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.lower("text").alias("text")).where("text is not null")
    entry = 4 * BLOCKS * len(_near()) + 32
    words = F.size(F.split("text", r"[\x20\x09-\x0D]+"))
    total = items.agg(F.sum(words * 40 + (words / LONGEST + 2) * (STRIDE * entry))).first()[0] or 0
    passes = max(1, -(-int(total) // max_bytes))
    for p in range(passes):
        yield build([(r["item_id"], r["text"]) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == p).orderBy("item_id", "text").collect()])


SCHEMA = "doc_id long, item_id long, similarity double, first_word long"


def find(docs: DataFrame, benchmark: DataFrame, max_bytes: int = MAX_BYTES) -> DataFrame:
    """One row for each document and benchmark item (item_id, text) that it holds: doc_id, item_id, similarity, and where in the document's words the most similar window begins.

    Letters of either case are alike. Null texts and texts without words, of either table, are in no row.
    Repeated documents each give their rows, repeated items too; an empty
    table gives an empty result; a null id comes back as null; other columns
    are not looked at. Very long texts go through in steps, beside which their
    words' hashes are in memory. Map-only: an index of about max_bytes goes
    with the tasks, and a larger benchmark is searched for in passes.
    """
    common.ready(docs.sparkSession)
    out = None
    for index in _indexes(benchmark, max_bytes):

        def run(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for b in common.slices(batches, limit=2 << 20):
                buf, off = common.utf8(b.column("text"))
                starts, ends, first = common.word_spans(buf, off)
                rows = leaks(index, common.span_hashes(buf, starts, ends), first)
                ids = b.column("doc_id").take(pa.array([r[0] for r in rows], pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, pa.array([index.ids[r[1]] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.float64()), pa.array([r[3] for r in rows], pa.int64())], ["doc_id", "item_id", "similarity", "first_word"])

        part = common.texts(docs).withColumn("text", F.lower("text")).mapInArrow(common.tidy(run), SCHEMA)
        out = part if out is None else out.unionAll(part)
    return out


def without(docs: DataFrame, benchmark: DataFrame, max_bytes: int = MAX_BYTES) -> DataFrame:
    """The rows of docs, with all their columns, whose text holds no benchmark item; cases, and letters in lower case, as find(). Map-only."""
    common.ready(docs.sparkSession)
    lowered = next(f"_lower{i}" for i in range(len(docs.columns) + 1) if f"_lower{i}" not in docs.columns)
    for index in _indexes(benchmark, max_bytes):

        def run(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for b in common.slices(batches, None, 2 << 20):
                buf, off = common.utf8(b.column(b.num_columns - 1))
                starts, ends, first = common.word_spans(buf, off)
                bad = {r[0] for r in leaks(index, common.span_hashes(buf, starts, ends), first)}
                yield b.select(range(b.num_columns - 1)).filter(pa.array([i not in bad for i in range(b.num_rows)]))

        both = docs.select("*", F.lower(F.coalesce(F.col("text"), F.lit(""))).alias(lowered))
        docs = both.mapInArrow(common.tidy(run), docs.schema)
    return docs
