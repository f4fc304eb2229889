"""Byte-level BPE by prefix dynamic programming.

For every prefix of a piece exactly one token can be the last of its
encoding: the token that ends there and is compatible with the last token of
what stands before it. Two tokens are compatible if BPE leaves them as they
are side by side, which is decided by walking down their merges. Storing each
prefix's last token gives the encoding of every prefix, exact appends, and
re-encoding near an edit from the first changed byte on.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from . import common

#: White space as the Unicode property has it.
_SPACES = r"\t-\r \x85\xa0  -     　"
#: Pieces kept by a worker; when there are more, it starts afresh. Bounds its memory whatever the input.
MAX_CACHE = 400_000
#: Characters of a text whose pieces are looked at in groups, and the pieces of a group.
LONG, GROUP = 1 << 20, 1 << 16
#: Texts of these characters only are split by the quicker of two equal patterns: ASCII without control characters but tab and newlines, and Latin letters.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xc0-\xd6\xd8-\xf6\xf8-ɏ]*")


class Vocabulary:
    """Ranks of byte strings. split[t]: the two tokens that BPE joins last to make t, or (t, t) for a single byte."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks, self.bytes = ranks, {v: k for k, v in ranks.items()}
        self.split: dict[int, tuple[int, int]] = {}
        self.whole: set[bytes] = set()
        for text, rank in sorted(ranks.items(), key=lambda x: x[1]):
            if len(text) == 1:
                self.split[rank] = rank, rank
                continue
            parts = self._merged(text, rank)
            if len(parts) == 2:
                self.split[rank] = parts[0], parts[1]
            else:
                self.whole.add(text)  # merges never make it; it only stands for a piece that equals it
        #: Every end of a token's bytes: the token that it is itself, or -1.
        self.tails = {t[i:]: -1 for t in ranks for i in range(len(t))} | {t: r for t, r in ranks.items() if r in self.split}
        self.pairs = {p: t for t, p in self.split.items() if p[0] != t}
        self._fits: dict[int, bool] = {}
        general = pattern.replace(r"[^\s", rf"[^{_SPACES}").replace(r"(?!\S)", rf"(?![^{_SPACES}])").replace(r"\s", f"[{_SPACES}]")
        self.general = regex.compile(general)
        self.quick = re.compile(pattern.replace(r"[^\s\p{L}\p{N}]", r"[^\sA-Za-z0-9\xc0-ɏ]").replace(r"\p{L}", r"[A-Za-z\xc0-ɏ]").replace(r"\p{N}", "[0-9]"))

    def _merged(self, text: bytes, below: int) -> list[int]:
        """What merges of ranks under below make of text; used for the vocabulary's own entries only."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], below))
            if self.ranks.get(parts[best] + parts[best + 1], below) >= below:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return [self.ranks[p] for p in parts]

    def fits(self, left: int, right: int) -> bool:
        """Whether BPE keeps left and right apart when they stand side by side."""
        key = left << 32 | right
        known = self._fits.get(key)
        if known is None:
            if len(self._fits) > MAX_CACHE:
                self._fits.clear()
            known = self._fits[key] = self._walk(left, right)
        return known

    def _walk(self, left: int, right: int) -> bool:
        """Undo the later of the two tokens' last merges, again and again; the pair falls if at some stage the tokens that then meet would merge before what is undone."""
        until = 1 << 62
        while True:
            merged = self.pairs.get((left, right))
            if merged is not None and merged < until:
                return False
            if left > right:
                inner = self.split[left][1]
                if inner != left:
                    until, left = left, inner
                    continue
                until, inner = right + 1, self.split[right][0]
                if inner == right:
                    return True
                right = inner
            else:
                inner = self.split[right][0]
                if inner != right:
                    until, right = right + 1, inner
                    continue
                until, inner = left, self.split[left][1]
                if inner == left:
                    return True
                left = inner

    def last_tokens(self, piece: bytes, known: list[int] | None = None) -> list[int]:
        """The last token of each prefix of piece, from length 1 on. known: those of a prefix, kept as they are (an append, or the part before an edit)."""
        last = list(known or ())
        tails, fits, memo = self.tails, self.fits, self._fits
        for end in range(len(last) + 1, len(piece) + 1):
            for begin in range(end - 1, -1, -1):
                token = tails.get(piece[begin:end])
                if token is None:
                    raise ValueError("a byte is missing from the vocabulary")
                if token < 0:
                    continue
                if begin:
                    left = last[begin - 1]
                    fit = memo.get(left << 32 | token)
                    if not (fits(left, token) if fit is None else fit):
                        continue
                last.append(token)
                break
        return last

    def tokens(self, last: list[int], end: int | None = None) -> list[int]:
        """The encoding of the prefix of length end, read back from the last tokens."""
        out, at = [], len(last) if end is None else end
        while at:
            out.append(last[at - 1])
            at -= len(self.bytes[out[-1]])
        return out[::-1]

    def piece(self, text: bytes) -> list[int]:
        whole = self.ranks.get(text)
        return [whole] if whole is not None else self.tokens(self.last_tokens(text))

    def edited(self, text: bytes, last: list[int], start: int, end: int, new: bytes) -> tuple[bytes, list[int]]:
        """A piece with bytes start to end replaced, and its last tokens; those of the prefixes before start are not computed again."""
        out = text[:start] + new + text[end:]
        return out, self.last_tokens(out, last[:start])

    def splitter(self, text: str):
        return self.quick if _PLAIN.fullmatch(text) else self.general

    def pieces(self, text: str) -> list[str]:
        return self.splitter(text).findall(text)

    def encode(self, text: str) -> list[int]:
        return [t for p in self.pieces(text) for t in self.piece(p.encode("utf-8", "replace"))]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(2)
def vocabulary(path: str, pattern: str) -> Vocabulary:
    """The vocabulary at path, a file of the tokenizer package that each node has."""
    return Vocabulary(read_ranks(path), pattern)


class Known(dict):
    """What each piece becomes: its ids, as a comma-joined string and as a number of them, and the bytes that they decode to."""

    def __init__(self, v: Vocabulary) -> None:
        self.v = v

    def stream(self, text: str) -> tuple[int, str, str]:
        """The number of a long text's ids and both digests, its pieces looked at in groups."""
        n, ids, back, first = 0, hashlib.sha256(), hashlib.sha256(), True
        found = (m.group() for m in self.v.splitter(text).finditer(text))
        while group := list(islice(found, GROUP)):
            self.learn(set(group))
            strings, counts, decoded = zip(*(self[p] for p in group), strict=True)
            ids.update((("" if first else ",") + ",".join(strings)).encode())
            back.update(b"".join(decoded))
            n, first = n + sum(counts), False
        return n, ids.hexdigest(), back.hexdigest()

    def learn(self, pieces: set[str]) -> None:
        """Add the pieces that are not known yet: in the order of their bytes, each begins with the last tokens of what it shares with the one before."""
        new = pieces - self.keys()
        if len(self) + len(new) > MAX_CACHE:
            self.clear()
            new = pieces
        v, before, last = self.v, b"", []
        for text, piece in sorted((p.encode("utf-8", "replace"), p) for p in new):
            whole = v.ranks.get(text)
            if whole is not None:
                ids = [whole]
            else:
                same = 0
                for x, y in zip(text, before):  # noqa: B905
                    if x != y:
                        break
                    same += 1
                before, last = text, v.last_tokens(text, last[:same])
                ids = v.tokens(last)
            self[piece] = ",".join(map(str, ids)), len(ids), v.decode(ids)


@lru_cache(2)
def _known(path: str, pattern: str) -> Known:
    return Known(vocabulary(path, pattern))


SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per document: doc_id, the number of ids, and the SHA-256 of the ids (decimal, comma-joined) and of the bytes they decode to.

    Null and empty texts have no ids. Repeated rows give repeated rows; an
    empty table an empty result; other columns are not looked at. A text of
    more than LONG characters goes through in groups of pieces. Map-only.
    """
    common.ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _known(path, pattern)
        split = known.v.pieces
        for b in common.slices(batches):
            if b.num_rows == 1 and len(text := b.column("text")[0].as_py()) > LONG:
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), *[pa.array([x]) for x in known.stream(text)]], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
                continue
            n, ids, back = array("q"), [], []
            pieces = [split(text) for text in b.column("text").to_pylist()]
            known.learn(set().union(*pieces))
            for each in pieces:
                rows = [known[p] for p in each]
                strings, counts, decoded = zip(*rows, strict=True) if rows else ((), (), ())
                n.append(sum(counts))
                ids.append(hashlib.sha256(",".join(strings).encode()).hexdigest())
                back.append(hashlib.sha256(b"".join(decoded)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids), pa.array(back)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return common.texts(docs).mapInArrow(common.tidy(run), SCHEMA)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per document: doc_id and its token ids. Cases as digests()."""
    common.ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path, pattern)
        for b in common.slices(batches):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([v.encode(t) for t in b.column("text").to_pylist()], pa.list_(pa.int32()))], ["doc_id", "ids"])

    return common.texts(docs).mapInArrow(common.tidy(run), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids) to (doc_id, text); bytes that are not UTF-8 become U+FFFD. Null ids count as none."""
    common.ready(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path, pattern)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([v.decode(i or ()).decode("utf-8", "replace") for i in b.column("ids").to_pylist()], pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(common.tidy(run), "doc_id long, text string")


def stage(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """docs with n_tokens and token_ids after its columns (a column so named before gives way); the ids of every whole text. Null and empty texts have none; repeated rows each have theirs; a very long text's ids are one array; an empty table gives an empty result."""
    from pyspark.sql import types as T

    common.ready(docs.sparkSession)
    d = docs.drop("n_tokens", "token_ids")
    schema = T.StructType([*d.schema.fields, T.StructField("n_tokens", T.LongType()), T.StructField("token_ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path, pattern)
        memo: dict[str, list[int]] = {}
        for b in common.slices((b.append_column("_text", b.column("text").fill_null("")) for b in batches), None, 1 << 20):
            values, off = array("i"), array("i", [0])
            for text in b.column(b.num_columns - 1).to_pylist():
                for p in v.pieces(text):
                    ids = memo.get(p)
                    if ids is None:
                        if len(memo) >= MAX_CACHE:
                            memo.clear()
                        ids = memo[p] = array("i", v.piece(p.encode("utf-8", "replace")))
                    values.extend(ids)
                off.append(len(values))
            ids = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(values, pa.int32()))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array([y - x for x, y in zip(off, off[1:])], pa.int64()), ids], [*b.schema.names[:-1], "n_tokens", "token_ids"])

    return d.mapInArrow(common.tidy(run), schema)
