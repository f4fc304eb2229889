"""Token ids in a content-addressed store.

Each document's ids are cut into chunks where a rolling hash over the last ids
says so; a chunk is named by the SHA-256 of its bytes and stored once. A
recipe lists a document's chunks in order. Recipes lie in ranges of ascending
ids; a manifest holds each range's Merkle root over its documents' roots, and
the root of them all. Reading checks chunks against their names and recipes
against the manifest.

Files, below one folder: ``chunks`` (hash, n, ids: little-endian unsigned
16-bit, or 32-bit for larger vocabularies), ``recipes`` (part, at, doc_id,
copy, start, n_tokens, root, hashes), ``manifest`` (part, n_tokens,
n_documents, root, first_start). All are written and read by Spark.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

END = 2
#: Ids that the rolling hash sees, the mean distance of its cuts, and the longest chunk.
ROLLING, MEAN, LONGEST = 8, 256, 2048
#: The text steps under which words can be encoded one by one.
_BY_WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Words of letters that each step of the tokenizer takes one by one: no two of them are composed, cut apart or lower-cased by their place.
_LATIN = re.compile(r"[a-zÀ-ÖØ-öø-ÿ]+")
#: Stands between words that are encoded together.
_MARK = "\x01"
#: Words whose ids a worker keeps; when there are more, it starts afresh.
MAX_WORDS = 600_000
#: Words encoded at once; what the library holds beside the ids grows with them.
TOGETHER = 4096


#: Documents and bytes of hashes in a range of recipes, about; documents of a Merkle subtree, a power of two.
RANGE_DOCS, RANGE_BYTES, SUBTREE = 200_000, 32 << 20, 1 << 14


class Encoder:
    """Ids of the words of many texts by the tokenizers library, each word asked for once.

    Where the file's steps allow, texts are cut into words that the steps never
    join; special tokens that a text spells get their ids, as the library gives
    them, and what stands around one is encoded by itself.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        steps = json.dumps(spec["normalizer"]), json.dumps(spec["pre_tokenizer"])
        mark = self.tokenizer.encode(_MARK, add_special_tokens=False).ids
        added = spec["added_tokens"]
        plain = all(x["special"] and not (x["normalized"] or x["single_word"] or x["lstrip"] or x["rstrip"]) for x in added)
        # a special token must not be a piece of its own, or it could stand in a list of words
        parts = [len(_pieces(*common.utf8(pa.array([x["content"].lower()])))[0]) for x in added]
        self.by_word = plain and all(n > 1 for n in parts) and json.dumps(_BY_WORD) in steps[1] and "Removed" in steps[1] and '"Lowercase"' in steps[0] and len(mark) == 1
        self.special = {x["content"]: x["id"] for x in added}
        self.spelt = regex.compile("|".join(sorted(map(regex.escape, self.special), key=len, reverse=True))) if added else None
        self.mark = mark[0] if mark else -1
        self.model = self.tokenizer.model
        self.letters = self._letters(spec) if self.by_word else {}
        self._clear()

    def _letters(self, spec: dict) -> dict[int, str]:
        """What the steps before the model make of each letter of _LATIN; empty if there are steps that may look at more than one."""
        inner = lambda x, names: x.get(names) or [x]
        normal = [x for x in inner(spec["normalizer"], "normalizers") if x["type"] not in ("NFC", "Lowercase") and not (x["type"] == "Replace" and x["pattern"] == {"Regex": r"\s+"})]
        cut = [x for x in inner(spec["pre_tokenizer"], "pretokenizers") if not (x["type"] == "Split" and x["pattern"] == {"Regex": _BY_WORD}) and not (x["type"] == "ByteLevel" and not x["add_prefix_space"] and not x["use_regex"])]
        if normal or cut or spec["model"]["type"] != "BPE" or spec["model"].get("dropout"):
            return {}
        made = {c: self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(chr(c))) for c in [*range(0x61, 0x7B), *range(0xC0, 0x100)] if _LATIN.match(chr(c))}
        same = all(len(x) == 1 for x in made.values()) and all(made[c][0][0] == chr(c) for c in range(0x61, 0x7B))
        return {c: x[0][0] for c, x in made.items()} if same else {}

    def _clear(self) -> None:
        self.keys, self.at, self.n, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.fresh: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def _learn(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of words, where each word's begin among them, and how many they are. Words of _LATIN are one piece each and go to the library's model at once; the others take all its steps."""
        if not self.letters:
            return self._marked(words)
        plain = np.array([_LATIN.fullmatch(w) is not None for w in words], bool)
        ids, at, n = np.zeros(0, np.int32), np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        if not plain.all():
            ids, at[~plain], n[~plain] = self._marked([words[i] for i in np.flatnonzero(~plain)])
        tokenize = self.model.tokenize
        got = [[t.id for t in tokenize(w if w.isascii() else w.translate(self.letters))] for w in (words[i] for i in np.flatnonzero(plain))]
        n[plain] = size = np.array([len(x) for x in got], np.int64)
        at[plain] = len(ids) + np.cumsum(size) - size
        return np.concatenate([ids, np.array([x for g in got for x in g], np.int32)]), at, n

    def _marked(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As _learn; the words are encoded as one text, a mark between them."""
        joined = f" {_MARK} ".join(w if _MARK not in w else "" for w in words)
        ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.int32)
        cut = np.flatnonzero(ids == self.mark)
        n, at = np.diff(np.concatenate([[-1], cut, [len(ids)]])) - 1, np.concatenate([[0], cut + 1])
        for i, w in enumerate(words):
            if _MARK in w:
                own = np.array(self.tokenizer.encode(w, add_special_tokens=False).ids, np.int32)
                at[i], n[i] = len(ids), len(own)
                ids = np.concatenate([ids, own])
        return ids, at, n

    def _add(self, ids: np.ndarray, at: np.ndarray, n: np.ndarray) -> None:
        self.fresh.append((at + sum(len(x[2]) for x in self.fresh) + len(self.ids), n, ids))

    def _index(self, keys: np.ndarray) -> None:
        """Take in what was added, in the order of keys."""
        at, n, ids = (np.concatenate(x) for x in zip(*self.fresh, strict=True))
        self.fresh = []
        self.ids = np.concatenate([self.ids, ids])
        every, where, size = np.concatenate([self.keys, keys]), np.concatenate([self.at, at]), np.concatenate([self.n, n])
        order = np.argsort(every)
        self.keys, self.at, self.n = every[order], where[order], size[order]

    def encode(self, column: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each with the end id after it, and where each text's begin (one more entry)."""
        if not self.by_word:
            got = [[*e.ids, end] for e in self.tokenizer.encode_batch_fast(column.to_pylist(), add_special_tokens=False)]
            return np.array([x for g in got for x in g], np.int64), np.concatenate([[0], np.cumsum([len(g) for g in got])]).astype(np.int64)
        if not self.special or not any(pc.any(pc.match_substring(column, x)).as_py() for x in self.special):
            return self._encode(column, np.full(len(column), end, np.int64))
        stretches, after, first = [], [], [0]
        for text in column.to_pylist():
            at = 0
            for m in self.spelt.finditer(text):
                stretches.append(text[at : m.start()])
                after.append(self.special[m.group()])
                at = m.end()
            stretches.append(text[at:])
            after.append(end)
            first.append(len(after))
        ids, begin = self._encode(pa.array(stretches, pa.string()), np.array(after, np.int64))
        return ids, begin[first]

    def _encode(self, column: pa.Array, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each with its own id of after behind it, and where each text's begin (one more entry)."""
        buf, off = common.utf8(column)
        buf = common.lower(buf)
        starts, ends, first = _pieces(buf, off)
        h = common.span_hashes(buf, starts, ends)
        keys, one, inverse = np.unique(h, return_index=True, return_inverse=True)
        known = np.zeros(len(keys), bool)
        if len(self.keys):
            place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            known = self.keys[place] == keys
        if not known.all():
            if len(self.keys) + int((~known).sum()) > MAX_WORDS:
                self._clear()
                known[:] = False
            raw = buf.tobytes()
            new, first_of = keys[~known], one[~known]
            for i in range(0, len(new), TOGETHER):
                self._add(*self._learn([raw[starts[j] : ends[j]].decode("utf-8", "replace") for j in first_of[i : i + TOGETHER]]))
            self._index(new)
        place = np.searchsorted(self.keys, keys)[inverse]
        n, at = self.n[place], self.at[place]
        total = np.concatenate([[0], np.cumsum(n)])
        per = total[first[1:]] - total[first[:-1]] + 1
        begin = np.concatenate([[0], np.cumsum(per)])
        out = np.empty(int(begin[-1]), np.int64)
        inner = np.ones(len(out), bool)
        inner[begin[1:] - 1] = False
        out[~inner] = after
        out[inner] = self.ids[common.ragged(at, n)]
        return out, begin


_KIND = np.full(256, 3, np.uint8)
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[range(97, 123)] = 1
_KIND[list(b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")] = 2


def _pieces(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As common.word_spans of lower-cased bytes, cut also between an ASCII letter and ASCII punctuation other than the apostrophe, where the pre-tokenizer always cuts."""
    k = _KIND[buf]
    n = len(k)
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    if n:
        a, b = k[:-1], k[1:]
        edge[1:-1] |= (a == 0) | (b == 0) | ((a == 1) & (b == 2)) | ((a == 2) & (b == 1))
    solid = k != 0
    starts = np.flatnonzero(solid & edge[:-1])
    return starts, np.flatnonzero(solid & edge[1:]) + 1, np.searchsorted(starts, off)


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


@lru_cache(2)
def _width(path: str) -> int:
    """Bytes of an id in the store."""
    from tokenizers import Tokenizer

    return 2 if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else 4


_MIX = common.mix(np.arange(1 << 16, dtype=np.uint64))


def cuts(ids: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Where chunks begin: at each document's begin, after each id whose rolling hash (of the last ROLLING ids of its document) falls on a MEAN-th, and where a chunk would pass LONGEST."""
    v = _MIX[ids & 0xFFFF] ^ (ids >> 16).astype(np.uint64)
    roll = v.copy()
    for i in range(1, ROLLING):
        roll[i:] += v[:-i] * np.uint64(pow(0x9E3779B97F4A7C15, i, 1 << 64))
    place = np.arange(len(ids)) - np.repeat(begin[:-1], np.diff(begin))
    mark = np.zeros(len(ids) + 1, bool)
    mark[1:] = (common.mix(roll) & np.uint64(MEAN - 1) == 0) & (place >= ROLLING - 1)
    mark[begin] = True
    at = np.flatnonzero(mark[:-1])
    gap = np.diff(np.concatenate([at, [len(ids)]]))
    long = -(-gap // LONGEST)
    return np.repeat(at, long) + LONGEST * (np.arange(int(long.sum())) - np.repeat(np.cumsum(long) - long, long))


def merkle(hashes: list[bytes]) -> bytes:
    """The root of a Merkle tree over hashes: pairs are hashed together, a last single one goes up as it is. Of none: the hash of nothing."""
    level = hashes or [hashlib.sha256(b"").digest()]
    while len(level) > 1:
        level = [hashlib.sha256(b"\x01" + level[i] + level[i + 1]).digest() if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]


def _names(hashes: bytes) -> list[bytes]:
    return [hashes[i : i + 32] for i in range(0, len(hashes), 32)]


def manifest(recipes: DataFrame) -> DataFrame:
    """(part, n_tokens, n_documents, root) of each range of recipes: the Merkle root over its documents' roots.

    Subtrees of SUBTREE documents are hashed first, each in a task of its own,
    then their roots; as they are whole trees, the root is that of all leaves.
    """

    def rooted(group: pa.Table) -> pa.Table:
        g = group.sort_by("at")
        return pa.table({"part": g.column("part")[:1], "at": g.column("next")[:1], "n_tokens": [sum(g.column("n_tokens").to_pylist())], "n_documents": [sum(g.column("n_documents").to_pylist())], "root": pa.array([merkle(g.column("root").to_pylist())], pa.binary())})

    schema = "part int, at long, n_tokens long, n_documents long, root binary"
    leaves = recipes.select("part", "at", F.floor(F.col("at") / SUBTREE).alias("next"), "n_tokens", F.lit(1).cast("long").alias("n_documents"), "root")
    trees = leaves.groupBy("part", "next").applyInArrow(rooted, schema)
    trees = trees.withColumn("next", F.lit(0).cast("long")).groupBy("part").applyInArrow(rooted, schema)
    return trees.drop("at")


def write(docs: DataFrame, folder: str, path: str, end: int = END) -> None:
    """Encode every whole text and write the store.

    A null or empty text is the end id alone; a very long text is encoded by
    itself, its ids cut like all others. Repeated ids keep one recipe each
    (``copy`` tells them apart within a range); a null id comes first; an empty
    table gives an empty store; other columns are not looked at. Each batch
    sends a chunk once, tasks put their batches' chunks together, and what is
    left meets by its hash; of recipes only the hashes move, to ranges of ids.
    The number of ranges follows the input.
    """
    common.ready(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        width = np.uint16 if e.size <= 1 << 16 else np.uint32
        w = width().itemsize
        for b in common.slices(batches, limit=2 << 20):
            ids, begin = e.encode(b.column("text"), end)
            at = cuts(ids, begin)
            edges = (np.concatenate([at, [len(ids)]]) * w).tolist()
            raw = ids.astype(width).tobytes()
            pieces = [raw[x:y] for x, y in pairwise(edges)]
            names = [hashlib.sha256(x).digest() for x in pieces]
            data = dict(zip(names, pieces, strict=True))
            first = np.searchsorted(at, begin).tolist()
            recipes = [b"".join(names[x:y]) for x, y in pairwise(first)]
            m, n = len(data), b.num_rows
            blank = lambda k, kind: pa.nulls(k, kind)
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays(x) for x in ([pa.array(list(data), pa.binary()), blank(n, pa.binary())], [pa.array(list(data.values()), pa.binary()), blank(n, pa.binary())], [blank(m, pa.int64()), b.column("doc_id")], [blank(m, pa.int64()), pa.array(np.diff(begin), pa.int64())], [blank(m, pa.binary()), pa.array(recipes, pa.binary())])],
                ["hash", "ids", "doc_id", "n_tokens", "hashes"],
            )

    zstd = {"compression": "zstd"}
    texts = common.texts(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    sent = common.written(texts.mapInArrow(common.tidy(encode), "hash binary, ids binary, doc_id long, n_tokens long, hashes binary"), f"{folder}/sent", zstd)
    # chunks of one name have the same bytes, so whichever comes first will do
    once = sent.where("hash is not null").groupBy("hash").agg(F.first("ids").alias("ids"))
    common.written(once.select("hash", (F.octet_length("ids") / F.lit(_width(path))).cast("int").alias("n"), "ids"), f"{folder}/chunks", zstd)

    rows = sent.where("hashes is not null").select("doc_id", "n_tokens", "hashes", F.xxhash64("hashes").alias("tie"))
    size = rows.agg(F.count("*"), F.sum(F.octet_length("hashes"))).first()
    parts = max(1, -(-size[0] // RANGE_DOCS), -(-(size[1] or 0) // RANGE_BYTES))
    # only ids and their ties are sampled for the ranges' edges; rows of one id may lie in several ranges
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie")]
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order, "hashes").drop("tie")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Starts within the range; the range's first start follows when all are known."""
        part, at, start, last, copy = TaskContext.get().partitionId(), 0, 0, (), 0
        for b in batches:
            starts, copies, roots = [], [], []
            for doc, n, hashes in zip(*(b.column(c).to_pylist() for c in ("doc_id", "n_tokens", "hashes")), strict=True):
                copy = copy + 1 if last == (doc,) else 0
                last = (doc,)
                starts.append(start)
                copies.append(copy)
                start += n
                roots.append(merkle(_names(hashes)))
            place = pa.array(np.arange(at, at + b.num_rows))
            at += b.num_rows
            yield pa.RecordBatch.from_arrays([pa.array([part] * b.num_rows, pa.int32()), place, b.column("doc_id"), pa.array(copies, pa.int32()), pa.array(starts, pa.int64()), b.column("n_tokens"), pa.array(roots, pa.binary()), b.column("hashes")], ["part", "at", "doc_id", "copy", "start", "n_tokens", "root", "hashes"])

    recipes = common.written(rows.mapInArrow(common.tidy(number), "part int, at long, doc_id long, copy int, start long, n_tokens long, root binary, hashes binary"), f"{folder}/recipes", zstd)
    w = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    common.written(manifest(recipes).withColumn("first_start", F.coalesce(F.sum("n_tokens").over(w), F.lit(0))), f"{folder}/manifest")
    common.removed(docs.sparkSession, f"{folder}/sent")


def _times(m: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The products over GF(2) of a matrix, given by its 32 columns, with vectors of 32 bits."""
    out = np.zeros_like(x)
    for i in range(32):
        out ^= np.where(x >> np.uint32(i) & np.uint32(1), m[i], np.uint32(0))
    return out


@lru_cache(64)
def _zeros(k: int) -> np.ndarray:
    """What carries a crc32 over 2**k zero bytes: for each of its four bytes a table of 256."""
    m = np.array([0xEDB88320, *(1 << i for i in range(31))], np.uint32)  # one bit
    for _ in range(k + 3):
        m = _times(m, m)
    byte = np.arange(256, dtype=np.uint32)
    return np.stack([_times(m, byte << np.uint32(8 * i)) for i in range(4)])


def joined_crc(crc: np.ndarray, size: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The crc32 of documents from those of their pieces and the pieces' bytes; first: each document's first piece (one more entry; every document has one).

    A piece's crc is carried over as many zero bytes as follow it in its
    document; the sum of what comes out, over GF(2), is the document's.
    """
    end = np.concatenate([[0], np.cumsum(size)])
    rest = np.repeat(end[first[1:]], np.diff(first)) - end[1:]
    out = crc.astype(np.uint32)
    for k in range(int(rest.max(initial=0)).bit_length()):
        at = np.flatnonzero(rest >> k & 1)
        x, t = out[at], _zeros(k)
        out[at] = t[0, x & 255] ^ t[1, x >> 8 & 255] ^ t[2, x >> 16 & 255] ^ t[3, x >> 24]
    return np.bitwise_xor.reduceat(out, first[:-1]) if len(first) > 1 else out


def read(spark: SparkSession, folder: str, wide: bool = False) -> DataFrame:
    """One row per document from the store's files: doc_id, start, n_tokens, ids_crc32 (of its ids as little-endian unsigned 32-bit integers).

    Each chunk is read once, checked against its name, and gives a crc32 and a
    length, of which a recipe's are put together; recipes are checked against
    their Merkle root, and ranges against the manifest. What does not agree
    fails the query. wide: chunks of 32-bit ids.
    """
    common.ready(spark)
    kind = np.uint32 if wide else np.uint16

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, data = b.column("hash").to_pylist(), b.column("ids").to_pylist()
            if any(hashlib.sha256(d).digest() != h for h, d in zip(names, data, strict=True)):
                raise ValueError("a chunk does not have the hash that it is named by")
            ids = [np.frombuffer(d, kind).astype("<u4") for d in data]
            yield pa.RecordBatch.from_arrays([b.column("hash"), pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()), pa.array([len(x) for x in ids], pa.int64())], ["hash", "crc", "n"])

    sums = spark.read.parquet(f"{folder}/chunks").select("hash", "ids").mapInArrow(common.tidy(summed), "hash binary, crc long, n long")
    # a range has fewer than 2**32 recipes: its number and a recipe's place in it are one key
    recipes = spark.read.parquet(f"{folder}/recipes").withColumn("key", F.shiftleft(F.col("part").cast("long"), 32).bitwiseOR(F.col("at")))
    size = (F.octet_length("hashes") / 32).cast("int")
    each = recipes.select("key", "hashes", F.explode(F.sequence(F.lit(0), size - 1)).alias("at"))
    each = each.select("key", "at", F.substring("hashes", F.col("at") * 32 + 1, F.lit(32)).alias("hash"))
    told = each.join(sums, "hash", "left").groupBy("key").agg(F.array_sort(F.collect_list(F.struct("at", "crc", "n"))).alias("chunks"))
    kept = spark.read.parquet(f"{folder}/manifest").alias("k").join(manifest(recipes).alias("f"), "part", "left")
    same = F.col("k.root").eqNullSafe(F.col("f.root")) & F.col("k.n_documents").eqNullSafe(F.col("f.n_documents"))
    wrong = F.raise_error(F.lit("the recipes of a range do not agree with the manifest")).cast("long")
    kept = kept.select("part", F.when(same, F.col("first_start")).otherwise(wrong).alias("first_start"))
    keyed = recipes.select("key", "part", "doc_id", "start", "n_tokens", "root", "hashes").join(told, "key").join(kept, "part")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            chunks, n = b.column("chunks"), b.column("n_tokens").to_numpy()
            first = np.frombuffer(chunks.buffers()[1], np.int32)[chunks.offset : chunks.offset + len(chunks) + 1].astype(np.int64)
            part = chunks.flatten()
            size, crc = part.field("n"), part.field("crc")
            first -= first[0]
            if size.null_count or (np.add.reduceat(size.to_numpy(), first[:-1]) != n).any() or any(merkle(_names(h)) != r for h, r in zip(b.column("hashes").to_pylist(), b.column("root").to_pylist(), strict=True)):
                raise ValueError("a recipe does not agree with its chunks or its root")
            start = b.column("start").to_numpy() + b.column("first_start").to_numpy()
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(start), b.column("n_tokens"), pa.array(joined_crc(crc.to_numpy(), 4 * size.to_numpy(), first).astype(np.int64))], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return keyed.select("doc_id", "start", "n_tokens", "root", "hashes", "chunks", "first_start").mapInArrow(common.tidy(joined), "doc_id long, start long, n_tokens long, ids_crc32 long")


def rebuilt(spark: SparkSession, folder: str, among: Column, wide: bool = False) -> DataFrame:
    """(doc_id, copy, ids) of the recipes that ``among`` chooses."""
    recipes = spark.read.parquet(f"{folder}/recipes").where(among)
    each = recipes.select("part", "doc_id", "copy", F.explode(F.sequence(F.lit(0), (F.octet_length("hashes") / 32).cast("int") - 1)).alias("at"), "hashes")
    each = each.select("part", "doc_id", "copy", "at", F.substring("hashes", F.col("at") * 32 + 1, F.lit(32)).alias("hash")).join(spark.read.parquet(f"{folder}/chunks").select("hash", "ids"), "hash")
    kind = np.uint32 if wide else np.uint16

    def whole(group: pa.Table) -> pa.Table:
        g = group.sort_by("at")
        return pa.table({"doc_id": g.column("doc_id")[:1], "copy": g.column("copy")[:1], "ids": pa.array([np.frombuffer(b"".join(g.column("ids").to_pylist()), kind).astype(np.int32)], pa.list_(pa.int32()))})

    return each.groupBy("part", "doc_id", "copy").applyInArrow(whole, "doc_id long, copy int, ids array<int>")
