"""Word streams in blocks, and global counts of their keys.

A block holds some megabytes of documents as word hashes. Counting keys (words,
word pairs, shingles) over all blocks takes an exchange: each block sends its
distinct keys with its own counts, sorted and packed, to the bucket that the
key's leading bits name; a bucket adds them up and sends each block the totals
of what it asked for, in the order it asked. So a key that every document
holds is sent once a block, and no row is made for a single word.

A block sends to FAN buckets at most. Where more are needed, groups of about
FAN blocks put their keys together first, a group for each of the FAN buckets;
what they have is sent on by the next bits of the key, and the totals come
back the same way. So rows grow in proportion to the blocks, no task hears
from more than some FAN others, and a key that all documents hold has become
one of a few groups' keys where it is added up.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Bytes of text in a block, and keys that a bucket adds up, about. Both bound the memory of a task.
BLOCK_BYTES, BUCKET_KEYS = 6 << 20, 1 << 20
#: Bytes of text whose words are hashed at a time; some 50 bytes of arrays go with each.
SLICE_BYTES = 1 << 19
#: Texts that a Python worker gets at a time.
BATCH = 1024
#: Leading bits of a key by which one step deals, and so the rows that a block sends at most.
DIGIT = 8
FAN = 1 << DIGIT
BLOCKS = "block long, kind int, n long, ids binary, flags binary, words binary, distinct binary, index binary"


def pack(a: np.ndarray) -> bytes:
    """A sorted or small array as zlib-compressed byte planes."""
    a = np.ascontiguousarray(a)
    return zlib.compress(a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes(), 1)


def unpack(b: bytes, dtype) -> np.ndarray:
    d = np.dtype(dtype)
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(b), np.uint8).reshape(d.itemsize, -1).T).view(d).ravel()


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys as differences, in byte planes: middle planes as they are (they are random), the top two compressed, empty ones left out."""
    planes = np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T
    some = [i for i in range(8) if planes[i].any()]
    low, high = (some[0], some[-1] + 1) if some else (0, 0)
    mid = max(low, high - 2)
    return len(keys).to_bytes(4, "little") + bytes([low, mid, high]) + planes[low:mid].tobytes() + zlib.compress(planes[mid:high].tobytes(), 1)


def unpack_keys(b: bytes) -> np.ndarray:
    n, low, mid, high = int.from_bytes(b[:4], "little"), b[4], b[5], b[6]
    planes = np.zeros((8, n), np.uint8)
    planes[low:mid] = np.frombuffer(b, np.uint8, (mid - low) * n, 7).reshape(mid - low, n)
    planes[mid:high] = np.frombuffer(zlib.decompress(b[7 + (mid - low) * n :]), np.uint8).reshape(high - mid, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def blocks(rows: DataFrame, path: str) -> DataFrame:
    """rows (doc_id, text, kind int, flag int) as a table of blocks at path: documents of one kind together. n: words; ids, flags, words: each document's id, flag and number of words; distinct: the block's distinct word hashes; index: of each word in turn, into distinct. Words are lower-cased in A-Z."""
    common.ready(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        made = 0

        def block(kind: int) -> pa.RecordBatch:
            nonlocal made
            parts = held.pop(kind)
            ids, flags, counts, hashes = (np.concatenate([p[i] for p in parts]) for i in range(4))
            distinct, index = np.unique(hashes, return_inverse=True)
            made += 1
            row = [TaskContext.get().partitionId() << 24 | made, kind, len(hashes), pack(ids), pack(flags), pack(counts), pack_keys(distinct), pack(index.astype(np.uint32))]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, [pa.int64(), pa.int32(), pa.int64(), *[pa.binary()] * 5], strict=True)], ["block", "kind", "n", "ids", "flags", "words", "distinct", "index"])

        for b in common.slices(batches, limit=SLICE_BYTES):
            buf, off = common.utf8(b.column("text"))
            buf = common.lower(buf)
            starts, ends, first = common.word_spans(buf, off)
            hashes = common.span_hashes(buf, starts, ends)
            kinds, ids, flags = b.column("kind").to_numpy(), b.column("doc_id").fill_null(-(1 << 63)).to_numpy(), b.column("flag").to_numpy().astype(np.int8)
            for kind in np.unique(kinds):
                at = np.flatnonzero(kinds == kind)
                n = np.diff(first)[at]
                part = ids[at], flags[at], n.astype(np.uint32), hashes if len(at) == len(kinds) else hashes[common.ragged(first[at], n)]
                held.setdefault(int(kind), []).append((*part, int(np.diff(off)[at].sum())))
                if sum(p[4] for p in held[int(kind)]) >= BLOCK_BYTES:
                    yield block(int(kind))
        for kind in list(held):
            yield block(kind)

    return common.written(rows.select("doc_id", "text", "kind", "flag").mapInArrow(common.tidy(run), BLOCKS), path, {"compression": "zstd"}, BATCH)


def read_block(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """ids, flags, index of each document's first word (one more), distinct word hashes, word index."""
    words = unpack(row["words"], np.uint32).astype(np.int64)
    return unpack(row["ids"], np.int64), unpack(row["flags"], np.int8), np.concatenate([[0], np.cumsum(words)]), unpack_keys(row["distinct"]), unpack(row["index"], np.uint32).astype(np.int64)


def digits_for(keys: int) -> list[int]:
    """How many leading bits each step deals by. One step, with all its buckets from some millions of keys on, reaches to FAN * BUCKET_KEYS."""
    if keys <= FAN * BUCKET_KEYS:
        return [min(DIGIT, (max(1, keys) * 8 // BUCKET_KEYS).bit_length())]
    bits = (keys // BUCKET_KEYS).bit_length()
    return [min(DIGIT, bits - i) for i in range(0, bits, DIGIT)]


SENT = "level int, prefix long, part long, sender long, keys binary, counts binary"
TOLD = "level int, prefix long, part long, receiver long, counts binary, distinct long"


def _deal(level: int, keys: np.ndarray, counts: np.ndarray, done: int, bits: int, groups: int, sender: int) -> Iterator[tuple]:
    """Rows (as SENT) of keys that agree in their first done bits, by the next bits. The part is one of groups, by a hash of the sender."""
    total = done + bits
    prefix = keys >> np.uint64(64 - total) if total else np.zeros(len(keys), np.uint64)
    cut = np.flatnonzero(np.diff(prefix, prepend=~prefix[:1]))
    part = int(common.mix(np.array([sender], np.uint64))[0] % np.uint64(groups))
    for a, b in pairwise([*cut.tolist(), len(keys)]):
        yield level, int(prefix[a]), part, sender, pack_keys(keys[a:b]), pack(counts[:, a:b].ravel())


def _sent(rows: Iterable[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * 6
    return pa.table([pa.array(c, t) for c, t in zip(columns, [pa.int32(), *[pa.int64()] * 3, *[pa.binary()] * 2], strict=True)], ["level", "prefix", "part", "sender", "keys", "counts"])


def _merged(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All keys, sorted and distinct; the place of each one's own among them, one list after the other; and where lists begin."""
    every, place = np.unique(np.concatenate(keys), return_inverse=True)
    return every, place, np.concatenate([[0], np.cumsum([len(k) for k in keys])])


def _summed(group: pa.Table, kind: type) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A group of SENT rows, their counts being numbers of that kind: senders, all keys, the places of theirs, where those begin, and both counts of all keys."""
    every, place, edges = _merged([unpack_keys(k.as_py()) for k in group.column("keys")])
    both = np.concatenate([unpack(c.as_py(), kind).reshape(2, -1) for c in group.column("counts")], axis=1)
    total = np.stack([np.bincount(place, c, len(every)) for c in both]).astype(np.uint64)
    return group.column("sender").to_pylist(), every, place, edges, total


def _told(level: int, prefix: int, senders: list[int], place: np.ndarray, edges: np.ndarray, total: np.ndarray) -> pa.Table:
    """Each sender's totals, and a row without receiver: how many keys have a count at all."""
    n = len(senders)
    blobs = [pack(total[:, place[edges[i] : edges[i + 1]]].ravel()) for i in range(n)]
    columns = [[level] * (n + 1), [prefix] * (n + 1), [0] * (n + 1), [*senders, None], [*blobs, None], [None] * n + [int((total.sum(0) > 0).sum())]]
    return pa.table([pa.array(c, t) for c, t in zip(columns, [pa.int32(), *[pa.int64()] * 3, pa.binary(), pa.int64()], strict=True)], ["level", "prefix", "part", "receiver", "counts", "distinct"])


def totals(table: DataFrame, keys_of: Callable, sizes: list[int], path: str) -> DataFrame:
    """The exchange. keys_of(row) gives for each level the sorted distinct keys of a block and two arrays of its own counts; sizes: about how many keys each level has.

    The result, a table at path: (level, prefix, receiver, counts), counts
    being the totals of both counts for the keys of the block ``receiver``
    that have the prefix, one after the other; and for each bucket a row with
    receiver null and distinct: how many keys have a count at all. Of an empty
    table the result is empty.
    """
    spark = table.sparkSession
    common.ready(spark)
    digits = [digits_for(n) for n in sizes]
    steps = max(map(len, digits))
    digits = [[*d, *[0] * (steps - len(d))] for d in digits]
    done = [np.concatenate([[0], np.cumsum(d)]).tolist() for d in digits]
    n = table.count() if steps > 1 else 1
    kinds = [np.uint32, *[np.uint64] * steps]  # a block's counts are small, those of many may not be
    groups = [max(1, -(-n // FAN ** (i + 1))) if i + 1 < steps else 1 for i in range(steps)]

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                rows = (x for level, (keys, *counts) in enumerate(keys_of(row)) if len(keys) for x in _deal(level, keys, np.stack(counts).astype(kinds[0]), 0, digits[level][0], groups[0], row["block"]))
                yield from _sent(rows).to_batches()

    sent = [table.mapInArrow(common.tidy(ask), SENT)]

    def together(i: int) -> Callable:
        def run(group: pa.Table) -> pa.Table:
            level, prefix, part = (group.column(c)[0].as_py() for c in ("level", "prefix", "part"))
            _, every, _, _, total = _summed(group, kinds[i - 1])
            return _sent(_deal(level, every, total, done[level][i], digits[level][i], groups[i], prefix << 32 | part))

        return run

    for i in range(1, steps):
        sent[-1] = common.written(sent[-1], f"{path}-sent{i}", {"compression": "zstd"})
        sent.append(sent[-1].groupBy("level", "prefix", "part").applyInArrow(together(i), SENT))

    def answer(group: pa.Table) -> pa.Table:
        senders, _, place, edges, total = _summed(group, kinds[steps - 1])
        common.give_back()
        return _told(group.column("level")[0].as_py(), group.column("prefix")[0].as_py(), senders, place, edges, total)

    told = common.written(sent.pop().groupBy("level", "prefix", "part").applyInArrow(answer, TOLD), path if steps == 1 else f"{path}-told{steps}", {"compression": "zstd"})
    distinct = told.where("receiver is null")

    def on(i: int) -> Callable:
        """The totals of a group of senders, from what its own buckets told it."""

        def run(group: pa.Table) -> pa.Table:
            asked = group.filter(pc.is_valid(group.column("keys")))
            back = group.filter(pc.is_null(group.column("keys"))).sort_by("sender")
            senders, _, place, edges, _ = _summed(asked, kinds[i - 1])
            total = np.concatenate([unpack(c.as_py(), np.uint64).reshape(2, -1) for c in back.column("counts")], axis=1)
            return _told(asked.column("level")[0].as_py(), asked.column("prefix")[0].as_py(), senders, place, edges, total).slice(0, len(senders))

        return run

    for i in range(steps - 1, 0, -1):
        back = told.where("receiver is not null")
        # a child's prefix puts what it told in the order of keys
        back = back.select("level", F.shiftright("receiver", 32).alias("prefix"), F.col("receiver").bitwiseAND(F.lit(0xFFFFFFFF)).alias("part"), F.col("prefix").alias("sender"), F.lit(None).cast("binary").alias("keys"), "counts")
        up = sent.pop().unionByName(back).groupBy("level", "prefix", "part").applyInArrow(on(i), TOLD)
        last = i == 1
        told = common.written(up.unionByName(distinct) if last else up, path if last else f"{path}-told{i}", {"compression": "zstd"})
        common.removed(spark, f"{path}-sent{i}")
        if not last:
            continue
        for k in range(2, steps + 1):
            common.removed(spark, f"{path}-told{k}")
    return told


def answered(table: DataFrame, told: DataFrame, use: Callable, schema: str) -> DataFrame:
    """use(row of a block, totals) for every block, totals being for each level the two arrays that totals() found for the block's keys, in the order of its keys. use gives record batches."""
    own = table.withColumn("part", F.lit(-1).cast("long")).withColumn("counts", F.lit(None).cast("binary"))
    back = told.where("receiver is not null").select(F.col("receiver").alias("block"), F.col("prefix").alias("part"), "counts", "level")
    cols = [c for c in table.columns if c != "block"]
    both = own.withColumn("level", F.lit(-1)).unionByName(back, allowMissingColumns=True).select("block", "part", "level", "counts", *cols)

    def run(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["part"])
        levels: dict[int, list] = {}
        for r in rows[1:]:
            levels.setdefault(r["level"], []).append(unpack(r["counts"], np.uint64).reshape(2, -1))
        out = use(rows[0], {level: np.concatenate(parts, axis=1) for level, parts in levels.items()})
        common.give_back()
        return out

    return both.groupBy("block").applyInArrow(run, schema)
