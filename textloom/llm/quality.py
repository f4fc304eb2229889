"""Quality scores by attention over passages.

A document is a bag of passages, of which only the whole has a label. Each
passage is encoded from its byte classes; gated attention (a tanh unit times a
sigmoid unit) weighs the passages, and the weighted sum of their encodings is
scored. Encoder, gates and scorer are learned together from document labels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: Bounds of the sample that is learned from: labelled documents, the bytes of their texts, and of one text.
TRAIN_DOCS, TRAIN_BYTES, TRAIN_LONGEST = 3000, 12 << 20, 1 << 20
#: Bytes of a long text whose passages are looked at together.
SECTION = 1 << 20
#: Words of a passage.
PASSAGE = 48
#: Documents with this score or more are kept.
KEEP = 0.7

_CLASS = np.zeros(256, np.int64)
for _i, _members in enumerate([b"aeiou", b"bcdfghjklmnpqrstvwxyz", b"AEIOU", b"BCDFGHJKLMNPQRSTVWXYZ", b"0123456789", b" ", b"\n\r\t\x0b\x0c", b".", b",;:", b"!?", b"|", b"#$%&*+=<>^~\\@`", b"\"'()[]{}-_/", bytes(range(0x80, 0x100))], 1):
    _CLASS[list(_members)] = _i
CLASSES = 15
FEATURES = CLASSES * CLASSES + CLASSES + 4


def passages(buf: np.ndarray, off: np.ndarray, words: int = PASSAGE) -> tuple[np.ndarray, np.ndarray]:
    """Features of the passages of all texts, and the index of each text's first passage (one more entry than texts). Every text has a passage; every byte of a text belongs to one."""
    starts, ends, first = common.word_spans(buf, off)
    n_words = np.diff(first)
    n = np.maximum(1, -(-n_words // words))
    begin = np.concatenate([[0], np.cumsum(n)])
    total = int(begin[-1])
    doc = np.repeat(np.arange(len(n)), n)
    nth = np.arange(total) - begin[doc]
    cut = off[doc].copy()
    inner = nth > 0
    cut[inner] = starts[first[doc[inner]] + nth[inner] * words]
    size = np.diff(np.concatenate([cut, [len(buf)]]))
    of = np.repeat(np.arange(total), size)
    c = _CLASS[buf]
    one = np.bincount(of * CLASSES + c, minlength=total * CLASSES).reshape(total, CLASSES)
    prev = np.concatenate([[0], c[:-1]])
    prev[cut[size > 0]] = 0
    two = np.bincount(of * CLASSES**2 + prev * CLASSES + c, minlength=total * CLASSES**2).reshape(total, -1)
    scale = np.maximum(size, 1)[:, None]
    h = common.span_hashes(common.lower(buf), starts, ends)
    piece = np.searchsorted(cut, starts, "right") - 1
    if len(piece):
        # an empty passage shares its cut with the next one: words belong to the one that has bytes
        known, where = np.unique(h ^ (common.mix(piece.astype(np.uint64) + np.uint64(1))), return_index=True)
        distinct = np.bincount(piece[where], minlength=total)
        count = np.bincount(piece, minlength=total)
        length = np.bincount(piece, ends - starts, minlength=total)
    else:
        distinct = count = length = np.zeros(total)
    extra = np.stack([np.log1p(size) / 8, np.log1p(count) / 4, distinct / np.maximum(count, 1), length / np.maximum(count, 1) / 16], 1)
    return np.concatenate([np.sqrt(two / scale), np.sqrt(one / scale), extra], 1).astype(np.float32), begin


def sections(buf: np.ndarray, words: int = PASSAGE, limit: int = SECTION) -> Iterator[np.ndarray]:
    """One text's bytes in sections of about limit bytes, each a number of whole passages; stretches without so many words stay whole."""
    at, size = 0, limit
    while at + size < len(buf):
        starts = common.word_spans(buf[at : at + size], np.array([0, size]))[0]
        whole = max(0, len(starts) - 1) // words * words
        if whole:
            yield buf[at : at + starts[whole]]
            at, size = at + int(starts[whole]), limit
        else:
            size *= 2
    yield buf[at:]


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    p: dict[str, np.ndarray]
    prior: float = 0.5

    def hidden(self, x: np.ndarray):
        p = self.p
        z = (x - self.mean) * self.scale
        h = np.tanh(z @ p["enc"] + p["enc0"])
        v, u = np.tanh(h @ p["tanh"]), 1 / (1 + np.exp(-np.clip(h @ p["gate"], -30, 30)))
        return z, h, v, u, (v * u) @ p["att"]

    def encode(self, x: np.ndarray, begin: np.ndarray):
        z, h, v, u, e = self.hidden(x)
        return z, h, v, u, *self.pooled(h, e, begin)

    def pooled(self, h: np.ndarray, e: np.ndarray, begin: np.ndarray):
        p, n = self.p, np.diff(begin)
        top = np.maximum.reduceat(e, begin[:-1])
        w = np.exp(e - np.repeat(top, n))
        a = w / np.repeat(np.add.reduceat(w, begin[:-1]), n)
        pooled = np.add.reduceat(a[:, None] * h, begin[:-1], axis=0)
        return a, pooled, pooled @ p["out"] + p["out0"]

    def score(self, x: np.ndarray, begin: np.ndarray) -> np.ndarray:
        if not self.p:
            return np.full(len(begin) - 1, self.prior)
        return _share(self.encode(x, begin)[-1])

    def of_texts(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        """The scores of texts, given by their bytes and where each begins (one more entry). Of one long text, only the passages' encodings are in memory together."""
        if len(off) != 2 or len(buf) <= SECTION or not self.p:
            return self.score(*passages(buf, off))
        parts = [self.hidden(passages(x, np.array([0, len(x)]))[0])[1::3] for x in sections(buf)]
        h, e = (np.concatenate(x) for x in zip(*parts, strict=True))
        return _share(self.pooled(h, e, np.array([0, len(e)]))[-1])


def _share(out: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(out, -60, 60).astype(np.float64)))


def fit(x: np.ndarray, begin: np.ndarray, label: np.ndarray, hidden: int = 24, gates: int = 12, epochs: int = 60, seed: int = 7) -> Model:
    """Weights learned by Adam on the mean log loss, with a small pull to zero; both labels weigh as they occur. With one label only, the model is that label's share."""
    if not len(label) or label.min() == label.max():
        return Model(np.zeros(FEATURES), np.ones(FEATURES), {}, float(label.mean()) if len(label) else 0.5)
    rng = np.random.default_rng(seed)
    m = Model(x.mean(0, dtype=np.float32), 1 / (x.std(0, dtype=np.float32) + np.float32(0.05)), {})
    d = x.shape[1]
    m.p = {"enc": rng.normal(0, d**-0.5, (d, hidden)), "enc0": np.zeros(hidden), "tanh": rng.normal(0, hidden**-0.5, (hidden, gates)), "gate": rng.normal(0, hidden**-0.5, (hidden, gates)), "att": rng.normal(0, 0.3, gates), "out": rng.normal(0, hidden**-0.5, hidden), "out0": np.zeros(1)}
    m.p = {k: v.astype(np.float32) for k, v in m.p.items()}
    first, second, t = {k: 0 for k in m.p}, {k: 0 for k in m.p}, 0
    for epoch in range(epochs):
        order = rng.permutation(len(label))
        for part in np.array_split(order, max(1, len(order) // 128)):
            n = np.diff(begin)[part]
            rows = common.ragged(begin[part], n)
            at = np.concatenate([[0], np.cumsum(n)])
            z, h, v, u, a, pooled, out = m.encode(x[rows].astype(np.float32), at)
            g = (1 / (1 + np.exp(-np.clip(out, -30, 30))) - label[part]).astype(np.float32) / len(part)
            p = m.p
            gp = g[:, None] * p["out"]
            gp_rows = np.repeat(gp, n, axis=0)
            ga = (gp_rows * h).sum(1)
            ge = a * (ga - np.repeat(np.add.reduceat(a * ga, at[:-1]), n))
            gvu = ge[:, None] * p["att"]
            gv, gu = gvu * u * (1 - v * v), gvu * v * u * (1 - u)
            gh = (a[:, None] * gp_rows + gv @ p["tanh"].T + gu @ p["gate"].T) * (1 - h * h)
            grads = {"enc": z.T @ gh, "enc0": gh.sum(0), "tanh": h.T @ gv, "gate": h.T @ gu, "att": (v * u).T @ ge, "out": pooled.T @ g, "out0": g.sum(keepdims=True)}
            t += 1
            rate = 0.01 * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
            for k, gr in grads.items():
                gr = gr + 1e-4 * p[k]
                first[k] = 0.9 * first[k] + 0.1 * gr
                second[k] = 0.999 * second[k] + 0.001 * gr * gr
                p[k] -= (rate * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return m


def learn(docs: DataFrame, labels: DataFrame, among=None, max_docs: int = TRAIN_DOCS, max_bytes: int = TRAIN_BYTES) -> Model:
    """A model from labels (doc_id, quality) and the texts of docs.

    The sample: labelled documents in the order of a hash of their id, at most
    max_docs, and of those, but for texts longer than TRAIN_LONGEST, whole
    texts in that order until max_bytes are full. ``among`` is a condition on
    doc_id. Null labels or ids are left out, null texts count as empty, of
    repeated ids each row counts, ties are broken by the id, and an empty
    table gives a model that scores all texts alike.
    """
    common.ready(docs.sparkSession)
    lab = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    lab = (lab if among is None else lab.where(among)).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    drawn = {r["doc_id"]: r["quality"] for r in lab.orderBy(F.xxhash64(F.lit("quality"), "doc_id"), "doc_id").limit(max_docs).collect()}
    if not drawn:
        return fit(np.zeros((0, FEATURES)), np.zeros(1, np.int64), np.zeros(0))
    own = common.texts(docs).where(F.col("doc_id").isin(list(drawn)))
    sizes = own.select("doc_id", F.octet_length("text").alias("n")).orderBy(F.xxhash64(F.lit("quality"), "doc_id"), "doc_id").limit(max_docs).collect()
    fits, room = [], max_bytes
    for r in sizes:
        if r["n"] > TRAIN_LONGEST:
            continue
        room -= r["n"]
        if room < 0:
            break
        fits.append(r["doc_id"])
    if not fits:
        return fit(np.zeros((0, FEATURES)), np.zeros(1, np.int64), np.zeros(0))
    got = own.where(F.col("doc_id").isin(fits)).orderBy(F.xxhash64(F.lit("quality"), "doc_id"), "doc_id").limit(max_docs).toArrow()
    ids, parts, begin = got.column("doc_id").to_pylist(), [], [0]
    for b in common.slices(got.select(["text"]).to_batches(), limit=256 << 10):  # bounds what the driver holds beside the features
        x, at = passages(*common.utf8(b.column("text")))
        begin.extend((at[1:] + begin[-1]).tolist())
        parts.append(x.astype(np.float16))  # shares of one: three digits are enough to learn from
    del got
    model = fit(np.concatenate(parts), np.array(begin), np.array([float(drawn[i] > 0) for i in ids]))
    del parts
    common.give_back(0)
    return model


def score(docs: DataFrame, model: Model, keep: float = KEEP) -> DataFrame:
    """docs with ``score`` (0 to 1) and ``predicted`` (1 at keep or more) after its columns, which are passed on as they are; a column named score or predicted before gives way.

    Every passage of every text is encoded. Null and empty texts are one empty
    passage. A very long text goes through in sections; what is kept of each
    passage is its encoding. Repeated rows each get their score; an empty table
    gives an empty result. Map-only.
    """
    common.ready(docs.sparkSession)
    d = docs.drop("score", "predicted")
    schema = T.StructType([*d.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices((b.append_column("_text", b.column("text").fill_null("")) for b in batches), None, 1 << 20):
            s = model.of_texts(*common.utf8(b.column(b.num_columns - 1)))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(s), pa.array((s >= keep).astype(np.int32))], [*b.schema.names[:-1], "score", "predicted"])

    return d.mapInArrow(common.tidy(run), schema)
