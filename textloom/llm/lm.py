"""Language-model scores by deleted interpolation of word pairs.

P(w | v) = a2 c(v, w) / c(v) + a1 c(w) / N + a0 / (V + 1)

with the weights of the bucket that the context's frequency c(v) falls in.
The weights are learned by expectation-maximisation: a tenth of the training
documents is deleted from the counts, and its words are what the weights must
predict. The final counts are of all training documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common, tokens

START, END = np.uint64(0x51A7C0DE00000001), np.uint64(0x51A7C0DE00000002)
#: One training document in so many is held out for the weights.
DELETED = 10
#: Buckets of context frequency: 0, 1, 2-3, 4-7, ...
BUCKETS = 40
#: Steps in a factor of two by which the parts of a word's probability are told apart when weights are learned.
STEPS = 4
HELD_OUT, TRAIN, DELETED_FLAG = 0, 1, 2


def _streams(row: dict):
    """A block's documents as token and context hashes (the end counted as a token, a start before the first), and where each begins."""
    ids, flags, first, distinct, index = tokens.read_block(row)
    n = np.diff(first)
    begin = first + np.arange(len(first))
    token = np.full(int(begin[-1]), END, np.uint64)
    inner = np.ones(len(token), bool)
    inner[begin[1:] - 1] = False
    token[inner] = distinct[index]
    context = np.empty_like(token)
    context[1:] = token[:-1]
    context[begin[:-1]] = START
    return ids, flags, begin, token, context, np.repeat(flags, n + 1)


def _keys(row: dict):
    """Level 0: words, the end, and the start (as a context); level 1: pairs. For each, the sorted keys and where each token's is."""
    ids, flags, begin, token, context, flag = _streams(row)
    one, at = np.unique(np.concatenate([token, [START]]), return_inverse=True)
    start = at[-1]
    at = at[:-1]
    before = np.empty_like(at)
    before[1:] = at[:-1]
    before[begin[:-1]] = start
    pair = common.mix(token + common.mix(context ^ np.uint64(0x6A09E667F3BCC909)))
    two, at_two = np.unique(pair, return_inverse=True)
    return ids, flags, begin, flag, (one, at, before, start), (two, at_two)


def _ask(row: dict):
    ids, flags, begin, flag, (one, at, _, start), (two, at_two) = _keys(row)
    kept, deleted = flag == TRAIN, flag == DELETED_FLAG
    words = [np.bincount(at, x, len(one)) for x in (kept, deleted)]
    for w, f in zip(words, (TRAIN, DELETED_FLAG), strict=True):
        w[start] = (flags == f).sum()
    return [(one, *words), (two, *[np.bincount(at_two, x, len(two)) for x in (kept, deleted)])]


def _bucket(context: np.ndarray) -> np.ndarray:
    return np.minimum(BUCKETS - 1, np.frexp(context.astype(np.float64))[1])


def _parts(row: dict, told: dict, kept_only: bool, n_tokens: int, vocabulary: int):
    """For each token of a block: its context's bucket and the three probabilities."""
    ids, flags, begin, flag, (one, at, before, _), (_, at_two) = _keys(row)
    own, pairs = (t[0] if kept_only else t.sum(0) for t in (told[0], told[1]))
    word, context, pair = own[at].astype(np.float64), own[before].astype(np.float64), pairs[at_two].astype(np.float64)
    return ids, flags, begin, flag, word, _bucket(context), pair / np.maximum(context, 1), word / max(1, n_tokens), 1 / (vocabulary + 1)


def learn_weights(cells: list[tuple[int, int, int, float]], rounds: int = 40) -> np.ndarray:
    """Weights (pair, word, any) of each bucket by expectation-maximisation. cells: (bucket, pair step, word step, weight), steps being STEPS times the binary logarithm of that part's probability over 1 / (V + 1), or -10000 for none. Buckets without cells get those of the nearest lower one."""
    out = np.tile([0.0, 0.9, 0.1], (BUCKETS, 1))
    by: dict[int, list] = {}
    for b, p, w, n in cells:
        by.setdefault(b, []).append((p, w, n))
    for b in range(BUCKETS):
        if b not in by:
            out[b] = out[b - 1] if b else out[b]
            continue
        p, w, n = np.array(by[b], np.float64).T
        part = np.stack([np.where(p <= -10000, 0, np.exp2(p / STEPS)), np.where(w <= -10000, 0, np.exp2(w / STEPS)), np.ones(len(p))], 1)
        a = np.array([1 / 3, 1 / 3, 1 / 3]) if b else np.array([0, 0.5, 0.5])
        for _ in range(rounds):
            share = part * a
            share /= share.sum(1, keepdims=True)
            a = (n[:, None] * share).sum(0) / n.sum()
            a = np.maximum(a, [1e-9 if b else 0, 1e-9, 1e-9])
            a /= a.sum()
        out[b] = a
    return out


SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


@dataclass
class Learned:
    """The blocks of all documents, the totals of their words and pairs, the number of training tokens, of different ones, and the weights of each bucket."""

    table: DataFrame
    told: DataFrame
    tokens: int
    vocabulary: int
    weights: np.ndarray


def learn(docs: DataFrame, held_out: Column, folder: str) -> Learned:
    """Counts and weights from all documents that are not held out, in tables below folder."""
    rows = common.texts(docs).withColumn("held", held_out)
    deleted = F.pmod(F.xxhash64(F.lit("deleted"), "doc_id"), F.lit(DELETED)) == 0
    flag = F.when(F.col("held"), HELD_OUT).when(deleted, DELETED_FLAG).otherwise(TRAIN)
    table = tokens.blocks(rows.withColumn("flag", flag).withColumn("kind", (flag == DELETED_FLAG).cast("int")), f"{folder}/blocks")

    def count(batches):
        for b in batches:
            out = [[0, 0, 0]]
            for row in b.to_pylist():
                flags, words = tokens.unpack(row["flags"], np.int8), tokens.unpack(row["words"], np.uint32).astype(np.int64) + 1
                out[0] = [out[0][0] + int(words[flags == TRAIN].sum()), out[0][1] + int(words[flags == DELETED_FLAG].sum()), out[0][2] + int(words.sum())]
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in out[0]], ["a", "b", "c"])

    sums = table.select("flags", "words").mapInArrow(common.tidy(count), "a long, b long, c long").agg(F.sum("a"), F.sum("b"), F.sum("c")).first()
    kept, held, every = (int(x or 0) for x in sums)
    told = tokens.totals(table, _ask, [every // 4, every], f"{folder}/totals")
    # the start is counted as a context only
    vocabulary = int(told.where("level = 0").agg(F.sum("distinct")).first()[0] or 0) - (1 if kept + held else 0)
    n = kept + held

    def cells(row: dict, answer: dict) -> pa.Table:
        *_, bucket, pair, one, rest = _parts(row, answer, True, kept, vocabulary)
        step = lambda x: np.where(x > 0, np.round(STEPS * np.log2(np.maximum(x, 1e-300) / rest)), -10000).astype(np.int64)
        code, count = np.unique((bucket.astype(np.int64) << 40) + ((step(pair) + 20000) << 20) + step(one) + 20000, return_counts=True)
        return pa.table({"code": code, "n": count.astype(np.int64)})

    got = tokens.answered(table.where("kind = 1"), told.join(table.where("kind = 1").select(F.col("block").alias("receiver")), "receiver", "left_semi"), cells, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).collect()
    return Learned(table, told, n, vocabulary, learn_weights([(c >> 40, (c >> 20 & 0xFFFFF) - 20000, (c & 0xFFFFF) - 20000, k) for c, k in got]))


def score(docs: DataFrame, held_out: Column) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens (words and an end), n_known, train_tokens, base_score (add-one words) and score, as log10 probabilities.

    Counts are of all documents that are not held out. A null or empty text is
    its end alone; a very long text is in one block, in memory whole as hashes
    of its words. Repeated rows each count and each give a row; an empty
    table gives an empty result; a null id comes back as null; other columns
    are not looked at. Without training documents every token has probability
    1 / (V + 1) = 1.
    """
    spark = docs.sparkSession
    folder = common.shared_folder(spark)
    m = learn(docs, held_out, folder)
    n, vocabulary, weights = m.tokens, m.vocabulary, m.weights

    def scores(row: dict, answer: dict) -> pa.Table:
        ids, flags, begin, flag, word, bucket, pair, one, rest = _parts(row, answer, False, n, vocabulary)
        p = weights[bucket, 0] * pair + weights[bucket, 1] * one + weights[bucket, 2] * rest if n else np.full(len(word), rest)
        add = lambda x: np.add.reduceat(x, begin[:-1]) if len(ids) else np.zeros(0)
        return pa.table({
            "doc_id": pa.array(ids, mask=ids == -(1 << 63)), "held_out": flags == HELD_OUT, "n_tokens": np.diff(begin), "n_known": add((word > 0).astype(np.int64)), "train_tokens": np.full(len(ids), n),
            "base_score": add(np.log10((word + 1) / (n + vocabulary + 1))), "score": add(np.log10(p)),
        })

    out = common.written(tokens.answered(m.table, m.told, scores, SCHEMA), f"{folder}-scores")
    common.removed(spark, folder)
    return out
