"""Language-model scoring with a hashed maximum-entropy model.

A text is its words (A-Z lower-cased) and one end token.  Every word has a slot: the
end token and the most frequent training words (heads) have their own, all others share
the remaining slots by hash; ``width`` neighbouring slots are a class.  The model is

    P(word | history) = P(class | history) P(slot | class, history) P(word | slot)

with two softmaxes of ``width`` outcomes whose scores sum the weight rows of hashed
features of the history: the word before, the two before (bigram), the second word back
alone (skip) and the third alone (skip).  P(word | slot) is (c + 1) / (sum of c + 1 over the
slot's known words, plus 1 in a shared slot, for unknown words); so the probabilities of
all words, with one unknown word for each shared slot, sum to 1.

Counting covers all training documents: shards send their distinct words with counts,
packed, to word buckets; these answer each shard with the counts of its words.  The
words' counts thus never stand in one place, and each shard holds its own words only.

The model's size follows V, the number of distinct training words (:func:`sizes_for`):
weight rows grow as the cube root of V above 2^20 words, classes and slots of a class as
the sixth root, so all weights grow as the square root of V, from 4.2 MB.  They are
broadcast, so growth ends at ``MOST_BYTES`` (about 4 * 10^9 words).

Training covers all training documents once, in ``ROUNDS`` disjoint parts.  A round's
documents are dealt by hash of (doc_id, text) to training shards of about ``TRAIN_BYTES`` and
sorted there by that hash, so neither files nor their order change what is learned.  Every
shard starts from the broadcast weights, makes row-wise Adagrad steps in sparse numpy
batches and returns its change of the weights; the changes are averaged by tokens, block
by block and in the order of the shards.  A shard's size does not depend on the input, so
neither does what one round learns.  Scoring runs the same batches forward, shard by shard.

The base score is the unigram model with add-one smoothing.  Words are told apart by a
64-bit hash.  Null and empty texts are the end token alone.  A null doc_id is neither
held out nor left out of training.  Repeated rows are learned and scored one by one; equal counts
are ordered by the word's hash.  An empty table gives no rows.  A document of any length is the
smallest unit of a shard.  Other columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .packed import by_target, pack, unpack, unpack_all
from .spans import LOWER, SPACED, Words, column_bytes, mix, pieces
from .store import settle, shard_count

FEATURES = 4
SAFE = 60.0                     # scores within it need no shift before exp
BATCH = 8192                    # tokens of a gradient step
RATE = 0.5
ROUNDS = 3
BLOCKS = 16                     # the weights' change is summed in so many blocks
SHARD_BYTES = 8 << 20
TRAIN_BYTES = 32 << 20          # text of a training shard
MOST_BYTES = 256 << 20          # of all weights

END = np.uint64(0x9E3779B97F4A7C15)     # the end token's key
START = np.uint64(0xD1B54A32D192ED03)   # before the first word


class Sizes(NamedTuple):
    width: int                  # classes, and slots of a class
    class_rows: int             # weight rows; the first ``width`` are biases
    slot_rows: int

    @property
    def slots(self) -> int:
        return self.width * self.width

    @property
    def heads(self) -> int:
        """Words with a slot of their own; slot 0 is the end token."""
        return self.slots * 3 // 4 - 1

    @property
    def tails(self) -> int:
        """Shared slots."""
        return self.slots - self.heads - 1


def sizes_for(words: int) -> Sizes:
    """The model's size for so many distinct training words."""
    most = (MOST_BYTES / (4 * 32 * FEATURES * 256 * 32)) ** (2 / 3)
    grow = min(max(1.0, (words / 2 ** 20) ** (1 / 3)), most)
    width = 8 * int(4 * grow ** 0.5)
    return Sizes(width, width + FEATURES * int(2720 * grow), width + FEATURES * int(5450 * grow))


def tokens(data: np.ndarray, offsets: np.ndarray, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, first token of each document, then the total) of documents i..j."""
    w = Words(data, offsets, i, j, LOWER, SPACED)
    keys = np.insert(w.hashes(), w.first[1:], END)
    return keys, w.first + np.arange(len(w.first))


def slots_of(keys: np.ndarray, heads: np.ndarray, order: np.ndarray, sizes: Sizes) -> np.ndarray:
    """Slot of each key; ``heads``: the head words' keys, sorted, ``order``: their ranks."""
    out = 1 + sizes.heads + (mix(keys ^ np.uint64(77)) % np.uint64(sizes.tails)).astype(np.int64)
    if len(heads):
        at = np.minimum(np.searchsorted(heads, keys), len(heads) - 1)
        out = np.where(heads[at] == keys, 1 + order[at], out)
    return np.where(keys == END, 0, out)


def history(keys: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(FEATURES, tokens) hashes of what stands before each token in its document."""
    n = len(keys)
    place = np.arange(n) - np.repeat(first[:-1], np.diff(first))
    before = np.concatenate([np.full(3, START), keys])
    out = np.empty((FEATURES, n), np.uint64)
    for a in range(0, n, BATCH):            # so much stays in the processor's cache
        b = min(a + BATCH, n)
        one, two, three = (np.where(place[a:b] < d, START, before[3 - d + a:3 - d + b]) for d in (1, 2, 3))
        for row, h in zip(out, (one ^ np.uint64(1), one * START ^ two, two ^ np.uint64(3), three ^ np.uint64(4))):
            row[a:b] = mix(h)
    return out


def counts_of(keys: np.ndarray, word: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The count of each key; ``word``: hashes in order, ``count``: theirs, 0 for others.
    Hashes are spread evenly, so a key's first bits lead to its place within a few steps."""
    bits = len(word).bit_length() + 1
    shift = np.uint64(64 - bits)
    begin = np.searchsorted(word, np.arange(1 << bits, dtype=np.uint64) << shift)
    word, count = np.append(word, np.uint64(2**64 - 1)), np.append(count, 0)
    at = begin[keys >> shift]
    todo = np.flatnonzero(word[at] < keys)
    while len(todo):
        at[todo] += 1
        todo = todo[word[at[todo]] < keys[todo]]
    return np.where(word[at] == keys, count[at], 0)


def _spread(h: np.ndarray, rows: int, width: int) -> np.ndarray:
    """(FEATURES, tokens) hashes -> rows, each feature in a part of width..rows-1 of its
    own; as 16-bit numbers if they suffice (numpy sorts these by radix)."""
    span = (rows - width) // FEATURES
    begin = width + span * np.arange(FEATURES, dtype=np.uint64)[:, None]
    return (begin + (((h >> np.uint64(32)) * np.uint64(span)) >> np.uint64(32))).astype(_row_type(rows))


def _row_type(rows: int) -> type:
    return np.uint16 if rows <= 1 << 16 else np.uint32


def rows_of(hist: np.ndarray, classes: np.ndarray | None, sizes: Sizes) -> np.ndarray:
    """Weight rows (FEATURES + 1, tokens): the bias row, then the features' rows."""
    if classes is None:
        rows = _spread(hist, sizes.class_rows, sizes.width)
        return np.concatenate([np.zeros((1, hist.shape[1]), rows.dtype), rows])
    turned = (hist ^ (classes.astype(np.uint64) * END)) * START
    rows = _spread(turned ^ (turned << np.uint64(29)), sizes.slot_rows, sizes.width)
    return np.concatenate([classes.astype(rows.dtype)[None], rows])


def _scores(weights: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each token's scores, their exponentials and the sums of these."""
    scores = weights.take(rows[0], axis=0)
    more = np.empty_like(scores)
    for r in rows[1:]:
        scores += weights.take(r, axis=0, out=more, mode="clip")    # "raise" would go through a buffer
    if not -SAFE < scores.min() <= scores.max() < SAFE:
        scores -= scores.max(axis=1, keepdims=True)
    e = np.exp(scores)
    return scores, e, np.einsum("ij->i", e)     # no BLAS: its threads would wait for one another


def segment_sums(x: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Sums of the runs of rows of ``x`` that begin at ``cut``; ``x`` is overwritten.
    Each pass adds the second half of every run to its first, so a run of any length
    takes few passes over whole arrays."""
    length = np.diff(np.append(cut, len(x)))
    begin = cut
    while True:
        longer = length > 1
        if not longer.any():
            return x[cut]
        begin, length = begin[longer], length[longer]
        half = length >> 1
        place = np.arange(int(half.sum())) + np.repeat(begin - (np.cumsum(half) - half), half)
        length = length - half
        x[place] += x.take(place + np.repeat(length, half), axis=0)


def _step(weights: np.ndarray, seen: np.ndarray, rows: np.ndarray, target: np.ndarray) -> None:
    """One row-wise Adagrad step on a batch, in place."""
    _, g, total = _scores(weights, rows)
    g *= (-1 / total)[:, None]
    g[np.arange(len(target)), target] += 1
    for r in rows:
        if r[0] == r[-1] and (r == r[0]).all():     # the one bias row of the class model
            total = g.sum(axis=0)
            seen[r[0]] += total @ total
            weights[r[0]] += total * (RATE / np.sqrt(seen[r[0]] + 1))
            continue
        order = np.argsort(r, kind="stable")
        at = r[order]
        cut = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        row = at[cut]
        total = segment_sums(g.take(order, axis=0), cut)
        seen[row] += np.einsum("ij,ij->i", total, total)
        weights[row] += total * (RATE / np.sqrt(seen[row] + 1))[:, None]


def log_probability(weights: tuple[np.ndarray, np.ndarray], slot: np.ndarray, hist: np.ndarray, sizes: Sizes) -> np.ndarray:
    """Natural log of P(class) P(slot | class) of each token."""
    out = np.zeros(len(slot))
    for a in range(0, len(slot), BATCH):
        s, h = slot[a:a + BATCH], hist[:, a:a + BATCH]
        c = s // sizes.width
        k = np.arange(len(s))
        for w, rows, target in ((weights[0], rows_of(h, None, sizes), c), (weights[1], rows_of(h, c, sizes), s % sizes.width)):
            scores, _, total = _scores(w, rows)
            out[a:a + BATCH] += scores[k, target] - np.log(total)
    return out


_CELLS = pa.schema([("kind", pa.int32()), ("target", pa.int32()), ("shard", pa.int32()), ("word", pa.int64()), ("n", pa.int64()), ("cell", pa.binary())])
_CELL_TYPE = "kind int, target int, shard int, word long, n long, cell binary"


def _cells(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows)) if rows else [()] * len(_CELLS)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _CELLS)], schema=_CELLS)


def _send_counts(targets: int):
    """Each distinct word of a shard, with its count in training documents."""
    def run(table: pa.Table) -> pa.Table:
        data, offsets = column_bytes(table["text"])
        learn = table["learn"].to_numpy()
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for i, j in pieces(offsets):
            k, first = tokens(data, offsets, i, j)
            k, inv = np.unique(k, return_inverse=True)
            n = np.bincount(inv, weights=np.repeat(learn[i:j], np.diff(first)), minlength=len(k)).astype(np.int64)
            keys, inv = np.unique(np.concatenate([keys, k]), return_inverse=True)
            counts = np.bincount(inv, weights=np.concatenate([counts, n]), minlength=len(keys)).astype(np.int64)
        shard = table["shard"][0].as_py()
        return _cells([(0, t, shard, None, None, pack(*x)) for t, x in by_target((mix(keys) % np.uint64(targets)).astype(np.int64), keys, counts)])
    return run


WORDS, TOTAL, REPLY = 1, 2, 3


def _answer(table: pa.Table) -> pa.Table:
    """A bucket's totals and known words, and for each shard the counts of its words."""
    (keys, counts), row = unpack_all(table["cell"])
    shard = table["shard"].to_numpy()[row]
    word, inv = np.unique(keys, return_inverse=True)
    c = np.bincount(inv, weights=counts, minlength=len(word)).astype(np.int64)
    known = c > 0
    plain = known & (word != END)
    out = [(TOTAL, None, None, int(known.sum()), int(c.sum()), None), (WORDS, None, None, None, None, pack(word[plain], c[plain]))]
    again = known[inv]
    out += [(REPLY, None, s, None, None, pack(k, n)) for s, (k, n) in by_target(shard[again], keys[again], c[inv][again])]
    return _cells(out)


def _heads_of(sizes: Sizes):
    """The most frequent words of each bucket: (word, n)."""
    def run(batches):
        for batch in batches:
            for cell in batch.column("cell").to_pylist():
                word, n = unpack(cell)
                best = np.lexsort((word, -n))[:sizes.heads]
                yield pa.RecordBatch.from_arrays([pa.array(word[best].view(np.int64)), pa.array(n[best])], names=["word", "n"])
    return run


def _shared_of(sizes: Sizes):
    """For each shared slot, the sum of c + 1 of a bucket's words: (word: the slot, n)."""
    def run(batches):
        for batch in batches:
            sums = np.zeros(sizes.slots, np.int64)
            for cell in batch.column("cell").to_pylist():
                word, n = unpack(cell)
                np.add.at(sums, slots_of(word, np.zeros(0, np.uint64), np.zeros(0, np.int64), sizes), n + 1)
            slot = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(sums[slot])], names=["word", "n"])
    return run


def _train(source):
    def run(batches):
        weights, heads, order, sizes = source.value
        now = [w.copy() for w in weights]
        seen = [np.zeros(len(w), np.float32) for w in weights]
        n, shard = 0, None
        for batch in batches:
            shard = batch.column("part")[0].as_py() if len(batch) else shard
            data, offsets = column_bytes(batch.column("text"))
            for i, j in pieces(offsets):
                keys, first = tokens(data, offsets, i, j)
                slot, hist = slots_of(keys, heads, order, sizes), history(keys, first)
                for a in range(0, len(slot), BATCH):
                    s, h = slot[a:a + BATCH], hist[:, a:a + BATCH]
                    c = s // sizes.width
                    _step(now[0], seen[0], rows_of(h, None, sizes), c)
                    _step(now[1], seen[1], rows_of(h, c, sizes), s % sizes.width)
                n += len(slot)
        if n:
            change = np.concatenate([b - a for a, b in zip(weights, now)])
            size = -(-len(change) // BLOCKS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(BLOCKS), pa.int32()), pa.array([shard] * BLOCKS, pa.int32()), pa.array([n] * BLOCKS, pa.int64()),
                 pa.array([(change[b * size:(b + 1) * size] * n).astype(np.float32).tobytes() for b in range(BLOCKS)], pa.binary())],
                names=["block", "part", "n", "change"])
    return run


def _sum_changes(batches):
    """Sums the changes of each block, as a stream."""
    total: dict[int, tuple[int, np.ndarray]] = {}
    for batch in batches:
        for b, n, cell in zip(*(batch.column(c).to_pylist() for c in ("block", "n", "change"))):
            x = np.frombuffer(cell, np.float32).astype(np.float64)
            m, y = total.get(b, (0, 0.0))
            total[b] = (m + n, y + x)
    if total:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([m for m, _ in total.values()], pa.int64()),
             pa.array([y.astype(np.float32).tobytes() for _, y in total.values()], pa.binary())], names=["block", "n", "change"])


def _score(source):
    def run(docs: pa.Table, replies: pa.Table) -> pa.Table:
        weights, heads, order, inside, n_all, v_all, sizes = source.value
        out = {c: [] for c in ("n_tokens", "n_known", "base_score", "score")}
        if len(docs):
            word, count = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            if len(replies):
                (word, count), _ = unpack_all(replies["cell"])
                o = np.argsort(word)
                word, count = word[o], count[o]
            data, offsets = column_bytes(docs["text"])
            for i, j in pieces(offsets):
                keys, first = tokens(data, offsets, i, j)
                c = counts_of(keys, word, count).astype(float)
                slot = slots_of(keys, heads, order, sizes)
                own = slot <= sizes.heads
                within = np.where(own, 0.0, np.log(c + 1) - np.log(inside[slot]))
                p = (log_probability(weights, slot, history(keys, first), sizes) + within) / np.log(10)
                base = np.log10((c + 1) / (n_all + (v_all + 1)))
                cut = first[:-1]
                out["n_tokens"].append(np.diff(first))
                out["n_known"].append(np.add.reduceat((c > 0).astype(np.int64), cut))
                out["base_score"].append(np.add.reduceat(base, cut))
                out["score"].append(np.add.reduceat(p, cut))
        cat = lambda c, kind: pa.array(np.concatenate(out[c]) if out[c] else [], kind)
        return pa.table({"doc_id": docs["doc_id"], "held_out": docs["held_out"], "n_tokens": cat("n_tokens", pa.int64()),
                         "n_known": cat("n_known", pa.int64()), "base_score": cat("base_score", pa.float64()), "score": cat("score", pa.float64())})
    return run


def start_weights(slot_counts: np.ndarray, sizes: Sizes) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the model without history: the log frequencies as biases."""
    c = (slot_counts + 0.5).reshape(sizes.width, sizes.width)
    classes, slots = (np.zeros((n, sizes.width), np.float32) for n in (sizes.class_rows, sizes.slot_rows))
    classes[0] = np.log(c.sum(axis=1) / c.sum())
    slots[:sizes.width] = np.log(c / c.sum(axis=1, keepdims=True))
    return classes, slots


def score(docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text", train_bytes: int = TRAIN_BYTES) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row;
    rows with ``held_out`` (over the input's columns) are not learned from."""
    spark = docs.sparkSession
    shards = shard_count(docs, text, SHARD_BYTES)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"),
                       F.col(text).cast("string").alias("text"))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int")).repartition(shards, "shard")
    counted = settle(dealt.select("text", "shard", (~F.col("held_out")).cast("long").alias("learn"))
                     .groupBy("shard").applyInArrow(_send_counts(shards), _CELL_TYPE)
                     .groupBy("target").applyInArrow(_answer, _CELL_TYPE))

    totals = counted.filter(F.col("kind") == TOTAL).agg(F.sum("word").alias("v"), F.sum("n").alias("n")).first()
    v_all, n_all = int(totals["v"] or 0), int(totals["n"] or 0)
    sizes = sizes_for(v_all)
    words = counted.filter(F.col("kind") == WORDS).select("cell")
    best = words.mapInArrow(_heads_of(sizes), "word long, n long").orderBy(F.desc("n"), "word").limit(sizes.heads).collect()
    heads = np.array([r["word"] for r in best], np.int64).view(np.uint64)
    counts = np.array([r["n"] for r in best], np.int64)
    shared = np.zeros(sizes.slots, np.int64)
    for r in words.mapInArrow(_shared_of(sizes), "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect():
        shared[r["word"]] = r["n"]
    # Head words leave the shared slot that their hash names.
    np.subtract.at(shared, slots_of(heads, np.zeros(0, np.uint64), np.zeros(0, np.int64), sizes), counts + 1)
    slot_counts = shared.astype(float)
    slot_counts[1:1 + len(heads)] = counts
    slot_counts[0] = max(0, n_all - counts.sum() - shared.sum() + (v_all - len(heads) - 1))
    order = np.argsort(heads)
    heads_sorted = heads[order]
    weights = start_weights(slot_counts, sizes)

    parts = max(1, -(-shards * SHARD_BYTES // (ROUNDS * train_bytes)))
    learned = rows.filter(~F.col("held_out")).withColumn("h", F.xxhash64("doc_id", "text", F.lit(3)))
    for r in range(ROUNDS):
        source = spark.sparkContext.broadcast((weights, heads_sorted, order, sizes))
        part = learned.filter(F.pmod("h", F.lit(ROUNDS)) == r) \
            .withColumn("part", F.pmod(F.xxhash64("h"), F.lit(parts)).cast("int")) \
            .repartitionById(parts, "part").sortWithinPartitions("h", "doc_id").select("part", "text")
        kind = "block int, part int, n long, change binary"
        got = part.mapInArrow(_train(source), kind).repartitionById(BLOCKS, "block").sortWithinPartitions("block", "part") \
            .mapInArrow(_sum_changes, "block int, n long, change binary").collect()     # as large as the weights
        if got:
            blocks = {g["block"]: np.frombuffer(g["change"], np.float32) / g["n"] for g in got}
            change = np.concatenate([blocks[b] for b in sorted(blocks)]).reshape(-1, sizes.width)
            weights = (weights[0] + change[:sizes.class_rows], weights[1] + change[sizes.class_rows:])
        source.unpersist()
    source = spark.sparkContext.broadcast((weights, heads_sorted, order, shared.astype(float) + 1, n_all, v_all, sizes))
    replies = counted.filter(F.col("kind") == REPLY).select("shard", "cell")
    out = dealt.groupBy("shard").cogroup(replies.groupBy("shard")).applyInArrow(
        _score(source), "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return out.withColumn("train_tokens", F.lit(n_all).cast("long"))
