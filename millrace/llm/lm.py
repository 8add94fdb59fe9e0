"""Operator 2: scores of a hashed maximum-entropy language model with a class-factored softmax.

A text is its words, lower-cased A-Z, and one end token. The model gives log10 p(class | context) + log10 p(word | class).

* Classes come from the corpus: words fall into buckets by their last letters, buckets into classes by
  the contexts they are seen in (k-means on the counts of all training tokens). The end is a class of its own.
* p(class | context) is a softmax over hashed features of the words before: the last one, the last two, the last but
  one (skip) and the bucket pair. Weights are a table of fixed size, trained in rounds: every task runs
  gradient updates over its share of the training documents, and the mean of the tasks' weights by tokens starts the
  next round.
* p(word | class) = (c + 1) / (N_class + V_class + 1) from the counts of all training tokens, so unknown words share one.

Words are met by 64-bit hashes. Counts of the ``HOT`` most frequent go to all tasks; the rest, an open number, meet
their texts in a shuffle join, grouped by text first. The base score uses the same counts.

Defined cases: null text is empty and scores its end token; repeated rows each get their score; a null id counts as
training; without training rows all counts are zero and so is N; other columns are left aside; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrays import LOWER, mixed, pieces, text_bytes, word_hashes, words
from millrace.llm.common import Shared, written

HOT = 131_072
BUCKETS = 1024
CONTEXTS = 64
CLASSES = 16  # the last one is the end
ROWS = 1 << 16
FEATURES = 4
#: Slices of the training documents; a round of training reads one, so as many rounds read all.
SHARE = 8
ROUNDS = SHARE
BATCH = 4096
#: Rows of the weight table whose steps travel together.
CHUNK = 1024
#: Groups of tasks whose steps are added up before all of a chunk are.
FAN = 4
END = np.int64(0x7E0D)

_LETTER = np.zeros(256, bool)
for _low, _high in ((65, 91), (97, 123), (128, 256)):
    _LETTER[_low:_high] = True


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 2, F.lit(False))


class Tokens:
    """Tokens of a piece of texts, ends included: hash, bucket, and the number of the first token of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        data = LOWER[data]
        starts, ends, first = words(data, offsets)
        n = len(offsets) - 1
        of_end = first[1:] + np.arange(n)  # where the ends stand
        total = len(starts) + n
        real = np.ones(total, bool)
        real[of_end] = False
        self.hash = np.full(total, END, np.int64)
        self.bucket = np.full(total, BUCKETS, np.int64)
        if len(starts):
            self.hash[real] = word_hashes(data, starts, ends).view(np.int64)
            letter = _LETTER[data]
            last = np.maximum.accumulate(np.where(letter, np.arange(len(data)), -1))[ends - 1]
            plain = last >= starts
            one = np.where(plain, data[last], data[starts]).astype(np.uint64)
            two = np.where(plain & (last - 1 >= starts), data[np.maximum(last - 1, 0)], 0).astype(np.uint64)
            code = (one << np.uint64(9)) | (two << np.uint64(1)) | plain.astype(np.uint64)
            self.bucket[real] = (mixed(code) % np.uint64(BUCKETS)).astype(np.int64)
        self.first = first + np.arange(n + 1)
        self.text = np.repeat(np.arange(n), np.diff(self.first))

    def features(self) -> np.ndarray:
        """Rows of the weight table for each token, from the words before it in its text."""
        h, b = self.hash.view(np.uint64), self.bucket.astype(np.uint64)
        place = np.arange(len(h)) - self.first[:-1][self.text]

        def before(values: np.ndarray, k: int) -> np.ndarray:
            out = np.zeros(len(values), np.uint64)
            out[k:] = values[:-k] if k < len(values) else out[k:]
            out[place < k] = k
            return out

        h1, h2, b1, b2 = before(h, 1), before(h, 2), before(b + np.uint64(7), 1), before(b + np.uint64(7), 2)
        keys = (h1, h2 * np.uint64(3) + h1, h2, b1 * np.uint64(5003) + b2)
        return np.stack([(mixed(k + np.uint64(97 * (i + 1))) >> np.uint64(48)).astype(np.int64) for i, k in enumerate(keys)], axis=1)


def _tokens(batch: pa.RecordBatch) -> Iterator[tuple[int, int, Tokens]]:
    data, offsets = text_bytes(batch.column("text"))
    for low, high in pieces(offsets):
        yield low, high, Tokens(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])


def count(training: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Counts of all training tokens: (h, bucket, c), and (bucket, context, n), written once."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(parts):
            h = np.concatenate([p[0] for p in parts])
            order = np.argsort(h)
            h, n, b = h[order], np.concatenate([p[1] for p in parts])[order], np.concatenate([p[2] for p in parts])[order]
            at = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            return h[at], np.add.reduceat(n, at), b[at]

        grid, parts, waiting = np.zeros((BUCKETS + 1) * CONTEXTS, np.int64), [], 0
        for batch in batches:
            for _, _, tokens in _tokens(batch):
                h, at, n = np.unique(tokens.hash, return_index=True, return_counts=True)
                parts.append((h, n, tokens.bucket[at]))
                waiting += len(h)
                context = (mixed(tokens.bucket.astype(np.uint64)) % np.uint64(CONTEXTS)).astype(np.int64)
                same = tokens.text[1:] == tokens.text[:-1]
                cells = (tokens.bucket[1:] * CONTEXTS + context[:-1])[same]
                grid += np.bincount(cells, minlength=len(grid))
                if waiting > 1_500_000:
                    parts = [flush(parts)]
                    waiting = len(parts[0][0])
                    if waiting > 1_000_000:
                        yield _counted(*parts[0], grid=False)
                        parts, waiting = [], 0
        if parts:
            yield _counted(*flush(parts), grid=False)
        some = np.flatnonzero(grid)
        if len(some):
            yield _counted(some % CONTEXTS, grid[some], some // CONTEXTS, grid=True)

    raw = written(training.select("text").mapInArrow(work, "grid boolean, h long, n long, bucket long"), "lm-partial")
    counts = raw.filter("not grid").groupBy("h", "bucket").agg(F.sum("n").alias("c"))
    grid = raw.filter("grid").groupBy("bucket", F.col("h").alias("context")).agg(F.sum("n").alias("n"))
    return written(counts, "lm-counts"), grid


def _counted(h, n, bucket, grid: bool) -> pa.RecordBatch:
    arrays = [pa.array(np.full(len(h), grid)), pa.array(h.astype(np.int64)), pa.array(n.astype(np.int64)), pa.array(bucket.astype(np.int64))]
    return pa.RecordBatch.from_arrays(arrays, names=["grid", "h", "n", "bucket"])


def classes(grid: np.ndarray, seed: int = 3) -> np.ndarray:
    """Class of each bucket: k-means over the contexts of the buckets, weighted by their counts."""
    out = np.zeros(BUCKETS + 1, np.int64)
    out[BUCKETS] = CLASSES - 1
    total = grid.sum(axis=1)
    used = np.flatnonzero(total[:BUCKETS] > 0)
    k = CLASSES - 1
    if len(used) == 0:
        return out
    share = (grid[used] + 0.5) / (total[used, None] + 0.5 * CONTEXTS)
    x = np.log(share / ((grid.sum(axis=0) + 0.5) / (grid.sum() + 0.5 * CONTEXTS)))
    weight = np.sqrt(total[used])
    rng = np.random.default_rng(seed)
    centres = x[np.argsort(-weight)[:1]]
    while len(centres) < min(k, len(used)):
        gap = ((x[:, None] - centres[None]) ** 2).sum(2).min(1) * weight
        centres = np.concatenate([centres, x[[rng.choice(len(x), p=gap / gap.sum())]]]) if gap.sum() > 0 else np.concatenate([centres, x[:1] + len(centres)])
    for _ in range(25):
        of = ((x[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        for c in range(len(centres)):
            if (of == c).any():
                centres[c] = np.average(x[of == c], axis=0, weights=weight[of == c])
    out[used] = of
    return out


def log_softmax(table: np.ndarray, rows: np.ndarray) -> np.ndarray:
    z = table[rows[:, 0]]
    for k in range(1, rows.shape[1]):
        z += table[rows[:, k]]
    z += table[ROWS]
    z -= z.max(axis=1, keepdims=True)
    z -= np.log(np.exp(z).sum(axis=1, keepdims=True))
    return z


def _updates(table: np.ndarray, memory: np.ndarray, tokens: Tokens, of: np.ndarray, rate: float) -> None:
    rows, y = tokens.features(), of[tokens.bucket]
    for low in range(0, len(rows), BATCH):
        r, t = rows[low : low + BATCH], y[low : low + BATCH]
        error = np.exp(log_softmax(table, r))
        error[np.arange(len(t)), t] -= 1
        at, inverse = np.unique(r, return_inverse=True)
        cells = (inverse.reshape(r.shape)[:, :, None] * CLASSES + np.arange(CLASSES)).reshape(-1)
        g = np.bincount(cells, np.repeat(error, FEATURES, axis=0).reshape(-1), len(at) * CLASSES).reshape(-1, CLASSES)
        memory[at] += g * g
        table[at] -= (rate * g / np.sqrt(memory[at])).astype(np.float32)
        g = error.sum(0)
        memory[ROWS] += g * g
        table[ROWS] -= (rate * g / np.sqrt(memory[ROWS])).astype(np.float32)


def _added(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, np.ndarray, np.ndarray]]:
    """Sums of the weighted steps of each group of rows (keys…, moved, weight, step) that come in order, one group at a time."""
    now, total, weight = None, None, None
    for batch in batches:
        for *key, moved, own, step in zip(*[batch.column(c).to_pylist() for c in (*keys, "moved", "weight", "step")], strict=True):
            if key != now:
                if now is not None:
                    yield tuple(now), total, weight
                now, total, weight = key, np.zeros((CHUNK, CLASSES)), np.zeros(CHUNK)
            at = np.frombuffer(moved, np.int32) - key[0] * CHUNK
            total[at] += np.frombuffer(step, np.float32).reshape(-1, CLASSES)
            weight[at] += np.frombuffer(own, np.float32)
    if now is not None:
        yield tuple(now), total, weight


def _sum_steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The steps of some tasks as one row, for each chunk of the table."""
    for (chunk, part), total, weight in _added(batches, ["chunk", "part"]):
        at = np.flatnonzero(weight)
        values = [(at + chunk * CHUNK).astype(np.int32), weight[at].astype(np.float32), total[at].astype(np.float32)]
        arrays = [pa.array([chunk], pa.int64()), pa.array([part], pa.int32()), *[pa.array([v.tobytes()], pa.binary()) for v in values]]
        yield pa.RecordBatch.from_arrays(arrays, names=["chunk", "part", "moved", "weight", "step"])


def _mean_steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every row moves by the mean of the tasks that moved it, by their tokens."""
    for (chunk,), total, weight in _added(batches, ["chunk"]):
        at = np.flatnonzero(weight)
        values = [(at + chunk * CHUNK).astype(np.int32), (total[at] / weight[at, None]).astype(np.float32)]
        yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in values], names=["moved", "step"])


def fit(training: DataFrame, of: np.ndarray, prior: np.ndarray, rounds: int = ROUNDS, share: int = SHARE, rate: float = 0.1) -> np.ndarray:
    """Weights after all rounds; the last row is the bias, which starts from the classes' frequencies."""
    spark = training.sparkSession
    table = np.zeros((ROWS + 1, CLASSES), np.float32)
    table[ROWS] = np.log((prior + 1) / (prior.sum() + len(prior)))
    slice_of = F.pmod(F.xxhash64(F.lit(2), F.col("doc_id")), F.lit(share))
    for turn in range(rounds):
        shared = Shared(spark, (table, of))

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            start, of = shared.get()
            own, memory, seen = start.copy(), np.full(start.shape, 1.0, np.float32), 0
            for batch in batches:
                for _, _, tokens in _tokens(batch):
                    _updates(own, memory, tokens, of, rate)
                    seen += len(tokens.hash)
            # rows that moved and their steps, packed by chunks of the table
            moved = np.flatnonzero((own != start).any(axis=1))
            cuts = np.searchsorted(moved, np.arange(0, ROWS + 1 + CHUNK, CHUNK))
            parts = [(i, moved[a:b]) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if a < b]
            task = TaskContext.get().partitionId()
            steps = [((own[m] - start[m]) * np.float32(seen)).tobytes() for _, m in parts]
            weights = [np.full(len(m), seen, np.float32).tobytes() for _, m in parts]
            arrays = [pa.array([i for i, _ in parts], pa.int64()), pa.array([task] * len(parts), pa.int32()), *[pa.array(x, pa.binary()) for x in ([m.astype(np.int32).tobytes() for _, m in parts], weights, steps)]]
            yield pa.RecordBatch.from_arrays(arrays, names=["chunk", "task", "moved", "weight", "step"])

        some = training.filter(slice_of == turn % share).select("text")
        # in two levels, so that many tasks do not meet in as many as there are chunks; in the order of the tasks, so that reruns agree
        steps = some.mapInArrow(work, "chunk long, task int, moved binary, weight binary, step binary").withColumn("part", F.pmod("task", F.lit(FAN)))
        steps = steps.repartition("chunk", "part").sortWithinPartitions("chunk", "part", "task")
        sums = steps.mapInArrow(_sum_steps, "chunk long, part int, moved binary, weight binary, step binary").repartition("chunk").sortWithinPartitions("chunk", "part")
        for r in sums.mapInArrow(_mean_steps, "moved binary, step binary").collect():  # a table of fixed size
            table[np.frombuffer(r["moved"], np.int32)] += np.frombuffer(r["step"], np.float32).reshape(-1, CLASSES)
    return table


def most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """The words (h, c) above a count that at most ``most`` words reach, by a histogram of eighth powers of two."""
    step = F.floor(F.log2("c") * 8)
    bins = counts.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect()  # a few hundred rows
    least, total = 10**6, 0
    for r in sorted(bins, key=lambda r: -r["step"]):
        total += r["n"]
        if total > most:
            break
        least = r["step"]
    return counts.filter(step >= least).select("h", "c")


def score(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """(doc_id, text) to doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    kept = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    training = kept.filter(~F.col("held_out"))
    counts, grid_rows = count(training)
    grid = np.zeros((BUCKETS + 1, CONTEXTS))
    for r in grid_rows.collect():  # a table of fixed size
        grid[r["bucket"], r["context"]] = r["n"]
    of = classes(grid)
    per_bucket = counts.groupBy("bucket").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()
    n_class, v_class = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in per_bucket:
        n_class[of[r["bucket"]]] += r["n"]
        v_class[of[r["bucket"]]] += r["v"]
    n_all, v_all = int(n_class.sum()), int(v_class.sum())
    table = fit(training, of, n_class)

    top = most_frequent(counts, hot).toPandas().sort_values("h")
    base = float(np.log10(n_all + v_all + 1))
    words_in_class = np.log10(n_class + v_class + 1)
    shared = Shared(spark, (table, of, words_in_class, top["h"].to_numpy(np.int64), np.log10(top["c"].to_numpy(float) + 1)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, of, words_in_class, known, value = shared.get()
        for batch in batches:
            keys, ids, held = batch.column("key").to_numpy(), batch.column("doc_id"), batch.column("held_out")
            for low, high, tokens in _tokens(batch):
                n_texts, total = high - low, len(tokens.hash)
                y = of[tokens.bucket]
                gain = np.empty(total)
                rows = tokens.features()
                for a in range(0, total, BATCH):
                    z = log_softmax(table, rows[a : a + BATCH])
                    gain[a : a + BATCH] = z[np.arange(len(z)), y[a : a + BATCH]]
                gain = gain / np.log(10) - words_in_class[y]
                at = np.minimum(np.searchsorted(known, tokens.hash), max(0, len(known) - 1))
                is_hot = known[at] == tokens.hash if len(known) else np.zeros(total, bool)
                log_count = np.where(is_hot, value[at], 0.0) if len(known) else np.zeros(total)
                per_text = lambda v: np.add.reduceat(v, tokens.first[:-1])  # noqa: E731, B023
                whole = (ids.slice(low, n_texts), held.slice(low, n_texts))
                yield _scored(keys[low:high], np.zeros(n_texts, np.int64), np.diff(tokens.first), per_text(is_hot.astype(np.int64)), per_text(log_count), per_text(gain), whole)
                # the others once per text, to meet their counts
                rest = np.flatnonzero(~is_hot)
                order = rest[np.lexsort((tokens.hash[rest], tokens.text[rest]))]
                h, t = tokens.hash[order], tokens.text[order]
                new = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (t[1:] != t[:-1])]) if len(h) else np.zeros(0, np.int64)
                times = np.diff(np.r_[new, len(h)])
                zero = np.zeros(len(new))
                yield _scored(keys[low:high][t[new]], h[new], times, times * 0, zero, zero, (pa.nulls(len(new), ids.type), pa.nulls(len(new), pa.bool_())))

    keyed = kept.withColumn("key", F.xxhash64("doc_id", "text"))
    kind = kept.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, key long, h long, n long, known long, log_count double, gain double"
    found = written(keyed.mapInArrow(work, schema), "lm-scores")
    whole = found.filter("held_out is not null")
    # rows that are equal have equal keys, and each of them has handed in its rare words
    rare = found.filter("held_out is null").select("key", "h", "n").join(counts.select("h", "c"), "h")
    met = rare.groupBy("key").agg(F.sum("n").alias("more"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("more_log"))
    met = met.join(whole.groupBy("key").agg(F.count("*").alias("copies")), "key")
    met = met.select("key", (F.col("more") / F.col("copies")).cast("long").alias("more"), (F.col("more_log") / F.col("copies")).alias("more_log"))
    rows = whole.join(met, "key", "left").select(
        "doc_id",
        "held_out",
        F.col("n").alias("n_tokens"),
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        (F.col("log_count") + F.coalesce("more_log", F.lit(0.0))).alias("log_count"),
        "gain",
    )
    return rows.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("log_count") - F.col("n_tokens") * F.lit(base)).alias("base_score"),
        (F.col("log_count") + F.col("gain")).alias("score"),
    )


def _scored(key, h, n, known, log_count, gain, whole: tuple) -> pa.RecordBatch:
    """A row of a text, with its id and whether it is held out, or of a rare word in it, without."""
    arrays = [pa.array(np.asarray(v, kind)) for v, kind in ((key, np.int64), (h, np.int64), (n, np.int64), (known, np.int64), (log_count, float), (gain, float))]
    return pa.RecordBatch.from_arrays([*whole, *arrays], names=["doc_id", "held_out", "key", "h", "n", "known", "log_count", "gain"])
