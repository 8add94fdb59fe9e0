"""Operator 4: language of whole texts by a byte convolutional network, in numpy.

Bytes fold to ``SYMBOLS`` symbols (letters without case, continuation bytes without the bit that tells case
apart). Filters of widths 2, 3 and 4 slide over windows of ``WINDOW`` bytes, the largest response of each
filter in a window goes to a softmax over the languages, and a text gets the mean of its windows' log
probabilities. All windows of a text count.

Training takes a bounded sample: at most ``per_language`` documents of each language, chosen by a hash of their
ids, and ``WINDOWS_PER_DOC`` windows of each, anywhere in it. Prediction uses nothing but the text.

Defined cases: null texts and texts without a letter are ``und`` with score 0; ties of probability go to the
language that sorts first; repeated rows get equal predictions; null and unknown languages of training
rows are left out; if nothing can be learned from, every document is ``und``; other columns are left aside.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.arrays import parts, text_bytes
from millrace.llm.common import Shared, written
from millrace.operators.lookup import fits_broadcast

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 10
SYMBOLS = 64
WINDOWS_PER_DOC = 3
PER_LANGUAGE = 1_500
#: How many times as many documents of a language are ranked as are wanted; those held out or without letters are among them.
MARGIN = 4
UND = "und"

FOLD = np.full(256, 26, np.int64)
FOLD[65:91] = FOLD[97:123] = np.arange(26)
FOLD[48:58] = 27
FOLD[128:192] = 28 + np.arange(64) % 32
FOLD[192:256] = 60 + np.arange(64) // 16


def held_out(doc_id) -> F.Column:
    """Documents that training leaves out; a null id is never left out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def sample(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """Training rows (lang, window): bounded, the same on every run, spread over whole texts."""
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}") & ~held_out(F.col("doc_id")))
    mark = F.xxhash64(F.lit(4), F.col("doc_id"))
    slim = usable.select("lang", F.col("doc_id").alias("picked"), mark.alias("mark"))
    # the smallest hashes of each language. Counts give each a bound that MARGIN times as many lie below, so that of a language
    # of a third of all documents no more than these are sorted; without text the count is one light scan
    size = written(docs.filter("lang is not null").groupBy("lang").agg(F.count("*").alias("size")), "languages")
    size = F.broadcast(size) if fits_broadcast(size) else size
    bound = F.lit(-(2.0**63)) + F.lit(2.0**64) * F.least(F.lit(1.0), F.lit(float(MARGIN * per_language)) / F.col("size"))
    low = slim.join(size, "lang").filter(F.col("mark").cast("double") <= bound)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("mark"))
    picked = low.withColumn("rank", rank).filter(F.col("rank") <= per_language).select("picked").distinct()
    chosen = usable.join(F.broadcast(picked), F.col("doc_id") == F.col("picked"))  # at most per_language rows a language
    n = F.length("text")
    starts = [F.pmod(F.xxhash64(F.lit(i), F.col("doc_id")), F.greatest(n - WINDOW + 1, F.lit(1))) for i in range(WINDOWS_PER_DOC)]
    windows = F.array(*[F.substring(F.col("text"), (s + 1).cast("int"), F.lit(WINDOW)) for s in starts])
    return chosen.select("lang", F.explode(windows).alias("window"))


def symbols_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows of all texts as rows of symbols, padded by spaces, and the number of windows of each text."""
    length = np.diff(offsets)
    counts = np.maximum(1, -(-length // WINDOW))
    rows = np.concatenate([[0], np.cumsum(counts)])
    flat = np.full(rows[-1] * WINDOW, 26, np.int64)
    shift = np.repeat(rows[:-1] * WINDOW - offsets[:-1], length)
    flat[np.arange(len(data)) + shift] = FOLD[data]
    return flat.reshape(-1, WINDOW), counts


class Network:
    """Weights: one (width, SYMBOLS, FILTERS) tensor per width, then the dense layer."""

    def __init__(self, languages: list[str], seed: int = 5):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.taps = [rng.normal(0, 0.3, (w, SYMBOLS, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.dense = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(languages))).astype(np.float32)
        self.offset = np.zeros(len(languages), np.float32)

    def responses(self, x: np.ndarray, taps: np.ndarray) -> np.ndarray:
        width = len(taps)
        n = x.shape[1] - width + 1
        out = taps[0][x[:, :n]]
        for k in range(1, width):
            out += taps[k][x[:, k : k + n]]
        return out

    def pooled(self, x: np.ndarray) -> np.ndarray:
        """Largest response of every filter in every window, by tables over pairs of symbols."""
        if not hasattr(self, "pairs"):
            self.pairs = [[(t[k][:, None] + t[k + 1][None]).reshape(-1, FILTERS) for k in range(0, len(t) - 1, 2)] for t in self.taps]
        out = np.empty((len(x), len(WIDTHS) * FILTERS), np.float32)
        for low in range(0, len(x), 64):  # stays in the cache
            part = x[low : low + 64]
            pair = part[:, :-1] * SYMBOLS + part[:, 1:]
            for i, (width, tables, taps) in enumerate(zip(WIDTHS, self.pairs, self.taps, strict=True)):
                n = WINDOW - width + 1
                got = tables[0].take(pair[:, :n], axis=0)
                for k, more in enumerate(tables[1:], 1):
                    got += more.take(pair[:, 2 * k : 2 * k + n], axis=0)
                if width % 2:
                    got += taps[-1].take(part[:, width - 1 : width - 1 + n], axis=0)
                out[low : low + 64, i * FILTERS : (i + 1) * FILTERS] = got.max(axis=1)
        return out

    def log_probabilities(self, pooled: np.ndarray) -> np.ndarray:
        z = np.maximum(pooled + self.bias, 0) @ self.dense + self.offset
        z -= z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 0.05, seed: int = 6) -> Network:
        """Adagrad; the gradient of a maximum goes to the place it was found at."""
        rng = np.random.default_rng(seed)
        weights = [*self.taps, self.bias, self.dense, self.offset]
        memory = [np.full_like(w, 1e-3) for w in weights]
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for low in range(0, len(x), batch):
                pick = order[low : low + batch]
                part, at, pooled = x[pick], [], []
                for taps in self.taps:
                    got = self.responses(part, taps)
                    at.append(got.argmax(axis=1))
                    pooled.append(np.take_along_axis(got, at[-1][:, None], 1)[:, 0])
                hidden = np.maximum(np.concatenate(pooled, 1) + self.bias, 0)
                z = hidden @ self.dense + self.offset
                p = np.exp(z - z.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                p[np.arange(len(pick)), y[pick]] -= 1
                p /= len(pick)
                back = (p @ self.dense.T) * (hidden > 0)
                grads = []
                for i, taps in enumerate(self.taps):
                    g, own = np.zeros_like(taps), back[:, i * FILTERS : (i + 1) * FILTERS]
                    for k in range(len(taps)):
                        symbol = np.take_along_axis(part, at[i] + k, 1)
                        np.add.at(g[k], (symbol, np.arange(FILTERS)[None]), own)
                    grads.append(g)
                grads += [back.sum(0), hidden.T @ p, p.sum(0)]
                for w, m, g in zip(weights, memory, grads, strict=True):
                    m += g * g
                    w -= rate * g / np.sqrt(m)
        return self

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the language and its probability, for each text."""
        x, counts = symbols_of(data, offsets)
        logs = np.add.reduceat(self.log_probabilities(self.pooled(x)), np.concatenate([[0], np.cumsum(counts)[:-1]]), axis=0)
        logs /= counts[:, None]
        p = np.exp(logs - logs.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        return best, p[np.arange(len(p)), best]


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Network | None:
    """Fit a network on the bounded sample of (doc_id, text, lang)."""
    rows = sorted((r["lang"], r["window"]) for r in sample(docs, per_language).collect())
    if not rows:
        return None
    languages = sorted({lang for lang, _ in rows})
    raw = [window.encode()[:WINDOW] for _, window in rows]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    x, _ = symbols_of(np.frombuffer(b"".join(raw), np.uint8), offsets)
    return Network(languages).fit(x, np.array([languages.index(lang) for lang, _ in rows]))


def predict(docs: DataFrame, network: Network | None, columns: list[str]) -> DataFrame:
    """``columns`` with lang_pred and score for each document."""
    letters = F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False))
    kept = docs.select(*dict.fromkeys([*columns, "text"]), letters.alias("has_letter_"))
    names = [*columns, "lang_pred", "score"]
    head = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema.fields if f.name in columns)
    shared = Shared(docs.sparkSession, network)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.get()
        for batch in (part for whole in batches for part in parts(whole)):
            data, offsets = text_bytes(batch.column("text"))
            letter = np.asarray(batch.column("has_letter_").to_pylist(), bool)
            best, score = np.zeros(len(letter), np.int64), np.zeros(len(letter))
            if net is None:
                letter[:] = False
            else:
                best[:], score[:] = net.predict(data, offsets)
            lang = [net.languages[b] if ok else UND for b, ok in zip(best, letter, strict=True)]
            arrays = [batch.column(c) for c in columns] + [pa.array(lang, pa.string()), pa.array(np.where(letter, score, 0.0))]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return kept.mapInArrow(work, f"{head}, lang_pred string, score double")
