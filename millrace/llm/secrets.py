"""Operator 5: secrets. Patterns give the base spans; a character network judges every other candidate.

Kinds assign, access and hex are the base: leftmost non-overlapping matches of their pattern per kind, those too
short dropped without another try. Candidates of the network are all runs of ``[A-Za-z0-9+/_=-]`` of
``LEAST`` characters or more with a letter and a digit, together with ``CONTEXT`` characters before and after. The
network convolves the characters of context and candidate, takes the largest response of each filter, and gives
a probability, calibrated on rows that training leaves out; the threshold is where a secret is likelier than not and
``FALSE`` of their harmless places pass at most, or lower to keep ``RECALL`` of their positives. A candidate of more than ``SHOWN`` characters is seen in windows, the largest probability counts. What passes becomes a span of kind ``model`` unless a base span overlaps it.

Labelled findings come from the corpus itself: all base findings are the positives; all other candidates and, of each document, some
long words are the negatives. Every document takes part: three quarters of its places train the network, in rounds of shares of the
documents in which each task goes on from the common weights and their mean, by rows, is what the next round starts from; the responses
to the last quarter of the places, counted in narrow steps, give calibration and threshold.

Defined cases: null and empty texts have no span; kinds are searched apart and may overlap; repeated rows are each
searched; null ids are carried along; without any positive nothing but the base is found; other
columns are left aside; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Shared
from millrace.llm.spans import joined, over_texts, sha256

KINDS = ("assign", "access", "hex", "model")
BASE = KINDS[:3]
ORDER = {kind: i for i, kind in enumerate(KINDS)}
LEAST = 16
CONTEXT = 24
SHOWN = 48
RECALL = 0.98
#: Share of harmless places that may be taken for secrets.
FALSE = 0.0075
#: Rounds of training. Each takes one share of the documents, the shares in turn; there are as many shares, up to one a round, as
#: leave a task some ``TASK_DOCS`` documents. More documents make more tasks a round, up to ``TASKS``, whose weights meet on the driver.
ROUNDS, TASK_DOCS, TASKS = 12, 6_000, 256
#: One place in so many is left out of training.
HELD = 4
#: Rows that a task trains on at once.
ROWS = 150_000
#: Steps of a response that are told apart when responses are counted, and the largest response.
STEPS, MOST = 1024, 64
#: Harmless words of a document that are no candidates but show the network what others look like.
HARMLESS = 8

ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
DIGIT = re.compile(r"[0-9]")
LETTER = re.compile(r"[A-Za-z]")
WORD = re.compile(r"\S{8,}")

WIDTH = 4
FILTERS = 24
LENGTH = 2 * CONTEXT + SHOWN
#: Classes of characters: letters by case, digits one by one, punctuation one by one, other.
CODES = {c: i + 2 for i, c in enumerate("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-.:;,'\"@()[]{}<>#$%&*!?|\\")}
SYMBOLS = len(CODES) + 2
#: Class of each code point, the last one stands for all from there on.
TABLE = np.array([0, *[CODES.get(chr(c), 1) for c in range(1, 256)]], np.uint8)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    spans: list[tuple[str, int, int]] = []
    low = text.lower()
    if "passw" in low or "secret" in low or "token" in low or "api" in low:
        spans += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    return spans


def candidates(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in RUN.finditer(text) if DIGIT.search(m.group()) and LETTER.search(m.group())]


def codes(text: str) -> np.ndarray:
    """Class of each character of a text, with ``CONTEXT`` empty places before and after."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.pad(TABLE[np.minimum(points, len(TABLE) - 1)], CONTEXT)


def encode(of: np.ndarray, places: list[tuple[int, int]], context: bool = True) -> np.ndarray:
    """Context, candidate and context of places of a text as rows of fixed length; longer candidates than ``SHOWN`` take ``windows``."""
    rows = np.zeros((len(places), LENGTH), np.uint8)
    for row, (start, end) in zip(rows, places, strict=True):
        row[CONTEXT : CONTEXT + end - start] = of[CONTEXT + start : CONTEXT + end]
        if context:
            row[:CONTEXT] = of[start : start + CONTEXT]
            row[CONTEXT + SHOWN :] = of[CONTEXT + end : 2 * CONTEXT + end]
    return rows


def windows(start: int, end: int) -> list[tuple[int, int]]:
    """Windows of ``SHOWN`` characters over a candidate, half a window apart and one at its end."""
    if end - start <= SHOWN:
        return [(start, end)]
    return [(a, a + SHOWN) for a in [*range(start, end - SHOWN, SHOWN // 2), end - SHOWN]]


def clear_of(spans: list[tuple]):
    """A test whether (start, end) overlaps none of the spans (kind, start, end), in the logarithm of their number."""
    starts, ends = [], []
    for _, start, end in sorted(spans, key=lambda s: s[1]):
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)

    def clear(start: int, end: int) -> bool:
        at = bisect_left(starts, end) - 1  # the last one that starts before the end
        return at < 0 or ends[at] <= start

    return clear


class Network:
    """One convolution with a part for the context and one for the candidate, maxima, logistic output."""

    def __init__(self, seed: int = 9):
        rng = np.random.default_rng(seed)
        self.taps = rng.normal(0, 0.3, (2, WIDTH, SYMBOLS, FILTERS)).astype(np.float32)
        self.out = rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32)
        self.offset = np.zeros(1, np.float32)
        self.memory = [np.full_like(w, 1e-3) for w in self.weights()]
        self.scale, self.shift, self.threshold = 1.0, 0.0, 1.1

    def weights(self) -> list[np.ndarray]:
        return [self.taps, self.out, self.offset]

    def state(self) -> bytes:
        """Weights, and what Adagrad remembers of their steps."""
        return np.concatenate([a.ravel() for a in self.weights() + self.memory]).astype("<f4").tobytes()

    def put(self, state: np.ndarray) -> None:
        for a in self.weights() + self.memory:
            a[...] = state[: a.size].reshape(a.shape)
            state = state[a.size :]

    def parts(self, x: np.ndarray) -> list[np.ndarray]:
        around = np.concatenate([x[:, :CONTEXT], x[:, CONTEXT + SHOWN :]], axis=1)
        return [around, x[:, CONTEXT : CONTEXT + SHOWN]]

    def pool(self, part: np.ndarray, taps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = part.shape[1] - WIDTH + 1
        got = sum(taps[k][part[:, k : k + n]] for k in range(WIDTH))
        at = got.argmax(axis=1)
        return np.take_along_axis(got, at[:, None], 1)[:, 0], at

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(len(x))
        for low in range(0, len(x), 512):
            pooled = [self.pool(p, t)[0] for p, t in zip(self.parts(x[low : low + 512]), self.taps, strict=True)]
            out[low : low + 512] = np.maximum(np.concatenate(pooled, 1), 0) @ self.out + self.offset
        return out

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 12, batch: int = 64, rate: float = 0.03, seed: int = 10) -> Network:
        rng = np.random.default_rng(seed)
        weights, memory = self.weights(), self.memory
        balance = np.where(y > 0, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y)
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for low in range(0, len(x), batch):
                pick = order[low : low + batch]
                parts = self.parts(x[pick])
                pooled = [self.pool(p, t) for p, t in zip(parts, self.taps, strict=True)]
                hidden = np.maximum(np.concatenate([p for p, _ in pooled], 1), 0)
                error = (1 / (1 + np.exp(-(hidden @ self.out + self.offset))) - y[pick]) * balance[pick] / len(pick)
                back = error[:, None] * self.out[None] * (hidden > 0)
                g = np.zeros_like(self.taps)
                for i, (part, (_, at)) in enumerate(zip(parts, pooled, strict=True)):
                    own = back[:, i * FILTERS : (i + 1) * FILTERS]
                    for k in range(WIDTH):
                        np.add.at(g[i, k], (np.take_along_axis(part, at + k, 1), np.arange(FILTERS)[None]), own)
                for w, m, step in zip(weights, memory, (g, hidden.T @ error, error.sum(keepdims=True)), strict=True):
                    m += step * step
                    w -= (rate * step / np.sqrt(m)).astype(np.float32)
        return self

    def calibrate(self, x: np.ndarray, y: np.ndarray, recall: float = RECALL) -> Network:
        """Platt scaling on rows left out of training, then the threshold: where a secret is likelier than not and no more than
        ``FALSE`` of the harmless places pass, as secrets of kinds that no pattern finds look less sure than those of the patterns;
        lower if that recall of the findings asks for it."""
        return self.settle(self.logits(x), y, np.ones(len(x)), recall)

    def settle(self, z: np.ndarray, y: np.ndarray, n: np.ndarray, recall: float = RECALL) -> Network:
        """Calibrate on responses z with labels y, each of n rows."""
        for _ in range(200):
            error = 1 / (1 + np.exp(-np.clip(self.scale * z + self.shift, -30, 30))) - y
            self.scale -= 0.1 * float((n * error * z).sum() / n.sum() / max(1.0, (n * z * z).sum() / n.sum()))
            self.shift -= 0.1 * float((n * error).sum() / n.sum())
        p = 1 / (1 + np.exp(-np.clip(self.scale * z + self.shift, -30, 30)))

        def ranked(some: np.ndarray, share: float, less: int) -> float:
            """What stands at that share of the rows, in the order of their probabilities."""
            order = np.argsort(p[some], kind="stable")
            upto = np.cumsum(n[some][order])
            return float(p[some][order][np.searchsorted(upto, int(share * (upto[-1] - less)), "right")])

        if (y > 0).any():
            self.threshold = ranked(y > 0, 1 - recall, 0)
        if (y == 0).any():
            self.threshold = min(self.threshold, max(0.5, ranked(y == 0, 1 - FALSE, 1)))
        return self

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.logits(x) + self.shift, -30, 30)))


def find(text: str, network: Network | None) -> list[tuple[str, int, int, float]]:
    """All spans of a text: (kind, start, end, probability); base spans whatever the network says."""
    spans = base_spans(text)
    places = spans + [("model", *c) for c in candidates(text)]
    if not places:
        return []
    if network is None:
        return [(*s, 1.0) for s in spans]
    # the largest response of the windows of each place
    cut = [windows(start, end) for _, start, end in places]
    first = np.cumsum([0, *map(len, cut)])[:-1]
    of, seen = codes(text), (w for ws in cut for w in ws)
    p = np.concatenate([network.probabilities(encode(of, part)) for part in iter(lambda: list(islice(seen, 4096)), [])])
    p = np.maximum.reduceat(p, first)
    found = [(*s, float(q)) for s, q in zip(places, p, strict=True)]
    clear = clear_of(spans)
    free = [s for s in found[len(spans) :] if s[3] >= network.threshold and clear(s[1], s[2])]
    return found[: len(spans)] + free


def shown(text: str) -> list[tuple[int, int, int]]:
    """Places (start, end, label) for training: values that the patterns found, and runs and words that they did not."""
    base, out = base_spans(text), []
    for kind, start, end in base:
        if kind == "assign":
            start += len(text[start:end]) - len(ASSIGN.match(text, start)[2])
        out += [(*w, 1) for w in windows(start, end)]
    clear = clear_of(base)
    others = [s for s in candidates(text) if clear(*s)]
    long_words = islice(WORD.finditer(text), 0, None, max(1, len(text) // 500))
    others += islice((m.span() for m in long_words if clear(*m.span())), HARMLESS)
    return out + [(*w, 0) for s in others for w in windows(*s)]


def rows_of(text: str, places: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Two rows for each place, with its context and without: the words that patterns ask for stand there, and candidates of the
    network lack them."""
    of, ends = codes(text), [p[:2] for p in places]
    both = np.stack([encode(of, ends), encode(of, ends, context=False)], axis=1)
    return both.reshape(-1, LENGTH), np.repeat(np.array([label for *_, label in places], np.float32), 2)


def labelled(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Rows for training of all places of the texts."""
    found = [rows_of(text, shown(text)) for text in texts]
    return np.concatenate([np.zeros((0, LENGTH), np.uint8), *[x for x, _ in found]]), np.concatenate([np.zeros(0, np.float32), *[y for _, y in found]])


def _rows(batches: Iterator[pa.RecordBatch], out: bool | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of all texts (text, part) of a task, about ``ROWS`` at once: of the places left out, of the others, or of all."""
    held, n = [], 0
    for batch in batches:
        for text, part in zip(batch.column("text").to_pylist(), batch.column("part").to_pylist(), strict=True):
            places = shown(text or "")
            if out is not None:
                places = [p for i, p in enumerate(places) if ((i + part) % HELD == 0) == out]
            if places:
                held.append(rows_of(text, places))
                n += 2 * len(places)
            if n >= ROWS:
                yield np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held])
                held, n = [], 0
    if held:
        yield np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held])


def _fitted(marked: DataFrame, out: bool | None) -> Network | None:
    """A network that has seen these rows of all of (text, part, mark), mark being a hash; None without any finding."""
    n = marked.count()
    shares = min(ROUNDS, max(1, -(-n // TASK_DOCS)))
    tasks = min(TASKS, max(1, -(-n // shares // TASK_DOCS)))
    network, seen = Network(), 0
    for number in range(shares * max(1, ROUNDS // shares)):
        shared = Shared(marked.sparkSession, network)

        def work(batches: Iterator[pa.RecordBatch], shared=shared, number=number) -> Iterator[pa.RecordBatch]:
            net, rows, found = shared.get(), 0, 0
            for x, y in _rows(batches, out):
                net.fit(x, y, epochs=1, seed=10 + number)
                rows, found = rows + len(y), found + int(y.sum())
            if rows:
                yield pa.RecordBatch.from_pydict({"rows": [rows], "found": [found], "state": [net.state()]})

        some = marked.filter(F.pmod("mark", F.lit(shares)) == number % shares).select("text", "part").coalesce(tasks)
        steps = some.mapInArrow(work, "rows long, found long, state binary")
        # weights of a fixed size for each task; a sort in Spark would train twice, as it samples its input first
        got = sorted(steps.withColumn("task", F.spark_partition_id()).collect(), key=lambda r: r["task"])
        seen += sum(r["found"] for r in got)
        if got:
            network.put(sum(r["rows"] * np.frombuffer(r["state"], "<f4").astype(np.float64) for r in got) / sum(r["rows"] for r in got))
        if not seen and number + 1 >= shares:
            return None
    return network


def _responses(marked: DataFrame, network: Network, out: bool | None) -> np.ndarray:
    """Steps of the network's response, labels and how many rows have them, over these rows of all texts (text, part)."""
    shared = Shared(marked.sparkSession, network)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.get()
        for x, y in _rows(batches, out):
            step = np.floor(np.clip(net.logits(x), -MOST, MOST) * STEPS).astype(np.int64)
            both, n = np.unique(2 * step + (y > 0), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(both), pa.array(n.astype(np.int64))], names=["both", "n"])

    counts = marked.select("text", "part").mapInArrow(work, "both long, n long").groupBy("both").agg(F.sum("n").alias("n"))
    return np.array([(r["both"] // 2, r["both"] % 2, r["n"]) for r in counts.collect()], np.int64).reshape(-1, 3)  # as many as there are steps


def train(docs: DataFrame) -> Network | None:
    """Fit on three quarters of the places, calibrate on the last one; on all of them if either part has no finding."""
    hashed = F.xxhash64(F.lit(5), F.col("doc_id"), F.col("text"))
    marked = docs.select("text", F.pmod(hashed, F.lit(HELD)).alias("part"), F.shiftright(hashed, 8).alias("mark"))
    network, rows = _fitted(marked, False), None
    if network:
        rows = _responses(marked, network, True)
    if rows is None or not rows[:, 1].any():
        network = _fitted(marked, None)
        if not network:
            return None
        rows = _responses(marked, network, None)
    return network.settle(rows[:, 0] / STEPS, rows[:, 1].astype(np.float64), rows[:, 2].astype(np.float64))


def digest(docs: DataFrame, network: Network | None) -> DataFrame:
    """(doc_id, text) to doc_id, count per base kind, digest of the base spans, all spans as text."""
    shared = Shared(docs.sparkSession, network)

    def row(text: str, network: Network | None) -> tuple:
        spans = find(text, network)
        base = [s for s in spans if s[0] in BASE]
        return (*[sum(s[0] == kind for s in base) for kind in BASE], sha256(joined(base, ORDER)), joined(spans, ORDER))

    counts = ", ".join(f"n_{kind} long" for kind in BASE)
    return over_texts(docs, ["doc_id"], f"{counts}, base_sha256 string, spans string", row, shared)
