"""Operator 13: SentencePiece encoding and decoding, in vectorised merge rounds.

The model joins the adjacent pair of symbols whose piece has the best score, the leftmost of equal ones, until no pair is a piece.
Here a text falls into words first, between which no piece of the vocabulary can reach, and the distinct new words of
a stretch of texts are joined together: one flat array of symbols, one array with the rank of the pair that begins at each, and in
every round the smallest rank of each word (``reduceat``), all its pairs of that rank joined from the left at once, and both arrays
compacted. A word leaves when no pair remains. Two cases need care to give just what one pair after the other gives:

* A new piece may form a pair of a better rank than its own with one of its neighbours. Pairs of that word to the right of it wait
  for the next round then. Where they wait in a long row (thousands of spaces), they are joined one by one after ``ROUNDS`` rounds.
* In words of more than ``LONG`` symbols the smallest rank of the word is replaced by the smallest within the length of the longest
  piece around: nothing farther off can take a symbol of the pair away before its turn. So a blob of 100,000 letters takes about
  as many rounds as a sentence.

Characters that the vocabulary does not have become their UTF-8 bytes. What a word became is kept in a dictionary of the task, emptied
at ``KEPT`` words. The vocabulary is read on the driver and sent to the tasks (its size is that of the model's file).

Defined cases: null text counts as empty and has no ids; long texts are taken in stretches cut between words; repeated rows are each
encoded; the columns named are carried along, others are left aside; an empty table gives an empty result. Decoding takes any ids
of the vocabulary: bytes that are no UTF-8 become U+FFFD each, control symbols nothing, null ids a null text; other ids raise an error.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache
from heapq import heappop, heappush
from itertools import count, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrays import pieces as stretches
from millrace.llm.common import Shared

SPACE = "▁"
#: Symbols from which on a word uses the ranks around a pair instead of those of the whole word.
LONG = 64
#: Words a task remembers.
KEPT = 200_000
#: Bytes of text whose new words are joined together.
STRETCH = 1 << 20
#: Rounds after which the pairs of a word are joined one after the other.
ROUNDS = 300
NONE = np.iinfo(np.int32).max


class Vocabulary:
    """Symbols of a model: its pieces by id, then characters that only occur within pieces."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.size = model.piece_size()
        ids = range(self.size)
        if any(model.is_unused(i) for i in ids) or model.normalize(f" a  {SPACE}éﬁ\n") != f"{SPACE}{SPACE}a{SPACE * 3}éﬁ\n":
            raise ValueError("only models that keep all characters and have no unused pieces are known here")
        pieces = [model.id_to_piece(i) for i in ids]
        self.bytes = np.full(256, -1, np.int32)
        plain = {}
        for i in ids:
            if model.is_byte(i):
                self.bytes[int(pieces[i][3:5], 16)] = i
            elif not model.is_control(i) and not model.is_unknown(i):
                plain[pieces[i]] = i
        if (self.bytes < 0).any():
            raise ValueError("the model has no bytes to fall back on")
        self.kind = np.array([1 if model.is_control(i) else 2 if model.is_byte(i) else 0 for i in ids], np.int8)
        surface = [b"" if k == 1 else bytes([int(p[3:5], 16)]) if k == 2 else p.replace(SPACE, " ").encode() for p, k in zip(pieces, self.kind, strict=True)]
        surface[model.unk_id()] = " ⁇ ".encode()
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.ends = np.cumsum([len(s) for s in surface])
        self.opens = np.array([k == 0 and p.startswith(SPACE) for p, k in zip(pieces, self.kind, strict=True)])

        symbols = dict(plain)
        for piece in plain:
            for char in piece:
                symbols.setdefault(char, self.size + len(symbols) - len(plain))
        self.symbols = self.size + len(symbols) - len(plain)
        self.chars = {ord(s): i for s, i in symbols.items() if len(s) == 1}
        score = {p: model.get_score(i) for p, i in plain.items()}
        place = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
        keys, joined, ranks = [], [], []
        self.early = np.zeros(self.symbols, bool)
        for piece, i in plain.items():
            for at in range(1, len(piece)):
                left, right = symbols.get(piece[:at]), symbols.get(piece[at:])
                if left is not None and right is not None:
                    keys.append(left * self.symbols + right)
                    joined.append(i)
                    ranks.append(rank := place[score[piece]])
                    for part, text in ((left, piece[:at]), (right, piece[at:])):
                        self.early[part] |= len(text) > 1 and rank <= place[score[text]]
        order = np.argsort(keys)
        self.keys = np.r_[np.array(keys, np.int64)[order], np.iinfo(np.int64).max]
        self.joined = np.r_[np.array(joined, np.int32)[order], 0].astype(np.int32)
        self.ranks = np.r_[np.array(ranks, np.int32)[order], 0].astype(np.int32)
        self.longest = max(map(len, plain), default=1)
        # words: a piece may begin with spaces and hold none after another character; characters of longer pieces hold together
        inner = {c for p in plain if len(p) > 1 for c in p} - {SPACE}
        self.leading = not any(SPACE in p.lstrip(SPACE) for p in plain)
        within = "[" + "".join(map(re.escape, sorted(inner if self.leading else inner | {SPACE}))) + "]" if inner else "(?!)"
        self.pattern = f"{SPACE}*{within}+|{SPACE}+|(?:(?!{within}|{SPACE})(?s:.))+" if self.leading else f"{within}+|(?:(?!{within})(?s:.))+"


class Pieces:
    """Encodes and decodes with one vocabulary; lives in a task."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.split = re.compile(vocabulary.pattern).findall
        self.of = np.arange(0x110000, dtype=np.int64) + vocabulary.symbols
        self.of[list(vocabulary.chars)] = list(vocabulary.chars.values())
        self.known: dict[str, bytes] = {}

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the pair stands in the table, and its rank."""
        key = left * self.v.symbols + right
        at = np.searchsorted(self.v.keys, key)
        found = (self.v.keys[at] == key) & (left < self.v.symbols) & (right < self.v.symbols)
        return at, np.where(found, self.v.ranks[at], NONE)

    def _lead(self, place: np.ndarray, take: np.ndarray, symbols: np.ndarray, at: np.ndarray, rank: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Marks the pairs at ``place`` whose piece forms a pair of a rank as good with the symbol before it or the one after."""
        n, new = len(symbols), self.v.joined[at[place]]
        before, after = np.maximum(place - 1, 0), np.minimum(place + 2, n - 1)
        joined = (place >= 2) & take[np.maximum(place - 2, 0)]
        left = np.where(joined, self.v.joined[at[np.maximum(place - 2, 0)]], symbols[before])
        lead = ((place > begin[place]) & (self._pairs(left, new)[1] <= rank[place])) | (
            (place + 2 < n) & (begin[after] == begin[place]) & (self._pairs(new, symbols[after])[1] <= rank[place])
        )
        marks = np.zeros(n, bool)
        marks[place[lead]] = True
        return marks

    def _one_by_one(self, symbols: np.ndarray) -> np.ndarray:
        """The rest of a word whose pairs wait for each other in a long row, like thousands of spaces."""
        own, n = symbols.tolist(), len(symbols)
        before, after, heap = list(range(-1, n - 1)), list(range(1, n + 1)), []

        @cache
        def look_up(left: int, right: int) -> tuple[int, int]:
            at, rank = self._pairs(np.array([left]), np.array([right]))
            return int(rank[0]), int(self.v.joined[at[0]])

        def push(i: int, j: int) -> None:
            if i >= 0 and j < n and (rank := look_up(own[i], own[j])[0]) < NONE:
                heappush(heap, (rank, i, own[i], own[j]))

        for i in range(n - 1):
            push(i, i + 1)
        while heap:
            _, i, left, right = heappop(heap)
            j = after[i]
            if own[i] != left or j >= n or own[j] != right:
                continue
            own[i], own[j], after[i] = look_up(left, right)[1], -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            push(before[i], i)
            push(i, after[i])
        return np.array([s for s in own if s >= 0], np.int64)

    def merge(self, symbols: np.ndarray, lengths: np.ndarray, around: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of words one after the other to those that remain, and how many of each word. ``around``: see ``LONG``."""
        n_words = len(lengths)
        word, kept, left_at = np.arange(n_words), [], []
        at, rank = self._pairs(symbols, np.r_[symbols[1:], 0])
        for turn in count():
            ends = np.cumsum(lengths)
            starts = ends - lengths
            rank[ends - 1] = NONE
            least = np.minimum.reduceat(rank, starts) if len(starts) else rank[:0]
            done = least == NONE
            if done.any():
                gone = np.repeat(done, lengths)
                left_at.append((word[done], lengths[done]))
                kept.append(symbols[gone])
                symbols, rank, at = symbols[~gone], rank[~gone], at[~gone]
                word, lengths, least = word[~done], lengths[~done], least[~done]
                if not len(word):
                    break
                ends = np.cumsum(lengths)
                starts = ends - lengths
            if turn == ROUNDS:
                rest = [self._one_by_one(s) for s in np.split(symbols, ends[:-1])]
                left_at.append((word, np.array([len(s) for s in rest])))
                kept.append(np.concatenate(rest))
                break
            begin = np.repeat(starts, lengths)
            index = np.arange(len(symbols))
            limit = _window_least(rank, around) if around else np.repeat(least, lengths)
            fits = (rank == limit) & (rank < NONE)
            # equal ranks side by side: every other one, counted from the first of them
            first = np.r_[True, rank[1:] != rank[:-1]]
            first = np.maximum.accumulate(np.where(first, index, 0))
            if around:
                fits &= np.maximum.accumulate(np.where(fits, -1, index)) < first
            take = fits & ((index - first) % 2 == 0)
            flagged = take & self.v.early[self.v.joined[at]]
            if flagged.any():
                flagged = self._lead(np.flatnonzero(flagged), take, symbols, at, rank, begin)
            if flagged.any():
                last = np.r_[-1, np.maximum.accumulate(np.where(flagged, index, -1))[:-1]]
                take &= last < (np.maximum(begin, index - 2 * around) if around else begin)
            place = np.flatnonzero(take)
            symbols[place] = self.v.joined[at[place]]
            stays = np.ones(len(symbols), bool)
            stays[place + 1] = False
            symbols, rank, at = symbols[stays], rank[stays], at[stays]
            lengths = lengths - np.add.reduceat(take.astype(np.int64), starts)
            place -= np.arange(len(place))
            fresh = np.union1d(place, place[place > 0] - 1)
            fresh = fresh[fresh < len(symbols) - 1]
            at[fresh], rank[fresh] = self._pairs(symbols[fresh], symbols[fresh + 1])
        words = np.concatenate([w for w, _ in left_at])
        counts = np.concatenate([c for _, c in left_at])
        flat = np.concatenate(kept)
        order = np.argsort(words)
        ends = np.cumsum(counts)
        begin, counts = (ends - counts)[order], counts[order]
        inside = np.arange(len(flat)) - np.repeat(np.cumsum(counts) - counts, counts)
        return flat[np.repeat(begin, counts) + inside], counts

    def ids(self, words: list[str]) -> list[bytes]:
        """The ids of each word, as 32-bit numbers."""
        lengths = np.array([len(w) for w in words], np.int64)
        symbols = self.of[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]
        out: list[bytes] = [b""] * len(words)
        for wide in (False, True):
            some = (lengths > LONG) == wide
            if not some.any():
                continue
            flat, counts = self.merge(symbols[np.repeat(some, lengths)], lengths[some], self.v.longest if wide else 0)
            flat, counts = self._fall_back(flat, counts)
            raw, ends = flat.astype("<i4").tobytes(), (np.cumsum(counts) * 4).tolist()
            low = 0
            for i, end in zip(np.flatnonzero(some).tolist(), ends, strict=True):
                out[i], low = raw[low:end], end
        return out

    def _fall_back(self, flat: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols outside of the vocabulary to the ids of their bytes."""
        odd = flat >= self.v.size
        if not odd.any():
            return flat, counts
        only = {i: c for c, i in self.v.chars.items()}
        bytes_of = [chr(only[s] if s < self.v.symbols else s - self.v.symbols).encode() for s in flat[odd].tolist()]
        times = np.ones(len(flat), np.int64)
        times[odd] = [len(b) for b in bytes_of]
        longer = np.repeat(flat, times)
        longer[np.repeat(odd, times)] = self.v.bytes[np.frombuffer(b"".join(bytes_of), np.uint8)]
        of = np.repeat(np.arange(len(counts)), counts)
        return longer, np.bincount(of, weights=times, minlength=len(counts)).astype(np.int64)

    def parts(self, text: str) -> Iterator[str]:
        """The normalised text in stretches, cut where a word begins."""
        text, low = SPACE + text.replace(" ", SPACE), 0
        while self.v.leading and len(text) - low > STRETCH:
            cut = low + STRETCH
            while (cut := text.find(SPACE, cut)) >= 0 and text[cut - 1] == SPACE:
                cut += 1
            if cut < 0:
                break
            yield text[low:cut]
            low = cut
        yield text[low:]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as 32-bit numbers; the texts should be about a stretch together."""
        out = []
        split = []
        for text in texts:
            if not text:
                split.append([])
            elif len(text) <= STRETCH:
                split.append(self.split(SPACE + text.replace(" ", SPACE)))
            else:
                out.append((len(split), b"".join(self._joined([self.split(s)])[0] for s in self.parts(text))))
                split.append([])
        found = self._joined(split)
        for i, ids in out:
            found[i] = ids
        return found

    def _joined(self, split: list[list[str]]) -> list[bytes]:
        known = self.known
        if len(known) > KEPT:
            known.clear()
        found = [list(map(known.get, words)) for words in split]
        lack = [i for i, f in enumerate(found) if None in f]
        if lack:
            new = list({w for i in lack for w, f in zip(split[i], found[i], strict=True) if f is None})
            known.update(zip(new, self.ids(new), strict=True))
            for i in lack:
                found[i] = map(known.__getitem__, split[i])
        return [b"".join(f) for f in found]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """Texts of ids one after the other; ``offsets`` has the n + 1 bounds of the texts."""
        v = self.v
        if len(ids) and not (0 <= ids.min() and ids.max() < v.size):
            raise ValueError("ids outside of the vocabulary")
        size = np.diff(v.ends, prepend=0)[ids]
        ends = np.r_[0, np.cumsum(size)]
        place = np.arange(ends[-1]) + np.repeat(v.ends[ids] - ends[1:], size)
        raw = v.surface[place].tobytes()
        kind, bounds, opens = v.kind[ids], ends[offsets].tolist(), v.opens[ids]
        told = np.flatnonzero(kind != 1)  # control symbols leave no trace, but keep bytes apart
        apart = len(told) < len(ids)
        head = np.searchsorted(told, offsets[:-1])
        out = []
        for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
            first = told[head[i]] if head[i] < len(told) else len(ids)
            skip = int(first < offsets[i + 1] and opens[first])
            own = slice(offsets[i], offsets[i + 1])
            try:
                out.append(self._repaired(ids[own])[skip:] if apart and (kind[own] == 1).any() else raw[a + skip : b].decode())
            except UnicodeDecodeError:
                out.append(self._repaired(ids[own])[skip:])
        return out

    def _repaired(self, ids: np.ndarray) -> str:
        """A text whose runs of bytes are no UTF-8 everywhere."""
        v, text, run = self.v, [], b""
        for i in [*ids.tolist(), None]:
            if i is not None and v.kind[i] == 2:
                run += v.surface[v.ends[i] - 1 : v.ends[i]].tobytes()
                continue
            while run:
                size = next((n for n in (1, 2, 3, 4) if _one_char(run[:n])), 0)
                text.append(run[:size].decode() if size else "�")
                run = run[size or 1 :]
            if i is not None:
                text.append(v.surface[(v.ends[i - 1] if i else 0) : v.ends[i]].tobytes().decode())
        return "".join(text)


def _one_char(raw: bytes) -> bool:
    try:
        return len(raw.decode()) == 1
    except UnicodeDecodeError:
        return False


def _window_least(rank: np.ndarray, around: int) -> np.ndarray:
    """The smallest rank from ``around`` places before to ``around`` after."""
    edge = np.full(around, NONE, rank.dtype)
    least, have, width = np.r_[edge, rank, edge], 1, 2 * around + 1
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    return least


def share(spark, path: str) -> Shared:
    """The vocabulary of a model file, sent to all tasks."""
    return Shared(spark, Vocabulary(path))


def _carried(df: DataFrame, columns: list[str], own: str, added: str) -> tuple[DataFrame, str]:
    name = "_".join(["own", *columns])  # a name that none of them has
    kept = df.select(*[F.col(c) for c in columns], F.col(own).alias(name))
    return kept, ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]] + [added])


def _offsets(found: list[bytes]) -> np.ndarray:
    return np.cumsum([0, *(len(f) // 4 for f in found)])


def _encoded(codec: Pieces, texts: pa.Array) -> Iterator[tuple[int, int, list[bytes]]]:
    """The ids of rows from low to high, a stretch of text at a time."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    for low, high in stretches(np.r_[0, np.cumsum(sizes, dtype=np.int64)], STRETCH):
        yield low, high, codec.encode(texts.slice(low, high - low).to_pylist())


def encode(docs: DataFrame, columns: list[str], shared: Shared, text: str = "text", into: str = "ids") -> DataFrame:
    """``columns`` of all rows and the ids of their whole text as an array."""
    kept, schema = _carried(docs, columns, text, f"`{into}` array<int>")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Pieces(shared.get())
        for batch in batches:
            for low, high, found in _encoded(codec, batch.column(len(columns))):
                ids = pa.ListArray.from_arrays(pa.array(_offsets(found), pa.int32()), pa.array(np.frombuffer(b"".join(found), "<i4"), pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(i).slice(low, high - low) for i in range(len(columns))] + [ids], names=[*columns, into])

    return kept.mapInArrow(work, schema)


def decode(encoded: DataFrame, columns: list[str], shared: Shared, ids: str = "ids", into: str = "text") -> DataFrame:
    """``columns`` of all rows and the text that their ids stand for."""
    kept, schema = _carried(encoded, columns, ids, f"`{into}` string")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(shared.get())
        for batch in batches:
            own = batch.column(len(columns))
            values = own.flatten()
            if values.null_count:
                raise ValueError("null among the ids of a text")
            sizes = np.array([0, *(x or 0 for x in own.value_lengths().to_pylist())], np.int64)
            found = pieces.decode(values.to_numpy(zero_copy_only=False).astype(np.int64), np.cumsum(sizes))
            texts = pa.array(found, pa.string(), mask=np.array(own.is_null()))
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(columns))] + [texts], names=[*columns, into])

    return kept.mapInArrow(work, schema)


def digest(docs: DataFrame, columns: list[str], shared: Shared) -> DataFrame:
    """``columns`` of all rows, how many ids their text has, and hashes of the ids and of the text decoded from them."""
    kept, schema = _carried(docs, columns, "text", "n_tokens long, ids_sha256 string, decoded_sha256 string")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Pieces(shared.get())
        told = np.array([f"{i},".encode() for i in range(codec.v.size)])
        for batch in batches:
            for low, high, found in _encoded(codec, batch.column(len(columns))):
                ids, offsets = np.frombuffer(b"".join(found), "<i4"), _offsets(found)
                texts = [hashlib.sha256(t.encode()).hexdigest() for t in codec.decode(ids, offsets)]
                shas = [hashlib.sha256(told[ids[a:b]].tobytes().replace(b"\0", b"")[:-1]).hexdigest() for a, b in pairwise(offsets.tolist())]
                own = [batch.column(i).slice(low, high - low) for i in range(len(columns))]
                yield pa.RecordBatch.from_arrays([*own, pa.array(np.diff(offsets)), pa.array(shas, pa.string()), pa.array(texts, pa.string())], names=[*columns, "n_tokens", "ids_sha256", "decoded_sha256"])

    return kept.mapInArrow(work, schema)
