"""Packing of documents into token sequences by order-preserving dynamic programming.

Documents are tokenised once, put in order of their ids, and read as one stream
of tokens.  A sequence is a window of the stream of at most ``length`` tokens.
Windows may be cut at document ends for nothing, at sentence ends for
``SENTENCE``, and every ``HARD_STEP`` tokens of a stretch without either for
``HARD`` (a truncation penalty, in tokens of padding).  A window costs the
padding up to ``length``, none if its own length is a power of two, and 1, so
that of equal plans the one with fewer sequences wins.

``cost[j] = penalty[j] + 1 + min(length - p[j] + min over p[i] >= p[j] - length of (cost[i] + p[i]),
min over k of cost[i at p[j] - 2**k])``: the inner minimum over the sliding range
is the head of a monotone queue, so a cut costs amortised constant time.

The stream is dealt by ranges of the order into blocks of about
``BLOCK_TOKENS``, one task each; a block is planned in stretches of
``STRETCH`` tokens, and the last ``length * TAIL`` tokens of a stretch are planned
again with the next one, so memory does not grow with a block or a document.

Defined results: null text counts as empty and gives the end token only; null
ids come last; rows with equal ids, repeated rows too, are packed each; an
empty table gives no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections import deque

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.llm.common import text_batches, write_stage

LENGTH = 2048
SENTENCE = 6
HARD = 24
HARD_STEP = 128
BLOCK_TOKENS = 1 << 21
STRETCH = 1 << 17
TAIL = 8
#: Chunks of text whose ids a task remembers.
CACHE = 1 << 20
END_ID = 1
#: Sequence ids: block number * BLOCK_IDS + number within the block.
BLOCK_IDS = 1 << 32

_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


# ------------------------------------------------------------ tokens
def _byte_characters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the
    others for the code points from 256 on, in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(rest)}


class _Numbers(dict):
    """Numbers keys in the order of their first look-up; ``new`` has those not yet learnt."""

    def __init__(self) -> None:
        self.new: list[bytes] = []

    def __missing__(self, key: bytes) -> int:
        n = self[key] = len(self)
        self.new.append(key)
        return n

    def take(self) -> list[bytes]:
        new, self.new = self.new, []
        return new


def _latin(text: str) -> str | None:
    """``text`` as the tokenizer normalises it, if it is a word of Latin letters."""
    lower = text if text.isascii() else unicodedata.normalize("NFC", text)
    lower = lower.lower()
    return lower if lower.isalpha() and (lower.isascii() or max(lower) < "\u0250") else None


class _Rows:
    """An array that grows at its end."""

    def __init__(self, shape: tuple[int, ...], dtype) -> None:
        self.n, self.room = 0, np.empty((1024, *shape), dtype)

    def add(self, rows: np.ndarray) -> None:
        need = self.n + len(rows)
        if need > len(self.room):
            room = np.empty((max(need, 2 * len(self.room)), *self.room.shape[1:]), self.room.dtype)
            room[:self.n] = self.all
            self.room = room
        self.room[self.n:need] = rows
        self.n = need

    @property
    def all(self) -> np.ndarray:
        return self.room[:self.n]


class Ids:
    """Token ids of whole texts.  White space separates tokens, so each stretch
    between ASCII white space is encoded once and remembered; Arrow splits the
    texts and numbers their distinct stretches, and only those are looked up.  Of
    a stretch, punctuation after a letter or digit is a group of its own, and a
    word of Latin letters needs no rule but lower case: it goes to the model directly."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.alphabet = _byte_characters()
        self.dtype = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self._forget()

    def _forget(self) -> None:
        self.known = _Numbers()                     # stretch -> row of pairs
        self.pairs = _Rows((2,), np.int32)          # its two groups; 0 is the empty one
        self.stops = _Rows((), bool)                # whether it ends a sentence
        self.groups = _Numbers()                    # group -> place in spans
        self.groups[b""] = 0
        self.spans = _Rows((2,), np.int64)          # its ids in flat
        self.spans.add(np.zeros((1, 2)))
        self.flat = _Rows((), self.dtype)

    def _learn_groups(self, groups: list[bytes]) -> None:
        ids, sizes = [], []
        tokenize, encode = self.model.tokenize, self.tokenizer.encode
        for group in groups:
            text = group.decode()
            if lower := _latin(text):
                symbols = lower if lower.isascii() else lower.encode().decode("latin-1").translate(self.alphabet)
                found = [t.id for t in tokenize(symbols)]
            else:
                found = encode(text, add_special_tokens=False).ids
            ids += found
            sizes.append(len(found))
        ends = self.flat.n + np.cumsum(np.array(sizes, np.int64))
        self.spans.add(np.column_stack([ends - sizes, ends]))
        self.flat.add(np.array(ids, self.dtype))

    def _learn(self, stretches: list[bytes]) -> None:
        split = []
        for chunk in stretches:
            body = chunk.rstrip(b".,;:!?")
            if body != chunk and body[-1:].isalnum():
                split += (body.lower() if body.isalpha() else body, chunk[len(body):])
            elif body != chunk and body[-1:] >= b"\x80" and (lower := _latin(body.decode())):
                split += (lower.encode(), chunk[len(body):])
            else:
                split += (chunk.lower() if chunk.isalpha() else chunk, b"")
        codes = np.fromiter(map(self.groups.__getitem__, split), np.int32, len(split))
        self._learn_groups(self.groups.take())
        self.pairs.add(codes.reshape(-1, 2))
        self.stops.add(np.fromiter((c[-1:] in (b".", b"!", b"?") for c in stretches), bool, len(stretches)))

    def _taken(self, spans: np.ndarray) -> np.ndarray:
        """The ids of spans of ``flat``, one after the other."""
        sizes = spans[:, 1] - spans[:, 0]
        ends = np.cumsum(sizes)
        return self.flat.all[np.repeat(spans[:, 0] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]

    def encode(self, texts: list[bytes | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per text its ids with the end token, and the places after sentence ends."""
        if len(self.known) > CACHE:
            self._forget()
        special = [bool(t) and b"<|" in t for t in texts]  # may hold the name of a special token
        split = pc.ascii_split_whitespace(pa.array([b"" if s or not t else t for t, s in zip(texts, special)], pa.large_string()))
        words = split.flatten().dictionary_encode()
        stretches = words.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
        codes = np.fromiter(map(self.known.__getitem__, stretches), np.int32, len(stretches))
        if self.known.new:
            self._learn(self.known.take())
        # the ids of the distinct stretches, then those of all words
        spans = self.spans.all[self.pairs.all[codes].ravel()]
        flat, ends = self._taken(spans), np.cumsum((spans[:, 1] - spans[:, 0]).reshape(-1, 2).sum(1))
        stops, at = self.stops.all[codes], words.indices.to_numpy()
        starts = np.concatenate([[0], ends[:-1]])[:len(ends)]
        sizes = (ends - starts)[at]
        ends = np.cumsum(sizes)
        ids = flat[np.repeat(starts[at] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]
        after = ends[stop := np.flatnonzero(stops[at])]
        bounds = split.offsets.to_numpy()
        lows = np.concatenate([[0], ends])[bounds]
        marks = np.searchsorted(stop, bounds)
        end, out = np.array([END_ID], self.dtype), []
        for i, (text, whole) in enumerate(zip(texts, special)):
            if whole:
                found = self.tokenizer.encode(text.decode(), add_special_tokens=False).ids
                out.append((np.array([*found, END_ID], self.dtype), np.empty(0, np.int32)))
            else:
                out.append((np.concatenate([ids[lows[i]:lows[i + 1]], end]),
                            (after[marks[i]:marks[i + 1]] - lows[i]).astype(np.int32)))
        return out


def _tokenised(path: str):
    def run(batches):
        ids = Ids(path)
        for batch, texts in text_batches(batches):
            done = ids.encode(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([i.tobytes() for i, _ in done], pa.binary()),
                 pa.array([s.tobytes() for _, s in done], pa.binary()), pa.array([len(i) for i, _ in done], pa.int64())],
                ["doc_id", "ids", "stops", "n"])

    return run


# ------------------------------------------------------------ cuts
def best_cuts(places: list[int], penalties: list[int], length: int, open_end: bool = False) -> list[int]:
    """Places (a subset, first and last included) that cut the stream at least
    cost.  ``places`` ascend and no gap exceeds ``length``.  With ``open_end``
    the stream goes on, and the last cut is the cheapest of the last window."""
    n = len(places)
    cost, back = [0] * n, [0] * n
    at = {places[0]: 0}
    powers = [1 << k for k in range(length.bit_length()) if 1 << k <= length]
    queue = deque([0])  # cost + place ascends from head to tail
    rank = [places[0]] + [0] * (n - 1)
    for j in range(1, n):
        p = places[j]
        while places[queue[0]] < p - length:
            queue.popleft()
        best, low = queue[0], rank[queue[0]] + length - p
        for size in powers:
            i = at.get(p - size)
            if i is not None and cost[i] < low:
                best, low = i, cost[i]
        cost[j] = low + 1 + penalties[j]
        back[j] = best
        at[p] = j
        rank[j] = r = cost[j] + p
        while queue and rank[queue[-1]] > r:
            queue.pop()
        queue.append(j)
    j = n - 1
    if open_end:
        j = min((i for i in range(n) if places[i] > places[-1] - length), key=cost.__getitem__)
    out = [places[j]]
    while j:
        j = back[j]
        out.append(places[j])
    return out[::-1]


class _Stream:
    """Tokens of a block that no sequence holds yet."""

    def __init__(self, length: int, first_id: int) -> None:
        self.length, self.next_id, self.step = length, first_id, min(HARD_STEP, length)
        self.docs = deque()  # [doc_id, doc tokens, ids, place of its first id, next id not yet packed]
        self.places, self.penalties = [0], [0]
        self.end = 0

    def _cut_at(self, place: int, penalty: int) -> None:
        for p in range(self.places[-1] + self.step, place, self.step):
            self.places.append(p)
            self.penalties.append(HARD)
        if place > self.places[-1]:
            self.places.append(place)
            self.penalties.append(penalty)
        elif penalty < self.penalties[-1]:
            self.penalties[-1] = penalty

    def add(self, doc_id, ids: np.ndarray, stops: np.ndarray):
        start = self.end
        self.docs.append([doc_id, len(ids), ids, start, 0])
        for s in range(0, len(stops), STRETCH):
            for stop in stops[s:s + STRETCH].tolist():
                self._cut_at(start + stop, SENTENCE)
                if self.places[-1] - self.places[0] >= STRETCH:
                    yield from self.flush(False)
        while start + len(ids) - self.places[0] > 2 * STRETCH:
            self._cut_at(max(self.places[-1], self.places[0] + STRETCH), HARD)
            yield from self.flush(False)
        self.end = start + len(ids)
        self._cut_at(self.end, 0)
        if self.end - self.places[0] >= STRETCH:
            yield from self.flush(False)

    def flush(self, last: bool):
        """Pieces of the planned sequences; unless ``last``, those near the end
        are left to be planned again."""
        cuts = best_cuts(self.places, self.penalties, self.length, not last)
        if not last:
            cuts = [c for c in cuts if c <= self.places[-1] - TAIL * self.length] or cuts[:1]
        for a, b in zip(cuts, cuts[1:]):
            place = a
            while place < b:
                doc = self.docs[0]
                ids = doc[2][doc[4]:doc[4] + b - place]
                yield (doc[0], doc[4], len(ids), zlib.crc32(ids.astype("<u4").tobytes()), doc[1], self.next_id, place - a)
                doc[4] += len(ids)
                place += len(ids)
                if doc[4] == doc[1]:
                    self.docs.popleft()
            self.next_id += 1
        done = cuts[-1]
        keep = next(k for k, p in enumerate(self.places) if p >= done)
        self.places, self.penalties = self.places[keep:], self.penalties[keep:]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in _PIECES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)


def _packed(length: int, dtype):
    def run(batches):
        from pyspark import TaskContext
        stream, rows = _Stream(length, TaskContext.get().partitionId() * BLOCK_IDS), []
        for batch in batches:
            for doc_id, ids, stops in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), batch.column("stops")):
                rows.extend(stream.add(doc_id, np.frombuffer(ids.as_buffer(), dtype), np.frombuffer(stops.as_buffer(), np.int32)))
                if len(rows) >= 10_000:
                    yield _batch(rows)
                    rows = []
        if stream.end:
            rows.extend(stream.flush(True))
        if rows:
            yield _batch(rows)

    return run


def pack(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per piece of a document: doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset."""
    path = tokenizer or default_tokenizer()
    dtype = Ids(path).dtype
    rows = write_stage(docs.select(F.col("doc_id").cast("long"), "text")
                       .mapInArrow(_tokenised(path), "doc_id long, ids binary, stops binary, n long")
                       .withColumn("uid", F.monotonically_increasing_id()), "token_ids")
    total = rows.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-total // block_tokens))
    order = [F.asc_nulls_last("doc_id"), F.col("n"), F.xxhash64("ids"), F.col("uid")]
    return rows.repartitionByRange(int(blocks), *order).sortWithinPartitions(*order) \
        .select("doc_id", "ids", "stops").mapInArrow(_packed(length, dtype), _PIECES)
