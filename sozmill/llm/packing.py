"""Packing of token sequences by a configuration linear program.

Documents become token ids and an end id; only longer ones than a sequence are
cut. The pieces' lengths make a histogram of at most ``size`` entries, all that the
driver sees. A configuration is a multiset of lengths that fits into one
sequence. The program, to cover the histogram with the fewest configurations,
is solved by multiplicative weights: a length's price falls as it is covered, and a
knapsack over the prices, by dynamic programming, gives the next configuration.
The solution is rounded down; the few pieces that are left are placed by best fit
in decreasing order, also on the histogram. Every place in the plan gets one piece
of its length, so no sequence has a gap.

Null and empty texts are one piece, the end id alone. Texts are tokenised whole.
Repeated rows are packed as many times. An empty table gives no row. Only the named
columns are read.
"""

from __future__ import annotations

import itertools
import os
import re
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import lean, slices, stored
from .sharding import numbered

#: A slice of texts that is tokenised at once, words that the library gets at once, and how many are remembered.
SLICE_BYTES, WORDS_AT_ONCE, KNOWN_WORDS = 4 << 20, 128, 250_000
#: Words of Latin-1 letters, perhaps with a mark after them: their normal form is their lower case.
_LATIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,;:!?]?)").fullmatch
#: Stands between words that are encoded together.
MARK = "\x01"
#: Rounds of the solver; each adds a configuration for a length at most.
ROUNDS = 40
#: How fast prices fall, the share of a length's need that a round covers, and what long pieces are worth more.
RATE, STEP, LONG = 1.0, 0.5, 0.2
#: A round takes configurations that are as full as this share of its fullest.
FULL = 0.999
# Characters that byte-level vocabularies have for bytes: printable ones stand for themselves, others follow.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_CHARACTERS = {b: chr(b) for b in _PRINTED} | {
    b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}
PIECES = "piece int, start long, length long, ids binary"


class Encoder:
    """Token ids of texts, word by word, for a vocabulary that never looks across white space.

    Each distinct word between ASCII white space is encoded by the library, once while it
    is remembered; a text's ids are its words' one after the other. Both its
    normalization and its splits leave such words apart. The words met last are remembered, a bounded number.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        self.model = self.tokenizer.model
        self.tails = {c: np.array(self.tokenizer.encode(c, add_special_tokens=False).ids, "<u4").tobytes()
                      for c in ["", *".,;:!?"]}

    def _learn(self, words: list[str]) -> list[bytes]:
        """The ids of each word. Words with the mark, if any, go alone; else it tells the words of a line apart."""
        if self.mark is None or any(MARK in w for w in words):
            found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
            return [np.array(f.ids, "<u4").tobytes() for f in found]
        ids = np.array(self.tokenizer.encode_batch_fast(
            [f" {MARK} ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        cuts = np.flatnonzero(ids == self.mark).tolist()
        raw = ids.tobytes()
        return [raw[4 * low:4 * high] for low, high in zip([0, *(c + 1 for c in cuts)], [*cuts, len(ids)])]

    def _plain(self, word: str) -> bytes:
        """The ids of a lower-case Latin word, which is one piece for the model, as its bytes' characters."""
        form = word if word.isascii() else word.encode().decode("latin-1").translate(_BYTE_CHARACTERS)
        return array("I", [token.id for token in self.model.tokenize(form)]).tobytes()

    def _ids(self, words: list[str]) -> list[bytes]:
        known, older = self.known, self.older
        new = []
        for word in itertools.filterfalse(known.__contains__, words):
            if word in older:
                known[word] = older[word]
                continue
            latin = _LATIN(word)
            if latin is None:
                new.append(word)
                continue
            # Such a word has one lower-case form, and the mark after it is a token of its own.
            base, tail = latin[1].lower(), self.tails[latin[2]]
            ids = known.get(base) or older.get(base) or self._plain(base)
            known[base] = ids
            known[word] = ids + tail
        for start in range(0, len(new), WORDS_AT_ONCE):
            some = new[start:start + WORDS_AT_ONCE]
            known.update(zip(some, self._learn(some)))
        out = list(map(known.__getitem__, words))
        if len(known) > KNOWN_WORDS:
            # The larger of these was needed for one slice only.
            self.known, self.older = {}, known if len(known) < 2 * KNOWN_WORDS else {}
        return out

    def __call__(self, texts: pa.Array) -> list[bytes]:
        """Little-endian 32-bit ids of each text of a string array without nulls."""
        lists = pc.ascii_split_whitespace(texts)
        words = lists.flatten().dictionary_encode()
        ids = pa.array(self._ids(words.dictionary.to_pylist()), pa.large_binary()).take(words.indices)
        if not len(ids):
            return [b""] * len(texts)
        ends = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset:ids.offset + len(ids) + 1]
        cuts = ends[lists.offsets.to_numpy()].tolist()
        raw = memoryview(ids.buffers()[2] or b"")
        return [bytes(raw[low:high]) for low, high in zip(cuts, cuts[1:])]


def pieces(docs: DataFrame, id: str, text: str, vocabulary: str, size: int, end: int) -> DataFrame:
    """``id, piece, start, length, ids`` of every document; ``ids`` are little-endian unsigned 32-bit."""
    content = open(vocabulary, encoding="utf-8").read()
    shared = docs.sparkSession.sparkContext.broadcast(content)  # a vocabulary file

    def run(batches):
        encode, last = Encoder(shared.value), np.array([end], "<u4").tobytes()
        types = (pa.int32(), pa.int64(), pa.int64(), pa.binary())
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            for low, high in slices(texts, SLICE_BYTES):
                rows, columns = [], ([], [], [], [])
                for i, ids in enumerate(encode(texts.slice(low, high - low)), low):
                    ids += last
                    for piece, start in enumerate(range(0, len(ids) // 4, size)):
                        part = ids[4 * start:4 * (start + size)]
                        rows.append(i)
                        for column, value in zip(columns, (piece, start, len(part) // 4, part)):
                            column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows))] + [pa.array(c, t) for c, t in zip(columns, types)],
                    names=["id", "piece", "start", "length", "ids"])

    kind = docs.schema[id].dataType.simpleString()
    return docs.select(F.col(id).alias("id"), F.col(text).alias("text")).mapInArrow(
        lean(run), f"id {kind}, {PIECES}")


def knapsack(price: np.ndarray, lengths: np.ndarray, size: int) -> np.ndarray:
    """By room up to ``size``: the length to take first for the greatest sum of prices, 0 for none.

    The dynamic program lets a length be taken again and again. Of equal sums the longer length is taken.
    """
    best, taken = np.zeros(size + 1), np.zeros(size + 1, np.int64)
    longest = lengths[::-1]
    prices = price[longest]
    for room in range(1, size + 1):
        first = len(longest) - np.searchsorted(lengths, room, "right")
        best[room], taken[room] = best[room - 1], taken[room - 1]
        if first < len(longest):
            value = prices[first:] + best[room - longest[first:]]
            k = int(value.argmax())
            if value[k] >= best[room]:
                best[room], taken[room] = value[k], longest[first + k]
    return taken


def solve(histogram: np.ndarray, size: int, rounds: int = ROUNDS) -> dict[tuple[int, ...], float]:
    """Configurations and their fractional numbers, by multiplicative weights.

    Prices start just above proportion to the length, the best ones if sequences can be
    filled, and fall by ``exp(-RATE * covered share)``. One program prices the best
    filling of every room, so a round gets the best configuration around each length
    and covers ``STEP`` of what that length still needs, as far as the others' needs go.
    """
    total = histogram.astype(np.float64)
    need = total.copy()
    share = np.arange(len(total)) / size
    out: dict[tuple[int, ...], float] = {}
    for _ in range(rounds):
        need[need < 1e-3] = 0
        lengths = np.flatnonzero(need)
        if not len(lengths):
            break
        price = share * (1 + LONG * share) * np.exp(-RATE * (1 - need / np.maximum(total, 1)))
        taken = knapsack(price, lengths, size)
        step, made = np.minimum(need, np.maximum(STEP * need, STEP)), []
        for length in lengths[::-1].tolist():
            found, room = [length], size - length
            while room > 0 and taken[room]:
                found.append(int(taken[room]))
                room -= found[-1]
            made.append((size - room, length, found))
        fullest = max(m[0] for m in made)
        for filled, length, found in made:
            values, times = np.unique(found, return_counts=True)
            number = min(step[length] / found.count(length), float(np.min(need[values] / times)))
            if number > 1e-6 and filled >= FULL * fullest:
                need[values] -= number * times
                key = tuple(sorted(found, reverse=True))
                out[key] = out.get(key, 0.0) + number
    return out


def best_fit(histogram: np.ndarray, size: int) -> list[tuple[list[int], int]]:
    """Best fit in decreasing order of all pieces, on the histogram.

    A sequence is filled by the longest pieces that still fit, and is repeated as
    often as its lengths last, so there are no more kinds of sequences than lengths.
    """
    left, out = histogram.copy(), []
    while left.any():
        found, room = [], size
        rest = left.copy()
        while True:
            fit = np.flatnonzero(rest[:room + 1])
            if not len(fit):
                break
            length = int(fit[-1])
            take = min(int(rest[length]), room // length)
            found += [length] * take
            rest[length] -= take
            room -= take * length
        lengths, times = np.unique(found, return_counts=True)
        number = int(np.min(left[lengths] // times))
        left[lengths] -= number * times
        out.append((found, number))
    return out


@dataclass
class Plan:
    """Kinds of sequences: lengths in order, and how many; ``least`` is a bound no packing is below."""

    kinds: list[tuple[list[int], int]]
    least: int

    @property
    def sequences(self) -> int:
        return sum(n for _, n in self.kinds)


def plan(histogram: np.ndarray, size: int, rounds: int = ROUNDS) -> Plan:
    """A packing of the histogram (pieces by length, from 0) into few sequences."""
    left = histogram.astype(np.int64).copy()
    kinds: list[tuple[list[int], int]] = [([size], int(left[size]))] if left[size] else []
    left[size] = 0
    for lengths, number in solve(left, size, rounds).items():
        values, times = np.unique(lengths, return_counts=True)
        whole = min(int(number + 1e-6), int(np.min(left[values] // times)))
        if whole:
            left[values] -= whole * times
            kinds.append((list(lengths), whole))
    kinds += best_fit(left, size)
    counts = histogram.astype(np.int64)
    half = int(counts[size // 2 + 1:].sum())  # no two of these share a sequence
    return Plan(kinds, max(half, -(-int((counts * np.arange(size + 1)).sum()) // size)))


class Places:
    """For every length, the places of the plan in order: the ``r``-th piece of a length has the ``r``-th."""

    def __init__(self, made: Plan):
        rows, base = [], 0
        for lengths, number in made.kinds:
            offset, i = 0, 0
            while i < len(lengths):
                same = lengths.count(lengths[i])
                rows.append((lengths[i], number * same, number, base, offset))
                offset, i = offset + same * lengths[i], i + same
            base += number
        rows.sort(key=lambda r: r[0])
        table = np.array(rows, np.int64).reshape(-1, 5)
        self.length, pieces, self.number, self.base, self.offset = table.T
        before = np.cumsum(pieces) - pieces
        first = np.searchsorted(self.length, self.length)
        self.rank = before - (before[first] if len(before) else before)
        self.key = (self.length << 44) + self.rank

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequences and offsets of the pieces of these lengths and ranks."""
        at = np.searchsorted(self.key, (length << 44) + rank, "right") - 1
        turn, which = np.divmod(rank - self.rank[at], self.number[at])
        return self.base[at] + which, self.offset[at] + turn * length


def histogram(found: DataFrame, size: int) -> np.ndarray:
    """Pieces by length; ``size`` rows at most reach the driver."""
    out = np.zeros(size + 1, np.int64)
    for length, count in found.groupBy("length").agg(F.count(F.lit(1))).collect():
        out[length] = count
    return out


def placed(found: DataFrame, size: int, row: str, rounds: int = ROUNDS) -> tuple[DataFrame, Plan]:
    """Stored pieces with ``sequence_id`` and ``offset``, and the plan.

    ``row`` numbers the pieces uniquely. Pieces of a length are numbered in buckets
    of bounded size, however many they are; the plan, which is bounded by ``size`` and
    ``rounds``, goes to the tasks. Columns that aren't needed aren't read.
    """
    made = plan(histogram(found, size), size, rounds)
    shared = found.sparkSession.sparkContext.broadcast(Places(made))

    @F.arrow_udf("struct<sequence_id:long,offset:long>")
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        sequence, offset = shared.value.of(length.to_numpy(), rank.to_numpy())
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(offset)], ["sequence_id", "offset"])

    ranked = numbered(found, "length", row, "__rank").withColumn("__at", place("length", "__rank"))
    return ranked.select(*found.columns, "__at.*"), made


def pack(docs: DataFrame, vocabulary: str, size: int, end: int, id: str = "doc_id", text: str = "text",
         carry=None) -> DataFrame:
    """Every piece with its ids, its sequence and its offset there: the training sequences, by piece.

    ``carry`` may project the stored pieces to what is to be shuffled with them; it
    keeps ``row`` and ``length``.
    """
    found = stored(pieces(docs, id, text, vocabulary, size, end).withColumn(
        "row", F.monotonically_increasing_id()))
    return placed(carry(found) if carry else found, size, "row")[0].drop("row").withColumnRenamed("id", id)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids`` of whole sequences, their pieces one after the other; a row is one sequence."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts["ids"], F.lit(b""), lambda all, one: F.concat(all, one))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))
