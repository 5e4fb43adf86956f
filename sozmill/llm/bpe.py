"""Byte-level BPE with a segment tree over byte positions.

Each match of the split pattern is encoded on its own. Its bytes are the leaves
of a tree whose root is the leftmost pair of least rank; a merge touches the
pair of the grown part and that of its left neighbour, so it costs a logarithm
of the match's length. Matches of any length, a text without a space included,
thus take ``n log n`` time. Short matches of a batch are merged together, each
with a tree of its own in one row of a matrix.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import as_bytes, lean, slices, with_fields

# Matches that were encoded are kept up to twice this many, for each task.
CACHE_ENTRIES = 1 << 17
# Matches of up to so many bytes are merged in batches.
WIDTHS = (8, 16, 32)
# Longer texts are split piece by piece, not into one list.
LIST_CHARS = 1 << 19
PIECES_AT_ONCE = 1 << 15
NONE = 1 << 62
_EMPTY = np.zeros(0, dtype=np.int32)


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as file:
        lines = (line.split() for line in file)
        return {base64.b64decode(token): int(rank) for token, rank in filter(None, lines)}


def encode_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one match. A match that is a token itself is that token."""
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    size = 1 << (n - 1).bit_length()
    parts = [piece[i:i + 1] for i in range(n)]
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    # A node holds rank * size + position, so the least node is the leftmost of least rank.
    tree = [NONE] * (2 * size)
    find = ranks.get
    for i in range(n - 1):
        rank = find(piece[i:i + 2])
        if rank is not None:
            tree[size + i] = rank * size + i
    for node in range(size - 1, 0, -1):
        left, right = tree[2 * node], tree[2 * node + 1]
        tree[node] = left if left < right else right

    while tree[1] != NONE:
        at = tree[1] % size
        gone, left = after[at], before[at]
        right = after[at] = after[gone]
        part = parts[at] = parts[at] + parts[gone]
        parts[gone] = None
        # The leaves of the grown part, of the part that is gone and of the left neighbour.
        value = NONE
        if right < n:
            before[right] = at
            rank = find(part + parts[right])
            if rank is not None:
                value = rank * size + at
        changed = [(size + gone, NONE), (size + at, value)]
        if left >= 0:
            rank = find(parts[left] + part)
            changed.append((size + left, NONE if rank is None else rank * size + left))
        for node, value in changed:
            if tree[node] == value:
                continue
            tree[node] = value
            while node > 1:
                other = tree[node ^ 1]
                if other < value:
                    value = other
                node >>= 1
                if tree[node] == value:
                    break
                tree[node] = value
    return [ranks[part] for part in parts if part is not None]


class PairRanks:
    """Rank of two tokens joined, for arrays of tokens: buckets of a hash, searched in step."""

    BITS = 20

    def __init__(self, ranks: dict[bytes, int]):
        found = [(ranks[token[:i]] << 32 | ranks[token[i:]], rank) for token, rank in ranks.items()
                 for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks]
        keys, values = np.array(found, dtype=np.int64).reshape(-1, 2).T
        bucket = self._bucket(keys)
        order = np.argsort(bucket, kind="stable")
        self.keys, self.values = keys[order], values[order]
        self.starts = np.searchsorted(bucket[order], np.arange((1 << self.BITS) + 1))

    def _bucket(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.BITS)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks, -1 where two tokens make none."""
        keys = left << 32 | right
        bucket = self._bucket(keys)
        at, end = self.starts[bucket], self.starts[bucket + 1]
        out = np.full(len(keys), -1, dtype=np.int64)
        rows = np.flatnonzero(at < end)
        while len(rows):
            hit = self.keys[at[rows]] == keys[rows]
            out[rows[hit]] = self.values[at[rows[hit]]]
            rows = rows[~hit]
            at[rows] += 1
            rows = rows[at[rows] < end[rows]]
        return out


def encode_short(pieces: list[bytes], width: int, single: np.ndarray, pairs: PairRanks) -> list[bytes]:
    """``encode_piece`` of many matches of at most ``width`` bytes that are no tokens themselves.

    ``width`` is a power of two and the number of leaves of each tree. Ids are
    given as the bytes of 32-bit numbers.
    """
    count = len(pieces)
    length = np.array([len(p) for p in pieces])
    raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), dtype=np.uint8)
    parts = single[raw].reshape(count, width)
    place = np.arange(width)
    alive = place < length[:, None]
    after = np.tile(place + 1, (count, 1))
    before = np.tile(place - 1, (count, 1))
    tree = np.full((count, 2 * width), NONE, dtype=np.int64)
    row, at = np.nonzero(place < length[:, None] - 1)
    rank = pairs.find(parts[row, at], parts[row, at + 1])
    tree[row, width + at] = np.where(rank < 0, NONE, rank * width + at)
    for node in range(width - 1, 0, -1):
        np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1], out=tree[:, node])
    rows = np.flatnonzero(tree[:, 1] != NONE)
    while len(rows):
        part, at = np.divmod(tree[rows, 1], width)
        gone, left = after[rows, at], before[rows, at]
        right = after[rows, gone]
        parts[rows, at] = part
        alive[rows, gone] = False
        after[rows, at] = right
        tree[rows, width + gone] = NONE
        tree[rows, width + at] = NONE
        more = right < length[rows]
        r, i, j = rows[more], at[more], right[more]
        before[r, j] = i
        rank = pairs.find(part[more], parts[r, j])
        tree[r, width + i] = np.where(rank < 0, NONE, rank * width + i)
        more = left >= 0
        r, i = rows[more], left[more]
        rank = pairs.find(parts[r, i], part[more])
        tree[r, width + i] = np.where(rank < 0, NONE, rank * width + i)
        nodes = [width + gone, width + at, width + np.maximum(left, 0)]
        while nodes[0][0] > 1:
            nodes = [node >> 1 for node in nodes]
            for node in nodes:
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
        rows = rows[tree[rows, 1] != NONE]
    ids = parts[alive].astype(np.int32).tobytes()
    ends = (4 * np.cumsum(alive.sum(axis=1))).tolist()
    return [ids[i:j] for i, j in zip([0, *ends], ends)]


class Known(dict):
    """Matches and their ids as the bytes of 32-bit numbers; long ones are encoded at each look."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks

    def __missing__(self, piece: str) -> bytes:
        return np.array(encode_piece(piece.encode(), self.ranks), dtype=np.int32).tobytes()


class Codec:
    """Encoder and decoder for one rank file and split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.tokens = {rank: token for token, rank in ranks.items()}
        # The last matches, and those before them: what is still in use moves over.
        self.pairs = PairRanks(ranks)
        self.single = np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int64)
        self.known = Known(ranks)
        self.older = Known(ranks)

    def pieces(self, text: str) -> Iterator[list[str]]:
        if len(text) <= LIST_CHARS:
            yield self.pattern.findall(text)
            return
        found = (match.group() for match in self.pattern.finditer(text))
        while part := list(islice(found, PIECES_AT_ONCE)):
            yield part

    def encode(self, text: str) -> Iterator[np.ndarray]:
        """Token ids of a text, in arrays of bounded length where the text is long."""
        for part in self.pieces(text):
            self.learn(part)
            yield self.encode_known(part)

    def encode_known(self, part: list[str]) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.known.__getitem__, part)), dtype=np.int32)

    def learn(self, part: list[str]) -> None:
        """Encode the short matches of ``part`` that aren't known yet."""
        new = set(part).difference(self.known)
        if not new:
            return
        if len(self.known) + len(new) > CACHE_ENTRIES:
            self.known, self.older = Known(self.ranks), self.known
            new = set(part)
        groups = {width: [] for width in WIDTHS}
        for piece in new:
            found = self.older.get(piece)
            if found is None:
                raw = piece.encode()
                whole = self.ranks.get(raw)
                if whole is None:
                    for width in WIDTHS:
                        if len(raw) <= width:
                            groups[width].append((piece, raw))
                            break
                    continue
                found = np.int32(whole).tobytes()
            self.known[piece] = found
        for width, group in groups.items():
            if group:
                names, raws = zip(*group)
                self.known.update(zip(names, encode_short(raws, width, self.single, self.pairs)))

    def encode_all(self, column: pa.Array) -> Iterator[Iterable[np.ndarray]]:
        """``encode`` of each value of a binary column; new matches of a slice are merged together."""
        for a, b in slices(column, LIST_CHARS):
            texts = [value.as_py().decode() for value in column.slice(a, b - a)]
            if b - a == 1:
                yield self.encode(texts[0])
                continue
            parts = [self.pattern.findall(text) for text in texts]
            self.learn(list(chain.from_iterable(parts)))
            for part in parts:
                yield [self.encode_known(part)]

    def forget(self) -> None:
        """Leave nothing but the ranks in a worker that waits for another task."""
        self.known, self.older = Known(self.ranks), Known(self.ranks)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The codec of a rank file; made once for each Python worker."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(load_ranks(path), pattern)
    return _codecs[path, pattern]


def encode(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``df`` with ``token_ids array<int>`` in place of the column ``text``; null is empty.

    ``path`` must be readable on every executor, as an installed package's files are.
    """
    def run(batches):
        coder = codec(path, pattern)
        for batch in batches:
            ids = pa.array([np.concatenate([_EMPTY, *parts]) for parts in coder.encode_all(
                as_bytes(batch.column(text)))], pa.list_(pa.int32()))
            yield batch.drop_columns([text]).append_column("token_ids", ids)
        coder.forget()

    others = df.drop(text, "token_ids")
    return df.select(*others.columns, text).mapInArrow(
        lean(run), with_fields(others, "token_ids array<int>"))


def decode(df: DataFrame, path: str, pattern: str, ids: str = "token_ids") -> DataFrame:
    """``df`` with ``decoded binary``, the bytes of the column ``ids``, in its place."""
    def run(batches):
        coder = codec(path, pattern)
        for batch in batches:
            found = pa.array([coder.decode(i.as_py() or []) for i in batch.column(ids)], pa.binary())
            yield batch.drop_columns([ids]).append_column("decoded", found)

    others = df.drop(ids, "decoded")
    return df.select(*others.columns, ids).mapInArrow(lean(run), with_fields(others, "decoded binary"))


_round_trip_of = ("n_tokens", "ids_sha256", "decoded_sha256")


def round_trip(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``df`` without ``text``, with the digests of its ids and of the bytes decoded from them.

    Ids are hashed as they are made, so a text of any length is held as text
    only. Null is an empty text: no tokens and the digests of nothing.
    Repeated rows stay repeated; columns of the names given here are replaced.
    """
    def one(coder: Codec, parts: Iterable[np.ndarray]) -> tuple[int, str, str]:
        count, ids_hash, bytes_hash = 0, hashlib.sha256(), hashlib.sha256()
        for ids in map(np.ndarray.tolist, parts):
            if ids:
                ids_hash.update((b"," if count else b"") + str(ids)[1:-1].replace(" ", "").encode())
            bytes_hash.update(coder.decode(ids))
            count += len(ids)
        return count, ids_hash.hexdigest(), bytes_hash.hexdigest()

    def run(batches):
        coder = codec(path, pattern)
        for batch in batches:
            rows = [one(coder, parts) for parts in coder.encode_all(as_bytes(batch.column(text)))]
            batch = batch.drop_columns([text])
            kinds = (pa.int64(), pa.string(), pa.string())
            for i, (name, kind) in enumerate(zip(_round_trip_of, kinds)):
                batch = batch.append_column(name, pa.array([r[i] for r in rows], kind))
            yield batch
        coder.forget()

    others = df.drop(text, *_round_trip_of)
    return df.select(*others.columns, text).mapInArrow(lean(run), with_fields(
        others, "n_tokens long, ids_sha256 string, decoded_sha256 string"))
