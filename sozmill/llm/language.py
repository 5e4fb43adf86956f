"""Language identification by a string kernel.

The kernel of two texts is the number of byte n-grams of one to three bytes that
both have (presence, not counts), over the root of the product of what each has.
A few texts a language are landmarks (Nystroem); kernel ridge regression,
one language against the rest, is solved on them. Texts are scored in batches:
presence matrix x landmark matrix x weights.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from .common import as_bytes, lean, slices, with_fields

SIZES = (1, 2, 3)
BITS = 14  # n-grams are hashed into so many bits of presence
ROWS_AT_ONCE = 256
#: Bounds of the labelled sample: rows of each language (on average over hashes) and of all.
SAMPLE, SAMPLE_ROWS = 600, 12_000
LANDMARKS = 32  # of each language
RIDGE = 0.1
SHARPNESS = 6.0
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
_FOLD = np.array([i + 32 if 65 <= i <= 90 else i if 97 <= i <= 122 or i >= 128 else 32 for i in range(256)],
                 dtype=np.uint32)


def presence(column: pa.Array) -> np.ndarray:
    """Presence of the hashed n-grams in each value of a binary column, as 0 and 1.

    ASCII letters are lower-cased, all else in ASCII is a space. Each value is
    read whole.
    """
    out = np.zeros((len(column), 1 << BITS), dtype=np.uint8)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)[offsets[0]:offsets[-1]]
    folded = _FOLD[data]
    lengths = np.diff(offsets)
    row = np.repeat(np.arange(len(column), dtype=np.int64), lengths)
    left = np.repeat(offsets[1:] - offsets[0], lengths) - np.arange(len(data))  # bytes to the end of the row
    value = np.zeros(len(data), dtype=np.uint32)
    for size in SIZES:
        value = value[: len(data) - size + 1] * np.uint32(257) + folded[size - 1:]
        if not len(value):
            break
        hashed = (value * np.uint32(2654435761) + np.uint32(size * 97)) >> np.uint32(32 - BITS)
        fits = left[: len(value)] >= size
        out.reshape(-1)[(row[: len(value)][fits] << BITS) + hashed[fits]] = 1
    return out


def has_letter(value: bytes) -> bool:
    return bool(_LETTER.search(value.decode()))


@dataclass
class LanguageModel:
    """Landmarks and weights: ``presence @ landmarks``, scaled, ``@ weights``."""

    languages: list[str]
    landmarks: np.ndarray  # hashed n-grams x landmarks
    weights: np.ndarray  # landmarks x languages
    bias: np.ndarray

    def scores(self, seen: np.ndarray) -> np.ndarray:
        """Decision values of a batch of presence rows."""
        return kernel(seen, self.landmarks) @ self.weights + self.bias


def kernel(seen: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    seen = seen.astype(np.float32)
    own = np.sqrt(np.maximum(seen.sum(axis=1), 1))
    theirs = np.sqrt(np.maximum(landmarks.sum(axis=0), 1))
    return (seen @ landmarks) / own[:, None] / theirs


def labelled_sample(docs: DataFrame, text: str, lang: str, key: str) -> DataFrame:
    """About ``SAMPLE`` rows of each language, by a hash of key and text: ``lang, place, seen``.

    ``seen`` are the packed presence bits of the whole text. A language takes
    the hashes below its share, so nothing is sorted or gathered; repeated rows
    count once. The shares are a row for each language, ``SAMPLE_ROWS`` at most.
    """
    place = F.xxhash64(F.col(key).cast("string"), F.col(text))
    some = docs.select(F.col(lang).alias("lang"), place.alias("place"), F.col(text).alias("text")).filter(
        F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}"))
    counts = some.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.desc("n"), "lang").limit(SAMPLE_ROWS).collect()
    wanted = min(SAMPLE, SAMPLE_ROWS // max(1, len(counts)))
    shares = docs.sparkSession.createDataFrame(
        [(row.lang, 2.0 ** 63 * min(1, wanted / row.n) - 2.0 ** 62) for row in counts],
        "lang string, last double")
    near = some.join(F.broadcast(shares), "lang").filter(F.shiftright("place", 1) <= F.col("last"))
    distinct = near.dropDuplicates(["lang", "place"]).select("lang", "place", "text")

    def run(batches):
        for batch in batches:
            column = as_bytes(batch.column(2))
            for a, b in _blocks(column):
                bits = np.packbits(presence(column.slice(a, b - a)), axis=1)
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([x.tobytes() for x in bits], pa.binary())],
                    ["lang", "place", "seen"])

    return distinct.mapInArrow(lean(run), "lang string, place long, seen binary")


def _blocks(column: pa.Array):
    for a, b in slices(column):
        for i in range(a, b, ROWS_AT_ONCE):
            yield i, min(b, i + ROWS_AT_ONCE)


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> LanguageModel | None:
    """The model of the labelled rows of ``docs``; None if none has a language and a letter.

    Fitted on about ``SAMPLE`` rows of each language, ``SAMPLE_ROWS`` of all, which
    the driver holds as bits (2 KB a row). Ties in the hash go by the content.
    """
    rows = sorted(labelled_sample(docs, text, lang, key).collect(), key=lambda r: (r.lang, r.place, r.seen))
    if not rows:
        return None
    languages = sorted({r.lang for r in rows})
    label = np.array([languages.index(r.lang) for r in rows])
    seen = np.unpackbits(np.frombuffer(b"".join(r.seen for r in rows), dtype=np.uint8)).reshape(len(rows), -1)
    chosen = np.concatenate([np.flatnonzero(label == i)[:LANDMARKS] for i in range(len(languages))])
    landmarks = seen[chosen].T.astype(np.float32)
    values, vectors = np.linalg.eigh(kernel(seen[chosen], landmarks).astype(np.float64))
    useful = values > 1e-6 * values.max()
    root = vectors[:, useful] / np.sqrt(values[useful])
    features = kernel(seen, landmarks) @ root
    # Languages weigh the same, however many rows they have.
    weight = 1 / np.bincount(label)[label]
    target = (label[:, None] == np.arange(len(languages))) * 2.0 - 1
    middle, bias = np.average(features, axis=0, weights=weight), np.average(target, axis=0, weights=weight)
    centred = (features - middle) * np.sqrt(weight)[:, None]
    gram = centred.T @ centred + RIDGE / len(rows) * np.eye(centred.shape[1])
    solved = np.linalg.solve(gram, centred.T @ ((target - bias) * np.sqrt(weight)[:, None]))
    return LanguageModel(languages, landmarks, (root @ solved).astype(np.float32),
                         (bias - middle @ solved).astype(np.float32))


def predict(docs: DataFrame, model: LanguageModel | None, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with ``lang_pred`` and ``score``, 0 to 1.

    ``und`` and 0 where the text is null or has no letter, and everywhere without a
    model. Only the text is looked at. Equal decision values take the language
    that comes first. Columns of these names are replaced.
    """
    docs = docs.drop("lang_pred", "score")
    others = [c for c in docs.columns if c != text]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        known = shared.value
        for batch in batches:
            column = as_bytes(batch.column(text))
            names, scores = [], []
            for a, b in _blocks(column):
                part = column.slice(a, b - a)
                letters = np.array([has_letter(x.as_py()) for x in part])
                if known is None or not letters.any():
                    names += [UNKNOWN] * (b - a)
                    scores += [0.0] * (b - a)
                    continue
                values = known.scores(presence(part)).astype(np.float64)
                best = values.argmax(axis=1)
                chance = 1 / np.exp(SHARPNESS * (values - values.max(axis=1, keepdims=True))).sum(axis=1)
                names += [known.languages[i] if ok else UNKNOWN for i, ok in zip(best, letters)]
                scores += np.where(letters, chance, 0.0).tolist()
            batch = batch.drop_columns([text])
            batch = batch.append_column("lang_pred", pa.array(names, pa.string()))
            yield batch.append_column("score", pa.array(scores, pa.float64()))

    return docs.select(*others, text).mapInArrow(
        lean(run), with_fields(docs.select(*others), "lang_pred string, score double"))
