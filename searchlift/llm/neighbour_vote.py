"""Quality classifier by nearest-neighbour voting among labelled latent-semantic vectors.

A text is a bag of terms: its pairs of bytes, the shapes of its words, and how much of it repeats itself. Terms are
hashed to TERMS places and weighted by their rarity among the labelled texts; a truncated singular value
decomposition (randomised, seeded) of the labelled texts turns bags into vectors of DIMENSIONS numbers. The labelled
vectors, at most `sample` of them, are broadcast, and every document meets all of them in blocks of exact cosine products.
The NEIGHBOURS nearest labelled texts (with all that tie with the last) vote, weighted by a power of their similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchlift.llm.hashing import chunks, shingles, text_bytes, word_hashes, word_spans
from searchlift.llm.tables import small_batches

#: Labelled rows that the classifier is fitted on, at most; the rows with the least hash of doc_id are taken.
SAMPLE = 4096
#: Places for pairs of bytes; shapes and repeats have places of their own behind.
TERMS = 1024
DIMENSIONS = 48
NEIGHBOURS = 25
SHARPNESS = 4
#: Similarities are compared after rounding, so that the order of sums in a product doesn't matter.
PLACES = 5
_SHAPES = 32
_REPEATS = 2
WIDTH = TERMS + _SHAPES + _REPEATS
#: How much shapes and repeats count beside pairs of bytes.
_EMPHASIS = 2.0

_KINDS = np.zeros(256, dtype=np.uint8)  # bits of a word's shape: lower case, upper case, digit, other sign, beyond ASCII
_KINDS[33:127] = 8
_KINDS[list(b".,;:'-")] = 0
_KINDS[97:123], _KINDS[65:91], _KINDS[48:58], _KINDS[128:] = 1, 2, 4, 16


def term_shares(column: pa.Array | pa.ChunkedArray) -> Iterator[np.ndarray]:
    """Blocks of rows of term shares (float32, WIDTH columns), one row for each text in order; no text has no share."""
    data, offsets = text_bytes(column)
    for first, last in chunks(offsets):
        part, at = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        n, sizes = last - first, np.diff(at)
        out = np.zeros((n, WIDTH), dtype=np.float32)
        if len(part):
            row = np.repeat(np.arange(n), sizes)
            pair = (part[:-1].astype(np.uint32) << np.uint32(8)) | part[1:]
            inside = row[:-1] == row[1:]
            place = (pair * np.uint32(2654435769)) >> np.uint32(32 - TERMS.bit_length() + 1)
            flat = np.bincount((row[:-1] * TERMS + place)[inside], minlength=n * TERMS).reshape(n, TERMS)
            out[:, :TERMS] = flat / np.maximum(sizes - 1, 1)[:, None]
            starts, ends, bounds = word_spans(part, at)
            words = np.diff(bounds)
            if len(starts):
                shape = np.bitwise_or.reduceat(_KINDS[part], starts)  # up to the next word; white space adds no bit
                owner = np.repeat(np.arange(n), words)
                shapes = np.bincount(owner * _SHAPES + shape, minlength=n * _SHAPES).reshape(n, _SHAPES)
                out[:, TERMS : TERMS + _SHAPES] = shapes / np.maximum(words, 1)[:, None]
                hashes = word_hashes(part, starts, ends)
                again = np.r_[False, (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])]
                out[:, TERMS + _SHAPES] = np.bincount(owner, weights=again, minlength=n) / np.maximum(words, 1)
                runs, begin = shingles(hashes, bounds, 3)
                for k in np.flatnonzero(np.diff(begin) > 1):
                    own = runs[begin[k] : begin[k + 1]]
                    out[k, TERMS + _SHAPES + 1] = 1 - len(np.unique(own)) / len(own)
        yield out


@dataclass
class Model:
    """The projection to vectors, and the labelled vectors with their labels."""

    weights: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def project(self, shares: np.ndarray) -> np.ndarray:
        return _unit(_unit(np.sqrt(shares) * self.weights) @ self.axes)

    def score(self, shares: np.ndarray) -> np.ndarray:
        """Share of label 1 among the neighbours, by weight; the labels' mean for a text without terms."""
        out = np.full(len(shares), self.prior)
        if not len(self.labels):
            return out
        vectors = self.project(shares)
        k = min(NEIGHBOURS, len(self.labels))
        for a in range(0, len(shares), 256):
            near = np.round((vectors[a : a + 256] @ self.vectors.T).astype(np.float64), PLACES)
            least = np.partition(near, len(self.labels) - k, axis=1)[:, len(self.labels) - k]
            weight = np.where(near >= least[:, None], np.maximum(near, 0) ** SHARPNESS, 0)
            total = weight.sum(axis=1)
            some = total > 0
            out[a : a + 256][some] = (weight @ self.labels)[some] / total[some]
        return np.clip(out, 0, 1)


def _unit(x: np.ndarray) -> np.ndarray:
    length = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return np.divide(x, length, out=np.zeros_like(x), where=length > 0)


def fit(shares: np.ndarray, labels: np.ndarray) -> Model:
    """A model of labelled texts, in the order given."""
    n = len(shares)
    held = (shares > 0).sum(axis=0)
    weights = (np.log((n + 1) / (held + 1)) + 1).astype(np.float32)
    weights[TERMS:] *= _EMPHASIS
    x = _unit(np.sqrt(shares) * weights)
    size = min(DIMENSIONS, n, WIDTH)
    random = np.random.default_rng(7).standard_normal((WIDTH, min(WIDTH, size + 16))).astype(np.float32)
    basis = x @ random
    for _ in range(3):
        basis = x @ (x.T @ np.linalg.qr(basis)[0]) if n else basis
    axes = np.linalg.svd(np.linalg.qr(basis)[0].T @ x, full_matrices=False)[2][:size].T if n else np.zeros((WIDTH, 0), np.float32)
    model = Model(weights, np.ascontiguousarray(axes, dtype=np.float32), np.zeros((0, 0)), np.zeros(0), float(labels.mean()) if n else 0.5)
    model.vectors, model.labels = model.project(shares), labels.astype(np.float64)
    return model


def fold(key: Column, parts: int) -> Column:
    """crc32 of the key as text, modulo `parts`."""
    return F.crc32(key.cast("string").cast("binary")) % parts


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [row.tobytes() for block in term_shares(batch.column("text")) for row in block]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(rows, pa.binary())], names=["doc_id", "label", "shares"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fits on documents with `labels(doc_id, label)`; the caller leaves out what is held out.

    Of more than `sample` labelled ids those with the least hash are taken. Null labels and ids count as absent; texts that
    repeat, or ids labelled twice, count as often as they come.
    """
    known = labels.where("doc_id IS NOT NULL AND label IS NOT NULL").select("doc_id", F.col("label").cast("int").alias("label"))
    taken = known.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample)  # at most `sample` rows of 12 bytes
    rows = docs.select("doc_id", "text").join(F.broadcast(taken), "doc_id").select("doc_id", "label", "text")
    found = rows.mapInArrow(_features, "doc_id long, label int, shares binary").orderBy("doc_id", "label", "shares").limit(sample).collect()
    shares = np.array([np.frombuffer(r["shares"], dtype=np.float32) for r in found], dtype=np.float32).reshape(len(found), WIDTH)
    return fit(shares, np.array([r["label"] for r in found], dtype=np.float64))


def vote(docs: DataFrame, model: Model) -> DataFrame:
    """`doc_id, score` for every row of `docs(doc_id, text)`; null, empty and wordless texts get the labels' mean or what their bytes say."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [sent.value.score(block) for block in term_shares(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(np.concatenate(scores) if scores else np.zeros(0))], names=["doc_id", "score"]
            )

    return small_batches(docs).select("doc_id", "text").mapInArrow(run, "doc_id long, score double")
