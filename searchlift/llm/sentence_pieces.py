"""SentencePiece encoding and decoding: the best segmentation of every whole text into pieces of a public model.

The pieces form an Aho-Corasick automaton over bytes: a trie whose missing steps follow failure links, with an output
link from every state to the next shorter piece that ends there. One pass over a text reads its bytes through the
automaton and, at each position, follows the output links to relax the best score of ending there (Viterbi). A
character that is no piece costs the least score minus 10 and is spelled in byte pieces. Ties go to the longer last
piece. Scores are the model's; the segmentation is the one of greatest total score.

A space is read as the model's word mark, and one is set before the text. No piece has a mark after another character
or holds a line break, so the best path breaks before every run of spaces and around line breaks. Between two breaks
stands a stretch that occurs again and again: equal stretches (told by 64-bit hashes) are encoded once in a task, many
at a time, with one array step for each position.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchlift.llm.hashing import text_bytes
from searchlift.llm.stretches import StretchCoder, ragged, runs
from searchlift.llm.tables import packed, small_batches, unpacked

MARK = "▁"
UNKNOWN_PENALTY = 10.0
_SPACE, _BREAK = 0x20, 0x0A
_MARK_BYTES = re.compile(MARK.encode())


class Pieces:
    """What is needed of a model: the text, score and kind of each piece."""

    def __init__(self, pieces: list[str], scores: list[float], plain: list[bool], byte_ids: list[int], unknown: int):
        self.byte_ids = byte_ids
        self.unknown = unknown
        self.bytes = [piece.replace(MARK, " ").encode() for piece in pieces]
        self.plain, self.scores = plain, scores
        inner = [piece.lstrip(MARK) for piece, ok in zip(pieces, plain) if ok]
        if any(MARK in rest or "\n" in rest for rest in inner):
            raise ValueError("a piece holds a word mark after another character, or a line break")
        for k, b in enumerate(byte_ids):
            self.bytes[b] = bytes([k])

    @classmethod
    def load(cls, path: str) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(n)]
        as_byte = [model.is_byte(i) for i in range(n)]
        pieces = ["" if skip else model.id_to_piece(i) for i, skip in enumerate(special)]
        byte_ids = sorted((i for i in range(n) if as_byte[i]), key=lambda i: int(pieces[i][1:-1], 16))
        if len(byte_ids) not in (0, 256):
            raise ValueError("byte pieces must be complete or absent")
        plain = [not (skip or b) for skip, b in zip(special, as_byte)]
        return cls(pieces, [model.get_score(i) for i in range(n)], plain, byte_ids, model.unk_id())


class Automaton:
    """Aho-Corasick over the bytes of the plain pieces, as one table of steps."""

    def __init__(self, pieces: Pieces):
        steps: list[dict[int, int]] = [{}]
        piece_at, parent, byte, depth = [-1], [0], [0], [0]
        for k, body in enumerate(pieces.bytes):
            if not pieces.plain[k] or not body:
                continue
            state = 0
            for b in body:
                to = steps[state].get(b)
                if to is None:
                    to = steps[state][b] = len(steps)
                    steps.append({})
                    piece_at.append(-1)
                    parent.append(state)
                    byte.append(b)
                    depth.append(depth[state] + 1)
                state = to
            if piece_at[state] < 0 or pieces.scores[k] > pieces.scores[piece_at[state]]:
                piece_at[state] = k
        self.piece = np.array(piece_at, dtype=np.int32)
        self.length = np.array(depth, dtype=np.int32)
        parent_of, byte_of = np.array(parent), np.array(byte)
        self.goto = np.zeros((len(steps), 256), dtype=np.int32)
        #: The next shorter piece that ends where a state ends; 0: none.
        self.link = np.zeros(len(steps), dtype=np.int32)
        fail = np.zeros(len(steps), dtype=np.int64)
        for level in range(int(self.length.max()) + 1):  # all states of a depth at once, from the root down
            states = np.flatnonzero(self.length == level)
            if level:
                up = parent_of[states]
                fail[states] = np.where(up > 0, self.goto[fail[up], byte_of[states]], 0)
                self.goto[states] = self.goto[fail[states]]
                f = fail[states]
                self.link[states] = np.where(self.piece[f] >= 0, f, self.link[f])
            below = np.flatnonzero(self.length == level + 1)
            self.goto[parent_of[below], byte_of[below]] = below
        scores = np.array(pieces.scores)
        self.score = np.where(self.piece >= 0, scores[self.piece], 0.0)
        self.unknown_score = min(x for x, ok in zip(pieces.scores, pieces.plain) if ok) - UNKNOWN_PENALTY
        self.byte_ids = np.array(pieces.byte_ids, dtype=np.int32) if pieces.byte_ids else None
        self.unknown = pieces.unknown

    def best(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the best segmentation of each stretch, in a row, and how many each has."""
        sizes = ends - starts
        order = np.argsort(sizes, kind="stable")
        counts = np.zeros(len(sizes), dtype=np.int64)
        parts = []
        first = 0
        while first < len(order):
            last = first + 1  # stretches of like length together, about 2^20 cells
            while last < len(order) and (last - first + 1) * int(sizes[order[min(last * 2 - first, len(order) - 1)]]) < 1 << 20:
                last = min(last * 2 - first, len(order) - 1) + 1
            ids, n = self._together(data, starts[order[first:last]], sizes[order[first:last]])
            counts[order[first:last]] = n
            parts.append(ids)
            first = last
        flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        at = np.zeros(len(sizes), dtype=np.int64)
        at[order] = np.r_[0, np.cumsum(counts[order])[:-1]] if len(order) else 0
        return flat[ragged(at, counts)], counts

    def _together(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """`best` of stretches in ascending length, one array step for each position."""
        n, width = len(sizes), int(sizes[-1])
        cells = np.zeros((n, width + 1), dtype=np.uint8)
        inside = np.arange(width) < sizes[:, None]
        cells[:, :width][inside] = data[ragged(starts, sizes)]
        inner = (cells & 0xC0) == 0x80  # a byte that goes on with a character
        score = np.full((n, width + 1), -np.inf)
        score[:, 0] = 0
        back = np.zeros((n, width + 1), dtype=np.int32)
        came = np.zeros((n, width + 1), dtype=np.int32)
        state = np.zeros(n, dtype=np.int32)
        began = np.zeros(n, dtype=np.int32)
        for t in range(width):
            a = int(np.searchsorted(sizes, t, side="right"))
            state[a:] = self.goto[state[a:], cells[a:, t]]
            began[a:] = np.where(inner[a:, t], began[a:], t)
            whole = np.zeros(n, dtype=bool)
            at = state[a:]
            node = np.where(self.piece[at] >= 0, at, self.link[at])
            row = np.flatnonzero(node) + a
            node = node[node > 0]
            while len(row):
                length = self.length[node]
                reached = score[row, t + 1 - length] + self.score[node]
                whole[row] |= length == t + 1 - began[row]
                better = reached > score[row, t + 1]
                on = row[better]
                score[on, t + 1] = reached[better]
                back[on, t + 1] = length[better]
                came[on, t + 1] = self.piece[node[better]]
                node = self.link[node]
                row, node = row[node > 0], node[node > 0]
            ends = ~inner[a:, t + 1]
            row = np.flatnonzero(ends & ~whole[a:]) + a
            reached = score[row, began[row]] + self.unknown_score
            row, reached = row[reached > score[row, t + 1]], reached[reached > score[row, t + 1]]
            score[row, t + 1] = reached
            if self.byte_ids is None:
                back[row, t + 1] = t + 1 - began[row]
                came[row, t + 1] = self.unknown
            else:  # spelled byte by byte; the places inside a character lead back through it
                row = np.r_[row, np.flatnonzero(~ends) + a]
                back[row, t + 1] = 1
                came[row, t + 1] = self.byte_ids[cells[row, t]]
        place = sizes.astype(np.int64).copy()
        counts = np.zeros(n, dtype=np.int64)
        steps = []
        row = np.flatnonzero(place > 0)
        while len(row):
            steps.append((row, came[row, place[row]]))
            place[row] -= back[row, place[row]]
            counts[row] += 1
            row = row[place[row] > 0]
        after = np.cumsum(counts)
        out = np.zeros(int(after[-1]) if n else 0, dtype=np.int32)
        for k, (row, ids) in enumerate(steps):
            out[after[row] - 1 - k] = ids
        return out, counts


def _breaks(data: np.ndarray) -> np.ndarray:
    """Places where the best path breaks whatever stands around: runs of spaces begin, line breaks begin and end."""
    space, line = data == _SPACE, data == _BREAK
    opens = line.copy()
    opens[1:] |= (space[1:] & ~space[:-1]) | line[:-1]
    return opens


class Encoder:
    """Encodes texts given as bytes, a mark set before each."""

    def __init__(self, automaton: Automaton):
        self.stretches = StretchCoder(_breaks, automaton.best)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts in a row, and where each text's begin (one more entry than texts)."""
        sizes = np.diff(offsets)
        shift = np.cumsum(sizes > 0)
        marked = np.full(len(data) + (shift[-1] if len(shift) else 0), _SPACE, dtype=np.uint8)
        marked[np.arange(len(data)) + np.repeat(shift, sizes)] = data
        return self.stretches.code(marked, offsets + np.r_[0, shift])


_BUILT: dict[str, Encoder] = {}


def _encoder(name: str, sent) -> Encoder:
    """The encoder of a broadcast model, built once in a worker and kept for its next tasks."""
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = Encoder(Automaton(sent.value))
    return _BUILT[name]


def _rows(docs: DataFrame, text: str, new: tuple[str, ...]) -> tuple[DataFrame, list[str], str]:
    names = [n for n in docs.columns if n != text and n not in new]
    rows = small_batches(docs).select(packed(names), F.col(text).alias("text"))
    return rows, names, rows.schema["row"].dataType.simpleString()


def encode(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """The rows of `docs` with `ids` (array of int) and `ids_crc32` (of the ids as little-endian 32-bit integers).

    `model` is the path of a SentencePiece model on the driver. A null or empty text has no ids. Repeated rows are
    encoded alike. The mark character itself is read as a space. Columns called ids or ids_crc32 are replaced.
    """
    rows, names, kind = _rows(docs, text, ("ids", "ids_crc32"))
    name = uuid.uuid4().hex
    sent = docs.sparkSession.sparkContext.broadcast(Pieces.load(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(name, sent)
        for batch in batches:
            column = batch.column("text")
            data, offsets = text_bytes(column)
            if _MARK_BYTES.search(data):
                data, offsets = text_bytes(pc.replace_substring(column, MARK, " "))
            for first, last in runs(offsets):
                at = offsets[first : last + 1]
                ids, begin = encoder.encode(data[at[0] : at[-1]], at - at[0])
                raw = ids.astype("<u4")
                sums = [zlib.crc32(raw[a:b]) for a, b in zip(begin[:-1].tolist(), begin[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row")[first:last], column[first:last], pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(ids)), pa.array(sums, pa.int64())],
                    names=["row", "text", "ids", "ids_crc32"],
                )

    found = rows.mapInArrow(run, f"row {kind}, text string, ids array<int>, ids_crc32 long")
    return found.select(*unpacked(names), F.col("text").alias(text), "ids", "ids_crc32")


def decode(encoded: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """The rows of `encoded` with `decoded`, the text that the ids spell; no ids, or null, spell the empty text.

    Bytes that are no UTF-8 become replacement characters. Control pieces spell nothing; unknown ones U+2047.
    """
    rows, names, kind = _rows(encoded, ids, ("decoded",))
    sent = encoded.sparkSession.sparkContext.broadcast(Pieces.load(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelled = list(sent.value.bytes)
        if not sent.value.byte_ids:
            spelled[sent.value.unknown] = " \u2047 ".encode()
        flat = np.frombuffer(b"".join(spelled), dtype=np.uint8)
        sizes = np.array([len(b) for b in spelled], dtype=np.int64)
        first = np.cumsum(sizes) - sizes
        for batch in batches:
            column = pc.fill_null(batch.column("text").cast(pa.large_list(pa.int32())), [])
            bounds = np.asarray(column.offsets)
            for a, b in runs(bounds * 4):
                own = np.asarray(column.values)[bounds[a] : bounds[b]]
                body = flat[ragged(first[own], sizes[own])]
                ends = np.r_[0, np.cumsum(sizes[own])][bounds[a : b + 1] - bounds[a]]
                begin = ends[:-1] + ((ends[1:] > ends[:-1]) & (body[np.minimum(ends[:-1], max(len(body) - 1, 0))] == _SPACE) if len(body) else 0)
                texts = [body[x:y].tobytes().decode("utf-8", "replace") for x, y in zip(begin.tolist(), ends[1:].tolist())]
                yield pa.RecordBatch.from_arrays([batch.column("row")[a:b], pa.array(texts, pa.string())], names=["row", "decoded"])

    found = rows.mapInArrow(run, f"row {kind}, decoded string")
    return found.select(*unpacked(names), "decoded")
