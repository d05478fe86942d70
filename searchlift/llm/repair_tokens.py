"""Token ids in binary files, compressed by Re-Pair grammars with random access.

Texts are encoded by a public tokenizer, an end id follows each document, and the ids are written in ascending order
of doc_id. A file is a Parquet part of blocks; a block is a shard of about BLOCK_IDS ids of whole documents with a
grammar of its own:

* `rules`: pairs of symbols, little-endian. Rule k names symbol base + k; symbols below base are ids.
* `lengths`: how many ids each rule expands to, so that the ids before a symbol are a sum, not a decoding.
* `sequence`: the symbols. No pair crosses the end of a document, so a document is a run of symbols.
* `doc_ids`, `doc_tokens`, `doc_at`: the documents, their ids' number and the place of their first symbol.

Re-Pair counts the pairs of neighbours in a block, replaces the most frequent ones by new symbols, and repeats on the
shorter sequence until no pair comes LEAST times or the symbols are used up. A round replaces many pairs at once, from
left to right where they overlap. `document_ids` decodes one document, `ids_between` any stretch of a block.

Encoding a byte-level tokenizer goes stretch by stretch: no pre-token spans the start of a run of spaces.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from searchlift.llm.hashing import text_bytes
from searchlift.llm.stretches import StretchCoder, ragged, runs
from searchlift.llm.tables import small_batches, stored

#: Ids of a block, about; a longer document is a block of its own.
BLOCK_IDS = 1 << 20
#: A pair that comes less often is not replaced.
LEAST = 8
#: Pairs replaced in a round.
ROUND_PAIRS = 4096
_SLOTS = 1 << 16

#: Fixed value: the public pattern by which byte-level tokenizers cut a text into pre-tokens.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

BLOCKS = "part int, block int, base int, width int, rules binary, lengths binary, sequence binary, doc_ids array<long>, doc_tokens array<int>, doc_at array<int>, tokens long"


@dataclass
class Block:
    """A sequence of symbols with the grammar that expands it."""

    base: int
    rules: np.ndarray
    lengths: np.ndarray
    sequence: np.ndarray

    def _sizes(self, symbols: np.ndarray) -> np.ndarray:
        made = symbols >= self.base
        out = np.ones(len(symbols), dtype=np.int64)
        out[made] = self.lengths[symbols[made] - self.base]
        return out

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The ids of symbols. Many of them are put together from the rules' ids, which are unfolded first."""
        counts = self._sizes(symbols)
        if len(symbols) <= len(self.rules) or self.lengths.sum() > counts.sum():
            return self._unfolded(symbols)
        out = symbols.astype(np.uint32)
        made = symbols >= self.base
        if not made.any():
            return out
        rule, pool = symbols[made].astype(np.int64) - self.base, self._unfolded(self.rules.ravel())
        out = np.repeat(out, counts)
        out[ragged((np.cumsum(counts) - counts)[made], counts[made])] = pool[ragged((np.cumsum(self.lengths) - self.lengths)[rule], counts[made])]
        return out

    def _unfolded(self, symbols: np.ndarray) -> np.ndarray:
        """The ids of symbols; each round unfolds every rule once, as deep as rules nest."""
        symbols = symbols.astype(np.int64)
        while True:
            made = symbols >= self.base
            if not made.any():
                return symbols.astype(np.uint32)
            counts = 1 + made
            out = np.repeat(symbols, counts)
            at = (np.cumsum(counts) - counts)[made]
            pairs = self.rules[symbols[made] - self.base]
            out[at], out[at + 1] = pairs[:, 0], pairs[:, 1]
            symbols = out

    def ids_between(self, start: int, end: int) -> np.ndarray:
        """Ids [start, end) of the block; only symbols that overlap them are unfolded."""
        after = np.cumsum(self._sizes(self.sequence))
        first = int(np.searchsorted(after, start, side="right"))
        last = int(np.searchsorted(after, end, side="left")) + 1
        skipped = int(after[first - 1]) if first else 0
        return self.expand(self.sequence[first:last])[start - skipped : end - skipped]


def repair(ids: np.ndarray, ends: np.ndarray, base: int, limit: int) -> tuple[Block, np.ndarray]:
    """The grammar of `ids` and, in the compressed sequence, the symbol that begins each document.

    `ends` marks the last id of every document. Symbols from `base` up to `limit` may be used for rules.
    """
    wide = np.uint64 if limit > 1 << 16 else np.uint32
    bits = wide(32 if limit > 1 << 16 else 16)
    seq, last = ids.astype(wide), ends.copy()
    rules, sizes = [], [np.ones(base, dtype=np.int64)]
    used = base
    while used < limit and len(seq) > 1:
        codes = (seq[:-1] << bits) | seq[1:]
        inside = ~last[:-1]
        pairs, counts = _frequent(np.sort(codes[inside]))
        if len(pairs) <= ROUND_PAIRS:
            seq, last, late = _replace_the_rest(seq, last, pairs, used, limit, bits)
            for new in late:
                known = np.concatenate(sizes)
                rules.append(new)
                sizes.append(known[new[:, 0].astype(np.int64)] + known[new[:, 1].astype(np.int64)])
            break
        pairs = pairs[np.argsort(-counts, kind="stable")[: min(ROUND_PAIRS, limit - used)]]
        # A table tells a pair's rule; of pairs that share a slot the most frequent stays, the others wait for a round.
        _, kept = np.unique(_slot(pairs), return_index=True)
        pairs = pairs[np.sort(kept)]
        table = np.full(_SLOTS, np.iinfo(wide).max, dtype=wide)
        symbol = np.zeros(_SLOTS, dtype=wide)
        table[_slot(pairs)] = pairs
        symbol[_slot(pairs)] = np.arange(used, used + len(pairs))
        slots = _slot(codes)
        hit = np.flatnonzero((table[slots] == codes) & inside)
        # Hits in a row overlap: every second one from the left is taken.
        fresh = np.r_[True, np.diff(hit) > 1]
        begin = np.flatnonzero(fresh)
        nth = np.arange(len(hit)) - np.repeat(begin, np.diff(np.r_[begin, len(hit)]))
        hit = hit[nth % 2 == 0]
        new = np.stack([pairs >> bits, pairs & ((wide(1) << bits) - wide(1))], axis=1)
        rules.append(new)
        known = np.concatenate(sizes)
        sizes.append(known[new[:, 0].astype(np.int64)] + known[new[:, 1].astype(np.int64)])
        used += len(pairs)
        seq[hit] = symbol[slots[hit]]
        last[hit] = last[hit + 1]
        stay = np.ones(len(seq), dtype=bool)
        stay[hit + 1] = False
        seq, last = seq[stay], last[stay]
    lengths = np.concatenate(sizes[1:]) if len(sizes) > 1 else np.zeros(0, np.int64)
    table = np.concatenate(rules).astype(np.int64) if rules else np.zeros((0, 2), np.int64)
    begins = np.r_[0, np.flatnonzero(last) + 1]
    return Block(base, table, lengths, seq), begins[:-1] if len(begins) > 1 else begins


def _frequent(in_order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What comes LEAST times or more in a sorted array, and how often: only places LEAST apart are compared."""
    if len(in_order) < LEAST:
        return in_order[:0], np.zeros(0, np.int64)
    own = in_order[np.flatnonzero(in_order[LEAST - 1 :] == in_order[: len(in_order) - LEAST + 1])]
    own = own[np.r_[True, own[1:] != own[:-1]][: len(own)]]
    return own, np.searchsorted(in_order, own, "right") - np.searchsorted(in_order, own, "left")


def _replace_the_rest(seq: np.ndarray, last: np.ndarray, pairs: np.ndarray, used: int, limit: int, bits) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """The rounds from where all frequent pairs fit into one: sequence, ends of documents, and the rules of each round.

    From then on a frequent pair always holds a symbol of the round before, so pairs are counted around the places
    just replaced and nowhere else; neighbours are found by links, and the sequence is closed up once, at the end.
    """
    wide = seq.dtype.type
    n = len(seq)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    stays = np.ones(n, dtype=bool)
    marked = np.zeros(_SLOTS, dtype=bool)
    marked[_slot(pairs)] = True
    codes = (seq[:-1] << bits) | seq[1:]
    at = np.flatnonzero(marked[_slot(codes)] & ~last[:-1])
    at = at[np.isin(codes[at], pairs)]
    rules = []
    while len(at) and used < limit:
        own, which, counts = np.unique((seq[at] << bits) | seq[after[at]], return_inverse=True, return_counts=True)
        often = np.flatnonzero(counts >= LEAST)
        often = often[np.argsort(-counts[often], kind="stable")][: limit - used]
        if not len(often):
            break
        symbol = np.zeros(len(own), dtype=wide)
        symbol[often] = np.arange(used, used + len(often))
        used += len(often)
        rules.append(np.stack([own[often] >> bits, own[often] & ((wide(1) << bits) - wide(1))], axis=1))
        put = symbol[which]
        at, put = at[put > 0], put[put > 0]
        taken = _every_second(at, after)
        at, put = at[taken], put[taken]
        right = after[at]
        seq[at], last[at], stays[right] = put, last[right], False
        after[at] = after[right]
        behind = after[at] < n
        before[after[at[behind]]] = at[behind]
        at = np.unique(np.concatenate([at, before[at]]))
        at = at[at >= 0]
        at = at[~last[at] & (after[at] < n)]
    return seq[stays], last[stays], rules


def _every_second(hit: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of places in a row, whose pairs overlap, every second one from the left."""
    fresh = np.r_[True, after[hit[:-1]] != hit[1:]][: len(hit)]
    begin = np.flatnonzero(fresh)
    return (np.arange(len(hit)) - np.repeat(begin, np.diff(np.r_[begin, len(hit)]))) % 2 == 0


def _slot(codes: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        if codes.dtype == np.uint32:
            return (codes * np.uint32(2654435769)) >> np.uint32(16)
        return ((codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.int64)


class ByteLevelEncoder:
    """Ids of texts by a tokenizer file; distinct stretches are encoded once.

    With a byte-level pre-tokenizer, stretches begin where white space does. A stretch of characters below U+0240 (where
    versions of Unicode agree) is cut by the public pattern and merged pre-token by pre-token by the file's model.
    Other stretches go through the whole tokenizer. A file with another pre-tokenizer gets whole texts.
    """

    def __init__(self, content: str, pattern: str):
        import os

        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task for each core
        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.encode_special_tokens = True
        spec = json.loads(content)
        cut = spec.get("pre_tokenizer") or {}
        plain = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space") and not spec.get("normalizer")
        self.pattern = regex.compile(pattern)
        self.spelled = _byte_letters()
        self.merged: dict[str, list[int]] = {}
        self.coder = StretchCoder(_breaks if plain else lambda data: np.zeros(len(data), dtype=bool), self._code if plain else self._whole)

    def vocabulary(self) -> int:
        return self.tokenizer.get_vocab_size()

    def _whole(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        texts = [data[a:b].tobytes().decode() for a, b in zip(starts, ends)]
        found = [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        return np.array([i for ids in found for i in ids], dtype=np.int32), np.array([len(ids) for ids in found], dtype=np.int64)

    def _code(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Stretches from white space to something else are cut together, in a row, as pre-tokens end where they do."""
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        odd = np.r_[0, np.cumsum((data >= 0xC9) | ((data < 0x20) & ~_SPACE[data]))]
        plain = _SPACE[data[starts]] & _closed(data, ends) & (odd[ends] == odd[starts])
        counts = np.zeros(len(starts), dtype=np.int64)
        ids = np.zeros(0, dtype=np.int32)
        if plain.any():
            sizes = (ends - starts)[plain]
            body = data[ragged(starts[plain], sizes)]
            words = self.pattern.findall(body.tobytes().decode())
            self._merge(words)
            found = list(map(self.merged.__getitem__, words))
            each = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
            ids = np.fromiter(chain.from_iterable(found), dtype=np.int32, count=int(each.sum()))
            letters = np.r_[0, np.cumsum((body & 0xC0) != 0x80)][np.cumsum(sizes) - sizes]
            word = np.r_[0, np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)))]
            counts[plain] = np.add.reduceat(each, np.searchsorted(word, letters))
        rest = np.flatnonzero(~plain)
        more, own = self._whole(data, starts[rest], ends[rest])
        counts[rest] = own
        first = np.zeros(len(starts), dtype=np.int64)
        first[plain] = np.cumsum(counts[plain]) - counts[plain]
        first[rest] = len(ids) + np.cumsum(own) - own
        return np.concatenate([ids, more])[ragged(first, counts)], counts

    def _merge(self, words: list[str]) -> None:
        if len(self.merged) > 1 << 19:
            self.merged.clear()
        model, spelled, blank = self.tokenizer.model, self.spelled, self.spelled[0x20]
        for word in set(words).difference(self.merged):
            # Printable ASCII is written as it is, but for the space.
            plain = word.replace(" ", blank) if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(spelled)
            self.merged[word] = [t.id for t in model.tokenize(plain)]


def _byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write a byte: printable ones as themselves, the others as letters from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + k) for k, b in enumerate(hidden)}


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _closed(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether the character before each place is surely no white space: ASCII, or a letter of two bytes."""
    before = data[ends - 1]
    lead = data[np.maximum(ends - 2, 0)]
    return ((before < 0x80) & ~_SPACE[before]) | ((before >= 0x80) & (lead >= 0xC3) & (lead < 0xE0))


def _breaks(data: np.ndarray) -> np.ndarray:
    """Bytes where a run of white space surely begins; after what may be white space of its own, a stretch goes on."""
    opens = np.zeros(len(data), dtype=bool)
    at = np.flatnonzero(_SPACE[data])
    at = at[at > 0]
    opens[at[_closed(data, at)]] = True
    return opens


_ENCODERS: dict[str, ByteLevelEncoder] = {}


def _encoder(name: str, sent) -> ByteLevelEncoder:
    """The encoder of a broadcast tokenizer file, kept in a worker for its next tasks."""
    if name not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[name] = ByteLevelEncoder(*sent.value)
    return _ENCODERS[name]


def write_tokens(docs: DataFrame, tokenizer: str, pattern: str = PATTERN, end_id: int = 0) -> DataFrame:
    """Writes the ids of `docs(doc_id, text)` as blocks below the shared folder and returns the blocks read back.

    `tokenizer` is a tokenizer file on the driver, `pattern` its public pre-token pattern. A null or empty text has only
    its end id. A null doc_id comes first; rows with the same doc_id follow in the order of their text's hash.
    """
    with open(tokenizer, encoding="utf-8") as file:
        content = file.read()
    name = uuid.uuid4().hex
    sent = docs.sparkSession.sparkContext.broadcast((content, pattern))
    tie = F.xxhash64(F.coalesce("text", F.lit("")))
    ranged = small_batches(docs).select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(name, sent)
        part, block = TaskContext.get().partitionId(), 0
        base = max(encoder.vocabulary(), end_id + 1)
        narrow = base < (1 << 16) - 1024
        limit, kind = (1 << 16, "<u2") if narrow else (base + (1 << 16), "<u4")

        def packed(doc_ids: list, ids: list[np.ndarray]) -> pa.RecordBatch:
            sizes = np.array([len(i) for i in ids])
            flat = np.concatenate(ids)
            ends = np.zeros(len(flat), dtype=bool)
            ends[np.cumsum(sizes) - 1] = True
            made, at = repair(flat, ends, base, limit)
            row = {
                "part": part, "block": block, "base": base, "width": 2 if narrow else 4,
                "rules": made.rules.astype(kind).tobytes(), "lengths": made.lengths.astype("<u4").tobytes(), "sequence": made.sequence.astype(kind).tobytes(),
                "doc_ids": doc_ids, "doc_tokens": sizes.tolist(), "doc_at": at.tolist(), "tokens": len(flat),
            }
            return pa.RecordBatch.from_pylist([row], schema=_BLOCK_SCHEMA)

        held_ids, held, n = [], [], 0
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            names = batch.column("doc_id").to_pylist()
            for a, b in runs(offsets):
                ids, begin = encoder.coder.code(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                for k in range(b - a):
                    held_ids.append(names[a + k])
                    held.append(np.append(ids[begin[k] : begin[k + 1]], end_id))
                    n += len(held[-1])
                    if n >= BLOCK_IDS:
                        yield packed(held_ids, held)
                        held_ids, held, n, block = [], [], 0, block + 1
        if held:
            yield packed(held_ids, held)

    return stored(ranged.mapInArrow(blocks, BLOCKS), "tokens")


_BLOCK_SCHEMA = pa.schema(
    [("part", pa.int32()), ("block", pa.int32()), ("base", pa.int32()), ("width", pa.int32()), ("rules", pa.binary()), ("lengths", pa.binary()), ("sequence", pa.binary())]
    + [("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int32())), ("doc_at", pa.list_(pa.int32())), ("tokens", pa.int64())]
)


def read_block(row: dict) -> Block:
    kind = f"<u{row['width']}"
    rules = np.frombuffer(row["rules"], dtype=kind).astype(np.int64).reshape(-1, 2)
    return Block(row["base"], rules, np.frombuffer(row["lengths"], dtype="<u4").astype(np.int64), np.frombuffer(row["sequence"], dtype=kind))


def document_ids(row: dict, k: int) -> np.ndarray:
    """Ids of the k-th document of a block, decoded alone."""
    made = read_block(row)
    at = [*row["doc_at"], len(made.sequence)]
    return made.expand(made.sequence[at[k] : at[k + 1]])


def read_tokens(blocks: DataFrame, with_ids: bool = True) -> DataFrame:
    """`doc_id, start, n_tokens, ids_crc32`, and `ids` if wanted, of every document in the files.

    start counts the ids of all documents before it, over all files: blocks add up within their file, files by a total
    for each of them (as many as the writing tasks).
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = read_block(row)
                flat = ids.expand(ids.sequence)
                sizes = np.array(row["doc_tokens"], dtype=np.int64)
                after = np.cumsum(sizes)
                raw = flat.astype("<u4")
                sums = [zlib.crc32(raw[b - n : b]) for n, b in zip(sizes.tolist(), after.tolist())]
                n = len(sizes)
                columns = [
                    pa.array(np.full(n, row["part"]), pa.int32()), pa.array(np.full(n, row["block"]), pa.int32()), pa.array(row["doc_ids"], pa.int64()),
                    pa.array(after - sizes), pa.array(sizes), pa.array(sums, pa.int64()),
                ]
                names = ["part", "block", "doc_id", "within", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.r_[0, after], pa.int32()), pa.array(flat.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "part int, block int, doc_id long, within long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    files = blocks.groupBy("part").agg(F.sum("tokens").alias("tokens"))
    before = files.select("part", (F.sum("tokens").over(Window.orderBy("part")) - F.col("tokens")).alias("files"))
    inner = blocks.select("part", "block", (F.sum("tokens").over(Window.partitionBy("part").orderBy("block")) - F.col("tokens")).alias("blocks"))
    starts = inner.join(before, "part").select("part", "block", (F.col("files") + F.col("blocks")).alias("base"))
    found = blocks.mapInArrow(read, schema).join(starts, ["part", "block"])
    return found.select("doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)
