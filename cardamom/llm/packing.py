"""Packing: token ids of all documents into sequences of a fixed length, online and in bounded space.

Each partition keeps ``open_windows`` open windows. The tail of a document goes to
the window that it fills best. When none has room for it and no window may be
opened, the fullest window is filled up with a part of the tail and emitted. At
the end a partition joins its open windows, so that one at most stays partly
filled; those of all partitions are merged in two further steps. What is left of
the last one is cut into sequences whose lengths are powers of two, without padding.

Null and empty texts are documents that hold the end id alone. Repeated rows are
packed once each. An empty table gives an empty result. Other columns of the input do not matter."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardamom.llm._common import Staged

PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary, open boolean"
ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary()), ("open", pa.bool_())])
LETTER_MARK = r"([a-zß-öø-ÿ])([!-/:-@\[-`{-~])"
#: Entries of a worker's memory of encoded words; beyond that it starts anew.
MEMORY = 600_000
_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str, memory: int) -> WordEncoder:
    """A worker's encoder; it keeps its memory from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    _ENCODERS[path].memory = memory
    return _ENCODERS[path]


class WordEncoder:
    """Encodes texts word by word, with a bounded memory of words already encoded.

    The tokenizer never joins what a space or line feed separates, nor a Latin letter with
    a mark after it, and lowers A-Z; so the ids of a text are those of its lowered
    parts, one after another. Only where texts hold "<|", which may begin
    a special token, or combining marks are they cut at spaces alone."""

    def __init__(self, path: str, memory: int = MEMORY):
        from tokenizers import Tokenizer

        self.memory = memory
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.batch = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        self.seen: dict[str, bytes] = {}

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all the texts, one after another, and where each text's begin (and the last ends)."""
        spaced = pc.replace_substring(pc.fill_null(texts.cast(pa.large_string()), ""), "\n", " ")
        if not pc.any(pc.match_substring_regex(spaced, r"<\||\p{M}")).as_py():
            spaced = pc.replace_substring_regex(pc.ascii_lower(spaced), pattern=LETTER_MARK, replacement=r"\1 \2")
        parts = pc.split_pattern(spaced, " ")
        coded = parts.flatten().dictionary_encode()
        words, seen = coded.dictionary.to_pylist(), self.seen
        new = [x for x in words if x not in seen]
        if len(seen) + len(new) > self.memory:
            seen.clear()
            new = words
        for x, e in zip(new, self.batch(new, add_special_tokens=False), strict=True):
            seen[x] = np.array(e.ids, "<u4").tobytes()
        each = [seen[x] for x in words]
        table = np.frombuffer(b"".join(each), "<u4")
        length = np.fromiter(map(len, each), np.int64, len(each)) // 4
        start = np.cumsum(length) - length
        at = coded.indices.to_numpy()
        n = length[at]
        end = np.cumsum(n)
        ids = table[np.repeat(start[at] - (end - n), n) + np.arange(end[-1] if len(end) else 0)]
        bounds = parts.offsets.to_numpy()
        return ids, np.concatenate(([0], end))[bounds - bounds[0]]


def chunks(batch: pa.RecordBatch, column: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts have up to ``most`` bytes, or one row that has more."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = sizes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, before + most, "right")))
        yield batch.slice(at, end - at)
        at = end
    pa.default_memory_pool().release_unused()


class Packer:
    """Open windows of one partition. Pieces are (doc_id, start, bytes of ids, doc_tokens)."""

    def __init__(self, length: int, open_windows: int, first_id: int):
        self.length, self.most, self.next_id = length, open_windows, first_id
        self.windows: list[tuple[list, int]] = []  # pieces, free places
        self.out: list[tuple] = []

    def emit(self, pieces: list, is_open: bool = False) -> None:
        at = 0
        for doc_id, start, ids, total in pieces:
            n = len(ids) // 4
            self.out.append((doc_id, start, n, total, self.next_id, at, ids, is_open))
            at += n
        self.next_id += 1

    def add(self, doc_id, ids: bytes, start: int = 0, total: int | None = None) -> None:
        total = len(ids) // 4 if total is None else total
        width, at = 4 * self.length, 0
        while len(ids) - at >= width:
            self.emit([(doc_id, start + at // 4, ids[at : at + width], total)])
            at += width
        if at < len(ids):
            self.place(doc_id, start + at // 4, ids[at:], total)

    def place(self, doc_id, start: int, ids: bytes, total: int) -> None:
        while ids:
            need = len(ids) // 4
            fit = min((k for k, w in enumerate(self.windows) if w[1] >= need), key=lambda k: self.windows[k][1], default=None)
            if fit is None and len(self.windows) < self.most:
                self.windows.append(([], self.length))
                fit = len(self.windows) - 1
            if fit is None:  # none fits: fill up the fullest and emit it
                fit = min(range(len(self.windows)), key=lambda k: self.windows[k][1])
            pieces, free = self.windows[fit]
            n = min(need, free)
            pieces.append((doc_id, start, ids[: 4 * n], total))
            self.windows[fit] = (pieces, free - n)
            if n == free:
                self.emit(self.windows.pop(fit)[0])
            ids, start = ids[4 * n :], start + n

    def close(self) -> None:
        """Join the open windows; the one that stays partly filled is emitted as open."""
        self.join([p for pieces, _ in sorted(self.windows, key=lambda w: w[1]) for p in pieces])

    def join(self, pieces: list) -> None:
        held, free = [], self.length
        for doc_id, start, ids, total in pieces:
            while ids:
                n = min(len(ids) // 4, free)
                held.append((doc_id, start, ids[: 4 * n], total))
                ids, start, free = ids[4 * n :], start + n, free - n
                if not free:
                    self.emit(held)
                    held, free = [], self.length
        if held:
            self.emit(held, True)
        self.windows = []


def powers(pieces: list, packer: Packer) -> None:
    """Emit the pieces as sequences whose lengths are falling powers of two."""
    left = sum(len(p[2]) // 4 for p in pieces)
    pieces = list(pieces)
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        held = []
        while room:
            doc_id, start, ids, total = pieces.pop(0)
            n = min(room, len(ids) // 4)
            held.append((doc_id, start, ids[: 4 * n], total))
            if 4 * n < len(ids):
                pieces.insert(0, (doc_id, start + n, ids[4 * n :], total))
            room -= n
        packer.emit(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), ARROW.types, strict=True)], schema=ARROW)


def pack(df: DataFrame, tokenizer: str, *, length: int = 2048, open_windows: int = 16, end_id: int = 1, memory: int = MEMORY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces: doc_id, start, length, doc_tokens, sequence_id, offset, ids (binary, 32-bit little-endian).

    A document's ids are its text's with ``end_id`` after them. ``tokenizer`` is the
    path of a tokenizer file that every executor has."""
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, memory)
        packer = Packer(length, open_windows, TaskContext.get().partitionId() << 32)
        for batch in (x for whole in batches for x in chunks(whole, 1, 8 << 20)):
            ids, at = encode(batch.column(1))
            for k, doc_id in enumerate(batch.column(0).to_pylist()):
                packer.add(doc_id, ids[at[k] : at[k + 1]].tobytes() + end)
                if len(packer.out) >= 1000:
                    yield _batch(packer.out)
                    packer.out = []
        packer.close()
        if packer.out:
            yield _batch(packer.out)

    pieces = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, PIECES)
    held = Staged(pieces, "pack").read()

    def merge(level: int, last: bool):
        def f(key: tuple, table: pa.Table) -> pa.Table:
            rows = table.sort_by([("sequence_id", "ascending"), ("offset", "ascending")]).to_pylist()
            packer = Packer(length, open_windows, (level << 61) + (key[0].as_py() << 32))
            packer.join([(r["doc_id"], r["start"], r["ids"], r["doc_tokens"]) for r in rows])
            if last and packer.out and packer.out[-1][-1]:
                tail = [x for x in packer.out if x[-1]]
                packer.out = [x for x in packer.out if not x[-1]]
                powers([(x[0], x[1], x[6], x[3]) for x in tail], packer)
            return pa.Table.from_batches([_batch(packer.out)])

        return f

    part = F.shiftright("sequence_id", 32)
    opened = held.filter("open").groupBy(F.shiftright(part, 7).alias("g")).applyInArrow(merge(1, False), PIECES)
    opened = Staged(opened, "pack-merge").read()
    last = opened.filter("open").groupBy(F.lit(0).cast("long").alias("g")).applyInArrow(merge(2, True), PIECES)
    return held.filter("not open").unionByName(opened.filter("not open")).unionByName(last).drop("open")
