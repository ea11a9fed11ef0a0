"""Language-model scoring by a weighted backoff automaton learned from the corpus.

Tokens are lower-cased (A-Z) words and one end for each text. States are the histories
seen in training: pairs of words, words, and the root. From the state of (u, v) an arc w leads to
the state of (v, w), with weight log10((c(u,v,w) + mu3 P(w|v)) / (c(u,v) + mu3)), where u v w
was seen; the failure arc leads to the state of v with log10(mu3 / (c(u,v) + mu3)). From there an
arc w weighs log10 P(w|v) = log10((c(v,w) + mu P(w)) / (c(v) + mu)) where v w was seen, and the failure
arc leads to the root with log10(mu / (c(v) + mu)), where w weighs log10 P(w) and leads to
the state of w. P discounts each count by D = n1 / (n1 + 2 n2) and gives what that frees to
the one unknown word, so all weights of a state sum to one. A text starts in the state of the end
token; the state that it carries is that of the longest history seen.

Counts are of all training texts. Texts are read once, into blocks: a block holds
its distinct words' 64-bit hashes and its texts as indices of these. Each block asks
shards of the hash range for the counts of its distinct words, pairs and triples, in one
array a shard; the answers are arrays in the same order. So what a task holds is
a block or a shard, and a common word or a hot source weighs no more than a rare one. A block
sends ``fan`` messages for each kind and no more: where that gives too few shards, the questions of
``fan`` blocks are merged and asked on, range by range, and the answers take the way back. So the
number of messages grows with the number of blocks, not with its square.

Null and empty texts have the end token alone. Repeated rows count and are scored
each. A very long text is one block. A null id is taken as an empty one (held out). An empty table gives
an empty result. Columns besides id and text do not matter, whatever their names."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardamom.llm._common import Staged
from cardamom.llm.packing import chunks

BLOCK_BYTES = 12 << 20
BLOCK = "block long, ids binary, held binary, ends binary, words binary, tokens binary"
_BLOCK = pa.schema([("block", pa.int64()), *[(n, pa.binary()) for n in ("ids", "held", "ends", "words", "tokens")]])
#: The end token's hash; a word with the same 64 bits would count as an end.
END = np.uint64(0x9E3779B97F4A7C15)
#: Tokens that look for their arcs at a time.
STEP = 1 << 19
#: Bits of a text in a block.
HELD, NULL_ID = 1, 2


def _squeeze(a: np.ndarray) -> bytes:
    """An array as compressed byte planes."""
    raw = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T).tobytes() if len(a) else b""
    return len(raw).to_bytes(8, "little") + bytes(pa.compress(raw, "zstd", asbytes=True))


def _expand(b: bytes, dtype) -> np.ndarray:
    n = int.from_bytes(b[:8], "little")
    if not n:
        return np.zeros(0, dtype)
    raw = np.frombuffer(pa.decompress(b[8:], decompressed_size=n, codec="zstd", asbytes=True), np.uint8)
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(dtype).ravel()


def _pack_sorted(a: np.ndarray) -> bytes:
    return _squeeze(np.diff(a, prepend=np.uint64(0)))


def _unpack_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(_expand(b, np.uint64), dtype=np.uint64)


def is_held_out(doc_id) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


def token_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, each text's with its end; and where each text's tokens end."""
    import xxhash

    spaced = pc.replace_substring_regex(pc.fill_null(texts.cast(pa.large_string()), ""), pattern=r"[\t-\r]", replacement=" ")
    parts = pc.split_pattern(pc.ascii_lower(spaced), " ")  # lowered last: ascii_lower errs on slices
    coded = parts.flatten().dictionary_encode()
    h = xxhash.xxh64_intdigest
    table = np.array([h(w) if w else 0 for w in coded.dictionary.to_pylist()], np.uint64)
    real = np.array([bool(w) for w in coded.dictionary.to_pylist()], bool)
    at = coded.indices.to_numpy()
    bounds = parts.offsets.to_numpy()
    bounds = bounds - bounds[0]
    keep = real[at] if len(at) else np.zeros(0, bool)
    upto = np.concatenate(([0], np.cumsum(keep)))[bounds]
    n = np.diff(upto)
    ends = np.cumsum(n + 1)
    out = np.full(int(ends[-1]) if len(ends) else 0, END, np.uint64)
    place = np.ones(len(out), bool)
    place[ends - 1] = False
    out[place] = table[at[keep]]
    return out, ends


def _mixed(history: np.ndarray, word: np.ndarray) -> np.ndarray:
    x = (history * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (word + np.uint64(0x165667B19E3779F9))
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct values, sorted; a place of each; and which of them stands at each place."""
    order = np.argsort(values)
    values = values[order]
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    at = np.empty(len(values), np.int32)
    at[order] = np.cumsum(new, dtype=np.int32) - 1
    return values[new], order[new], at


class Grams:
    """A block's distinct words, pairs and triples (sorted hashes), and which of them end at each token.

    The first token of a text follows an end token and closes no triple (-1)."""

    def __init__(self, words: np.ndarray, tokens: np.ndarray, ends: np.ndarray):
        now = words[tokens]
        pair = np.empty_like(now)
        pair[1:] = now[:-1]
        pair[:1] = END  # each later text follows the end of the one before it
        pair = _mixed(pair, now)
        inner = np.ones(len(now), bool)
        inner[(ends - np.diff(ends, prepend=0))] = False
        inner = np.flatnonzero(inner)
        triple = _mixed(pair[inner - 1], now[inner])
        del now
        self.words, self.word_at = words, tokens.astype(np.int32)
        self.pairs, self.pair_first, self.pair_at = _distinct(pair)
        del pair
        self.triples, first, at = _distinct(triple)
        self.triple_first = inner[first]
        self.triple_at = np.full(len(tokens), -1, np.int32)
        self.triple_at[inner] = at

    def kinds(self) -> tuple[tuple[np.ndarray, np.ndarray], ...]:
        return (self.words, self.word_at), (self.pairs, self.pair_at), (self.triples, self.triple_at)


def blocks(df: DataFrame, id_col: str, text_col: str, block_bytes: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k, size = TaskContext.get().partitionId() << 24, 0, 0
        held: list[tuple] = []

        def give() -> pa.RecordBatch:
            ids = np.concatenate([x[0] for x in held])
            tokens = np.concatenate([x[2] for x in held])
            lengths = np.concatenate([np.diff(x[3], prepend=0) for x in held])
            words, at = np.unique(tokens, return_inverse=True)
            row = (part + k, _squeeze(ids), np.concatenate([x[1] for x in held]).tobytes(), _squeeze(np.cumsum(lengths)), _pack_sorted(words), _squeeze(at.astype(np.uint32)))
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, _BLOCK.types, strict=True)], schema=_BLOCK)

        for batch in (x for whole in batches for x in chunks(whole, 1)):
            raw = batch.column(0).to_pylist()
            ids = np.array([x or 0 for x in raw], np.int64)
            tokens, ends = token_hashes(batch.column(1))
            held.append((ids, np.array([HELD * is_held_out(x) + NULL_ID * (x is None) for x in raw], np.uint8), tokens, ends))
            size += batch.column(1).nbytes
            if size >= block_bytes:
                yield give()
                held, k, size = [], k + 1, 0
        if held:
            yield give()

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, BLOCK)


def _load(row: dict) -> tuple[np.ndarray, ...]:
    return _expand(row["ids"], np.int64), np.frombuffer(row["held"], np.uint8), _expand(row["ends"], np.int64), _unpack_sorted(row["words"]), _expand(row["tokens"], np.uint32)


class Automaton:
    """The part of the automaton that a block's texts can visit.

    State 0 is the root, 1 + i that of word i, 1 + words + j that of pair j. Weights of arcs that are not there are NaN."""

    def __init__(self, grams: Grams, counts: list[np.ndarray], stats: dict, mu: float, mu3: float):
        total, distinct, once, twice = (stats[k] for k in ("total", "distinct", "once", "twice"))
        c1, c2, c3 = counts
        discount = once / (once + 2 * twice) if once and twice else 0.5
        if not distinct:
            p1 = np.ones(len(c1))  # nothing learned: the unknown word is certain
        else:
            p1 = np.where(c1 > 0, (c1 - discount) / total, discount * distinct / total)
        end = int(np.searchsorted(grams.words, END))
        last = grams.word_at[grams.pair_first]
        first = np.where(grams.pair_first > 0, grams.word_at[grams.pair_first - 1], end)
        p2 = (c2 + mu * p1[last]) / (c1[first] + mu)
        out, into = grams.pair_at[grams.triple_first - 1], grams.pair_at[grams.triple_first]
        p3 = (c3 + mu3 * p2[into]) / (c2[out] + mu3)
        w, seen2 = len(c1), c2 > 0
        self.weights = [np.log10(p1), np.where(seen2, np.log10(p2), np.nan), np.where(c3 > 0, np.log10(p3), np.nan)]
        self.fail_to = np.concatenate((np.zeros(1 + w, np.int32), 1 + last))
        self.fail_weight = np.concatenate(([0.0], np.log10(mu / (c1 + mu)), np.log10(mu3 / (c2 + mu3))))
        self.pair_state = np.where(seen2, 1 + w + np.arange(len(c2), dtype=np.int32), np.where(c1[last] > 0, 1 + last, 0)).astype(np.int32)
        self.n_words, self.start = w, 1 + end if c1[end : end + 1].sum() > 0 else 0

    def traverse(self, grams: Grams, ends: np.ndarray) -> np.ndarray:
        """Log10 probability of each text.

        Every arc of a token leads to the state of the longest history that it closes, so the states that
        the texts carry from token to token are known beforehand; from these all tokens look for their
        arc at once, and follow failure arcs until they have one."""
        arcs = (grams.word_at, grams.pair_at, grams.triple_at)
        carried = np.empty(len(grams.word_at), np.int32)
        carried[1:] = self.pair_state[grams.pair_at[:-1]]
        starts = ends - np.diff(ends, prepend=0)
        carried[starts] = self.start
        score = np.zeros(len(carried))
        for a in range(0, len(carried), STEP):
            state = carried[a : a + STEP]
            live = np.arange(a, a + len(state))
            while len(live):
                order = (state > 0).astype(np.int8) + (state > self.n_words)
                step = np.full(len(live), np.nan)
                for k, weights in enumerate(self.weights):
                    own = np.flatnonzero(order == k)
                    step[own] = weights[arcs[k][live[own]]]
                failed = np.isnan(step)
                score[live[~failed]] += step[~failed]
                live, state = live[failed], state[failed]
                score[live] += self.fail_weight[state]
                state = self.fail_to[state]
        return np.add.reduceat(score, starts) if len(ends) else np.zeros(0)


ASKED = "kind int, part long, src long, keys binary, n binary"
ANSWER = "kind int, part long, src long, sub int, totals binary"


def _table(schema: str, columns: list[list]) -> pa.Table:
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.table([pa.array(c, types[x.split()[1]]) for c, x in zip(columns, schema.split(", "), strict=True)], names=[x.split()[0] for x in schema.split(", ")])


def _split(keys: np.ndarray, used: int, bits: int) -> np.ndarray:
    """Where the 2**bits equal parts begin of sorted hashes that agree in ``used`` leading bits, and the end."""
    if not len(keys):
        return np.zeros((1 << bits) + 1, np.int64)
    own = (keys << np.uint64(used)) >> np.uint64(64 - bits) if bits else np.zeros(len(keys), np.uint64)
    return np.searchsorted(own, np.arange((1 << bits) + 1))


def answers(asked: DataFrame, sources: int, levels: list[int], used: int = 0, questions: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] = iter) -> DataFrame:
    """(kind, part, src, sub, totals): for each question and each of 2**levels[0] parts of its range the totals of its keys.

    asked: sorted hashes and their counts, by kind, part of the hash range (of 2**used) and one of so many sources.
    For kind 0 there are also statistics of each part (src -1). Where ``questions`` makes them of the rows of ``asked``, the same
    Python worker splits them: a second one for each task would take the memory of its libraries again."""
    bits, last = levels[0], len(levels) == 1
    fan = 1 << bits

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in questions(batches):
            for row in batch.to_pylist():
                keys, n = _unpack_sorted(row["keys"]), _expand(row["n"], np.uint32)
                cut = _split(keys, used, bits)
                each = range(fan)
                yield from _table(ASKED + ", sub int", [[row["kind"]] * fan, [row["part"]] * fan, [row["src"]] * fan, [_pack_sorted(keys[cut[s] : cut[s + 1]]) for s in each], [_squeeze(n[cut[s] : cut[s + 1]]) for s in each], list(each)]).to_batches()

    def merged(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Distinct hashes, their summed counts, and where each row's are among them."""
        keys = [_unpack_sorted(x) for x in table.column("keys").to_pylist()]
        n = np.concatenate([_expand(x, np.uint32) for x in table.column("n").to_pylist()]).astype(np.float64)
        found, at = np.unique(np.concatenate(keys), return_inverse=True)
        return found, np.bincount(at, n, len(found)).astype(np.int64), np.split(at, np.cumsum([len(k) for k in keys])[:-1])

    parts = asked.mapInArrow(ask, ASKED + ", sub int")
    if last:

        def answer(key: tuple, table: pa.Table) -> pa.Table:
            kind, part, sub = (x.as_py() for x in key)
            _, total, places = merged(table)
            src, out = table.column("src").to_pylist(), [_squeeze(total[at].astype(np.uint64)) for at in places]
            if kind == 0:
                src.append(-1)
                out.append(np.array([total.sum(), (total > 0).sum(), (total == 1).sum(), (total == 2).sum()], np.int64).tobytes())
            return _table(ANSWER, [[kind] * len(src), [part] * len(src), src, [sub] * len(src), out])

        return parts.groupBy("kind", "part", "sub").applyInArrow(answer, ANSWER)

    # Too many parts for one step: the questions of ``fan`` sources become one, which is asked on.
    joint_schema = ASKED + ", maps binary, srcs binary, sizes binary"

    def join(key: tuple, table: pa.Table) -> pa.Table:
        kind, part, sub, group = (x.as_py() for x in key)
        found, total, places = merged(table)
        srcs, sizes = np.array(table.column("src").to_pylist(), np.int64), np.array([len(p) for p in places], np.int64)
        return _table(joint_schema, [[kind], [part * fan + sub], [group], [_pack_sorted(found)], [_squeeze(np.minimum(total, 0xFFFFFFFF).astype(np.uint32))], [_squeeze(np.concatenate(places).astype(np.uint32))], [srcs.tobytes()], [sizes.tobytes()]])

    groups = -(-sources // fan)
    joint = Staged(parts.withColumn("grp", F.pmod(F.xxhash64("src"), F.lit(groups))).groupBy("kind", "part", "sub", "grp").applyInArrow(join, joint_schema), "lm-joint").read()
    inner = Staged(answers(joint.select(*[x.split()[0] for x in ASKED.split(", ")]), groups, levels[1:], used + bits), "lm-inner").read()

    def expand(key: tuple, asked_: pa.Table, got: pa.Table) -> pa.Table:
        row = asked_.to_pylist()[0]
        total = np.concatenate([_expand(x, np.uint64) for x in got.sort_by("sub").column("totals").to_pylist()])[_expand(row["maps"], np.uint32)]
        srcs, sizes = np.frombuffer(row["srcs"], np.int64), np.frombuffer(row["sizes"], np.int64)
        each = np.split(total, np.cumsum(sizes)[:-1])
        n = len(srcs)
        return _table(ANSWER, [[row["kind"]] * n, [row["part"] // fan] * n, srcs.tolist(), [row["part"] % fan] * n, [_squeeze(x) for x in each]])

    out = joint.groupBy("kind", "part", "src").cogroup(inner.filter("src >= 0").groupBy("kind", "part", "src")).applyInArrow(expand, ANSWER)
    return out.unionByName(inner.filter("src < 0"))


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, mean_score double"


def lm_score(df: DataFrame, *, mu: float = 1000.0, mu3: float = 20.0, alpha: float = 0.1, block_bytes: int = BLOCK_BYTES, fan_bits: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, mean_score (of a token)."""
    held = Staged(blocks(df, id_col, text_col, block_bytes), "lm-blocks").read()
    n_blocks = held.select("block").count()
    bits = max(1, (n_blocks - 1).bit_length())
    levels = [min(fan_bits, bits - k) for k in range(0, bits, fan_bits)]

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each kind (0 words, 1 pairs, 2 triples): the block's sorted distinct hashes, and counts in training."""
        for batch in batches:
            for row in batch.to_pylist():
                _, flags, ends, words, tokens = _load(row)
                trained = np.repeat(flags & HELD == 0, np.diff(ends, prepend=0))
                for kind, (keys, at) in enumerate(Grams(words, tokens, ends).kinds()):
                    n = np.bincount(at[trained & (at >= 0)], minlength=len(keys)).astype(np.uint32)
                    yield from _table(ASKED, [[kind], [0], [row["block"]], [_pack_sorted(keys)], [_squeeze(n)]]).to_batches()

    got = Staged(answers(held, n_blocks, levels, questions=ask), "lm-answers").read()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(4, np.int64)
        for batch in batches:
            for x in batch.column(0).to_pylist():
                total += np.frombuffer(x, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([int(v)], pa.int64()) for v in total], names=["total", "distinct", "once", "twice"])

    names = ("total", "distinct", "once", "twice")
    sums = got.filter("src = -1").select("totals").mapInArrow(add, ", ".join(f"{n} long" for n in names))
    row = sums.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names]).first()
    stats = {n: row[n] for n in names}

    def score(key: tuple, block: pa.Table, totals: pa.Table) -> pa.Table:
        ids, flags, ends, words, tokens = _load(block.to_pylist()[0])
        totals = totals.sort_by([("kind", "ascending"), ("sub", "ascending")])
        grams = Grams(words, tokens, ends)
        counts = [np.concatenate([_expand(x, np.uint64) for x in totals.filter(pc.equal(totals.column("kind"), kind)).column("totals").to_pylist()]).astype(float) for kind in range(3)]
        starts, lengths = ends - np.diff(ends, prepend=0), np.diff(ends, prepend=0)
        log_p = Automaton(grams, counts, stats, mu, mu3).traverse(grams, ends)
        base = np.log10((counts[0] + alpha) / (stats["total"] + alpha * (stats["distinct"] + 1)))
        known = np.add.reduceat((counts[0] > 0).astype(np.int64)[tokens], starts)
        doc_id = pa.array(ids, mask=flags & NULL_ID > 0)
        return pa.table([doc_id, pa.array(flags & HELD > 0), pa.array(lengths), pa.array(known), pa.array(np.full(len(ids), stats["total"])), pa.array(np.add.reduceat(base[tokens], starts)), pa.array(log_p), pa.array(log_p / lengths)], names=[x.split()[0] for x in SCORED.split(", ")])

    return held.groupBy("block").cogroup(got.filter("src >= 0").groupBy("src")).applyInArrow(score, SCORED)
