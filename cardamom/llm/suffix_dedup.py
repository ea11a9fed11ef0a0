"""Exact removal of long repeats by merging sparse suffix arrays and their Burrows-Wheeler columns.

Every byte that a string of ``length`` bytes covers goes if the string starts
anywhere else too. Besides, the bytes that repeated strings of ``passage`` bytes cover are
counted. Only sampled suffixes are sorted: of each 128 positions in a row
the one whose 32 bytes hash least is an anchor, so equal strings have equal anchors and
all strings that start at p are found at the anchor of p.

1. Texts that are the same are one text. Anchors whose next ``passage - 127`` bytes
   occur once in the corpus are left out: nothing at them repeats.
2. Each shard of texts yields the suffixes at its anchors and, as their
   Burrows-Wheeler columns, the up to 127 bytes before them.
3. The shards' suffixes are dealt out by ranges of their order, so many that share one prefix
   are several tasks' work. A task merges its shards' by refining their interleave: intervals
   that agree in k words are split by the next word, those of one suffix are done. The splits
   give the common prefixes of neighbours.
4. Going backwards through the columns, an interval of suffixes that agree in
   length - o bytes is refined by the o bytes before; what holds two or more is a repeat.
5. An interval at the edge of a range may go on in the next one. The suffixes of such intervals are
   sorted once more, by their columns: a string that starts o bytes before a suffix repeats only if
   a neighbour there has the same o bytes before it. What is left of the edges' strings, each
   once for a range, is settled by counting their 128-bit hashes.

Texts are UTF-8 bytes; null is empty. Repeated rows are copies, so they go if they are
long enough. An empty table gives an empty result. Columns besides id and text do
not matter."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardamom.llm._common import Staged, join_spread
from cardamom.llm.packing import chunks

WINDOW, GRAM = 128, 32
BLOOM_BITS = 25
FOUND = "k1 long, k2 long, at binary, f1 long, f2 long, tail binary, before binary, mark binary, tell binary"
_K = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _least(key: np.ndarray) -> np.ndarray:
    """The least of each WINDOW values in a row, by running minima within aligned blocks."""
    n = len(key)
    pad = np.full(-n % WINDOW, np.iinfo(np.uint64).max, np.uint64)
    rows = np.concatenate((key, pad)).reshape(-1, WINDOW)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - WINDOW + 1], ahead[WINDOW - 1 : n])


def anchors(data: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, least o, most o): strings of ``length`` bytes start at anchor - o, for these o."""
    n = len(data)
    if n < length:
        none = np.zeros(0, np.int64)
        return none, none, none
    m = n - GRAM + 1
    word = np.ndarray((n - 7,), np.dtype("<u8"), data, strides=(1,))
    h = word[:m] * _K[0]
    for k in (1, 2, 3):
        h ^= h >> np.uint64(31)
        h += word[8 * k : 8 * k + m] * _K[k]
    h ^= h >> np.uint64(29)
    h *= _K[1]
    # ties go to the later position
    key = (h & np.uint64(0xFFFFFFFF00000000)) | (np.uint64(0xFFFFFFFF) - np.arange(m, dtype=np.uint64))
    at = np.uint64(0xFFFFFFFF) - (_least(key)[: n - length + 1] & np.uint64(0xFFFFFFFF))
    at = at.astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    last = np.append(first[1:], len(at)) - 1
    return at[first], at[first] - last, at[first] - first


def _prefixes(data: bytes, at: np.ndarray, length: int) -> np.ndarray:
    """128-bit hashes of the length - 127 bytes at each anchor, as two signed longs."""
    import xxhash

    size = length - (WINDOW - 1)
    h = xxhash.xxh3_128_digest
    return np.frombuffer(b"".join(h(data[a : a + size]) for a in at.tolist()), "<i8").reshape(-1, 2)


def _listed(df: DataFrame, length: int) -> DataFrame:
    """(f, k1, twice) of each text's distinct anchors: prefix, text key, whether it stands there twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()  # copies are listed once in a task
        for batch in (x for whole in batches for x in chunks(whole, 1)):
            fs, ks, ts = [], [], []
            for k1, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if k1 in done:
                    continue
                done.add(k1)
                data = text.as_buffer().to_pybytes()
                at, _, _ = anchors(data, length)
                if len(at):
                    f, n = np.unique(_prefixes(data, at, length)[:, 0], return_counts=True)
                    fs.append(f)
                    ks.append(np.full(len(f), k1))
                    ts.append(n > 1)
            if fs:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (fs, ks, ts)], names=["f", "k1", "twice"])

    return df.select("k1", "text").mapInArrow(run, "f long, k1 long, twice boolean")


def _grouped(batches: Iterator[pa.RecordBatch], by: str, least: int) -> Iterator[pa.Table]:
    """Tables of whole groups from rows sorted by a column, of ``least`` rows or more but the last."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.num_rows
        if size < least:
            continue
        t = pa.Table.from_batches(held)
        v = t.column(by).to_numpy()
        same = np.flatnonzero(v != v[-1])
        cut = int(same[-1]) + 1 if len(same) else 0
        if cut:
            yield t.slice(0, cut)
            held, size = t.slice(cut).combine_chunks().to_batches(), t.num_rows - cut
    if held:
        yield pa.Table.from_batches(held)


def _with_ends(tables: Iterator[pa.Table]) -> Iterator[tuple[pa.Table, bool, bool]]:
    """Each table, whether it is the first, and whether it is the last."""
    held, first = None, True
    for t in tables:
        if held is not None:
            yield held, first, False
            first = False
        held = t
    if held is not None:
        yield held, first, True


def _shared(listed: DataFrame) -> DataFrame:
    """(k1, f): the prefixes that stand twice in a text or in two texts.

    Rows are dealt out by ranges of (f, k1), so a prefix of very many texts is several tasks'
    work. Whether the first and last prefix of a range go on in another is told by joining these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, first, last in _with_ends(_grouped(batches, "f", 100_000)):
            f, k, twice = (t.column(c).to_numpy(zero_copy_only=False) for c in ("f", "k1", "twice"))
            new = np.concatenate(([True], (f[1:] != f[:-1]) | (k[1:] != k[:-1])))
            start = np.flatnonzero(new)
            twice = np.logical_or.reduceat(twice, start)
            f, k = f[start], k[start]
            group = np.flatnonzero(np.concatenate(([True], f[1:] != f[:-1])))
            n = np.diff(np.append(group, len(f)))
            sure = np.repeat((n > 1) | np.logical_or.reduceat(twice, group), n)
            edge = (first & (f == f[0])) | (last & (f == f[-1]))
            keep = sure | edge
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (k, f, sure, edge)], names=["k1", "f", "sure", "edge"])

    ranges = listed.repartitionByRange("f", "k1").sortWithinPartitions("f", "k1")
    rows = Staged(ranges.mapInArrow(run, "k1 long, f long, sure boolean, edge boolean"), "repeats-prefixes").read()
    several = rows.filter("edge").groupBy("f").agg(F.count("*").alias("n")).filter("n > 1").select("f")
    return rows.filter("sure").select("k1", "f").unionByName(rows.filter("not sure").select("k1", "f").join(several, "f", "left_semi"))


class Merged:
    """Suffixes of several shards, merged.

    prefix: number of each suffix's group (same first bytes); tails: its next bytes, padded with
    zeros to whole words; before: the bytes before it, the nearest first, padded to 128;
    places: how often the suffix stands in its text with just these bytes around it."""

    def __init__(self, prefix: np.ndarray, tails: np.ndarray, before: np.ndarray, places: np.ndarray):
        n, width = tails.shape
        order = np.argsort(prefix, kind="stable")
        words = np.ascontiguousarray(tails).view(">u8").astype(np.uint64)
        lcp = np.full(n, width, np.int16)  # with the one before it in the order; -1: another group
        start = np.concatenate(([True], prefix[order][1:] != prefix[order][:-1]))
        lcp[start] = -1
        for k in range(width // 8):  # refine the interleave by one more word
            interval = np.cumsum(start) - 1
            live = np.flatnonzero(np.bincount(interval)[interval] > 1)
            if not len(live):
                break
            word = words[order[live], k]
            by = np.lexsort((word, interval[live]))
            order[live] = order[live][by]
            word, own = word[by], interval[live]
            differ = np.flatnonzero((own[1:] == own[:-1]) & (word[1:] != word[:-1])) + 1
            x = word[differ] ^ word[differ - 1]
            byte = np.zeros(len(x), np.int16)  # equal leading bytes
            for j in range(7, 0, -1):
                byte += (x >> np.uint64(8 * (8 - j))) == 0
            lcp[live[differ]] = 8 * k + byte
            start[live[differ]] = True
        self.order, self.lcp, self.before, self.weight = order, lcp, before[order], places[order]

    def repeats(self, tail: int, least: np.ndarray, most: np.ndarray, first: bool, last: bool) -> tuple[np.ndarray, np.ndarray]:
        """For each suffix and o, of the string from o bytes before it to ``tail - o`` bytes behind its prefix: whether it
        repeats here, and whether other ranges must hear of it: its interval is at the edge of the range, if ``first``
        or ``last`` in it, and the suffix is the first one that has the string."""
        n = len(self.order)
        out, tell = np.zeros((n, WINDOW), bool), np.zeros((n, WINDOW), bool)
        z = np.random.default_rng(5).integers(0, 1 << 63, (WINDOW, 256), np.uint64)
        left = np.zeros(n, np.uint64)
        lo, hi, many = least[self.order], most[self.order], self.weight > 1
        for o in range(min(WINDOW, tail + 1)):
            new = self.lcp < tail - o
            fits = (lo <= o) & (o <= hi)
            # Suffixes alone in their interval are done.
            live = np.flatnonzero(fits & ~(new & np.append(new[1:], True)))
            twice, again = fits & many, np.zeros(n, bool)
            if len(live):
                block = np.cumsum(new)
                key = block[live].astype(np.uint64) * _K[0] + left[live]
                key ^= key >> np.uint64(32)
                key *= _K[3]
                by = np.argsort(key)
                same = key[by][1:] == key[by][:-1]
                again[live[by[1:]]] = same
                twice[live[by[1:]]] |= same
                twice[live[by[:-1]]] |= same
            out[self.order, o] = twice
            edge = np.zeros(n, bool)
            if first:
                edge[: int(np.argmax(new[1:])) + 1 if new[1:].any() else n] = True
            if last:
                edge[n - 1 - int(np.argmax(new[::-1])) :] = True
            tell[self.order, o] = edge & fits & ~again
            left += z[o][self.before[:, o]]
        return out, tell


def _strings(edges: DataFrame, tail_bytes: int) -> DataFrame:
    """(h1, h2, k1, k2, at, o, single): hashes of the strings at edges that may repeat."""

    def shared(t: pa.Table) -> np.ndarray:
        """How many of the bytes before each suffix the next one of the same prefix has too; -1: of another prefix."""
        before = np.frombuffer(b"".join(x.ljust(WINDOW, b"\0") for x in t.column("before").to_pylist()), np.uint8).reshape(-1, WINDOW)
        differ = before[1:] != before[:-1]
        n = np.where(differ.any(1), differ.argmax(1), WINDOW)
        f1, f2 = t.column("f1").to_numpy(), t.column("f2").to_numpy()
        return np.where((f1[1:] == f1[:-1]) & (f2[1:] == f2[:-1]), n, -1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        def give(t: pa.Table, upto: np.ndarray) -> Iterator[pa.RecordBatch]:
            for r, most in zip(t.to_pylist(), upto.tolist(), strict=True):
                tell, mark = (np.unpackbits(np.frombuffer(r[c], np.uint8)).reshape(2, WINDOW) for c in ("tell", "mark"))
                kinds, offsets = np.nonzero(tell[:, : most + 1])
                if not len(kinds):
                    continue
                head = r["f1"].to_bytes(8, "little", signed=True) + r["f2"].to_bytes(8, "little", signed=True)
                keys = b"".join(xxhash.xxh3_128_digest(head + bytes([k, o]) + r["before"][:o] + r["tail"][: (tail_bytes, WINDOW - 1)[k] - o]) for k, o in zip(kinds.tolist(), offsets.tolist(), strict=True))
                h, n = np.frombuffer(keys, "<i8").reshape(-1, 2), len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array([r["k1"]] * n, pa.int64()), pa.array([r["k2"]] * n, pa.int64()), pa.array([r["at"]] * n, pa.binary()), pa.array((offsets + WINDOW * kinds).astype(np.int32)), pa.array(mark[kinds, offsets] == 0)], names=["h1", "h2", "k1", "k2", "at", "o", "single"])

        held, before = None, WINDOW  # the first and last suffix of a range may have neighbours elsewhere
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([held, t]) if held is not None else t
            n = shared(t)
            yield from give(t.slice(0, len(n)), np.maximum(np.concatenate(([before], n))[:-1], n) if len(n) else n)
            held, before = t.slice(len(n)).combine_chunks(), int(n[-1]) if len(n) else before
        if held is not None:
            yield from give(held, np.array([WINDOW]))

    ranges = edges.repartitionByRange("f1", "f2", "before", "k1").sortWithinPartitions("f1", "f2", "before")
    return ranges.mapInArrow(run, "h1 long, h2 long, k1 long, k2 long, at binary, o int, single boolean")


def remove_repeats(df: DataFrame, *, length: int = 400, passage: int = 256, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_shared (and kept, binary, with ``with_text``).

    n_shared: bytes that strings of ``passage`` bytes cover which start anywhere else too."""
    if not 2 * WINDOW <= passage <= length:
        raise ValueError(f"passage must be {2 * WINDOW} or more, length no less")
    size = passage - (WINDOW - 1)
    tail_bytes = length - size
    spark = df.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))).alias("id"), text.alias("text"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(17), text).alias("k2"))
    base = docs.select("doc_id", "id", "k1", "k2", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("sha"), *(["text"] if with_text else []))
    texts = Staged(base.groupBy("k1", "k2").agg(F.min("id").alias("id"), F.count("*").alias("copies"), F.max("n_bytes").alias("n_bytes")), "repeats-texts").read()

    shared = Staged(_shared(Staged(_listed(docs.filter(F.octet_length("text") >= passage), passage), "repeats-listed").read()), "repeats-shared").read()
    per_text = shared.groupBy("k1").agg(F.collect_list("f").alias("fs")).join(texts, "k1").select("k1", "k2", "id", "fs")
    # Most texts share nothing: a filter of fixed size (4 MB) spares their way through the shuffle.
    slots = per_text.select(F.col("k1").bitwiseAND((1 << BLOOM_BITS) - 1).alias("b")).groupBy(F.shiftright("b", 6).alias("slot")).agg(F.bit_or(F.expr("shiftleft(1L, cast(b & 63 as int))")).alias("bits"))
    table = np.zeros(1 << (BLOOM_BITS - 6), np.int64)
    got = slots.toPandas()
    table[got["slot"].to_numpy(np.int64)] = got["bits"].to_numpy(np.int64)
    bitmap = spark.sparkContext.broadcast(table)

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value
        for batch in batches:
            k = batch.column(0).to_numpy() & ((1 << BLOOM_BITS) - 1)
            own = batch.filter(pa.array((bits[k >> 6] >> (k & 63)) & 1 == 1))
            packed = [pa.compress(x.as_buffer().to_pybytes(), "zstd", asbytes=True) for x in own.column(3)]
            yield pa.RecordBatch.from_arrays([*own.columns[:3], pa.array(packed, pa.binary()), pc.binary_length(own.column(3).cast(pa.binary())).cast(pa.int64())], names=["k1", "k2", "id", "packed", "n"])

    sifted = docs.select("k1", "k2", "id", "text").mapInArrow(sift, "k1 long, k2 long, id long, packed binary, n long")
    live = Staged(sifted.join(per_text, ["k1", "k2", "id"]).dropDuplicates(["k1", "k2", "id"]).select("k1", "k2", "packed", "n", "fs"), "repeats-live").read()

    names = ["f1", "f2", "k1", "k2", "at", "n", "least", "most", "tail", "before"]

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                data = pa.decompress(row["packed"], decompressed_size=row["n"], codec="zstd", asbytes=True)
                at, least, most = anchors(data, passage)
                f = _prefixes(data, at, passage)
                keep = np.isin(f[:, 0], np.array(row["fs"], np.int64))
                at, least, most, f = at[keep], least[keep], most[keep], f[keep]
                # Anchors of a text with the same bytes around them are one suffix, at several places.
                same: dict[tuple, list[int]] = {}
                for a, x, y, lo, hi in zip(at.tolist(), f[:, 0].tolist(), f[:, 1].tolist(), least.tolist(), most.tolist(), strict=True):
                    same.setdefault((x, y, lo, hi, data[a + size : a + length], data[a - hi : a][::-1]), []).append(a)
                if not same:
                    continue
                f1, f2, least, most, tail, before = zip(*same, strict=True)
                places = [np.array(x, "<i8").tobytes() for x in same.values()]
                cols = (f1, f2, [row["k1"]] * len(same), [row["k2"]] * len(same), places, list(map(len, same.values())), least, most, tail, before)
                types = [pa.int64()] * 4 + [pa.binary(), pa.int64(), pa.int16(), pa.int16(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

    def padded(values: pa.ChunkedArray, width: int) -> np.ndarray:
        out = b"".join(x.ljust(width, b"\0") for x in values.to_pylist())
        return np.frombuffer(out, np.uint8).reshape(-1, width)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Suffixes with what repeats here (a bit for each kind of string and o) and what other ranges must hear of."""
        for t, first, last in _with_ends(_grouped(batches, "f1", 50_000)):
            f1, f2 = t.column("f1").to_numpy(), t.column("f2").to_numpy()
            least, most = t.column("least").to_numpy(), t.column("most").to_numpy()
            group = np.cumsum(np.concatenate(([True], (f1[1:] != f1[:-1]) | (f2[1:] != f2[:-1]))))
            merged = Merged(group, padded(t.column("tail"), -(-tail_bytes // 8) * 8), padded(t.column("before"), WINDOW), t.column("n").to_numpy())
            behind = pc.binary_length(t.column("tail")).to_numpy()
            # strings of ``length`` and of ``passage`` bytes
            both = [merged.repeats(tail, np.maximum(least, tail - behind), most, first, last) for tail in (tail_bytes, WINDOW - 1)]
            mark, tell = (np.concatenate(x, axis=1) for x in zip(*both, strict=True))
            told = tell.any(1)
            hit = np.flatnonzero(mark.any(1) | told)
            if len(hit):
                own, none = t.take(pa.array(hit)), ~told[hit]
                bits = lambda x: pa.array([y.tobytes() for y in np.packbits(x[hit], axis=1)], pa.binary())
                away = lambda c: pc.if_else(pa.array(none), None, c)
                cols = [own.column(c).combine_chunks() for c in ("k1", "k2", "at", "f1", "f2", "tail", "before")]
                yield pa.RecordBatch.from_arrays([*cols[:5], *(away(c) for c in cols[5:]), bits(mark), away(bits(tell))], names=[x.split()[0] for x in FOUND.split(", ")])

    schema = "f1 long, f2 long, k1 long, k2 long, at binary, n long, least short, most short, tail binary, before binary"
    rows = Staged(live.mapInArrow(suffixes, schema), "repeats-suffixes").read()
    ranges = rows.repartitionByRange("f1", "f2", "tail", "before", "k1").sortWithinPartitions("f1", "f2")
    found = Staged(ranges.mapInArrow(merge, FOUND), "repeats-marks").read()

    def bits_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mask = np.zeros((batch.num_rows, 2 * WINDOW), bool)
            for k, o in enumerate(batch.column(3).to_pylist()):
                mask[k, o] = True
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([x.tobytes() for x in np.packbits(mask, axis=1)], pa.binary())], names=["k1", "k2", "at", "bits"])

    edges = Staged(_strings(found.filter("tell is not null"), tail_bytes), "repeats-edges").read()
    twice = edges.groupBy("h1", "h2").agg(F.count("*").alias("n")).filter("n > 1").select("h1", "h2")
    hits = edges.filter("single").join(twice, ["h1", "h2"], "left_semi").groupBy("k1", "k2", "at").agg(F.collect_set("o").alias("os"))  # 256 at most
    marks = found.select("k1", "k2", "at", F.col("mark").alias("bits")).unionByName(hits.mapInArrow(bits_of, "k1 long, k2 long, at binary, bits binary"))

    def cut(key: tuple, text: pa.Table, own: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if text.num_rows and own.num_rows:
            row = text.slice(0, 1).to_pylist()[0]
            data = pa.decompress(row["packed"], decompressed_size=row["n"], codec="zstd", asbytes=True)
            bits = np.unpackbits(np.frombuffer(b"".join(own.column("bits").to_pylist()), np.uint8).reshape(-1, 2 * WINDOW // 8), axis=1)
            places = own.column("at").to_pylist()
            bits = np.repeat(bits, [len(x) // 8 for x in places], axis=0)
            place, covered = np.frombuffer(b"".join(places), "<i8"), []
            for kind, reach in enumerate((length, passage)):
                k, o = np.nonzero(bits[:, kind * WINDOW : (kind + 1) * WINDOW])
                p = place[k] - o
                step = np.bincount(p, minlength=row["n"] + 1) - np.bincount(p + reach, minlength=row["n"] + 1)
                covered.append(np.cumsum(step)[:-1] > 0)
            gone, shared_ = covered
            kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
            spans = int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
            out.append((row["k1"], row["k2"], int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), int(shared_.sum()), kept if with_text else None))
        cols = list(zip(*out, strict=True)) if out else [[]] * 7
        types = [pa.int64()] * 4 + [pa.string(), pa.int64(), pa.binary()]
        return pa.table([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["k1", "k2", "n_removed", "n_spans", "kept_sha256", "n_shared", "kept"])

    done = live.select("k1", "k2", "packed", "n").groupBy("k1", "k2").cogroup(marks.groupBy("k1", "k2")).applyInArrow(cut, "k1 long, k2 long, n_removed long, n_spans long, kept_sha256 string, n_shared long, kept binary")
    copied = F.col("copies") > 1
    whole = copied & (F.col("n_bytes") >= length)
    nothing = hashlib.sha256(b"").hexdigest()
    facts = texts.join(done, ["k1", "k2"], "left").filter((copied & (F.col("n_bytes") >= passage)) | F.col("n_removed").isNotNull()).select(
        "k1", "k2",
        F.when(whole, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(whole, F.lit(1).cast("long")).otherwise(F.col("n_spans")).alias("n_spans"),
        F.when(whole, F.lit(nothing)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
        F.when(copied & (F.col("n_bytes") >= passage), F.col("n_bytes")).otherwise(F.col("n_shared")).alias("n_shared"),
        F.when(whole, F.lit(b"")).otherwise(F.col("kept")).alias("kept"),
    )
    zero = F.lit(0).cast("long")
    out = join_spread(base, facts, ["k1", "k2"], texts.select("k1", "k2", F.col("copies").alias("n")), "id")
    cols = ["doc_id", "n_bytes", *[F.coalesce(c, zero).alias(c) for c in ("n_removed", "n_spans")], F.coalesce("kept_sha256", "sha").alias("kept_sha256"), F.coalesce("n_shared", zero).alias("n_shared")]
    return out.select(*cols, *([F.coalesce("kept", F.col("text").cast("binary")).alias("kept")] if with_text else []))
