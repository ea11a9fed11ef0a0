"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints of equal value are one node from the start, so groups of copies cost
one row. The bits are grouped into partitions, correlated ones together; dynamic
programming gives each partition a threshold (those of m partitions sum to
limit - m + 1) for the least estimated number of candidates and probes. Two
fingerprints within the limit are within the threshold in at least one partition, where
the one is found among the probes of the other; candidates are verified. A bucket
of over ``block`` rows is compared in pairs of blocks, each its own group. A group
yields a spanning forest of its verified links, not its pairs.

Null, empty and blank texts have fingerprint zero and are linked like any other.
Repeated rows share a fingerprint. An empty table gives an empty result. Other
columns of the input do not matter.

The near-duplicate stage (``similar_groups``, ``one_of_each``) asks for a Jaccard similarity, which
no limit on fingerprints tells. It verifies the links of the fingerprints on whole texts,
and finds the rest by joining texts by their rarest shingles; texts of a shingle that many share
are compared in blocks, so rows do not grow with the square of such a group."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardamom.llm._common import Staged, at_most, sifted, tasks_for
from cardamom.llm.components import components

BITS = 64


def fingerprint(text: str | None, width: int = 4, seed: int = 42) -> int:
    """The fingerprint, unsigned: the majority of each bit over the shingles' hashes."""
    import xxhash

    h = xxhash.xxh64_intdigest
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        return h(joined, seed)
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    starts = itertools.chain((0,), ends)
    n, ones = len(words) - width + 1, np.zeros(BITS, np.int64)
    pairs = zip(starts, itertools.islice(ends, width - 1, None))  # noqa: B905  starts has more
    while chunk := [h(joined[a : b - 1], seed) for a, b in itertools.islice(pairs, 65536)]:
        bits = np.unpackbits(np.array(chunk, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.uint32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint's 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.fromiter((fingerprint(x.as_py(), width) for x in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], names=["doc_id", "fp"])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def bit_statistics(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """The number of fingerprints and the 64 x 64 matrix of how often two bits are both set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros((BITS, BITS))
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float64)
            n, total = n + len(values), total + bits.T @ bits
        at = np.arange(BITS * BITS + 1)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.append(total.ravel(), n).astype(np.int64))], names=["k", "v"])

    sums = nodes.select("fp").mapInArrow(run, "k long, v long").groupBy("k").agg(F.sum("v").alias("v"))
    held = dict(sums.collect())  # 4,097 sums, whatever the input
    n = held.get(BITS * BITS, 0)
    return n, np.array([held.get(k, 0) for k in range(BITS * BITS)], float).reshape(BITS, BITS)


def group_bits(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """m partitions of the 64 bits of nearly equal size, each grown by the bit most correlated with it."""
    mean = np.diag(both) / max(n, 1)
    cov = both / max(n, 1) - np.outer(mean, mean)
    sd = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    corr = np.abs(cov / np.outer(sd, sd))
    left, out = set(range(BITS)), []
    for k in range(m):
        size = (len(left) + m - k - 1) // (m - k)
        part = [min(left, key=lambda j: (abs(mean[j] - 0.5), j))]
        left.remove(part[0])
        while len(part) < size:
            best = max(left, key=lambda j: (corr[j, part].sum(), -j))
            part.append(best)
            left.remove(best)
        out.append(sorted(part))
    return out


def _pairs_within(n: int, mean: np.ndarray, part: list[int], most: int) -> list[float]:
    """Expected pairs at distance 0..most within a partition, from the bits' shares, cumulated."""
    dist = np.zeros(most + 2)
    dist[0] = 1.0
    for j in part:
        differ = 2 * mean[j] * (1 - mean[j])
        moved = np.roll(dist, 1) * differ
        moved[0] = 0
        dist = dist * (1 - differ) + moved
    return list(np.cumsum(dist[: most + 1]) * n * (n - 1) / 2)


def allocate(n: int, both: np.ndarray, limit: int, probe_cost: float = 1000.0) -> tuple[list[list[int]], list[int]]:
    """Partitions and thresholds of the least estimated cost: candidates, and ``probe_cost`` for each row emitted.

    A threshold of -1 leaves a partition out."""
    mean, best = np.diag(both) / max(n, 1), None
    for m in range(1, limit + 2):
        parts = group_bits(n, both, m)
        cost = []
        for part in parts:
            pairs = _pairs_within(n, mean, part, limit)
            cost.append([0.0] + [pairs[t] + probe_cost * n * sum(comb(len(part), i) for i in range(t + 1)) for t in range(limit + 1)])
        # table[u]: the least cost of the partitions so far with u units; a threshold t takes t + 1 units
        table: list[tuple[float, list[int]]] = [(0.0, [])] + [(float("inf"), [])] * (limit + 1)
        for k in range(m):
            new = []
            for u in range(limit + 2):
                new.append(min(((table[u - t - 1][0] + cost[k][t + 1], table[u - t - 1][1] + [t]) for t in range(-1, u)), key=lambda x: x[0]))
            table = new
        total, thresholds = table[limit + 1]
        if best is None or total < best[0]:
            best = (total, parts, thresholds)
    return best[1], best[2]


def _grown(v: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """The forest below by growing trees: for groups in which most values are linked."""
    left, links = np.arange(1, len(v)), []
    near = np.bitwise_count(v[left] ^ v[0]).astype(np.uint8)
    at = np.zeros(len(left), np.int64)
    while len(left):
        k = int(np.argmin(near))
        new = left[k]
        if near[k] <= limit:
            links.append((v[at[k]], v[new]))
        keep = np.arange(len(left)) != k
        left, near, at = left[keep], near[keep], at[keep]
        d = np.bitwise_count(v[left] ^ v[new])
        closer = d < near
        near[closer], at[closer] = d[closer], new
    return links


def _forest(v: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Links within the limit among values, as a spanning forest of the closest ones."""
    v = np.unique(v)
    if len(v) == 2:
        return [(v[0], v[1])] if int(v[0] ^ v[1]).bit_count() <= limit else []
    found, total = [], 0
    rows = max(16, (1 << 21) // len(v))  # 16 MB at a time
    for a in range(0, len(v) - 1, rows):
        d = np.bitwise_count(v[a : a + rows, None] ^ v[None, a:])
        i, j = np.nonzero(d <= limit)
        up = j > i
        i, j = i[up], j[up]
        found.append((i + a, j + a, d[i, j]))
        total += len(i)
        if total > 20 * len(v) + 10_000:
            return _grown(v, limit)
    i, j, d = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
    parent, links = {}, []

    def root(x: int) -> int:
        while (y := parent.get(x, x)) != x:
            parent[x] = parent.get(y, y)
            x = y
        return x

    by = np.argsort(d, kind="stable")
    for x, y in zip(i[by].tolist(), j[by].tolist(), strict=True):
        a, b = root(x), root(y)
        if a != b:
            parent[a] = b
            links.append((v[x], v[y]))
    return links


def near_links(nodes: DataFrame, limit: int, block: int = 8_192, temporary: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """(a, b): fingerprints within ``limit`` bits; of each group the closest links that keep together what is linked."""
    n, both = bit_statistics(nodes)
    parts, thresholds = allocate(n, both, limit)
    used = [(k, p, t) for k, (p, t) in enumerate(zip(parts, thresholds, strict=True)) if t >= 0]

    def signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (part, key, fp): the partition's bits, packed; for thresholds over 0 also all keys within it."""
        for batch in batches:
            raw = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            fp = raw.view(np.uint64)
            for k, bits, t in used:
                key = np.zeros(len(fp), np.uint64)
                for at, j in enumerate(bits):
                    key |= ((fp >> np.uint64(j)) & np.uint64(1)) << np.uint64(at)
                flips = [0] + [sum(1 << i for i in c) for r in range(1, t + 1) for c in itertools.combinations(range(len(bits)), r)]
                for x in flips:
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(fp), k, np.int32)), pa.array((key ^ np.uint64(x)).view(np.int64)), pa.array(raw)], names=["part", "key", "fp"])

    rows = nodes.select("fp").mapInArrow(signatures, "part int, key long, fp long")
    rows = temporary(rows, "signatures") if temporary else Staged(rows, "signatures").read()
    # Buckets over the block size are split; few rows, but any number.
    sizes = rows.groupBy("part", "key").agg(F.count("*").alias("n")).filter(F.col("n") > block)
    g = F.ceil(F.col("n") / block).cast("int")
    rows = rows.join(sizes.select("part", "key", g.alias("g")), ["part", "key"], "left").withColumn("g", F.coalesce("g", F.lit(1)))
    mine = F.pmod(F.xxhash64("fp"), F.col("g")).cast("int")
    rows = rows.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("g") - 1))).withColumn("mine", mine)
    rows = rows.select("part", "key", F.least("mine", "j").alias("i"), F.greatest("mine", "j").alias("j"), "fp")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted rows: a group is complete when the next one starts."""
        held = None

        def links_of(t: pa.Table) -> list[tuple[int, int]]:
            part = t.column("part").to_numpy()
            cut = np.ones(len(part), bool)
            cut[1:] = False
            for c in ("part", "key", "i", "j"):
                v = t.column(c).to_numpy()
                cut[1:] |= v[1:] != v[:-1]
            starts = np.append(np.flatnonzero(cut), len(part))
            fp = t.column("fp").to_numpy().view(np.uint64)
            out = []
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                if b - a == 1:
                    continue
                out += _forest(fp[a:b], limit)
            return out

        def give(links: list) -> pa.RecordBatch:
            x = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1])], names=["a", "b"])

        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([held, t]) if held is not None else t
            if not t.num_rows:
                continue
            last = np.ones(t.num_rows, bool)
            for c in ("part", "key", "i", "j"):
                v = t.column(c).to_numpy()
                last &= v == v[-1]
            first = int(np.argmax(last)) if last[-1] else t.num_rows
            while first > 0 and last[first - 1]:
                first -= 1
            held, done = t.slice(first), t.slice(0, first)
            if done.num_rows and (links := links_of(done)):
                yield give(links)
        if held is not None and held.num_rows and (links := links_of(held)):
            yield give(links)

    cols = ["part", "key", "i", "j"]
    return rows.repartition(*cols).sortWithinPartitions(*cols).mapInArrow(verify, "a long, b long")


def _shingles(text: str | None, width: int) -> set[bytes]:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    joined = b" ".join(words)
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    return {joined[a : b - 1] for a, b in zip([0, *ends], ends[width - 1 :])} if len(words) > width else {joined}  # noqa: B905


def _set_hashes(text: str | None, width: int) -> np.ndarray:
    """The hashes of the distinct shingles, unsigned."""
    import xxhash

    h = xxhash.xxh64_intdigest
    return np.unique(np.array([h(s) for s in _shingles(text, width)], np.uint64))


#: Texts of which one is drawn at least, however many there are: a shingle of over FEW texts is to be known as common.
EVERY = 16


def common_shingles(docs: DataFrame, width: int, sample: int = 5_000, most: int = 100_000) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts) of the commonest shingles of a sample (``sample`` texts or one in EVERY, if these are more), by hash. They only
    set the order in which shingles are taken: any order gives the same links, this one the fewest candidates. Copies of a text count once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [_set_hashes(x.as_py(), width) for x in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array((np.concatenate(sets) if sets else np.zeros(0, np.uint64)).view(np.int64))], names=["token"])

    every = min(docs.count() // sample + 1, EVERY)
    drawn = docs.filter(F.pmod(F.xxhash64("node"), F.lit(every)) == 0).dropDuplicates(["node"]).select("text")
    sums = drawn.mapInArrow(run, "token long").groupBy("token").agg(F.count("*").alias("n")).filter("n > 2")
    table = Staged(sums.orderBy(F.desc("n"), "token").limit(most), "common-shingles")  # its shuffle files go
    held = table.read().toArrow()  # no row objects in the driver
    table.drop()
    hashes = held.column("token").to_numpy().view(np.uint64)
    by = np.argsort(hashes)
    return hashes[by], held.column("n").to_numpy()[by]


#: Shingles that two similar texts share among their first ones, if they have so many.
SHARED = 4


def prefixes(docs: DataFrame, width: int, similarity: float) -> DataFrame:
    """(token, node, size, pos): the first shingles of each text in one order for all, rare ones first.

    Of ``size`` shingles so many that two sets with the similarity share SHARED of them, or all that they
    have in common. A text that a task meets again is listed once."""
    common = docs.sparkSession.sparkContext.broadcast(common_shingles(docs, width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = common.value
        done: set[int] = set()
        for batch in batches:
            held = []
            for node, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if node in done:
                    continue
                done.add(node)
                own = _set_hashes(x.as_py(), width)
                rank = np.zeros(len(own), np.int64)
                if len(hashes):
                    at = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
                    rank = np.where(hashes[at] == own, counts[at], 0)
                n = len(own) - int(np.ceil(similarity * len(own) - 1e-6)) + SHARED
                first = own[np.lexsort((own, rank))][:n].view(np.int64)
                held.append((first, np.full(len(first), node, np.int64), np.full(len(first), len(own), np.int32), np.arange(len(first), dtype=np.int32)))
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held, strict=True)], names=["token", "node", "size", "pos"])

    return docs.select("node", "text").mapInArrow(run, "token long, node long, size int, pos int")


def _may_be_similar(x: str, y: str, similarity: float) -> Column:
    """False only where sizes, or what follows one of the first SHARED common shingles, rule the similarity out."""
    n, m = F.col(f"{x}size"), F.col(f"{y}size")
    rest = F.least(n - F.col(f"{x}pos"), m - F.col(f"{y}pos")) + (SHARED - 1)
    return (F.least(n, m) >= similarity * F.greatest(n, m) - 1e-6) & (rest >= similarity / (1 + similarity) * (n + m) - 1e-6)


def _texts_of(wanted: DataFrame, docs: DataFrame, name: str, tasks: int | None = None) -> Staged:
    """(node, text) of the wanted nodes, each once."""
    # the mark is a predicate, without which Spark makes no Bloom filter of a table
    nodes = Staged(at_most(wanted.select("node").distinct().withColumn("mark", F.lit(1)), tasks), "wanted-nodes")
    texts = docs.join(nodes.read().filter("mark = 1").select("node"), "node", "left_semi").select("node", "text").dropDuplicates(["node"])
    held = sifted(texts, name, tasks)
    nodes.drop()
    return held


def similar_links(links: DataFrame, docs: DataFrame, width: int, similarity: float, tasks: int | None = None) -> Staged:
    """The links (a, b) whose texts share ``similarity`` of all their shingles (Jaccard).

    docs: node, text. Each link carries its two texts once."""
    held = _texts_of(links.select(F.explode(F.array("a", "b")).alias("node")), docs, "similar-texts", tasks)
    texts = held.read()
    both = links.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a").join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, t = None, set()
        for batch in batches:
            keep = []
            for b, x, y in zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
                if b != last:
                    last, t = b, _shingles(y.as_py(), width)
                s = _shingles(x.as_py(), width)
                same = len(s & t)
                keep.append(same >= similarity * (len(s) + len(t) - same))
            yield batch.filter(pa.array(keep, pa.bool_())).select([0, 1])

    out = Staged(at_most(both.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long"), tasks), "similar-links")
    held.drop()
    return out


def _grouped(prints: DataFrame, nodes: DataFrame, links: DataFrame, key: str = "fp") -> DataFrame:
    """(doc_id, key, component_id) of the documents, from links between their nodes."""
    found = components(links)
    member = found.join(nodes.withColumnRenamed(key, "node"), "node")
    least = member.groupBy("component").agg(F.min("rep").alias("component_id"))
    known = member.select("node", "component").join(least, "component").select(F.col("node").alias(key), "component_id")
    per_node = nodes.join(known, key, "left").select(key, F.coalesce("component_id", "rep").alias("component_id"))
    return prints.join(per_node, key).select("doc_id", key, "component_id")


def _nodes(df: DataFrame, id_col: str, text_col: str, width: int) -> tuple[DataFrame, DataFrame]:
    prints = Staged(fingerprints(df, id_col=id_col, text_col=text_col, width=width), "fingerprints").read()
    return prints, Staged(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "nodes").read()


def simhash_groups(df: DataFrame, *, limit: int = 4, width: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id (least doc_id reachable)."""
    prints, nodes = _nodes(df, id_col, text_col, width)
    out = _grouped(prints, nodes, near_links(nodes, limit))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


#: Rows of first shingles above which they are put in order in SLICES parts, one after the other: their shuffle is the largest of all.
SLICED = 1 << 24
SLICES = 4


def neighbours(rows: DataFrame, temporary: Callable[[DataFrame, str], DataFrame], slices: int = 1) -> DataFrame:
    """The rows (token, node, size, pos) whose token others have too, with n_node, n_size, n_pos: the next of the token by size.

    Rows are dealt out by ranges, so the many of a common token are several tasks' work; the first and
    last row of each range (all are kept) are put in order afterwards, two for each range. With ``slices`` the tokens are taken in so
    many parts, each shuffled when the files of the one before are gone."""
    cols = ["token", "node", "size", "pos"]
    names = [*cols, "n_node", "n_size", "n_pos", "edge"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def give(t: pa.Table, keep: np.ndarray, nexts: list[pa.Array], edge: bool) -> pa.RecordBatch:
            own = t.filter(pa.array(keep))
            return pa.RecordBatch.from_arrays([*(own.column(c).combine_chunks() for c in cols), *(x.filter(pa.array(keep)) for x in nexts), pa.array(np.full(own.num_rows, edge))], names=names)

        held, before = None, False  # the last row so far, and whether it has one before it
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch.select(cols)])
            if held is None:
                yield give(t.slice(0, 1), np.ones(1, bool), [pa.nulls(1, x) for x in (pa.int64(), pa.int32(), pa.int32())], True)
            else:
                t = pa.concat_tables([held, t])
            token, node = t.column("token").to_numpy(), t.column("node").to_numpy()
            new = np.concatenate(([True], (token[1:] != token[:-1]) | (node[1:] != node[:-1])))
            if not new.all():  # the same text from several tasks
                t = t.filter(pa.array(new)).combine_chunks()
                token = t.column("token").to_numpy()
            same = token[1:] == token[:-1]
            prev = np.concatenate(([before], same))
            if len(same):
                follow = [pa.array(t.column(c).to_numpy()[1:], mask=~same) for c in cols[1:]]
                out = give(t.slice(0, len(same)), same | prev[:-1], follow, False)
                if out.num_rows:
                    yield out
            held, before = t.slice(len(same)).combine_chunks(), bool(prev[-1])
        if held is not None:
            yield give(held, np.ones(1, bool), [pa.nulls(1, x) for x in (pa.int64(), pa.int32(), pa.int32())], True)

    schema = "token long, node long, size int, pos int, n_node long, n_size int, n_pos int, edge boolean"
    found = None
    for k in range(slices):
        own = rows.filter(F.pmod("token", F.lit(slices)) == k) if slices > 1 else rows
        ranges = own.repartitionByRange("token", "size", "node").sortWithinPartitions("token", "size", "node")
        part = temporary(ranges.mapInArrow(run, schema), "neighbours")
        found = part if found is None else found.unionByName(part)
    order = Window.orderBy("token", "size", "node")
    ahead = F.lead(F.struct(*cols)).over(order)
    edges = found.filter("edge").select(*cols).withColumn("ahead", ahead)
    same = F.col("ahead.token") == F.col("token")
    edges = edges.select(*cols, *[F.when(same, F.col(f"ahead.{c}")).alias(f"n_{c}") for c in cols[1:]])
    return found.filter("not edge").drop("edge").unionByName(edges)


def _pairs(rows: DataFrame, similarity: float) -> DataFrame:
    """Distinct links (a < b) of neighbours that may be similar, and are neighbours in two shingles at least.

    A single one is mostly a phrase that unlike texts share; whatever is left out here, all candidates are met later."""
    near = rows.filter("n_node is not null and n_node <> node").select(*[F.col(c).alias(f"a_{c}") for c in ("node", "size", "pos")], *[F.col(f"n_{c}").alias(f"b_{c}") for c in ("node", "size", "pos")])
    near = near.filter(_may_be_similar("a_", "b_", similarity))
    return near.select(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b")).groupBy("a", "b").agg(F.count("*").alias("n")).filter("n > 1").select("a", "b")


def similar_nodes(df: DataFrame, *, similarity: float = 0.8, width: int = 5, limit: int = 4, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(doc_id, node) of the rows, nodes being distinct texts, and (node, component) of the nodes that have links.

    Linked are texts with ``similarity`` of shingles in common. All such texts are found:
    1. SimHash: fingerprints within ``limit`` bits (the links of ``near_links``, and each text with the next one of
       its fingerprint) are candidates, verified on whole texts.
    2. Two such texts share some of their first shingles (``prefixes``). Each text is held against those that are the next in size
       of two of these, if they are not of its group yet.
    3. Texts of like size that a shingle shared by over FEW of them leads to, directly or by way of others, are a family;
       all its texts are compared (``family_links``).
    4. All other candidates between groups that are still different are verified: those that share SHARED of
       their first shingles, or as many as they must have in common at all."""
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("node"), F.col(text_col).alias("text"))
    prints = Staged(docs.select("doc_id", "node"), "text-nodes").read()
    tasks = tasks_for(df)  # but for the shingles, no table is larger than the texts
    made: list[Staged] = []

    def temporary(rows: DataFrame | Staged, name: str = "") -> DataFrame:
        """The rows, written down until the groups are known."""
        made.append(rows if isinstance(rows, Staged) else Staged(at_most(rows, tasks), name))
        return made[-1].read()

    def forget(*names: str) -> None:
        """Delete tables that nothing reads any more."""
        for table in [x for x in made if x.name in names]:
            made.remove(table)
            table.drop()

    marks = temporary(fingerprints(docs, id_col="node", width=width).groupBy(F.col("doc_id").alias("node")).agg(F.first("fp").alias("fp")), "text-fingerprints")
    heads = temporary(marks.groupBy("fp").agg(F.min("node").alias("node")), "fingerprint-heads")
    far = near_links(heads.select("fp"), limit, temporary=temporary).join(heads.select(F.col("fp").alias("a"), F.col("node").alias("x")), "a").join(heads.select(F.col("fp").alias("b"), F.col("node").alias("y")), "b").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    zero = F.lit(0)
    alike = neighbours(marks.select(F.col("fp").alias("token"), "node", zero.alias("size"), zero.alias("pos")), temporary).filter("n_node is not null and n_node <> node").select(F.least("node", "n_node").alias("a"), F.greatest("node", "n_node").alias("b"))
    tried = temporary(far.unionByName(alike).distinct(), "simhash-links")
    forget("signatures", "neighbours", "text-fingerprints", "fingerprint-heads")
    links = temporary(similar_links(tried, docs, width, similarity, tasks))
    groups = temporary(components(links, tasks=tasks), "similar-groups")
    first = Staged(prefixes(docs, width, similarity), "first-shingles")
    rows = neighbours(first.read(), temporary, SLICES if first.read().count() > SLICED else 1)
    first.drop()
    ends = _pairs(rows, similarity)
    for x in "ab":  # links within a group have nothing to add
        ends = ends.join(groups.select(F.col("node").alias(x), F.col("component").alias(f"{x}_group")), x, "left")
    ends = ends.filter("coalesce(a_group, a) <> coalesce(b_group, b)").select("a", "b")
    near = temporary(ends.join(tried, ["a", "b"], "left_anti"), "near-links")
    links = links.unionByName(temporary(similar_links(near, docs, width, similarity, tasks)))
    # A shingle whose texts are all of one group has nothing left to verify.
    groups = temporary(components(links, tasks=tasks), "similar-groups")
    rows = temporary(_mixed(rows, groups), "mixed-shingles")
    forget("neighbours")
    rows = _celled(rows, similarity)
    many = temporary(_many(rows), "many-texts")
    families = temporary(_families(rows, many, tasks), "families")
    links = links.unionByName(family_links(families, docs, width, similarity, temporary, tasks))
    # those of one family have been compared, so no shingle of many texts is left here
    rows = rows.join(many, ["token", "cell"], "left_anti").join(families.select("node", "cell", "family"), ["node", "cell"], "left")
    sides = [rows.select("token", "cell", *[F.col(c).alias(f"{x}_{c}") for c in ("node", "size", "pos", "component", "class", "family")]) for x in "ab"]
    pairs = sides[0].join(sides[1], ["token", "cell"]).filter("a_node < b_node and a_component <> b_component and cell = least(a_class, b_class) and (a_family = b_family) is not true").filter(_may_be_similar("a_", "b_", similarity))
    shared = F.least(F.lit(SHARED), F.ceil(F.lit(similarity) * F.greatest("a_size", "b_size") - 1e-6))
    rest = pairs.groupBy(F.col("a_node").alias("a"), F.col("b_node").alias("b")).agg(F.count("*").alias("n"), F.first(shared).alias("least")).filter("n >= least").select("a", "b")
    for done in (tried, near):
        rest = rest.join(done, ["a", "b"], "left_anti")
    more = temporary(similar_links(temporary(rest, "other-links"), docs, width, similarity, tasks))
    groups = Staged(at_most(components(links.unionByName(more), tasks=tasks), tasks), "similar-groups").read()
    for table in made:
        table.drop()
    return prints, groups


#: Texts of a shingle and cell up to which they are joined in pairs; those of larger ones are compared in blocks.
FEW = 100
#: Shingles of all texts in a block.
BLOCK_SHINGLES = 1 << 20
#: Bytes of hashes that a round of blocks shuffles, or a quarter of the families' hashes, if that is more.
ROUND = 1 << 28


def _celled(rows: DataFrame, similarity: float) -> DataFrame:
    """The rows with ``class``, by size, and each twice with a ``cell``: its class and the one below.

    Two texts with the similarity are of one class or of neighbouring ones, so they meet in the cell of the lower."""
    rows = rows.withColumn("class", F.floor(F.log("size") / F.lit(float(-np.log(similarity) + 1e-6))).cast("int"))
    return rows.withColumn("cell", F.explode(F.array(F.col("class"), F.col("class") - 1)))


def _many(rows: DataFrame) -> DataFrame:
    """(token, cell, least): the shingles that over FEW texts of a cell have, of several groups, with the least node of each."""
    sums = rows.groupBy("token", "cell").agg(F.min("node").alias("least"), F.count("*").alias("n"), F.min("component").alias("x"), F.max("component").alias("y"))
    return sums.filter((F.col("n") > FEW) & (F.col("x") != F.col("y"))).select("token", "cell", "least")


def _families(rows: DataFrame, many: DataFrame, tasks: int | None = None) -> DataFrame:
    """(node, cell, component, family): what shingles of many texts lead to, from one to another within a cell."""
    own = rows.join(many, ["token", "cell"]).withColumn("a", F.xxhash64("least", "cell")).withColumn("b", F.xxhash64("node", "cell"))
    found = components(own.select("a", "b"), tasks=tasks).select(F.col("node").alias("b"), F.col("component").alias("family"))
    return own.select("node", "cell", "component", "b").distinct().join(found, "b").drop("b")


def _parity(sets: list[np.ndarray], bits: int) -> np.ndarray:
    """bits / 64 words for each set (one column), in which each hash turns over one bit.

    Two sets differ in at least as many hashes as their words differ in bits."""
    out = np.empty((bits // 64, len(sets)), np.uint64)
    step = max(1, (1 << 21) // bits)
    for a in range(0, len(sets), step):
        own = sets[a : a + step]
        at = (np.concatenate(own) & np.uint64(bits - 1)).astype(np.int64) + np.repeat(np.arange(len(own)) * bits, [len(x) for x in own])
        odd = (np.bincount(at, minlength=len(own) * bits) & 1).astype(np.uint8)
        out[:, a : a + step] = np.packbits(odd.reshape(len(own), bits), axis=1, bitorder="little").view(np.uint64).T
    return out


def _similar_forest(sets: list[np.ndarray], group: np.ndarray, side: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """Links (places) of sets with the similarity that join different groups, as a spanning forest of these.

    All pairs are looked at (of unlike sides only, if there are two): ruled out by sizes and by the bits of ``_parity``, and verified
    where these do not tell, unless they have come into one group before."""
    by = np.argsort([len(x) for x in sets], kind="stable")
    sets, side = [sets[k] for k in by], side[by]
    size, two = np.array([len(x) for x in sets], np.int64), side.min() != side.max()
    _, group = np.unique(group[by], return_inverse=True)
    parent, links = list(range(int(group.max()) + 1)), []
    limit = (1 - similarity) / (1 + similarity)

    def root(x: int) -> int:
        while (y := parent[x]) != x:
            parent[x] = x = parent[y]
        return x

    lo = 0
    while lo < len(sets):  # sets of up to twice the size at a time
        hi = int(np.searchsorted(size, 2 * size[lo]))
        end = int(np.searchsorted(size, size[hi - 1] / similarity + 1e-6, "right"))
        words = _parity(sets[lo:end], min(1 << 15, max(256, 1 << int(8 * size[lo]).bit_length())))
        rows = max(16, (1 << 20) // (end - lo))
        for a in range(lo, hi, rows):
            b = min(a + rows, hi)
            top = int(np.searchsorted(size, size[b - 1] / similarity + 1e-6, "right"))
            d = np.zeros((b - a, top - a), np.uint16)
            for w in words:
                d += np.bitwise_count(w[a - lo : b - lo, None] ^ w[None, a - lo : top - lo])
            near = (d <= limit * (size[a:b, None] + size[None, a:top]) + 1e-6) & (size[a:b, None] >= similarity * size[None, a:top] - 1e-6) & (group[a:b, None] != group[None, a:top])
            if two:
                near &= side[a:b, None] != side[None, a:top]
            i, j = np.nonzero(near)
            i, j = i[j > i], j[j > i]
            close = np.argsort(d[i, j], kind="stable")
            for x, y in zip((i[close] + a).tolist(), (j[close] + a).tolist(), strict=True):
                g, h = root(group[x]), root(group[y])
                if g == h:
                    continue
                same = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                if same >= similarity * (len(sets[x]) + len(sets[y]) - same):
                    parent[max(g, h)] = min(g, h)
                    links.append((int(by[x]), int(by[y])))
            if len(i):
                group = np.array([root(x) for x in range(len(parent))])[group]
        lo = hi
    return links


def family_links(families: DataFrame, docs: DataFrame, width: int, similarity: float, temporary: Callable[[DataFrame, str], DataFrame], tasks: int | None = None) -> DataFrame:
    """(a, b): links with the similarity within families that hold their different groups together.

    A family is compared in pairs of blocks, each its own task's work: what is shuffled is a text's hashes, once for each
    block, and what comes out is a forest of each pair of blocks, never the pairs of texts. As this grows with the square of a family,
    the pairs of blocks are taken in rounds, and the shuffle files of each go before the next."""
    texts = _texts_of(families, docs, "family-texts", tasks)

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [_set_hashes(x.as_py(), width) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in sets], pa.int64()), pa.array([x.tobytes() for x in sets], pa.binary())], names=["node", "size", "hashes"])

    sets = temporary(texts.read().mapInArrow(hashes, "node long, size long, hashes binary"), "family-sets")
    texts.drop()
    members = families.join(sets, "node")
    members = members.join(members.groupBy("family").agg(F.ceil(F.sum("size") / BLOCK_SHINGLES).cast("int").alias("g")), "family")
    members = members.withColumn("mine", F.pmod(F.xxhash64("node"), F.col("g")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
    cells = members.select("family", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "node", "component", "hashes")

    def run(cell: pa.Table) -> pa.Table:
        node, component, mine = (cell.column(c).to_numpy() for c in ("node", "component", "mine"))
        links = _similar_forest([np.frombuffer(x.as_buffer(), np.uint64) for x in cell.column("hashes")], component, mine, similarity)
        return pa.table([pa.array([int(node[x[k]]) for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

    once, sent = (x.agg(F.sum(8 * F.col("size")).alias("n")).first()["n"] or 0 for x in (sets, members))
    rounds = max(1, -(-sent // max(ROUND, once // 4)))
    found = None
    for k in range(rounds):
        own = cells.filter(F.pmod(F.xxhash64("family", "i", "j"), F.lit(rounds)) == k) if rounds > 1 else cells
        part = temporary(own.groupBy("family", "i", "j").applyInArrow(run, "a long, b long"), "family-links")
        found = part if found is None else found.unionByName(part)
    return found


def _mixed(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows of tokens whose nodes are of several groups, with the ``component`` of each."""
    rows = rows.select("token", "node", "size", "pos").join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = rows.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y").select("token")
    return rows.join(mixed, "token", "left_semi").distinct()


def similar_groups(df: DataFrame, **how) -> DataFrame:
    """One row per input row: doc_id, component_id (the least doc_id of the group; see ``similar_nodes``)."""
    prints, groups = similar_nodes(df, **how)
    per_node = prints.groupBy("node").agg(F.min("doc_id").alias("rep")).join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = per_node.groupBy("component").agg(F.min("rep").alias("component_id"))
    return prints.join(per_node.join(least, "component").select("node", "component_id"), "node").select("doc_id", "component_id")


def one_of_each(df: DataFrame, **how) -> DataFrame:
    """One row of each group of similar texts: that of the least doc_id (null ids last, unlike texts under one id are
    different documents). All columns stay."""
    prints, groups = similar_nodes(df, **how)
    id_col, text_col = how.get("id_col", "doc_id"), how.get("text_col", "text")
    rows = prints.groupBy("doc_id", "node").agg(F.count("*").alias("n")).join(groups, "node", "left")
    by = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")
    kept = rows.groupBy(F.coalesce("component", "node").alias("component")).agg(F.min(by).alias("k"), F.min_by("n", by).alias("n")).select(F.col("k.node").alias("_k_node"), F.col("k.doc_id").alias("_k_id"), (F.col("n") > 1).alias("_k_again"))
    mine = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    found = df.select(mine.alias("_row"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_node"), F.col(id_col).cast("long").alias("_id"))
    found = found.join(kept, (F.col("_node") == F.col("_k_node")) & F.col("_id").eqNullSafe(F.col("_k_id")))
    again = found.filter("_k_again").groupBy("_node", "_id").agg(F.first("_row").alias("_row"))  # the same row several times
    return found.filter("not _k_again").select("_row.*").unionByName(again.select("_row.*"))
