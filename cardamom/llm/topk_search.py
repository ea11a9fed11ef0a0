"""Exact top-k inner products by block-at-a-time pruning.

Vectors lie in blocks of consecutive document ranges. A block has a forward index
(its vectors' components) and, for each term (dimension), its largest and least
component; a query's bound for the block is the sum over terms of what these can
give.

1. Blocks of queries meet the blocks' summaries (their largest and least components alone), group by group. Each
   query names the ``first`` blocks of the best bounds.
2. Queries and the blocks they named are scored, which gives each query a first k-th score.
3. The summaries are looked at once more: only blocks whose bound reaches the k-th score of some query
   of a block of queries are sent to it. There the blocks are visited for each query in falling order of bounds
   until a bound is below the k-th score so far. The k best of each group are merged.

Components are floor(scale * x). Null vectors and those with null, NaN or infinite
components take no part; a vector is compared with those of its own length alone.
The candidates of a query are the rows with another id. Ties go to the smaller id;
null ids take no part. Repeated rows are candidates each; a repeated query row is
answered once for each row. Scores beyond 64 bits are held at the limits. An empty table gives an empty
result. Columns besides id and vector do not matter, whatever their names."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardamom.llm._common import Staged

BLOCK = "block long, dim int, n int, ids binary, vals binary, top binary, low binary"
#: Vectors in a block; blocks in a group, about; queries in a block of queries (2**10 at most), and such blocks in a chunk, about.
BLOCK_ROWS, GROUP_BLOCKS, QUERY_ROWS, CHUNK_BLOCKS = 256, 64, 1024, 8


def _blocks(df: DataFrame, id_col: str, vec_col: str, scale: float, rows: int) -> DataFrame:
    """Blocks of up to ``rows`` vectors of one length."""
    names = ["block", "dim", "n", "ids", "vals", "top", "low"]
    types = [pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 4]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k = TaskContext.get().partitionId() << 32, 0
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def give(dim: int, ids: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
            nonlocal k
            row = (part + k, dim, len(ids), ids.tobytes(), v.tobytes(), v.max(0).tobytes(), v.min(0).tobytes())
            k += 1
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types, strict=True)], names=names)

        for batch in batches:
            ids, vectors = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            lengths = np.diff(vectors.offsets.to_numpy())
            flat = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
            starts = np.concatenate(([0], np.cumsum(lengths)))
            for dim in np.unique(lengths):
                own = np.flatnonzero(lengths == dim)
                v = flat[(starts[own][:, None] + np.arange(dim)).ravel()].reshape(len(own), dim)
                held.setdefault(int(dim), []).append((ids[own], v))
            for dim, parts in held.items():
                i, v = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
                full = len(i) // rows * rows
                for a in range(0, full, rows):
                    yield give(dim, i[a : a + rows], v[a : a + rows])
                held[dim] = [(i[full:], v[full:])]
        for dim, parts in held.items():
            if len(parts[0][0]):
                yield give(dim, *parts[0])

    v = F.col(vec_col)
    fine = v.isNotNull() & F.col(id_col).isNotNull() & ~F.coalesce(F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(True))
    return df.filter(fine).select(F.col(id_col).cast("long"), v.cast("array<double>")).mapInArrow(run, BLOCK)


def _exact(v: np.ndarray) -> np.ndarray:
    """As Python's integers, for products that doubles would round."""
    return np.array([[int(x) for x in row] for row in v], dtype=object).reshape(v.shape)


class Queries:
    """Blocks of queries: numbers, ids and components."""

    def __init__(self, rows: list[dict], dim: int):
        self.v = np.concatenate([_load(x["vals"], x["n"], dim) for x in rows])
        self.id = np.concatenate([np.frombuffer(x["ids"], np.int64) for x in rows])
        self.no = np.concatenate([(x["block"] << 10) + np.arange(x["n"]) for x in rows])
        self.kth = np.full(len(self.no), -np.inf)  # the k-th score so far
        for start, x in zip(np.cumsum([0] + [x["n"] for x in rows]), rows, strict=False):
            for r in x.get("floors") or ():
                if r["kth"] is not None:
                    self.kth[start + r["r"]] = r["kth"]

    def take(self, rows: np.ndarray) -> None:
        self.v, self.id, self.no, self.kth = self.v[rows], self.id[rows], self.no[rows], self.kth[rows]


def _load(b: bytes, *shape: int) -> np.ndarray:
    return np.frombuffer(b, np.float64).reshape(*shape)


def _exactly(*arrays: np.ndarray) -> list[np.ndarray]:
    """The arrays, as integers of any length where products might be rounded."""
    most = [float(np.abs(a).max(initial=0)) for a in arrays]
    wide = most[0] * max(most[1:]) * max(arrays[0].shape[1], 1) >= 2.0**53
    return [_exact(a) for a in arrays] if wide else list(arrays)


def _bounds(q: np.ndarray, blocks: list[dict], dim: int) -> np.ndarray:
    """The most that each query can score in each block."""
    top, low = (np.stack([_load(x[c], dim) for x in blocks]) for c in ("top", "low"))
    q, top, low = _exactly(q, top, low)
    return np.maximum(q, 0) @ top.T + np.minimum(q, 0) @ low.T


def _search(queries: Queries, blocks: list[dict], dim: int, k: int, kth: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, score, id) of the k best of these blocks for each query that are no worse than its ``kth`` so far."""
    bound = _bounds(queries.v, blocks, dim)
    v_id = [np.frombuffer(x["ids"], np.int64) for x in blocks]
    kth = kth.astype(bound.dtype)
    order = np.argsort(-bound, axis=1, kind="stable")
    best = (np.zeros(0, np.int64), np.zeros(0, bound.dtype), np.zeros(0, np.int64))
    live = np.arange(len(queries.id))
    for r in range(len(blocks)):
        at = order[live, r]
        live = live[bound[live, at] >= kth[live]]
        if not len(live):
            break
        new = []
        at = order[live, r]
        for b in np.unique(at):
            own = live[at == b]
            q, v = _exactly(queries.v[own], _load(blocks[b]["vals"], blocks[b]["n"], dim))
            s = (q @ v.T).astype(bound.dtype)
            s = np.where(v_id[b][None, :] == queries.id[own][:, None], -np.inf, s)
            least = kth[own]
            if s.shape[1] > k:
                least = np.maximum(least, -np.partition(-s, k - 1, axis=1)[:, k - 1])
            i, j = np.nonzero((s >= least[:, None]) & (s > -np.inf))
            new.append((own[i], s[i, j], v_id[b][j]))
        a, s, x = (np.concatenate(c) for c in zip(best, *new, strict=True))
        by = np.lexsort((x, -s, a))
        a, s, x = a[by], s[by], x[by]
        start = np.concatenate(([True], a[1:] != a[:-1])) if len(a) else np.zeros(0, bool)
        rank = np.arange(len(a)) - np.maximum.accumulate(np.where(start, np.arange(len(a)), 0)) if len(a) else np.zeros(0, np.int64)
        keep = rank < k
        best = (a[keep], s[keep], x[keep])
        at_k = rank[keep] == k - 1
        kth[best[0][at_k]] = np.maximum(kth[best[0][at_k]], best[1][at_k])
    return best


def _floors(scores: np.ndarray) -> np.ndarray:
    """Doubles that are no greater than the scores."""
    if scores.dtype != object:
        return scores
    held = np.array([-np.inf if x < -(10**300) else float(min(x, 10**300)) for x in scores])
    return np.where(np.abs(held) < 2.0**53, held, np.nextafter(held, -np.inf))


def _held(scores: np.ndarray) -> list[int]:
    """Scores as 64-bit integers, held at the limits."""
    return [max(-(2**63), min(2**63 - 1, int(y))) for y in scores]


def _given(names: str, cols: list) -> pa.Table:
    types = {"long": pa.int64(), "double": pa.float64()}
    return pa.table([pa.array(c, types[x.split()[1]]) for c, x in zip(cols, names.split(", "), strict=True)], names=[x.split()[0] for x in names.split(", ")])


def topk_search(df: DataFrame, is_query: Column, *, k: int = 10, scale: float = 1024.0, first: int = 2, group_blocks: int = GROUP_BLOCKS, block_rows: int = BLOCK_ROWS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """For each row where ``is_query``: query_id, rank (from 1), vec_id, score of its k best rows of another id."""
    # Written down, so that all that follows sees the same blocks.
    blocks = Staged(_blocks(df, id_col, vec_col, scale, block_rows), "search-blocks").read()
    asked = Staged(_blocks(df.filter(is_query), id_col, vec_col, scale, QUERY_ROWS), "search-queries").read()
    groups, chunks = (max(1, -(-t.select("block").count() // n)) for t, n in ((blocks, group_blocks), (asked, CHUNK_BLOCKS)))
    number = lambda n: F.pmod(F.xxhash64("block"), F.lit(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    blocks, asked = blocks.withColumn("grp", number(groups)), asked.withColumn("chunk", number(chunks))
    # A stated set of queries meets the summaries of all blocks: each chunk of queries each group.
    brief = blocks.select("grp", "block", "dim", "top", "low", all_of(chunks).alias("chunk"))
    keys = ["grp", "chunk", "dim"]

    def name(b: pa.Table, q: pa.Table) -> pa.Table:
        out = [[], [], []]
        if b.num_rows and q.num_rows:
            rows, dim = b.sort_by("block").to_pylist(), b.column("dim")[0].as_py()
            queries = Queries(q.to_pylist(), dim)
            bound = _bounds(queries.v, rows, dim)
            bound = _floors(bound.ravel()).reshape(bound.shape)
            best = np.argsort(-bound, axis=1, kind="stable")[:, :first]
            at = np.arange(len(bound))[:, None]
            out = [np.repeat(queries.no, best.shape[1]), np.array([x["block"] for x in rows])[best].ravel(), bound[at, best].ravel()]
        return _given("query_no long, block long, bound double", out)

    met = asked.select("chunk", "block", "dim", "n", "ids", "vals", all_of(groups).alias("grp"))
    named = brief.groupBy(*keys).cogroup(met.groupBy(*keys)).applyInArrow(name, "query_no long, block long, bound double")
    best = F.row_number().over(Window.partitionBy("query_no").orderBy(F.desc("bound"), "block"))
    named = named.withColumn("at", best).filter(F.col("at") <= first)
    named = named.groupBy("block", F.shiftright("query_no", 10).alias("q_block")).agg(F.collect_list(F.expr("cast(query_no & 1023 as int)")).alias("rows"))  # 1,024 at most
    named = Staged(named.select(F.col("block").alias("to_block"), "q_block", "rows"), "search-named").read()

    def begin(b: pa.Table, q: pa.Table) -> pa.Table:
        out = [[], []]
        if b.num_rows and q.num_rows:
            row, rows = b.to_pylist()[0], q.to_pylist()
            queries = Queries(rows, row["dim"])
            starts = np.cumsum([0] + [x["n"] for x in rows])
            queries.take(np.concatenate([s + np.sort(np.array(x["rows"], np.int64)) for s, x in zip(starts, rows, strict=False)]))
            a, s, _ = _search(queries, [row], row["dim"], k, np.full(len(queries.no), -np.inf))
            out = [queries.no[a], _floors(s)]
        return _given("query_no long, score double", out)

    some = asked.join(named, F.col("block") == F.col("q_block")).select(F.col("to_block").alias("to"), F.col("chunk").alias("of"), "block", "n", "ids", "vals", "rows")
    wanted = named.select("to_block", F.pmod(F.xxhash64("q_block"), F.lit(chunks)).cast("int").alias("chunk")).distinct()
    sent = blocks.join(wanted, F.col("block") == F.col("to_block")).select("to_block", "chunk", "dim", "n", "ids", "vals", "top", "low")
    scores = sent.groupBy("to_block", "chunk").cogroup(some.groupBy("to", "of")).applyInArrow(begin, "query_no long, score double")
    kth = F.get(F.sort_array(F.collect_list("score"), asc=False), F.lit(k - 1))  # first * k at most
    floors = scores.groupBy("query_no").agg(kth.alias("kth")).groupBy(F.shiftright("query_no", 10).alias("q_block")).agg(F.collect_list(F.struct(F.expr("cast(query_no & 1023 as int)").alias("r"), "kth")).alias("floors"))
    asked = Staged(asked.join(floors, F.col("block") == F.col("q_block"), "left").select("chunk", "block", "dim", "n", "ids", "vals", "floors"), "search-floors").read()
    met = asked.select("*", all_of(groups).alias("grp"))

    def reach(b: pa.Table, q: pa.Table) -> pa.Table:
        out = [[], []]
        if b.num_rows and q.num_rows:
            rows, dim = b.sort_by("block").to_pylist(), b.column("dim")[0].as_py()
            queries = Queries(q.to_pylist(), dim)
            bound = _bounds(queries.v, rows, dim)
            own = [x["block"] for x, hit in zip(rows, (bound >= queries.kth[:, None]).any(0), strict=True) if hit]
            out = [own, [q.column("chunk")[0].as_py()] * len(own)]
        return _given("block long, chunk long", out)

    pairs = Staged(brief.groupBy(*keys).cogroup(met.groupBy(*keys)).applyInArrow(reach, "block long, chunk long"), "search-pairs").read()
    left = blocks.join(pairs.select("block", F.col("chunk").cast("int").alias("chunk")), "block")
    right = met.join(left.select(*keys).distinct(), keys, "left_semi")

    def run(b: pa.Table, q: pa.Table) -> pa.Table:
        out = [[], [], [], []]
        if b.num_rows and q.num_rows:
            dim = b.column("dim")[0].as_py()
            queries = Queries(q.to_pylist(), dim)
            a, s, x = _search(queries, b.sort_by("block").to_pylist(), dim, k, queries.kth)
            out = [queries.no[a], queries.id[a], x, _held(s)]
        return _given("query_no long, query_id long, vec_id long, score long", out)

    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, "query_no long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_no").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
