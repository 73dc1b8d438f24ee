"""Exact k-nearest-neighbour join (Euclidean), classifier and regressor.

Spark ML has no kNN. Pairs are pruned by a vector-approximation file, which
keeps pruning where cells or pivots do not (64 dimensions and more):

0. references that fill several blocks of a space with few wide dimensions (most cells of a k-d tree over a sample
   are out of reach) need no approximation: a query meets the whole vectors of its own cell in one task, which gives its
   ``k`` nearest there by exact distances, and then only the cells that come within the ``k``-th of them, by the box
   that a cell's references fill (``_searched``). Ids are compared in the tasks. Everything else goes by codes:
1. equal vectors are collapsed (a query vector is searched once, and of equal
   reference vectors only the ``k`` smallest ids can matter);
2. every reference becomes two bytes per dimension (a uniform grid over the range of
   a bounded sample; values beyond it are clipped), every query single-precision
   numbers, each with the exact norm of what that loses, so the distance of two
   approximations, plus or minus both norms, bounds the true distance on both sides;
3. references that fill several blocks are cut into axis-parallel cells (a k-d tree
   over the sample). A query first meets its own cell, and then only cells that come within the
   ``k``-th upper bound found there: in data with a few wide dimensions most cells are
   passed over, in data without any every cell is met;
4. each (query block, reference block) pair of a cell is one cogroup task over codes
   only: a matrix product gives the bounds, and a reference stays if its lower bound
   reaches the ``k``-th smallest upper bound of the query in the block. The block is cut into
   leaves in the same way, and only leaves within the bound of the query's own leaf are multiplied,
   unless that would be most of them; each leaf met tightens the bound, and pairs beyond it are let go;
5. survivors meet per query, are pruned again by the ``k``-th upper bound over all blocks,
   and only then are exact distances computed, for these few pairs.

Blocks are sized by ``block_rows`` (up to 8 times that for many references), which bounds the memory of a task:
two blocks of codes and one strip of distances. Distances are rounded to 9 decimals, ties broken by the
reference id. Query ids should identify rows; rows that share an id share
one answer per distinct vector.
"""

from __future__ import annotations

import copy
import heapq
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, settle, ship_package
from .quantiles import same_keys

DIST_DIGITS = 9
LEVELS = 65535  # steps of the grid in each dimension (two bytes)
SAMPLE = 8192   # vectors (about) whose range the grid covers; up to 8 times that for many cells
MAX_CELLS = 4096
PER_CELL = 16   # vectors of the sample in a cell
BLOCKS = 24     # blocks of references from which on they grow
LEAF = 64       # references in a leaf of a block
WIDE = 8        # dimensions of the largest variance, among which cells are cut
FEW = 0.25      # share of the cells (by the sample) up to which queries go from cell to cell
STRIP = 256     # queries whose distances to a block are held at once
SLACK = 4e-9    # rounding of the reported distances


def _distances(Q: np.ndarray, P: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distances by matrix product, and a bound of their rounding error per row."""
    qn, pn = np.einsum("ij,ij->i", Q, Q), np.einsum("ij,ij->i", P, P)
    d2 = qn[:, None] + pn[None, :] - 2.0 * (Q @ P.T)
    err = np.sqrt(4e-15 * Q.shape[1] * (qn + pn.max())) + 2e-9
    return np.sqrt(np.maximum(d2, 0)), err


def _plain(features: str) -> F.Column:
    """The vector as the bytes of its doubles, which are written, hashed and compared faster than an array;
    without negative zero, so that equal vectors hash alike."""
    @F.arrow_udf("binary")
    def plain(x: pa.Array) -> pa.Array:
        if not len(x):
            return pa.array([], pa.binary())
        if len(set(np.diff(x.offsets.to_numpy()))) > 1:
            raise ValueError("vectors of one length are needed")
        m = x.flatten().to_numpy(zero_copy_only=False).astype("<f8") + 0.0
        ends = np.arange(len(x) + 1, dtype=np.int32) * np.int32(m.nbytes // len(x))
        return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(ends), pa.py_buffer(m)])

    return plain(features).alias("_f")


def _exact(a: str, b: str) -> F.Column:
    """Rounded distance of two array columns: the squares are added in the order of the dimensions."""
    @F.arrow_udf("double")
    def square(x: pa.Array, y: pa.Array) -> pa.Array:
        if not len(x):
            return pa.array([], pa.float64())
        return pa.array(_squares(_matrix(x), _matrix(y)))

    scale = float(10 ** DIST_DIGITS)
    return F.floor(F.sqrt(square(a, b)) * scale + 0.5) / scale


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of rows, added in the order of the dimensions."""
    d = x - y
    d *= d
    return np.cumsum(d, axis=1)[:, -1] if d.shape[1] else np.zeros(len(d))


def _matrix(x: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length (bytes of doubles, see ``_plain``, or arrays) as rows."""
    x = x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x
    if not len(x):
        return np.zeros((0, 0))
    if not pa.types.is_binary(x.type):
        return x.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(x), -1)
    ends = np.frombuffer(x.buffers()[1], np.int32)[x.offset:x.offset + len(x) + 1]
    return np.frombuffer(x.buffers()[2], np.uint8)[ends[0]:ends[-1]].view("<f8").reshape(len(x), -1)


def _stacked(f: pd.Series) -> np.ndarray:
    if not isinstance(f.iloc[0], bytes):
        return np.stack(f.to_numpy()).astype(np.float64)
    return np.frombuffer(b"".join(f), "<f8").reshape(len(f), -1)


def _sample(r: DataFrame, n: int, block_rows: int) -> np.ndarray:
    """About ``SAMPLE`` of ``n`` reference vectors, by hash (all of a smaller table); more if they fill many blocks."""
    want = SAMPLE * max(1, min(8, n // block_rows * PER_CELL // 8192))
    few = r.select("_f", F.xxhash64("_f").alias("_h"))
    if n > want:
        few = few.where(F.col("_h") < -(1 << 63) + int(want / n * (1 << 64)))
    rows = few.select("_f").limit(2 * want).toArrow()
    rows = rows if rows.num_rows else r.select("_f").limit(1).toArrow()
    return _matrix(rows["_f"])


def _grid(sample: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lowest value, step) per dimension."""
    lo, hi = sample.min(0), sample.max(0)
    return lo, np.maximum(hi - lo, 1e-300) / LEVELS


class _Cells:
    """Axis-parallel cells of about equal numbers of sample vectors: the largest cell is halved at the
    median of its widest dimension until there are ``n`` of them."""

    def __init__(self, sample: np.ndarray, n: int):
        d = sample.shape[1]
        self.nodes: list[list] = []  # dimension, threshold, below, above (inner node, or -1 - cell)
        wide = np.sort(np.argsort(-sample.var(0), kind="stable")[:WIDE])  # looked at first
        cells = [(-len(sample), 0, np.arange(len(sample)), np.full(d, -np.inf), np.full(d, np.inf), None)]
        whole, born = [], 0  # cells of equal vectors
        while cells and len(cells) + len(whole) < n:
            _, _, rows, lo, hi, link = heapq.heappop(cells)  # the largest
            x = sample[np.ix_(rows, wide)]
            axis = int(wide[x.var(0).argmax()])
            x = sample[rows, axis]
            if len(values := np.unique(x)) < 2:
                axis = int(sample[rows].var(0).argmax())
                x = sample[rows, axis]
                values = np.unique(x)
            if len(values) < 2:
                whole.append((rows, lo, hi, link))
                continue
            at = min(float(np.median(x)), float(values[-2]))
            at = float(values[np.searchsorted(values, at, side="right") - 1])
            me = len(self.nodes)
            self.nodes.append([axis, at, None, None])
            if link:
                self.nodes[link[0]][link[1]] = me
            below, above = hi.copy(), lo.copy()
            below[axis] = above[axis] = at
            for part, low, high, side in ((rows[x <= at], lo, below, 2), (rows[x > at], above, hi, 3)):
                born += 1
                heapq.heappush(cells, (-len(part), born, part, low, high, (me, side)))
        cells = [c[2:] for c in sorted(cells, key=lambda c: c[1])]
        cells += whole
        for c, (_, _, _, link) in enumerate(cells):
            if link:
                self.nodes[link[0]][link[1]] = -1 - c
        self.axes = sorted({node[0] for node in self.nodes})
        self.lo = np.array([c[1][self.axes] for c in cells])
        self.hi = np.array([c[2][self.axes] for c in cells])

    def box(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(lowest, highest) values of vectors in the dimensions that are cut."""
        return x[:, self.axes].min(0), x[:, self.axes].max(0)

    def tighten(self, cell: int, lo: np.ndarray, hi: np.ndarray) -> None:
        """The cell holds nothing outside of this ``box``."""
        self.lo[cell], self.hi[cell] = np.maximum(self.lo[cell], lo), np.minimum(self.hi[cell], hi)

    def home(self, x: np.ndarray) -> np.ndarray:
        """The cell of every vector."""
        at = np.zeros(len(x), np.int64) if self.nodes else np.full(len(x), -1)
        while (inner := at >= 0).any():
            for node in np.unique(at[inner]):
                axis, cut, below, above = self.nodes[node]
                mine = np.flatnonzero(at == node)
                at[mine] = np.where(x[mine, axis] <= cut, below, above)
        return -1 - at

    def near(self, x: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Which cells come within ``bound`` of every vector (rows x cells)."""
        gap = np.zeros((len(x), len(self.lo)))
        for j, axis in enumerate(self.axes):
            v = x[:, axis, None]
            g = np.maximum(np.maximum(self.lo[None, :, j] - v, v - self.hi[None, :, j]), 0)
            gap += g * g
        return np.sqrt(gap) * (1 - 1e-12) <= bound[:, None] + SLACK

    def reach(self, x: np.ndarray, bound: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(cell, vectors) of what ``near`` marks, down the tree: far subtrees are passed over whole."""
        far = bound + SLACK
        todo = [(0 if self.nodes else -1, np.arange(len(x)))]
        while todo:
            at, rows = todo.pop()
            if at >= 0:
                axis, cut, below, above = self.nodes[at]
                gap = (x[rows, axis] - cut) * (1 - 1e-12)
                todo += [(to, some) for to, some in ((below, rows[gap <= far[rows]]), (above, rows[-gap <= far[rows]])) if len(some)]
                continue
            v = x[np.ix_(rows, self.axes)]
            gap = np.maximum(np.maximum(self.lo[-1 - at] - v, v - self.hi[-1 - at]), 0)
            rows = rows[np.sqrt((gap * gap).sum(1)) * (1 - 1e-12) <= far[rows]]
            if len(rows):
                yield -1 - at, rows


def _coded(df: DataFrame, grid: tuple[np.ndarray, np.ndarray] | None, cells: _Cells | None) -> DataFrame:
    """Add ``code`` (two bytes per dimension on ``grid``; without one, single-precision numbers), ``e``, the
    norm of what the code loses, and ``_leaf``, the vector's cell."""
    @F.pandas_udf("code binary, e double, leaf long")
    def code(f: pd.Series) -> pd.DataFrame:
        if not len(f):
            return pd.DataFrame({"code": [], "e": [], "leaf": []})
        x = _stacked(f)
        c = x.astype("<f4") if grid is None else np.clip(np.rint((x - grid[0]) / grid[1]), 0, LEVELS).astype("<u2")
        back = c if grid is None else grid[0] + c * grid[1]
        e = np.sqrt(((x - back) ** 2).sum(1)) * (1 + 1e-12) + 1e-12
        return pd.DataFrame({"code": [row.tobytes() for row in c], "e": e,
                             "leaf": cells.home(x) if cells else np.zeros(len(x), np.int64)})

    return df.withColumn("_c", code("_f")).select(
        *df.columns, F.col("_c.code").alias("code"), F.col("_c.e").alias("e"), F.col("_c.leaf").alias("_leaf"))


def _visits(q: DataFrame, cells: _Cells, bound: F.Column, home: bool) -> DataFrame:
    """A row per query and cell within its ``bound`` (``home``: its own cell as well)."""
    @F.pandas_udf("array<long>")
    def within(f: pd.Series, b: pd.Series) -> pd.Series:
        if not len(f):
            return pd.Series([], dtype=object)
        met = list(cells.reach(_stacked(f), b.to_numpy(float)))
        rows = np.concatenate([np.zeros(0, np.int64), *(some for _, some in met)])
        there = np.repeat([c for c, _ in met], [len(some) for _, some in met]).astype(np.int64)
        order = np.lexsort((there, rows))
        return pd.Series(np.split(there[order], np.searchsorted(rows[order], np.arange(1, len(f)))))

    there = F.explode(within("_f", bound)).alias("_there")
    out = q.select(*q.columns, there)
    if not home:
        out = out.where("_there <> _leaf")
    return out.drop("_leaf").withColumnRenamed("_there", "_leaf")


def _decoded(q: pd.DataFrame, r: pd.DataFrame, lo, step) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Approximations of queries and references, and the norms of what they lose."""
    Q = np.frombuffer(b"".join(q["code"]), "<f4").reshape(-1, len(lo)).astype(np.float64)
    R = lo + np.frombuffer(b"".join(r["code"]), "<u2").reshape(-1, len(lo)) * step
    return Q, R, q["e"].to_numpy(), r["e"].to_numpy()


def _bounds(Q, R, eq, er) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all distances."""
    d, err = _distances(Q, R)
    loose = eq[:, None] + er[None, :] + err[:, None]
    return d - loose, d + loose


def _strip(R: np.ndarray) -> int:
    return max(16, min(STRIP, STRIP * 4096 // len(R)))


def _strips(Q, R, eq, er):
    """(first query, lower bounds, upper bounds) of strips of queries against a whole block."""
    strip = _strip(R)
    for s in range(0, len(Q), strip):
        yield s, *_bounds(Q[s:s + strip], R, eq[s:s + strip], er)


def _kth(up: np.ndarray, k: int) -> np.ndarray:
    """The ``k``-th smallest number of every row (infinite if there are fewer)."""
    return np.partition(up, k - 1, axis=1)[:, k - 1] if up.shape[1] >= k else np.full(len(up), np.inf)


def _near_pairs(Q, R, eq, er, k: int, far: np.ndarray):
    """(query, reference, lower, upper bound) of a block: the references whose lower bound reaches the ``k``-th
    upper bound of the query in it, or its bound ``far``."""
    leaves = _Cells(R, len(R) // LEAF) if len(R) >= 4 * LEAF else None
    if leaves is not None and len(leaves.lo) > 1:
        place = leaves.home(R)
        order = np.argsort(place, kind="stable")
        members = np.split(order, np.searchsorted(place[order], np.arange(1, len(leaves.lo))))
        for c, rows in enumerate(members):
            if len(rows):
                leaves.tighten(c, *leaves.box(R[rows]))
        mine, kth = leaves.home(Q), far.copy()
        best, found = np.full((len(Q), k), np.inf), []  # the k smallest upper bounds so far

        def meet(rows: np.ndarray, c: int) -> None:
            """Compare queries with a leaf; only what can still be among the k nearest is kept."""
            for s in range(0, len(rows), 16 * STRIP):
                part = rows[s:s + 16 * STRIP]
                low, up = _bounds(Q[part], R[members[c]], eq[part], er[members[c]])
                best[part] = np.partition(np.hstack([best[part], up]), k - 1, axis=1)[:, :k]
                kth[part] = np.minimum(kth[part], best[part].max(1))
                qi, ri = np.nonzero(low <= kth[part, None] + SLACK)
                found.append((part[qi], members[c][ri], low[qi, ri], up[qi, ri]))

        at = np.argsort(mine, kind="stable")
        for c, rows in enumerate(np.split(at, np.searchsorted(mine[at], np.arange(1, len(members))))):
            if len(rows):
                meet(rows, c)
        within = kth + eq + er.max()  # of approximations: those of distances farther apart need no look
        some = np.arange(0, len(Q), max(1, len(Q) // 64))
        met = sum(len(rows) * len(members[c]) for c, rows in leaves.reach(Q[some], within[some]))
        if met <= 0.35 * len(some) * len(R):
            for c, rows in leaves.reach(Q, within):
                meet(rows[mine[rows] != c], c)
            return _within_kth(found, k, kth)
    return _within_kth(_all_near(Q, R, eq, er, k, far), k, far.copy())


def _all_near(Q, R, eq, er, k: int, far: np.ndarray):
    """``_near_pairs`` of a block without leaves: the matrix of squared distances is compared with a limit per query,
    and bounds are made for what remains."""
    qn, pn, R2 = np.einsum("ij,ij->i", Q, Q), np.einsum("ij,ij->i", R, R), -2.0 * R.T
    most = eq + er.max() + np.sqrt(4e-15 * Q.shape[1] * (qn + pn.max())) + 2e-9  # what a distance can be wrong by
    strip, found = _strip(R), []
    for s in range(0, len(Q), strip):
        at = slice(s, s + strip)
        d2 = Q[at] @ R2
        d2 += pn
        d2 += qn[at, None]
        kth = np.minimum(np.sqrt(np.maximum(_kth(d2, k), 0)) + most[at], far[at])
        qi, ri = np.nonzero(d2 <= ((kth + most[at] + SLACK) ** 2 * (1 + 1e-12))[:, None])
        d = np.sqrt(np.maximum(d2[qi, ri], 0))
        loose = (most[at] - er.max())[qi] + er[ri]
        keep = d - loose <= kth[qi] + SLACK
        qi, ri, d, loose = qi[keep], ri[keep], d[keep], loose[keep]
        found.append((qi + s, ri, d - loose, d + loose))
    return found


def _within_kth(found: list[tuple], k: int, kth: np.ndarray):
    """The pairs within ``kth`` and the ``k``-th upper bound of their query."""
    if not found:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, float, float))
    qi, ri, low, up = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((up, qi))
    qi, ri, low, up = qi[order], ri[order], low[order], up[order]
    last = np.searchsorted(qi, np.arange(len(kth))) + k - 1  # the k-th of every query, if it has so many
    has = last < np.searchsorted(qi, np.arange(len(kth)), side="right")
    kth[has] = np.minimum(kth[has], up[last[has]])
    keep = low <= kth[qi] + SLACK
    return qi[keep], ri[keep], low[keep], up[keep]


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _dealt(q: DataFrame, r: DataFrame, keys: list[str], block_rows: int, q_cols: Sequence[str] = (), r_cols: Sequence[str] = ()):
    """Codes of queries and references of equal ``keys``, dealt to the pairs of blocks to be compared."""
    per = [F.count(F.lit(1)).alias("_n")]
    blocks = same_keys(q.groupBy(*keys).agg(*per).withColumnRenamed("_n", "_nq"), r.groupBy(*keys).agg(*per), keys)
    blocks = materialize(blocks.select(*keys, F.ceil(F.col("_nq") / block_rows).alias("_nqb"),
                                       F.ceil(F.col("_n") / block_rows).alias("_nrb")), "knn-blocks")

    def deal(df, own, other, own_n, other_n, cols):
        df = same_keys(df, blocks, keys).withColumn(own, F.pmod(F.xxhash64("_k"), F.col(own_n))) \
            .withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(other_n) - 1)))
        return df.select(*keys, "_qb", "_rb", "_k", "code", "e", *cols)

    # a number of partitions is given, because few bytes of codes are much work: sized by bytes they would be few
    by, n = [*keys, "_qb", "_rb"], _partitions(q)
    return (deal(q, "_qb", "_rb", "_nqb", "_nrb", q_cols).repartition(n, *by).groupBy(*by)
            .cogroup(deal(r, "_rb", "_qb", "_nrb", "_nqb", r_cols).repartition(n, *by).groupBy(*by)))


def _prepared(q: DataFrame, r: DataFrame, part: list[str], block_rows: int, name: str):
    """(coded queries, coded references, grid, cells or None, rows of a block): references that fill several blocks
    are cut into cells, so that whole blocks can be passed over."""
    n = r.count()
    if not n:
        return None
    # every query is sent to the blocks it may have neighbours in: with more rows, larger blocks, not only more of them
    block_rows = min(8 * block_rows, max(block_rows, n // BLOCKS))
    sample = _sample(r, n, block_rows)
    groups = max(1, r.select(*part).distinct().count()) if part and n >= 2 * block_rows else 1
    n_cells = min(MAX_CELLS, len(sample) // PER_CELL, n // groups // block_rows)
    grid, cells = _grid(sample), _Cells(sample, n_cells) if n_cells > 1 else None
    keep = [*part, "_k", "_f"]
    q, r = _coded(q.select(*keep), None, cells), _coded(r.select(*[c for c in r.columns if c != "_rid"]), grid, cells)
    if cells:  # read by both passes
        q, r = materialize(q, f"{name}-query-codes"), materialize(r.drop("_f"), f"{name}-codes")
    return q, r, grid, cells, block_rows


def _asked(queries: DataFrame, refs: DataFrame, q_id: str, r_id: str, features: str, ref_cols: list[str],
           part: list[str]) -> tuple[DataFrame, DataFrame]:
    """Queries and references that have a vector, written with it as bytes (``_f``), its hash (``_h``) and a key ``_k``."""
    def written(df: DataFrame, name: str) -> DataFrame:
        return materialize(df.withColumns({"_h": F.xxhash64("_f"), "_k": F.monotonically_increasing_id()}), name)

    if queries is refs:  # written once
        both = written(refs.where(F.col(features).isNotNull()).select(
            *part, F.col(q_id).alias("_qid"), F.col(r_id).alias("_rid"), _plain(features), *ref_cols), "knn-given")
        return both.select(*part, "_qid", "_f", "_h", "_k"), both.drop("_qid")
    asked = queries.where(F.col(features).isNotNull()).select(
        *part, F.col(q_id).alias("_qid"), _plain(features))
    # one type on both sides: a group's rows must hash alike
    r = refs.where(F.col(features).isNotNull()).select(
        *[F.col(p).cast(queries.schema[p].dataType).alias(p) for p in part],
        F.col(r_id).alias("_rid"), _plain(features), *ref_cols)
    return written(asked, "knn-asked"), written(r, "knn-given")


def _smallest(r: DataFrame, k: int, part: list[str]) -> DataFrame:
    """Of equal reference vectors the ``k`` smallest ids."""
    same = Window.partitionBy(*part, "_h", "_f").orderBy("_rid")
    return r.withColumn("_o", F.row_number().over(same)).where(F.col("_o") <= k).drop("_o")


def _sides(asked: DataFrame, r: DataFrame, k: int, part: list[str]) -> tuple[DataFrame, DataFrame]:
    """(distinct queries, references that can matter), written, each row with a key ``_k``."""
    # rows meet by the hash of the vector, which sorts and compares faster, and then by the vector
    q = asked.select(*part, "_h", "_f").distinct()
    q = materialize(q.withColumn("_k", F.monotonically_increasing_id()), "knn-queries")
    return q, materialize(_smallest(r, k, part).drop("_h"), "knn-refs")


def _candidates(q: DataFrame, r: DataFrame, k: int, part: list[str], block_rows: int) -> DataFrame:
    """Pairs (``_qk``, ``_rk``) of keys whose exact distance can matter."""
    schema = "_qk long, _rk long, low double, up double"
    ready = _prepared(q, r, part, block_rows, "knn")
    if ready is None:
        return q.limit(0).select(F.col("_k").alias("_qk"), F.col("_k").alias("_rk"))
    q, r, grid, cells, block_rows = ready
    keys = [*part, "_leaf"]

    def per_block(qb: pd.DataFrame, rb: pd.DataFrame) -> pd.DataFrame:
        if not len(qb) or not len(rb):
            return pd.DataFrame({"_qk": [], "_rk": [], "low": [], "up": []})
        qi, ri, low, up = _near_pairs(*_decoded(qb, rb, *grid), k, qb["bound"].to_numpy(float))
        return pd.DataFrame({"_qk": qb["_k"].to_numpy()[qi], "_rk": rb["_k"].to_numpy()[ri], "low": low, "up": up})

    def pruned(found):  # by the k-th upper bound over all blocks so far
        mine = Window.partitionBy("_qk")
        found = found.withColumn("_o", F.row_number().over(mine.orderBy("up"))) \
            .withColumn("_kth", F.max(F.when(F.col("_o") == k, F.col("up"))).over(mine))
        return found.where(F.col("_kth").isNull() | (F.col("low") <= F.col("_kth") + SLACK)).drop("_o")

    unbounded = F.lit(float("inf"))
    found = pruned(_dealt(q.withColumn("bound", unbounded), r, keys, block_rows, ["bound"]).applyInPandas(per_block, schema))
    if cells:  # what the query's own cell gives bounds the others
        found = materialize(found, "knn-home")
        bounds = found.groupBy(F.col("_qk").alias("_k")).agg(F.max("_kth").alias("bound"))
        known = q.join(bounds, "_k", "left").withColumn("bound", F.coalesce("bound", unbounded))
        away = materialize(_visits(known, cells, F.col("bound"), home=False).drop("_f"), "knn-visits")
        found = pruned(found.drop("_kth").unionByName(
            _dealt(away, r, keys, block_rows, ["bound"]).applyInPandas(per_block, schema)))
    return found.select("_qk", "_rk")


def knn_join(queries: DataFrame, refs: DataFrame, k: int, q_id: str, r_id: str,
             features: str = "features", ref_cols: Sequence[str] = (),
             partition: str | None = None, block_rows: int = 4096) -> DataFrame:
    """``(q_id, r_id, dist, nn_rank, *ref_cols)``: the ``k`` nearest references
    of every query (within the same ``partition`` value when given). Rows with
    a null feature vector take no part."""
    if k < 1:
        raise ValueError("k must be at least 1")
    ship_package(queries.sparkSession)
    ref_cols, part = list(ref_cols), [partition] if partition else []
    asked, r = _asked(queries, refs, q_id, r_id, features, ref_cols, part)
    # ids are compared in the tasks as well: those that they order as Spark does
    plain = r.schema["_rid"].dataType == T.StringType() or isinstance(r.schema["_rid"].dataType, T.IntegralType)
    cells = _near_only(r, k, part, block_rows) if plain else None
    out = _searched(asked, r, k, part, ref_cols, *cells) if cells else _compared(asked, r, k, part, ref_cols, block_rows)
    cols = [*part, "_qid", "_rid", "dist", *ref_cols, "nn_rank"]
    return out.select(*cols).withColumnRenamed("_qid", q_id).withColumnRenamed("_rid", f"nn_{r_id}" if r_id == q_id else r_id)


def _compared(asked: DataFrame, r: DataFrame, k: int, part: list[str], ref_cols: list[str], block_rows: int) -> DataFrame:
    """The ``k`` nearest of every asked row, by codes of all pairs of blocks."""
    q, r = _sides(asked, r, k, part)
    pairs = _candidates(q, r, k, part, block_rows)
    near = pairs.join(q.select(F.col("_k").alias("_qk"), F.col("_f").alias("_qf")), "_qk") \
        .join(r.select(F.col("_k").alias("_rk"), F.col("_f").alias("_rf"), "_rid", *ref_cols), "_rk") \
        .withColumn("dist", _exact("_qf", "_rf")).drop("_qf", "_rf")
    w = Window.partitionBy("_qk").orderBy("dist", "_rid")
    top = near.withColumn("nn_rank", F.row_number().over(w)).where(F.col("nn_rank") <= k)
    # the asked rows of each distinct query: met by the hash of the vector, then compared
    # (coalesce: not as a second key of the join, by which every row would be sorted)
    known = q.select(*part, "_h", F.col("_f").alias("_qf"), F.col("_k").alias("_qk"))
    whose = same_keys(asked.drop("_k"), known, [*part, "_h"]).where("coalesce(_f = _qf, false)").select(*part, "_qid", "_qk")
    return whose.join(top, "_qk")


def _near_only(r: DataFrame, k: int, part: list[str], block_rows: int) -> tuple[_Cells, int] | None:
    """(cells, rows of one) if references fill several blocks and a query meets few of their cells: judged by the
    ``k``-th neighbours of some vectors of the sample within it, which are farther than those among all rows."""
    n = r.count()
    if n < 2 * block_rows:
        return None
    rows = min(4 * block_rows, max(block_rows, n // (2 * BLOCKS)))
    sample = _sample(r, n, rows)
    groups = r.select(*part).distinct().count() if part else 1
    n_cells = min(MAX_CELLS, len(sample) // PER_CELL, n // groups // rows)
    if n_cells < 2:
        return None
    cells = _Cells(sample, n_cells)
    some = sample[::max(1, len(sample) // 256)]
    met = cells.near(some, _kth(_distances(some, sample)[0], k + 1)).mean()
    return (cells, rows) if met <= FEW else None


def _hot(df: DataFrame, n: int, rows: int) -> list[int]:
    """Hashes of the vectors that (by a sample of rows) fill about half of ``rows``: too many to meet in one task."""
    if n <= rows:
        return []
    some = df.select("_h").sample(min(1.0, 16 * max(n // rows, 512) / n), seed=1)
    return [x["_h"] for x in some.groupBy("_h").count().where(F.col("count") > 8).select("_h").collect()]


def _first_of(h: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows that come first with their vector, which of them every row equals), by the hashes ``h`` if they tell all apart."""
    _, first, same = np.unique(h, return_index=True, return_inverse=True)
    if len(first) < len(h) and not np.array_equal(x, x[first[same]]):
        _, first, same = np.unique(x, axis=0, return_index=True, return_inverse=True)
    return first, same.reshape(-1)


def _few_of_each(h: np.ndarray, x: np.ndarray, k: int) -> np.ndarray:
    """The first ``k`` rows of every vector (all rows if two vectors share a hash)."""
    order = np.argsort(h, kind="stable")
    start = np.flatnonzero(np.r_[True, h[order][1:] != h[order][:-1]])
    begin = np.repeat(start, np.diff(np.r_[start, len(h)]))
    place = np.arange(len(h)) - begin
    again = np.flatnonzero(place)
    if not (place >= k).any() or not np.array_equal(x[order[again]], x[order[begin[again]]]):
        return np.arange(len(h))
    return np.sort(order[place < k])


def _nearest(qt: pa.Table, rt: pa.Table, k: int, bound: np.ndarray | None,
             ref_cols: list[str]) -> tuple[np.ndarray, np.ndarray, pa.ListArray, np.ndarray]:
    """(distinct queries of a block, which of them every row is, the ``k`` nearest of every row, the ``k``-th distance of
    the distinct ones): exact distances, those beyond ``bound`` left out."""
    Q = _matrix(qt["_f"])
    first, same = _first_of(qt["_h"].to_numpy(), Q)
    Q, rt = Q[first], rt.combine_chunks()
    rid = rt["_rid"].combine_chunks()
    order = pc.array_sort_indices(rid, null_placement="at_start").to_numpy()
    R = _matrix(rt["_f"])
    order = order[_few_of_each(rt["_h"].to_numpy()[order], R[order], k)]
    R = R[order]  # in the order of the ids
    far = np.full(len(Q), np.inf) if bound is None else bound[first]
    qi, ri = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(Q) and len(R):
        qi, ri, _, _ = _near_pairs(Q, R, np.zeros(len(Q)), np.zeros(len(R)), k, far)
    dist, scale = np.empty(len(qi)), float(10 ** DIST_DIGITS)
    for s in range(0, len(qi), 2048):
        at = slice(s, s + 2048)
        dist[at] = np.floor(np.sqrt(_squares(Q[qi[at]], R[ri[at]])) * scale + 0.5) / scale
    near = dist <= far[qi]
    qi, ri, dist = qi[near], ri[near], dist[near]
    best = np.lexsort((ri, dist, qi))
    qi, ri, dist = qi[best], ri[best], dist[best]
    near = np.arange(len(qi)) - np.searchsorted(qi, qi) < k
    qi, ri, dist = qi[near], ri[near], dist[near]
    ends = np.r_[0, np.cumsum(np.bincount(qi, minlength=len(Q)))]
    kth = np.full(len(Q), np.inf)
    full = np.diff(ends) == k
    kth[full] = dist[ends[1:][full] - 1]
    taken = rt.select(["_rid", *ref_cols]).take(pa.array(order[ri]))
    nn = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
        [pa.array(dist), *(taken[c].combine_chunks() for c in ("_rid", *ref_cols))], names=["dist", "_rid", *ref_cols]))
    return Q, same, nn.take(pa.array(same)), kth


def _searched(asked: DataFrame, r: DataFrame, k: int, part: list[str], ref_cols: list[str], cells: _Cells,
              rows: int) -> DataFrame:
    """The ``k`` nearest of every asked row: it is compared with its own cell, and then with the cells that come within
    what it found there. A cell's references meet a block of its queries in one task, with their whole vectors."""
    n_asked, n_refs = asked.count(), r.count()
    if hot := _hot(r, n_refs, rows):
        many = F.col("_h").isin(hot)
        r = r.where(~many).unionByName(_smallest(r.where(many), k, part))
    r = r.drop("_k")
    q = asked
    if hot := _hot(asked, n_asked, rows):
        many = F.col("_h").isin(hot)
        once = materialize(asked.where(many).select(*part, "_h", "_f").distinct()
                           .withColumn("_k", -1 - F.monotonically_increasing_id()), "knn-queries")
        q = asked.where(~many).unionByName(once.withColumn("_qid", F.lit(None).cast(asked.schema["_qid"].dataType)))
    cores = q.sparkSession.sparkContext.defaultParallelism
    near = T.StructType([T.StructField("dist", T.DoubleType()), *(T.StructField(c, r.schema[c].dataType) for c in ("_rid", *ref_cols))])
    keys = [T.StructField(c, asked.schema[c].dataType) for c in (*part, "_qid", "_k")]
    nearest = T.StructField("nn", T.ArrayType(near))
    found = T.StructType([*keys, T.StructField("_leaf", T.LongType()), T.StructField("bound", T.DoubleType()), nearest,
                          T.StructField("_f", T.BinaryType())])

    def home(qt: pa.Table, rt: pa.Table) -> pa.Table:
        Q, same, nn, kth = _nearest(qt, rt, k, None, ref_cols)
        far = np.zeros(len(Q), bool)
        if len(Q):
            mine = cells.home(Q)
            for cell, at in cells.reach(Q, kth):
                far[at[mine[at] != cell]] = True
        f = qt["_f"].combine_chunks()
        out = pa.table([*(qt[c] for c in (*part, "_qid", "_k", "_leaf")), pa.array(kth[same]), nn,
                        pc.if_else(pa.array(far[same]), f, pa.scalar(None, f.type))], names=found.names)
        if not rt.num_rows:
            return out
        box = {"_leaf": rt["_leaf"][0].as_py(), "_f": np.concatenate(cells.box(_matrix(rt["_f"]))).tobytes()}
        return pa.concat_tables([out, pa.table([pa.array([box.get(c.name)], c.type) for c in out.schema], names=found.names)])

    def away(qt: pa.Table, rt: pa.Table) -> pa.Table:
        _, _, nn, _ = _nearest(qt, rt, k, qt["bound"].to_numpy(), ref_cols)
        return pa.table([qt["_k"], nn], names=["_k", "nn"]).filter(pa.array(nn.value_lengths().to_numpy() > 0))

    def meet(q: DataFrame, blocks: dict, n: int, search, schema: T.StructType) -> DataFrame:
        """``search`` in every cell; its queries are dealt to so many ``blocks``, its references go to all of them."""
        by, of = [*part, "_leaf", "_qb"], np.array([blocks.get(c, 1) for c in range(len(cells.lo))])
        there = _placed(r, cells, of)
        if "bound" in q.columns:  # cells that no query comes to are left out
            there = there.where(F.col("_leaf").isin(list(blocks)))
        there = there.withColumn("_qb", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1))).drop("_n")
        if "_leaf" not in q.columns:
            q = _placed(q, cells, of)
        else:
            q = q.withColumn("_n", F.element_at(F.array(*[F.lit(int(x)) for x in of]), (F.col("_leaf") + 1).cast("int")))
        q = q.withColumn("_qb", F.pmod("_h", F.col("_n"))).drop("_n")
        # a number of partitions is given, because few bytes are much work; groups are not of one size: several a core
        n = max(_partitions(q), min(int(of.sum()), max(16 * cores, n // 100_000)))
        return q.repartition(n, *by).groupBy(*by).cogroup(there.repartition(n, *by).groupBy(*by)).applyInArrow(search, schema)

    some = _matrix(q.select("_f").sample(min(1.0, 16384 / max(n_asked, 1)), seed=1).limit(65536).toArrow()["_f"])
    here = np.bincount(cells.home(some)) * (n_asked / len(some)) if len(some) else []
    first = materialize(meet(q, {c: math.ceil(x / (2 * rows)) for c, x in enumerate(here) if x}, n_asked + n_refs, home, found), "knn-home")
    # the cells as the references fill them: far fewer come within a bound
    boxes: dict[int, list] = {}
    for x in first.where("_k IS NULL").select("_leaf", "_f").collect():
        boxes.setdefault(x["_leaf"], []).append(np.frombuffer(x["_f"]).reshape(2, -1))
    filled = copy.deepcopy(cells)
    for c, some in boxes.items():
        filled.tighten(c, np.min([b[0] for b in some], 0), np.max([b[1] for b in some], 0))
    first = first.where("_k IS NOT NULL")
    going = first.where("_f IS NOT NULL").select(*part, "_k", "_f", "bound", "_leaf")
    going = materialize(_visits(going, filled, F.col("bound"), home=False).withColumn("_h", F.xxhash64("_f")), "knn-visits")
    here = {x["_leaf"]: x["count"] for x in going.groupBy("_leaf").count().collect()}
    out = first.drop("_f", "_leaf", "bound")
    if here:
        more = meet(going, {c: math.ceil(x / (2 * rows)) for c, x in here.items()}, sum(here.values()) + n_refs, away,
                    T.StructType([keys[-1], nearest]))
        more = settle(more.groupBy("_k").agg(F.flatten(F.collect_list("nn")).alias("_more")))  # few: its size is known
        best = F.when(F.col("_more").isNull(), F.col("nn")).otherwise(F.slice(F.sort_array(F.concat("nn", "_more")), 1, k))
        out = out.join(more, "_k", "left").withColumn("nn", best).drop("_more")
    if hot:  # the asked rows of each vector that was searched once
        known = materialize(out.where("_k < 0"), "knn-once").select("_k", "nn").join(
            once.select("_k", *part, "_h", F.col("_f").alias("_qf")), "_k").drop("_k")
        rest = same_keys(asked.where(many).select(*part, "_qid", "_h", "_f"), known, [*part, "_h"]).where("coalesce(_f = _qf, false)")
        out = out.where("_k >= 0").select(*part, "_qid", "nn").unionByName(rest.select(*part, "_qid", "nn"))
    out = out.select(*part, "_qid", F.posexplode("nn").alias("_o", "_n"))
    return out.select(*part, "_qid", "_n.*", (F.col("_o") + 1).alias("nn_rank"))


def _placed(df: DataFrame, cells: _Cells, blocks: np.ndarray) -> DataFrame:
    """Rows with their cell ``_leaf`` and its number of query blocks ``_n``."""
    @F.arrow_udf("long")
    def place(f: pa.Array) -> pa.Array:
        leaf = cells.home(_matrix(f)) if len(f) else np.zeros(0, np.int64)
        return pa.array(leaf << 24 | blocks[leaf])

    return df.withColumn("_at", place("_f")).withColumns(
        {"_leaf": F.shiftright("_at", 24), "_n": F.col("_at").bitwiseAND(F.lit((1 << 24) - 1))}).drop("_at")


def pruning(queries: DataFrame, refs: DataFrame, k: int, q_id: str, r_id: str, features: str = "features",
            partition: str | None = None, block_rows: int = 4096) -> DataFrame:
    """What the approximation saves: one row with the distinct ``n_queries``, the ``n_refs``, all
    ``n_pairs`` of them and ``n_exact``, the pairs whose exact distance ``knn_join`` computes."""
    ship_package(queries.sparkSession)
    part = [partition] if partition else []
    q, r = _sides(*_asked(queries, refs, q_id, r_id, features, [], part), k, part)
    n = [F.count(F.lit(1)).alias("n")]
    pairs = same_keys(q.groupBy(*part).agg(*n), r.groupBy(*part).agg(F.count(F.lit(1)).alias("m")), part) if part else \
        q.agg(*n).withColumn("m", F.lit(r.count()).cast("long"))
    exact = _candidates(q, r, k, part, block_rows).count()
    return pairs.agg(F.sum("n").alias("n_queries"), F.sum("m").alias("n_refs"),
                     F.sum(F.col("n") * F.col("m")).alias("n_pairs"), F.lit(exact).cast("long").alias("n_exact"))


def vote(neighbours: DataFrame, q_id, label: str, k: int,
         positive=None) -> DataFrame:
    """Uniform-weight vote: ``prediction`` = most frequent label (ties -> the
    smallest label); ``probability`` = share of ``positive`` (or of the
    predicted label when no positive class is named)."""
    q_id = [q_id] if isinstance(q_id, str) else list(q_id)
    counts = neighbours.groupBy(*q_id, label).agg(F.count(F.lit(1)).alias("_c"))
    best = counts.groupBy(*q_id).agg(
        F.min_by(label, F.struct(-F.col("_c"), F.col(label))).alias("prediction"),
        F.max("_c").alias("_cmax"),
        F.sum(F.when(F.col(label) == F.lit(positive), F.col("_c")).otherwise(0)).alias("_cpos")
        if positive is not None else F.lit(0).alias("_cpos"),
        F.sum("_c").alias("_n"))
    share = F.col("_cpos") if positive is not None else F.col("_cmax")
    return best.select(*q_id, "prediction", (share / F.col("_n")).alias("probability"))


def knn_classify(queries: DataFrame, refs: DataFrame, k: int, q_id: str, r_id: str,
                 label: str, features: str = "features", positive=None, **kw) -> DataFrame:
    nn = knn_join(queries, refs, k, q_id, r_id, features, [label], **kw)
    part = [kw["partition"]] if kw.get("partition") else []
    return vote(nn, part + [q_id], label, k, positive)


def knn_regress(queries: DataFrame, refs: DataFrame, k: int, q_id: str, r_id: str,
                target: str, features: str = "features", **kw) -> DataFrame:
    """Mean target of the k nearest references: ``(q_id, prediction)``."""
    nn = knn_join(queries, refs, k, q_id, r_id, features, [target], **kw)
    part = [kw["partition"]] if kw.get("partition") else []
    return nn.groupBy(*part, q_id).agg(F.avg(F.col(target).cast("double")).alias("prediction"))


def fold_sets(df: DataFrame, fold_col: str, k_folds: int, role: str) -> DataFrame:
    """Rows tagged with the CV set(s) they belong to as ``_set``: ``test`` role
    -> its own fold; ``train`` role -> every other fold; ``both`` -> all folds."""
    if role == "test":
        return df.withColumn("_set", F.col(fold_col))
    if role == "both":
        return df.withColumn("_set", F.explode(F.sequence(F.lit(0), F.lit(k_folds - 1))))
    others = F.filter(F.sequence(F.lit(0), F.lit(k_folds - 1)), lambda s: s != F.col(fold_col))
    return df.withColumn("_set", F.explode(others))


def fold_neighbours(df: DataFrame, k: int, id_col: str, fold_col: str, k_folds: int, ref_cols: Sequence[str],
                    features: str = "features") -> DataFrame:
    """``knn_join`` of the ``both`` rows of all sets with their ``train`` rows (``fold_sets``, by ``_set``), every pair of rows
    compared once: the ``k`` nearest of each row are found per fold, and a set merges those of its folds."""
    ref_cols = list(ref_cols)
    rows = materialize(df.select(id_col, fold_col, features, *[c for c in ref_cols if c not in (id_col, fold_col)])
                       .withColumn("_row", F.monotonically_increasing_id()), "fold-rows")
    own = F.when(F.col(fold_col).between(0, k_folds - 1), F.col(fold_col)).otherwise(k_folds).cast("int")
    refs = rows.where(F.col(fold_col).isNotNull()).withColumn("_set", own)
    qs = rows.select("_row", features, F.explode(F.sequence(F.lit(0), F.lit(k_folds))).alias("_set"))
    near = knn_join(qs, refs, k, "_row", id_col, features, ref_cols, partition="_set")
    others = F.filter(F.sequence(F.lit(0), F.lit(k_folds - 1)), lambda s: s != F.col("_set"))
    near = near.select("_row", F.explode(others).alias("_set"), F.col(id_col).alias(f"nn_{id_col}"), "dist", *ref_cols)
    w = Window.partitionBy("_set", "_row").orderBy("dist", f"nn_{id_col}")
    near = near.withColumn("nn_rank", F.row_number().over(w)).where(F.col("nn_rank") <= k)
    return near.join(rows.select("_row", id_col), "_row").select("_set", id_col, f"nn_{id_col}", "dist", *ref_cols, "nn_rank")


def radius_aggregate(queries: DataFrame, refs: DataFrame, radius: float, q_id: str, r_id: str,
                     target: str, features: str = "features", block_rows: int = 4096) -> DataFrame:
    """All references within ``radius`` of each query, reduced to ``(q_id, target_value, n,
    total)`` (``total`` sums the numeric target value). Pairs whose upper bound lies inside the
    radius are counted in the block task and never leave it; only those that the bounds leave
    open are compared exactly. Equal (vector, target) references are counted once with their number."""
    ship_package(queries.sparkSession)
    q = queries.where(F.col(features).isNotNull()).select(F.col(q_id).alias("_qid"), _plain(features))
    r = refs.where(F.col(features).isNotNull()).groupBy(_plain(features), F.col(target).alias("_t")).agg(
        F.count(F.lit(1)).alias("_m"))
    q, r = (materialize(df.withColumn("_k", F.monotonically_increasing_id()), name)
            for df, name in ((q, "radius-queries"), (r, "radius-refs")))
    schema = T.StructType([T.StructField("_qk", T.LongType()), T.StructField("_rk", T.LongType()),
                           T.StructField("_t", refs.schema[target].dataType), T.StructField("n", T.LongType())])
    ready = _prepared(q, r, [], block_rows, "radius")
    if ready is None:
        none = q.limit(0).select(F.col("_qid").alias(q_id), F.lit(None).cast(refs.schema[target].dataType).alias(target))
        return none.withColumns({"n": F.lit(0).cast("long"), "total": F.lit(0.0)})

    def per_block(qb: pd.DataFrame, rb: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(qb) and len(rb):
            qk, rk, t, m = (x.to_numpy() for x in (qb["_k"], rb["_k"], rb["_t"], rb["_m"]))
            for s, low, up in _strips(*_decoded(qb, rb, *grid)):
                qi, ri = np.nonzero(up <= radius - SLACK)
                sure = pd.DataFrame({"_qk": qk[qi + s], "_t": t[ri], "n": m[ri]}).groupby(
                    ["_qk", "_t"], sort=False, dropna=False).agg(n=("n", "sum")).reset_index()
                out.append(sure.assign(_rk=None))
                qi, ri = np.nonzero((low <= radius + SLACK) & (up > radius - SLACK))
                out.append(pd.DataFrame({"_qk": qk[qi + s], "_t": t[ri], "n": m[ri], "_rk": rk[ri]}))
        frame = pd.concat(out) if out else pd.DataFrame({c: pd.Series([], dtype=object) for c in schema.names})
        return frame[schema.names].astype({"_rk": "Int64"})

    qc, rc, grid, cells, block_rows = ready
    if cells:
        qc = materialize(_visits(qc, cells, F.lit(float(radius)), home=True).drop("_f"), "radius-visits")
    part = materialize(_dealt(qc, rc, ["_leaf"], block_rows, r_cols=["_t", "_m"]).applyInPandas(per_block, schema), "radius-parts")
    open_ = part.where("_rk IS NOT NULL").join(q.select(F.col("_k").alias("_qk"), F.col("_f").alias("_qf")), "_qk") \
        .join(r.select(F.col("_k").alias("_rk"), F.col("_f").alias("_rf")), "_rk").where(_exact("_qf", "_rf") <= radius)
    hits = part.where("_rk IS NULL").select("_qk", "_t", "n").unionByName(open_.select("_qk", "_t", "n"))
    per = hits.groupBy("_qk", "_t").agg(F.sum("n").alias("n"))
    per = per.join(q.select(F.col("_k").alias("_qk"), "_qid"), "_qk").groupBy("_qid", "_t").agg(F.sum("n").alias("n"))
    return per.withColumn("total", F.col("_t").cast("double") * F.col("n")) \
              .withColumnRenamed("_qid", q_id).withColumnRenamed("_t", target)


def radius_classify(queries, refs, radius, q_id, r_id, label, features="features", **kw) -> DataFrame:
    """Majority label among references within ``radius`` (ties -> smaller
    label); queries with no reference in range get no prediction."""
    agg = radius_aggregate(queries, refs, radius, q_id, r_id, label, features, **kw)
    return agg.groupBy(q_id).agg(F.min_by(label, F.struct(-F.col("n"), F.col(label))).alias("prediction"))


def radius_regress(queries, refs, radius, q_id, r_id, target, features="features", **kw) -> DataFrame:
    """Mean target of the references within ``radius``."""
    agg = radius_aggregate(queries, refs, radius, q_id, r_id, target, features, **kw)
    return agg.groupBy(q_id).agg((F.sum("total") / F.sum("n")).alias("prediction"))
