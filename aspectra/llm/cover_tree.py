"""Exact top-k search by integer inner product with dual cover trees.

Components become floor(``scale`` * x) in double precision; a score is the integer inner
product of two such vectors.  Queries are rows of the table; candidates are all rows but the
query's own.

1. *Cells.*  Rows go to the nearest of at most ``MAX_PIVOTS`` pivots, the greedy cover of a
   bounded sample of ``SAMPLE`` rows; a pivot's cell with more rows than ``CELL_VALUES`` /
   dimensions is split by the hash of the id, so a hot vector or cluster never meets in one
   task.  The pivots only route rows.
2. *Trees.*  Queries and data are indexed together, cell by cell: each cell gets a cover tree
   over its rows (a child covers half its parent's radius; the root's first child is the
   root's own point; points that cover nothing but themselves are bundled into leaves around
   their parent) and one over its queries, which are searched in it at once.  That gives every
   query a first list of k.
3. *Blocks.*  The queries of neighbouring cells form blocks of about ``BLOCK`` queries with a
   tree each.  A block meets only the cells that the bound below does not rule out, the most
   promising first, ``SLICE`` cells to a task.
4. *Dual descent.*  A pair of nodes with centres q, r and covering radii s, t holds no score
   above <q, r> + s |r| + t |q| + s t.  If that is below the worst k-th score among the
   node's queries, the pair is dropped; ties are kept, since a smaller id may win.

Every result is exact; pivots, bounds and order only save work.  Of equal vectors in a cell
the k + 1 smallest ids are kept: no answer holds more (one may be the query itself).

Defined cases: a vector that is null, holds null or non-finite components (before or after
scaling), or has a null id takes no part; shorter vectors count as padded with zeros, an
empty one is all zeros; rows that repeat id and vector count once; rows with a query's id are
never its answers; an id with several vectors is a query per vector and a candidate per
vector; ties go to the smaller id; a query without candidates has no row; an empty table gives
no rows; other columns are ignored, whatever their names.  Scores beyond a long saturate.
"""

from __future__ import annotations

import math
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, ready

SAMPLE = 4096              # rows that the pivots are chosen from
MAX_PIVOTS = 512
CELL_VALUES = 1 << 17      # components of the vectors of a cell (2 048 rows of 64)
LEAF = 128                 # points of a leaf
BLOCK = 1024               # queries of a block
SLICE = 16                 # cells that a task searches for a block

_LOWEST = np.iinfo(np.int64).min
_EXACT = float(1 << 53)


# ---------------------------------------------------------------------------------------
# cover tree
# ---------------------------------------------------------------------------------------
class Tree:
    """Nodes as arrays; the points below a node are neighbours in ``points``."""

    def __init__(self, points: np.ndarray):
        self.order = np.arange(len(points))
        self.nodes: list = []                  # centre, radius, lo, hi, children (numbers)
        if len(points):
            mean = points.mean(axis=0)
            with np.errstate(over="ignore", invalid="ignore"):
                first = int(np.argmin(((points - mean) ** 2).sum(axis=1)))
            self._grow(points, first)
        self.points = points[self.order]
        with np.errstate(over="ignore", invalid="ignore"):
            self.centres = points[[c for c, *_ in self.nodes]]
            self.norms = np.sqrt((self.centres ** 2).sum(axis=1))
        self.radii = np.array([r for _, r, *_ in self.nodes])
        self.lo = [n[2] for n in self.nodes]
        self.hi = [n[3] for n in self.nodes]
        self.children = [np.array(n[4], dtype=np.int64) for n in self.nodes]
        self.largest = float(np.abs(points).max()) if points.size else 0.0
        del self.nodes

    def _far(self, points, rows, centre) -> np.ndarray:
        with np.errstate(over="ignore", invalid="ignore"):
            d = points[rows] - points[centre]
            return np.nan_to_num(np.sqrt(np.einsum("ij,ij->i", d, d)), nan=np.inf, posinf=np.inf)

    def _grow(self, points, first) -> None:
        self.nodes.append((first, float(self._far(points, self.order, first).max()), 0, len(points), []))
        at = 0
        while at < len(self.nodes):
            centre, radius, lo, hi, children = self.nodes[at]
            at += 1
            if hi - lo <= LEAF or radius == 0 or not math.isfinite(radius):
                continue
            rest, nxt, groups, single = self.order[lo:hi].copy(), centre, [], []
            while len(rest):
                far = self._far(points, rest, nxt)
                near = far <= radius / 2
                if near.sum() == 1:
                    single.append(rest[near])
                else:
                    groups.append((nxt, float(far[near].max()), rest[near]))
                rest = rest[~near]
                nxt = rest[0] if len(rest) else None
            single = np.concatenate(single) if single else np.empty(0, dtype=np.int64)
            far = self._far(points, single, centre)
            by = np.argsort(far, kind="stable")
            for i in range(0, len(single), LEAF):
                b = by[i:i + LEAF]
                groups.append((centre, float(far[b].max()), single[b]))
            for c, r, members in groups:
                self.order[lo:lo + len(members)] = members
                children.append(len(self.nodes))
                self.nodes.append((c, r, lo, lo + len(members), []))
                lo += len(members)

    def bounds(self, nodes, other: "Tree", node: int) -> np.ndarray:
        """Upper bounds of the scores between each of ``nodes`` and ``node`` of ``other``."""
        return score_bound(self.centres[nodes], self.norms[nodes], self.radii[nodes],
                           other.centres[node], other.norms[node], other.radii[node])


def score_bound(q, q_norm, s, r, r_norm, t):
    with np.errstate(over="ignore", invalid="ignore"):
        slack = 1e-9 * (q_norm + s) * (r_norm + t)      # far above any rounding error
        return np.nan_to_num(q @ r + s * r_norm + t * q_norm + s * t + slack, nan=np.inf, posinf=np.inf, neginf=np.inf)


def padded(a: np.ndarray, width: int) -> np.ndarray:
    return a if a.shape[1] == width else np.pad(a, ((0, 0), (0, width - a.shape[1])))


def same_width(a: Tree, b: Tree) -> None:
    width = max(a.points.shape[1], b.points.shape[1])
    for t in (a, b):
        t.points, t.centres = padded(t.points, width), padded(t.centres, width)


def scores_of(a: np.ndarray, b: np.ndarray, exact: bool) -> np.ndarray:
    """Integer inner products of all rows of a with all rows of b."""
    if exact:
        return (a @ b.T).astype(np.int64)
    whole = lambda m: np.array([[int(x) for x in r] for r in m], dtype=object).reshape(m.shape)
    s = whole(a) @ whole(b).T
    return np.clip(s, _LOWEST + 1, np.iinfo(np.int64).max).astype(np.int64)


class Best:
    """The k best (score, id) of every query, in the order of the query tree's points."""

    def __init__(self, ids: np.ndarray, k: int, scores=None, found=None, cells=None):
        self.ids, self.k, self.cells = ids, k, cells
        self.scores = np.full((len(ids), k), _LOWEST) if scores is None else scores
        self.found = np.zeros((len(ids), k), dtype=np.int64) if found is None else found
        self.new = np.zeros((len(ids), k), dtype=bool)

    def offer(self, lo: int, hi: int, scores: np.ndarray, ids: np.ndarray, cell: int | None) -> None:
        own = self.ids[lo:hi, None] == ids[None, :]
        if self.cells is not None:
            own |= (self.cells[lo:hi] == cell)[:, None]
        scores[own] = _LOWEST
        better = scores >= np.maximum(self.scores[lo:hi, -1:], _LOWEST + 1)
        rows, cols = np.flatnonzero(better.any(axis=1)), np.flatnonzero(better.any(axis=0))
        if not len(rows):
            return
        s = np.concatenate([self.scores[lo + rows], scores[np.ix_(rows, cols)]], axis=1)
        i = np.concatenate([self.found[lo + rows], np.broadcast_to(ids[cols], (len(rows), len(cols)))], axis=1)
        n = np.ones(s.shape, dtype=bool)
        n[:, :self.k] = self.new[lo + rows]
        top = np.lexsort((i, ~s), axis=-1)[:, :self.k]       # ~s falls as s rises, without overflow
        self.scores[lo + rows], self.found[lo + rows], self.new[lo + rows] = (
            np.take_along_axis(x, top, axis=1) for x in (s, i, n))


def search(q: Tree, r: Tree, r_ids: np.ndarray, best: Best, cell: int | None = None) -> None:
    """Dual descent of both trees; ``best`` takes what is found."""
    if not len(q.radii) or not len(r.radii):
        return
    same_width(q, r)
    exact = q.largest * r.largest * q.points.shape[1] < _EXACT
    stack = [(float(q.bounds([0], r, 0)[0]), 0, 0)]
    while stack:
        bound, a, b = stack.pop()
        if bound < float(best.scores[q.lo[a]:q.hi[a], -1].min()):
            continue
        if len(r.children[b]) and (not len(q.children[a]) or r.radii[b] >= q.radii[a]):
            nodes = r.children[b]
            more = [(x, a, n) for x, n in zip(r.bounds(nodes, q, a).tolist(), nodes.tolist())]
        elif len(q.children[a]):
            nodes = q.children[a]
            more = [(x, n, b) for x, n in zip(q.bounds(nodes, r, b).tolist(), nodes.tolist())]
        else:
            best.offer(q.lo[a], q.hi[a],
                       scores_of(q.points[q.lo[a]:q.hi[a]], r.points[r.lo[b]:r.hi[b]], exact), r_ids[r.lo[b]:r.hi[b]], cell)
            continue
        stack.extend(sorted(more))              # the highest bound comes off first


# ---------------------------------------------------------------------------------------
# Spark
# ---------------------------------------------------------------------------------------
def _matrix(column) -> np.ndarray:
    rows = [np.frombuffer(b, dtype="<f8") for b in column.to_pylist()]
    out = np.zeros((len(rows), max(map(len, rows), default=0)))
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, is_query: Column, scale: float) -> DataFrame:
    """id, q (is a query), vec (little-endian doubles that hold integers) of the rows that take part."""
    def run(batches):
        for b in batches:
            keep, vecs = [], []
            for at, v in enumerate(b.column(2)):
                x = v.values
                if x is None or x.null_count:
                    continue
                x = x.to_numpy(zero_copy_only=False).astype("<f8")
                with np.errstate(over="ignore"):
                    x = np.floor(scale * x) + 0.0        # no negative zero
                if np.isfinite(x).all():
                    keep.append(at)
                    vecs.append(x.tobytes())
            take = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), pa.array(vecs, pa.binary())],
                                             names=["id", "q", "vec"])

    d = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(is_query, F.lit(False)).alias("q"),
                       F.col(f"`{vector_col}`").cast("array<double>").alias("v")).filter("id IS NOT NULL AND v IS NOT NULL")
    return d.mapInArrow(run, "id bigint, q boolean, vec binary")


def choose_pivots(sample: np.ndarray, wanted: int) -> np.ndarray:
    """Greedy cover of the sample: each pivot is the row farthest from those before."""
    pivots = [0]
    with np.errstate(over="ignore", invalid="ignore"):
        far = np.full(len(sample), np.inf)
        while len(pivots) < min(wanted, len(sample)):
            d = sample - sample[pivots[-1]]
            far = np.minimum(far, np.nan_to_num((d * d).sum(axis=1), nan=np.inf))
            if not far.max() > 0:
                break
            pivots.append(int(far.argmax()))
    return sample[pivots]


def _assigned(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    def run(batches):
        for b in batches:
            x = _matrix(b.column(2))
            width = max(x.shape[1], pivots.shape[1])
            x, p = padded(x, width), padded(pivots, width)
            with np.errstate(over="ignore", invalid="ignore"):
                near = np.nan_to_num((p * p).sum(axis=1)[None, :] - 2 * (x @ p.T), nan=np.inf).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(near, pa.int32())], names=["id", "q", "vec", "pivot"])

    return rows.mapInArrow(run, "id bigint, q boolean, vec binary, pivot int")


def _numbered(counts: dict[int, int], pivots: int, most: int) -> tuple[list[int], list[int]]:
    """Per pivot its first part and the number of its parts of about ``most`` rows."""
    parts = [max(1, -(-counts.get(p, 0) // most)) for p in range(pivots)]
    return [sum(parts[:p]) for p in range(pivots)], parts


def _grouped(counts: dict[int, int], pivots: int, most: int) -> tuple[list[int], list[int]]:
    """The same, but neighbouring small pivots share a part."""
    first, parts, held, number = [], [], 0, 0
    for p in range(pivots):
        c = counts.get(p, 0)
        if held and held + c > most:
            number, held = number + 1, 0
        n = max(1, -(-c // most))
        first.append(number)
        parts.append(n)
        number, held = (number + n, 0) if n > 1 else (number, held + c)
    return first, parts


def _part(first: list[int], parts: list[int]) -> Column:
    at = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("pivot") + 1)
    return (at(first) + F.pmod(F.xxhash64("id"), at(parts))).cast("int")


_QUERY = "struct<id:bigint,vec:binary,scores:array<bigint>,found:array<bigint>>"
_CELL = f"cell int, pivot int, centre binary, radius double, tree binary, queries array<{_QUERY}>"
_QUERIES = pa.list_(pa.struct([("id", pa.int64()), ("vec", pa.binary()), ("scores", pa.list_(pa.int64())), ("found", pa.list_(pa.int64()))]))


def _cells(assigned: DataFrame, k: int) -> DataFrame:
    """A row per cell: its tree, and its queries with their first lists."""
    def build(t: pa.Table) -> pa.Table:
        ids, vecs = t.column("id").to_numpy(), t.column("vec").to_pylist()
        q, x = t.column("q").to_numpy(), _matrix(t.column("vec"))
        seen, rows = {}, []
        for i in np.argsort(ids, kind="stable").tolist():          # smallest ids first
            held = seen.setdefault(vecs[i].rstrip(b"\0"), [])
            if len(held) <= k and int(ids[i]) not in held:
                held.append(int(ids[i]))
                rows.append(i)
        tree = Tree(x[rows])
        tree.ids = ids[rows][tree.order]
        asked = list({(int(ids[i]), vecs[i]): i for i in np.flatnonzero(q).tolist()}.values())
        mine = Tree(x[asked])
        asked = np.array(asked, dtype=np.int64)[mine.order]
        best = Best(ids[asked], k)
        search(mine, tree, tree.ids, best)
        queries = []
        for j, i in enumerate(asked.tolist()):
            got = best.scores[j] > _LOWEST
            queries.append({"id": int(ids[i]), "vec": vecs[i], "scores": best.scores[j][got].tolist(), "found": best.found[j][got].tolist()})
        return pa.table([t.column("cell").slice(0, 1), t.column("pivot").slice(0, 1),
                         pa.array([tree.centres[0].tobytes()], pa.binary()), pa.array([float(tree.radii[0])]),
                         pa.array([pickle.dumps(tree)], pa.binary()), pa.array([queries], _QUERIES)],
                        names=["cell", "pivot", "centre", "radius", "tree", "queries"])

    return assigned.groupBy("cell").applyInArrow(build, _CELL)


def _blocks(queries: DataFrame, k: int) -> DataFrame:
    """A row per block: the tree of its queries and the lists they have."""
    def build(t: pa.Table) -> pa.Table:
        tree = Tree(_matrix(t.column("vec")))
        scores, found = np.full((t.num_rows, k), _LOWEST), np.zeros((t.num_rows, k), dtype=np.int64)
        for i, (s, f) in enumerate(zip(t.column("scores").to_pylist(), t.column("found").to_pylist())):
            scores[i, :len(s)], found[i, :len(f)] = s, f
        by = tree.order
        vecs = t.column("vec").to_pylist()
        tree.best = Best(t.column("id").to_numpy()[by], k, scores[by], found[by], t.column("cell").to_numpy()[by])
        tree.keys = t.column("key").to_numpy()[by]
        return pa.table([t.column("block").slice(0, 1), pa.array([tree.centres[0].tobytes()], pa.binary()),
                         pa.array([float(tree.radii[0])]), pa.array([float(scores[:, -1].min())]),
                         pa.array([pickle.dumps(tree)], pa.binary())],
                        names=["block", "centre", "radius", "worst", "tree"])

    return queries.groupBy("block").applyInArrow(build, "block int, centre binary, radius double, worst double, tree binary")


def _met(pairs: DataFrame) -> DataFrame:
    """(block, cell, bound) of the pairs that the bound leaves."""
    def run(batches):
        for b in batches:
            c = {name: b.column(i) for i, name in enumerate(b.schema.names)}
            q, r = _matrix(c["q"]), _matrix(c["r"])
            width = max(q.shape[1], r.shape[1])
            q, r = padded(q, width), padded(r, width)
            bound = np.array([score_bound(q[i], np.linalg.norm(q[i]), c["s"][i].as_py(), r[i], np.linalg.norm(r[i]), c["t"][i].as_py())
                              for i in range(b.num_rows)], dtype=np.float64)
            ok = pa.array(bound >= c["worst"].to_numpy())
            yield pa.RecordBatch.from_arrays([c["block"].filter(ok), c["cell"].filter(ok), pa.array(bound).filter(ok)],
                                             names=["block", "cell", "bound"])

    return pairs.mapInArrow(run, "block int, cell int, bound double")


def _searched(work: DataFrame) -> DataFrame:
    """(query_id, key, vec_id, score) that each slice of cells adds to the lists of a block."""
    def run(t: pa.Table) -> pa.Table:
        order = np.argsort(-t.column("bound").to_numpy(), kind="stable").tolist()
        trees, cells = t.column("tree"), t.column("cell").to_pylist()
        block = pickle.loads(trees[next(i for i in order if cells[i] is None)].as_py())
        for i in order:
            if cells[i] is not None:
                cell = pickle.loads(trees[i].as_py())
                search(block, cell, cell.ids, block.best, cells[i])
        b = block.best
        row, col = np.nonzero(b.new & (b.scores > _LOWEST))
        return pa.table([b.ids[row], block.keys[row], b.found[row, col], b.scores[row, col]],
                        names=["query_id", "key", "vec_id", "score"])

    return work.groupBy("block", "slice").applyInArrow(run, "query_id bigint, key bigint, vec_id bigint, score bigint")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: float = 256.0) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows of every row for which ``is_query`` holds."""
    spark = ready(vectors.sparkSession)
    tables = Scratch(spark, "cover-tree")
    rows = tables.keep(whole_vectors(vectors, id_col, vector_col, is_query, scale))
    sample = rows.select(F.xxhash64("id", "vec").alias("h"), "vec").orderBy("h", "vec").limit(SAMPLE).toArrow()
    sample = _matrix(sample.column("vec")) if sample.num_rows else np.zeros((1, 0))
    cell_rows = max(64, CELL_VALUES // max(1, sample.shape[1]))
    pivots = choose_pivots(sample, min(MAX_PIVOTS, max(1, rows.count() // cell_rows)))
    assigned = tables.keep(_assigned(rows, pivots))
    counts = assigned.groupBy("pivot").agg(F.count(F.lit(1)).alias("n"), F.count_if("q").alias("q")).collect()
    first, parts = _numbered({r.pivot: r.n for r in counts}, len(pivots), cell_rows)
    cells = tables.keep(_cells(assigned.withColumn("cell", _part(first, parts)), k))
    queries = tables.keep(cells.select("cell", "pivot", F.explode("queries").alias("x")).select(
        "cell", "pivot", "x.*", F.xxhash64("x.vec").alias("key")))
    first_block, in_blocks = _grouped({r.pivot: r.q for r in counts}, len(pivots), BLOCK)
    blocks = tables.keep(_blocks(queries.withColumn("block", _part(first_block, in_blocks)), k))

    slices = -(-sum(parts) // SLICE)
    last_block = max(f + n for f, n in zip(first_block, in_blocks)) - 1
    pairs = (cells.select("cell", F.col("centre").alias("r"), F.col("radius").alias("t"),
                          F.explode(F.sequence(F.lit(0), F.lit(last_block))).alias("block"))
             .join(blocks.select("block", F.col("centre").alias("q"), F.col("radius").alias("s"), "worst"), "block"))
    met = tables.keep(_met(pairs).withColumn("slice", F.col("cell") % slices))
    work = (met.join(cells.select("cell", "tree"), "cell").select("block", "slice", "cell", "bound", "tree")
            .unionByName(met.select("block", "slice").distinct().join(blocks.select("block", "tree"), "block")
                         .select("block", "slice", F.lit(None).cast("int").alias("cell"), F.lit(float("inf")).alias("bound"), "tree")))
    found = _searched(work).unionByName(
        queries.select(F.col("id").alias("query_id"), "key", F.explode(F.arrays_zip("found", "scores")).alias("x"))
        .select("query_id", "key", F.col("x.found").alias("vec_id"), F.col("x.scores").alias("score")))
    best = Window.partitionBy("query_id", "key").orderBy(F.col("score").desc(), "vec_id")
    out = Scratch(spark, "top-k").keep(
        found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
    tables.drop()
    return out
