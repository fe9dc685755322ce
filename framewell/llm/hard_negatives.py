"""Hard-negative mining: cover trees over norm-augmented candidates.

The score of two vectors is the inner product of their components after ``floor(scale * x)``.
One further component makes all candidates of a tree equally long (``norm``), so those
within an angle of a node's centre lie in a cone, and the cone bounds their scores for
any query from above and below.

*Index.*  Every vector belongs to a chunk: the nearest of a few centres (the top of the
tree, farthest points of a bounded sample of ``SAMPLE`` vectors by hash), cut by a hash
where a centre has more than ``CHUNK`` vectors.  A task builds the tree of a chunk: a
node picks farthest points as children until they cover it at half its radius (or
``FANOUT`` is reached), gives every vector to the nearest, and measures the radius that
really covers them; nodes of up to ``LEAF`` vectors are leaves.  Trees are written to
the shared folder, one row a chunk.  All vectors are indexed; the sample only decides
which chunk they are in.

*Search.*  A query has a window of scores.  It first visits the chunk with the best
bound, which gives a k-th best score to beat; then all other chunks whose cone still
reaches the window above that score.  In a chunk its leaves are visited best bound
first, in rounds of 1, 2, 4, ... leaves, many queries at a time; nodes outside the
window or below the k-th best are skipped, and the vectors of a leaf are scored
exactly.  Blocks of queries and chunks are both bounded, so a task's memory is.

Of equal vectors with one label only the rows that can be among the first are
indexed (the smallest ids, as many as a result can hold), and anchors with equal
vector and label are one query, so copies cost nothing.

Defined cases: rows take no part without an id, a label or a vector, or with a null or
non-finite component; of vectors of different lengths missing components count as 0;
ties go to the smaller id, then to the earlier row; a repeated row is another row;
scores are exact (whole numbers beyond 2**53 are kept as such, beyond 64 bits the
result has the nearest 64-bit number); an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewell.llm.common import BROADCAST_BYTES, join_classes, pick
from framewell.plans.settle import settle, settle_counted

SAMPLE = 2048
CENTRES = 32
CHUNK = 16_384
BLOCK = 4096
FANOUT = 32
LEAF = 256
EXACT = 2.0**52
LONG = 2**63 - 1


# -- vectors -------------------------------------------------------------------------------
def scaled_vectors(vectors: DataFrame, scale: int) -> DataFrame:
    """``row, vec_id, label, anchor, v`` of the rows that take part; ``v`` holds the whole components as doubles."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            lengths = np.asarray(lists.value_lengths().fill_null(0))
            flat = lists.flatten()
            x = np.floor(scale * np.asarray(flat.cast(pa.float64()).fill_null(np.nan), dtype=np.float64))
            ends = np.cumsum(lengths)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
            sound = np.asarray(lists.is_valid()) & (bad[ends] == bad[ends - lengths])
            keep = pa.array(np.flatnonzero(sound))
            raw = [x[e - n : e].tobytes() for e, n in zip(ends[sound].tolist(), lengths[sound].tolist(), strict=True)]
            kept = batch.take(keep)
            yield pa.RecordBatch.from_arrays(
                [kept.column("vec_id"), kept.column("label"), kept.column("anchor"), pa.array(raw, pa.binary())],
                names=["vec_id", "label", "anchor", "v"],
            )

    some = vectors.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")
    sound = some.mapInArrow(run, "vec_id bigint, label bigint, anchor boolean, v binary")
    return settle(sound.withColumn("row", F.monotonically_increasing_id()), "vectors")


def stacked(raw: pa.ChunkedArray | list[bytes], width: int = 0) -> np.ndarray:
    """Vectors given as bytes, as rows of equal length."""
    values = raw if isinstance(raw, list) else raw.to_pylist()
    width = max([width, *(len(b) // 8 for b in values)])
    if all(len(b) == 8 * width for b in values):
        return np.frombuffer(b"".join(values), np.float64).reshape(len(values), width)
    out = np.zeros((len(values), width))
    for i, b in enumerate(values):
        out[i, : len(b) // 8] = np.frombuffer(b, np.float64)
    return out


def together(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both with the components of the longer."""
    width = max(a.shape[1], b.shape[1])
    widened = lambda x: x if x.shape[1] == width else np.pad(x, ((0, 0), (0, width - x.shape[1])))
    return widened(a), widened(b)


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products: doubles where those are exact, else whole numbers of any size."""
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)))
    reach = np.abs(a).max(axis=0) @ np.abs(b).max(axis=0)
    if reach < EXACT:
        return a @ b.T
    whole = lambda x: np.array([[int(c) for c in r] for r in x.tolist()], dtype=object).reshape(x.shape)
    return whole(a) @ whole(b).T


# -- trees -----------------------------------------------------------------------------------
def farthest_points(points: np.ndarray, most: int, until: float) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of centres and the nearest of them for each point; stops when all are within ``until`` (two at least of unequal points)."""
    centres = [0]
    far = np.linalg.norm(points - points[0], axis=1)
    nearest = np.zeros(len(points), np.int64)
    while len(centres) < most and (far.max() > until or (len(centres) == 1 and far.max() > 0)):
        c = int(far.argmax())
        d = np.linalg.norm(points - points[c], axis=1)
        nearest[d < far] = len(centres)
        far = np.minimum(far, d)
        centres.append(c)
    return np.array(centres), nearest


def angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Angles between rows and rows, rows of length 0 at any."""
    lengths = np.linalg.norm(a, axis=1)[:, None] * np.linalg.norm(b, axis=1)[None, :]
    return np.arccos(np.clip(np.divide(a @ b.T, lengths, out=np.ones_like(lengths), where=lengths > 0), -1, 1))


class CoverTree:
    """Leaves of a tree with the centre and angle of every node, level by level (see the module)."""

    def __init__(self, vectors: np.ndarray, centres: np.ndarray | None = None, nodes: np.ndarray | None = None, order: np.ndarray | None = None):
        lengths = np.linalg.norm(vectors, axis=1) if len(vectors) else np.zeros(0)
        self.norm = float(lengths.max(initial=0.0))
        self.vectors = vectors
        if nodes is None:
            augmented = np.hstack([vectors, np.sqrt(np.maximum(self.norm**2 - lengths**2, 0))[:, None]])
            self._build(augmented)
        else:
            self.centres, self.nodes, self.order = centres, nodes, order

    def _build(self, points: np.ndarray) -> None:
        # nodes: first and last place in the order, parent, angle; parents come before children
        nodes, centres, order = [], [], np.arange(len(points))
        todo = [(0, len(points), -1)]
        while todo:
            first, last, parent = todo.pop(0)
            own = order[first:last]
            here = points[own]
            middle = here[np.linalg.norm(here - here.mean(axis=0), axis=1).argmin()]
            # distances in float; the angle of the covering ball on the sphere, a little wider than measured
            angle = float(angles(middle[None], here).max()) + 1e-6 if self.norm > 0 else np.pi
            me = len(nodes)
            nodes.append((first, last, parent, angle, 0.0))
            centres.append(middle)
            if last - first <= LEAF or np.ptp(here, axis=0).max() == 0:
                nodes[me] = (first, last, parent, angle, 1.0)
                continue
            radius = np.linalg.norm(here - middle, axis=1).max()
            _, nearest = farthest_points(here, FANOUT, radius / 2)
            sort = np.argsort(nearest, kind="stable")
            order[first:last] = own[sort]
            at = first
            for n in np.bincount(nearest).tolist():
                todo.append((at, at + n, me))
                at += n
        self.nodes, self.centres, self.order = np.array(nodes), np.array(centres), order

    def bounds(self, queries: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest and smallest score each query can have in each of the nodes."""
        q = np.hstack([queries, np.zeros((len(queries), 1))])
        theta = angles(q, self.centres[which])
        length = (np.linalg.norm(q, axis=1) * self.norm)[:, None]
        slack = length * 1e-9 + 1e-6
        angle = self.nodes[which, 3]
        high = length * np.cos(np.maximum(theta - angle, 0)) + slack
        return high, length * np.cos(np.minimum(theta + angle, np.pi)) - slack

    def reached(self, queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(query, leaf, bound)`` for the leaves whose cones, and those of all nodes above, meet the window."""
        parent, is_leaf = self.nodes[:, 2].astype(int), self.nodes[:, 4] > 0
        alive = {}
        out = []
        for level in self._levels():
            top, bottom = self.bounds(queries, level)
            meets = (top >= low[:, None]) & (bottom <= high[:, None])
            for k, node in enumerate(level):
                if parent[node] >= 0:
                    meets[:, k] &= alive[parent[node]]
                alive[node] = meets[:, k]
                if is_leaf[node]:
                    who = np.flatnonzero(meets[:, k])
                    out.append((who, np.full(len(who), node), top[who, k]))
        if not out:
            return np.empty(0, int), np.empty(0, int), np.empty(0)
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def _levels(self) -> Iterator[np.ndarray]:
        depth = np.zeros(len(self.nodes), int)
        for i, p in enumerate(self.nodes[:, 2].astype(int)):
            depth[i] = 0 if p < 0 else depth[p] + 1
        for d in range(depth.max(initial=-1) + 1):
            yield np.flatnonzero(depth == d)


class Best:
    """The first ``k`` found for each query: highest score, then smallest id, then row."""

    def __init__(self, n: int, k: int, low: np.ndarray):
        self.n, self.k, self.low = n, k, low
        self.kth = low.astype(object) if low.dtype == object else low.copy()
        self.rows = tuple(np.empty(0, t) for t in (np.int64, object, np.int64, np.int64))  # query, score, vec_id, row
        self.new: list[tuple] = []

    def offer(self, who: np.ndarray, scores: np.ndarray, allowed: np.ndarray, high: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        fits = allowed & (scores >= self.kth[who][:, None]).astype(bool) & (scores <= high[who][:, None]).astype(bool)
        if scores.dtype != object and scores.shape[1] > self.k:  # within a leaf no more than its own first k, and ties
            held = np.where(fits, scores, -np.inf)
            fits &= held >= np.partition(held, -self.k, axis=1)[:, -self.k][:, None]
        i, j = np.nonzero(fits)
        if len(i):
            self.new.append((who[i], scores[i, j], ids[j], rows[j]))

    def settle(self) -> None:
        if not self.new:
            return
        query, score, vec_id, row = (np.concatenate([old, *[n[c] for n in self.new]]) for c, old in enumerate(self.rows))
        self.new = []
        whole = np.array([int(s) for s in score], dtype=object) if score.dtype == object else score
        order = np.lexsort((row, vec_id, _descending(whole), query))
        query, whole, vec_id, row = query[order], whole[order], vec_id[order], row[order]
        first = np.searchsorted(query, np.arange(self.n))
        place = np.arange(len(query)) - first[query]
        keep = place < self.k
        self.rows = (query[keep], whole[keep].astype(object), vec_id[keep], row[keep])
        full = np.flatnonzero(place == self.k - 1)
        if len(full):
            at = query[full]
            kth = whole[full]
            self.kth[at] = np.maximum(self.kth[at], kth if self.kth.dtype == object else kth.astype(np.float64))


def _descending(score: np.ndarray) -> np.ndarray:
    """A sort key for falling scores (ranks, where numbers do not fit doubles exactly)."""
    if score.dtype != object:
        return -score
    levels = {s: i for i, s in enumerate(sorted(set(score.tolist()), reverse=True))}
    return np.array([levels[s] for s in score.tolist()])


def search_tree(tree: CoverTree, labels, ids, rows, queries, q_labels, low, high, same: bool, k: int) -> tuple[np.ndarray, ...]:
    """``(query, score, vec_id, row)`` of the first ``k`` in each query's window with the same, or another, label."""
    best = Best(len(queries), k, low)
    if not len(queries) or not len(tree.vectors):
        return best.rows
    distinct, which = np.unique(queries, axis=0, return_inverse=True)
    which = which.ravel()
    query, leaf, bound = tree.reached(queries, low.astype(float), high.astype(float))
    order = np.lexsort((-bound, query))
    query, leaf, bound = query[order], leaf[order], bound[order]
    turn = np.arange(len(query)) - np.searchsorted(query, np.arange(len(queries)))[query]
    done, step = 0, 1
    while len(query):
        now = (turn >= done) & (turn < done + step)
        if not now.any():
            break
        visits = np.flatnonzero(now & (bound >= best.kth[query].astype(float)))
        visits = visits[np.argsort(leaf[visits], kind="stable")]
        cuts = np.flatnonzero(np.diff(leaf[visits])) + 1
        for group in np.split(visits, cuts):
            if not len(group):
                continue
            node = tree.nodes[int(leaf[group[0]])]
            own = tree.order[int(node[0]) : int(node[1])]
            for piece in range(0, len(own), 4 * LEAF):  # equal vectors may make a large leaf
                some = own[piece : piece + 4 * LEAF]
                who = query[group]
                asked, back = np.unique(which[who], return_inverse=True)
                scores = exact_scores(distinct[asked], tree.vectors[some])[back]
                match = labels[some][None, :] == q_labels[who][:, None]
                best.offer(who, scores, match if same else ~match, high, ids[some], rows[some])
        best.settle()
        done, step = done + step, step * 2
    return best.rows


# -- the distributed index ---------------------------------------------------------------------
def build_index(rows: DataFrame) -> tuple[DataFrame, int]:
    """``chunk, trees``: one tree a chunk over ``row, vec_id, label, v``; and how many chunks there are."""
    sample = rows.select("v").orderBy(F.xxhash64("v"), "row").limit(SAMPLE).collect()
    points = stacked([bytes(r["v"]) for r in sample]) if sample else np.zeros((0, 1))
    centres = points[farthest_points(points, CENTRES, 0.0)[0]] if len(points) else points

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, c = together(stacked(batch.column("v")), centres)
            near = ((c**2).sum(axis=1)[None, :] - 2 * x @ c.T).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near.astype(np.int32))], names=[*batch.schema.names, "centre"])

    placed = settle(rows.select("row", "vec_id", "label", "v").mapInArrow(assign, "row bigint, vec_id bigint, label bigint, v binary, centre int"), "placed")
    sizes = {r["centre"]: r["n"] for r in placed.groupBy("centre").agg(F.count(F.lit(1)).alias("n")).collect()}  # CENTRES at most
    first, start = {}, 0
    for c in sorted(sizes):
        first[c], start = start, start + -(-sizes[c] // CHUNK)
    if not sizes:
        return rows.sparkSession.createDataFrame([], TREE), 0
    lookup = F.create_map(*[x for c in sizes for x in (F.lit(c), F.struct(F.lit(first[c]).alias("first"), F.lit(-(-sizes[c] // CHUNK)).alias("parts")))])
    at = F.element_at(lookup, F.col("centre"))
    chunked = placed.withColumn("chunk", (at["first"] + F.pmod(F.xxhash64("row"), at["parts"])).cast("int")).drop("centre")
    return settle(chunked.groupBy("chunk").applyInArrow(plant, TREE), "trees"), start


TREE = "chunk int, width int, norm double, centre binary, angle double, row binary, vec_id binary, label binary, v binary, centres binary, nodes binary, tree_order binary"


def plant(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    vectors = stacked(rows.column("v"))
    tree = CoverTree(vectors)
    raw = lambda x, t: np.ascontiguousarray(x, dtype=t).tobytes()
    values = {
        "chunk": pa.array([key[0].as_py()], pa.int32()), "width": pa.array([vectors.shape[1]], pa.int32()), "norm": [tree.norm],
        "centre": pa.array([raw(tree.centres[0], np.float64)], pa.binary()), "angle": [float(tree.nodes[0, 3])],
    }
    for name in ("row", "vec_id", "label"):
        values[name] = pa.array([raw(rows.column(name).to_numpy(), np.int64)], pa.binary())
    for name, x, t in (("v", vectors, np.float64), ("centres", tree.centres, np.float64), ("nodes", tree.nodes, np.float64), ("tree_order", tree.order, np.int64)):
        values[name] = pa.array([raw(x, t)], pa.binary())
    return pa.table(values)


def cut_down(tree: dict) -> tuple[CoverTree, np.ndarray, np.ndarray, np.ndarray]:
    """A stored tree and its labels, ids and rows."""
    whole = lambda name: np.frombuffer(tree[name], np.int64)
    width = tree["width"]
    vectors = np.frombuffer(tree["v"], np.float64).reshape(-1, width)
    centres = np.frombuffer(tree["centres"], np.float64).reshape(-1, width + 1)
    nodes = np.frombuffer(tree["nodes"], np.float64).reshape(-1, 5)
    return CoverTree(vectors, centres, nodes, whole("tree_order")), whole("label"), whole("vec_id"), whole("row")


HIT = pa.schema([("query", pa.int64()), ("score", pa.int64()), ("vec_id", pa.int64()), ("row", pa.int64())])


def search_chunk(same: bool, k: int):
    def run(key, trees: pa.Table, asking: pa.Table) -> pa.Table:
        if not trees.num_rows or not asking.num_rows:
            return HIT.empty_table()
        tree, labels, ids, rows = cut_down(trees.to_pylist()[0])
        queries = stacked(asking.column("v"), tree.vectors.shape[1])
        if queries.shape[1] > tree.vectors.shape[1]:
            queries = queries[:, : tree.vectors.shape[1]]  # further components meet zeros
        bounds = [_limits(asking.column(c)) for c in ("low", "high")]
        query, score, vec_id, row = search_tree(tree, labels, ids, rows, queries, asking.column("label").to_numpy(), *bounds, same, k)
        scores = [min(max(int(s), -LONG), LONG) for s in score.tolist()]
        found = [asking.column("query").to_numpy()[query], scores, vec_id, row]
        return pa.table({n: pa.array(x, pa.int64()) for n, x in zip(HIT.names, found, strict=True)})

    return run


def _limits(column: pa.ChunkedArray) -> np.ndarray:
    values = column.to_pylist()
    far = any(abs(v) > EXACT and abs(v) < LONG for v in values)
    if far:
        return np.array(values, dtype=object)
    return np.array([np.inf * np.sign(v) if abs(v) >= LONG else v for v in values], dtype=np.float64)


def search(index: DataFrame, n_chunks: int, asked: DataFrame, *, same: bool, k: int) -> DataFrame:
    """``query, score, vec_id, row``: the first ``k`` rows of each query's window with its label, or with any other.

    ``asked`` has ``query, label, v, low, high``; scores at the ends of 64 bits stand for no limit.
    """
    spark = asked.sparkSession
    if n_chunks == 0:
        return spark.createDataFrame([], "query bigint, score bigint, vec_id bigint, row bigint")
    asked, n_asked = settle_counted(asked, "queries")
    blocks = max(1, -(-n_asked // BLOCK))
    block = F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int").alias("block")
    tops = index.select("chunk", "width", "norm", "centre", "angle")
    row_bytes = 64 + tops.agg(F.coalesce(F.max(F.octet_length("centre")), F.lit(0)).alias("n")).first()["n"]
    routes = tops.orderBy("chunk").collect() if n_chunks * row_bytes <= BROADCAST_BYTES else None
    stocked = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def visit(queries: DataFrame) -> DataFrame:
        found = stocked.groupBy("chunk", "block").cogroup(queries.groupBy("chunk", "block")).applyInArrow(
            search_chunk(same, k), "query bigint, score bigint, vec_id bigint, row bigint"
        )
        return settle(found, "found")

    if routes is None:  # more chunks than can be looked through at once: each decides for itself
        return first_k(visit(asked.select("*", block, F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))).alias("chunk"))), k)

    kept = [(r["chunk"], r["width"], r["norm"], bytes(r["centre"]), r["angle"]) for r in routes]
    home = visit(routed(asked, kept, only_best=True).select("*", block))
    kth = home.groupBy("query").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("kth"))
    raised = asked.join(kth, "query", "left").withColumn("low", F.greatest("low", F.coalesce("kth", "low"))).drop("kth")
    rest = visit(routed(raised, kept, only_best=False).select("*", block))
    return first_k(home.unionByName(rest), k)


def first_k(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    return settle(found.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k).drop("_n"), "best")


def routed(asked: DataFrame, routes: list[tuple], *, only_best: bool) -> DataFrame:
    """The queries with the ``chunk`` that bounds them best, or with all others that can reach their window."""
    chunks = np.array([r[0] for r in routes], np.int32)
    width = max(r[1] for r in routes)
    centres = np.zeros((len(routes), width + 1))
    for i, (_, own, _, raw, _) in enumerate(routes):
        c = np.frombuffer(raw, np.float64)
        centres[i, :own], centres[i, width] = c[:own], c[own]
    norms, angle = np.array([r[2] for r in routes]), np.array([r[4] for r in routes])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            q = stacked(batch.column("v"), width)[:, :width]
            theta = angles(np.hstack([q, np.zeros((len(q), 1))]), centres)
            length = np.linalg.norm(q, axis=1)[:, None] * norms[None, :]
            slack = length * 1e-9 + 1e-6
            top = length * np.cos(np.maximum(theta - angle, 0)) + slack
            bottom = length * np.cos(np.minimum(theta + angle, np.pi)) - slack
            low, high = (_limits(pa.chunked_array([batch.column(c)])).astype(float)[:, None] for c in ("low", "high"))
            meets = (top >= low) & (bottom <= high)
            best = np.where(bottom <= high, np.minimum(top, high), -np.inf).argmax(axis=1)
            one = np.zeros_like(meets)
            one[np.arange(len(q)), best] = True
            i, j = np.nonzero(meets & (one if only_best else ~one))
            rows = batch.take(pa.array(i))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(chunks[j])], names=[*batch.schema.names, "chunk"])

    return asked.select("query", "label", "v", "low", "high").mapInArrow(
        run, "query bigint, label bigint, v binary, low bigint, high bigint, chunk int"
    )


# -- mining --------------------------------------------------------------------------------------
def mine(
    vectors: DataFrame,
    anchors: Column,
    *,
    scale: int = 256,
    positives: int = 5,
    negatives: int = 3,
    percent: tuple[int, int] = (50, 95),
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows where ``anchors`` holds.

    Each anchor's positives are its first ``positives`` other rows of the same label; the negatives of each are the first
    ``negatives`` rows of other labels whose score is between the two percentages of the positive's.
    """
    marked = vectors.withColumn("_anchor", F.coalesce(anchors, F.lit(False)))
    rows = pick(marked, vec_id=id_col, embedding=vector_col, label=label_col, anchor="_anchor")
    rows = scaled_vectors(rows.select("vec_id", F.col("label").cast("bigint").alias("label"), "embedding", "anchor"), scale)
    # of equal vectors with one label no more can be among the first than a result holds, the anchor itself included
    most = max(positives + 1, negatives)
    same = Window.partitionBy("label", "v").orderBy("vec_id", "row")
    candidates = settle(rows.drop("anchor").withColumn("_n", F.row_number().over(same)).where(F.col("_n") <= most).drop("_n"), "candidates")
    index, n_chunks = build_index(candidates)

    asking = rows.where("anchor")
    queries = settle(asking.groupBy("label", "v").agg(F.min("row").alias("query"), F.count(F.lit(1)).alias("n")), "asked")
    anchored = settle(
        asking.select("row", "vec_id", F.min("row").over(Window.partitionBy("label", "v")).alias("query")), "anchors"
    )
    unlimited = {"low": F.lit(-LONG), "high": F.lit(LONG)}
    found = search(index, n_chunks, queries.select("query", "label", "v").withColumns(unlimited), same=True, k=positives + 1)

    ps, (least, highest) = F.col("score"), percent
    windows = found.select("query", "score").distinct().where(ps >= 0)
    exact = lambda p: ps.cast("decimal(38,0)") * p / 100
    windows = windows.select("query", "score", F.ceil(exact(least)).cast("bigint").alias("low"), F.floor(exact(highest)).cast("bigint").alias("high"))
    windows = settle(windows.where("low <= high").withColumn("window", F.monotonically_increasing_id()), "windows")
    wanted = windows.join(queries.select("query", "label", "v"), "query").select(F.col("window").alias("query"), "label", "v", "low", "high")
    others = search(index, n_chunks, wanted, same=False, k=negatives)

    ranked = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("k"), "vec_id", "row")))
    per_window = others.groupBy(F.col("query").alias("window")).agg(ranked.alias("negatives"))
    per_window = windows.select("window", "query", "score").join(per_window, "window").drop("window")
    lists = found.select("query", "score", "vec_id", "row").join(per_window, ["query", "score"], "left")
    lists = lists.groupBy("query").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("k"), "vec_id", "row", "negatives"))).alias("list"))
    classes = settle(lists.join(queries.select("query", "n"), "query"), "classes")

    met = join_classes(anchored, classes, "query", "n")
    own = F.slice(F.filter("list", lambda p: p["row"] != F.col("row")), 1, positives)
    pairs = met.select(F.col("vec_id").alias("anchor_id"), F.explode(own).alias("p"))
    out = pairs.select("anchor_id", "p", F.posexplode("p.negatives").alias("rank", "n"))
    return out.select(
        "anchor_id", F.col("p.vec_id").alias("positive_id"), (F.col("rank") + 1).cast("int").alias("rank"),
        F.col("n.vec_id").alias("negative_id"), (-F.col("p.k")).alias("positive_score"), (-F.col("n.k")).alias("negative_score"),
    )
