"""Approximate nearest neighbours with learned partitions, in as many levels as the table asks for.

1. Fit on a bounded sample (``SAMPLE`` different vectors of smallest hash): the exact neighbour graph of four fifths
   of it is cut into balanced partitions (median splits, then moves that gain edges under a size limit), and a softmax
   classifier learns from vectors to the partitions of their neighbours.
2. Every vector of the table is put into its most probable partition. A partition that then holds more than ``LEAF``
   rows is fitted and split in the same way, by a sample of its own, and so on: the partitions at the ends (*leaves*) grow in
   number with the table, and none is much larger than ``LEAF`` unless its vectors are copies of one.
3. A query is routed, at each level, to its most probable partitions: as many as reach the level's share of ``TARGET``
   recall on the fifth of the sample that was held out. A query whose leaves hold too few rows visits further ones,
   most probable first, until they hold ``SPARE`` times the neighbours asked for. Candidates are reranked exactly, on
   the original vectors.

Leaves are searched in blocks: at most about ``BLOCK`` candidates meet at most about ``QUERIES`` queries in one
task, however large a leaf is (a vector repeated in a third of all rows fills many blocks of one leaf).
Each block returns a query's best ``k``; those meet in a rank-limited window.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut

SAMPLE = 6000
PER_PARTITION = 75
MAX_PARTITIONS = 64
NEIGHBOURS = 10
TARGET = 0.98
LEAF, MAX_LEAVES = 100_000, 1 << 16
SPARE = 3
BLOCK = 20_000
QUERIES = 2_000
STEPS, RATE, SEED = 200, 0.05, 11


@dataclass
class Router:
    """Softmax classifier over partitions, and the number of them that a query visits."""

    weights: np.ndarray
    bias: np.ndarray
    probes: int

    def logits(self, x: np.ndarray) -> np.ndarray:
        return unit(x) @ self.weights + self.bias

    def ranked(self, x: np.ndarray) -> np.ndarray:
        """Partitions by falling probability; ties by number."""
        return np.argsort(-self.logits(x), axis=1, kind="stable")


@dataclass
class Tree:
    """Routers by node. The root is node 1; partition ``p`` of node ``n`` is node ``n * MAX_PARTITIONS + p + 1``."""

    routers: dict[int, Router] = field(default_factory=dict)

    def plain(self) -> dict[int, tuple]:
        """The routers as arrays: what is broadcast must not need this module in the workers."""
        return {n: (r.weights, r.bias, r.probes) for n, r in self.routers.items()}

    @classmethod
    def of(cls, plain: dict[int, tuple]) -> "Tree":
        return cls({n: Router(*r) for n, r in plain.items()})

    def leaf(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector."""
        node = np.ones(len(x), np.int64)
        pending = [1]
        while pending:
            n = pending.pop()
            own = np.flatnonzero(node == n) if n in self.routers else ()
            if len(own):
                router = self.routers[n]
                child = n * MAX_PARTITIONS + 1 + router.logits(x[own]).argmax(axis=1)
                node[own] = child
                pending += np.unique(child).tolist()
        return node

    def visits(self, x: np.ndarray) -> list[list[int]]:
        """The leaves that each query visits."""
        out: list[list[int]] = [[] for _ in range(len(x))]
        pending = [(1, np.arange(len(x)))]
        while pending:
            n, rows = pending.pop()
            router = self.routers.get(n)
            if router is None:
                for r in rows.tolist():
                    out[r].append(n)
                continue
            near = router.ranked(x[rows])[:, :router.probes]
            for p in np.unique(near).tolist():
                pending.append((n * MAX_PARTITIONS + 1 + p, rows[(near == p).any(axis=1)]))
        return out

    def by_probability(self, x: np.ndarray) -> list[int]:
        """All leaves for one query, most probable first."""
        found, pending = [], [(0.0, 1)]
        while pending:
            log, n = pending.pop()
            router = self.routers.get(n)
            if router is None:
                found.append((-log, n))
                continue
            z = router.logits(x[None])[0]
            z = z - z.max() - np.log(np.exp(z - z.max()).sum())
            pending += [(log + float(v), n * MAX_PARTITIONS + 1 + p) for p, v in enumerate(z)]
        return [n for _, n in sorted(found)]


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` others of largest inner product for each row."""
    out = np.zeros((len(x), min(k, len(x) - 1)), np.int64)
    for a in range(0, len(x), 1000):
        s = x[a:a + 1000] @ x.T
        s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
        out[a:a + 1000] = np.argpartition(-s, out.shape[1] - 1, axis=1)[:, :out.shape[1]]
    return out


def balanced_partitions(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 8) -> np.ndarray:
    """A partition per row, sizes within a tenth of even; moves keep to what raises the edges inside partitions."""
    label = np.zeros(len(x), np.int64)
    for _ in range(parts.bit_length() - 1):
        halves = 2 * label
        for p in np.unique(label):
            own = np.flatnonzero(label == p)
            centred = x[own] - x[own].mean(axis=0)
            axis = np.linalg.svd(centred.T @ centred)[0][:, 0]
            order = own[np.argsort(centred @ axis, kind="stable")]
            halves[order[len(order) // 2:]] += 1
        label = halves
    limit = int(np.ceil(1.1 * len(x) / parts)) + 1
    ends = np.concatenate([graph.ravel(), np.repeat(np.arange(len(x)), graph.shape[1])])
    starts = np.concatenate([np.repeat(np.arange(len(x)), graph.shape[1]), graph.ravel()])
    for _ in range(rounds):
        links = np.zeros((len(x), parts))
        np.add.at(links, (starts, label[ends]), 1.0)
        best = links.argmax(axis=1)
        gain = links[np.arange(len(x)), best] - links[np.arange(len(x)), label]
        sizes, moved = np.bincount(label, minlength=parts), 0
        for v in np.argsort(-gain, kind="stable"):
            if gain[v] <= 0:
                break
            if sizes[best[v]] < limit:
                sizes[label[v]] -= 1
                sizes[best[v]] += 1
                label[v], moved = best[v], moved + 1
        if moved < len(x) // 200:
            break
    return label


def fit_router(sample: np.ndarray, target: float = TARGET) -> Router:
    """Router learned from a sample of vectors (original lengths); how many partitions reach ``target`` is measured on
    every fifth of them, which nothing else is learned from."""
    held = np.arange(len(sample)) % 5 == 4
    fit, test = sample[~held], sample[held]
    parts = 1
    while parts * 2 * PER_PARTITION <= len(fit) and parts < MAX_PARTITIONS:
        parts *= 2
    d = sample.shape[1]
    if parts == 1:
        return Router(np.zeros((d, 1)), np.zeros(1), 1)
    graph, x = neighbour_graph(fit, NEIGHBOURS), unit(fit)
    label = balanced_partitions(x, graph, parts)
    wanted = np.zeros((len(x), parts))
    wanted[np.arange(len(x)), label] = 1.0
    np.add.at(wanted, (np.repeat(np.arange(len(x)), graph.shape[1]), label[graph.ravel()]), 1.0 / graph.shape[1])
    wanted /= wanted.sum(axis=1, keepdims=True)
    w = np.random.default_rng(SEED).normal(0, 0.01, (d, parts))
    b, moments = np.zeros(parts), [np.zeros((d, parts)), np.zeros((d, parts)), np.zeros(parts), np.zeros(parts)]
    for step in range(1, STEPS + 1):  # Adam
        z = x @ w + b
        p = np.exp(z - z.max(axis=1, keepdims=True))
        error = (p / p.sum(axis=1, keepdims=True) - wanted) / len(x)
        for value, grad, k in ((w, x.T @ error, 0), (b, error.sum(axis=0), 2)):
            moments[k] = 0.9 * moments[k] + 0.1 * grad
            moments[k + 1] = 0.999 * moments[k + 1] + 0.001 * grad ** 2
            value -= RATE * 10 * (moments[k] / (1 - 0.9 ** step)) / (np.sqrt(moments[k + 1] / (1 - 0.999 ** step)) + 1e-12)
    router = Router(w, b, parts)
    near = np.argsort(-(test @ fit.T), axis=1, kind="stable")[:, :NEIGHBOURS]
    ranked = router.ranked(test)
    place = np.empty_like(ranked)
    np.put_along_axis(place, ranked, np.arange(parts)[None, :].repeat(len(test), axis=0), axis=1)
    home = router.logits(fit).argmax(axis=1)
    needed = np.take_along_axis(place, home[near], axis=1).ravel()
    reached = np.cumsum(np.bincount(needed, minlength=parts)) / len(needed)
    router.probes = int(np.argmax(reached >= target)) + 1
    return router


def usable_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id`` and ``v`` (doubles) of the rows that take part: an id, and a vector of finite numbers, not all zero. Rows
    equal in both count once."""
    v = F.col(vector_col).cast("array<double>")
    return df.select(F.col(id_col).alias("id"), v.alias("v")).filter(
        F.col("id").isNotNull() & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)).distinct()


def fit_routers(sample: DataFrame, target: float) -> dict[int, Router]:
    """A router for each node of ``sample`` (p, v), fitted in a task of its own on about ``SAMPLE`` vectors at the most."""

    def fit(table: pa.Table) -> pa.Table:
        own = table.sort_by("h")
        router = fit_router(_matrix(own["v"])[:2 * SAMPLE], target)
        numbers = pa.list_(pa.float64())
        return pa.table({"p": own["p"].slice(0, 1), "weights": pa.array([router.weights.ravel()], numbers),
                         "bias": pa.array([router.bias], numbers), "probes": pa.array([router.probes], pa.int32())})

    hashed = sample.select("p", "v", F.xxhash64("v").alias("h"))
    found = hashed.groupBy("p").applyInArrow(fit, "p long, weights array<double>, bias array<double>, probes int")
    return {r["p"]: Router(np.array(r["weights"]).reshape(-1, len(r["bias"])), np.array(r["bias"]), r["probes"])
            for r in found.toLocalIterator()}


def fit_tree(vectors: DataFrame, size: int) -> tuple[Tree, DataFrame, dict[int, int]]:
    """The tree for the vectors of ``size`` numbers, all vectors with their leaf ``p``, and the rows of each leaf.

    Vectors of another size cannot be compared with those: all of one size are a leaf of their own, ``-size``. A level
    takes a bounded sample from each partition to be split and one pass over the table. The driver gets the routers and a
    number a leaf; there are at most about ``MAX_LEAVES`` leaves, so on tables of more than that times ``LEAF`` leaves grow.
    """
    spark, tree, tried, split = vectors.sparkSession, Tree(), set(), {}
    first = vectors.filter(F.size("v") == size).groupBy("v").agg(F.xxhash64("v").alias("h")).orderBy("h", "v").limit(SAMPLE)
    sample, target = cut(first.select(F.lit(1).cast("long").alias("p"), "v"), "sample"), TARGET
    while True:
        found = fit_routers(sample, target)
        tried |= set(found)
        tree.routers |= {p: r for p, r in found.items() if r.bias.size > 1}
        held = spark.sparkContext.broadcast(tree.plain())

        def place(batches, held=held):
            placing = Tree.of(held.value)
            for batch in batches:
                lengths = np.diff(batch.column(1).offsets.to_numpy())
                leaf = -lengths.astype(np.int64)
                own = np.flatnonzero(lengths == size)
                if len(own):
                    leaf[own] = placing.leaf(_matrix(batch.column(1).take(pa.array(own))))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=["id", "v", "p"])

        placed = cut(vectors.mapInArrow(place, T.StructType([*vectors.schema.fields, T.StructField("p", T.LongType())])), "placed")
        rows = dict(map(tuple, placed.groupBy("p").count().collect()))
        total = sum(rows.values())
        most = max(LEAF, total // MAX_LEAVES)
        split.setdefault(1, sum(n for p, n in rows.items() if p > 0))
        # a partition that took most of its parent again would do so at every further level: it stays a leaf
        large = [(p, min(1.0, SAMPLE / n)) for p, n in rows.items()
                 if p > 0 and p not in tried and n > most and n < 0.75 * split[(p - 1) // MAX_PARTITIONS]]
        split |= {p: rows[p] for p, _ in large}
        if not large:
            return tree, placed, rows
        if tried == {1}:                                     # each level loses its share of what may be lost
            target = TARGET ** (1 / (1 + int(np.ceil(np.log(total / most) / np.log(MAX_PARTITIONS)))))
            tree.routers |= fit_routers(sample, target)
        unit_hash = F.pmod(F.xxhash64("v"), F.lit(1 << 30)) / float(1 << 30)
        shares = spark.createDataFrame(large, "p long, share double")
        sample = cut(placed.join(shares, "p").filter(unit_hash < F.col("share")).select("p", "v").distinct(), "sample")


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _best(queries: pa.Table, candidates: pa.Table, k: int) -> pa.Table:
    """The ``k`` best candidates of each query: largest score first, ties to the smaller id."""
    q, c = _matrix(queries["v"]), _matrix(candidates["v"])
    q_ids, c_ids = queries["id"].to_numpy(), candidates["id"].to_numpy()
    rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for a in range(0, len(q), 256):
        rough = q[a:a + 256] @ c.T
        rough[q_ids[a:a + 256, None] == c_ids[None, :]] = -np.inf
        scale = 1e-9 * (1.0 + np.abs(rough, where=np.isfinite(rough), out=np.zeros_like(rough)).max(axis=1, initial=0.0))
        for r, row in enumerate(rough):
            edge = np.partition(row, len(row) - k)[len(row) - k] if len(row) > k else -np.inf
            near = np.flatnonzero((row >= edge - scale[r]) & (row > -np.inf))
            exact = (c[near] * q[a + r]).sum(axis=1)
            order = np.lexsort((c_ids[near], -exact))[:k]
            rows.append((np.full(len(order), q_ids[a + r]), c_ids[near][order], exact[order]))
    columns = [np.concatenate(x) for x in zip(*rows)] if rows else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
    return pa.table({"query_id": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()),
                     "score": pa.array(columns[2], pa.float64())})


def nearest(df: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` (inner product, doubles) of the ``k`` nearest found.

    ``is_query`` is a condition on the column ``id`` (a long). Rows without a usable vector take no part; see
    :func:`usable_vectors`. Only vectors of one length are compared. Every row is a candidate, so an id of several rows may be
    found several times; it is one query (its smallest vector), and its own rows are not among its candidates. A
    query with fewer than ``k`` candidates gets them all, ties go to the smaller id; an empty table gives no row.
    """
    spark = df.sparkSession
    vectors = cut(usable_vectors(df, id_col, vector_col).select(F.col("id").cast("long").alias("id"), "v"), "vectors")
    sizes = vectors.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    tree, placed, rows = fit_tree(vectors, sizes[0]["n"])
    size, wanted = sizes[0]["n"], SPARE * k
    held = spark.sparkContext.broadcast((tree.plain(), rows))

    def route(batches):
        tree, rows = Tree.of(held.value[0]), held.value[1]
        for batch in batches:
            lengths = np.diff(batch.column(1).offsets.to_numpy())
            visits = [[-int(n)] for n in lengths]
            own = np.flatnonzero(lengths == size)
            x = _matrix(batch.column(1).take(pa.array(own))) if len(own) else np.zeros((0, 1))
            for r, v, leaves in zip(own.tolist(), x, tree.visits(x) if len(own) else ()):
                got = sum(rows.get(p, 0) for p in leaves)
                if got <= wanted:                            # too few: further leaves, most probable first
                    seen = set(leaves)
                    for p in tree.by_probability(v):
                        if got > wanted:
                            break
                        if p not in seen and rows.get(p):
                            leaves.append(p)
                            got += rows[p]
                visits[r] = leaves
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(visits, pa.list_(pa.int64()))],
                                             names=["id", "v", "parts"])

    asking = vectors.filter(is_query).groupBy("id").agg(F.min("v").alias("v"))
    schema = T.StructType([*asking.schema.fields, T.StructField("parts", T.ArrayType(T.LongType()))])
    query = cut(asking.mapInArrow(route, schema), "routed").select("id", "v", F.explode("parts").alias("p"))
    asked = query.groupBy("p").agg(F.count("*").alias("n"))
    #: One row a leaf that is visited: its blocks of candidates (c) and of queries (q). 24 bytes a leaf, of at least half a
    #: ``LEAF`` of rows on the average.
    blocks = cut(placed.groupBy("p").agg(F.count("*").alias("m")).join(asked, "p").select(
        "p", F.ceil(F.col("m") / BLOCK).cast("int").alias("cs"), F.ceil(F.col("n") / QUERIES).cast("int").alias("qs")), "blocks")

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        """Each row once for every block of the other side; its own block by hash of the id."""
        grid = rows.join(blocks, "p").withColumn(own, F.pmod(F.xxhash64("id", "v"), F.col(f"{own}s")).cast("int"))
        return grid.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1))).select("p", "c", "q", "id", "v")

    found = dealt(query, "q", "c").groupBy("p", "c", "q").cogroup(dealt(placed, "c", "q").groupBy("p", "c", "q")).applyInArrow(
        lambda left, right: _best(left, right, k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
