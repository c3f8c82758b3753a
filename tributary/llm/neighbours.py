"""Approximate nearest neighbours by NN-descent and greedy search of the graph.

Equal vectors are one node. The graph starts from exact neighbours inside cells of random
hyperplanes, several times over, and inside cells by hash, which give edges to a node that is
alone in the others as well. It is improved in rounds: every node brings a bounded
sample of its neighbours, forward and reverse, together, each fresh pair among them is
compared, and a node keeps its `degree` nearest. Rounds are joins and windows over written
edge tables; a task only sees the sampled lists of some nodes. Vectors travel as bytes, one
per component, which is enough for the graph.

A query starts at its own node. The search keeps the `beam` nearest nodes found, and in each
round joins the nearest that were not yet expanded with the stored lists of neighbours. The
lists lie in a table bucketed by node, so that only the queries move. The best of the beam are
scored again on the original vectors in double precision and expanded into their copies.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.folders import work_folder
from tributary.llm.common import release, written

CELL = 256


def usable(vectors: DataFrame, id_column: str, column: str) -> DataFrame:
    """(id, v): finite non-zero vectors of the commonest length, in double precision."""
    v = F.transform(column, lambda x: x.cast("double"))
    present = vectors.where(F.col(id_column).isNotNull() & F.col(column).isNotNull())
    good = present.select(F.col(id_column).alias("id"), v.alias("v")).where(
        F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("v", lambda x: x != 0)
    )
    lengths = good.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1)
    return good.join(F.broadcast(lengths.select("n")), F.size("v") == F.col("n")).select("id", "v")


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    """Rows of a column of equally long binary values."""
    flat = b"".join(column.to_pylist())
    return np.frombuffer(flat, kind).reshape(len(column), -1) if len(column) else np.zeros((0, 1), kind)


def _unit(bytes_matrix: np.ndarray) -> np.ndarray:
    x = bytes_matrix.astype(np.float32)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, which changes no cosine, so that no square of a component is lost or infinite."""
    if not x.size:
        return x
    _, exponent = np.frexp(np.abs(x).max(axis=1, keepdims=True))
    return np.ldexp(x, -exponent)


def short_vectors(nodes: DataFrame) -> DataFrame:
    """(node, vec): components scaled to signed bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("v").flatten().to_numpy(zero_copy_only=False)
            x = flat.reshape(batch.num_rows, -1) if batch.num_rows else np.zeros((0, 1))
            x = _scaled(x)
            x = np.round(127 * (x / np.maximum(np.abs(x).max(axis=1, keepdims=True), 1e-300))).astype(np.int8)
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array([r.tobytes() for r in x], pa.binary())], names=["node", "vec"])

    return nodes.select("node", "v").mapInArrow(run, "node long, vec binary")


def start_edges(short: DataFrame, n: int, degree: int, trees: int) -> DataFrame:
    """(node, near, sim): the nearest inside cells of random hyperplanes, and of one dealing by hash."""
    dealt = max(1, n // CELL)
    bits = max(0, math.ceil(math.log2(max(1, n) / CELL)))

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _unit(_matrix(batch.column("vec"), np.int8))
            for tree in range(trees + 1):
                planes = np.random.default_rng(tree).normal(size=(x.shape[1], bits))
                code = ((x @ planes > 0) @ (1 << np.arange(bits, dtype=np.int64))) if bits else np.zeros(len(x), np.int64)
                if tree == trees:  # a node's number is a hash
                    code = batch.column("node").to_numpy() % dealt
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), tree)), pa.array(code.astype(np.int64)), *batch.columns], names=["tree", "code", "node", "vec"]
                )

    def cell(table: pa.Table) -> pa.Table:
        node = table.column("node").to_numpy()
        x = _unit(_matrix(table.column("vec").combine_chunks(), np.int8))
        k = min(degree, len(node) - 1)
        if k < 1:
            return pa.table({"node": pa.array([], pa.int64()), "near": pa.array([], pa.int64()), "sim": pa.array([], pa.float32())})
        sims = x @ x.T
        np.fill_diagonal(sims, -9)
        best = np.argpartition(-sims, k - 1, axis=1)[:, :k]
        return pa.table(
            {"node": np.repeat(node, k), "near": node[best].ravel(), "sim": np.take_along_axis(sims, best, 1).ravel().astype(np.float32)}
        )

    placed = written(short.mapInArrow(codes, "tree long, code long, node long, vec binary"), "nn-codes")
    sizes = placed.groupBy("tree", "code").agg(F.ceil(F.count(F.lit(1)) / (4 * CELL)).alias("parts"))
    part = F.pmod(F.xxhash64("node", "tree"), F.col("parts"))
    cells = placed.join(sizes, ["tree", "code"]).withColumn("part", part)
    return cells.groupBy("tree", "code", "part").applyInArrow(cell, "node long, near long, sim float").select("node", "near", "sim")


def nearest_edges(edges: DataFrame, degree: int) -> DataFrame:
    """The `degree` nearest of each node; of an edge that is named twice the older counts."""
    once = edges.groupBy("node", "near").agg(F.max("sim").alias("sim"), F.min(F.col("fresh").cast("int")).alias("fresh"))
    place = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("sim"), "near"))
    kept = once.withColumn("place", place).where(F.col("place") <= degree)
    return kept.select("node", "near", "sim", (F.col("fresh") == 1).alias("fresh"), "place")


def descend(edges: DataFrame, short: DataFrame, turn: int, degree: int, sample: int) -> DataFrame:
    """One round: neighbours of a node are compared with each other."""
    both = edges.select("node", "near", "fresh").union(edges.select("near", "node", "fresh"))
    order = F.row_number().over(Window.partitionBy("node", "fresh").orderBy(F.xxhash64(F.lit(turn), "node", "near"), "near"))
    sampled = both.withColumn("order", order).where(F.col("order") <= sample).select("node", "near", "fresh")
    worst = edges.where(F.col("place") == degree).select(F.col("node").alias("near"), F.col("sim").alias("worst"))
    about = short.withColumnRenamed("node", "near").join(worst, "near", "left")
    lists = sampled.join(about, "near").groupBy("node").agg(
        F.collect_list(F.struct("near", "fresh", "vec", F.coalesce("worst", F.lit(-2.0).cast("float")).alias("worst"))).alias("l")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("l")
            bounds = column.offsets.to_numpy() - column.offsets[0].as_py()
            items = column.flatten()
            near, fresh, worst = (items.field(f).to_numpy(zero_copy_only=False) for f in ("near", "fresh", "worst"))
            x = _unit(_matrix(items.field("vec"), np.int8))
            out = []
            for s, e in zip(bounds[:-1], bounds[1:], strict=True):
                new = np.flatnonzero(fresh[s:e])
                sims = x[s:e][new] @ x[s:e].T
                ids, other = near[s:e][new], near[s:e]
                # A pair of two fresh ones is looked at from the smaller id only.
                ok = (ids[:, None] != other[None, :]) & (~fresh[s:e][None, :] | (ids[:, None] < other[None, :]))
                for one, two, limit in ((0, 1, worst[s:e][new][:, None]), (1, 0, worst[s:e][None, :])):
                    i, j = np.nonzero(ok & (sims > limit))
                    pair = (ids[i], other[j])
                    out.append((pair[one], pair[two], sims[i, j]))
            a, b, c = (np.concatenate(v) for v in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.float32),)
            key = np.unique(np.stack([a, b]), axis=1, return_index=True)[1] if len(a) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(a[key]), pa.array(b[key]), pa.array(c[key].astype(np.float32))], names=["node", "near", "sim"])

    found = lists.select("l").mapInArrow(run, "node long, near long, sim float").withColumn("fresh", F.lit(True))
    # What was sampled as fresh has been compared.
    seen = sampled.where("fresh").select("node", "near", F.lit(True).alias("seen"))
    old = edges.join(seen, ["node", "near"], "left").withColumn("fresh", F.col("fresh") & F.col("seen").isNull())
    return nearest_edges(old.select("node", "near", "sim", "fresh").union(found), degree)


def search(graph: str, starts: DataFrame, beam: int, wide: int, rounds: int) -> DataFrame:
    """(query, beam array of (sim, node, done)) after no node of a beam is left to expand.

    `graph` names the table of (node, near, vecs); `starts` has (query, vec, beam).
    """
    spark = starts.sparkSession
    state = starts
    lists = spark.table(graph)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            query, least = batch.column("query").to_numpy(), batch.column("least").to_numpy()
            q = _unit(_matrix(batch.column("vec"), np.int8))
            near = batch.column("near")
            bounds = near.offsets.to_numpy() - near.offsets[0].as_py()
            ids, row = near.flatten().to_numpy(), np.repeat(np.arange(len(query)), np.diff(bounds))
            x = _unit(np.frombuffer(b"".join(batch.column("vecs").to_pylist()), np.int8).reshape(len(ids), -1)) if len(ids) else q[:0]
            sims = np.einsum("ij,ij->i", x, q[row])
            good = sims > least[row]
            yield pa.RecordBatch.from_arrays(
                [pa.array(query[row[good]]), pa.array(sims[good].astype(np.float32)), pa.array(ids[good])], names=["query", "sim", "node"]
            )

    of = pa.list_(pa.struct([("sim", pa.float32()), ("node", pa.int64()), ("done", pa.bool_())]))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, left = [], []
            for old, new, expanded in zip(batch.column("beam").to_pylist(), batch.column("found").to_pylist(), batch.column("expanded").to_pylist(), strict=True):
                expanded, best = set(expanded or ()), {}
                for entry in old:
                    best[entry["node"]] = (entry["sim"], entry["done"] or entry["node"] in expanded)
                for entry in new or ():
                    best.setdefault(entry["node"], (entry["sim"], False))
                order = sorted(best.items(), key=lambda kv: (-kv[1][0], kv[0]))[:beam]
                out.append([{"sim": s, "node": node, "done": done} for node, (s, done) in order])
                left.append(sum(not done for _, (_, done) in order))
            yield pa.RecordBatch.from_arrays(
                [batch.column("query"), batch.column("vec"), pa.array(out, of), pa.array(left, pa.int64())], names=["query", "vec", "beam", "left"]
            )

    schema = "query long, vec binary, beam array<struct<sim: float, node: long, done: boolean>>, left long"
    for _ in range(rounds):
        todo = F.slice(F.filter("beam", lambda b: ~b["done"]), 1, wide)
        todo = F.transform(todo, lambda b: b["node"])
        least = F.when(F.size("beam") < beam, F.lit(-2.0)).otherwise(F.element_at("beam", -1)["sim"]).cast("float")
        opened = state.select("query", "vec", "beam", todo.alias("expanded"), least.alias("least"))
        asked = opened.select("query", "vec", "least", F.explode("expanded").alias("node"))
        found = asked.join(lists, "node").select("query", "vec", "least", "near", "vecs")
        found = found.mapInArrow(compare, "query long, sim float, node long")
        found = found.groupBy("query").agg(F.collect_list(F.struct("sim", "node")).alias("found"))
        joined = opened.join(found, "query", "left").select("query", "vec", "beam", "found", "expanded")
        state = written(joined.mapInArrow(merge, schema), "nn-search")
        if not (state.agg(F.sum("left").alias("n")).first().n or 0):
            break
        state = state.drop("left")
    return state.select("query", "beam")


def nearest_neighbours(
    vectors: DataFrame,
    queries: DataFrame,
    *,
    id_column: str = "vec_id",
    column: str = "embedding",
    k: int = 5,
    degree: int = 32,
    sample: int = 16,
    trees: int = 6,
    turns: int = 6,
    beam: int = 320,
    wide: int = 64,
    rounds: int = 40,
    again: int = 64,
) -> DataFrame:
    """(query_id, rank, id, score): for each id in `queries`, its `k` nearest other vectors found.

    `vectors` has the id and an array column, `queries` the ids to search for, among them.
    Nearness is the cosine; ties go to the smaller id. Null and zero vectors, such with null or
    non-finite components or of another length than most, and null ids take no part. Rows that
    repeat an id count once. Fewer candidates than `k` are all returned. Empty tables give an
    empty result; other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_column, column).groupBy("id").agg(F.min("v").alias("v"))
    rows = written(rows.withColumn("node", F.xxhash64("v")), "nn-vectors")
    nodes = rows.groupBy("node").agg(F.min("v").alias("v"), F.min("id").alias("first"))
    nodes = written(nodes, "nn-nodes")
    short = written(short_vectors(nodes), "nn-short")
    n = short.count()
    edges = start_edges(short, n, degree, trees).withColumn("fresh", F.lit(True))
    edges = written(nearest_edges(edges, degree), "nn-edges")
    for turn in range(turns):
        if n <= degree + 1:
            break
        edges = written(descend(edges, short, turn, degree, sample), "nn-edges")
        release(spark)

    lists = edges.join(short.withColumnRenamed("node", "near"), "near").groupBy("node")
    lists = lists.agg(F.array_sort(F.collect_list(F.struct("place", "near", "sim", "vec"))).alias("l"))
    graph = f"nn_graph_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = lists.select("node", F.col("l.near").alias("near"), F.col("l.sim").alias("sims"), F.expr("aggregate(l.vec, X'', (a, b) -> concat(a, b))").alias("vecs"))
    stored = packed.repartition(buckets, "node").write.option("path", work_folder(spark, "nn-graph"))
    stored.bucketBy(buckets, "node").sortBy("node").saveAsTable(graph)
    try:
        asked = queries.select(F.col(id_column).alias("id")).distinct().join(rows.select("id", "node"), "id")
        asked = written(asked.select(F.col("id").alias("query_id"), "node"), "nn-queries")
        own = F.expr("transform(arrays_zip(near, sims), x -> named_struct('sim', x.sims, 'node', x.near, 'done', false))")
        starts = asked.select("node").distinct().join(spark.table(graph), "node").join(short, "node")
        starts = written(starts.select(F.col("node").alias("query"), "vec", own.alias("beam")), "nn-search")
        found = written(search(graph, starts, beam, wide, rounds), "nn-found")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {graph}")

    near = found.select("query", F.explode(F.slice("beam", 1, again)).alias("b")).select("query", F.col("b.node").alias("node"))
    near = near.union(asked.select("node", "node")).distinct()  # copies of the query itself
    exact = near.join(nodes.select("node", "v"), "node").join(nodes.select(F.col("node").alias("query"), F.col("v").alias("q")), "query")

    def cosine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (_scaled(batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)) for c in ("q", "v"))
            dot = np.einsum("ij,ij->i", a, b)
            score = dot / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))
            yield pa.RecordBatch.from_arrays([batch.column("query"), batch.column("node"), pa.array(score)], names=["query", "node", "score"])

    scored = exact.select("query", "node", "q", "v").mapInArrow(cosine, "query long, node long, score double")
    member = F.row_number().over(Window.partitionBy("node").orderBy("id"))
    members = rows.select("node", "id").withColumn("m", member).where(F.col("m") <= k + 1).drop("m")
    pairs = asked.withColumnRenamed("node", "query").join(scored, "query").join(members, "node").where("id <> query_id")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    ranked = pairs.withColumn("rank", place).where(F.col("rank") <= k)
    return written(ranked.select("query_id", "rank", F.col("id").alias(id_column), "score"), "nn-result")
