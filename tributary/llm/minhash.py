"""Near-duplicate documents by min-max hashing.

A document is the set of its distinct five-word runs. Each of `permutations` hash
functions gives two signature values, the smallest and the largest number in the set, so
that half as many evaluations fill the same bands. Bands of four values propose pairs;
every proposed pair is confirmed on the full sets. With 64 functions there are 32 bands,
and a pair of similarity 0.75 is missed with a probability of (1 - 0.75**4)**32, about
five in a million.

A bucket never becomes all pairs of its members. Documents with the same set are one
member. Each round a bucket compares its members with one pivot only, the links found are
joined into components, and the pivot leaves; a bucket whose members are all in one
component is finished. What is still open after `star_rounds` is cut into blocks, and each
pair of blocks is compared in a task of its own that returns a spanning forest of the links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import batches_of, written
from tributary.llm.components import joined_components
from tributary.llm.tokens import mix, shingle_hashes, word_hashes

_random = np.random.default_rng(75)
MAX_PERMUTATIONS = 128
MULTIPLIERS = _random.integers(0, 1 << 63, MAX_PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _random.integers(0, 1 << 63, MAX_PERMUTATIONS, dtype=np.uint64)
CHUNK = 4096


def min_max(shingles: np.ndarray, permutations: int) -> np.ndarray:
    """2 * permutations values: minimum and maximum of the set under each function."""
    low = np.full(permutations, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(permutations, np.uint64)
    for at in range(0, len(shingles), CHUNK):
        seen = MULTIPLIERS[:permutations, None] * shingles[None, at : at + CHUNK] + SHIFTS[:permutations, None]
        np.minimum(low, seen.min(axis=1), out=low)
        np.maximum(high, seen.max(axis=1), out=high)
    return np.stack([low, high], axis=1).ravel()


def band_keys(signatures: np.ndarray, band_rows: int) -> np.ndarray:
    """One number per band of a signature matrix (documents x values)."""
    n, width = signatures.shape
    bands = width // band_rows
    shaped = signatures[:, : bands * band_rows].reshape(n, bands, band_rows)
    keys = np.broadcast_to(np.arange(bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), (n, bands)).copy()
    for j in range(band_rows):
        keys = mix(keys * np.uint64(0xC2B2AE3D27D4EB4F) + shaped[:, :, j])
    return keys


def _lists(values: np.ndarray, width: int) -> pa.Array:
    flat = pa.array(np.ascontiguousarray(values).view(np.int64).ravel())
    return pa.ListArray.from_arrays(pa.array(np.arange(0, len(values) * width + 1, width, dtype=np.int32)), flat)


def set_name(shingles: np.ndarray) -> bytes:
    """16 bytes that name a set of shingle numbers, whatever their order."""
    if len(shingles) == 0:
        return b""
    return np.array(
        [mix(shingles).sum(), mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum()], np.uint64
    ).tobytes()


def signatures(documents: DataFrame, shingle: int, permutations: int, band_rows: int) -> DataFrame:
    """(doc_id, n_shingles, node, bands): `node` names the set, empty for the empty set."""
    bands = 2 * permutations // band_rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, offsets = word_hashes(batch.column("text"))
            n = batch.num_rows
            sizes, names = np.zeros(n, np.int64), []
            signs = np.zeros((n, 2 * permutations), np.uint64)
            for i in range(n):
                found = np.unique(shingle_hashes(words[offsets[i] : offsets[i + 1]], shingle))
                sizes[i] = len(found)
                names.append(set_name(found))
                if len(found):
                    signs[i] = min_max(found, permutations)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes),
                    pa.array(names, pa.binary()),
                    _lists(band_keys(signs, band_rows), bands),
                ],
                names=["doc_id", "n_shingles", "node", "bands"],
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_shingles long, node binary, bands array<long>"
    )


def shingle_sets(documents: DataFrame, shingle: int) -> DataFrame:
    """(node, shingles): the sorted numbers of the distinct runs, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, offsets = word_hashes(batch.column("text"))
            for at in range(0, batch.num_rows, 500):
                rows = range(at, min(at + 500, batch.num_rows))
                sets = [np.unique(shingle_hashes(words[offsets[i] : offsets[i + 1]], shingle)) for i in rows]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([set_name(s) for s in sets], pa.binary()),
                        pa.array([s.tobytes() for s in sets], pa.binary()),
                    ],
                    names=["node", "shingles"],
                )

    return documents.select("text").mapInArrow(run, "node binary, shingles binary")


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have 100 * intersection >= percent * union."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) pairs that are linked by their full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("x"), batch.column("y")
            good = [
                linked(np.frombuffer(left[i].as_py(), np.uint64), np.frombuffer(right[i].as_py(), np.uint64), percent)
                for i in range(batch.num_rows)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    full = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b"
    )
    return full.select("a", "b", "x", "y").mapInArrow(run, "a binary, b binary")


def block_links(rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """A spanning forest of the links between members of different components in one cell.

    Intersections come from products of the members' incidence over shingles that at least
    two of them hold, a slice of shingles at a time.
    """
    sets = [np.frombuffer(s, np.uint64) for s in rows["shingles"]]
    m, sizes = len(sets), np.array([len(s) for s in sets], np.int64)
    values, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(m), sizes)
    shared = counts[inverse] > 1
    owner, inverse = owner[shared], np.cumsum(counts > 1)[inverse[shared]] - 1
    order = np.argsort(inverse, kind="stable")
    owner, inverse = owner[order], inverse[order]
    both, width = np.zeros((m, m), np.float64), 8192
    for lo in range(0, int(inverse[-1]) + 1 if len(inverse) else 0, width):
        s, e = np.searchsorted(inverse, [lo, lo + width])
        held = np.zeros((m, width), np.float32)
        held[owner[s:e], inverse[s:e] - lo] = 1
        both += held @ held.T
    union = sizes[:, None] + sizes[None, :] - both
    a, b = np.nonzero(np.triu(100 * both >= percent * union, 1))
    _, label = np.unique(rows["component"].to_numpy(), return_inverse=True)
    root = list(range(int(label.max()) + 1))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    kept = []
    for i, j in zip(a.tolist(), b.tolist(), strict=True):
        x, y = find(label[i]), find(label[j])
        if x != y:
            root[x] = y
            kept.append((i, j))
    nodes = rows["node"].to_numpy()
    return pd.DataFrame({"a": [nodes[i] for i, _ in kept], "b": [nodes[j] for _, j in kept]}, dtype=object)


def near_duplicates(
    documents: DataFrame,
    *,
    shingle: int = 5,
    percent: int = 75,
    permutations: int = 64,
    band_rows: int = 4,
    star_rounds: int = 2,
    block: int = 256,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of `documents`.

    `component_id` is the smallest doc_id that links reach; `kept` marks it. Texts that are
    null, empty or blank have no shingles and are linked with nothing. Rows that repeat a
    doc_id count as documents of their own and get the same id back. A row with a null
    doc_id is linked with nothing: its component is null and it is kept. Other columns are
    ignored, and an empty table gives an empty result.
    """
    spark = documents.sparkSession
    kind = documents.schema["doc_id"].dataType.simpleString()
    with batches_of(spark, 2000):
        signed = written(signatures(documents, shingle, permutations, band_rows), "minhash-signatures")
    usable = signed.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = written(
        usable.groupBy("node").agg(
            F.min("doc_id").alias("first_id"),
            F.count(F.lit(1)).alias("copies"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("bands").alias("bands"),
        ),
        "minhash-classes",
    )
    banded = classes.select("node", "n_shingles", "copies", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    members = written(banded.join(shared, "bucket").withColumn("component", F.col("node")), "minhash-members")
    wanted = members.select("node").distinct().join(classes.select("node", "first_id"), "node")
    texts = documents.join(wanted.select(F.col("first_id").alias("doc_id")), "doc_id", "left_semi")
    with batches_of(spark, 2000):
        sets = written(shingle_sets(texts, shingle), "minhash-sets")
        # A doc_id that stands for several texts brings sets that nobody asked for, or one twice.
        if sets.count() != wanted.count():
            sets = sets.join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"])

    labels = None
    for _ in range(star_rounds):
        if members.isEmpty():
            break
        # The set with most copies comes first: often the text that others were made from.
        best = F.max(F.struct("copies", F.xxhash64("node").alias("h"), "node", "component", "n_shingles"))
        pivots = written(members.groupBy("bucket").agg(best.alias("p")), "minhash-pivots")
        paired = members.join(pivots, "bucket").where("node <> p.node AND component <> p.component")
        paired = paired.where(
            100 * F.least("n_shingles", "p.n_shingles") >= percent * F.greatest("n_shingles", "p.n_shingles")
        )
        pairs = paired.select(F.least("node", "p.node").alias("a"), F.greatest("node", "p.node").alias("b")).distinct()
        with batches_of(spark, 500):
            found = written(confirm(pairs, sets, percent), "minhash-links")
        labels = joined_components(labels, found)
        members = _still_open(members, pivots, labels)
    if labels is not None and not members.isEmpty():
        labels = joined_components(labels, written(_blocks(members, sets, percent, block), "minhash-links"))
    same = signed.select("doc_id", "n_shingles", "node")
    if labels is None:
        roots = classes.select("node", F.col("first_id").alias("root"))
    else:
        labels = labels.join(classes.select("node", "first_id"), "node")
        smallest = labels.groupBy("component").agg(F.min("first_id").alias("smallest"))
        reached = labels.join(smallest, "component").select("node", "smallest")
        roots = classes.join(reached, "node", "left").select("node", F.coalesce("smallest", "first_id").alias("root"))
    joined = same.join(written(roots, "minhash-roots"), "node", "left")
    alone = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("root")).cast(kind)
    return joined.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def _still_open(members: DataFrame, pivots: DataFrame, labels: DataFrame) -> DataFrame:
    """Members with their new component, without pivots, in buckets of several components."""
    left = members.join(pivots.select("bucket", F.col("p.node").alias("pivot")), "bucket").where("node <> pivot")
    left = left.select("bucket", "node", "n_shingles", "copies").join(labels, "node", "left")
    left = left.withColumn("component", F.coalesce("component", "node"))
    left = written(left, "minhash-left")
    open_buckets = (
        left.groupBy("bucket")
        .agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
        .where("lo <> hi")
        .select("bucket")
    )
    return written(left.join(open_buckets, "bucket"), "minhash-members")


def _blocks(members: DataFrame, sets: DataFrame, percent: int, block: int) -> DataFrame:
    """Links of the open buckets, block against block; buckets of the same members count once."""
    shape = members.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("same"),
        F.sum(F.xxhash64(F.lit(1), "node").cast("decimal(38,0)")).alias("same2"),
    )
    once = shape.groupBy("n", "same", "same2").agg(F.min("bucket").alias("bucket")).select("bucket", "n")
    cells = members.join(once, "bucket").withColumn("blocks", F.ceil(F.col("n") / block))
    cells = cells.withColumn("own", F.pmod(F.xxhash64(F.lit(7), "node"), F.col("blocks")))
    cells = cells.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    cells = cells.select(
        "bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "component"
    )
    full = cells.join(sets, "node")
    return full.groupBy("bucket", "i", "j").applyInPandas(lambda rows: block_links(rows, percent), "a binary, b binary")
