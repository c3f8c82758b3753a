"""A dataset manifest as a hash tree, and proofs by a recursive query that climbs it.

Every row is a leaf. The leaves of a source, in order, are hashed `FANOUT` at a time until one
node remains; what remains of the sources is hashed likewise to one root. A built level is stored
as rows that name their parent, and a Spark recursive query goes from the leaves to the root along
these links: each step takes the siblings of the node it is at and folds the claimed hash with them.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm.common import written
from tributary.llm.places import with_places

FANOUT = 16
NODE = {"tree": "STRING", "level": "INT", "place": "BIGINT", "children": "BINARY", "width": "BIGINT"}
TOP = ""  # the tree over the sources; those of sources are ":" and the source, "-" without one


def hashed(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def as_text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def field(value: Column) -> Column:
    """A value with its length in bytes before it, `-` for null; fields laid end to end can be told apart."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: list[Column]) -> Column:
    return hashed(F.concat(*[field(v) for v in values]))


@dataclass(frozen=True)
class Manifest:
    """`leaves`: key, claim, parent and slot; `nodes`: (tree, level, place), the digests below it, its parent and slot."""

    leaves: DataFrame
    nodes: DataFrame
    root: str | None
    groups: int = 0


def build(docs: DataFrame, fields: list[str], key: str, group: str, claimed: dict[str, Column] | None = None) -> Manifest:
    """The manifest of a table. `claimed` replaces fields to give each row the leaf it claims to have.

    Leaves of a group go by `key`, nulls first; rows of the same key go by their hash, and equal rows are
    equal leaves. A null group is a group, before all others. An empty table has no root.
    """
    spark = docs.sparkSession
    claimed = claimed or {}
    digest = leaf([F.col(f) for f in fields])
    claim = leaf([claimed.get(f, F.col(f)) for f in fields])
    tree = F.coalesce(F.concat(F.lit(":"), F.col(group).cast("string")), F.lit("-"))
    hashes = docs.select(F.col(key).alias("key"), tree.alias("tree"), digest.alias("digest"), claim.alias("claim"))
    hashes = written(hashes.withColumn("__n", F.monotonically_increasing_id()), "merkle-hashes")
    order = [F.col("key").asc_nulls_first(), F.col("digest").asc()]
    leaves = written(with_places(hashes, ["tree"], order, "merkle-order"), "merkle-leaves")

    level = leaves.select("tree", "place", "digest")
    sizes = written(level.groupBy("tree").agg(F.count(F.lit(1)).alias("size")), "merkle-sizes")
    below, tops = _tree(level, sizes)
    subroots = tops.withColumn("__n", F.lit(0))
    sources = written(with_places(subroots, [], [F.col("tree").asc()], "merkle-sources"), "merkle-subroots")
    count = sources.count()
    if not count:
        return Manifest(_parents(leaves, sources, sizes, 0), _parents(below, sources, sizes, 0), None, 0)
    above, last = _tree(
        sources.select(F.lit(TOP).alias("tree"), "place", "digest"),
        spark.range(1).select(F.lit(TOP).alias("tree"), F.lit(count).cast("bigint").alias("size")),
    )
    root = bytes(last.first().digest).hex()
    nodes = _parents(below, sources, sizes, count).unionByName(_parents(above, sources.limit(0), sizes.limit(0), count, TOP))
    return Manifest(_parents(leaves, sources, sizes, count), written(nodes, "merkle-nodes"), root, count)


def _tree(leaves: DataFrame, sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes above the leaves, what remains of each tree), level by level; a level is a sixteenth of the one below."""
    spark = leaves.sparkSession
    largest = sizes.agg(F.max("size")).first()[0] or 0
    built: list[DataFrame] = []
    level = 0
    single = sizes.where("size = 1").select("tree")
    tops = [leaves.join(single, "tree", "left_semi").select("tree", "digest")]
    grown = leaves.join(sizes.where("size > 1"), "tree").withColumn("width", F.col("size"))
    while largest > 1:
        level, largest = level + 1, -(-largest // FANOUT)
        texts = F.sort_array(F.collect_list(F.struct("place", as_text(F.col("digest")).alias("digest"))))
        runs = grown.groupBy("tree", F.floor(F.col("place") / FANOUT).alias("place")).agg(
            F.max("width").alias("width"), F.array_join(F.transform(texts, lambda c: c["digest"]), "").alias("texts")
        )
        current = written(
            runs.select(
                "tree", F.lit(level).alias("level"), "place", F.unhex("texts").alias("children"),
                hashed(F.col("texts")).alias("digest"), F.ceil(F.col("width") / FANOUT).cast("bigint").alias("width"),
            ),
            "merkle-level",
        )
        built.append(current)
        tops.append(current.where("width = 1").select("tree", "digest"))
        grown = current.where("width > 1").select("tree", "place", "digest", "width")
    nodes = spark.sql(f"SELECT {', '.join(f'CAST(NULL AS {t}) AS {c}' for c, t in NODE.items())} WHERE false")
    for frame in built:
        nodes = nodes.unionByName(frame.drop("digest"))
    remains = tops[0]
    for frame in tops[1:]:
        remains = remains.unionByName(frame)
    return nodes, remains


def _parents(rows: DataFrame, sources: DataFrame, sizes: DataFrame, trees: int, tree: str | None = None) -> DataFrame:
    """Rows with (up_tree, up_level, up_place, slot): where they hang. The root, and it alone, hangs nowhere."""
    if "level" not in rows.columns:
        rows = rows.join(sizes, "tree").withColumnRenamed("size", "width").withColumn("level", F.lit(0))
    if tree is None:
        ranks = sources.select("tree", F.col("place").alias("rank"))
        rows = rows.join(ranks, "tree")
    else:
        rows = rows.withColumn("rank", F.lit(None).cast("bigint"))
    inner = F.col("width") > 1
    outer = ~inner & F.col("rank").isNotNull() & F.lit(trees > 1)
    at = F.when(inner, F.col("place")).when(outer, F.col("rank"))
    return rows.withColumns(
        {
            "up_tree": F.when(inner, F.col("tree")).when(outer, F.lit(TOP)),
            "up_level": F.when(inner, F.col("level") + 1).when(outer, F.lit(1)),
            "up_place": F.floor(at / FANOUT),
            "slot": (at % FANOUT).cast("int"),
        }
    ).drop("width", "rank")


# One row holds the leaves below one first node: from there on they share every sibling, but each
# folds a hash of its own. `tree`, `level`, `place` name the node to go to next.
CLIMB = """
WITH RECURSIVE climb(tree, level, place, claims, first, above, subroot) AS (
  SELECT tree, level, place, claims, CAST(NULL AS BINARY), CAST('' AS BINARY), CAST(NULL AS BINARY)
  FROM {anchors}
  UNION ALL
  SELECT
    n.up_tree, n.up_level, n.up_place,
    transform(c.claims, k -> struct(
      k.key AS key, n.slot AS slot, k.first_slot AS first_slot,
      unhex(sha2(lower(hex(concat(
        substring(n.children, 1, 32 * k.slot), k.fold, substring(n.children, 32 * k.slot + 33)
      ))), 256)) AS fold
    )),
    coalesce(c.first, n.children),
    CASE WHEN c.first IS NULL THEN c.above ELSE concat(
      c.above, substring(n.children, 1, 32 * c.claims[0].slot), substring(n.children, 32 * c.claims[0].slot + 33)
    ) END,
    CASE WHEN n.tree = '' AND n.level = 1 AND c.first IS NOT NULL
      THEN substring(n.children, 32 * c.claims[0].slot + 1, 32) ELSE c.subroot END
  FROM climb c JOIN {nodes} n ON c.tree = n.tree AND c.level = n.level AND c.place = n.place
)
SELECT * FROM climb WHERE tree IS NULL
"""


@contextlib.contextmanager
def _unlimited(spark: SparkSession) -> Iterator[None]:
    """Recursive queries of any number of rows; by default Spark ends them at a million."""
    name = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, -1)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def verify(manifest: Manifest) -> DataFrame:
    """Per leaf: key, leaf, subroot, root, proof_sha256, folded_root, verified; digests as hex text.

    `folded_root` is what the claimed leaf gives with the siblings of the manifest, `proof_sha256` the hash of
    these siblings, lowest level first, each level left to right.
    """
    spark = manifest.leaves.sparkSession
    claim = F.struct("key", "slot", F.col("slot").alias("first_slot"), F.col("claim").alias("fold"))
    runs = manifest.leaves.groupBy("up_tree", "up_level", "up_place").agg(F.collect_list(claim).alias("claims"))
    anchors = written(
        runs.select(F.col("up_tree").alias("tree"), F.col("up_level").alias("level"), F.col("up_place").alias("place"), "claims"),
        "merkle-anchors",
    )
    with _unlimited(spark):
        climbed = written(spark.sql(CLIMB, anchors=anchors, nodes=manifest.nodes), "merkle-climbed")
    each = climbed.select(F.explode("claims").alias("c"), "first", "above", "subroot")
    root = F.unhex(F.lit(manifest.root))
    own = F.expr("substring(first, 32 * c.first_slot + 1, 32)")
    others = F.expr("concat(substring(first, 1, 32 * c.first_slot), substring(first, 32 * c.first_slot + 33))")
    siblings = F.concat(F.coalesce(others, F.lit(b"")), F.col("above"))
    original = F.coalesce(own, root)  # without a parent the leaf is the root
    if manifest.groups == 1:
        subroot = root
    else:
        subroot = F.coalesce("subroot", original)  # a leaf that is alone in its group
    return each.select(
        F.col("c.key").alias("key"),
        as_text(original).alias("leaf"),
        as_text(subroot).alias("subroot"),
        F.lit(manifest.root).alias("root"),
        F.sha2(as_text(siblings), 256).alias("proof_sha256"),
        as_text(F.col("c.fold")).alias("folded_root"),
        (F.col("c.fold") == root).alias("verified"),
    )
