"""Temperature mixing of sources, realised as budgeted block permutations.

The token shares of the sources are raised to one exponent between 0 (all sources alike)
and 1 (shares as they are). Bisection finds the smallest exponent that meets a target
entropy and a limit on how often a source is repeated. Each source then gets its part of
the token budget: whole epochs first, then a part of one more. An epoch deals the
documents of a source into blocks by a hash of seed, epoch and id; blocks follow each
other, and inside a block documents follow the hash. The part of an epoch ends at a cut,
a block and the last hash taken in it, so that taking a document or not is decided on its
own row. Windows only run over the blocks of a source and over one block of it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import written

HALVINGS = 30
AT_ONCE = 6


def n_tokens(text: str = "text") -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _digest(seed: int, epoch: Column, doc_id: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))))


def _block(digest: Column, blocks: int) -> Column:
    return (F.conv(F.substring(digest, 1, 6), 16, 10).cast("long") % blocks).cast("int")


def source_exponent(
    shares: DataFrame, budget: int, target_entropy: float | None, max_repeats: float | None
) -> float:
    """The smallest exponent in [0, 1] that meets both limits, 1 if none does.

    `shares` (source, tokens, share) stays distributed: a round evaluates the 63 exponents
    that six halvings can reach, in one aggregate, and brings 63 rows to the driver.
    """
    low, high, steps = 0.0, 1.0, 2**AT_ONCE
    for _ in range(HALVINGS // AT_ONCE):
        width = (high - low) / steps
        tried = shares.select("share", "tokens", F.explode(F.sequence(F.lit(1), F.lit(steps - 1))).alias("k"))
        tried = tried.withColumn("x", F.lit(low) + F.lit(width) * F.col("k")).withColumn("w", F.pow("share", "x"))
        found = (
            tried.groupBy("k")
            .agg(
                F.sum("w").alias("z"),
                F.sum(F.col("w") * F.col("x") * F.log2("share")).alias("wl"),
                F.max(F.col("w") / F.col("tokens")).alias("most"),
            )
            .collect()
        )
        good = []
        for row in found:
            entropy = math.log2(row.z) - row.wl / row.z
            fits = target_entropy is None or entropy <= target_entropy
            fits = fits and (max_repeats is None or budget * row.most / row.z <= max_repeats)
            if fits:
                good.append(row.k)
        first = min(good, default=steps)
        low, high = low + width * (first - 1), low + width * first
    return high


def mix(
    documents: DataFrame,
    *,
    flatten: float = 0.5,
    target_entropy: float | None = None,
    max_repeats: float | None = 4.0,
    budget: int | None = None,
    blocks: int = 4096,
    seed: int = 11,
) -> DataFrame:
    """`documents`, each once per epoch it is drawn in, with n_tokens, epoch, block, position.

    The target entropy in bits is given, or lies `flatten` of the way from the entropy of the
    shares to that of equal shares. `budget` counts tokens, by default those of the table.
    (epoch, block, position) orders the draws of a source. A source without tokens has no
    weight and is not drawn; a document without tokens is drawn with its block. Null sources
    are one source. Rows that repeat a doc_id follow each other and are drawn or cut
    together; a null doc_id counts as the empty text. Other columns are carried along;
    columns named like the four added ones are replaced.
    """
    added = ("n_tokens", "epoch", "block", "position")
    columns = [c for c in documents.columns if c not in added]
    docs = documents.select(*columns).withColumn("n_tokens", n_tokens())
    light = written(docs.select("doc_id", "source", "n_tokens"), "mixing-tokens")
    sums = light.groupBy("source").agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0")
    whole = sums.agg(F.sum("tokens").alias("total"), F.count(F.lit(1)).alias("sources")).first()
    if not whole.total:
        return docs.select("*", *[F.lit(None).cast(t).alias(c) for c, t in zip(added[1:], ("int", "int", "string"), strict=True)]).where("false")
    total, budget = int(whole.total), int(whole.total if budget is None else budget)
    shares = written(sums.withColumn("share", F.col("tokens") / F.lit(total)), "mixing-shares")
    if target_entropy is None:
        own = shares.agg(F.sum(-F.col("share") * F.log2("share")).alias("h")).first().h
        target_entropy = own + flatten * (math.log2(whole.sources) - own)
    exponent = source_exponent(shares, budget, target_entropy, max_repeats)
    z = shares.agg(F.sum(F.pow("share", F.lit(exponent))).alias("z")).first().z
    part = F.floor(F.lit(float(budget)) * F.pow("share", F.lit(exponent)) / F.lit(z) + F.lit(1e-6))
    plan = shares.withColumn("part", part).select(
        "source", F.expr("part DIV tokens").alias("epochs"), F.expr("part % tokens").alias("rest")
    )

    last = _join(light, plan).withColumn("position", _digest(seed, F.col("epochs"), "doc_id"))
    last = last.withColumn("block", _block(F.col("position"), blocks))
    per_block = last.groupBy("source", "block", "rest").agg(F.sum("n_tokens").alias("held"))
    before = F.sum("held").over(Window.partitionBy("source").orderBy("block"))
    summed = per_block.withColumn("upto", before)
    # The first block that does not fit as a whole; a part of it is taken.
    cut = summed.where("upto > rest").groupBy("source").agg(
        F.min(F.struct("block", (F.col("upto") - F.col("held")).alias("before"))).alias("c")
    )
    cut = cut.select(F.col("source"), F.col("c.block").alias("cut_block"), F.col("c.before").alias("before"))
    inside = _join(last, cut).where("block = cut_block")
    running = F.sum("n_tokens").over(Window.partitionBy("source").orderBy("position", "doc_id"))
    taken = inside.withColumn("upto", F.col("before") + running).where("upto <= rest")
    ends = taken.groupBy("source").agg(F.max("position").alias("cut_position"))
    plan = _join(_join(plan, cut, "left"), ends, "left")
    # Names that no column of the documents should have.
    names = ("epochs", "cut_block", "cut_position")
    plan = written(plan.select("source", *[F.col(c).alias(f"__{c}") for c in names]), "mixing-plan")

    drawn = _join(docs, plan).withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__epochs"))))
    drawn = drawn.withColumn("position", _digest(seed, F.col("epoch"), "doc_id"))
    drawn = drawn.withColumn("block", _block(F.col("position"), blocks))
    whole_epoch = F.col("epoch") < F.col("__epochs")
    in_part = (F.col("block") < F.col("__cut_block")) | (
        (F.col("block") == F.col("__cut_block")) & F.coalesce(F.col("position") <= F.col("__cut_position"), F.lit(False))
    )
    return drawn.where(whole_epoch | in_part).select(
        *columns, "n_tokens", F.col("epoch").cast("int").alias("epoch"), "block", "position"
    )


def _join(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join by source, where null equals null; columns of the right side follow."""
    renamed = right.withColumnRenamed("source", "__source")
    return left.join(renamed, F.col("source").eqNullSafe(F.col("__source")), how).drop("__source")


DOCUMENTS_SQL = r"""
    WITH RECURSIVE d AS (
        SELECT doc_id, source,
            CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS n_tokens
        FROM documents
    ), s AS (
        SELECT source, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM d GROUP BY source HAVING sum(n_tokens) > 0
    ), t AS (SELECT CAST(sum(tokens) AS BIGINT) AS total, count(*) AS sources FROM s
    ), p AS (SELECT source, tokens, tokens / total AS share FROM s, t
    ), g AS (
        SELECT h + 0.5 * (log2(sources) - h) AS target, total
        FROM t, (SELECT sum(-share * log2(share)) AS h FROM p)
    ), bisect(i, low, high) AS (
        SELECT 0, CAST(0 AS DOUBLE), CAST(1 AS DOUBLE)
        UNION ALL
        SELECT i + 1, CASE WHEN good THEN low ELSE (low + high) / 2 END, CASE WHEN good THEN (low + high) / 2 ELSE high END
        FROM (
            SELECT i, low, high,
                log2(sum(pow(share, (low + high) / 2)))
                    - sum(pow(share, (low + high) / 2) * ((low + high) / 2) * log2(share))
                        / sum(pow(share, (low + high) / 2)) <= max(target)
                AND max(total) * max(pow(share, (low + high) / 2) / tokens)
                    / sum(pow(share, (low + high) / 2)) <= 4.0 AS good
            FROM bisect, p, g WHERE i < 30 GROUP BY i, low, high
        )
    ), e AS (SELECT high AS x FROM bisect WHERE i = 30
    ), w AS (
        SELECT source, tokens,
            CAST(floor(total * pow(share, x) / (SELECT sum(pow(share, x)) FROM p, e) + 1e-6) AS BIGINT) AS part
        FROM p, e, t
    ), plan AS (SELECT source, part // tokens AS epochs, part % tokens AS rest FROM w
    ), last AS (
        SELECT d.doc_id, d.source, n_tokens, rest, md5('11:' || epochs || ':' || coalesce(CAST(doc_id AS VARCHAR), '')) AS position
        FROM d JOIN plan ON d.source IS NOT DISTINCT FROM plan.source
    ), lastb AS (SELECT *, CAST(('0x' || substr(position, 1, 6)) AS INT) % 4096 AS block FROM last
    ), blocks AS (
        SELECT source, block, rest, held, sum(held) OVER (PARTITION BY source ORDER BY block) AS upto
        FROM (SELECT source, block, rest, sum(n_tokens) AS held FROM lastb GROUP BY source, block, rest)
    ), cut AS (
        SELECT source, min(block) AS cut_block, arg_min(upto - held, block) AS before
        FROM blocks WHERE upto > rest GROUP BY source
    ), inside AS (
        SELECT l.source, position, before + sum(n_tokens) OVER (PARTITION BY l.source ORDER BY position, doc_id) AS upto, rest
        FROM lastb l JOIN cut ON l.source IS NOT DISTINCT FROM cut.source AND block = cut_block
    ), ends AS (SELECT source, max(position) AS cut_position FROM inside WHERE upto <= rest GROUP BY source
    ), full_plan AS (
        SELECT plan.source, epochs, cut_block, cut_position FROM plan
        LEFT JOIN cut ON plan.source IS NOT DISTINCT FROM cut.source
        LEFT JOIN ends ON plan.source IS NOT DISTINCT FROM ends.source
    ), drawn AS (
        SELECT doc_id, d.source, n_tokens, epochs, cut_block, cut_position, unnest(range(epochs + 1)) AS epoch
        FROM d JOIN full_plan f ON d.source IS NOT DISTINCT FROM f.source
    ), placed AS (
        SELECT *, md5('11:' || epoch || ':' || coalesce(CAST(doc_id AS VARCHAR), '')) AS position FROM drawn
    ), numbered AS (SELECT *, CAST(CAST(('0x' || substr(position, 1, 6)) AS INT) % 4096 AS INT) AS block FROM placed
    )
    SELECT doc_id, source, n_tokens, CAST(epoch AS INT) AS epoch, block, position FROM numbered
    WHERE epoch < epochs OR block < cut_block OR (block = cut_block AND coalesce(position <= cut_position, false))
"""
