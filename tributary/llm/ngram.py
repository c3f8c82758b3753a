"""A word bigram model by deleted interpolation, and the scores of all texts under it.

The probability of a token mixes three maximum-likelihood estimates: of the token after its
context word, of the token alone, and an equal share for every known token and one unknown.
The weights depend on how often the context was seen, in buckets of powers of two. They are
learned by expectation-maximisation on deleted counts: every training token is held out from
the counts once, so that it is predicted from what is left.

Counting moves little. Texts are packed into chunks of a few megabytes. A chunk asks once for
each of its distinct words and word pairs, as sorted 64-bit numbers in one parcel per range of
numbers, together with its own training counts. A range adds up the counts of all chunks and
answers every parcel in order; the chunk then lays the counts beside its tokens. A number
stands in a chunk's parcels once, however frequent it is, so no range is hot. Everything is
kept for all texts; no count is cut.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tributary.llm.common import batches_of, fold, release, written
from tributary.llm.tokens import buffers, mix, word_hashes

CHUNK_BYTES = 8 << 20
END, BEGIN = np.uint64(0x1F83D9ABFB41BD6B), np.uint64(0x5BE0CD19137E2179)
BUCKETS = 48
STEP = 8  # cells of the held-out histogram per factor e


def squeeze(values: np.ndarray) -> bytes:
    """Unsigned numbers as compressed byte planes; the width is the least that holds them."""
    values = values.astype(np.uint64)
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()
    return struct.pack("<BQ", width, len(values)) + pa.compress(planes, codec="zstd", asbytes=True)


def expand(packed: bytes) -> np.ndarray:
    width, n = struct.unpack_from("<BQ", packed)
    planes = pa.decompress(packed[9:], decompressed_size=width * n, codec="zstd", asbytes=True)
    values = np.zeros((n, 8), np.uint8)
    values[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, n).T
    return values.view(np.uint64).ravel()


def squeeze_sorted(values: np.ndarray) -> bytes:
    return squeeze(np.diff(values, prepend=np.uint64(0)))


def expand_sorted(packed: bytes) -> np.ndarray:
    return np.cumsum(expand(packed), dtype=np.uint64)


def _chunks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about CHUNK_BYTES of text."""
    _, offsets = buffers(batch.column("text"))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def pack_texts(documents: DataFrame) -> DataFrame:
    """(chunk, doc_id, train, lengths, vocabulary, tokens): texts as chunks of word numbers.

    `documents` has doc_id, train and text.
    """
    id_type = to_arrow_type(documents.schema["doc_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _chunks(batch):
                words, offsets = word_hashes(part.column("text"))
                vocabulary, tokens = np.unique(words, return_inverse=True)
                row = {
                    "chunk": uuid.uuid4().bytes,
                    "doc_id": part.column("doc_id").to_pylist(),
                    "train": squeeze(part.column("train").to_numpy(zero_copy_only=False)),
                    "lengths": squeeze(np.diff(offsets)),
                    "vocabulary": squeeze_sorted(vocabulary),
                    "tokens": squeeze(tokens),
                }
                types = {"chunk": pa.binary(), "doc_id": pa.list_(id_type)}
                yield pa.RecordBatch.from_arrays([pa.array([v], types.get(k, pa.binary())) for k, v in row.items()], names=list(row))

    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"chunk binary, doc_id array<{kind}>, train binary, lengths binary, vocabulary binary, tokens binary"
    return documents.select("doc_id", "train", "text").mapInArrow(run, schema)


def stream(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(token, context, train, document bounds) of a chunk: words and one end per text."""
    lengths = expand(row["lengths"]).astype(np.int64)
    vocabulary = expand_sorted(row["vocabulary"])
    words = vocabulary[expand(row["tokens"]).astype(np.int64)]
    bounds = np.concatenate(([0], np.cumsum(lengths + 1)))
    token = np.empty(int(bounds[-1]), np.uint64)
    is_end = np.zeros(len(token), bool)
    is_end[bounds[1:] - 1] = True
    token[is_end], token[~is_end] = END, words
    context = np.empty_like(token)
    context[1:] = token[:-1]
    context[bounds[:-1]] = BEGIN
    return token, context, np.repeat(expand(row["train"]).astype(bool), lengths + 1), bounds


def single_keys(token: np.ndarray) -> np.ndarray:
    return mix(token ^ np.uint64(0x6A09E667F3BCC909))


def pair_keys(context: np.ndarray, token: np.ndarray) -> np.ndarray:
    return mix(mix(context) * np.uint64(0xC2B2AE3D27D4EB4F) + token)


def _by_range(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where each of 2**bits equal ranges begins in sorted keys, and the end."""
    firsts = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(1, np.uint64)
    return np.append(np.searchsorted(keys, firsts, "left"), len(keys))


def requests(packed: DataFrame, bits: int) -> DataFrame:
    """(part, chunk, keys and training counts of singles and pairs): what the chunks ask for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                token, context, train, _ = stream(row)
                columns: dict[str, list] = {}
                for name, numbers in (("single", single_keys(token)), ("pair", pair_keys(context, token))):
                    keys, inverse = np.unique(numbers, return_inverse=True)
                    counts = np.bincount(inverse[train], minlength=len(keys))
                    cuts = _by_range(keys, bits)
                    columns[name] = [squeeze_sorted(keys[s:e]) for s, e in zip(cuts[:-1], cuts[1:], strict=True)]
                    columns[f"{name}_n"] = [squeeze(counts[s:e]) for s, e in zip(cuts[:-1], cuts[1:], strict=True)]
                parts = 1 << bits
                arrays = {"part": pa.array(range(parts), pa.int32()), "chunk": pa.array([row["chunk"]] * parts, pa.binary())}
                arrays |= {k: pa.array(v, pa.binary()) for k, v in columns.items()}
                yield pa.RecordBatch.from_arrays(list(arrays.values()), names=list(arrays))

    schema = "part int, chunk binary, single binary, single_n binary, pair binary, pair_n binary"
    return packed.select("chunk", "train", "lengths", "vocabulary", "tokens").mapInArrow(run, schema)


def _totals(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return every, np.bincount(inverse, weights=np.concatenate(counts), minlength=len(every)).astype(np.int64)


def answers(asked: DataFrame) -> DataFrame:
    """(part, chunk, single, pair, n_tokens, n_distinct): counts in the order of the keys asked for.

    One row per part has no chunk and the part's training tokens and distinct training tokens.
    """

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        out = {"part": [], "chunk": [], "single": [], "pair": [], "n_tokens": [], "n_distinct": []}
        totals = (0, 0)
        answered: dict[str, list[bytes]] = {}
        for name in ("single", "pair"):
            keys = [expand_sorted(r[name]) for r in rows]
            every, total = _totals(keys, [expand(r[f"{name}_n"]).astype(np.float64) for r in rows])
            answered[name] = [squeeze(total[np.searchsorted(every, k)]) for k in keys]
            if name == "single":
                totals = (int(total.sum()), int((total > 0).sum()))
        out["part"] = [r["part"] for r in rows] + [rows[0]["part"]]
        out["chunk"] = [r["chunk"] for r in rows] + [None]
        out["single"], out["pair"] = answered["single"] + [None], answered["pair"] + [None]
        out["n_tokens"], out["n_distinct"] = [0] * len(rows) + [totals[0]], [0] * len(rows) + [totals[1]]
        types = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
        return pa.table([pa.array(v, t) for v, t in zip(out.values(), types, strict=True)], names=list(out))

    return asked.groupBy("part").applyInArrow(
        run, "part int, chunk binary, single binary, pair binary, n_tokens long, n_distinct long"
    )


def counted(packed: DataFrame, answered: DataFrame) -> DataFrame:
    """(doc_id, train, lengths, singles, pairs): each chunk with the counts beside its tokens."""
    id_type = to_arrow_type(packed.schema["doc_id"].dataType)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row, parts = left.to_pylist()[0], sorted(right.to_pylist(), key=lambda r: r["part"])
        token, context, _, _ = stream(row)
        counts = []
        for name, numbers in (("single", single_keys(token)), ("pair", pair_keys(context, token))):
            _, inverse = np.unique(numbers, return_inverse=True)
            counts.append(squeeze(np.concatenate([expand(p[name]) for p in parts])[inverse]))
        values = {
            "doc_id": pa.array([row["doc_id"]], id_type),
            "train": pa.array([row["train"]], pa.binary()),
            "lengths": pa.array([row["lengths"]], pa.binary()),
            "singles": pa.array([counts[0]], pa.binary()),
            "pairs": pa.array([counts[1]], pa.binary()),
        }
        return pa.table(list(values.values()), names=list(values))

    kind = packed.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, train binary, lengths binary, singles binary, pairs binary"
    answered = answered.where("chunk IS NOT NULL").select("part", "chunk", "single", "pair")
    return packed.groupBy("chunk").cogroup(answered.groupBy("chunk")).applyInArrow(run, schema)


def _beside(row: dict, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(token count, pair count, context count, train, bounds); the count of a text's begin is the number of training texts."""
    lengths = expand(row["lengths"]).astype(np.int64) + 1
    bounds = np.concatenate(([0], np.cumsum(lengths)))
    single, pair = expand(row["singles"]).astype(np.float64), expand(row["pairs"]).astype(np.float64)
    context = np.empty_like(single)
    context[1:] = single[:-1]
    context[bounds[:-1]] = texts
    return single, pair, context, np.repeat(expand(row["train"]).astype(bool), lengths), bounds


def bucket_of(context: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else one more than the power of two in its count."""
    return np.where(context > 0, 1 + np.floor(np.log2(np.maximum(context, 1))), 0).astype(np.int64)


def _cell(p: np.ndarray) -> np.ndarray:
    """Cell of a probability on a logarithmic scale, 0 for none."""
    return np.where(p > 0, 1 + np.round(-np.log(np.maximum(p, 1e-300)) * STEP), 0).astype(np.int64)


def deleted_histogram(chunks: DataFrame, n_tokens: int, texts: int) -> DataFrame:
    """(bucket, pair_cell, single_cell, n): the training tokens, each held out from the counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                single, pair, context, train, _ = _beside(row, texts)
                single, pair, context = single[train] - 1, pair[train] - 1, context[train] - 1
                by_pair = _cell(np.where(context > 0, pair / np.maximum(context, 1), 0))
                alone = _cell(single / max(1, n_tokens - 1))
                keys, n = np.unique((bucket_of(context) * 4096 + by_pair) * 4096 + alone, return_counts=True)
                columns = [keys // 4096**2, keys // 4096 % 4096, keys % 4096, n]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["bucket", "pair_cell", "single_cell", "n"])

    found = chunks.mapInArrow(run, "bucket long, pair_cell long, single_cell long, n long")
    return found.groupBy("bucket", "pair_cell", "single_cell").agg(F.sum("n").alias("n"))


def mixture_weights(cells: list, n_distinct: int, rounds: int = 60) -> np.ndarray:
    """(BUCKETS, 3) weights of pair, single and equal share, by expectation-maximisation."""
    if not cells:  # nothing was learned
        return np.tile([0.0, 0.0, 1.0], (BUCKETS, 1))
    weights = np.tile([0.0, 0.5, 0.5], (BUCKETS, 1))
    rows = np.array([(r.bucket, r.pair_cell, r.single_cell, r.n) for r in cells], np.float64).reshape(-1, 4)
    value = lambda c: np.where(c > 0, np.exp(-(c - 1) / STEP), 0.0)
    for b in np.unique(rows[:, 0]).astype(int):
        own = rows[rows[:, 0] == b]
        p = np.stack([value(own[:, 1]), value(own[:, 2]), np.full(len(own), 1 / (n_distinct + 1))], axis=1)
        w = np.array([1 / 3, 1 / 3, 1 / 3]) if b else np.array([0.0, 0.5, 0.5])
        for _ in range(rounds):
            share = p * w
            share *= (own[:, 3] / share.sum(axis=1))[:, None]
            w = share.sum(axis=0) / own[:, 3].sum()
        w = np.maximum(w, 1e-6 * np.array([b > 0, 1, 1]))  # no event of the future is impossible
        weights[b] = w / w.sum()
    seen = sorted(set(rows[:, 0].astype(int)) - {0})
    for b in range(1, BUCKETS):  # a bucket that training never reached takes the nearest one that it did
        if seen and b not in seen:
            weights[b] = weights[min(seen, key=lambda s: abs(s - b))]
    return weights


def scores(chunks: DataFrame, weights: np.ndarray, n_tokens: int, n_distinct: int, texts: int, kind: str) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of every text."""
    id_type = to_arrow_type(chunks.schema["doc_id"].dataType).value_type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                single, pair, context, _, bounds = _beside(row, texts)
                w = weights[np.minimum(bucket_of(context), BUCKETS - 1)]
                p = w[:, 0] * pair / np.maximum(context, 1) + w[:, 1] * single / max(1, n_tokens) + w[:, 2] / (n_distinct + 1)
                base = np.log10((single + 0.5) / (n_tokens + 0.5 * (n_distinct + 1)))
                sums = [np.add.reduceat(x, bounds[:-1]) for x in ((single > 0).astype(np.int64), base, np.log10(p))]
                columns = [pa.array(row["doc_id"], id_type), pa.array(np.diff(bounds)), *map(pa.array, sums)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    schema = f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double"
    return chunks.mapInArrow(run, schema)


def language_model_scores(documents: DataFrame, *, held_out: int = 1, parts: int | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row.

    Rows whose crc32 fold of the id is `held_out` are not learned from. Null, empty and blank
    texts have the end as their only token. A null doc_id counts as the empty text for the
    fold. Repeated rows are texts of their own and count again. Without training texts all
    scores are 0. Other columns are ignored. `parts` is the number of ranges that counts are
    kept in, by default four for each shuffle partition of the session, at least 32.
    """
    spark = documents.sparkSession
    kind = documents.schema["doc_id"].dataType.simpleString()
    texts = documents.select("doc_id", (fold("doc_id") != held_out).alias("train"), "text")
    packed = written(pack_texts(texts), "ngram-packed")
    parts = parts or max(32, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    with batches_of(spark, 1):
        answered = written(answers(requests(packed, parts.bit_length() - 1)), "ngram-answers")
        release(spark)
        chunks = written(counted(packed, answered), "ngram-counted")
        release(spark)
    whole = answered.where("chunk IS NULL").agg(F.sum("n_tokens").alias("n"), F.sum("n_distinct").alias("v")).first()
    n_tokens, n_distinct = int(whole.n or 0), int(whole.v or 0)
    training = texts.where("train").count()
    with batches_of(spark, 1):
        cells = deleted_histogram(chunks, n_tokens, training).collect()
        release(spark)
    weights = mixture_weights(cells, n_distinct)
    found = scores(chunks, weights, n_tokens, n_distinct, training, kind)
    return found.select(
        "doc_id",
        (fold("doc_id") == held_out).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(n_tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
