"""Benchmark decontamination: BM25 retrieval of test items for every training passage.

The test items form an inverted index whose postings carry each term's full BM25 weight.
Items stand in blocks; a term also has the largest weight it has in each block. Every text
is cut into overlapping passages, each passage is a query, and the block maxima bound what
it can score: a passage whose bound over all blocks is too low is left at once, then blocks
whose bound is too low, and only what is left is scored item by item.

An item is retrieved at a threshold of its own that no passage below it can pass the check
that follows, so the index loses nothing. A retrieved item is verified on the passage: of
the distinct five-word runs of its question, and of those of its answer, at least `overlap`
must stand in the passage. The question of an item is its text up to the last sentence, the
answer is the last sentence; an item of one sentence has a question only. Words are runs of
ASCII letters and digits and of all characters beyond ASCII, A-Z lower-cased, so that
punctuation put onto a word does not hide it.

The index goes to the tasks as one object. It holds at most `items_at_once` items; more
items are taken in slices by id hash, each slice against all passages.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tributary.llm.common import batches_of, pieces, written
from tributary.llm.tokens import NOT_ALNUM, shingle_hashes, word_hashes

SENTENCE_END = re.compile(r"[.!?](?=[\x20\x09-\x0D]+[^\x20\x09-\x0D])")


def question_answer(text: str) -> tuple[str, str]:
    """The text up to its last sentence, and that sentence (empty if there is only one)."""
    ends = [m.end() for m in SENTENCE_END.finditer(text)]
    return (text[: ends[-1]], text[ends[-1] :]) if ends else (text, "")


@dataclass
class Index:
    ids: np.ndarray  # item ids, by position
    terms: np.ndarray  # sorted word numbers
    block: int
    weights: np.ndarray  # (blocks, terms, items of the block): postings of a block
    maxima: np.ndarray  # (terms, blocks) largest weight of the term in the block
    best: np.ndarray  # largest weight of the term
    thresholds: np.ndarray  # (blocks, items of the block)
    block_threshold: np.ndarray  # smallest threshold in the block
    grams: list[tuple[np.ndarray, np.ndarray]]  # distinct runs of question and answer
    widths: list[tuple[int, int]]  # words in a run of question and answer
    longest: int  # words of the longest item
    sieve: np.ndarray  # which low bits any term has


def _runs(words: np.ndarray, size: int) -> np.ndarray:
    return np.unique(shingle_hashes(words, size))


def build_index(
    ids: list, texts: list[str], size: int, overlap: float, block: int, k1: float = 1.2, b: float = 0.75
) -> Index | None:
    """Index of the items that have words."""
    pairs = [question_answer(t) for t in texts]
    parts = [word_hashes(pa.array([p[side] for p in pairs], pa.large_string()), breaks=NOT_ALNUM) for side in (0, 1)]
    kept, docs, grams = [], [], []
    for i in range(len(ids)):
        q, a = (w[o[i] : o[i + 1]] for w, o in parts)
        if len(q) == 0:
            q, a = a, q
        if len(q):
            kept.append(ids[i])
            docs.append((q, a))
            grams.append((_runs(q, size), _runs(a, size)))
    if not kept:
        return None
    every = [np.concatenate(d) for d in docs]
    terms, df = np.unique(np.concatenate([np.unique(d) for d in every]), return_counts=True)
    n, mean = len(kept), sum(map(len, every)) / len(kept)
    idf = np.log1p((n - df + 0.5) / (df + 0.5))
    postings, thresholds = [], np.zeros(n)
    for i, words in enumerate(every):
        t, tf = np.unique(words, return_counts=True)
        at = np.searchsorted(terms, t)
        w = idf[at] * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(words) / mean))
        postings.append((at, w))
        thresholds[i] = _threshold(docs[i], t, w, size, overlap)
    # Items of like thresholds share blocks, so that a low one does not keep others alive.
    order = sorted(range(n), key=lambda i: (thresholds[i], i))
    kept, docs, grams, every, postings = ([x[i] for i in order] for x in (kept, docs, grams, every, postings))
    blocks = -(-n // block)
    weights = np.zeros((blocks, len(terms), block), np.float32)
    for i, (at, w) in enumerate(postings):
        weights[i // block, at, i % block] = w * 1.00001  # rounded up, so that bounds and thresholds hold
    padded = np.full(blocks * block, np.inf)
    padded[:n] = thresholds[order]
    padded = padded.reshape(blocks, block)
    maxima = np.ascontiguousarray(weights.max(axis=2).T)
    sieve = np.zeros(1 << 20, bool)
    sieve[terms & np.uint64((1 << 20) - 1)] = True
    return Index(
        np.array(kept), terms, block, weights, maxima, maxima.max(axis=1), padded, padded.min(axis=1), grams,
        [(min(size, len(q)), min(size, len(a))) for q, a in docs], max(map(len, every)), sieve,
    )


def _threshold(parts: tuple[np.ndarray, np.ndarray], terms: np.ndarray, weights: np.ndarray, size: int, overlap: float) -> float:
    """A score that every passage reaches which holds enough runs of question and of answer.

    The weight of a term is dealt over its places in the item. A set of runs covers at least
    a `size`-th of the sum of its runs' weights, as a place lies in at most `size` runs. The
    lightest choice of enough runs bounds the score from below.
    """
    spread = weights / np.unique(np.concatenate(parts), return_counts=True)[1]
    total = 0.0
    for words in parts:
        if len(words) == 0:
            continue
        place = spread[np.searchsorted(terms, words)]
        width = min(size, len(words))
        sums = np.convolve(place, np.ones(width), "valid")
        numbers = shingle_hashes(words, size)
        # Equal runs count once for the overlap; take the lightest of them.
        order = np.lexsort((sums, numbers))
        first = np.ones(len(order), bool)
        first[1:] = numbers[order][1:] != numbers[order][:-1]
        light = np.sort(sums[order][first])
        total += light[: math.ceil(overlap * len(light))].sum() / width
    return total * 0.9999


def passages(index: Index, words: np.ndarray, offsets: np.ndarray, stride: int):
    """(row, passage number, start, end, terms): distinct index terms of every passage that has any."""
    hit = np.flatnonzero(index.sieve[words & np.uint64(len(index.sieve) - 1)])
    at = np.searchsorted(index.terms, words[hit])
    at[at == len(index.terms)] = 0
    good = index.terms[at] == words[hit]
    hit, at = hit[good], at[good]
    row = np.searchsorted(offsets, hit, "right") - 1
    part = (hit - offsets[row]) // stride
    # Passage j covers the words from j * stride to (j + 2) * stride, so a word lies in two.
    again = part > 0
    rows, parts = np.concatenate([row, row[again]]), np.concatenate([part, part[again] - 1])
    terms, wide = np.concatenate([at, at[again]]), int(part.max(initial=0)) + 1
    key = np.unique((rows * wide + parts) * len(index.terms) + terms)
    place, terms = key // len(index.terms), key % len(index.terms)
    starts = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1]))) if len(place) else place
    return place[starts] // wide, place[starts] % wide, starts, np.append(starts[1:], len(place)), terms


def search(index: Index, words: np.ndarray, offsets: np.ndarray, size: int, stride: int, overlap: float):
    """(row, passage, item position, score) of the verified items of a batch of texts."""
    row, part, starts, ends, terms = passages(index, words, offsets, stride)
    if len(starts) == 0:
        return
    alive = np.flatnonzero(np.add.reduceat(index.best[terms], starts) >= index.block_threshold.min())
    blocks = index.maxima.shape[1]
    for some in np.array_split(alive, max(1, int((ends - starts)[alive].sum()) * blocks // 4_000_000)):
        if len(some) == 0:
            continue
        own, first = _gathered(terms, starts[some], ends[some])
        live = np.add.reduceat(index.maxima[own], first, axis=0) >= index.block_threshold
        for b in np.flatnonzero(live.any(axis=0)):
            p = some[live[:, b]]
            own, first = _gathered(terms, starts[p], ends[p])
            scores = np.add.reduceat(index.weights[b][own], first, axis=0)
            for k, item in zip(*np.nonzero(scores >= index.thresholds[b]), strict=True):
                i, j = int(row[p[k]]), int(part[p[k]])
                lo = offsets[i] + j * stride
                if _verified(index, b * index.block + item, words[lo : min(lo + 2 * stride, offsets[i + 1])], overlap):
                    yield i, j, int(b * index.block + item), float(scores[k, item])


def _gathered(terms: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The terms of some passages in one array, and where each passage begins in it."""
    lengths = ends - starts
    first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    return terms[np.repeat(starts - first, lengths) + np.arange(lengths.sum())], first


def _verified(index: Index, item: int, text: np.ndarray, overlap: float) -> bool:
    """Whether the passage holds enough runs of the item's question and of its answer."""
    for grams, width in zip(index.grams[item], index.widths[item], strict=True):
        if len(grams) and len(np.intersect1d(grams, _runs(text, width), assume_unique=True)) < overlap * len(grams):
            return False
    return True


def contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    *,
    size: int = 5,
    overlap: float = 0.5,
    stride: int = 64,
    block: int = 8,
    items_at_once: int = 1000,
) -> DataFrame:
    """(doc_id, item_id, first_passage, n_passages, score): test items that documents hold.

    `documents` has doc_id and text, `benchmark` item_id and text. Passages have twice
    `stride` words, or twice the longest item if that is more, and start every half of that.
    Null, empty and blank texts hold nothing, and such items are never found. Repeated rows of
    a document or an item count once in the result. Other columns are ignored.
    """
    spark = documents.sparkSession
    doc_type = documents.schema["doc_id"].dataType.simpleString()
    item_type = benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {doc_type}, item_id {item_type}, passage long, score double"
    benchmark = benchmark.select("item_id", "text").where("text IS NOT NULL")
    counted = benchmark.agg(
        F.count(F.lit(1)).alias("n"), F.max(F.regexp_count("text", F.lit(r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"))).alias("longest")
    ).first()
    slices, stride = max(1, -(-counted.n // items_at_once)), max(stride, counted.longest or 0)
    found = None
    for number in range(slices):
        items = benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == number).collect()
        items.sort(key=lambda r: (str(r.item_id), r.text))
        index = build_index([r.item_id for r in items], [r.text for r in items], size, overlap, block)
        if index is None:
            continue
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in pieces(batches):
                words, offsets = word_hashes(batch.column("text"), breaks=NOT_ALNUM)
                hits = list(search(index, words, offsets, size, stride, overlap))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array([h[0] for h in hits], pa.int64())),
                        pa.array([index.ids[h[2]] for h in hits]).cast(id_type) if hits else pa.array([], id_type),
                        pa.array([h[1] for h in hits], pa.int64()),
                        pa.array([h[3] for h in hits], pa.float64()),
                    ],
                    names=["doc_id", "item_id", "passage", "score"],
                )

        id_type = to_arrow_type(benchmark.schema["item_id"].dataType)
        hits = documents.select("doc_id", "text").mapInArrow(run, schema)
        found = hits if found is None else found.union(hits)
    if found is None:
        found = spark.createDataFrame([], schema)
    with batches_of(spark, 2000):
        found = written(found, "contaminated")
    return found.groupBy("doc_id", "item_id").agg(
        F.min("passage").alias("first_passage"),
        F.count_distinct("passage").alias("n_passages"),
        F.max("score").alias("score"),
    )


BENCHMARK_SQL = r"""
    WITH low AS (
        SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS big, 'abcdefghijklmnopqrstuvwxyz' AS small
    ), i AS (
        SELECT DISTINCT item_id, translate(text, big, small) AS text FROM benchmark, low WHERE text IS NOT NULL
    ), cut AS (
        SELECT item_id, text,
            regexp_extract(text, '(?s)^(.*[.!?])[\x20\x09-\x0D]+[^\x20\x09-\x0D].*$', 1) AS head FROM i
    ), sides AS (
        SELECT item_id, 0 AS side, CASE WHEN head = '' THEN text ELSE head END AS part FROM cut
        UNION ALL SELECT item_id, 1, substr(text, length(head) + 1) FROM cut WHERE head <> ''
    ), side_words AS (
        SELECT item_id, side, regexp_extract_all(part, '[0-9A-Za-z\x{80}-\x{10FFFF}]+') AS w FROM sides
    ), grams AS (
        SELECT DISTINCT item_id, side, least(5, len(w)) AS width,
            array_to_string(list_slice(w, p, p + least(5, len(w)) - 1), ' ') AS gram
        FROM (SELECT item_id, side, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS p FROM side_words WHERE len(w) > 0)
    ), needed AS (SELECT item_id, side, count(*) AS n FROM grams GROUP BY item_id, side
    ), item_sides AS (SELECT item_id, count(*) AS n_sides FROM needed GROUP BY item_id
    ), stride AS (
        SELECT greatest(64, max(len(regexp_extract_all(text, '[0-9A-Za-z\x{80}-\x{10FFFF}]+')))) AS s FROM i
    ), d AS (
        SELECT doc_id, regexp_extract_all(translate(text, big, small), '[0-9A-Za-z\x{80}-\x{10FFFF}]+') AS w FROM documents, low
    ), doc_grams AS (
        SELECT doc_id, width, p - 1 AS p, array_to_string(list_slice(w, p, p + width - 1), ' ') AS gram
        FROM (
            SELECT doc_id, w, width, unnest(range(1, len(w) - width + 2)) AS p
            FROM d, (SELECT DISTINCT width FROM grams) WHERE len(w) >= width
        )
    ), matched AS (
        SELECT doc_id, p, g.width, item_id, side, g.gram FROM doc_grams JOIN grams g
        ON doc_grams.gram = g.gram AND doc_grams.width = g.width
    ), placed AS (
        SELECT doc_id, p // s AS passage, item_id, side, gram FROM matched, stride
        UNION ALL
        SELECT doc_id, p // s - 1, item_id, side, gram FROM matched, stride
        WHERE p >= s AND p + width <= (p // s + 1) * s
    ), enough AS (
        SELECT doc_id, passage, item_id, side FROM (
            SELECT doc_id, passage, item_id, side, count(DISTINCT gram) AS n FROM placed GROUP BY ALL
        ) held JOIN needed USING (item_id, side) WHERE held.n >= 0.5 * needed.n
    ), verified AS (
        SELECT doc_id, passage, item_id FROM enough JOIN item_sides USING (item_id)
        GROUP BY doc_id, passage, item_id, n_sides HAVING count(*) = n_sides
    )
    SELECT doc_id, item_id, min(passage) AS first_passage, count(*) AS n_passages FROM verified GROUP BY doc_id, item_id
"""
