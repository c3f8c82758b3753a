"""Toxicity by nearest labelled examples under exact TF-IDF cosine.

A bounded sample of labelled documents is the index. A document is read in passages of `passage` words, as a few
words among hundreds make a document toxic and would hardly move the cosine of its whole text. A passage
is the TF-IDF vector of its words; words that no example has count in its length, and words that more than
`max_share` of the examples hold are stop words. Its neighbours are the `k` examples of the largest cosine,
ties by smaller id.

Postings stand in blocks of BLOCK examples with the largest weight of the term in the block. Examples of one
language and of like length share blocks, so that a term has few; no result depends on that order. A passage's
terms give every block an upper bound, and the k-th best posting of its best term a score that k examples
reach; only blocks whose bound reaches it are scored, and of these only what reaches the k-th best block is
ranked. So the neighbours are exact.

The neighbours of a passage vote with their cosine relative to the nearest, together with SMOOTH votes of the
usual mix, and the votes of a document's passages (the largest, the means of the three largest, of the
largest eighth and of all, and their number) become a probability by a logistic fit on the examples, each read
without itself. Scoring is one pass without a shuffle. The neighbours of the strongest passage are the evidence.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import fold, pieces
from tributary.llm.labelled import labelled_sample
from tributary.llm.tokens import NOT_ALNUM, word_hashes

BLOCK = 64
SMOOTH = 2.0
AT_ONCE = 256  # passages, so that their scores stay in the cache
SIM_BITS = 40  # of a cosine in units of 1e-12
NO_WORD = np.uint64(0xFFFFFFFFFFFFFFFF)


def word_counts(words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(offsets by text, word, count) of the distinct words of each text."""
    found = [np.unique(words[s:e], return_counts=True) for s, e in zip(offsets[:-1], offsets[1:], strict=True)]
    cuts = np.concatenate(([0], np.cumsum([len(w) for w, _ in found]))).astype(np.int64)
    word = np.concatenate([w for w, _ in found]) if found else np.zeros(0, np.uint64)
    return cuts, word, np.concatenate([c for _, c in found]) if found else np.zeros(0, np.int64)


def passages(words: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text of each passage; passage, word, count of its distinct words); a text without words is one empty passage."""
    sizes = np.diff(offsets)
    parts = np.maximum(1, -(-sizes // size))
    text = np.repeat(np.arange(len(sizes)), parts)
    first = np.repeat(np.cumsum(parts) - parts, sizes)
    inside = np.arange(len(words)) - np.repeat(offsets[:-1], sizes)
    grid = np.full((len(text), size), NO_WORD, np.uint64)
    grid[first + inside // size, inside % size] = words
    grid.sort(axis=1)
    fresh = grid != NO_WORD
    fresh[:, 1:] &= grid[:, 1:] != grid[:, :-1]
    passage, column = np.nonzero(fresh)
    word = grid[passage, column]
    return text, passage, word, (grid[passage] == word[:, None]).sum(axis=1)


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers from each of `first` on, as many as `size` says."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + size, size)


def _set(marks: np.ndarray) -> np.ndarray:
    """The places of the set marks, which are few; the array's size is a multiple of 8, and 8 are looked at at once."""
    eights = np.flatnonzero(marks.reshape(-1).view(np.uint64) != 0)
    found = np.flatnonzero(marks.reshape(-1, 8)[eights])
    return eights[found >> 3] * 8 + (found & 7)


def _heads(query: np.ndarray) -> np.ndarray:
    """Where each number of an ascending array begins."""
    return np.flatnonzero(np.concatenate(([True], query[1:] != query[:-1]))) if len(query) else np.zeros(0, np.int64)


@dataclass
class Index:
    terms: np.ndarray  # sorted word numbers
    idf: np.ndarray  # 0 for stop words
    ids: np.ndarray  # example ids, ascending
    labels: np.ndarray
    order: np.ndarray  # the examples as they stand in the blocks
    starts: np.ndarray  # of each term: its blocks
    block: np.ndarray
    most: np.ndarray  # largest weight of the term in the block
    at: np.ndarray  # of each block of a term, and one more: its postings
    slots: np.ndarray  # of each posting: its example's place in the block
    values: np.ndarray
    reached: np.ndarray  # of each term: the weight that k + 1 examples reach, or 0
    share: float  # of toxic examples
    k: int
    passage: int
    fit: np.ndarray | None = None

    def weights(self, terms: np.ndarray, counts: np.ndarray, unknown: np.ndarray | tuple = ()) -> np.ndarray:
        """Weights of the terms in a unit vector; `unknown` has the counts of words in no example."""
        w = (1 + np.log(counts)) * self.idf[terms]
        rest = (1 + np.log(np.asarray(unknown, float))) * self.unknown
        return w / max(math.sqrt(w @ w + rest @ rest), 1e-300)

    @property
    def unknown(self) -> float:
        return math.log(1 + len(self.ids)) + 1

    def nearest(self, terms: np.ndarray, weights: np.ndarray, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """(positions, cosines) of the k nearest examples with a positive cosine."""
        _, item, sim = self.search(np.zeros(len(terms), np.int64), terms, weights, np.array([without]))
        return item, sim

    def search(self, query: np.ndarray, terms: np.ndarray, weights: np.ndarray, without: np.ndarray):
        """(query, position, cosine) of the k nearest examples of each query, by query and then nearest first.

        `query` ascends; `without` has for each query an example that does not count, or -1. Queries times
        examples are below 2**22, as a query, a cosine and an example are sorted as one number.
        """
        blocks = -(-len(self.ids) // BLOCK)
        used = np.flatnonzero(weights > 0)
        query, terms, weights = query[used], terms[used], weights[used]
        if not len(query):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        least = np.zeros(len(without))
        heads = _heads(query)
        least[query[heads]] = np.maximum.reduceat(weights * self.reached[terms], heads)
        least = np.maximum(least - 1e-9, 1e-13)
        size = self.starts[terms + 1] - self.starts[terms]
        entry = _ranges(self.starts[terms], size)
        weight = np.repeat(weights, size)
        cell = np.repeat(query * blocks, size) + self.block[entry]
        bound = np.bincount(cell, self.most[entry] * weight, len(without) * blocks)
        keep = (bound.reshape(-1, blocks) >= least[:, None]).ravel()
        cells = np.flatnonzero(keep)
        row = np.zeros(len(keep), np.int64)
        row[cells] = np.arange(len(cells))
        kept = np.flatnonzero(keep[cell])
        entry, weight, row = entry[kept], weight[kept], row[cell[kept]]
        size = self.at[entry + 1] - self.at[entry]
        place = _ranges(self.at[entry], size)
        # by slot and then cell, so that what follows runs along the cells
        scores = np.bincount(
            np.multiply(self.slots.take(place), len(cells), dtype=np.int64) + np.repeat(row, size),
            self.values.take(place) * np.repeat(weight, size), BLOCK * len(cells),
        ).reshape(BLOCK, len(cells))
        # the best scores of k + 1 blocks are those of as many examples
        of = cells // blocks
        many = np.flatnonzero(np.bincount(of, minlength=len(without)) > self.k)
        if len(many):
            highest = np.zeros(len(keep))
            highest[cells] = scores.max(axis=0)
            other = np.partition(highest.reshape(-1, blocks)[many], blocks - self.k - 1, axis=1)[:, blocks - self.k - 1]
            least[many] = np.maximum(least[many], other - 1e-9)
        hit = _set(scores >= least[of])
        sim = np.rint(scores.ravel()[hit] * 1e12).astype(np.int64)
        slot, column = np.divmod(hit, max(1, len(cells)))
        query, block = np.divmod(cells[column], blocks)
        item = self.order[block * BLOCK + slot]
        good = np.flatnonzero((sim > 0) & (item != without[query]))
        # query, falling cosine and item in one number
        bits = len(self.ids).bit_length()
        key = np.sort((((query[good] << SIM_BITS) - sim[good]) << bits) | item[good])
        item, key = key & ((1 << bits) - 1), key >> bits
        query = -(-key >> SIM_BITS)
        sim = (query << SIM_BITS) - key
        heads = _heads(query)
        rank = np.arange(len(query)) - np.repeat(heads, np.diff(np.append(heads, len(query))))
        best = np.flatnonzero(rank < self.k)
        return query[best], item[best], sim[best] / 1e12

    def votes(self, found: tuple[np.ndarray, np.ndarray, np.ndarray], queries: int) -> np.ndarray:
        """Share of toxic neighbours of each query, weighted by cosine."""
        query, item, sim = found
        heads = _heads(query)
        weight = sim / np.repeat(sim[heads], np.diff(np.append(heads, len(query))))
        toxic = np.bincount(query, weight * self.labels[item], queries)
        return (toxic + SMOOTH * self.share) / (np.bincount(query, weight, queries) + SMOOTH)

    def read(self, column: pa.Array, without: np.ndarray | None = None):
        """(inputs of the fit, evidence) of texts; `without` has for each an example that does not count, or -1."""
        text, passage, word, count = passages(*word_hashes(column, breaks=NOT_ALNUM), self.passage)
        n, queries = len(column), len(text)
        term = np.minimum(np.searchsorted(self.terms, word), max(0, len(self.terms) - 1))
        known = self.terms[term] == word if len(self.terms) else np.zeros(len(word), bool)
        weight = (1 + np.log(count)) * np.where(known, self.idf[term] if len(self.terms) else 0.0, self.unknown)
        norm = np.sqrt(np.bincount(passage, weight**2, queries))
        passage, term, weight = passage[known], term[known], weight[known] / norm[passage[known]].clip(1e-300)
        skip = np.full(queries, -1) if without is None else without[text]
        vote, near = np.full(queries, self.share), []
        # so many that query, cosine and example fit into one number
        step = min(AT_ONCE, 1 << max(0, 63 - SIM_BITS - len(self.ids).bit_length()))
        for at in range(0, queries, step):
            s, e = np.searchsorted(passage, [at, at + step])
            some = skip[at : at + step]
            found = self.search(passage[s:e] - at, term[s:e], weight[s:e], some)
            vote[at : at + step] = self.votes(found, len(some))
            near.append((found[0] + at, *found[1:]))
        query, item, sim = (np.concatenate(x) for x in zip(*near, strict=True)) if near else (np.zeros(0, np.int64),) * 3
        order = np.lexsort((np.arange(queries), -vote, text))
        sums = np.concatenate(([0.0], np.cumsum(vote[order])))
        heads = np.searchsorted(text, np.arange(n))
        total = np.diff(np.append(heads, queries))

        def mean(of: np.ndarray) -> np.ndarray:
            return (sums[heads + of] - sums[heads]) / of

        largest = [vote[order[heads]], mean(np.minimum(3, total)), mean(np.maximum(1, total // 8)), mean(total)]
        odds = [np.log(v / (1 - v)) for v in largest]
        best = order[heads]
        s, e = np.searchsorted(query, best), np.searchsorted(query, best, "right")
        evidence = [(item[a:b], sim[a:b]) for a, b in zip(s, e, strict=True)]
        return np.stack([np.ones(n), *odds, np.log(total)], axis=1), evidence

    def score(self, inputs: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(inputs @ self.fit, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps, with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + 0.05 * w
        step = np.linalg.solve((x.T * (p * (1 - p) + 1e-9)) @ x + 0.05 * np.eye(len(w)), grad)
        w -= np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass
class Packed:
    """What an index is made from, a small part of its size; where it is sent, it arrives as the index."""

    terms: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    counts: bytes
    settings: dict
    fit: np.ndarray | None = None

    def __reduce__(self):
        return _restored, (self.terms, self.ids, self.labels, self.counts, self.settings, self.fit)


def _packed(example: np.ndarray, term: np.ndarray, count: np.ndarray) -> bytes:
    """The counts by example, terms as differences, each byte of the numbers apart."""
    pack, out = zlib.compressobj(1), []
    for x in (np.diff(example, prepend=example[:1] * 0), np.diff(term, prepend=term[:1] * 0), count):
        x = x.astype(np.int32).view(np.uint8).reshape(-1, 4)
        out.extend(pack.compress(np.ascontiguousarray(x[:, i])) for i in range(4))
    return b"".join([*out, pack.flush()])


def _unpacked(packed: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    flat = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(3, 4, -1)
    example, term, count = (np.ascontiguousarray(x.T).view(np.int32).ravel() for x in flat)
    return np.cumsum(example, dtype=np.int32), np.cumsum(term, dtype=np.int32), count


def _restored(terms: np.ndarray, ids: np.ndarray, labels: np.ndarray, counts: bytes, settings: dict, fit: np.ndarray | None) -> Index:
    index = build_index(terms, ids, labels, *_unpacked(counts), **settings)
    index.fit = fit
    return index


def _standing(example: np.ndarray, term: np.ndarray, common: np.ndarray, length: np.ndarray) -> np.ndarray:
    """An order in which examples of one language and length stand together, so that terms have few blocks.

    Languages are told by the signs of the leading components of the commonest stop words.
    """
    common = np.sort(common[:100])
    column = np.searchsorted(common, term).clip(max=max(0, len(common) - 1))
    used = np.flatnonzero(common[column] == term) if len(common) else np.zeros(0, np.int64)
    has = np.zeros((len(length), len(common)))
    has[example[used], column[used]] = 1
    has -= has.mean(axis=0)
    leading = np.linalg.eigh(has.T @ has)[1][:, ::-1][:, :4]
    return np.lexsort((length, (has @ leading > 0) @ (1 << np.arange(leading.shape[1]))))


def build_index(
    terms: np.ndarray, ids: np.ndarray, labels: np.ndarray, example: np.ndarray, term: np.ndarray, count: np.ndarray,
    k: int, passage: int = 6, max_share: float = 0.1,
) -> Index:
    """Index of all examples, given their term counts by example; its fit is still to be set."""
    n, n_terms = len(ids), len(terms)
    df = np.bincount(term, minlength=n_terms)
    idf = np.where(df > max_share * n, 0.0, np.log((1 + n) / (1 + df)) + 1)
    weight = (1 + np.log(count)) * idf[term]
    length = np.sqrt(np.bincount(example, weights=weight**2, minlength=n))
    weight /= length[example].clip(1e-300)
    standing = _standing(example, term, np.argsort(-df, kind="stable")[: np.count_nonzero(idf == 0)], length)
    place = np.empty(n, np.int64)
    place[standing] = np.arange(n)
    order = np.flatnonzero(weight > 0)
    order = order[np.argsort(term[order].astype(np.int64) * n + place[example[order]])]
    term, items, values = term[order].astype(np.int64), place[example[order]], weight[order]
    blocks = term * (n // BLOCK + 1) + items // BLOCK
    at = np.flatnonzero(np.concatenate(([True], blocks[1:] != blocks[:-1]))) if len(blocks) else np.zeros(0, np.int64)
    most = np.maximum.reduceat(values, at) if len(at) else np.zeros(0)
    # the (k + 1)-th largest weight of each term: k examples reach it even if one of them does not count
    falling = np.lexsort((-values, term))
    first = np.searchsorted(term, np.arange(n_terms))
    many = np.searchsorted(term, np.arange(n_terms), "right") - first > k
    reached = np.zeros(n_terms)
    reached[many] = values[falling[first[many] + k]]
    share = (labels.sum() + 0.5) / (n + 1)
    return Index(
        terms, idf, ids, labels, standing, np.searchsorted(term[at], np.arange(n_terms + 1)), items[at] // BLOCK, most,
        np.append(at, len(items)), (items % BLOCK).astype(np.uint8), values, reached, share, k, passage,
    )


def fit(
    documents: DataFrame, labels: DataFrame, label: str = "toxic", *,
    max_examples: int = 6_000, k: int = 15, passage: int = 6, max_share: float = 0.1,
) -> Packed | None:
    """Index of at most `max_examples` labelled documents over all their words; None without any."""
    sample = labelled_sample(documents, labels, label, max_examples)
    kind = documents.schema["doc_id"].dataType.simpleString()

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            cuts, word, count = word_counts(*word_hashes(batch.column("text"), breaks=NOT_ALNUM))
            spans = list(zip(cuts[:-1], cuts[1:], strict=True))
            packed = [[word[s:e].tobytes() for s, e in spans], [zlib.compress(count[s:e].astype(np.int32).tobytes(), 1) for s, e in spans]]
            columns = [batch.column("doc_id"), batch.column("label"), *(pa.array(x, pa.binary()) for x in packed)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "label", "words", "counts"])

    rows = sample.mapInArrow(vectors, f"doc_id {kind}, label int, words binary, counts binary").collect()
    rows.sort(key=lambda r: r.doc_id)
    if not rows:
        return None
    ids, marks = np.array([r.doc_id for r in rows]), np.array([int(r.label > 0) for r in rows])
    example = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r.words) // 8 for r in rows])
    words = np.frombuffer(b"".join([r.words for r in rows]), np.uint64)
    count = np.frombuffer(b"".join([zlib.decompress(r.counts) for r in rows]), np.int32)
    del rows
    terms = np.unique(words)
    term = np.searchsorted(terms, words).astype(np.int32)
    del words
    settings = {"k": k, "passage": passage, "max_share": max_share}
    index = Packed(terms, ids, marks, _packed(example, term, count), settings)
    shared = documents.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in pieces(batches, 200):
            own = np.searchsorted(index.ids, np.array(batch.column("doc_id").to_pylist(), index.ids.dtype))
            inputs, _ = index.read(batch.column("text"), own)
            columns = [own, *inputs.T]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x)) for x in columns], names=["at", *INPUTS])

    schema = ", ".join(["at long", *[f"{c} double" for c in INPUTS]])
    # small parts, as most of the work is in the fit of long examples
    spread = sample.repartition(max(1, min(24, len(ids) // 200)), F.xxhash64("doc_id"))
    read = spread.mapInArrow(run, schema).collect()
    shared.destroy()
    read = np.array(sorted(tuple(r) for r in read)).reshape(-1, 1 + len(INPUTS))
    index.fit = _logistic(read[:, 1:], marks[read[:, 0].astype(np.int64)].astype(float))
    return index


INPUTS = ["one", "most", "three", "eighth", "mean", "number"]


def score(documents: DataFrame, index: Packed | None, threshold: float = 0.5) -> DataFrame:
    """(doc_id, held_out, score, predicted, evidence) for every row of `documents`.

    `evidence` lists the nearest examples of the strongest passage with their cosine and label. A passage without a
    neighbour votes with the share of toxic examples; null and empty texts are one such passage. With
    no index at all every score is 0. A null doc_id counts as the empty text for `held_out`.
    Repeated rows are scored alike; other columns are ignored.
    """
    shared = documents.sparkSession.sparkContext.broadcast(index)
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in pieces(batches, 500):
            scores, evidence = np.zeros(batch.num_rows), [[] for _ in range(batch.num_rows)]
            if index is not None:
                inputs, near = index.read(batch.column("text"))
                scores = index.score(inputs)
                evidence = [
                    [
                        {"example": a, "cosine": b, "label": c}
                        for a, b, c in zip(index.ids[item].tolist(), sim.tolist(), index.labels[item].tolist(), strict=True)
                    ]
                    for item, sim in near
                ]
            of = pa.struct([("example", batch.column("doc_id").type), ("cosine", pa.float64()), ("label", pa.int32())])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores), pa.array(evidence, pa.list_(of))], names=["doc_id", "score", "evidence"]
            )

    schema = f"doc_id {kind}, score double, evidence array<struct<example: {kind}, cosine: double, label: int>>"
    scored = documents.select("doc_id", "text").mapInArrow(run, schema)
    return scored.select(
        "doc_id",
        (fold("doc_id") == 0).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "evidence",
    )
