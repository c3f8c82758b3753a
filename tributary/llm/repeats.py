"""Exact repeats of long strings across all texts, by bounded interval expansion on a BWT.

A byte goes if a string of `length` bytes that covers it also starts somewhere else. The
suffixes of a whole corpus do not fit anywhere, so the work is cut where content says:

1. Anchors. Of the `gram`-byte strings in every window of `length` bytes the one with the
   smallest hash is an anchor. Equal windows have equal anchors at equal places, so a repeated
   window is found at anchors of one hash. About one byte in seventy is an anchor.
2. Contexts. The bytes around an anchor that windows with this anchor can cover are its context.
   Anchors whose hash is alone are done. Equal contexts are counted, not compared: if one
   occurs twice, all of it is repeated. What is left are different contexts of one hash, one of
   each.
3. Expansion. Contexts of one hash meet in a task, aligned at their anchors; a byte and its
   column are one letter. Their suffixes are sorted, and backward extension on the
   Burrows-Wheeler transform goes breadth first through the intervals of suffixes with a
   common prefix; it gives the places where neighbours part after 0, 1, 2 ... bytes and stops
   at `length`. Neighbours that it did not part share a window.
4. A hash with more than `hot` contexts is cut by what windows have in common. The windows of a context
   fall into runs of neighbours. Equal windows of a run have equal cores, the bytes that all windows of
   the run share, so contexts meet per run and core. Those that agree in the hull of the run, the bytes
   of all its windows, are counted, not compared, and one of them goes on. If the hulls of one core are
   still more than `hot`, the run is halved. A run of one window is its own core and hull, so every
   window's holders meet somewhere, in a group of at most `hot` for step 3 or in a count.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import pieces, release, written
from tributary.llm.tokens import BASE, BYTE_VALUES, INVERSE, buffers, mix, powers

SLICE = 1 << 20
RANGES = 4
NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every `width` neighbours."""
    n = len(x) - width + 1
    rows = -(-len(x) // width)
    padded = np.full(rows * width, NEVER, np.uint64)
    padded[: len(x)] = x
    blocks = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """(text, position, hash, context hash) of the anchors of a batch of texts."""
    out: list[tuple[np.ndarray, ...]] = []
    end = int(offsets[-1])
    for at in range(0, end, SLICE):
        lo, hi = max(0, at - length), min(end, at + SLICE + length)
        n = hi - lo
        if n < length:
            continue
        sums = np.empty(n + 1, np.uint64)
        sums[0] = 0
        np.cumsum(BYTE_VALUES[data[lo:hi]] * powers(BASE, n), out=sums[1:])
        hashes = mix((sums[gram:] - sums[:-gram]) * powers(INVERSE, n + 1)[: n + 1 - gram])
        wide = length - gram + 1
        least = _sliding_min(hashes, wide)
        # Only windows inside one text count; the bounds of texts within the slice part them.
        cuts = offsets[np.searchsorted(offsets, lo, "right") : np.searchsorted(offsets, hi, "left")] - lo
        for cut in cuts:
            least[max(0, cut - length + 1) : cut] = NEVER
        # A gram is an anchor if it is the least of a window: the largest least around it is its own.
        turned = np.concatenate([np.full(wide - 1, NEVER, np.uint64), least, np.full(wide - 1, NEVER, np.uint64)])
        turned = np.where(turned == NEVER, NEVER, ~turned)
        around = _sliding_min(turned, wide)[: len(hashes)]
        own = np.flatnonzero((around == ~hashes) & (around != NEVER)) + lo
        own = own[(own >= at) & (own < at + SLICE)]
        text = np.searchsorted(offsets, own, "right") - 1
        first = np.maximum(offsets[text], own - (length - gram)) - lo
        last = np.minimum(offsets[text + 1], own + length) - lo
        around = (sums[last] - sums[first]) * powers(INVERSE, n + 1)[first]
        context = mix(around + (own - lo - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + (last - first).astype(np.uint64))
        out.append((text, own - offsets[text], hashes[own - lo], context))
    if not out:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.uint64, np.uint64))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def anchor_rows(documents: DataFrame, length: int, gram: int) -> DataFrame:
    """(hash, context, row, pos): all anchors of (row, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            text, pos, hashes, context = anchors(*buffers(batch.column("text")), length, gram)
            columns = [hashes.view(np.int64), context.view(np.int64), batch.column("row").take(pa.array(text)), pos]
            yield pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], names=["hash", "context", "row", "pos"])

    kind = documents.schema["row"].dataType.simpleString()
    return documents.select("row", "text").mapInArrow(run, f"hash long, context long, row {kind}, pos long")


def context_rows(found: DataFrame, length: int, gram: int) -> DataFrame:
    """(hash, context, n, row, first, anchor, bytes) of wanted contexts, from (row, text, wanted).

    `first` is where the context begins in its text, `anchor` where its anchor stands in it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 200):
            data, offsets = buffers(batch.column("text"))
            column = batch.column("wanted")
            wanted = column.flatten()
            text = np.repeat(np.arange(batch.num_rows), np.diff(column.offsets.to_numpy()))
            pos = wanted.field("pos").to_numpy() + offsets[text]
            first = np.maximum(offsets[text], pos - (length - gram))
            last = np.minimum(offsets[text + 1], pos + length)
            sizes = last - first
            ends = np.concatenate(([0], np.cumsum(sizes)))
            flat = data[np.repeat(first - ends[:-1], sizes) + np.arange(ends[-1])]
            contents = pa.Array.from_buffers(pa.binary(), len(pos), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(flat)])
            columns = {k: wanted.field(k) for k in ("hash", "context", "n")} | {
                "row": batch.column("row").take(pa.array(text)),
                "first": pa.array(first - offsets[text]),
                "anchor": pa.array(pos - first),
                "bytes": contents,
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    kind = found.schema["row"].dataType.simpleString()
    schema = f"hash long, context long, n long, row {kind}, first long, anchor long, bytes binary"
    return found.select("row", "text", "wanted").mapInArrow(run, schema)


def run_rows(parts: DataFrame, length: int, gram: int) -> DataFrame:
    """(hash, context, row, many, low, high, core, hull, start, end) of runs of windows, from contexts with `runs`.

    Window w begins in column w, its distance from the left end that a context has if its text does not
    end before. A run has the windows from `low` to `high` - 1; without any of them in the context there is no row.
    `start` and `end` bound its hull in the text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column("bytes"))
            runs = batch.column("runs")
            of = np.repeat(np.arange(batch.num_rows), np.diff(runs.offsets.to_numpy()))
            low, high = (runs.flatten().field(c).to_numpy() for c in ("low", "high"))
            anchor, first, size = batch.column("anchor").to_numpy()[of], batch.column("first").to_numpy()[of], np.diff(offsets)[of]
            begin = length - gram - anchor
            there = np.maximum(low, begin) <= np.minimum(high - 1, begin + size - length)
            shift = offsets[of] - begin  # from columns to places in the data
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(BYTE_VALUES[data] * powers(BASE, len(data)))))
            back = powers(INVERSE, len(data) + 1)

            def hashed(s: np.ndarray, e: np.ndarray) -> np.ndarray:
                return (sums[e] - sums[s]) * back[s] + (e - s).astype(np.uint64)  # noqa: B023

            start, end = np.maximum(low, begin)[there], np.minimum(high - 1 + length, begin + size)[there]
            inner = mix(hashed((high - 1 + shift)[there], (low + length + shift)[there]))
            outer = mix(hashed(start + shift[there], end + shift[there]) + (start - low[there]).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            to_text = first[there] - begin[there]
            columns = {k: batch.column(k).take(pa.array(of[there])) for k in ("hash", "context", "row")} | {
                "many": runs.flatten().field("many").take(pa.array(np.flatnonzero(there))), "low": pa.array(low[there]), "high": pa.array(high[there]),
                "core": pa.array(inner.view(np.int64)), "hull": pa.array(outer.view(np.int64)),
                "start": pa.array(start + to_text), "end": pa.array(end + to_text),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    kind = parts.schema["row"].dataType.simpleString()
    schema = f"hash long, context long, row {kind}, many boolean, low long, high long, core long, hull long, start long, end long"
    return parts.select("hash", "context", "row", "first", "anchor", "bytes", "runs").mapInArrow(run, schema)


RUN = ["hash", "low", "high", "core"]


def cut_runs(contexts: DataFrame, length: int, gram: int, cell: int, hot: int) -> tuple[DataFrame, DataFrame]:
    """(repeated spans, parts) of contexts of hot hashes.

    Parts are like contexts, cut to the hull of a run, with a `group`. Of one run and core there are at most `hot`,
    and a group holds about `cell` parts.
    """
    starts = np.linspace(0, length - gram + 1, RANGES + 1).astype(int).tolist()
    bounds = [(F.lit(s).cast("long"), F.lit(e).cast("long")) for s, e in zip(starts[:-1], starts[1:], strict=True)]
    runs = F.array(*[F.struct(low.alias("low"), high.alias("high"), (F.col("n") > 1).alias("many")) for low, high in bounds])
    parts = contexts.withColumn("runs", runs)
    spans, small = [], []
    while True:
        rows = written(run_rows(parts, length, gram), "repeats-runs")
        hulls = rows.groupBy(*RUN, "hull").agg(
            F.count(F.lit(1)).alias("n"), F.max("many").alias("many"), F.min("context").alias("context")
        )
        hulls = written(hulls, "repeats-hulls")
        spans.append(rows.join(hulls.where("n > 1").select(*RUN, "hull"), [*RUN, "hull"]).select("row", "start", "end"))
        kinds = hulls.groupBy(*RUN).agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
        several = hulls.join(kinds, RUN).select(*RUN, "kinds", "context", (F.col("many") | (F.col("n") > 1)).alias("many"))
        several = written(several, "repeats-cores")
        small.append(several.where(F.col("kinds") <= hot))
        large = several.where(F.col("kinds") > hot)
        if large.isEmpty():
            break
        middle = F.floor((F.col("low") + F.col("high")) / 2)
        halves = F.array(F.struct("low", middle.alias("high")), F.struct(middle.alias("low"), "high"))
        own = large.select("hash", "context", "many", F.inline(halves).alias("low", "high")).where("low < high")
        own = own.groupBy("hash", "context").agg(F.collect_list(F.struct("low", "high", "many")).alias("runs"))
        parts = contexts.join(own, ["hash", "context"])
    found = written(reduce(DataFrame.unionByName, small), "repeats-small")
    bins = max(1, -(-found.count() // cell))
    group = F.struct(F.lit(True).alias("large"), F.pmod(F.xxhash64(F.lit(3), *RUN), F.lit(bins)).alias("at"))
    whole = contexts.join(found, ["hash", "context"])
    begin = length - gram - F.col("anchor")
    left = F.greatest(F.col("low") - begin, F.lit(0))
    right = F.least(F.col("high") - 1 + length - begin, F.octet_length("bytes"))
    cut = whole.select(
        "hash", "context", F.when(F.col("many"), 2).otherwise(1).cast("long").alias("n"), "row", (F.col("first") + left).alias("first"),
        (F.col("anchor") - left).alias("anchor"), F.substring("bytes", left.cast("int") + 1, (right - left).cast("int")).alias("bytes"),
        group.alias("group"),
    )
    return reduce(DataFrame.union, spans), cut


def suffix_order(symbols: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(part, column) of all suffixes of aligned parts, by column and then by content.

    Part i has symbols[i, begin[i]:end[i]] and a separator of its own after them; separators
    come first, as column -1. A symbol together with its column counts as one letter, so this
    is the suffix order over that alphabet. It is found column by column from the right: a
    suffix ranks by its first symbol and then by the rank of the suffix after it.
    """
    n, width = symbols.shape
    rank, parts, columns = np.arange(n), [], []
    for column in range(width - 1, -1, -1):
        here = np.flatnonzero((begin <= column) & (column < end))
        here = here[np.argsort(symbols[here, column].astype(np.int64) * (2 * n + 2) + rank[here])]
        rank[here] = n + np.arange(len(here))
        parts.append(here)
        columns.append(np.full(len(here), column))
    return np.concatenate([np.arange(n), *parts[::-1]]), np.concatenate([np.full(n, -1), *columns[::-1]])


def _ascending(places: np.ndarray, n: int) -> np.ndarray:
    """Different numbers below n in order; many of them by marking rather than by sorting."""
    if len(places) < n // 100:
        return np.sort(places)
    marks = np.zeros(n, bool)
    marks[places] = True
    return np.flatnonzero(marks)


def parted_below(bwt: np.ndarray, limit: int) -> np.ndarray:
    """parted[i]: suffixes i - 1 and i have a common prefix of fewer than `limit` symbols.

    `bwt` holds the symbol before each suffix in suffix order; equal symbols of separators
    must have been made different. The interval of all suffixes is extended backward by every
    symbol; an interval of prefix length d that ends where no shorter prefix ended parts the
    neighbours there after d symbols, and only such intervals are extended further.
    """
    n = len(bwt)
    by_symbol = np.argsort(bwt, kind="stable")
    to = np.empty(n, np.int64)  # where the suffix that is longer by the symbol before it stands
    to[by_symbol] = np.arange(n)
    same = bwt[by_symbol][1:] == bwt[by_symbol][:-1]
    following, preceding = np.full(n, n, np.int64), np.full(n, -1, np.int64)
    following[by_symbol[:-1][same]] = by_symbol[1:][same]
    preceding[by_symbol[1:][same]] = by_symbol[:-1][same]
    parted = np.zeros(n + 1, bool)
    parted[0] = parted[n] = True
    low, high = np.array([0]), np.array([n - 1])
    for depth in range(limit):
        if len(low) == 0:
            break
        sizes = high - low + 1
        if sizes.max() == 1:  # single suffixes, as most are after some rounds
            at = low
            last = first = np.ones(len(low), bool)
        else:
            at = np.repeat(low - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
            last = following[at] > np.repeat(high, sizes)
            first = preceding[at] < np.repeat(low, sizes)
        # The k-th first and the k-th last in the order they go to are of one interval.
        new_high, new_low = _ascending(to[at[last]], n), _ascending(to[at[first]], n)
        # A prefix of depth + 1 symbols ends here; suffixes part after `depth` symbols.
        fresh = ~parted[new_high + 1]
        if depth == 0:
            fresh |= new_high == n - 1
        parted[new_high[fresh] + 1] = True
        low, high = new_low[fresh], new_high[fresh]
    return parted[:-1]


def repeated_windows(parts: list[bytes], begin: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(part, offset, class) of all windows, class by class; equal windows of one column are one class.

    begin[i] is the column of the first byte of part i, which has one byte at least.
    """
    sizes = np.array([len(p) for p in parts], np.int64)
    end = begin + sizes
    symbols = np.zeros((len(parts), int(end.max())), np.uint8)
    flat = np.repeat(np.arange(len(parts)) * symbols.shape[1] + begin, sizes)
    flat += np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    symbols.ravel()[flat] = np.frombuffer(b"".join(parts), np.uint8)
    part, column = suffix_order(symbols, begin, end)
    before = np.where(column < 0, end[part], column) - 1
    letter = len(parts) + before * 256 + symbols[part, np.maximum(before, 0)]
    bwt = np.where(before < begin[part], (part - 1) % len(parts), letter)
    run = np.cumsum(parted_below(bwt, length))
    whole = (column >= 0) & (column + length <= end[part])
    return part[whole], (column - begin[part])[whole], run[whole]


def cell_spans(table: pa.Table, length: int, gram: int) -> pa.Table:
    """Repeated spans of the contexts of a cell that occur once."""
    rows = table.to_pylist()
    rows.sort(key=lambda r: (r["hash"], r["context"], r["first"]))
    begin = np.array([length - gram - r["anchor"] for r in rows], np.int64)
    part, offset, run = repeated_windows([r["bytes"] for r in rows], begin, length)
    first = np.array([r["first"] for r in rows], np.int64)
    many = np.array([r["n"] > 1 for r in rows])
    names = {}
    document = np.array([names.setdefault(r["row"], len(names)) for r in rows], np.int64)
    place = (document[part] << 40) + first[part] + offset
    # A class is repeated if it starts at two places, or stands in a context that occurs twice.
    begins = np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1]))) if len(run) else np.zeros(0, np.int64)
    group = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(run))))
    twice = np.zeros(0, bool)
    if len(begins):
        twice = np.minimum.reduceat(place, begins) != np.maximum.reduceat(place, begins)
        twice |= np.maximum.reduceat(many[part], begins)
    marked = twice[group] & ~many[part]
    order = np.lexsort((offset[marked], part[marked]))
    p, o = part[marked][order], offset[marked][order]
    # Windows of a context that touch become one span.
    starts = np.flatnonzero(np.concatenate(([True], (p[1:] != p[:-1]) | (o[1:] > o[:-1] + length)))) if len(p) else p
    lasts = np.append(starts[1:], len(p)) - 1 if len(p) else p
    named = pa.array([r["row"] for r in rows], table.schema.field("row").type)
    at = p[starts]
    columns = [named.take(pa.array(at)), pa.array(first[at] + o[starts], pa.int64()), pa.array(first[at] + o[lasts] + length, pa.int64())]
    return pa.table(columns, names=["row", "start", "end"])


def repeated_spans(documents: DataFrame, *, length: int = 200, gram: int = 64, cell: int = 2048, hot: int = 256) -> DataFrame:
    """(row, start, end): spans of (row, text) that cover every byte of a repeated window, and no other.

    Rows must have names of their own. Spans may overlap, and reach beyond the end of a text:
    one that has fewer than `length` bytes inside the text does not count (see `merged`). Null
    texts are empty.
    """
    spark = documents.sparkSession
    found = written(anchor_rows(documents, length, gram), "repeats-found")
    counts = written(found.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash"), "repeats-hashes")
    release(spark)
    shared = written(found.join(counts, "hash"), "repeats-anchors")
    release(spark)
    contexts = shared.groupBy("hash", "context").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "pos")).alias("one")
    )
    contexts = written(contexts, "repeats-contexts")
    several = contexts.where("n > 1").select("hash", "context")
    whole = shared.join(several, ["hash", "context"]).select(
        "row",
        F.greatest(F.col("pos") - (length - gram), F.lit(0)).alias("start"),
        (F.col("pos") + length).alias("end"),
    )
    whole = written(whole, "repeats-whole")

    mixed = contexts.groupBy("hash").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    mixed = written(mixed, "repeats-mixed")
    wanted = contexts.join(mixed.select("hash"), "hash").select(
        F.col("one.row").alias("row"), F.struct("hash", "context", "n", F.col("one.pos").alias("pos")).alias("w")
    )
    wanted = wanted.groupBy("row").agg(F.collect_list("w").alias("wanted"))
    pieces_of = written(context_rows(documents.join(wanted, "row"), length, gram), "repeats-pieces")
    release(spark)
    few = mixed.where(F.col("kinds") <= hot).agg(F.sum("kinds").alias("n")).first().n or 0
    large = written(mixed.where(F.col("kinds") > hot).select("hash"), "repeats-large")
    # Hashes of few contexts share cells.
    bin_of = F.pmod(F.xxhash64(F.lit(4), "hash"), F.lit(max(1, -(-few // cell))))
    placed = pieces_of.join(large, "hash", "left_anti")
    placed = placed.withColumn("group", F.struct(F.lit(False).alias("large"), bin_of.alias("at")))
    if not large.isEmpty():
        spans, cut = cut_runs(written(pieces_of.join(large, "hash"), "repeats-many"), length, gram, cell, hot)
        whole, placed = whole.union(spans), placed.unionByName(cut)
    kind = documents.schema["row"].dataType.simpleString()
    found = placed.groupBy("group").applyInArrow(lambda t: cell_spans(t, length, gram), f"row {kind}, start long, end long")
    return whole.union(written(found, "repeats-found"))


def merged(spans: list, size: int, length: int) -> list[tuple[int, int]]:
    """Disjoint, ascending, with gaps between them, inside a text of `size` bytes."""
    out: list[list[int]] = []
    for s, e in sorted((s, min(e, size)) for s, e in spans):
        if e - s < length:
            continue
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def remove_repeats(documents: DataFrame, *, length: int = 200, gram: int = 64, cell: int = 2048, hot: int = 256) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept, kept_sha256) for every row.

    Texts are taken as UTF-8 bytes, null as empty; `kept` has the bytes that stay, which may
    cut a character. Rows that repeat a doc_id, or have none, are texts of their own. Texts
    shorter than `length` keep all. Other columns are ignored.
    """
    texts = documents.select("doc_id", "text")
    ids = texts.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("doc_id").alias("ids")).first()
    if ids.rows == ids.ids:
        texts = texts.withColumn("row", F.col("doc_id"))
    else:  # names for the rows, fixed by writing them
        texts = written(texts.withColumn("row", F.monotonically_increasing_id()), "repeats-rows")
    spans = repeated_spans(texts, length=length, gram=gram, cell=cell, hot=hot).distinct()
    spans = spans.groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    spans = written(spans, "repeats-spans")
    release(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            data, offsets = buffers(batch.column("text"))
            sizes, removed, counts, kept, digests = np.diff(offsets), [], [], [], []
            for i, found in enumerate(batch.column("spans").to_pylist()):
                text = data[offsets[i] : offsets[i + 1]].tobytes()
                cuts = merged([(s["start"], s["end"]) for s in found or []], len(text), length)
                at, left = 0, []
                for s, e in cuts:
                    left.append(text[at:s])
                    at = e
                left = b"".join([*left, text[at:]])
                removed.append(len(text) - len(left))
                counts.append(len(cuts))
                kept.append(left)
                digests.append(hashlib.sha256(left).hexdigest())
            columns = [pa.array(sizes), pa.array(removed, pa.int64()), pa.array(counts, pa.int64()), pa.array(kept, pa.binary()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"
    return texts.join(spans, "row", "left").select("doc_id", "text", "spans").mapInArrow(run, schema)
