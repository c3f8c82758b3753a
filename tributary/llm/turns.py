"""Conversation structure repair: the cheapest edits that make the roles of a conversation alternate.

The roles that remain have to read `(s?(ua)+)?` by their initials. A row is kept, given another role or deleted, and
empty rows can be inserted. All of it is one shortest path through the rows and four states, where a weight is
a single integer: its high digits are the cost, its low digits the letters of the edits from the left, three
bits each, with zeros to a fixed width. Of two integers the smaller is thus the cheaper path, and of equally cheap
ones the one whose letters come first. Paths grow at their front, which shifts the letters by one.

A conversation is cut into blocks of rows. A block gives the weights between any two states at its ends, weights
of blocks are put end to end, and once the states between blocks are known each block has its letters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import written
from tributary.llm.places import with_places

BLANKS = "\t\n\x0b\x0c\r "
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
LETTERS = "\0" + "".join(sorted(KEEP + REROLE + DELETE + INSERT))  # digit to letter, in ASCII order
DIGIT = {letter: LETTERS.index(letter) for letter in LETTERS[1:]}
COSTS = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED_COST = 1
# States by what was written last: nothing, s, u, a. What may follow each.
STATES = "-sua"
NEXT = {"-": "su", "s": "u", "u": "a", "a": "u"}
FINAL = "-a"
BITS = 3
BLOCK = 256  # rows

Weight = int


def _inserts(best: dict[str, Weight | None], width: int) -> None:
    """Paths that insert a row first, and a second before it; a third would only come back to a state."""
    for _ in range(2):
        for state in STATES:
            for role in NEXT[state].replace("s", ""):
                _take(best, state, _before(best[role], COSTS[INSERT], INSERT, width))


def _before(rest: Weight | None, cost: int, letter: str, width: int) -> Weight | None:
    """The path of one edit and then `rest`."""
    if rest is None:
        return None
    low = width * BITS
    letters = rest & ((1 << low) - 1)
    return ((rest >> low) + cost << low) | (DIGIT[letter] << low - BITS) | (letters >> BITS)


def _take(best: dict[str, Weight | None], state: str, path: Weight | None) -> None:
    if path is not None and (best[state] is None or path < best[state]):
        best[state] = path


def width_of(rows: int) -> int:
    """Letters that the edits of so many rows can have: one a row, two inserts around each."""
    return 3 * rows + 2


def block_weights(rows: list[tuple[str, str]], ends: str) -> dict[str, Weight | None]:
    """Per state before the rows, the least weight of edits that lead to one of `ends` after them.

    A row is (initial of its role, fault); faults are "b" and "d", which leave only deleting, "t", and "".
    """
    width = width_of(len(rows))
    best: dict[str, Weight | None] = {state: 0 if state in ends else None for state in STATES}
    _inserts(best, width)
    for initial, fault in reversed(rows):
        after, best = best, dict.fromkeys(STATES)
        more = TRUNCATED_COST if fault == "t" else 0
        for state in STATES:
            _take(best, state, _before(after[state], COSTS[DELETE], DELETE, width))
            if fault in ("", "t"):
                for role in NEXT[state]:
                    if role == initial:
                        _take(best, state, _before(after[role], COSTS[KEEP] + more, KEEP, width))
                    if role != "s":
                        _take(best, state, _before(after[role], COSTS[REROLE] + more, REROLE, width))
        _inserts(best, width)
    return best


def letters_of(weight: Weight, width: int) -> str:
    low = weight & ((1 << width * BITS) - 1)
    digits = [(low >> BITS * (width - 1 - i)) & 7 for i in range(width)]
    return "".join(LETTERS[d] for d in digits if d)


def joined(front: Weight, front_width: int, back: Weight, back_width: int) -> Weight:
    """Two paths end to end, in the sum of their widths."""
    low_f, low_b = front_width * BITS, back_width * BITS
    letters = front & ((1 << low_f) - 1)
    free = ((letters & -letters).bit_length() - 1) // BITS if letters else front_width
    tail = back & ((1 << low_b) - 1)
    cost = (front >> low_f) + (back >> low_b)
    return (cost << low_f + low_b) | (letters << low_b) | (tail << BITS * free)


def edits_of(letters: str, state: str, initials: list[str]) -> list[tuple[int, str, str]]:
    """(row or -1, letter, role) of every row that the letters write, from a state; the role is "" where it is kept."""
    out, at = [], 0
    for letter in letters:
        if letter != DELETE:
            state = initials[at] if letter == KEEP else NEXT[state][-1]
            role = "" if letter == KEEP else {"u": "user", "a": "assistant"}[state]
            out.append((-1 if letter == INSERT else at, letter, role))
        at += letter != INSERT
    return out


def as_bytes(weight: Weight) -> bytes:
    return weight.to_bytes((weight.bit_length() + 7) // 8, "big")


def _runs(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[tuple[tuple, list[dict]]]:
    """(key, rows) of neighbouring rows with the same key, in rows that are sorted by it."""
    held: list[dict] = []
    current: tuple | None = None
    for batch in batches:
        for row in batch.to_pylist():
            key = tuple(row[k] for k in keys)
            if key != current and held:
                yield current, held
                held = []
            current = key
            held.append(row)
    if held:
        yield current, held


def _in_batches(rows: Iterator[dict], schema: pa.Schema, size: int = 256) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def fits(pair: str) -> bool:
    return pair in ("su", "ua", "au")


PART = pa.struct([("start", pa.string()), ("end", pa.string()), ("weight", pa.binary())])
WEIGHED = pa.schema(
    [
        ("conv", pa.string()), ("block", pa.int64()), ("rows", pa.int64()), ("illegal", pa.int64()),
        ("first", pa.string()), ("final", pa.string()), ("weights", pa.list_(PART)),
    ]
)
WEIGHED_DDL = (
    "conv STRING, block BIGINT, rows BIGINT, illegal BIGINT, first STRING, final STRING, "
    "weights ARRAY<STRUCT<start: STRING, end: STRING, weight: BINARY>>"
)


def _weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The weights of each block, between the states that can be at its ends, and its pairs of roles that do not fit."""

    def blocks() -> Iterator[dict]:
        for (conv, block), held in _runs(batches, "conv", "block"):
            rows = [(r["initial"], r["fault"]) for r in held]
            last = held[-1]["place"] == held[-1]["size"] - 1
            weights = []
            for end in [FINAL] if last else STATES:
                best = block_weights(rows, end)
                for start in STATES if block else STATES[0]:
                    if best[start] is not None:
                        weights.append({"start": start, "end": end[0], "weight": as_bytes(best[start])})
            pairs = zip(rows, rows[1:], strict=False)
            yield {
                "conv": conv, "block": block, "rows": len(rows), "first": rows[0][0], "final": rows[-1][0],
                "illegal": sum(not fits(a + b) for (a, _), (b, _) in pairs), "weights": weights,
            }

    return _in_batches(blocks(), WEIGHED)


CHOSEN = pa.schema(
    [
        ("conv", pa.string()), ("block", pa.int64()), ("start", pa.string()),
        ("letters", pa.string()), ("cost", pa.int64()), ("illegal", pa.int64()),
    ]
)
CHOSEN_DDL = "conv STRING, block BIGINT, start STRING, letters STRING, cost BIGINT, illegal BIGINT"


def _choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The letters of every block: its least path between the states that the whole conversation's least path goes through."""

    def chosen() -> Iterator[dict]:
        for (conv,), blocks in _runs(batches, "conv"):
            suffix: dict[str, tuple[Weight, int]] = dict.fromkeys(FINAL, (0, 0))  # weight and width of what comes after
            ways = []
            for block in reversed(blocks):
                width, before, way = width_of(block["rows"]), {}, {}
                for part in block["weights"]:
                    start, end, own = part["start"], part["end"], int.from_bytes(part["weight"], "big")
                    if end in suffix:
                        whole = joined(own, width, *suffix[end])
                        if start not in before or whole < before[start][0]:
                            before[start], way[start] = (whole, width + suffix[end][1]), (end, own)
                suffix = before
                ways.append(way)
            state, previous = STATES[0], None
            for block, way in zip(blocks, reversed(ways), strict=True):
                end, own = way[state]
                width = width_of(block["rows"])
                edge = previous is not None and not fits(previous + block["first"])
                yield {
                    "conv": conv, "block": block["block"], "start": state, "letters": letters_of(own, width),
                    "cost": own >> width * BITS, "illegal": block["illegal"] + edge,
                }
                state, previous = end, block["final"]

    return _in_batches(chosen(), CHOSEN)


REPAIRED = pa.schema(
    [
        ("conv", pa.string()), ("block", pa.int64()), ("seq", pa.int64()),
        ("edit", pa.string()), ("role", pa.string()), ("text", pa.string()),
    ]
)
REPAIRED_DDL = "conv STRING, block BIGINT, seq BIGINT, edit STRING, role STRING, text STRING"


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows that the letters of a block write."""

    def rows() -> Iterator[dict]:
        for (conv, block), held in _runs(batches, "conv", "block"):
            made = edits_of(held[0]["letters"], held[0]["start"], [r["initial"] for r in held])
            for seq, (at, letter, role) in enumerate(made):
                text = "" if at < 0 else held[at]["text"]
                yield {"conv": conv, "block": block, "seq": seq, "edit": letter, "role": role or held[at]["role"], "text": text}

    return _in_batches(rows(), REPAIRED, 64)


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """sha256 of the lines of each conversation, row after row; no text is kept."""

    def hashes() -> Iterator[dict]:
        conv, digest = None, hashlib.sha256()
        for batch in batches:
            for key, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv", "role", "text")], strict=True):
                if key != conv:
                    if conv is not None:
                        yield {"conv": conv, "sha256": digest.hexdigest()}
                    conv, digest = key, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
        if conv is not None:
            yield {"conv": conv, "sha256": digest.hexdigest()}

    return _in_batches(hashes(), pa.schema([("conv", pa.string()), ("sha256", pa.string())]))


def with_faults(rows: DataFrame) -> DataFrame:
    """(conv, place, size, block, turn, role, text, initial, fault) of rows (conv, turn, role, text, __n) that are stored.

    The rows of a conversation go by turn, nulls first, then by role and by the sha256 of the text. A copy of an earlier row
    of the conversation is a duplicate wherever it stands; the first of the copies is found by aggregation.
    """
    rows = rows.withColumn("digest", F.unhex(F.sha2("text", 256)))
    order = [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("digest").asc()]
    placed = written(with_places(rows, ["conv"], order, "turns-order"), "turns-placed")
    firsts = placed.groupBy("conv", "role", "digest").agg(F.min("place").alias("place")).select("conv", "place", F.lit(True).alias("first"))
    sizes = placed.groupBy("conv").agg(F.count(F.lit(1)).alias("size"))
    last = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    fault = (
        F.when(last == "", "b").when(F.col("first").isNull(), "d").when(~last.isin(".", "!", "?"), "t").otherwise("")
    )
    judged = placed.join(firsts, ["conv", "place"], "left").join(sizes, "conv")
    return judged.select(
        "conv", "place", "size", F.floor(F.col("place") / BLOCK).alias("block"), "turn", "role", "text",
        F.left("role", F.lit(1)).alias("initial"), fault.alias("fault"),
    )


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(repaired rows, one row per conversation).

    Repaired rows: conv, block, seq (their order), edit, role, text. Conversations: conv, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256. `conv` is ":" and the id as text, "-" without an id. A null role or text
    counts as one space. A text is blank if it holds no character but space and \\x09 to \\x0D. Rows without an id are
    one conversation. An empty table gives no rows.
    """
    key = conv_key(F.col(conv))
    plain = rows.select(
        key.alias("conv"), F.col(turn).cast("bigint").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"),
    )
    stored = written(plain.withColumn("__n", F.monotonically_increasing_id()), "turns-rows")
    judged = written(with_faults(stored), "turns-judged")
    slim = judged.select("conv", "block", "place", "size", "initial", "fault")
    blocks = slim.repartition("conv", "block").sortWithinPartitions("conv", "block", "place").mapInArrow(_weigh, WEIGHED_DDL)
    weighed = written(blocks, "turns-weights")
    ways = weighed.repartition("conv").sortWithinPartitions("conv", "block").mapInArrow(_choose, CHOSEN_DDL)
    chosen = written(ways, "turns-chosen")

    # only the first row of a block carries its letters
    heads = chosen.select("conv", (F.col("block") * BLOCK).alias("place"), "start", "letters")
    lettered = judged.select("conv", "block", "place", "role", "text", "initial").join(heads, ["conv", "place"], "left")
    made = lettered.repartition("conv", "block").sortWithinPartitions("conv", "block", "place").mapInArrow(_repair, REPAIRED_DDL)
    repaired = written(made, "turns-repaired")
    lines = repaired.select("conv", "block", "seq", "role", "text")
    lines = lines.repartition("conv").sortWithinPartitions("conv", "block", "seq").select("conv", "role", "text")
    hashes = lines.mapInArrow(_hash, "conv STRING, sha256 STRING")

    count = lambda fault: F.count_if(F.col("fault") == fault)
    gaps = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    counts = judged.groupBy("conv").agg(
        F.coalesce(gaps, F.lit(0)).cast("bigint").alias("gaps"),
        count("b").alias("blank"), count("d").alias("duplicate"), count("t").alias("truncated"),
    )
    parts = F.sort_array(F.collect_list(F.struct("block", "letters")))
    paths = chosen.groupBy("conv").agg(
        F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"),
        F.array_join(F.transform(parts, lambda p: p["letters"]), "").alias("audit"),
    )
    done = counts.join(paths, "conv").join(hashes, "conv", "left")
    empty = F.lit(hashlib.sha256().hexdigest())
    return repaired, done.select(*counts.columns, "illegal", "cost", "audit", F.coalesce("sha256", empty).alias("repaired_sha256"))


def conv_key(conv: Column) -> Column:
    return F.coalesce(F.concat(F.lit(":"), conv.cast("string")), F.lit("-"))


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with known faults, by the crc32 of conversation and turn modulo 20; a null counts as one space.

    0: the row goes; 1: its text is empty; 2: its text has no `.`, `!`, `?`; 3: it stands twice; 4: its role is user.
    """
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(shown(conv), F.lit(":"), shown(turn)).cast("binary")), F.lit(20))
    rows = rows.select(F.col(conv).alias(conv), F.col(turn).alias(turn), shown(role).alias(role), shown(text).alias(text), kind.alias("__kind"))
    hurt = F.when(F.col("__kind") == 1, "").when(F.col("__kind") == 2, F.translate(text, ".!?", "")).otherwise(F.col(text))
    times = F.when(F.col("__kind") == 0, 0).when(F.col("__kind") == 3, 2).otherwise(1)
    made = rows.select(
        conv, turn, F.when(F.col("__kind") == 4, "user").otherwise(F.col(role)).alias(role), hurt.alias(text),
        F.explode(F.array_repeat(F.lit(0), times)).alias("__copy"),
    )
    return made.drop("__copy")
