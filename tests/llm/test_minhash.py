from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import words
from tributary.llm import minhash, tokens
from tributary.llm.components import components


def brute_force(rows, percent=75):
    sets = []
    for _, text in rows:
        w = words(text)
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    smallest = {}
    for i, (doc_id, _) in enumerate(rows):
        smallest[find(i)] = min(smallest.get(find(i), doc_id), doc_id)
    return sorted((doc_id, len(sets[i]), smallest[find(i)], doc_id == smallest[find(i)]) for i, (doc_id, _) in enumerate(rows))


def collection(seed):
    """Groups that are near copies of a base, chains in which only neighbours are linked, and others."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(4):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(30, 80))]
        for _ in range(12):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append(" ".join(copy))
    chain = [rng.choice(vocabulary) for _ in range(60)]
    for _ in range(10):
        rows.append(" ".join(chain))
        chain = chain[3:] + [rng.choice(vocabulary) for _ in range(3)]
    rows += [" ".join(rng.choice(vocabulary) for _ in range(40)) for _ in range(10)]
    rows += ["", "  \n ", "one two", "ONE  two", "one", rows[0], rows[0].upper(), "é è ê ë ö", "É è ê ë ö"]
    order = list(range(len(rows)))
    rng.shuffle(order)
    return list(zip(order, rows, strict=True))


@pytest.mark.parametrize("seed, stars, block", [(1, 2, 256), (2, 1, 3)])
def test_like_brute_force(documents, seed, stars, block):
    rows = collection(seed)
    found = minhash.near_duplicates(documents(rows), star_rounds=stars, block=block)
    assert sorted(map(tuple, found.collect())) == brute_force(rows)


def test_nulls_repeated_rows_and_empty_tables(documents):
    text = "a b c d e f g"
    found = minhash.near_duplicates(documents([(1, None), (2, text), (2, text), (None, text), (5, text), (7, "")])).collect()
    assert sorted(map(tuple, found), key=str) == sorted(
        [(1, 0, 1, True), (2, 3, 2, True), (2, 3, 2, True), (None, 3, None, True), (5, 3, 2, False), (7, 0, 7, True)], key=str
    )
    assert minhash.near_duplicates(documents([])).collect() == []


def test_min_and_max_estimate_the_similarity():
    shingles = tokens.mix(np.arange(3000, dtype=np.uint64))
    a, b = minhash.min_max(shingles[:2000], 128), minhash.min_max(shingles[500:2500], 128)
    assert len(a) == 256 and abs((a == b).mean() - 1500 / 2500) < 0.1


def test_words_of_a_long_text_and_of_short_ones():
    long = " ".join(f"Wört{i % 7}" for i in range(600_000))
    texts = ["a B", "", None, long, "b c\ta", "A"]
    hashes, offsets = tokens.word_hashes(pa.array(texts, pa.string()))
    counts = np.diff(offsets).tolist()
    assert counts == [len(words(t)) for t in texts]
    assert len(np.unique(hashes[offsets[3] : offsets[4]])) == 7
    assert hashes[0] == hashes[-1] and hashes[1] != hashes[0]


def test_components_like_a_loop(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(40)] + [(200, 200)]
    links += [(rng.randint(300, 360), rng.randint(300, 360)) for _ in range(40)]
    frame = spark.createDataFrame(links, "a BIGINT, b BIGINT")
    groups = {}
    for row in components(frame).collect():
        groups.setdefault(row["component"], set()).add(row["node"])
    want = {}
    for a, b in links:
        merged = want.get(a, {a}) | want.get(b, {b})
        for x in merged:
            want[x] = merged
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, {frozenset(s) for s in want.values()}))
