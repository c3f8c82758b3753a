"""URL filters, the manifest and conversation repair, against plain Python."""

from __future__ import annotations

import functools
import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest

import __spark_entry__ as spark_entry
from check import TABLES, rows_of
from pyspark.sql import functions as F
from tests.llm.conftest import LOWER
from tributary.llm import merkle, queries, turns, urls


@pytest.mark.parametrize("name", ["op11_url_filters", "op12_merkle_manifest"])
def test_query_like_its_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    frame, relation = spark_entry.queries()[name](spark, folder), db.sql(spark_entry.oracle_sql()[name])
    assert rows_of(frame.columns, [tuple(r) for r in frame.collect()]) == rows_of(relation.columns, relation.fetchall())


# --- url filters --------------------------------------------------------------

RULES = [
    ("site", "org/", "allow"), ("site", "example.org/es/", "block"), ("site", "example.org/en/1", "block"),
    ("site", "COM/fr/", "allow"), ("site", "plain.net", "block"), ("pattern", "||farm.*^ads^", "block"),
    ("pattern", "|shop.net/", "allow"), ("pattern", "*.exe|", "block"), ("pattern", "track", "block"),
    ("pattern", "/a(b/", "block"), ("pattern", None, "block"),
]
CASES = {
    "http://a.example.org/es/x": ("example.org/es/", "block"),
    "http://A.EXAMPLE.ORG/en/17?x#y": ("example.org/en/1", "block"),
    "http://example.org/EN/1": ("org/", "allow"),
    "http://badexample.org/es/": ("org/", "allow"),
    "http://example.org": (None, "allow"),  # no path, so it does not start with /
    "http://example.org:80/es/": (None, "allow"),
    "x://y.com/fr/track": ("COM/fr/", "allow"),
    "x://plain.net": ("plain.net", "block"),
    "x://my.plain.net?q": ("plain.net", "block"),
    "x://plain.net.uk/": (None, "allow"),
    "x://www.farm.de/x/ads": ("||farm.*^ads^", "block"),
    "x://www.farm.de/x/ads-1": (None, "allow"),  # "-" does not end a part
    "x://shop.net/track/a.exe": ("|shop.net/", "allow"),
    "x://www.shop.net/a.exe": ("*.exe|", "block"),
    "x://z/xtracky": ("track", "block"),
    "x://z/a(b/": ("/a(b/", "block"),
    "x://z/\u00e9?http://example.org/es/": (None, "allow"),
    "no scheme track": (None, "allow"),
    "": (None, "allow"),
    None: (None, "allow"),
    "x://": (None, "allow"),
    "x://z/" + "a" * 200_000 + ".exe": ("*.exe|", "block"),
}


@pytest.mark.parametrize("in_memory", [urls.IN_MEMORY, 700])
def test_urls_are_judged(spark, monkeypatch, in_memory):
    monkeypatch.setattr(urls, "IN_MEMORY", in_memory)  # 700 bytes hold the rules without a token, not all of them
    rows = [(i, u, "h", "k") for i, u in enumerate(list(CASES) * 2)]
    pages = spark.createDataFrame(rows, "page_id INT, url STRING, host STRING, judged STRING")
    rules = spark.createDataFrame(RULES, urls.RULE_SCHEMA)
    found = urls.judge(pages, rules).collect()
    assert sorted(r.page_id for r in found) == list(range(len(rows)))
    for r in found:
        assert (r.judged.rule, r.judged.verdict) == CASES[r.url], r.url
        assert r.host == "h"
        rest = (r.url or "").partition("://")[2]
        host = re.match("[^/?#]*", rest).group()
        assert (r.judged.host, r.judged.path) == (host.translate(LOWER), re.match("[^?#]*", rest[len(host) :]).group())
    assert urls.judge(pages.limit(0), rules).collect() == []
    assert {r.judged.verdict for r in urls.judge(pages, rules.limit(0)).collect()} == {"allow"}


def test_rules_are_filed_by_their_rarest_token(spark):
    rules = urls.compiled(spark.createDataFrame(RULES, urls.RULE_SCHEMA))
    pages = spark.createDataFrame([("//a.org/en",), ("//example.org/",), ("//b.com/fr/",), ("//c.com/",)], "subject STRING")
    tokens = {r.text: r.token for r in urls.filed(rules, pages).collect()}
    assert tokens["example.org/en/1"] in ("en", "example") and tokens["COM/fr/"] == "fr" and tokens["org/"] == "org"
    assert tokens["track"] is None and tokens["*.exe|"] == "exe" and None not in tokens
    with pytest.raises(ValueError):
        urls.compile_rule("host", "a/", "block")


# --- manifest -----------------------------------------------------------------


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([H(*last[i : i + 16]) for i in range(0, len(last), 16)])
    return levels


def leaf(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def manifest_by_hand(rows):
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    of = {s: sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for s in sources}
    trees = {s: levels_of([leaf(r) for r in of[s]]) for s in sources}
    top = levels_of([trees[s][-1][0] for s in sources])
    out = []
    for k, source in enumerate(sources):
        for i, row in enumerate(of[source]):
            hurt = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None
            claim = leaf((*row[:4], row[4].translate(LOWER))) if hurt else leaf(row)
            siblings = []
            for levels, at in ((trees[source], i), (top, k)):
                for level in levels[:-1]:
                    run, slot = level[at // 16 * 16 :][:16], at % 16
                    siblings += run[:slot] + run[slot + 1 :]
                    claim, at = H(*run[:slot], claim, *run[slot + 1 :]), at // 16
            root = top[-1][0]
            out.append((row[0], leaf(row), trees[source][-1][0], root, H(*siblings), claim, claim == root))
    return out


TABLES_OF_DOCUMENTS = {
    "empty": [],
    "one": [(1, None, None, None, None)],
    "one source": [(i, "a", "en", i, f"T{i}") for i in range(40)],
    "repeats and nulls": [(i % 40, None if i % 3 else "", "en", i % 7, "T\u00c9" * (i % 11)) for i in range(700)]
    + [(5, f"s{i}", "l", None, "X") for i in range(300)] + [(None, "s1", None, 1, None)] * 3 + [(7, "s2", "l", 1, "Q" * 100_000)],
}


@pytest.mark.parametrize("name", TABLES_OF_DOCUMENTS)
def test_manifest_like_plain_python(spark, tmp_path, name):
    rows = TABLES_OF_DOCUMENTS[name]
    schema = "doc_id BIGINT, source STRING, lang STRING, n_chars BIGINT, text STRING, tree STRING, place INT"
    spark.createDataFrame([(*r, "t", 1) for r in rows], schema).write.parquet(f"{tmp_path}/documents.parquet")
    found = [tuple(r) for r in queries.op12(spark, str(tmp_path)).collect()]
    assert sorted(found, key=str) == sorted(manifest_by_hand(rows), key=str)


def test_manifest_climbs_by_a_recursive_query_without_python(spark, plan_of):
    rows = [(i, "a", f"T{i}") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, source STRING, text STRING")
    manifest = merkle.build(docs, ["doc_id", "text"], "doc_id", "source")
    climb = spark.sql(merkle.CLIMB, anchors=manifest.leaves.selectExpr(
        "up_tree AS tree", "up_level AS level", "up_place AS place",
        "array(struct(key, slot, slot AS first_slot, claim AS fold)) AS claims"), nodes=manifest.nodes)
    assert "UnionLoop" in plan_of(climb) and "Python" not in plan_of(climb)
    assert climb.count() == 20
    assert all(r.verified for r in merkle.verify(manifest).collect())


def test_places_count_on_over_tasks(spark):
    from tributary.llm.places import with_places

    rows = [("hot", 1, i) for i in range(900)] + [("b", i % 5, i) for i in range(90)] + [(None, None, 7)]
    frame = spark.createDataFrame(rows, "g STRING, k INT, __n BIGINT")
    placed = with_places(frame, ["g"], [F.col("k").asc_nulls_first()], "test-places").collect()
    for group in ("hot", "b", None):
        mine = sorted((r for r in placed if r.g == group), key=lambda r: r.place)
        assert [r.place for r in mine] == list(range(len(mine))) and len(mine) in (900, 90, 1)
        assert [r.k for r in mine] == sorted((r.k for r in mine), key=lambda k: k or 0)


# --- conversations ------------------------------------------------------------

NOTHING = hashlib.sha256().hexdigest()


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        out += [(conv, turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def faults_of(rows):
    seen, found = set(), []
    for _, _, role, text in rows:
        words = re.sub(r"[\x20\x09-\x0D]", "", text)
        found.append("b" if not words else "d" if (role, text) in seen else "" if words[-1] in ".!?" else "t")
        seen.add((role, text))
    return found


def best_edits(rows, faults):
    """Tuples (cost, letters, lines) from each row and state to the end, by recursion."""
    after = {"-": "su", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    @functools.cache
    def best(i, state, inserted):
        ways = [(0, "", ())] if i == len(rows) and state in "-a" else []
        if inserted < 2:
            for role in after[state].replace("s", ""):
                if rest := best(i, role, inserted + 1):
                    ways.append((rest[0] + 2, "I" + rest[1], (f"{names[role]}:", *rest[2])))
        if i < len(rows):
            _, _, role, text = rows[i]
            if rest := best(i + 1, state, 0):
                ways.append((rest[0] + 3, "D" + rest[1], rest[2]))
            if faults[i] in ("", "t"):
                for to in after[state]:
                    rest = best(i + 1, to, 0)
                    if rest and role[:1] == to:
                        ways.append((rest[0] + (faults[i] == "t"), "K" + rest[1], (f"{role}:{text}", *rest[2])))
                    if rest and to != "s":
                        ways.append((rest[0] + 2 + (faults[i] == "t"), "R" + rest[1], (f"{names[to]}:{text}", *rest[2])))
        return min(ways, default=None)

    return best(0, "-", 0)


def repaired_by_hand(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        mine = [r for r in damaged(rows) if r[0] == conv]
        mine.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
        faults = faults_of(mine)
        cost, letters, lines = best_edits(mine, faults)
        numbers = [r[1] for r in mine if r[1] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:], strict=False))
        counts = [faults.count(f) for f in "bdt"]
        out[conv] = (gaps, *counts, illegal, cost, letters, H("\n".join(lines)))
    return out


def conversations(seed, count, longest):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "why", "  ", "", "a b. \t", "long " * 50 + "?", "\u00e9", None, "x.\u00a0"]
    roles = ["user", "assistant", "system", "tool", "", None, "User", "ux"]
    rows = []
    for conv in range(count):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(roles) if rng.random() < 0.2 else ("user", "assistant")[turn % 2]
            text = rng.choice(texts) if rng.random() < 0.4 else f"t{rng.randint(0, 9)}."
            rows.append((None if conv == 0 else conv, None if rng.random() < 0.03 else turn + (rng.random() < 0.1), role, text))
    return rows


SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING, block STRING, place INT"


def run_repair(spark, folder, rows):
    spark.createDataFrame([(*r, "b", 1) for r in rows], SCHEMA).write.parquet(f"{folder}/conversations.parquet")
    return {r[0]: tuple(r)[1:] for r in queries.op13(spark, str(folder)).collect()}


@pytest.mark.parametrize("block", [256, 3, 1])
def test_repair_like_plain_python(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(turns, "BLOCK", block)
    rows = conversations(block, 120, 14)
    found, wanted = run_repair(spark, tmp_path, rows), repaired_by_hand(rows)
    assert found.keys() == wanted.keys()
    for conv in wanted:
        assert found[conv] == wanted[conv], [r for r in damaged(rows) if r[0] == conv]


def test_repair_of_edges(spark, tmp_path):
    gone = next(i for i in range(100, 999) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = [(gone, 0, "user", "a."), (1, None, "user", "a.")]
    rows += [(2, i, "user" if i % 2 == 0 else "assistant", f"{i}." + "x" * 2000 + "!") for i in range(700)]
    found, wanted = run_repair(spark, tmp_path, rows), repaired_by_hand([r for r in rows if r[0] != 2])
    assert found[gone] == (0, 0, 0, 0, 0, 0, "", NOTHING)
    assert found[1] == wanted[1] and len(found) == 3
    assert len(found[2][6]) >= 600 and found[2][5] > 0
    assert run_repair(spark, tmp_path / "none", []) == {}


def test_least_weight_of_all_edits():
    """Every string of edits of short conversations, tried out."""
    kinds = [("u", ""), ("a", ""), ("s", ""), ("u", "t"), ("a", "b"), ("x", ""), ("u", "d")]
    for rows in [r for n in range(4) for r in itertools.product(kinds, repeat=n)]:
        best = None
        for inserts in itertools.product(range(3), repeat=len(rows) + 1):
            for letters in itertools.product("DKR", repeat=len(rows)):
                text = "".join("I" * k + c for k, c in zip(inserts, [*letters, ""], strict=True))
                if best and (cost := priced(text, rows)) is not None:
                    best = min(best, (cost, text))
                elif not best and (cost := priced(text, rows)) is not None:
                    best = (cost, text)
        width = turns.width_of(len(rows))
        weight = turns.block_weights(list(rows), turns.FINAL)["-"]
        assert (weight >> 3 * width, turns.letters_of(weight, width)) == best, rows


def priced(text, rows):
    states, cost, at = "-", 0, 0
    after = {"-": "su", "s": "u", "u": "a", "a": "u"}
    state = states
    for letter in text:
        initial, fault = rows[at] if at < len(rows) and letter != "I" else ("", "")
        if letter in "KR" and fault in ("b", "d"):
            return None
        if letter == "K":
            if initial not in after[state] or initial == "":
                return None
            state = initial
        elif letter in "RI":
            state = after[state][-1]
        cost += {"K": 0, "R": 2, "D": 3, "I": 2}[letter] + (fault == "t" and letter in "KR")
        at += letter != "I"
    return cost if state in "-a" else None
