"""DuckDB SQL that gives the rows of operators 11 and 12."""

URLS_SQL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, rest,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), site AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/') THEN 'org/'
  END AS rule,
  '.' || host || substr(rest, length(host) + 1) AS whole
  FROM parts
)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
  WHEN rule IS NOT NULL THEN 'block'
  WHEN regexp_matches(whole, '^([^/?#]*[.])free-bets[.].*/de/') THEN 'allow'
  WHEN regexp_matches(whole, '^([^/?#]*[.])(casino-win|ads-track|free-bets|spam-farm|cheap-pills)[.]') THEN 'block'
  WHEN regexp_matches(whole, '/en/.*[.]html([^0-9A-Za-z_.%-].*utm_source=)') THEN 'block'
  ELSE 'allow'
END AS verdict
FROM site
"""

# Levels that the SQL builds: enough for 16^5 documents a source and as many sources.
_LEVELS = 5


def _levels(name: str, keys: str) -> str:
    """CTEs `name`1 to `name`_LEVELS over `name`0 (keys, i, h, n); a tree of one node stays as it is."""
    made = []
    for k in range(1, _LEVELS + 1):
        by = f"{keys}, " if keys else ""
        made.append(
            f"{name}{k} AS (SELECT {by}i // 16 AS i, CASE WHEN any_value(n) = 1 THEN any_value(h) "
            f"ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h, (any_value(n) + 15) // 16 AS n "
            f"FROM {name}{k - 1} GROUP BY {by}i // 16)"
        )
    return ",\n".join(made)


def _runs(name: str, keys: str) -> str:
    """CTEs of the children of every node, as lists."""
    by = f"{keys}, " if keys else ""
    return ",\n".join(
        f"{name}r{k} AS (SELECT {by}i // 16 AS i, list(h ORDER BY i) AS hs, any_value(n) AS n FROM {name}{k} GROUP BY {by}i // 16)"
        for k in range(_LEVELS)
    )


def _climb(name: str, start: str, prefix: str, key: str) -> str:
    """CTEs that go up `name` level by level from `start` (doc_id, i, fold, proof, ...)."""
    made, before = [], start
    for k in range(_LEVELS):
        own = f"{prefix}{k}"
        on = f"c.{key} IS NOT DISTINCT FROM r.{key} AND " if key else ""
        made.append(
            f"{own} AS (SELECT c.* REPLACE (c.i // 16 AS i, "
            f"CASE WHEN r.n = 1 THEN c.fold ELSE sha256(array_to_string(r.hs[:c.i % 16] || [c.fold] || r.hs[c.i % 16 + 2:], '')) END AS fold, "
            f"CASE WHEN r.n = 1 THEN c.proof ELSE c.proof || array_to_string(r.hs[:c.i % 16] || r.hs[c.i % 16 + 2:], '') END AS proof) "
            f"FROM {before} c JOIN {name}r{k} r ON {on}r.i = c.i // 16)"
        )
        before = own
    return ",\n".join(made)


_FIELD = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{0}")) + ")"
# crc32 as its definition has it: a byte at a time, eight shifts each
_CRC = """
crc AS (SELECT list(v ORDER BY b) AS t FROM (
  SELECT b, list_reduce([b] || range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v
  FROM (SELECT unnest(range(256)) AS b)
)),
ids AS (SELECT doc_id, xor(4294967295, list_reduce([4294967295] || list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT),
  lambda c, b: xor(c // 256, t[(xor(c, b) & 255) + 1]))) % 5 = 0 AS tampered
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL), crc)
"""
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

MANIFEST_SQL = f"""
WITH {_CRC},
leaves AS (
  SELECT d.doc_id, d.source, {_LEAF.format("text")} AS leaf,
    CASE WHEN coalesce(tampered, false) THEN {_LEAF.format(_LOWER)} ELSE {_LEAF.format("text")} END AS claim
  FROM (SELECT * FROM documents) d LEFT JOIN ids USING (doc_id)
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
    count(*) OVER (PARTITION BY source) AS n FROM leaves
),
s0 AS (SELECT source, i, leaf AS h, n FROM placed),
{_levels("s", "source")},
{_runs("s", "source")},
t0 AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, h, count(*) OVER () AS n FROM s{_LEVELS}),
{_levels("t", "")},
{_runs("t", "")},
start AS (SELECT doc_id, source, leaf, i, claim AS fold, '' AS proof FROM placed),
{_climb("s", "start", "a", "source")},
mid AS (SELECT a.doc_id, a.source, a.leaf, t0.h AS subroot, t0.i AS i, a.fold, a.proof
  FROM a{_LEVELS - 1} a JOIN t0 ON t0.source IS NOT DISTINCT FROM a.source),
{_climb("t", "mid", "b", "")}
SELECT b.doc_id, b.leaf, b.subroot, r.h AS root, sha256(b.proof) AS proof_sha256, b.fold AS folded_root, b.fold = r.h AS verified
FROM b{_LEVELS - 1} b, (SELECT h FROM t{_LEVELS}) r
"""
