"""URL filters: pattern rules that are looked up by their rarest literal token.

Two kinds of rules, as rows (kind, text, action):

- `site`: a host and a path, as `example.org/en/`. It fits the host and its subdomains if the path of a URL
  starts with the rule's. Of those that fit the longest decides, before any pattern.
- `pattern`: a filter with `*` for any text, `^` for a separator or the end, `||` in front for the start of a
  host or of one of its labels, `|` for the start or the end. Of those that fit an `allow` decides before any
  `block`, then the longest.

Ties go to the smaller text. A rule becomes a regular expression and the set of tokens (runs of letters and
digits) that every URL it fits must hold whole. It is filed under the one of them that the fewest URLs hold.
A URL is cut into its tokens, these fetch the rules filed under them, and only those run their expressions.
Rules without such a token run on every URL.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm.common import written

RULE_SCHEMA = "kind STRING, text STRING, action STRING"
COMPILED = "kind STRING, text STRING, action STRING, weight BIGINT, expression STRING, tokens ARRAY<STRING>"
IN_MEMORY = 64 << 20  # bytes of compiled rules that every task may hold
TOKEN = "[0-9A-Za-z]+"
HOST_START = r"//(?:[^/?#]*\.)?"
WEIGHTS = {("site", "allow"): 1 << 40, ("site", "block"): 1 << 40, ("pattern", "allow"): 1 << 39, ("pattern", "block"): 0}


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host is what follows the first `://` up to `/`, `?`, `#` or the end, with A-Z lowered; the path goes up to
    `?`, `#` or the end. Both are empty for a null and where there is no `://`."""
    rest = _rest(url)
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.locate("://", F.coalesce(url, F.lit("")))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def subject(url: Column) -> Column:
    """What expressions see: `//`, the host in lower case, and the rest as it is."""
    rest = _rest(url)
    return F.concat(F.lit("//"), host_and_path(url)[0], F.regexp_replace(rest, "^[^/?#]*", ""))


def _whole_tokens(text: str, start: bool, end: bool) -> list[str]:
    """The tokens of a pattern that stand whole in what it fits: nothing can go on before or after them."""
    found = []
    for run in re.finditer(TOKEN, text):
        opens = start if run.start() == 0 else text[run.start() - 1] != "*"
        closes = end if run.end() == len(text) else text[run.end()] != "*"
        if opens and closes:
            found.append(run.group())
    return sorted(set(found))


def compile_rule(kind: str, text: str, action: str) -> tuple[int, str, list[str]]:
    """(weight, expression, tokens) of a rule; an unknown kind or action is an error."""
    if (kind, action) not in WEIGHTS:
        raise ValueError(f"not a rule: {kind!r}, {text!r}, {action!r}")
    weight = WEIGHTS[kind, action] + len(text)
    if kind == "site":
        host = re.match("[^/]*", text).group().translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        path = text[len(host) :]
        # a rule without a path fits the whole host and nothing beside it
        after = re.escape(path) if path else r"(?=[/?#]|\Z)"
        tokens = set(re.findall(TOKEN, host)) | set(_whole_tokens(path.replace("*", "."), True, False))
        return weight, rf"\A{HOST_START}{re.escape(host)}{after}", sorted(tokens)
    body, end = (text[:-1], r"\Z") if text.endswith("|") and text != "|" else (text, "")
    if body.startswith("||"):
        body, start = body[2:], rf"\A{HOST_START}"
    elif body.startswith("|"):
        body, start = body[1:], r"\A//"
    else:
        start = ""
    marks = {"*": "(?s:.*)", "^": r"(?:[^0-9A-Za-z_.%-]|\Z)"}
    expression = start + "".join(marks.get(c) or re.escape(c) for c in body) + end
    return weight, expression, _whole_tokens(body, bool(start), bool(end))


def compiled(rules: DataFrame) -> DataFrame:
    """Rules as rows of COMPILED, each once; rows with a null do not count."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            made = [compile_rule(*r) for r in rows.itertuples(index=False)]
            yield rows.assign(weight=[m[0] for m in made], expression=[m[1] for m in made], tokens=[m[2] for m in made])

    known = rules.select("kind", "text", "action").dropna().distinct()
    return known.mapInPandas(run, COMPILED)


def filed(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """Compiled rules with `token`, the one of theirs that the fewest of `urls` (subject) hold; null if they have none.

    All URLs are counted, with partial counts per task, but only tokens of rules.
    """
    wanted = rules.select(F.explode("tokens").alias("token")).distinct()
    held = urls.select(F.explode(F.array_distinct(F.regexp_extract_all("subject", F.lit(TOKEN), F.lit(0)))).alias("token"))
    counts = held.join(wanted, "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("urls"))
    each = rules.select("kind", "text", "action", F.explode("tokens").alias("token")).join(counts, "token", "left")
    rarest = each.groupBy("kind", "text", "action").agg(
        F.min(F.struct(F.coalesce("urls", F.lit(0)).alias("urls"), "token")).getField("token").alias("token")
    )
    return rules.join(rarest, ["kind", "text", "action"], "left")


@dataclass(frozen=True)
class Index:
    """Rules by their token; the ones in force are found by `best`."""

    by_token: dict[str | None, list[tuple]]

    def best(self, text: str) -> tuple | None:
        """(-weight, text, kind, action) of the rule that decides on a subject, None if none fits."""
        tried = self.by_token.get(None, [])
        for token in set(re.findall(TOKEN, text)):
            tried = tried + self.by_token.get(token, [])
        fit = [rule[:4] for rule in tried if re.search(rule[4], text)]
        return min(fit, default=None)


def _index(rows: list) -> Index:
    by_token: dict[str | None, list[tuple]] = {}
    for r in rows:
        by_token.setdefault(r.token, []).append((-r.weight, r.text, r.kind, r.action, r.expression))
    return Index(by_token)


FOUND = "weight BIGINT, text STRING, kind STRING, action STRING"


def _as_rows(found: list[tuple | None]) -> pd.DataFrame:
    whole = [f or (None, None, None, None) for f in found]
    frame = pd.DataFrame(whole, columns=["weight", "text", "kind", "action"])
    return frame.astype({"weight": "Int64"})


def judge(urls: DataFrame, rules: DataFrame, url: str = "url", into: str = "judged") -> DataFrame:
    """All rows and columns, and `into`: struct(host, path, kind, rule, verdict).

    `kind` and `rule` name the rule that decided; without one they are null and the verdict is `allow`. A null URL,
    an empty one and one without `://` have an empty host and path, which no site rule fits. Rules that fit into
    IN_MEMORY go to every task and nothing is shuffled; others are joined to the tokens of URLs. A column
    that is named like `into` is replaced.
    """
    spark = urls.sparkSession
    host, path = host_and_path(F.col(url))
    known = written(compiled(rules), "url-rules")
    index = filed(known, urls.select(subject(F.col(url)).alias("subject")))
    length = F.length("text") + F.length("expression") + 100
    size = known.agg(F.coalesce(F.sum(length), F.lit(0))).first()[0]
    if size <= IN_MEMORY:
        found = _found_in_memory(spark, index)(subject(F.col(url)))
        judged = urls.withColumn("__found", found)
    else:
        best = _found_by_join(urls.select(subject(F.col(url)).alias("subject")), index)
        judged = urls.withColumn("__subject", subject(F.col(url)))
        judged = judged.join(best, "__subject", "left").drop("__subject")
    verdict = F.struct(
        host.alias("host"),
        path.alias("path"),
        F.col("__found.kind").alias("kind"),
        F.col("__found.text").alias("rule"),
        F.coalesce("__found.action", F.lit("allow")).alias("verdict"),
    )
    return judged.withColumn("__judged", verdict).drop("__found", into).withColumnRenamed("__judged", into)


def _found_in_memory(spark: SparkSession, rules: DataFrame):
    shared = spark.sparkContext.broadcast(_index(rules.collect()))

    @F.pandas_udf(FOUND)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        index = shared.value
        for texts in batches:
            seen = {text: index.best(text) for text in set(texts)}
            yield _as_rows([seen[text] for text in texts])

    return found


def _found_by_join(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(__subject, __found) of the subjects that a rule fits, each subject once."""
    subjects = urls.distinct()
    tokens = F.explode(F.array_distinct(F.regexp_extract_all("subject", F.lit(TOKEN), F.lit(0))))
    with_token = rules.where("token IS NOT NULL").drop("tokens")
    pairs = subjects.select("subject", tokens.alias("token")).join(with_token, "token").drop("token")

    @F.pandas_udf("boolean")
    def fits(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, expressions in batches:
            yield pd.Series([re.search(e, t) is not None for t, e in zip(texts, expressions, strict=True)], dtype=bool)

    rule = F.struct((-F.col("weight")).alias("weight"), "text", "kind", "action")
    found = pairs.where(fits("subject", "expression")).select("subject", rule.alias("found"))
    rest = rules.where("token IS NULL")
    size = rest.agg(F.coalesce(F.sum(F.length("expression")), F.lit(0))).first()[0]
    if size > IN_MEMORY:
        raise ValueError("too many rules without a token to look them up by")
    plain = _found_in_memory(urls.sparkSession, rest)("subject")
    others = subjects.select("subject", plain.alias("found")).where("found.text IS NOT NULL")
    both = found.unionByName(others)
    return both.groupBy(F.col("subject").alias("__subject")).agg(F.min("found").alias("__found"))
