"""URL filters: pattern rules indexed by their rarest literal token.

Every rule becomes one regular expression. Its literal tokens
(maximal runs of letters, digits and other word bytes) are counted over all urls;
the rarest one is the rule's key. A url's own tokens fetch the rules filed under
them, and only those run their expression; the longest rule that fits decides.

A rule ``host/path`` fits its host and all subdomains if the url's path starts
with the rule's. The last token of a rule's path can be the beginning of a longer
word in a url, so it serves as key only if the path ends behind it; a rule
without any usable token is tried on every url. The rule set is broadcast up to
``max_rules``; larger sets are cut into blocks that urls pass one after another.

Defined results: null urls and urls without ``://`` have empty host and path and
fit no rule; of rules of equal length the longer host, then the smaller text,
wins; a rule given twice counts once, block before allow; equal rows get equal
results; other columns are not carried.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lanewatch.llm.common import read, register

#: rules of the query: (verdict, host and path)
RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/")]
TOKEN = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
PY_TOKEN = re.compile(r"[0-9A-Za-z\x80-\U0010FFFF]+")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise(F.lit(""))
    rest = F.coalesce(F.regexp_replace(rest, r"(?s)[?#].*", ""), F.lit(""))
    host = F.regexp_replace(rest, r"(?s)/.*", "")
    return F.translate(host, UPPER, LOWER), F.substring(rest, F.char_length(host) + 1, F.char_length(rest))


class Rule:
    """One rule: text, verdict, expression over host + path, and the tokens that every fitting url holds."""

    def __init__(self, text: str, verdict: str):
        self.text, self.verdict = text, verdict
        host, slash, path = text.partition("/")
        self.host, self.path = host.translate(str.maketrans(UPPER, LOWER)), slash + path
        self.expression = re.compile(rf"(?:.*\.)?{re.escape(self.host)}", re.DOTALL)
        ends_in_token = bool(path) and PY_TOKEN.fullmatch(path[-1]) is not None
        in_path = PY_TOKEN.findall(self.path)
        self.tokens = sorted({*PY_TOKEN.findall(self.host), *(in_path[:-1] if ends_in_token else in_path)})
        # a host that starts inside a label cannot occur: subdomains end with a dot
        self.order = self.order_of(text)

    @staticmethod
    def order_of(text: str) -> tuple:
        """Of fitting rules the greatest wins: the longest, then the longer host, then the first in code points."""
        return len(text), text.find("/") if "/" in text else len(text), [-ord(c) for c in text]

    def fits(self, host: str, path: str) -> bool:
        return path.startswith(self.path) and self.expression.fullmatch(host) is not None


def _rules(rules: list[tuple[str, str]]) -> list[Rule]:
    chosen: dict[str, str] = {}
    for verdict, text in rules:
        if verdict not in ("allow", "block"):
            raise ValueError(f"verdict of {text!r}: {verdict!r}")
        chosen[text] = "block" if "block" in (verdict, chosen.get(text)) else "allow"
    return [Rule(text, verdict) for text, verdict in sorted(chosen.items())]


def token_counts(pages: DataFrame, wanted: list[str]) -> dict[str, int]:
    """How many urls hold each of the rules' tokens (counted over all urls; one number a wanted token)."""
    if not wanted:
        return {}
    spark = pages.sparkSession
    tokens = F.array_distinct(F.regexp_extract_all(F.concat_ws("\n", "host", "path"), F.lit(TOKEN), F.lit(0)))
    names = spark.createDataFrame([(t,) for t in wanted], "token string")
    found = pages.select(F.explode(tokens).alias("token")).join(F.broadcast(names), "token").groupBy("token").count()
    return {r["token"]: r["count"] for r in found.collect()}


def index(rules: list[Rule], counts: dict[str, int]) -> tuple[dict[str, list[Rule]], list[Rule]]:
    """Rules under their rarest token, and the rules that have none."""
    filed: dict[str, list[Rule]] = {}
    rest = []
    for r in rules:
        if r.tokens:
            filed.setdefault(min(r.tokens, key=lambda t: (counts.get(t, 0), t)), []).append(r)
        else:
            rest.append(r)
    return filed, rest


def judge(pages: DataFrame, rules: list[tuple[str, str]], *, page_id: str = "page_id", url: str = "url",
          default: str = "allow", max_rules: int = 200_000) -> DataFrame:
    """page_id, host, path, rule, verdict and tried (candidate rules whose expression ran) of every page."""
    spark = pages.sparkSession
    host, path = host_and_path(F.col(url))
    df = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    known = _rules(rules)
    counts = token_counts(df, sorted({t for r in known for t in r.tokens}))
    df = df.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default), "tried": F.lit(0).cast("long")})
    names = df.columns
    for at in range(0, len(known), max_rules):
        shared = spark.sparkContext.broadcast(index(known[at:at + max_rules], counts))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            filed, always = shared.value
            for batch in batches:
                rule, verdict = batch.column("rule").to_pylist(), batch.column("verdict").to_pylist()
                tried = batch.column("tried").to_pylist()
                for i, (h, p) in enumerate(zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True)):
                    if not h:
                        continue
                    near = [r for t in set(PY_TOKEN.findall(f"{h}\n{p}")) for r in filed.get(t, ())] + always
                    fits = [r for r in near if r.fits(h, p)]
                    tried[i] += len(near)
                    if fits:
                        best = max(fits, key=lambda r: r.order)
                        if rule[i] is None or best.order > Rule.order_of(rule[i]):      # the best of earlier blocks is its text
                            rule[i], verdict[i] = best.text, best.verdict
                yield pa.RecordBatch.from_arrays(
                    [batch.column("page_id"), batch.column("host"), batch.column("path"), pa.array(rule, pa.string()),
                     pa.array(verdict, pa.string()), pa.array(tried, pa.int64())], names)

        df = df.mapInArrow(run, df.schema)
    return df


SQL = r"""
WITH u AS (
  SELECT page_id, coalesce(CASE WHEN position('://' IN url) > 0 THEN
           regexp_extract(substr(url, position('://' IN url) + 3), '^[^?#]*') END, '') AS rest FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         substr(rest, length(regexp_extract(rest, '^[^/]*')) + 1) AS path FROM u),
r(verdict, rule, h, q) AS (VALUES ('allow', 'com/', 'com', '/'), ('block', 'example.com/en/', 'example.com', '/en/'),
  ('allow', 'www.example.com/en/', 'www.example.com', '/en/'), ('block', 'net/es/', 'net', '/es/'), ('block', 'net/fr/', 'net', '/fr/')),
f AS (
  SELECT p.*, r.rule, r.verdict, row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.rule) DESC) AS k
  FROM p LEFT JOIN r ON (p.host = r.h OR p.host LIKE '%.' || r.h) AND starts_with(p.path, r.q))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM f WHERE k = 1
"""


@register("op10_url_filters", SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "pages"), RULES).drop("tried")
