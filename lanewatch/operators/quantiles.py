"""Exact quantiles of many columns and groups without bringing a group's values together.

A quantile (linear interpolation at rank (n - 1) q) needs one or two order statistics.
Values are unpivoted to (id, x), id being (group, column), and ranks are found by
counting in ranges: a mergeable sketch (``percentile_approx``) proposes border values
around each wanted rank, one pass counts the values below and at every border exactly, and
a rank either falls on a border or strictly between two neighbours. Between two borders
lie about 4 / accuracy of the values, ties of a border excluded, so one value that holds
most rows ends the search instead of blocking it. At most ``cap`` values of a range are
sorted; a range with more is searched again in the same way. Every pass is a partial aggregation;
nothing but the borders, counts and at most ``cap`` values an id is shuffled.

Whole columns (``quantiles``) need no tables for this: borders and counts of a few columns are numbers
that the driver holds, and every pass is one job.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanewatch.session import keep

ACCURACY = 10_000
CAP = 50_000
GRID = [k / 16 for k in range(1, 16)]


def unpivoted(df: DataFrame, values: dict[str, Column], by: tuple[str, ...] = ()) -> DataFrame:
    """(id, x): id holds the group and the column's number ``c``; nulls are left out."""
    pairs = F.array(*[F.struct(F.lit(i).alias("c"), F.col(v).cast("double").alias("x") if isinstance(v, str)
                               else v.cast("double").alias("x")) for i, v in enumerate(values.values())])
    return (df.select(*by, F.explode(pairs).alias("_v")).select(F.struct(*by, F.col("_v.c").alias("c")).alias("id"),
                                                                F.col("_v.x").alias("x")).filter("x IS NOT NULL"))


def _sorted_values(values: DataFrame, ranks: DataFrame) -> DataFrame:
    """(id, r, value) by sorting; every id has at most ``cap`` values."""
    own = values.groupBy("id").agg(F.sort_array(F.collect_list("x")).alias("v"))
    return ranks.join(own, "id").select("id", "r", F.get("v", F.col("r").cast("int")).alias("value"))


def order_statistics(values: DataFrame, ranks: DataFrame, sizes: DataFrame, fractions: list[float], largest: int,
                     accuracy: int = ACCURACY, cap: int = CAP) -> DataFrame:
    """(id, r, value): the r-th least x (from 0) of each id for ``ranks`` (id, r); ``sizes`` has (id, n), ``largest`` its maximum.

    ``fractions`` are where the sketch puts borders: near the wanted ranks, if these are at fixed fractions.
    """
    if largest <= cap:
        return _sorted_values(values, ranks)
    few = sizes.filter(F.col("n") <= cap).select("id")
    done = _sorted_values(values.join(few, "id", "left_semi"), ranks.join(few, "id", "left_semi"))
    many = sizes.filter(F.col("n") > cap).select("id")
    values, ranks = values.join(many, "id", "left_semi"), ranks.join(many, "id", "left_semi")
    # borders: least, proposed, largest
    sketch = F.percentile_approx("x", fractions, accuracy)
    borders = keep(values.groupBy("id").agg(F.min("x").alias("lo"), F.max("x").alias("hi"), sketch.alias("s"))
                   .select("id", F.array_sort(F.array_distinct(F.concat(F.array("lo"), "s", F.array("hi")))).alias("s")))
    m = len(fractions) + 2
    at = [F.get("s", F.lit(j)) for j in range(m)]
    counted = values.join(borders, "id").groupBy("id", "s").agg(
        F.array(*[F.count_if(F.col("x") < b) for b in at]).alias("below"),
        F.array(*[F.count_if(F.col("x") == b) for b in at]).alias("equal"))
    # the last border with no more than r values below it
    r, n = F.col("r"), F.size("s")
    j = F.aggregate(F.sequence(F.lit(1), n - 1), F.lit(0),
                    lambda best, k: F.when(F.get("below", k) <= r, k).otherwise(best))
    place = F.when(n == 1, F.lit(0)).otherwise(j)
    found = keep(ranks.join(counted, "id").withColumn("j", place).select(
        "id", "r", F.get("s", F.col("j")).alias("a"), F.get("s", F.col("j") + 1).alias("b"),
        (F.get("below", F.col("j")) + F.get("equal", F.col("j"))).alias("upto"),
        F.get("below", F.col("j") + 1).alias("next")))
    on_border = found.filter(F.col("r") < F.col("upto")).select("id", "r", F.col("a").alias("value"))
    between = found.filter(F.col("r") >= F.col("upto"))
    ranges = between.groupBy("id", "a", "b", "upto").agg((F.first("next") - F.col("upto")).alias("n"))
    # strictly between two borders: the same task on fewer values
    inner_id = F.struct("id", "a").alias("id")
    inner = values.join(ranges.drop("n"), "id").filter((F.col("x") > F.col("a")) & (F.col("x") < F.col("b"))).select(inner_id, "x")
    inner_ranks = between.select(inner_id, (F.col("r") - F.col("upto")).alias("r"))
    inner_sizes = keep(ranges.select(inner_id, "n"))
    most = inner_sizes.agg(F.max("n")).first()[0]
    done = done.unionByName(on_border)
    if most is None:
        return done
    rest = order_statistics(keep(inner), inner_ranks, inner_sizes, GRID, most, accuracy, cap)
    back = between.select(F.col("id").alias("_id"), F.col("r").alias("_r"), F.struct("id", "a").alias("id"),
                          (F.col("r") - F.col("upto")).alias("r"))
    return done.unionByName(back.join(rest, ["id", "r"]).select(F.col("_id").alias("id"), F.col("_r").alias("r"), "value"))


def quantiles_by(df: DataFrame, values: dict[str, Column | str], qs: list[float], by: tuple[str, ...] = (), *,
                 at_most: int | None = None, accuracy: int = ACCURACY, cap: int = CAP) -> DataFrame:
    """by..., column, n, q (the quantiles in the order of ``qs``) for every group and column with values.

    ``at_most``: a bound on the rows of a group that the caller knows already (saves a counting pass).
    """
    long = unpivoted(df, values, by)
    sizes = long.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    if at_most is None or at_most > cap:
        sizes = keep(sizes)
        largest = sizes.agg(F.max("n")).first()[0] or 0
    else:
        largest = at_most
    if largest <= cap:
        got = long.groupBy("id").agg(F.sort_array(F.collect_list("x")).alias("v")).withColumn("n", F.size("v").cast("bigint"))
        at = lambda k: F.get("v", k.cast("int"))
    else:
        wanted = F.array_distinct(F.flatten(F.array(*[F.array(_lower(q), _upper(q)) for q in qs])))
        ranks = sizes.select("id", F.explode(wanted).alias("r"))
        near = 2.0 / accuracy
        fractions = sorted({min(1.0, max(0.0, f)) for q in qs for f in (q - near, q + near)})
        found = order_statistics(long, ranks, sizes, fractions, largest, accuracy, cap)
        got = found.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("r", "value"))).alias("v")).join(sizes, "id")
        at = lambda k: F.element_at("v", k)
    names = F.array(*[F.lit(c) for c in values])
    return got.select(*[F.col("id")[c].alias(c) for c in by], F.get(names, F.col("id.c")).alias("column"), "n",
                      F.array(*[_between(q, at) for q in qs]).alias("q"))


def _lower(q: float) -> Column:
    return F.floor((F.col("n") - 1) * F.lit(float(q))).cast("bigint")


def _upper(q: float) -> Column:
    return F.ceil((F.col("n") - 1) * F.lit(float(q))).cast("bigint")


def _between(q: float, at) -> Column:
    """Linear interpolation between the order statistics around rank (n - 1) q."""
    p, lo, hi = (F.col("n") - 1) * F.lit(float(q)), _lower(q), _upper(q)
    return F.when(lo == hi, at(lo)).otherwise((hi - p) * at(lo) + (p - lo) * at(hi))


@dataclass
class _Range:
    """The values of column ``c`` strictly between two borders (None: all): how many, how many of the column come before, the ranks looked for."""

    c: int
    a: float | None
    b: float | None
    n: int
    before: int
    ranks: list[int]
    borders: list[float] | None = None


def _inside(long: DataFrame, ranges: list[_Range]) -> DataFrame:
    """(g, x): the values of every range; g is its number."""
    of = {c: [i for i, g in enumerate(ranges) if g.c == c] for c in range(1 + max(g.c for g in ranges))}
    ends = F.array(*[F.array(*[F.struct(F.lit(i).alias("g"), F.lit(ranges[i].a).cast("double").alias("a"), F.lit(ranges[i].b).cast("double").alias("b"))
                               for i in own]) if own else F.lit(None).cast("array<struct<g:int,a:double,b:double>>") for own in of.values()])
    x = F.col("x")
    inside = F.filter(F.get(ends, F.col("c")), lambda s: F.coalesce(x > s["a"], F.lit(True)) & F.coalesce(x < s["b"], F.lit(True)))
    return long.select(F.explode(inside).alias("_r"), "x").select("_r.g", "x")


def _sketch(fractions: list[float], accuracy: int) -> Column:
    """Border values: least, proposed, largest."""
    near = F.percentile_approx("x", fractions, accuracy)
    return F.array_sort(F.array_distinct(F.concat(F.array(F.min("x")), near, F.array(F.max("x"))))).alias("s")


def _ranked(long: DataFrame, ranges: list[_Range], accuracy: int, cap: int) -> dict[tuple[int, int], float]:
    """(c, rank) -> value; ``long`` has (c, x)."""
    found = {}
    while ranges:
        small, large = [g for g in ranges if g.n <= cap], [g for g in ranges if g.n > cap]
        ranges = []
        if small:
            places = F.get(F.array(*[F.array(*[F.lit(r - g.before) for r in g.ranks]) for g in small]), F.col("g"))
            rows = _inside(long, small).groupBy("g").agg(F.sort_array(F.collect_list("x")).alias("v"))
            for r in rows.select("g", F.transform(places, lambda i: F.get("v", i)).alias("v")).collect():      # a number a rank
                found |= {(small[r["g"]].c, k): v for k, v in zip(small[r["g"]].ranks, r["v"])}
        unknown = [g for g in large if g.borders is None]
        if unknown:
            for r in _inside(long, unknown).groupBy("g").agg(_sketch(GRID, accuracy)).collect():
                unknown[r["g"]].borders = list(r["s"])
        if not large:
            continue
        of = F.get(F.array(*[F.array(*[F.lit(b) for b in g.borders]) for g in large]), F.col("g"))
        at = [F.get(of, F.lit(j)) for j in range(max(len(g.borders) for g in large))]
        counted = _inside(long, large).groupBy("g").agg(F.array(*[F.count_if(F.col("x") < b) for b in at]).alias("below"),
                                                        F.array(*[F.count_if(F.col("x") == b) for b in at]).alias("equal"))
        for r in counted.collect():
            g, inner = large[r["g"]], {}
            for k in g.ranks:
                # the last border with no more than the rank's values below it
                j = max(i for i in range(len(g.borders)) if i == 0 or r["below"][i] <= k - g.before)
                upto = r["below"][j] + r["equal"][j]
                if k - g.before < upto:
                    found[g.c, k] = g.borders[j]
                    continue
                inner.setdefault(j, _Range(g.c, g.borders[j], g.borders[j + 1], r["below"][j + 1] - upto, g.before + upto, [])).ranks.append(k)
            ranges += inner.values()
    return found


def quantiles(df: DataFrame, values: dict[str, Column | str], qs: list[float], *, at_most: int | None = None,
              exact: bool = True, accuracy: int = ACCURACY, cap: int = CAP) -> dict[str, list[float | None]]:
    """The quantiles of whole columns as Python numbers; None where a column has no values.

    ``exact=False``: one pass of the sketch alone.
    """
    names, rows = list(values), {}
    if exact and at_most is not None and at_most <= cap:
        rows = {r["column"]: list(r["q"]) for r in quantiles_by(df, values, qs, at_most=at_most, cap=cap).collect()}
    elif exact:
        long, near = unpivoted(df, values).select("id.c", "x"), 2.0 / accuracy
        fractions = sorted({min(1.0, max(0.0, f)) for q in qs for f in (q - near, q + near)})
        heads = {r["c"]: r for r in long.groupBy("c").agg(F.count(F.lit(1)).alias("n"), _sketch(fractions, accuracy)).collect()}
        places = {c: [(r["n"] - 1) * float(q) for q in qs] for c, r in heads.items()}
        found = _ranked(long, [_Range(c, None, None, r["n"], 0, sorted({f(p) for p in places[c] for f in (math.floor, math.ceil)}), list(r["s"]))
                               for c, r in heads.items()], accuracy, cap)
        for c, at in places.items():
            ends = [(p, math.floor(p), math.ceil(p)) for p in at]
            rows[names[c]] = [found[c, lo] if lo == hi else (hi - p) * found[c, lo] + (p - lo) * found[c, hi] for p, lo, hi in ends]
    else:
        long = unpivoted(df, values)
        rows = {names[r["c"]]: list(r["q"]) for r in long.groupBy("id.c").agg(
            F.percentile_approx("x", qs, ACCURACY).alias("q")).collect()}
    return {c: rows.get(c, [None] * len(qs)) for c in values}
