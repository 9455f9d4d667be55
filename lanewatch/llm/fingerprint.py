"""Document fingerprints from closed syncmers, in DataFrame functions only.

A text's symbols are its words (runs outside white space, letters lower-cased), or
its characters (white space as one blank) if it has fewer than k words or more than
32 characters a word. Every run of ``k`` symbols is a k-mer, every run of ``s``
symbols inside it an s-mer; the k-mer is kept as an anchor if its least s-mer is
the first or the last one. The choice looks at nothing outside the k-mer, so a
shared passage gives the same anchors wherever it stands. All anchors are returned
with their positions (number of the k-mer's first symbol, from 0).

Two texts are matched by anchor hash and offset: equal hashes are paired one to one
in order of position, pairs with one difference of positions and holes of at most
``gap`` symbols are one shared passage. Sorting makes this linear but for the
logarithm, however often a hash repeats. A digest goes with it: the fingerprint is
the ``size`` least distinct anchor hashes, likeness the Jaccard estimate on them (1
for equal, 0 for unrelated).

The next document (descending id) is found without a global sort in one task:
rows are dealt to id ranges, the first row of each range is copied to the range
before it, and ``lead`` runs inside ranges.

Defined results: null counts as empty; a text without words has the fingerprint
'' (two of them are alike: 1); a text of fewer than k words and k
characters has one anchor, its whole sequence; equal ids are ordered by text hash; a single document is
its own next one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lanewatch.llm.common import read, register

WHITE = r"[\x20\x09-\x0D]+"


def positioned(text: Column, k: int = 4, s: int = 2) -> Column:
    """All closed syncmers of a text in their order: structs of ``hash`` (48 bits) and ``pos``."""
    words = F.filter(F.split(F.lower(text), WHITE), lambda w: w != "")
    def symbols(w: Column) -> Column:
        line = F.array_join(w, " ")
        return F.when((F.size(w) < k) | (F.char_length(line) > F.size(w) * 32), F.filter(F.split(line, ""), lambda c: c != "")) \
            .otherwise(w)
    hashed = F.transform(_let(words, symbols), lambda w: F.xxhash64(w))
    # neighbours are read by place: no array of pairs or triples is made
    def runs(x: Column, n: int, body) -> Column:
        """body(item, item after it, ...) over every run of n items."""
        first = F.slice(x, 1, F.greatest(F.size(x) - (n - 1), F.lit(0)))
        return F.transform(first, lambda item, i: body([item, *[F.get(x, i + j) for j in range(1, n)]], i))
    def smers(h: Column) -> Column:
        return runs(h, s, lambda z, i: F.xxhash64(*z))
    inner = k - s + 1
    def anchor(h: Column, pos: Column) -> Column:
        return F.struct(F.shiftrightunsigned(h, 16).alias("hash"), pos.cast("int").alias("pos"))
    def kmers(m: Column) -> Column:
        def edge(z: list[Column]) -> Column:
            return F.least(z[0], z[-1]) <= (F.least(*z[1:-1]) if inner > 3 else z[1] if inner == 3 else F.least(*z))
        # a k-mer is known by its s-mers
        found = runs(m, inner, lambda z, i: F.when(edge(z), anchor(F.xxhash64(*z), i)))
        return F.filter(found, lambda x: x.isNotNull())
    return _let(hashed, lambda h: F.when(F.size(h) == 0, F.array().cast("array<struct<hash:bigint,pos:int>>"))
                .when(F.size(h) < k, F.array(anchor(F.xxhash64(h), F.lit(0))))
                .otherwise(_let(smers(h), kmers)))


def sketch(found: Column, size: int = 64) -> Column:
    """The ``size`` least distinct hashes of positioned anchors, ascending."""
    return F.slice(F.sort_array(F.array_distinct(found["hash"])), 1, size)


def anchors(text: Column, k: int = 4, s: int = 2, size: int = 64) -> Column:
    """The ``size`` least closed-syncmer hashes (48 bits) of a text, ascending."""
    return _let(positioned(text, k, s), lambda a: sketch(a, size))


def passages(a: Column, b: Column, k: int = 4, gap: int = 16) -> Column:
    """Shared passages of two texts by their positioned anchors: structs of ``pos`` in a, ``other`` in b, ``length``
    (symbols in a) and ``anchors`` matched, by offset and position."""
    kind = "array<struct<pos:int,other:int,length:int,anchors:int>>"

    def starts(rows: Column, first) -> Column:
        """1-based places at which ``first`` (of a row and the one before) says that something begins."""
        return F.filter(F.when(F.size(rows) > 0, F.sequence(F.lit(1), F.size(rows))).otherwise(F.array().cast("array<int>")),
                        lambda i: F.when(i == 1, F.lit(True)).otherwise(first(F.get(rows, i - 1), F.get(rows, i - 2))))

    def ends(at: Column, j: Column, rows: Column) -> Column:
        return F.coalesce(F.get(at, j + 1), F.size(rows) + 1)

    def pairs(rows: Column, at: Column) -> Column:
        """(off, pos) of equal hashes, the t-th of a with the t-th of b: a run of a's rows followed by b's of that hash."""
        def pair(i: Column, j: Column) -> Column:
            mid = F.get(at, j + 1)
            here, there = F.get(rows, i - 1), F.get(rows, mid - 1)
            n = F.least(mid - i, ends(at, j + 1, rows) - mid)
            return F.when((here["side"] == 0) & (there["side"] == 1) & (here["hash"] == there["hash"]), F.transform(
                F.sequence(F.lit(0), n - 1), lambda t: F.struct(
                    (F.get(rows, mid - 1 + t)["pos"] - F.get(rows, i - 1 + t)["pos"]).alias("off"),
                    F.get(rows, i - 1 + t)["pos"].alias("pos"))))
        return F.sort_array(F.flatten(F.filter(F.transform(at, pair), lambda x: x.isNotNull())))

    def joined(m: Column) -> Column:
        at = starts(m, lambda x, y: (x["off"] != y["off"]) | (x["pos"] - y["pos"] > gap + k))
        def passage(i: Column, j: Column, all_: Column) -> Column:
            head, last = F.get(m, i - 1), ends(all_, j, m) - 1
            return F.struct(head["pos"].alias("pos"), (head["pos"] + head["off"]).alias("other"),
                            (F.get(m, last - 1)["pos"] - head["pos"] + k).alias("length"), (last - i + 1).alias("anchors"))
        return _let(at, lambda all_: F.transform(all_, lambda i, j: passage(i, j, all_)))

    def side(x: Column, n: int) -> Column:
        return F.transform(x, lambda r: F.struct(r["hash"].alias("hash"), F.lit(n).alias("side"), r["pos"].alias("pos")))

    def of(rows: Column) -> Column:
        return _let(starts(rows, lambda x, y: (x["hash"] != y["hash"]) | (x["side"] != y["side"])),
                    lambda at: _let(pairs(rows, at), joined))

    # hashes that occur once a side, at places below 2**15 (most texts): hash, side and place are one long
    plain = F.lit(gap + k < 1 << 15) & (F.element_at(a, -1)["pos"] < 1 << 15) & (F.element_at(b, -1)["pos"] < 1 << 15) \
        & (F.size(F.array_distinct(a["hash"])) == F.size(a)) & (F.size(F.array_distinct(b["hash"])) == F.size(b))
    return F.when(~F.arrays_overlap(a["hash"], b["hash"]), F.array().cast(kind)) \
        .when(plain, _plain_passages(a, b, k, gap).cast(kind)) \
        .otherwise(_let(F.sort_array(F.concat(side(a, 0), side(b, 1))), of).cast(kind))


def _plain_passages(a: Column, b: Column, k: int, gap: int) -> Column:
    """``passages`` of anchors with distinct hashes and places below 2**15, on longs: sorted, neighbours that differ in the
    side alone are pairs; pairs are offset and place in one long, sorted again and cut where the offset changes or a hole is."""
    def packed(x: Column, side: int) -> Column:
        return F.transform(x, lambda r: F.shiftleft(r["hash"], 16).bitwiseOR(r["pos"].cast("long")).bitwiseOR(F.lit(side << 15).cast("long")))

    low, high = F.lit((1 << 15) - 1).cast("long"), F.lit(1 << 16).cast("long")

    def pair(x: Column, y: Column) -> Column:
        mine, other = x.bitwiseAND(low), y.bitwiseAND(low)
        return F.when(F.shiftrightunsigned(x.bitwiseXOR(y), 16) == 0, (other - mine) * high + mine)

    def pairs(rows: Column) -> Column:
        found = F.transform(F.slice(rows, 1, F.size(rows) - 1), lambda x, i: pair(x, F.get(rows, i + 1)))
        return F.sort_array(F.filter(found, lambda x: x.isNotNull()))

    def starts(m: Column) -> Column:
        # one offset and a small step of the place are a small step of the long
        return F.filter(F.transform(m, lambda x, i: F.when((i == 0) | (x - F.get(m, i - 1) > gap + k), i)), lambda x: x.isNotNull())

    def passage(m: Column, at: Column) -> Column:
        def one(s: Column, j: Column) -> Column:
            upto = F.coalesce(F.get(at, j + 1), F.size(m))
            head = F.get(m, s)
            pos = F.pmod(head, high)
            return F.struct(pos.cast("int").alias("pos"), (pos + F.shiftright(head - pos, 16)).cast("int").alias("other"),
                            (F.get(m, upto - 1) - head + k).cast("int").alias("length"), (upto - s).alias("anchors"))
        return F.transform(at, one)

    rows = F.sort_array(F.concat(packed(a, 0), packed(b, 1)))
    return _let(_let(rows, pairs), lambda m: _let(starts(m), lambda at: passage(m, at)))


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def as_text(a: Column) -> Column:
    return F.array_join(F.transform(a, lambda x: F.lpad(F.lower(F.hex(x)), 12, "0")), "")


def likeness(a: Column, b: Column, size: int = 64) -> Column:
    """Jaccard estimate: share of the ``size`` least values of the union that both have."""
    union = F.slice(F.sort_array(F.array_union(a, b)), 1, size)
    both = F.size(F.array_intersect(F.array_intersect(a, b), union))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)) \
        .otherwise(both / F.greatest(F.size(union), F.lit(1)).cast("double"))


def _ranges(docs: DataFrame, rows_per_range: int, most: int) -> list:
    """Ascending id bounds that cut the table into ranges of about equal row counts (at most ``most``)."""
    n = docs.count()
    parts = min(most, max(1, -(-n // rows_per_range)))
    if parts == 1:
        return []
    found = docs.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 20 * most).alias("b")).first()[0]
    return sorted(set(found or ()))


def _range_of(bounds: list, id_: Column) -> Column:
    """Number of bounds below the id, found in two steps (coarse, then inside)."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    chunks = [bounds[i:i + step] for i in range(0, len(bounds), step)]
    kind = "array<bigint>"
    coarse = F.size(F.filter(F.array(*[F.lit(c[0]) for c in chunks]).cast(kind), lambda x: x < id_))
    table = F.array(*[F.array(*[F.lit(x) for x in c]) for c in chunks]).cast(f"array<{kind}>")
    inside = F.size(F.filter(F.element_at(table, F.greatest(coarse, F.lit(1))), lambda x: x < id_))
    return F.greatest(coarse - 1, F.lit(0)) * step + inside


def with_next(docs: DataFrame, columns: list[str], order: list[str], rows_per_range: int = 2000,
              most: int = 16384) -> DataFrame:
    """Every row with ``next_<column>`` of the row that follows in descending ``doc_id``; the first follows the last."""
    bounds = _ranges(docs, rows_per_range, most)
    dealt = docs.withColumn("_range", F.coalesce(_range_of(bounds, F.col("doc_id")), F.lit(0)))
    # the first row (largest id) of each range also ends the range above; the very first ends the lowest
    heads = sorted(dealt.groupBy("_range").agg(F.max("doc_id").alias("head")).collect(), key=lambda r: -r["_range"])
    if not heads:
        return docs.select("*", *[F.col(c).alias(f"next_{c}") for c in columns])
    above = {heads[i]["_range"]: heads[i - 1]["_range"] for i in range(len(heads))}      # heads[-1]: the wrap
    rows = [(r["_range"], r["head"], above[r["_range"]]) for r in heads]
    where = docs.sparkSession.createDataFrame(rows, "_r int, _head long, _above int")     # at most ``most`` rows
    marked = dealt.join(F.broadcast(where), (F.col("_range") == F.col("_r")) & F.col("doc_id").eqNullSafe(F.col("_head")), "left")
    copies = F.when(F.col("_above").isNull(), F.array(F.struct(F.lit(False).alias("ghost"), F.col("_range").alias("to")))) \
        .otherwise(F.array(F.struct(F.lit(False).alias("ghost"), F.col("_range").alias("to")),
                           F.struct(F.lit(True).alias("ghost"), F.col("_above").alias("to"))))
    spread = marked.withColumn("_copy", F.explode(copies)) \
        .withColumn("_ghost", F.col("_copy.ghost")).withColumn("_range", F.col("_copy.to"))
    # ghosts stand last; of equal ids the one that sorts first must be met first
    place = Window.partitionBy("_range").orderBy("_ghost", *[F.desc_nulls_last(c) for c in order])
    out = spread.select("*", *[F.lead(F.struct(*columns)).over(place).alias("_next")]).filter(~F.col("_ghost"))
    return out.select(*docs.columns, *[F.col(f"_next.{c}").alias(f"next_{c}") for c in columns])


def fingerprints(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", k: int = 4, s: int = 2,
                 size: int = 64) -> DataFrame:
    """Fingerprints of every document and of its edited text, their likeness, all anchors with positions, and the
    passages shared with the edited text and the next document."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    paired = with_next(slim.withColumn("h", F.xxhash64("text")), ["text"], ["doc_id", "h"])
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = paired.select(
        "doc_id", n.cast("long").alias("n_chars"), "text", "next_text",
        F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half)).alias("edited"))
    found = edited.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                          *[positioned(F.col(c), k, s).alias(a) for c, a in (("text", "a"), ("edited", "e"), ("next_text", "x"))])
    done = found.select("*", *[sketch(F.col(a), size).alias(f"{a}fp") for a in "aex"])
    return done.select("doc_id", "n_chars", "edited_sha256", as_text(F.col("afp")).alias("fingerprint"),
                       as_text(F.col("efp")).alias("edited_fingerprint"),
                       likeness(F.col("afp"), F.col("efp"), size).alias("near_edited"),
                       likeness(F.col("afp"), F.col("xfp"), size).alias("near_next"), F.col("a").alias("anchors"),
                       passages(F.col("a"), F.col("e"), k).alias("edited_passages"),
                       passages(F.col("a"), F.col("x"), k).alias("next_passages"))


@register("op7_document_fingerprints")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(read(spark, sf_dir, "documents"))
