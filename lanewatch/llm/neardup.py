"""Near-duplicate detection: fast similarity sketches, banding, exact verification.

The sketch of a set fills ``coordinates`` bins in rounds: in round i every
element is hashed into one bin with a value that orders after all earlier rounds;
from round ``coordinates`` on, all elements go to bin i - coordinates, so that
every bin is certainly filled. Rounds stop once a document's bins are full.

Equal sets are one class, represented by its smallest id; only classes are
banded. Inside a band's bucket candidates are not paired all with all: every
member is first compared with its most central neighbour (the one that shares
most buckets). Buckets whose members then lie in one component are done. In the
others a member's own shingles, which no other member has, bound what it can have
in common with anyone, and members of one hub share at most what both share with
it and what neither has alone outside it. Members that no bound rules out are
compared across components, each component but a group's largest with all others.
Links are confirmed on the full shingle sets.

Defined results: no words or no text: empty set, linked with nothing; fewer
words than a shingle: the whole sequence is the only one; equal rows fall into
one class; a null id can join a group but never names one that has ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanewatch.llm import textops
from lanewatch.llm.common import bounded_batches, kept, read, register

EMPTY = np.uint64(2**64 - 1)


def shingle_hashes(words: textops.Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles of a batch and each text's offsets into them."""
    h, counts, offsets = words.hashes(), words.counts, words.offsets
    starts = textops.run_starts(counts, offsets, k)
    long = textops.rolling(h, k)[starts] if len(starts) else np.zeros(0, dtype=np.uint64)
    n = np.maximum(counts - k + 1, 0)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if not len(short):
        return long, np.concatenate([[0], np.cumsum(n)])
    own = np.array([int(textops.rolling(h[offsets[i]:offsets[i + 1]], int(counts[i]))[0]) for i in short], dtype=np.uint64)
    at = np.concatenate([[0], np.cumsum(n)])[short]
    out = np.insert(long, at, own)
    n[short] = 1
    return out, np.concatenate([[0], np.cumsum(n)])


def similarity_sketch(values: np.ndarray, offsets: np.ndarray, t: int) -> np.ndarray:
    """Fast similarity sketches (texts x t) of sets given as flat hashes; an empty set's row is all EMPTY."""
    n = len(offsets) - 1
    bins = np.full(n * t, EMPTY, dtype=np.uint64)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    shift = np.uint64(64 - (t - 1).bit_length())
    low = np.uint64((1 << 54) - 1)
    with np.errstate(over="ignore"):
        for i in range(2 * t):
            if not len(values):
                break
            x = textops.mix(values ^ (np.uint64(i + 1) * textops.M1))
            at = (x >> shift).astype(np.int64) % t if i < t else np.full(len(x), i - t)
            np.minimum.at(bins, owner * t + at, (x & low) | np.uint64(i << 54))
            open_ = (bins.reshape(n, t) == EMPTY).any(axis=1)[owner]
            if not open_.all():
                values, owner = values[open_], owner[open_]
    return bins.reshape(n, t)


def band_hashes(sketch: np.ndarray, rows: int) -> np.ndarray:
    n, t = sketch.shape
    parts = sketch.reshape(n, t // rows, rows)
    with np.errstate(over="ignore"):
        h = np.broadcast_to(np.arange(1, t // rows + 1, dtype=np.uint64) * textops.M2, (n, t // rows))
        for j in range(rows):
            h = textops.mix((h * textops.M1) ^ parts[:, :, j])
    return h


def _signatures(docs: DataFrame, k: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, n_shingles, sig, bands) of every document; sig and bands null for an empty set."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_shingles", T.LongType()),
                           T.StructField("sig", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in textops.slices(whole, "text"):
                values, off = shingle_hashes(textops.split_words(batch.column("text"), textops.LOWER), k)
                sets = [np.unique(values[a:b]) for a, b in zip(off[:-1], off[1:], strict=True)]
                sizes = np.array([len(s) for s in sets], dtype=np.int64)
                off = np.concatenate([[0], np.cumsum(sizes)])
                flat = np.concatenate(sets) if sets else values
                h = band_hashes(similarity_sketch(flat, off, bands * rows), rows).view(np.int64)
                some = np.flatnonzero(sizes)
                where = np.concatenate([[0], np.cumsum(np.where(sizes > 0, bands, 0))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(where), pa.array(h[some].ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(sizes),
                     pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                     lists], schema.names)

    return docs.mapInArrow(run, schema)


def _sets(docs: DataFrame, k: int) -> DataFrame:
    schema = T.StructType([docs.schema["doc_id"], T.StructField("shingles", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in textops.slices(whole, "text", 2 << 20):
                values, off = shingle_hashes(textops.split_words(batch.column("text"), textops.LOWER), k)
                sets = [np.unique(values[a:b]).view(np.int64) for a, b in zip(off[:-1], off[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.list_(pa.int64()))],
                                                 schema.names)

    return docs.mapInArrow(run, schema)


def small_side(df: DataFrame, rows: int = 500_000) -> DataFrame:
    """Broadcast a table of ids only if its counted rows stay under the bound."""
    return F.broadcast(df) if df.count() <= rows else df


def _overlaps(docs: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """The pairs (a, b) with the sizes of their full sets and of the intersection: na, nb, common."""
    ids = kept(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct())
    sets = kept(_sets(docs.join(small_side(ids), "doc_id", "left_semi"), k))
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").select(
        "a", "b", F.size("sa").alias("na"), F.size("sb").alias("nb"), F.size(F.array_intersect("sa", "sb")).alias("common"))


def _linked(percent: int, common) -> Column:
    return common * 100 >= (F.col("na") + F.col("nb") - common) * percent


def _own_shingles(docs: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """(rep, q): how many of a member's shingles no other member or hub has. No link of the members can use them."""
    ids = kept(members.select(F.col("rep").alias("doc_id")).union(members.filter("hub is not null").select("hub")).distinct())
    each = _sets(docs.join(small_side(ids), "doc_id", "left_semi"), k) \
        .select("doc_id", F.explode("shingles").alias("shingle"))
    once = each.groupBy("shingle").agg(F.count("*").alias("c"), F.min("doc_id").alias("rep")).filter("c = 1")
    return kept(once.groupBy("rep").agg(F.count("*").alias("q")))


def _others(members: DataFrame, key: str) -> DataFrame:
    """The members outside their group's largest component."""
    largest = members.groupBy(key, "c").agg(F.count("*").alias("size")) \
        .groupBy(key).agg(F.max(F.struct("size", "c")).alias("l")).select(key, F.col("l.c").alias("main"))
    return members.join(largest, key).filter("c <> main").drop("main")


def _across(members: DataFrame, key: str) -> DataFrame:
    """Pairs of members of one group in different components: a*, b* columns of both sides."""
    side = lambda m, x: m.select(key, *[F.col(c).alias(f"{c}{x}") for c in ("rep", "n", "q", "c", "hub", "common")
                                        if c != key])
    return side(_others(members, key), "a").join(side(members, "b"), key).filter("ca <> cb") \
        .withColumnsRenamed({"repa": "a", "repb": "b"})


def components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """(node, component) of an undirected edge table (a, b): alternating large and small stars.

    Every round is a grouped minimum and a join; the rounds end when the edges are
    a forest of stars around each component's smallest node.
    """
    def print_of(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    def star(e: DataFrame, large: bool) -> DataFrame:
        sides = e.union(e.select(F.col("v"), F.col("u"))).toDF("u", "v") if large else e
        least = sides.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        near = sides.filter("v > u") if large else sides
        out = near.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        if not large:
            out = out.union(least.select("u", "m")).distinct()
        return out.filter("u <> v")

    e = kept(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    mark = print_of(e)
    for _ in range(max_rounds):
        e = kept(star(star(e, True), False))
        mark, old = print_of(e), mark
        if mark == old:
            break
    else:
        raise RuntimeError(f"components: no fixed point in {max_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")) \
        .union(e.select(F.col("v"), F.col("v")).distinct())


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = 3,
                    percent: int = 85, bands: int = 32, rows: int = 4) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document.

    ``bands`` x ``rows`` coordinates: a pair at the threshold similarity s is missed
    with probability (1 - s**rows)**bands, 6e-11 for the defaults at 0.85.
    """
    bounded_batches(docs.sparkSession)
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    sigs = kept(_signatures(slim, shingle, bands, rows))
    classes = kept(sigs.filter("sig is not null").groupBy("sig", "n_shingles")
                   .agg(F.min("doc_id").alias("rep"), F.any_value("bands").alias("bands")))
    placed = classes.filter("rep is not null").select(F.explode("bands").alias("bucket"), "rep", F.col("n_shingles").alias("n"))
    shared = placed.groupBy("bucket").agg(F.count("*").alias("c")).filter("c > 1")
    members = kept(placed.join(shared, "bucket"))
    central = members.groupBy("rep").agg(F.sum("c").alias("near"))       # members with many neighbours make good hubs
    members = kept(members.drop("c").join(central, "rep"))
    hub = F.max(F.struct("near", "rep", "n")).alias("hub")
    first = members.join(members.groupBy("bucket").agg(hub), "bucket").filter(F.col("rep") != F.col("hub.rep")) \
        .groupBy("rep", "n").agg(F.max("hub").alias("hub"))
    fits = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent
    first = first.select(F.col("rep").alias("a"), F.col("hub.rep").alias("b"), F.col("n").alias("na"), F.col("hub.n").alias("nb"))
    compared = kept(_overlaps(slim, kept(first.filter(fits).select("a", "b")), shingle))
    edges = compared.filter(_linked(percent, F.col("common"))).select("a", "b")
    # labels for now: the hub, or its hub (hubs are ever more central, so this has no cycles)
    upper = edges.select(F.col("a").alias("b"), F.col("b").alias("top"))
    group = kept(edges.join(upper, "b", "left").select(F.col("a").alias("node"), F.coalesce("top", "b").alias("component"))
                 .distinct())

    def mixed(m: DataFrame) -> DataFrame:
        """The members of buckets that still hold several components: with component c, the bucket's least set size."""
        named = m.drop("c", "least").join(small_side(group), F.col("rep") == F.col("node"), "left") \
            .withColumn("c", F.coalesce("component", "rep")).drop("node", "component")
        open_ = named.groupBy("bucket").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.min("n").alias("least")) \
            .filter("lo < hi").select("bucket", "least")
        return kept(named.join(open_, "bucket"))

    hubs = compared.select(F.col("a").alias("rep"), F.col("b").alias("hub"), "common")
    members = mixed(members.join(hubs, "rep", "left"))
    own = _own_shingles(slim, members, shingle)
    # at most n - q shingles of a set of n are anyone else's, and a partner in the bucket has at least ``least``
    able = F.when(F.col("least") > F.col("n") - F.col("q"), F.col("least") + F.col("q")).otherwise(F.col("n"))
    members = mixed(members.join(own, "rep", "left").withColumn("q", F.coalesce("q", F.lit(0)))
                    .filter((F.col("n") - F.col("q")) * 100 >= able * percent))
    # two sets share at most what both share with their hub, and what neither has alone outside it
    free = [F.greatest(F.col(f"n{x}") - F.col(f"common{x}") - F.col(f"q{x}"), F.lit(0)) for x in "ab"]
    most = F.least(F.col("na") - F.col("qa"), F.col("nb") - F.col("qb"))
    near_hub = F.least(most, F.least("commona", "commonb") + F.least(*free))
    same_hub = _across(members.filter("hub is not null").select("rep", "n", "q", "c", "hub", "common").distinct(), "hub")
    rest = _across(members, "bucket").filter("huba is null or hubb is null or huba <> hubb")
    pairs = same_hub.filter(fits & _linked(percent, near_hub)).select("a", "b") \
        .union(rest.filter(fits & _linked(percent, most)).select("a", "b"))
    pairs = kept(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    late = _overlaps(slim, pairs, shingle).filter(_linked(percent, F.col("common"))).select("a", "b")
    group = kept(components(edges.union(late)))
    named = sigs.select("doc_id", "n_shingles", "sig") \
        .join(classes.select("sig", F.col("n_shingles").alias("_n"), "rep"),
              F.col("n_shingles").eqNullSafe(F.col("_n")) & (sigs.sig == classes.sig), "left") \
        .join(group, F.col("rep") == group.node, "left")
    whole = F.coalesce("component", "rep", "doc_id")
    return named.select("doc_id", "n_shingles", whole.alias("component_id"),
                        F.col("doc_id").eqNullSafe(whole).alias("kept"))


def drop_near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents, all columns, one of each group (the smallest id)."""
    found = near_duplicates(docs, doc_id=doc_id, text=text, **options)
    gone = kept(found.filter("not kept and doc_id is not null").select(F.col("doc_id").alias(doc_id)).distinct())
    return docs.join(small_side(gone), doc_id, "left_anti")


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[p:p + least(3, len(ws)) - 1], ' ') AS sh
  FROM w, unnest(range(1, len(ws) - least(3, len(ws)) + 2)) AS t(p) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT sh FROM s GROUP BY sh HAVING count(*) > 1),
inter AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i
          FROM s a JOIN c USING (sh) JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM inter JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
r AS (SELECT doc_id AS node, doc_id AS root FROM documents
      UNION SELECT e.b, r.root FROM r JOIN e ON r.node = e.a),
g AS (SELECT node, min(root) AS root FROM r GROUP BY node)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, g.root AS component_id, d.doc_id = g.root AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN g ON g.node = d.doc_id
"""


@register("op3_minhash_near_dedup", SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))
