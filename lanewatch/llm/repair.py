"""Conversation structure repair: cheapest edits by bidirectional Dijkstra over the edit lattice.

A conversation of n rows and the pattern ``(s?(ua)+)?`` of role initials span a lattice
of nodes (rows read, place in the pattern). Edges: Keep a row whose initial fits (0),
Rerole it to the role that fits (3), Delete it (4), Insert an empty turn (3); a row that
is cut off costs 3 more unless deleted; blank and duplicate rows can only be deleted. A
forward heap grows from the start, a reverse heap from the accepting ends; they meet at
the least cost, go on until no other crossing can cost as little, and the edges on any
cheapest path are walked from the start, always by the least letter: that is the least
audit. (Letters fix the cost, so no cheapest audit begins another.)

Plan: damage and faults are column expressions. Conversations of at most ``max_rows``
rows and ``max_bytes`` bytes are brought together by id and solved one after another in
sorted streams. A longer one is never brought together: its rows are dealt by range of
(turn, role, text), repeated rows are found by digest, runs of at most ``max_rows`` rows
give their cheapest edits from every place of the pattern to every other (16 searches),
and only these short strings meet per conversation. Its repaired text is written run by
run; the SHA-256, sequential by nature, reads the runs in order through one stream that
holds one run at a time.

Defined results: a null role or text counts as one blank, in the damage key a null id or
turn too; a null conv_id is a conversation of its own; null turns come first, rows of one
turn are in order of role and text (UTF-8); repeated rows are duplicates; an empty role
fits nowhere; a conversation whose rows are all dropped, or a table without rows, gives
zeros and empty strings or no rows; other columns of the table are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanewatch.llm.common import kept, kept_by, read, register, shuffle_partitions

WHITE = " \t\n\x0b\x0c\r"
#: places in the pattern: nothing written, after s, after u, after ua
START, SYSTEM, USER, PAIR = range(4)
STEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (PAIR, "u"): USER, (USER, "a"): PAIR}
ENDS = (START, PAIR)
ROLE = {"u": "user", "a": "assistant"}
COST = {"K": 0, "R": 3, "D": 4, "I": 3}
CUT_OFF = 3
FAULTS = ("blank", "duplicate", "truncated")


def _edges(code: str | None) -> list[list[tuple[str, int, int]]]:
    """By place: (letter, cost, next place) over a row of that code, or of the inserts (None)."""
    out: list[list[tuple[str, int, int]]] = [[] for _ in range(4)]
    for q in range(4):
        if code is None:
            out[q] = [("I", COST["I"], STEP[q, x]) for x in "ua" if (q, x) in STEP]
            continue
        out[q].append(("D", COST["D"], q))
        if code == "-":
            continue
        more = CUT_OFF if code.isupper() else 0
        if (q, code.lower()) in STEP:
            out[q].append(("K", more, STEP[q, code.lower()]))
        out[q] += [("R", COST["R"] + more, STEP[q, x]) for x in "ua" if (q, x) in STEP]
    return out


#: a row's code: its role initial (x: any other), upper case if truncated; - if it must be deleted
FORWARD = {c: _edges(c) for c in "suaxSUAX-"} | {None: _edges(None)}
REVERSE = {c: [[(a, w, p) for p in range(4) for a, w, q in rows[p] if q == to] for to in range(4)]
           for c, rows in FORWARD.items()}


def cheapest(code: str, source: int = START, targets: tuple[int, ...] = ENDS) -> tuple[int, str] | None:
    """Least cost of edits that read ``code`` from place ``source`` to a target place, and their least audit."""
    n = len(code)
    goal = None
    dist: tuple[dict, dict] = ({source: 0}, {4 * n + q: 0 for q in targets})
    done: tuple[dict, dict] = ({}, {})
    # of equal costs the node nearer to its own end is settled first: free edges lead away from it
    heaps = [[(0, 0, source)], [(0, 0, 4 * n + q) for q in targets]]

    def after(v: int) -> Iterator[tuple[str, int, int]]:
        i, q = divmod(v, 4)
        if i < n:
            for a, w, p in FORWARD[code[i]][q]:
                yield a, w, 4 * i + 4 + p
        for a, w, p in FORWARD[None][q]:
            yield a, w, 4 * i + p

    def ahead(v: int) -> Iterator[tuple[str, int, int]]:
        i, q = divmod(v, 4)
        if i:
            for a, w, p in REVERSE[code[i - 1]][q]:
                yield a, w, 4 * i - 4 + p
        for a, w, p in REVERSE[None][q]:
            yield a, w, 4 * i + p

    tops = [0, 0]
    while heaps[0] and heaps[1]:
        tops = [heaps[0][0][0], heaps[1][0][0]]
        if goal is not None and sum(tops) > goal:
            break
        side = int(tops[1] < tops[0] or (tops[0] == tops[1] and len(done[1]) < len(done[0])))
        far, own = dist[1 - side], dist[side]
        d, _, v = heappop(heaps[side])
        if v in done[side]:
            continue
        done[side][v] = d
        if v in far and (goal is None or d + far[v] < goal):
            goal = d + far[v]
        for _, w, u in (ahead if side else after)(v):
            if d + w < own.get(u, d + w + 1):
                own[u] = d + w
                heappush(heaps[side], (d + w, n - u // 4 if side else u // 4, u))
                if u in far and (goal is None or d + w + far[u] < goal):
                    goal = d + w + far[u]
    if goal is None:
        return None
    # edges of cheapest paths: those before a crossing, the crossings, those after
    front, back = done
    on: dict[int, list[tuple[str, int]]] = {}
    before, behind = [], []

    def use(v: int, a: str, u: int) -> None:
        on.setdefault(v, []).append((a, u))

    for v, d in front.items():
        if v in back and d + back[v] == goal:
            before.append(v)
            behind.append(v)
        for a, w, u in after(v):
            if u in back and d + w + back[u] == goal:
                use(v, a, u)
                before.append(v)
                behind.append(u)
    seen = set(before)
    while before:
        v = before.pop()
        for a, w, u in ahead(v):
            if u in front and front[u] + w == front[v]:
                use(u, a, v)
                if u not in seen:
                    seen.add(u)
                    before.append(u)
    seen = set(behind)
    while behind:
        v = behind.pop()
        for a, w, u in after(v):
            if u in back and back[u] + w == back[v]:
                use(v, a, u)
                if u not in seen:
                    seen.add(u)
                    behind.append(u)
    audit, places = [], {source}
    while True:
        steps = [x for v in places for x in on.get(v, ())]
        if not steps:
            return goal, "".join(audit)
        least = min(a for a, _ in steps)
        audit.append(least)
        places = {u for a, u in steps if a == least}


@lru_cache(maxsize=20_000)
def _cheapest_short(code: str) -> tuple[int, str]:
    return cheapest(code)


def solve(code: str) -> tuple[int, str]:
    """Cost and audit of a whole conversation; short codes are remembered."""
    return _cheapest_short(code) if len(code) <= 64 else cheapest(code)


def code_of(role: str, fault: str | None) -> str:
    if fault in ("blank", "duplicate"):
        return "-"
    c = role[:1] if role[:1] in ("s", "u", "a") else "x"
    return c.upper() if fault == "truncated" else c


def repaired(rows: Iterable[tuple[str, str]], audit: str, place: int = START) -> Iterator[tuple[str, str]]:
    """The rows that an audit leaves, read from a place of the pattern."""
    rows = iter(rows)
    for a in audit:
        if a == "I":
            role, text = ROLE["a" if place == USER else "u"], ""
        else:
            role, text = next(rows)
            if a == "D":
                continue
            if a == "R":
                role = ROLE["a" if place == USER else "u"]
        place = STEP[place, role[0]]
        yield role, text


# ---- damage and faults, as columns

def damaged(rows: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
            damage: bool = True) -> DataFrame:
    """conv_id, turn, role, text, alive of the rows after damage; a dropped row stays as one without text, not alive."""
    blank = F.lit(" ")
    slim = rows.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
                       F.coalesce(F.col(role), blank).alias("role"), F.coalesce(F.col(text), blank).alias("text"))
    if not damage:
        return slim.withColumn("alive", F.lit(True))
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), blank), F.coalesce(F.col("turn").cast("string"), blank))
    what = slim.withColumn("_what", F.crc32(key.cast("binary")) % 20)
    hurt = what.select(
        "conv_id", "turn", F.when(F.col("_what") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("_what") <= 1, F.lit("")).when(F.col("_what") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"), (F.col("_what") != 0).alias("alive"),
        F.explode(F.when(F.col("_what") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"))
    return hurt.drop("_copy")


def _last(text: Column) -> Column:
    """The last character that is not white space; empty if there is none."""
    return F.substring(F.rtrim(text, F.lit(WHITE)), -1, 1)


def faults(rows: DataFrame) -> DataFrame:
    """With ``blank`` and ``open`` (the last character ends no sentence)."""
    last = _last(F.col("text"))
    return rows.withColumn("blank", last == "").withColumn("open", ~last.isin(".", "!", "?"))


# ---- conversations that one task may hold

FIELDS = [("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
          ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())]
RESULT = ", ".join(f"{n} {'string' if t == pa.string() else 'long'}" for n, t in FIELDS)
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


def _gaps(turns: Iterable[int | None]) -> int:
    known = {t for t in turns if t is not None}
    return max(known) - min(known) + 1 - len(known) if known else 0


def repair_one(rows: list[tuple[int | None, str, str, bool, bool]]) -> tuple:
    """FIELDS of one conversation's rows (turn, role, text, blank, open) in their order."""
    seen: set[tuple[str, str]] = set()
    found = dict.fromkeys(FAULTS, 0)
    code = []
    for _, role, text, blank, cut in rows:
        fault = "blank" if blank else "duplicate" if (role, text) in seen else "truncated" if cut else None
        seen.add((role, text))
        if fault:
            found[fault] += 1
        code.append(code_of(role, fault))
    cost, audit = solve("".join(code))
    text = "\n".join(f"{r}:{t}" for r, t in repaired(((x[1], x[2]) for x in rows), audit))
    illegal = sum((a[1][:1], b[1][:1]) not in LEGAL for a, b in zip(rows, rows[1:]))
    return (_gaps(x[0] for x in rows), *found.values(), illegal, cost, audit,
            hashlib.sha256(text.encode()).hexdigest())


def _repair_short(rows: DataFrame) -> DataFrame:
    """One task holds one conversation at a time of a sorted stream."""
    id_type = rows.schema["conv_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key, started, out, kind = [], None, False, [], None

        def flush() -> pa.RecordBatch:
            ids, values = [x[0] for x in out], [x[1] for x in out]
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, kind), *[pa.array([v[k] for v in values], t) for k, (_, t) in enumerate(FIELDS)]],
                ["conv_id", *[n for n, _ in FIELDS]])

        for batch in batches:
            kind = batch.column("conv_id").type
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "alive", "turn", "role", "text", "blank", "open")]
            for own, alive, *row in zip(*columns, strict=True):
                if not started or own != key:
                    if started:
                        out.append((key, repair_one(held)))
                    held, key, started = [], own, True
                if alive:
                    held.append(tuple(row))
            if len(out) >= 1000:
                yield flush()
        if started:
            out.append((key, repair_one(held)))
            yield flush()

    schema = T.StructType([T.StructField("conv_id", id_type), *T.StructType.fromDDL(RESULT).fields])
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(run, schema)


# ---- longer conversations, in runs

def _runs(rows: DataFrame, max_rows: int, max_bytes: int) -> DataFrame:
    """The rows of longer conversations in order, with ``part`` and ``run`` (runs of a range partition) and their ``code``.

    Equal rows of a turn are one row with their number ``m``; its code is followed by m - 1 rows to delete.
    """
    text_id = F.sha2(F.concat(F.col("role"), F.lit("\x00"), F.col("text")).cast("binary"), 256)
    alike = rows.withColumn("_same", text_id).groupBy("conv_id", "_same", "turn").agg(
        F.first("role").alias("role"), F.first("text").alias("text"), F.first("blank").alias("blank"),
        F.first("open").alias("open"), F.count("*").alias("m"))
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn"))
    first = alike.groupBy("conv_id", "_same").agg(F.min(place).alias("_first")) \
        .select(F.col("conv_id").alias("_conv"), F.col("_same").alias("_id"), "_first")
    told = alike.join(first, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("_same") == F.col("_id"))) \
        .withColumn("again", ~place.eqNullSafe(F.col("_first"))).drop("_conv", "_id", "_first", "_same")
    n = shuffle_partitions(rows.sparkSession)
    ordered = told.repartitionByRange(n, "conv_id", "turn", "role", "text") \
        .sortWithinPartitions("conv_id", "turn", "role", "text")
    schema = T.StructType([*[told.schema[c] for c in ("conv_id", "turn", "role", "text", "m")],
                           *T.StructType.fromDDL("part int, run int, place long, code string, fault string").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, number, held, size, key, at = TaskContext.get().partitionId(), -1, 0, 0, None, 0
        for batch in batches:
            extra: list[list] = [[], [], [], []]
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "blank", "open", "again")]
            for own, role, text, blank, cut, again in zip(*columns, strict=True):
                if number < 0 or own != key or held >= max_rows or size >= max_bytes:
                    number, held, size, key = number + 1, 0, 0, own
                fault = "blank" if blank else "duplicate" if again else "truncated" if cut else None
                for column, value in zip(extra, (number, at, code_of(role, fault), fault), strict=True):
                    column.append(value)
                held, size, at = held + 1, size + len(text), at + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("conv_id", "turn", "role", "text", "m")]
                + [pa.array([part] * batch.num_rows, pa.int32()), pa.array(extra[0], pa.int32()),
                   pa.array(extra[1], pa.int64()), pa.array(extra[2], pa.string()), pa.array(extra[3], pa.string())],
                schema.names)

    return ordered.mapInArrow(run, schema)


def combine(tables: list[dict[tuple[int, int], tuple[int, str]]]) -> tuple[int, list[str], list[int]]:
    """Cheapest way through runs, each a table (place in, place out) -> (cost, audit): cost, audit and place in by run."""
    back: list[dict[int, tuple[int, int]]] = []
    best: dict[int, tuple[int, str]] = {q: (0, "") for q in ENDS}
    for table in reversed(tables):                 # from the end: the least rest of every place
        now: dict[int, tuple[int, str]] = {}
        pick: dict[int, tuple[int, int]] = {}
        for (a, b), (cost, audit) in table.items():
            if b in best:
                whole = (cost + best[b][0], audit + best[b][1])
                if a not in now or whole < now[a]:
                    now[a], pick[a] = whole, (b, len(audit))
        back.append(pick)
        best = now
    cost, rest = best[START]
    audits, places, q = [], [], START
    for pick in reversed(back):
        places.append(q)
        q, size = pick[q]
        audits.append(rest[:size])
        rest = rest[size:]
    return cost, audits, places


def _repair_long(rows: DataFrame, max_rows: int, max_bytes: int) -> DataFrame:
    spark = rows.sparkSession
    runs = kept(_runs(rows, max_rows, max_bytes))
    by_run = ["conv_id", "part", "run"]
    initial = F.substring("role", 1, 1)
    in_order = F.sort_array(F.collect_list(F.struct("place", "code", "m", initial.alias("i"))))
    slim = runs.groupBy(*by_run).agg(
        in_order.alias("rows"), *[F.sum(F.when(F.col("fault") == f, 1).otherwise(0)).alias(f) for f in FAULTS[:1]],
        F.sum(F.when(F.col("fault") == "blank", F.col("m") - 1).otherwise(0)).alias("more_blank"),
        F.sum(F.when(F.col("fault") == "duplicate", F.col("m")).when(F.col("fault") == "blank", 0)
              .otherwise(F.col("m") - 1)).alias("duplicate"),
        F.sum(F.when(F.col("fault") == "truncated", 1).otherwise(0)).alias("truncated"))
    slim = slim.withColumn("blank", F.col("blank") + F.col("more_blank")).drop("more_blank")
    pairs = F.transform(F.sequence(F.lit(1), F.size("rows") - 1), lambda k: F.struct(
        F.get("rows", k - 1)["i"].alias("x"), F.get("rows", k)["i"].alias("y")))
    inner = F.when(F.size("rows") < 2, F.lit(0)).otherwise(F.size(F.filter(
        pairs, lambda p: ~F.concat(p["x"], p["y"]).isin("su", "ua", "au"))))
    # a row that stands m times: m - 1 neighbours with equal initials, never legal
    repeats = F.aggregate("rows", F.lit(0).cast("long"), lambda s, r: s + r["m"] - 1)
    parts = slim.select(
        *by_run, *FAULTS, (inner + repeats).alias("illegal"), F.get("rows", F.lit(0))["i"].alias("first"),
        F.element_at("rows", -1)["i"].alias("last"),
        F.array_join(F.transform("rows", lambda r: F.concat(
            r["code"], F.repeat(F.lit("-"), (r["m"] - 1).cast("int")))), "").alias("code"))
    tables = kept(parts.mapInArrow(_tables(parts), T.StructType(
        [*[f for f in parts.schema.fields if f.name != "code"],
         *T.StructType.fromDDL("code string, table array<struct<a:int,b:int,cost:long,audit:string>>").fields])))
    id_type = rows.schema["conv_id"]
    chosen = kept(tables.groupBy("conv_id").applyInArrow(_choose, T.StructType(
        [id_type, *T.StructType.fromDDL("part int, run int, at int, audit string, cost long, blank long, duplicate long, "
                                        "truncated long, illegal long").fields])))
    # the repaired text of each run, then one digest a conversation over its runs in order
    same = lambda c: F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    texts = runs.alias("l").join(chosen.filter("audit != ''").alias("r"), same("conv_id") & same("part") & same("run"))
    lines = texts.groupBy("l.conv_id", "l.part", "l.run").agg(
        F.sort_array(F.collect_list(F.struct("l.place", "l.role", "l.text", "l.m"))).alias("rows"),
        F.first("r.audit").alias("audit"), F.first("r.at").alias("at"))
    pieces = lines.mapInArrow(_apply, T.StructType([id_type, *T.StructType.fromDDL("part int, run int, text string").fields]))
    hashes = kept(pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part", "run")
                  .mapInArrow(_digest, T.StructType([id_type, T.StructField("repaired_sha256", T.StringType())])))
    whole = chosen.groupBy("conv_id").agg(
        *[F.first(c).alias(c) for c in ("cost", *FAULTS, "illegal")],
        F.sort_array(F.collect_list(F.struct("part", "run", "audit"))).alias("audits"))
    turns = rows.groupBy("conv_id", "turn").agg(F.lit(1).alias("one")).groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"))
    out = whole.alias("l").join(turns.alias("r"), same("conv_id")).select("l.*", "r.gaps")
    out = out.alias("l").join(hashes.alias("r"), same("conv_id"), "left").select("l.*", "r.repaired_sha256")
    return out.select("conv_id", "gaps", *FAULTS, "illegal", "cost", F.array_join(F.col("audits.audit"), "").alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


def _tables(parts: DataFrame):
    names = [f.name for f in parts.schema.fields if f.name != "code"]
    kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[{"a": a, "b": b, "cost": way[0], "audit": way[1]} for a in range(4) for b in range(4)
                      if (way := cheapest(code, a, (b,))) is not None] for code in batch.column("code").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], batch.column("code"), pa.array(found, kind)],
                                             [*names, "code", "table"])

    return run


def _choose(group: pa.Table) -> pa.Table:
    """The cheapest way through one conversation's runs."""
    group = group.sort_by([("part", "ascending"), ("run", "ascending")])
    tables = [{(x["a"], x["b"]): (x["cost"], x["audit"]) for x in t} for t in group.column("table").to_pylist()]
    cost, audits, places = combine(tables)
    first, last = group.column("first").to_pylist(), group.column("last").to_pylist()
    between = sum((a, b) not in LEGAL for a, b in zip(last, first[1:]))
    n = group.num_rows
    total = {c: sum(group.column(c).to_pylist()) for c in (*FAULTS, "illegal")}
    return pa.table([group.column("conv_id"), group.column("part"), group.column("run"), pa.array(places, pa.int32()),
                     pa.array(audits, pa.string()), *[pa.array([v] * n, pa.int64()) for v in (
                         cost, *[total[c] for c in FAULTS], total["illegal"] + between)]],
                    ["conv_id", "part", "run", "at", "audit", "cost", *FAULTS, "illegal"])


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            own = batch.slice(k, 1)
            rows = ((x["role"], x["text"]) for x in own.column("rows")[0].as_py() for _ in range(x["m"]))
            left = list(repaired(rows, own.column("audit")[0].as_py(), own.column("at")[0].as_py()))
            if left:
                yield pa.RecordBatch.from_arrays(
                    [*[own.column(c) for c in ("conv_id", "part", "run")],
                     pa.array(["\n".join(f"{r}:{t}" for r, t in left)], pa.string())], ["conv_id", "part", "run", "text"])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, state, kind = None, None, None

    def told() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key], kind), pa.array([state.hexdigest()])], ["conv_id", "repaired_sha256"])

    for batch in batches:
        kind = batch.column("conv_id").type
        for own, text in zip(batch.column("conv_id").to_pylist(), batch.column("text"), strict=True):
            if state is None or own != key:
                if state is not None:
                    yield told()
                key, state = own, hashlib.sha256()
            else:
                state.update(b"\n")
            state.update(text.as_py().encode())
    if state is not None:
        yield told()


def repair(conversations: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           damage: bool = True, max_rows: int = 4096, max_bytes: int = 32 << 20) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation."""
    rows = faults(damaged(conversations, conv_id=conv_id, turn=turn, role=role, text=text, damage=damage))
    sizes = rows.groupBy("conv_id").agg(F.count("*").alias("n"), F.sum(F.octet_length("text").cast("long")).alias("b"))
    long = kept(sizes.filter((F.col("n") > max_rows) | (F.col("b") > max_bytes)).select(F.col("conv_id").alias("_long")))
    if not long.take(1):
        return _repair_short(rows)
    # every long id stands for more than max_rows rows or max_bytes bytes, so this list is small against the table
    tagged = rows.join(long, F.col("conv_id").eqNullSafe(F.col("_long")), "left")
    is_long = F.col("_long").isNotNull()
    if conversations.schema[conv_id].nullable and long.filter("_long is null").take(1):
        is_long = is_long | F.col("conv_id").isNull()
    short = _repair_short(tagged.filter(~is_long).drop("_long"))
    alive = tagged.filter(is_long & F.col("alive")).drop("_long", "alive")
    solved = _repair_long(alive, max_rows, max_bytes)
    lost = long.alias("l").join(solved.alias("r"), F.col("l._long").eqNullSafe(F.col("r.conv_id")), "left_anti").select(
        F.col("_long").alias("conv_id"), *[F.lit(0).cast("long").alias(c) for c in ("gaps", *FAULTS, "illegal", "cost")],
        F.lit("").alias("audit"), F.lit(hashlib.sha256(b"").hexdigest()).alias("repaired_sha256"))
    return short.unionByName(solved).unionByName(lost)


# ---- query

def _add(s: str, cost: str, letter: str, piece: str) -> str:
    return f"CASE WHEN {s} IS NOT NULL THEN {{'c': {s}.c + {cost}, 'a': {s}.a || '{letter}', 'o': {s}.o || {piece}}} END"


def _sql() -> str:
    """Damage (crc32 bit by bit), faults, and the least (cost, audit) of every place of the pattern row by row."""
    kind = "STRUCT(c BIGINT, a VARCHAR, o VARCHAR)"
    drop = {q: _add(q, "4", "D", "''") for q in ("q0", "qs", "qu", "qa")}
    keep_piece = "chr(10) || role || ':' || text"
    rerole = {r: f"chr(10) || '{r}:' || text" for r in ("user", "assistant")}

    def least(*ways: str) -> str:
        return f"list_min([{', '.join(ways)}])"

    def fits(initial: str, way: str) -> str:
        return f"CASE WHEN initial = '{initial}' THEN {way} END"

    to_user = [w for q in ("q0", "qs", "qa") for w in (fits("u", _add(q, "more", "K", keep_piece)),
                                                       _add(q, "3 + more", "R", rerole["user"]))]
    to_pair = [fits("a", _add("qu", "more", "K", keep_piece)), _add("qu", "3 + more", "R", rerole["assistant"])]
    must = "fault IN ('blank', 'duplicate')"

    def read_row(q: str, ways: list[str]) -> str:
        return f"CASE WHEN {must} THEN {drop[q]} ELSE {least(drop[q], *ways)} END AS {q}"

    def insert(q: str, role: str) -> str:
        return _add(q, "3", "I", f"chr(10) || '{role}:'")

    return rf"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
checked AS (
  SELECT *, xor(list_reduce(flatten(list_transform(string_split(key, ''),
       lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
     lambda s, x: CASE WHEN x >= 0 THEN xor(s, x) ELSE xor(s >> 1, 3988292384 * (s & 1)) END,
     CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT)) % 20 AS what FROM raw),
hurt AS (
  SELECT conv_id, turn, CASE WHEN what = 4 THEN 'user' ELSE role END AS role,
         CASE what WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE WHEN what = 3 THEN 2 ELSE 1 END)) AS copy
  FROM checked WHERE what <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, substr(role, 1, 1) AS initial,
         regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z', 1) AS last FROM hurt),
told AS (
  SELECT *, CASE WHEN last = '' THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN last NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM placed),
rows_ AS (SELECT *, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS more FROM told),
ways AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, CAST({{'c': 0, 'a': '', 'o': ''}} AS {kind}) AS q0, CAST(NULL AS {kind}) AS qs,
         CAST({{'c': 3, 'a': 'I', 'o': chr(10) || 'user:'}} AS {kind}) AS qu,
         CAST({{'c': 6, 'a': 'II', 'o': chr(10) || 'user:' || chr(10) || 'assistant:'}} AS {kind}) AS qa
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i, q0, qs, qu, {least("qa", insert("qu", "assistant"))} AS qa FROM (
    SELECT conv_id, i, q0, qs, {least("qu", *[insert(q, "user") for q in ("q0", "qs", "qa")])} AS qu, qa FROM (
      SELECT w.conv_id, r.i, {read_row("q0", [])}, {read_row("qs", [fits("s", _add("q0", "more", "K", keep_piece))])},
             {read_row("qu", to_user)}, {read_row("qa", to_pair)}
      FROM ways w JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1))),
counted AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows_ GROUP BY conv_id),
best AS (
  SELECT w.conv_id, c.*, {least("w.q0", "w.qa")} AS b
  FROM ways w LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM w.conv_id WHERE w.i = coalesce(c.n, 0))
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, b.c AS cost, b.a AS audit, sha256(substr(b.o, 2)) AS repaired_sha256
FROM best"""


SQL = _sql()


@register("op13_conversation_repair", SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(read(spark, sf_dir, "conversations"))
