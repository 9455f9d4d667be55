"""Conversation repair against a row-by-row search that keeps every cheapest audit's least form."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from lanewatch.llm import repair as R

SCHEMA = "conv_id long, turn long, role string, text string"
EMPTY = hashlib.sha256(b"").hexdigest()


def brute_code(code: str) -> tuple[int, str]:
    """Least (cost, audit) by place, row by row, inserts closed after each row."""
    def closed(best):
        for q, x, to in ((0, "u", 2), (1, "u", 2), (3, "u", 2), (2, "a", 3)):
            if q in best:
                way = (best[q][0] + 3, best[q][1] + "I")
                best[to] = min(best.get(to, way), way)
        return best
    best = closed({0: (0, "")})
    for c in code:
        now = {}

        def put(q, way):
            now[q] = min(now.get(q, way), way)
        for q, (cost, audit) in best.items():
            put(q, (cost + 4, audit + "D"))
            if c == "-":
                continue
            more = 3 if c.isupper() else 0
            for x in "sua":
                if (q, x) in R.STEP:
                    if c.lower() == x:
                        put(R.STEP[q, x], (cost + more, audit + "K"))
                    elif x != "s":
                        put(R.STEP[q, x], (cost + more + 3, audit + "R"))
        best = closed(now)
    return min(best[q] for q in R.ENDS if q in best)


def test_search_is_the_cheapest():
    rng = random.Random(5)
    for n in range(9):
        for _ in range(150):
            code = "".join(rng.choice("suaxSUAX-") for _ in range(n))
            assert R.cheapest(code) == brute_code(code), code
    for _ in range(60):
        code = "".join(rng.choice("uaua-Us") for _ in range(rng.randrange(20, 120)))
        assert R.cheapest(code) == brute_code(code), code


def test_search_stops_where_the_heaps_meet():
    """A sound conversation is its own repair."""
    assert R.cheapest("s" + "ua" * 2000) == (0, "K" * 4001)


def test_runs_combine():
    rng = random.Random(6)
    for _ in range(60):
        code = "".join(rng.choice("suaxUA--") for _ in range(rng.randrange(1, 40)))
        cut = sorted(rng.sample(range(1, len(code) + 1), min(3, len(code))))
        parts = [code[a:b] for a, b in zip([0, *cut], [*cut, len(code)])]
        tables = [{(a, b): way for a in range(4) for b in range(4) if (way := R.cheapest(p, a, (b,)))} for p in parts]
        cost, audits, places = R.combine(tables)
        assert (cost, "".join(audits)) == brute_code(code) and places[0] == R.START


def expected(rows):
    """The contract, conversation by conversation."""
    by = {}
    for conv, turn, role, text in rows:
        own = by.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        what = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if what == 0:
            continue
        text = "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text
        own += [(turn, "user" if what == 4 else role, text)] * (2 if what == 3 else 1)
    out = {}
    for conv, own in by.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, code, count = set(), "", dict.fromkeys(R.FAULTS, 0)
        for _, role, text in own:
            last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
            fault = ("blank" if not last else "duplicate" if (role, text) in seen
                     else "truncated" if last[0] not in ".!?" else None)
            seen.add((role, text))
            if fault:
                count[fault] += 1
            c = "-" if fault in ("blank", "duplicate") else role[:1] if role[:1] in ("s", "u", "a") else "x"
            code += c.upper() if fault == "truncated" else c
        cost, audit = brute_code(code)
        left, place, it = [], 0, iter(own)
        for a in audit:
            row = None if a == "I" else next(it)
            if a == "D":
                continue
            role = row[1] if a == "K" else ("assistant" if place == R.USER else "user")
            left.append(f"{role}:{row[2] if row else ''}")
            place = R.STEP[place, role[0]]
        turns = {t for t, _, _ in own if t is not None}
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *count.values(),
                     sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") or not (a[1] and b[1]) for a, b in zip(own, own[1:])),
                     cost, audit, hashlib.sha256("\n".join(left).encode()).hexdigest())
    return out


def conversations(seed=2):
    rng, rows = random.Random(seed), []
    lines = ["Yes.", "No!", "Why?", "cut off", "", " \t\n", "Fine. \n", "é.", None, "x" * 2000, "a.b", "\x1f", " "]
    for conv in range(60):
        for turn in range(rng.randrange(0, 14)):
            rows.append((conv, turn if rng.random() < 0.9 else None, rng.choice(["user", "assistant", "user", "assistant", "system",
                         "tool", "", None]), rng.choice(lines) if rng.random() < 0.5 else f"line {rng.random()}."))
    rows += [(100, t, ("user", "assistant")[t % 2], f"turn {t}.") for t in range(90)]           # long
    rows += [(101, 5, "user", "Same.")] * 30 + [(101, 6, "assistant", "Other.")] * 12            # repeated rows, one turn
    rows += [(102, t, "user", "Again.") for t in range(40)]
    rows += [(None, t % 3, "user", f"nobody {t % 7}.") for t in range(20)] + [(103, None, None, None)]
    dropped = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    rows += [(dropped, 1, "user", "gone.")] * 9
    return rows


def check(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for c in ("alive", "blank", "open", "code", "run", "part", "place", "m", "_long", "audit"):
        df = df.withColumn(c, F.lit("own"))
    got = R.repair(df, **options).collect()
    want = expected(rows)
    assert len(got) == len(want)
    for r in got:
        assert tuple(r)[1:] == want[r.conv_id], r.conv_id


@pytest.mark.parametrize("options", [{}, {"max_rows": 7}, {"max_rows": 3, "max_bytes": 60}])
def test_repair(spark, options):
    """Whole conversations, and the same cut into short runs."""
    check(spark, conversations(), **options)


def test_empty(spark):
    assert R.repair(spark.createDataFrame([], SCHEMA)).count() == 0


def test_undamaged(spark):
    rows = [(1, 0, "user", "Hello."), (1, 1, "assistant", "Yes?"), (2, 0, "assistant", "open")]
    got = {r.conv_id: r for r in R.repair(spark.createDataFrame(rows, SCHEMA), damage=False).collect()}
    assert (got[1].cost, got[1].audit) == (0, "KK") and (got[2].cost, got[2].audit) == (4, "D")
    assert got[2].repaired_sha256 == EMPTY
