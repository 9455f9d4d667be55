"""Small fixtures: nulls, empty and long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(rng: random.Random, n: int, vocabulary: int = 4000) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def corpus(seed: int = 3) -> list[tuple]:
    """About 120 documents: exact copies, near copies, shared passages, edge cases."""
    rng, rows = random.Random(seed), []
    passage, line = words(rng, 60), words(rng, 36)
    base = words(rng, 300)
    for i in range(40):
        rows.append(" ".join(words(rng, rng.randrange(1, 400))))
    for i in range(15):                                    # exact copies
        rows.append(" ".join(base))
    for i in range(15):                                    # near copies, each different
        x = list(base)
        x[rng.randrange(300)] = f"change{i}"
        rows.append(" ".join(x))
    for i in range(10):                                    # a passage in different places
        x = words(rng, 80)
        at = rng.randrange(80)
        rows.append(" ".join(x[:at] + passage + x[at:]))
    once = words(rng, 30)
    rows.append(" ".join(once + line + words(rng, 5) + line + once))      # a repeat inside one document
    rows += [None, "", " \n\t ", "one", "one two", "One TWO", "ÉTÉ élan ñandú straße", "x" * 3000, "a\nb\r\nc\x0bd",
             "   .,;!? 123", "?!", None, "日本語 テキスト 東京", "it's we're <|endoftext|> don't 12x ½ naïve"]
    rows.append(" ".join(words(rng, 30_000, 50_000)))      # very long
    rows += [rows[3], rows[3]]
    return [(i, t, ("en", "fr", None)[i % 3], f"s{i % 2}", None if t is None else len(t)) for i, t in enumerate(rows)]


def frame(spark: SparkSession, rows: list[tuple], parts: int = 3) -> DataFrame:
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def clashing(df: DataFrame) -> DataFrame:
    """Extra columns under names that operators use themselves."""
    from pyspark.sql import functions as F
    for c in ["_found", "unit", "words", "body", "bucket", "rep", "component_id", "kept", "label", "shard", "slot", "score",
              "lang_pred", "n_words", "length", "_rank", "h", "fp", "host", "rule", "page", "f0", "grp", "cell"]:
        df = df.withColumn(c, F.lit(f"own {c}"))
    return df


def plain_words(text: str | None, lower: bool = False) -> list[str]:
    text = (text or "").translate(LOWER) if lower else text or ""
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def alnum_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
