"""Small frames for the operators' tests."""

import random

WORDS = [a + b for a in ("ka", "lo", "mi", "te", "su", "ra", "no", "vi") for b in ("ran", "bel", "dor", "min", "sta", "pel", "gor", "fen", "lis", "tam")]


def prose(seed: int, n: int = 120) -> list[str]:
    r = random.Random(seed)
    return [r.choice(WORDS) + (r.choice(WORDS) if r.random() < 0.4 else "") for _ in range(n)]


def documents(spark, rows):
    """`rows`: (doc_id, text). With the other columns of documents, and extra ones whose names operators use inside."""
    return spark.createDataFrame(
        [(i, t, "en", "src", len(t) if t is not None else None, "x", 7, "y") for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long, `row` string, size long, `key` string",
    )


def collect(df, key):
    return {r[key]: r for r in df.collect()}
