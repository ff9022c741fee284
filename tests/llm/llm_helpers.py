"""Small tables and brute-force versions for the operators' tests."""
import os
import random
import re

from pyspark.sql import functions as F

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
CLASHING = ("name", "block", "route", "sha", "found", "marks", "root", "kept_id", "gone_id", "weight", "score", "body")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def importable(spark):
    spark.sparkContext.environment["PYTHONPATH"] = REPO
    return spark


def documents(spark, rows, clashing=True):
    """A documents table of (doc_id, text), with columns whose names the operators use themselves."""
    df = importable(spark).createDataFrame(
        [(i, t, None, "s", None if t is None else len(t)) for i, t in rows], DOCS)
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHING]) if clashing else df


def edge_rows(seed=3):
    """Nulls, empty and long texts, ties, repeated rows, copies and near copies."""
    r = random.Random(seed)
    words = ["alpha", "Beta", "gamma", "délta", "EPS", "zeta,", "eta.", "θ", "日本", "12"]
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "One two"), (None, "no id"), (None, None), (None, "no id"),
            (6, "same Text"), (7, "SAME text"), (7, "SAME text"), (8, "a b c"), (8, "another text of one id"),
            (9, "word " * 30_000), (10, "x" * 50_000), (11, "ÀB"), (12, "àb")]
    for g in range(6):
        text = [r.choice(words) + str(r.randint(0, 40)) for _ in range(r.choice([12, 40, 120]))]
        for c in range(7):
            copy = list(text)
            for _ in range(r.choice([0, 0, 1, 2, 5])):
                copy[r.randrange(len(copy))] = "changed" + str(r.randint(0, 3))
            rows.append((100 + 10 * g + c, " ".join(copy)))
    return rows


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, str(x)) for x in r))
