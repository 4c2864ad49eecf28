"""Small tables with the cases that every operator has to take: NULLs, empty and long texts, ties,
repeated rows, and columns named like the operators' own."""

from __future__ import annotations

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi".split()
PASSAGE = " ".join(f"{w}{k}" for k, w in enumerate(WORDS * 3))  # 48 words
LONG = " ".join(f"w{k * 7919 % 5003}" for k in range(30_000))

TEXTS = [
    (0, f"start {PASSAGE} end", "en", "a"),
    (1, f"Other start\n{PASSAGE}\tother end", "en", "b"),
    (2, None, "en", "a"),
    (3, "", None, None),
    (4, " \t\n\x0b\x0c\r ", "de", None),
    (5, "one", "de", "c"),
    (6, LONG, "de", "c"),
    (7, LONG + " more", "de", "c"),
    (7, "the same id with another text " * 5, "de", "c"),
    (8, "repeated row " * 12, "fr", "b"),
    (8, "repeated row " * 12, "fr", "b"),
    (9, "again again " * 40, "fr", "b"),
    (10, "ÄÖÜ ßß été œuvre 日本語 русский 123 !!!  nbsp em", "de", "a"),
    (11, f"start {PASSAGE} end", "en", "a"),
    (None, "no id here but some words in it", "en", "a"),
    (-5, "negative id <|endoftext|> <|im_end|>", "en", "d"),
]

SCHEMA = "doc_id long, text string, lang string, source string"
#: Names that the operators use themselves.
CLASHES = ["hash", "bad", "score", "lang_pred", "key", "bucket", "row", "size", "target", "tile",
           "kept_hash", "mix_nth", "text_hash", "nth", "times", "fingerprint", "component_id"]


def documents(spark, rows=TEXTS):
    """The rows over several partitions, with clashing columns."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHES])


def no_documents(spark):
    return documents(spark, [])


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)
