"""Small tables that hold the awkward cases: nulls, empty and long texts, repeated rows, and columns of clashing names."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, n_words int, row string, spans string, key string, fp int"


def prose(seed: int, words: int) -> str:
    source = random.Random(seed)
    vocabulary = [f"w{source.randrange(400)}" for _ in range(60)] + ["the", "and", "of", "to"] * 8
    return " ".join(source.choice(vocabulary) for _ in range(words))


def texts() -> list[str | None]:
    some = [prose(k, 20 + 13 * k) for k in range(12)]
    return [
        *some,
        some[3],
        some[3] + " more",
        None,
        "",
        " \t\n",
        "One",
        "A b \x1c c d É ß 日本 \U0001f600 x",
        "line\nline\n\n line\nother\r\nline",
        prose(99, 30_000),
        "a a a a a a a",
        "\\ <|end|> [INST]",
    ]


def awkward(spark: SparkSession) -> DataFrame:
    """Every text once, one row twice, one without id."""
    rows = [(k, text, k, "r", "s", "k", 1) for k, text in enumerate(texts())]
    rows += [rows[3], (None, "no id here", None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)
