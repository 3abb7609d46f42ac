"""Small tables with everything that an operator must bear."""

from __future__ import annotations

import random

import pandas as pd

# Names that operators use inside, as extra columns of a table.
CLASHING = (
    "id", "key", "norm", "length", "digest", "value", "node", "bands", "bucket", "parts", "rate",
    "doc", "copies", "shard", "size", "edge", "label", "domain", "item", "centre", "span", "low",
    "class_id", "kept", "n_tokens", "time", "features", "score", "link", "position", "_leaked",
)

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(seed: int, words: int, vocabulary: int = 3000) -> str:
    chooser = random.Random(seed)
    numbers = (str(chooser.randrange(vocabulary)) for _ in range(words))
    return " ".join("w" + "".join(chr(97 + int(c)) for c in n) for n in numbers)


def awkward_rows() -> list[tuple]:
    """Nulls in any column, empty and very long texts, ties and repeated rows."""
    long_text = prose(1, 40_000)
    texts = [
        (1, prose(2, 120)),
        (2, prose(2, 120)),
        (2, prose(2, 120)),
        (3, " " + prose(2, 120).replace(" ", "\t")),
        (4, ""),
        (5, None),
        (5, None),
        (None, prose(3, 80)),
        (None, None),
        (6, " \n\t "),
        (7, long_text),
        (8, long_text + " end"),
        (9, "x" * 200_000),
        (10, "one two three"),
        (11, "!!! ??? ***"),
        (12, "naïve café 世界 𝔘𝔫𝔦 " * 30),
        (2**62, prose(4, 60)),
        (-3, prose(4, 60)),
    ]
    return [
        (i, t, None if n % 5 == 0 else "en", None if n % 3 == 0 else "src0", None)
        for n, (i, t) in enumerate(texts)
    ]


def with_extras(df):
    from pyspark.sql import functions as F

    return df.select("*", *(F.lit(f"extra {c}").alias(c) for c in CLASHING))


def documents(spark, rows=None):
    return with_extras(spark.createDataFrame(awkward_rows() if rows is None else rows, SCHEMA))


def no_documents(spark):
    return with_extras(spark.createDataFrame([], SCHEMA))


def table(spark, sf_dir, name) -> pd.DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").toPandas()


def words_of(text: str | None) -> list[str]:
    import re

    return re.findall(r"\w+", (text or "").lower())


def shingle_bag(text: str | None):
    from collections import Counter

    words = words_of(text)
    width = min(5, len(words))
    if not words:
        return Counter()
    return Counter(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def jaccard(a, b) -> float:
    both = sum((a & b).values())
    either = a.total() + b.total() - both
    return both / either if either else 0.0
