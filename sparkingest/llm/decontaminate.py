"""Benchmark decontamination by templates.

Numbers, names and units become typed placeholders; windows of the templates are hash-joined
between the benchmark and the documents. Where an item has placeholders, its values must map
consistently to those of the document, which finds questions with other parameters as well.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkingest.llm.words import SHINGLE, SIMILARITY, text_key, whole_text
from sparkingest.session import materialize

NUMBER, NAME, UNIT = "<num>", "<name>", "<unit>"

# Units that follow a number.
UNITS = (
    "mm|cm|dm|m|km|in|inch|inches|ft|feet|foot|yd|yards?|mi|miles?|met(?:er|re)s?|"
    "mg|g|kg|t|lbs?|oz|grams?|kilograms?|tons?|pounds?|"
    "ml|cl|dl|l|lit(?:er|re)s?|gal|gallons?|"
    "ms|s|sec|seconds?|min|minutes?|h|hrs?|hours?|days?|weeks?|months?|years?|"
    "hz|khz|mhz|ghz|w|kw|mw|kwh|v|mv|a|ma|pa|kpa|mpa|bar|n|j|kj|cal|kcal|mol|"
    "b|kb|mb|gb|tb|mph|kph|kmh|km/h|m/s|usd|eur|gbp|dollars?|euros?|cents?|percent"
)

# A name for certain is a capitalised word after a small letter, a digit or a comma: not one
# that opens a sentence or a line, and not one in a text of capitals.
_NAME = r"(?<=[\p{Ll}\p{Nd},;:] )\p{Lu}[\p{L}’']*"
# Any other capitalised word may be a name that opens a sentence or a line. Such words stand
# between two marks in the template.
_CAPITALISED = r"(?<![\p{L}\p{Nd}<])\p{Lu}[\p{L}’']*"
OPENS, CLOSES = "\x02", "\x03"
_NUMBER = r"[+-]?\d+(?:[.,:/]\d+)*"
_UNIT = rf"(<num>\s?)(?:{UNITS})(?![\p{{L}}\p{{Nd}}<])"
_SIGNS = rf"[^\p{{L}}\p{{Nd}}<>\s{OPENS}{CLOSES}]+"

# Between the values of a window's placeholders; a control character that is no blank.
SEPARATOR = "\x01"

# What the split of ``words`` takes for a blank.
BLANKS = " \t\n\x0b\f\r"

# Rows of benchmark windows up to which they are broadcast; beyond it they are shuffled.
BROADCAST_WINDOWS = 1_000_000


def template(text: Column) -> Column:
    """The text with placeholders and marks, in small letters and without signs; blanks stay,
    so what stands between them is that of the text, one for one."""
    named = F.regexp_replace(F.regexp_replace(text, f"[<>{OPENS}{CLOSES}]", ""), _NAME, NAME)
    marked = F.regexp_replace(named, _CAPITALISED, f"{OPENS}$0{CLOSES}")
    numbered = F.regexp_replace(F.lower(marked), _NUMBER, NUMBER)
    return F.regexp_replace(F.regexp_replace(numbered, _UNIT, f"$1{UNIT}"), _SIGNS, "")


def words(text: Column) -> Column:
    return F.split(text, r"\s")


def plain(marked: Column) -> Column:
    """The template in which marked words are words."""
    return F.translate(marked, f"{OPENS}{CLOSES}", "")


def all_named(marked: Column) -> Column:
    """The template in which marked words are names."""
    return F.regexp_replace(marked, f"{OPENS}[^{CLOSES}]*{CLOSES}", NAME)


def windows(form: Column, values: Column, width: int = SHINGLE) -> Column:
    """The place, a hash of each run of ``width`` words, the ``values`` of its placeholders
    and whether any of its words is none; nothing if there are fewer words."""
    count = F.size(form) - F.lit(width - 1)
    starts = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(
        starts,
        lambda i: F.struct(
            i.alias("place"),
            F.xxhash64(*(F.get(form, i + j) for j in range(width))).alias("hash"),
            F.concat_ws(SEPARATOR, *(F.get(values, i + j) for j in range(width))).alias("values"),
            functools.reduce(
                lambda x, y: x | y, (F.get(values, i + j).isNull() for j in range(width))
            ).alias("literal"),
        ),
    )


def _windowed(texts: DataFrame, *carried: str) -> DataFrame:
    """``carried, place, hash, values, literal`` for every window of ``texts(text)``.

    A window with a word that may be a name is there twice, with the word and with a name.
    """
    marked = words(template(F.col("text"))).alias("form")
    # Blanks in a row and signs that stand alone are no words.
    said = F.filter(F.arrays_zip(marked, words(F.col("text")).alias("raw")), lambda w: w["form"] != "")

    def slots(form: str) -> Column:
        return F.zip_with(form, "raw", lambda f, r: F.when(f.contains("<"), r))

    # Words without marks are alike in both templates, and so are their windows.
    first = windows(F.col("form"), F.col("form_slots"))
    second = windows(F.col("named"), F.col("named_slots"))
    more = F.filter("second", lambda w: w["hash"] != F.get("first", w["place"])["hash"])
    every = F.when(F.col("second").isNull(), F.col("first")).otherwise(F.concat("first", more))
    any_marked = F.exists("marked", lambda w: w.contains(OPENS))
    return (
        texts.select(*carried, said.alias("said"))
        .select(*carried, F.col("said.form").alias("marked"), F.col("said.raw").alias("raw"))
        .select(
            *carried,
            "raw",
            F.transform("marked", plain).alias("form"),
            F.when(any_marked, F.transform("marked", all_named)).alias("named"),
        )
        # Lists that a lambda reads are columns, or it would make them again per word.
        .select(
            *carried,
            "form",
            "named",
            slots("form").alias("form_slots"),
            slots("named").alias("named_slots"),
        )
        .select(
            *carried,
            first.alias("first"),
            F.when(F.col("named").isNotNull(), second).alias("second"),
        )
        # The outer form, as a filter on non-empty lists would compute them again per word.
        .select(*carried, F.explode_outer(every).alias("window"))
        .select(*carried, "window.*")
    )


def window_hashes(texts: DataFrame, *carried: str) -> DataFrame:
    """``carried, hash`` for every window of ``texts(text)``, those of ``_windowed``.

    Without lambdas, places and values, so that all of it is compiled: the words and the same
    words from the second, third, ... on are zipped, and a row of these is a window.
    """

    def shifted(form: str, n_words: str) -> list[Column]:
        starts = F.greatest(F.col(n_words) - F.lit(SHINGLE - 1), F.lit(0))
        return [F.slice(form, i + 1, starts).alias(f"{form}{i}") for i in range(SHINGLE)]

    def said(form: Column) -> Column:
        return F.split(F.btrim(form, F.lit(BLANKS)), r"\s+")

    marked = F.col("marked")
    zipped = F.arrays_zip(*shifted("form", "n_words"), *shifted("named", "n_words"))
    first = F.xxhash64(*(f"window.form{i}" for i in range(SHINGLE)))
    second = F.xxhash64(*(f"window.named{i}" for i in range(SHINGLE)))
    return (
        texts.select(*carried, template(F.col("text")).alias("marked"))
        .select(
            *carried,
            said(F.regexp_replace(marked, f"[{OPENS}{CLOSES}]", "")).alias("form"),
            said(F.regexp_replace(marked, f"{OPENS}[^{CLOSES}]*{CLOSES}", NAME)).alias("named"),
        )
        .select(*carried, "form", "named", F.size("form").alias("n_words"))
        .select(*carried, F.explode(zipped).alias("window"))
        .select(*carried, first.alias("first"), second.alias("second"))
        .select(
            *carried,
            F.explode(
                F.when(F.col("first") == F.col("second"), F.array("first")).otherwise(
                    F.array("first", "second")
                )
            ).alias("hash"),
        )
    )


def rarest_windows(item_windows: DataFrame, similarity: float) -> DataFrame:
    """``item, hash`` of the windows of which a text with ``similarity`` of an item's has one.

    Of n places a text must cover the least whole number of at least ``similarity * n``, so it
    has one of any n - that + 1 places. Taken are those whose windows the fewest items share:
    a beginning that many items have in common is then no reason to compare.
    """
    shared = item_windows.groupBy("hash").agg(F.count_distinct("item").alias("items"))
    # A place counts as rare as the most common of its windows.
    places = (
        item_windows.join(shared, "hash")
        .groupBy("item", "at")
        .agg(F.max("items").alias("items"), F.collect_set("hash").alias("hashes"))
    )
    of_item = Window.partitionBy("item")
    return (
        places.withColumn("n", F.count("*").over(of_item))
        .withColumn("rank", F.row_number().over(of_item.orderBy("items", "at")))
        # Rounding must not make the least number larger.
        .where(F.col("rank") <= F.col("n") - F.ceil(F.col("n") * F.lit(similarity) - 1e-9) + 1)
        .select("item", F.explode("hashes").alias("hash"))
        .distinct()
    )


def contaminated_texts(
    docs: DataFrame,
    benchmark: DataFrame,
    item_column: str,
    text_column: str,
    similarity: float,
) -> DataFrame:
    """``key, item, coverage, changed`` for texts that hold an item's template."""
    items = benchmark.select(
        F.col(item_column).alias("item"), whole_text(text_column).alias("text")
    )
    item_windows = materialize(
        _windowed(items, "item")
        # A window of placeholders alone says nothing about an item.
        .where("literal")
        .select("item", F.col("place").alias("at"), "hash", F.col("values").alias("asked")),
        "item-windows",
    )
    wanted = item_windows.groupBy("item").agg(F.count_distinct("at").alias("n_windows"))
    rarest = materialize(rarest_windows(item_windows, similarity), "item-rarest")
    probe = F.broadcast(rarest) if rarest.count() <= BROADCAST_WINDOWS else rarest

    texts = docs.select(
        text_key(text_column).alias("key"), whole_text(text_column).alias("text")
    )
    # Every window of every text is looked up, by its hash alone; places and values are
    # taken from texts with a hit, and counted for the items that they hit. A text goes along
    # with its windows, as a reference, and only those with a hit are written and dealt out.
    held = materialize(
        window_hashes(texts, "key", "text")
        .join(probe, "hash")
        .groupBy("key")
        .agg(
            # A null item would be left out of a set, a struct of it is not.
            F.collect_set(F.struct("item")).alias("items"),
            F.any_value("text").alias("text"),
        ),
        "template-held",
    )
    touched = held.select("key", F.inline("items"))
    # Windows that no item has are left where they are.
    asked_hashes = item_windows.select("hash").distinct()
    if asked_hashes.count() <= BROADCAST_WINDOWS:
        asked_hashes = F.broadcast(asked_hashes)
    touched_windows = touched.withColumnRenamed("item", "_item").join(
        item_windows, F.col("_item").eqNullSafe(F.col("item"))
    )
    hits = materialize(
        _windowed(held.select("key", "text"), "key")
        .select("key", "place", "hash", F.col("values").alias("given"))
        .join(asked_hashes, "hash", "left_semi")
        .join(touched_windows.select("key", "item", "at", "hash", "asked"), ["key", "hash"])
        .select("key", "item", "at", "place", "asked", "given")
        .distinct()
        .withColumn("shift", F.col("place") - F.col("at")),
        "template-hits",
    )
    covered = (
        hits.groupBy("key", "item")
        .agg(F.count_distinct("at").alias("found"))
        .join(wanted.withColumnRenamed("item", "_item"), F.col("item").eqNullSafe(F.col("_item")))
        .select("key", "item", (F.col("found") / F.col("n_windows")).alias("coverage"))
        .where(F.col("coverage") >= F.lit(similarity))
    )
    # Places of an item and a text are compared along the shift that most windows share.
    shifts = (
        hits.groupBy("key", "item", "shift")
        .agg(F.count("*").alias("n"))
        .groupBy("key", "item")
        .agg(F.max_by("shift", F.struct("n", -F.col("shift"))).alias("shift"))
    )
    same = [
        shifts["key"] == covered["key"],
        shifts["item"].eqNullSafe(covered["item"]),
    ]
    candidates = materialize(
        covered.join(shifts, same).select(covered["key"], covered["item"], "coverage", "shift"),
        "template-candidates",
    )
    # Values of placeholders met along that shift, as distinct pairs.
    main = hits.where(F.col("asked") != "").join(
        candidates.select(
            "key", F.col("item").alias("_item"), "shift"
        ),
        ["key", "shift"],
    )
    met = main.where(F.col("item").eqNullSafe(F.col("_item"))).select(
        "key",
        "item",
        F.explode(
            F.arrays_zip(
                F.split("asked", SEPARATOR).alias("asked"), F.split("given", SEPARATOR).alias("given")
            )
        ).alias("pair"),
    )
    checked = (
        met.select("key", "item", "pair.asked", "pair.given")
        .distinct()
        .groupBy("key", F.col("item").alias("_item"))
        .agg(
            F.count_distinct("asked").alias("values"),
            F.count("*").alias("pairs"),
            F.count_if(~F.col("asked").eqNullSafe(F.col("given"))).alias("changed"),
        )
        .withColumnRenamed("key", "_key")
    )
    # Consistent: nearly every value of the item stands for one value in the text.
    on = (F.col("key") == F.col("_key")) & F.col("item").eqNullSafe(F.col("_item"))
    return (
        candidates.join(checked, on, "left")
        .select(
            "key",
            "item",
            "coverage",
            F.coalesce("changed", F.lit(0)).alias("changed"),
            F.coalesce(F.col("values") / F.col("pairs"), F.lit(1.0)).alias("consistency"),
        )
        .where(F.col("consistency") >= F.lit(similarity))
        .drop("consistency")
    )


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    similarity: float = SIMILARITY,
) -> DataFrame:
    """One row per input row: ``id, contaminated, items, coverage, changed_slots``.

    A text is contaminated if it holds at least ``similarity`` of the five-word template
    windows of an item and the item's numbers, names and units map to one value each there
    (again ``similarity`` of them at least). A capitalised word that opens a sentence or a line
    may be a name or a word: a window counts if it is found either way. ``items`` lists the items
    in order, ``coverage`` is the largest, ``changed_slots`` counts the values that differ from
    the benchmark's. Values are compared along the shift between text and item that most windows
    share, the smallest of several such. A clean row has an empty list, coverage null and 0. A
    null text is empty and clean. Items of fewer than five words, or of placeholders alone,
    match nothing; repeated item rows count as one item. Repeated rows of documents give a row
    each, an empty table none, and against an empty benchmark all are clean. Other columns are
    not read.
    """
    items = benchmark.select(item_column, text_column).dropDuplicates([item_column])
    found = contaminated_texts(docs, items, item_column, text_column, similarity)
    by_text = found.groupBy("key").agg(
        F.sort_array(F.collect_list("item")).alias("items"),
        F.max("coverage").alias("coverage"),
        F.sum("changed").alias("changed_slots"),
    )
    rows = docs.select(F.col(id_column).cast("bigint").alias("id"), text_key(text_column).alias("key"))
    item_type = items.schema[item_column].dataType.simpleString()
    return rows.join(by_text, "key", "left").select(
        F.col("id").alias(id_column),
        F.col("items").isNotNull().alias("contaminated"),
        F.coalesce("items", F.array().cast(f"array<{item_type}>")).alias("items"),
        "coverage",
        F.coalesce("changed_slots", F.lit(0)).cast("bigint").alias("changed_slots"),
    )
