"""Languages against a plain mixture model, and against the labels that were held out."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from sparkingest.llm import languages as g
from sparkingest.llm.queries import QUERIES
from sparkingest.llm.words import mixed
from tests.llm.fixtures import CLASHING, documents, no_documents, table


def plain_words(text: str) -> list[list[int]]:
    """Buckets of the three-letter sequences of each word."""
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    code = lambda t: sum((0 if c == " " else ord(c)) << s for c, s in zip(t, (42, 21, 0), strict=True))
    bucket = lambda t: int(mixed(np.array([code(t)], dtype=np.uint64))[0]) >> (64 - g.BUCKET_BITS)
    return [[bucket(f" {w} "[i : i + 3]) for i in range(len(w))] for w in words]


TEXTS = ["Hello, World's end", "", "...", "é1a  B", "İstanbul ΣΑΣ x", "世界 ok", "a" * 50, "one\ttwo\nthree"]


def test_sequences():
    buckets, words, per_text = g.grams(TEXTS)
    expected = [plain_words(t) for t in TEXTS]
    assert per_text.tolist() == [len(w) for w in expected]
    flat = [w for text in expected for w in text]
    assert np.split(buckets, words[1:])[0].tolist() == flat[0]
    assert [x.tolist() for x in np.split(buckets, words[1:])] == flat


def plain_mixture(rows: list[list[float]]) -> list[float]:
    """The same model by loops over words: ``rows`` are logarithms by language."""
    count = len(rows[0])
    tops = [max(r) for r in rows]

    def fit(allowed):
        share = [1 / len(allowed) if i in allowed else 0.0 for i in range(count)]
        for _ in range(g.ROUNDS):
            new = [0.0] * count
            for r, top in zip(rows, tops, strict=True):
                joint = [s * math.exp(x - top) for s, x in zip(share, r, strict=True)]
                for i, j in enumerate(joint):
                    new[i] += j / sum(joint)
            share = [x / sum(new) for x in new]
        likely = sum(
            math.log(sum(s * math.exp(x - top) for s, x in zip(share, r, strict=True)))
            for r, top in zip(rows, tops, strict=True)
        )
        return share, likely

    full, _ = fit(set(range(count)))
    alone = [sum(r[i] - top for r, top in zip(rows, tops, strict=True)) for i in range(count)]
    first = alone.index(max(alone))
    chosen, best = {first}, alone[first]
    share = [float(i == first) for i in range(count)]
    for i in sorted(range(count), key=lambda i: -full[i]):
        if i in chosen:
            continue
        wider, likely = fit(chosen | {i})
        if likely <= best + 0.5 * math.log(len(rows)):
            break
        chosen, best, share = chosen | {i}, likely, wider
    return share


@pytest.mark.parametrize("seed", range(5))
def test_mixtures(seed):
    rng = np.random.default_rng(seed)
    per_text = rng.integers(1, 30, size=40)
    logs = rng.normal(-4, 1.5, size=(per_text.sum(), 4))
    for begin, n in zip(np.cumsum(per_text) - per_text, per_text, strict=True):
        logs[begin : begin + n, rng.integers(0, 4, size=2)] += rng.choice([0, 2], size=(n, 1))
    found = g.mixtures(logs, per_text)
    ends = np.cumsum(per_text)
    expected = [plain_mixture(logs[e - n : e].tolist()) for e, n in zip(ends, per_text, strict=True)]
    assert np.allclose(found, expected, atol=1e-9)
    assert {1, 2} <= set((found > 0).sum(axis=1).tolist())


def test_one_pass_or_many(monkeypatch):
    texts = ["some words of a text", "", "autre chose encore " * 20]
    logs = np.log(np.random.default_rng(1).dirichlet([1] * (1 << g.BUCKET_BITS), size=3).T + 1e-9)
    whole, _ = g.block_mixtures(texts, logs.astype(np.float32))
    monkeypatch.setattr(g, "BLOCK_CELLS", 30)
    assert np.allclose(g.block_mixtures(texts, logs.astype(np.float32))[0], whole)


def test_counts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(5)
    found = {(x["language"], x["bucket"]): x["n"] for x in g.gram_counts(docs, "lang", "text").collect()}
    expected: Counter = Counter()
    for lang, text in docs.select("lang", "text").toPandas().itertuples(index=False):
        expected.update((lang, b) for word in plain_words(text) for b in word)
    assert found == dict(expected)


def test_held_out_languages(spark, sf_dir):
    source = table(spark, sf_dir, "documents").set_index("doc_id")
    found = QUERIES["op12_language_id"](spark, sf_dir).toPandas()
    assert sorted(found.doc_id) == sorted(source.index)
    held = found[found.held_out]
    assert set(held.doc_id) == {i for i in source.index if zlib.crc32(str(i).encode()) % 5 == 0}
    right = held.lang_pred == source.lang.reindex(held.doc_id).to_numpy()
    assert right.mean() >= 0.98
    assert found.score.between(0, 1).all()


def test_mixed_text(spark, sf_dir):
    source = table(spark, sf_dir, "documents")
    long = source[source.text.str.len().between(2000, 4000)]
    pick = lambda lang: long[long.lang == lang].text.iloc[0]
    text = pick("de")[:2000] + "\n" + pick("fr")[:1000]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = g.language_model(g.gram_counts(docs, "lang", "text"))
    row = g.identify(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), *model).first()
    assert row["language"] == "de" and 0.5 < row["score"] < 0.85
    assert set(row["mixture"]) == {"de", "fr"}


def test_labels_outside_the_fold_do_not_matter(spark, sf_dir):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    hidden = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 != 0, F.col("lang")))
    before = g.predict_languages(docs).drop("mixture").toPandas().sort_values("doc_id")
    after = g.predict_languages(hidden.withColumn("source", F.lit(None))).drop("mixture")
    assert before.equals(after.toPandas().sort_values("doc_id").set_axis(before.index))


def test_awkward_rows(spark):
    found = g.predict_languages(documents(spark)).collect()
    assert len(found) == 18
    by_id = {x["doc_id"]: x for x in found if x["doc_id"] is not None}
    for i in (4, 5, 6, 11):
        assert (by_id[i]["lang_pred"], by_id[i]["score"], by_id[i]["mixture"]) == ("und", 0.0, {})
    assert by_id[7]["lang_pred"] == "en" and by_id[7]["score"] == 1.0
    assert not any(x["held_out"] for x in found if x["doc_id"] is None)


def test_empty_and_unlabelled_tables(spark):
    assert g.predict_languages(no_documents(spark)).count() == 0
    docs = spark.createDataFrame([(1, "a word", None)], "doc_id bigint, text string, lang string")
    assert g.predict_languages(docs).select("lang_pred", "score").first() == ("und", 0.0)
    assert "lang" not in CLASHING
