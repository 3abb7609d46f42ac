from __future__ import annotations

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sparkingest.llm import tokens
from tests.llm.fixtures import awkward_rows, documents, no_documents, prose

PATH = str(public_tokenizers.path(tokens.VOCABULARY))
LIBRARY = Tokenizer.from_file(PATH)


def counted(text: str) -> int:
    return len(LIBRARY.encode(text, add_special_tokens=False))


TRICKY = [
    "",
    " ",
    "a  b   c    d\n\n\n e\t\tf   ",
    "it's we're they'll I'd you've 'tis 's",
    "x<|endoftext|>y <|endoftext|> <|endoftext",
    "<|endoftext|>" * 40,
    "naïve café 世界 𝔘𝔫𝔦     x́",
    "1234 5678,90 3.14 -7",
    "a" * 700,
    ("b" * 90 + " ") * 12,
    "!?!?... --- ###" * 30,
]


@pytest.mark.parametrize("chunk, overlap", [(20, 4), (50, 8), (64, 32), (10_000, 10)])
def test_chunks_give_what_the_library_gives(chunk, overlap):
    encoder = tokens.load(PATH)
    chooser = random.Random(chunk)
    texts = TRICKY + ["".join(chooser.choices(TRICKY, k=8)) for _ in range(30)]
    texts += [prose(s, 300) for s in range(5)]
    for text in texts:
        assert tokens.count_tokens(text, encoder, chunk, overlap) == counted(text), text[:80]


def test_whole_table(spark, sf_dir):
    from sparkingest.llm.queries import QUERIES

    found = {r.doc_id: r for r in QUERIES["op1_token_counts"](spark, sf_dir).collect()}
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(found) == len(rows)
    for row in rows:
        expected = counted(row.text)
        got = found[row.doc_id]
        assert (got.n_bytes, got.n_tokens) == (len(row.text.encode()), expected)
        assert got.over_limit == (expected > 1024)


def test_awkward_rows(spark):
    got = tokens.token_counts(documents(spark), PATH).collect()
    expected = [(i, len((t or "").encode()), counted(t or "")) for i, t, *_ in awkward_rows()]
    assert sorted(map(repr, ((r.doc_id, r.n_bytes, r.n_tokens) for r in got))) == sorted(
        map(repr, expected)
    )
    assert tokens.token_counts(no_documents(spark), PATH).collect() == []


def test_other_kinds_are_refused():
    with pytest.raises(ValueError, match="cannot be spliced"):
        tokens.load(str(public_tokenizers.path("word_bpe_49k.json")))
