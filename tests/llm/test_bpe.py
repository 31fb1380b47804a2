from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.conftest import SMALL
from tests.llm.shared import ODD_TEXTS, documents
from tillwright.llm import bpe, queries


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _texts() -> list[str]:
    rng = random.Random(2)
    letters = "aAbBéÉΣσ'stred 0½\n\t\x1c\x85 _-.,😀İßǅ한ᄀ́"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(400)]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 0x2000), rng.randrange(0x10000, 0x1FFFF)])) for _ in range(20)) for _ in range(200)]
    return texts + ["<|startoftext|>hi<|endoftext|> x", "<|STARTOFTEXT|>", "don't I'LL we've", "x" * 3000, "Σας ΟΔΟΣ"]


def test_ids_and_decoded_text_are_the_library_s(library):
    own = bpe.Codec(bpe.vocabulary())
    for text in [t or "" for t in ODD_TEXTS] + _texts():
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids, text
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False), text


def test_a_full_memory_does_not_change_ids(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 2)
    own = bpe.Codec(bpe.vocabulary())
    text = "the heather that was there then other weather"
    assert own.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_columns_and_clashing_names(spark, library):
    docs = documents(spark, ODD_TEXTS).withColumns({"n_tokens": F.lit(1), "ids": F.lit(2), "digest": F.lit(3)})
    rows = docs.select("text", bpe.encode(F.col("text")).alias("own"), bpe.decode(bpe.encode(F.col("text"))).alias("back")).collect()
    assert len(rows) == len(ODD_TEXTS)
    for row in rows:
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids
        assert row["own"] == ids
        assert row["back"] == library.decode(ids, skip_special_tokens=False)
    assert bpe.round_trip(docs).count() == len(ODD_TEXTS)
    assert bpe.round_trip(docs.limit(0)).count() == 0


def test_whole_table(spark, library):
    texts = dict(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect())
    rows = queries.op6_bpe(spark, SMALL).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row["doc_id"]] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()
