"""BPE against the tokenizers library."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marketlake.llm import bpe
from marketlake.llm.queries import op2_bpe_round_trip, tokenizer_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


def test_ids_equal_the_library(library):
    rng = random.Random(1)
    letters = [chr(c) for c in [*range(1, 0x250), *range(0x370, 0x400), *range(0x1E00, 0x1F00), *range(0x3040, 0x30A0)] if chr(c).isprintable() or c < 128]
    texts = ["", " ", "it's WE'LL 'S 123 ½", "a\x1cb\x85c\xa0d​", "<|endoftext|>x<|startoftext|> <|ENDOFTEXT|>", "ΣΑΣ İ ẞ", "é é",
             "aaaaaaaaaa aaa", "x" * 4000] + ["".join(rng.choice(letters) for _ in range(50)) for _ in range(400)]
    ids, counts = bpe.WordBpe(tokenizer_path()).encode(texts)
    at = 0
    for text, n in zip(texts, counts.tolist()):
        want = library.encode(text, add_special_tokens=False)
        assert ids[at:at + n].tolist() == want.ids, text
        at += n


def test_the_word_memory_starts_anew(library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY_WORDS", 3)
    own = bpe.WordBpe(tokenizer_path())
    for text in ("one two three four", "five six seven one", "one <|endoftext|>"):
        assert own.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_query_digests(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op2_bpe_round_trip(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_edges_and_arrays(spark, docs, none, library):
    out = bpe.encode_decode(docs, tokenizer_path())
    assert set(out.columns) == {*docs.columns, "n_tokens", "decoded"}  # "ids" replaces the input's
    rows = out.withColumn("list", bpe.ids_array()).collect()
    assert len(rows) == docs.count()
    for r in rows:
        want = library.encode(r.text or "", add_special_tokens=False)
        assert r.list == want.ids and r.decoded == library.decode(want.ids, skip_special_tokens=False)
    again = bpe.decode_ids(out.select("ids", F.col("decoded").alias("was")), tokenizer_path()).filter("decoded <> was")
    assert again.count() == 0
    assert bpe.encode_decode(none, tokenizer_path()).count() == 0
