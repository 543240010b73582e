"""BPE by speculation against the tokenizers library."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from statweave.llm import bpe, queries


@pytest.fixture(scope="module")
def own():
    return bpe.WordBpe(bpe.public_word_bpe())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.public_word_bpe())


def check(own, library, texts):
    for text, ids, e in zip(texts, own.encode(texts),
                            library.encode_batch(texts, add_special_tokens=False)):
        assert ids.tolist() == e.ids, text
        assert own.decode(ids) == library.decode(e.ids, skip_special_tokens=False), text


ALPHABETS = ["abcdefghij etaoin'  ", "aaab ", "éàüß öçñ ' s",
             "ΣσΑ İıſ 中\U0001f600́\x1c\x85  ²½",
             "<|startoftext|> <|endoftext|> <|EndOfText|>", "'sdlrevmt '", "._-!?*#0123 ’€"]


def test_awkward_texts(own, library):
    rng = random.Random(1)
    texts = ["", " ", "\x1c", "?\x1c!", "<|startoftext|>", "a<|endoftext|><|endoftext|>b"]
    for _ in range(4000):
        a = "".join(rng.sample(ALPHABETS, rng.randint(1, 3)))
        texts.append("".join(rng.choice(a) for _ in range(rng.randint(0, 40)))
                     + rng.choice(["", " <|startoftext|>x", "<|endoftext|>"]))
    pieces = [w.removesuffix("</w>") for w in sorted(library.get_vocab())]
    texts += ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 6))) for _ in range(4000)]
    check(own, library, texts)


def test_very_long_words(own, library):
    rng = random.Random(2)
    check(own, library, ["".join(rng.choice("abcde") for _ in range(30_000)), "a" * 20_001,
                         "ab" * 15_000 + " c"])


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text(own, library, text):
    check(own, library, [text])


def test_compatible_pairs(own):
    """The array test against merging the joined text of both pieces."""
    rng = np.random.default_rng(3)
    inner = np.array(list(own.inner.values()))
    both = np.array(list(own.inner.values()) + list(own.final.values()))
    a, b = rng.choice(inner, 4000), rng.choice(both, 4000)
    text = {i: p for p, i in own.inner.items()}
    last = {i: p for p, i in own.final.items()}
    for x, y, good in zip(a.tolist(), b.tolist(), own.compatible(a, b)):
        if y in last:  # an end of a word
            assert (own.merge(text[x] + last[y]) == [x, y]) == good


def test_cache_is_emptied(own, library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_RUNS", 3)
    for k in range(5):
        check(own, library, [f"alpha{k} beta{k} gamma{k} delta{k}", "alpha0 omega"])


def test_query(spark, edge_dir, library, monkeypatch):
    monkeypatch.setattr(bpe, "IDS_PER_BATCH", 500)  # many slices, the long text alone in one
    got = sorted([tuple(r) for r in queries.QUERIES["op12_speculative_bpe"](spark, edge_dir).collect()],
                 key=str)
    exp = []
    for r in spark.read.parquet(f"{edge_dir}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        exp.append((r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                    hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(exp, key=str)


def test_empty(spark, empty_dir):
    out = queries.QUERIES["op12_speculative_bpe"](spark, empty_dir)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and not out.collect()


def test_extra_columns(spark):
    docs = spark.createDataFrame([(1, "a b", "x", 2)], "doc_id int, text string, ids string, decoded int")
    r = bpe.encode(docs).first()
    assert r.doc_id == 1 and len(r.ids) == 2 and r.decoded == "a</w> b</w>"
    assert bpe.encode(docs.withColumn("text", F.lit(None).cast("string"))).first().ids == []
