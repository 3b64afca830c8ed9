import functools

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from freshet.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@functools.cache
def both():
    return Tokenizer.from_file(PATH), packing.CachedTokenizer(PATH)


@given(st.lists(st.text(alphabet=" \n\t\r\x0b\x1c\x85  ab'sé1,.<|>漢"), max_size=6))
@settings(max_examples=150, deadline=None)
def test_cached_tokenizer_equals_the_tokenizer(texts):
    whole, cached = both()
    texts = [*texts, "two  spaces", " lead", "trail ", "<|endoftext|> x", "a<|endoftext|><|endoftext|> b <|endoftext|>", "<|endoftext|>", " <|endoftext|", "it's we'll don't", "a \n b"]
    got = [ids.tolist() for ids in cached.encode(texts)]
    assert got == [whole.encode(t, add_special_tokens=False).ids for t in texts]


@given(st.integers(0, 5000))
def test_pieces_are_binary_digits(length):
    pieces = packing.piece_lengths(length)
    assert sum(pieces) == length
    assert pieces == sorted(pieces, reverse=True)
    rest = [p for p in pieces if p < 1024]
    assert len(set(rest)) == len(rest) and all(p & p - 1 == 0 for p in pieces)


def test_round_trip(docs, awkward_texts, tokenizer):
    pieces = packing.pack(docs, PATH).collect()
    want = sorted([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for t in awkward_texts)
    by_doc = {}
    for p in pieces:
        assert p["offset"] == 0 and len(p["ids"]) == 4 * p["length"]
        by_doc.setdefault(p["doc_id"], []).append(p)
    got = []
    for own in by_doc.values():
        own.sort(key=lambda p: p["start"])
        assert [p["start"] for p in own] == np.cumsum([0, *[p["length"] for p in own]])[:-1].tolist()
        ids = np.frombuffer(b"".join(p["ids"] for p in own), "<u4").tolist()
        assert all(p["doc_tokens"] == len(ids) for p in own)
        got.append(ids)
    assert sorted(got) == want
    assert len({p["sequence_id"] for p in pieces}) == len(pieces)


def test_sequence_ids_sort_by_length(docs):
    pieces = sorted(packing.pack(docs, PATH).collect(), key=lambda p: p["sequence_id"])
    assert [p["length"] for p in pieces] == sorted(p["length"] for p in pieces)


def test_empty_table_clashing_names_and_buckets(no_docs, clashing, docs, spark, tmp_path):
    assert packing.pack(no_docs, PATH).count() == 0
    pieces = packing.pack(clashing, PATH)
    assert pieces.count() == packing.pack(docs, PATH).count()
    packing.write_buckets(pieces, str(tmp_path / "packed"))
    back = spark.read.parquet(str(tmp_path / "packed"))
    assert back.where("bucket <> length").count() == 0 and back.count() == pieces.count()
    with pytest.raises(ValueError):
        packing.pack(docs, PATH, sequence=1000)
