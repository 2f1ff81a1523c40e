"""The transducer against tiktoken, and the round trip."""

import hashlib
import random
import struct

import pyarrow as pa
import pytest
import public_tokenizers as P
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from newsloom.llm import byte_bpe as B

PATH = P.path("byte_bpe_multi_50k.tiktoken")
CODEC = B.Codec(B.read_ranks(B.vocabulary(PATH)), P.PATTERN)
OTHER = tiktoken.Encoding("own", pat_str=P.PATTERN, special_tokens={},
                          mergeable_ranks={n: k for k, n in enumerate(CODEC.transducer.names)})


def ids(text):
    packed = CODEC.encode(text)
    return list(struct.unpack(f"<{len(packed) // 4}I", packed))


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text_is_encoded_as_tiktoken_does_and_comes_back(text):
    text = text.encode("utf-8", "ignore").decode()
    assert ids(text) == OTHER.encode_ordinary(text)
    assert CODEC.decode(CODEC.encode(text)) == text


@pytest.mark.parametrize("alphabet", ["a", "ab", "abcdefghijklmnopqrstuvwxyz", "日本語éa", "thequickbrownfox"])
def test_long_pieces_give_out_tokens_on_the_way(alphabet):
    rng = random.Random(1)
    text = "".join(rng.choice(alphabet) for _ in range(12_000))
    assert ids(text) == OTHER.encode_ordinary(text)
    parts = list(CODEC.transducer.stream([text.encode()[k:k + 1000] for k in range(0, len(text.encode()), 1000)]))
    assert [k for p in parts for k in p] == OTHER.encode_ordinary(text)
    assert len(parts) > 2


def test_states_may_be_thrown_away():
    fresh = B.Codec(CODEC.transducer.names, P.PATTERN, states=50, pieces=5)
    rng = random.Random(2)
    for _ in range(200):
        text = "".join(rng.choice("abcdefgh é<|endoftext|>") for _ in range(40))
        assert fresh.encode(text) == CODEC.encode(text)
    long = "".join(rng.choice("abcdefgh") for _ in range(9000))
    assert fresh.encode(long) == CODEC.encode(long)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40), st.integers(1, 5))
def test_characters_may_be_cut_anywhere(text, step):
    data = text.encode("utf-8", "ignore")
    stream = B.Utf8Stream()
    got = "".join(stream.feed(data[k:k + step]) for k in range(0, len(data), step)) + stream.end()
    assert got.encode() == data


def test_broken_bytes_become_replacement_characters():
    stream = B.Utf8Stream()
    assert stream.feed(b"a\xff\xe2\x82") == "a�" and stream.end() == "�"


def test_round_trip_of_rows(spark):
    rows = [(1, "Ein Test, <|endoftext|> 12'll"), (2, None), (3, ""), (None, "x" * 30_000), (1, "twice")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit(1))
    got = {(r.doc_id, r.n_tokens): r for r in B.round_trip(docs, PATH).collect()}
    for i, text in rows:
        want = OTHER.encode_ordinary(text or "")
        row = got[(i, len(want))]
        assert row.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(want)}I", *want)).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    added = B.tokenize(docs, PATH, decoded_col="back")
    assert added.columns == ["doc_id", "text", "ids", "back"]
    assert all(r.back == (r.text or "") and r.ids == OTHER.encode_ordinary(r.text or "") for r in added.collect())
    assert B.tokenize(docs.limit(0), PATH).count() == 0 == B.round_trip(docs.limit(0), PATH).count()


def test_workers_keep_no_codec_after_tokenizing(spark):
    def kept(batches):
        import sys
        for batch in batches:
            own = sys.modules.get("newsloom.llm.byte_bpe")
            codecs = sum(key[1:] == (own.STATES, own.PIECES) for key in own._CODEC) if own else 0
            yield pa.RecordBatch.from_pydict({"codecs": [codecs]})

    docs = spark.range(0, 64, 1, 8).select(F.col("id").alias("doc_id"), F.lit("some words").alias("text"))
    assert B.tokenize(docs, PATH).where("size(ids) > 0").count() == 64
    rows = spark.range(0, 64, 1, 8).mapInArrow(kept, "codecs long").collect()
    assert rows and not any(r.codecs for r in rows)
