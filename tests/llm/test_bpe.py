"""Byte-level BPE: exact ids, round trips, and long texts cut at safe places."""

import hashlib
import random
import struct

import public_tokenizers
import pytest
import regex

from razonete.llm import bpe
from razonete.llm.queries import QUERIES

TEXTS = [
    None, "", " ", "a", "it's  fine\n\n don't", "naïve été — 東京 12,345 🎉🎉", "x" * 3000, " " * 500 + "y",
    "a b  c\x1cd\x85e", "tabs\t\t\tand\r\nends  \n", "<|endoftext|>", "'s't're", "!!!??? ...\n...",
]


@pytest.fixture(scope="module")
def of():
    return bpe.encoding(bpe.RANKS, public_tokenizers.PATTERN)


def test_ids_are_those_of_each_match_alone(of):
    for text in TEXTS:
        alone = [i for match in regex.findall(public_tokenizers.PATTERN, text or "") for i in of.encode_ordinary(match)]
        assert bpe.encode_text(text, of) == alone
        assert of.decode_bytes(bpe.encode_text(text, of)) == (text or "").encode()


def test_cut_texts_have_the_ids_of_the_whole(of):
    draw = random.Random(5)
    pieces = ["word", " ", "  ", "\n", "\t ", "'s", "é", "12", "!?", " ", "東京", "'", "ll", " \n "]
    for size in (1, 2, 3, 7, 50):
        for _ in range(60):
            text = "".join(draw.choice(pieces) for _ in range(draw.randrange(1, 80)))
            assert "".join(bpe.parts(text, size)) == text
            assert bpe.encode_text(text, of, size) == of.encode_ordinary(text)


def test_a_text_without_a_safe_place_stays_whole():
    assert bpe.parts("x" * 100, 10) == ["x" * 100]
    assert bpe.parts(" " * 100, 10) == [" " * 100]


def test_very_long_texts_are_encoded(of):
    text = "ab cd\n" * 100_000 + "z" * 200_000
    assert of.decode_bytes(bpe.encode_text(text, of)) == text.encode()


def test_encode_and_decode_keep_rows_and_columns(spark):
    rows = [(i, t, "kept", [1]) for i, t in enumerate(TEXTS)] + [(0, None, "again", None), (None, "null id", None, [])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids_ string, n_tokens array<int>")
    out = bpe.decode(bpe.encode(docs)).collect()
    assert len(out) == len(rows)
    assert all(bytes(r["decoded"]) == (r["text"] or "").encode() for r in out)
    assert sorted(str(r["n_tokens"]) for r in out) == sorted(str(r[3]) for r in rows)


def test_partial_characters_decode_to_their_bytes(spark):
    split = spark.createDataFrame([([240],), ([],), (None,)], "ids array<int>")
    of = bpe.encoding(bpe.RANKS, public_tokenizers.PATTERN)
    assert [bytes(r["decoded"]) for r in bpe.decode(split).collect()] == [of.decode_bytes([240]), b"", b""]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(empty)).columns == ["doc_id", "text", "ids", "decoded"]
    assert bpe.encode(empty).count() == 0


def test_query_digests(spark, folder, of):
    texts = dict(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())
    rows = QUERIES["op1_bpe"](spark, folder).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = of.encode_ordinary(texts[row["doc_id"]] or "")
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256((texts[row["doc_id"]] or "").encode()).hexdigest()
