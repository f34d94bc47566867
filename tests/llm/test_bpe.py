"""Byte-level BPE against the tiktoken library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewater.llm import bpe, common, queries
from tidewater.llm.tokens import slices

SF = "/root/testdata/sf0.001"
FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = bpe.vocabulary(FILE)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
KINDS = bpe.classes()
BYTES = tiktoken.Encoding("cut", pat_str=public_tokenizers.PATTERN, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
ODD = [
    None, "", " ", "  ", "\n", " \n", "a", " a", "  a", "\t a", " \t a", "a  ", "a \n", "it's", "it 's", "it  's", "it\n's", "it's't", "'s'T're've'm'll'd", "!'s", "x'r", "x're", "x'reb", "'", "''s", "' s", "1's", "a'1",
    "<|endoftext|>", " a", "a　 b", "\x1c a", "été", "漢字かな交じり文", "١٢٣ ½", "\U0001f600\U0001f600 \U00010400x", "\x00\x01", "é" * 70_000, "ab" * 50_000, " " * 5000 + "x" + "\n" * 5000, "r", "e", "don't " * 3000,
]


def spans(texts: list[str | None]) -> list[list[str]]:
    out: list[list[str]] = [[] for _ in texts]
    for row, data, offsets in slices(pa.array(texts, pa.string())):
        begins, rows = bpe.pieces(data, offsets, KINDS)
        ends = np.append(begins[1:], len(data))[: len(begins)]
        for a, b, r in zip(begins, ends, rows, strict=True):
            out[row + r].append(data[a:b].tobytes().decode())
    return out


def matches(text: str | None) -> list[str]:
    """By the definition: the longest prefix that is one match, again and again. A match alone is its own only match."""
    import regex

    # The classes as the library has them: code points that the other library knows are replaced by ones that both know.
    stand = {bpe.LETTER: "x", bpe.NUMBER: "1", bpe.OTHER: "!"}
    text = text or ""
    plain = "".join(c if ord(c) < 128 or KINDS[ord(c)] == bpe.SPACE else stand[KINDS[ord(c)]] for c in text)
    return [text[m.start() : m.end()] for m in regex.finditer(public_tokenizers.PATTERN, plain)]


def test_pattern_is_the_public_one():
    assert bpe.PATTERN == public_tokenizers.PATTERN


def test_pieces_of_odd_texts():
    assert spans(ODD) == [matches(t) for t in ODD]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'streveml1!é 　"), st.characters(codec="utf-8")), max_size=14), min_size=1, max_size=6))
def test_pieces_of_any_texts(texts):
    assert spans(texts) == [matches(t) for t in texts]


def test_long_words_that_polynomial_hashes_confuse():
    one, two = "a", "b"
    for _ in range(12):
        one, two = one + two, two + one
    texts = pa.array([one, two])
    for _, data, offsets in slices(texts):
        begins, _ = bpe.pieces(data, offsets, KINDS)
        h1, h2 = bpe.hashes(data, begins, np.append(begins[1:], len(data)))
        assert len(begins) == 2 and h1[0] != h1[1] and h2[0] != h2[1]


def check(df, texts: list[tuple[int | None, str | None]]) -> None:
    got = sorted((r.doc_id is not None, r.doc_id, r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in df.collect())
    want = []
    for i, t in texts:
        ids = LIBRARY.encode_ordinary(t or "")
        want.append((i is not None, i, len(ids), np.array(ids, "<u4").tobytes(), (t or "").encode()))
    assert got == sorted(want)


@pytest.mark.parametrize("block", [1, 30_000, bpe.BLOCK_BYTES])
def test_odd_rows(spark, monkeypatch, block):
    monkeypatch.setattr(bpe, "BLOCK_BYTES", block)
    rows = list(enumerate(ODD)) + [(7, "it's the same id"), (7, "it's the same id")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, block string, ids int").repartition(3)
    check(bpe.decoded(bpe.encoded(docs, RANKS), RANKS), rows)
    check(bpe.encoded(docs, RANKS, decode=True), rows)


def test_null_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, "one two"), (None, None)], "doc_id long, text string")
    assert sorted((r.doc_id is None, r.n_tokens) for r in bpe.encoded(docs, RANKS).collect()) == [(True, 0), (True, len(LIBRARY.encode_ordinary("one two")))]
    assert bpe.decoded(bpe.encoded(docs.where("false"), RANKS), RANKS).count() == 0


def test_each_distinct_word_is_encoded_once(spark, monkeypatch):
    """Words of many small blocks: a word that several blocks ask for belongs to one part, which is one task's."""
    monkeypatch.setattr(bpe, "BLOCK_BYTES", 2000)
    r = random.Random(1)
    texts = pa.array([" ".join(r.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(50)) for _ in range(20)])
    parts: dict[bytes, set[int]] = {}
    for at in range(0, 20, 5):
        for part, blob in bpe.Block(texts.slice(at, 5), KINDS, 7).asked():
            sizes, data = bpe.unpacked(blob)
            ends = np.cumsum(sizes)
            words = [data[e - n : e].tobytes() for n, e in zip(sizes, ends, strict=True)]
            assert len(words) == len(set(words))
            for w in words:
                parts.setdefault(w, set()).add(part)
    assert all(len(p) == 1 for p in parts.values()) and len(parts) > 4


def test_given_documents(spark):
    want = {r.doc_id: r.text for r in common.table(spark, SF, "documents").collect()}
    got = queries.QUERIES["op11_bpe"](spark, SF)
    assert dict(got.dtypes) == {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}
    rows = got.collect()
    assert len(rows) == len(want)
    for r in rows:
        ids = LIBRARY.encode_ordinary(want[r.doc_id] or "")
        text = (want[r.doc_id] or "").encode()
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text).hexdigest())


def test_texts_are_not_shuffled_for_the_join(spark):
    docs = common.table(spark, SF, "documents")
    plan = bpe.encoded(docs, RANKS)._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan
    assert all("text" not in line for line in plan.splitlines() if "Exchange" in line)


def test_decoding_of_any_ids(spark):
    ids = [[0], [], [5, 5, 40_000], None]
    df = spark.createDataFrame([(i, None if x is None else bytearray(np.array(x, "<u4").tobytes())) for i, x in enumerate(ids)], "k int, ids binary")
    found = {r.k: bytes(r.decoded) for r in bpe.decoded(df, RANKS).collect()}
    assert found == {i: LIBRARY.decode_bytes(x or []) for i, x in enumerate(ids)}
