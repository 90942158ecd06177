import base64
import hashlib

import pytest
import public_tokenizers as P
import pyarrow as pa
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from helixframe.llm import bpe, tokencount
from helixframe.llm import queries as llm

RANKS, JSON = P.path("byte_bpe_multi_50k.tiktoken"), P.path("byte_bpe_50k.json")
TEXTS = ["", "That it.", "a" * 6000, "ab" * 1500 + " x", " \n\n\t x  y", "<|endoftext|> hi<|endoftext|>", "'s're'LL don't 12345", "日本語テキスト" * 400, "Ciónazbo ñ ßäö\x85\x1c x", "|||***$$$" * 50]


def _library():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


LIB, TOK = _library(), Tokenizer.from_file(JSON)


def test_encode_decode(spark):
    rows = [(i, t) for i, t in enumerate([*TEXTS, TEXTS[1], None])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"ids": bpe.F.lit("clash"), "x": bpe.F.lit(1)})
    got = {r.doc_id: r for r in bpe.decode(bpe.encode(df, RANKS), RANKS).collect()}
    for i, t in rows:
        assert got[i].ids == LIB.encode_ordinary(t or "") and bytes(got[i].decoded) == (t or "").encode() and got[i].x == 1
    one = bpe.round_trip(df.withColumn("both", bpe.F.lit(2)), RANKS)
    assert one.columns == ["doc_id", "text", "x", "both", "ids", "decoded"]
    assert {r.doc_id: (r.ids, bytes(r.decoded)) for r in one.collect()} == {i: (got[i].ids, bytes(got[i].decoded)) for i in got}


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(df, RANKS), RANKS).collect() == bpe.round_trip(df, RANKS).collect() == []
    assert tokencount.count_tokens(df, JSON).count() == 0


def test_decode_null_and_empty(spark):
    df = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert [bytes(r.decoded) for r in bpe.decode(df, RANKS).collect()] == [b"", b""]


def test_counts(spark):
    rows = [(i, t) for i, t in enumerate([*TEXTS, TEXTS[1], None])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in tokencount.count_tokens(df, JSON).collect()}
    assert got == {i: len(TOK.encode(t or "", add_special_tokens=False).ids) for i, t in rows}


def _ids(texts):
    import numpy as np

    ids, n = bpe.codec(RANKS, P.PATTERN).encode(pa.array(texts, pa.string()))
    return [x.tolist() for x in np.split(ids, np.cumsum(n))[:-1]]


#: Characters around which words and spaces meet in every way.
MEETING = ["a", "B", "é", "1", "!", "'s", "'ll", " ", " ", "  ", "\n", " \n", "\t", "\x1c", "\x85", "\xa0", "\u2003", "日本", "<|endoftext|>", "x" * 40]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=60), st.lists(st.sampled_from(MEETING), max_size=20).map("".join)), min_size=1, max_size=5))
def test_any_texts(texts):
    assert _ids(texts) == LIB.encode_ordinary_batch(texts)
    (names, codes, ends), added = tokencount.counter(JSON).pieces(pa.array(texts, pa.string()))
    count = tokencount.counter(JSON).counts(names)[codes]
    got = [int(count[a:b].sum() + n) for a, b, n in zip(ends, ends[1:], added)]
    assert got == [len(x.ids) for x in TOK.encode_batch(texts, add_special_tokens=False)]


def test_long_pieces():
    """A piece in a matrix of its own gets the library's ids, however long."""
    c = bpe.codec(RANKS, P.PATTERN)
    digits = "".join(hashlib.sha256(bytes([i])).hexdigest() for i in range(20))
    words = "".join(x.replace(" ", "") for x in ("thestinterationofanother", "wherentiably", "unnenationingly") * 3000)
    for x in (digits, words[:150_000], "a" * 50_000, "=-" * 20_000 + "-" * 9):
        assert _ids([x, "a" + x]) == LIB.encode_ordinary_batch([x, "a" + x])
        assert c._merge_long(x[:900].encode()) == c.merge([x[:900].encode()])[0]


def test_more_than_a_block(spark):
    """Texts of more than a block, and a block of more than a text."""
    text = "Shesting the tioned, ou 12 x\n" * 200_000
    df = spark.createDataFrame([(1, text), (2, "the"), (3, text + "!")], "doc_id long, text string").coalesce(1)
    both = bpe.decode(bpe.encode(df, RANKS), RANKS).select("doc_id", "ids", "text", "decoded").collect()
    assert all(r.ids == LIB.encode_ordinary(r.text) and bytes(r.decoded) == r.text.encode() for r in both)
    assert {r.doc_id: r.n_tokens for r in tokencount.count_tokens(df, JSON).collect()} == {r.doc_id: len(TOK.encode(r.text, add_special_tokens=False).ids) for r in both}


def test_memory_of_pieces_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    c = bpe.Codec(RANKS, P.PATTERN)
    for k in range(20):
        texts = [f"qx{i * k} the{i}zz and" for i in range(30)]
        ids, n = c.encode(pa.array(texts))
        assert ids.tolist() == [t for x in LIB.encode_ordinary_batch(texts) for t in x] and len(c.known) + len(c.older) < 300


@pytest.mark.parametrize("frequent", [0, 5, 10**6])
def test_counts_by_both_sides_of_the_join(spark, frequent):
    """Pre-tokens that are broadcast and those that are shuffled give the same sums; columns may have the helpers' names."""
    rows = [(i, t, "x", -1, "y") for i, t in enumerate([*TEXTS, TEXTS[1], TEXTS[1], None])]
    df = spark.createDataFrame(rows, "doc_id long, text string, h string, N_TOKENS int, piece string")
    got = tokencount.count_tokens(df, JSON, frequent=frequent)
    assert got.columns == ["doc_id", "text", "h", "piece", "n_tokens"]
    assert sorted((r.doc_id, r.h, r.piece, r.n_tokens) for r in got.collect()) == [(i, "x", "y", len(TOK.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in rows]


def test_distinct_pieces_are_counted_once(spark):
    df = spark.createDataFrame([("the the and",), ("the and",), (None,)], "text string").repartition(3)
    got = sorted(map(tuple, tokencount.piece_counts(df, JSON).collect()))
    assert got == [(" and", 2, 1), (" the", 1, 1), ("the", 2, 1)]


def test_queries_give_the_contract(spark):
    """The registered queries over a whole table, against the libraries."""
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    sha = lambda b: hashlib.sha256(b).hexdigest()
    ids = [LIB.encode_ordinary(t) for _, t in docs]
    want = sorted((i, len(x), sha(",".join(map(str, x)).encode()), sha(t.encode())) for (i, t), x in zip(docs, ids))
    got = llm.op10_byte_bpe(spark, "/root/testdata/sf0.001").select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert sorted(map(tuple, got.collect())) == want
    n = [len(x.ids) for x in TOK.encode_batch([t for _, t in docs], add_special_tokens=False)]
    want = sorted((i, len(t.encode()), k, k > 512) for (i, t), k in zip(docs, n))
    got = llm.op9_token_counts(spark, "/root/testdata/sf0.001").select("doc_id", "n_bytes", "n_tokens", "over_limit")
    assert sorted(map(tuple, got.collect())) == want


@pytest.mark.parametrize("ids", [[5, 10**8], [-1], [None]])
def test_unknown_ids_raise(spark, ids):
    with pytest.raises(Exception, match="token id"):
        bpe.decode(spark.createDataFrame([(ids,)], "ids array<int>"), RANKS).collect()


def test_unsupported_tokenizer():
    with pytest.raises(ValueError):
        tokencount.PieceCounter(P.path("word_bpe_49k.json"))
