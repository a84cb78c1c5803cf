import base64

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from panelloom.llm import tokens

tiktoken = pytest.importorskip("tiktoken")
PATH = f"{tokens.TOKENIZERS}/{tokens.VOCABULARY}"
RANKS = tokens.read_ranks(PATH)
PUBLIC = tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ENCODER = tokens.Encoder(RANKS)


def plain_merge(piece):
    """The same merges by looking at all pairs each time."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, i = min((RANKS.get(parts[i] + parts[i + 1], 1 << 30), i) for i in range(len(parts) - 1))
        if rank == 1 << 30:
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [RANKS[p] for p in parts]


@settings(max_examples=300, deadline=None)
@given(st.binary(min_size=1, max_size=40) | st.text("aeiostnr ", min_size=1, max_size=60).map(str.encode))
def test_merges_equal_the_plain_way(piece):
    assert tokens.merge(piece, RANKS) == plain_merge(piece)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=200))
def test_ids_equal_the_public_library(text):
    assert ENCODER.ids(text) == PUBLIC.encode_ordinary(text)


def test_long_pieces():
    for text in ("a" * 30_000, "ab" * 20_000, " " * 5_000, "漢字" * 4_000, "<|endoftext|> x"):
        assert ENCODER.ids(text) == PUBLIC.encode_ordinary(text)


def test_tables(spark):
    df = spark.createDataFrame([(1, "Hello wörld", 5), (2, "", 5), (3, None, 5), (1, "Hello wörld", 6)], "doc_id bigint, text string, ids int")
    got = {r["doc_id"]: r["ids"] for r in tokens.encode(df).collect()}
    assert got == {1: PUBLIC.encode_ordinary("Hello wörld"), 2: [], 3: []}
    n = len(got[1])
    assert sorted(map(tuple, tokens.token_counts(df).collect())) == [(1, n), (1, n), (2, 0), (3, 0)]
    assert tokens.encode(df.limit(0)).count() == 0


def test_vocabulary_round_trip(spark):
    table = {r["id"]: bytes(r["token"]) for r in tokens.vocabulary_table(spark).collect()}
    text = "Ein Satz, ein “Satz” – 漢字 \n\t x  y"
    assert b"".join(table[i] for i in ENCODER.ids(text)).decode() == text
    assert len(table) == len(RANKS) and base64.b64encode(table[0])
