from __future__ import annotations

import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from lakebars.llm.merge_replay import CorpusEncoder, decode, encode
from lakebars.llm.tokens import pattern, ranks_of

from odd_documents import ODD, nothing, odd  # noqa: F401  two of them are fixtures

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
LIBRARY = tiktoken.Encoding("own", pat_str=pattern(), mergeable_ranks=ranks_of(VOCABULARY), special_tokens={})
ENCODER = CorpusEncoder(VOCABULARY)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=60), st.text("ab ", max_size=40), st.text("an1\n ", max_size=40)), max_size=6))
def test_ids_are_those_of_the_library(texts):
    ids, sizes = ENCODER.encode(texts)
    assert ids.tolist() == [i for text in texts for i in LIBRARY.encode_ordinary(text)]
    assert sizes.tolist() == [len(LIBRARY.encode_ordinary(text)) for text in texts]


def test_round_trip(spark, odd):
    rows = decode(encode(odd, VOCABULARY), VOCABULARY).collect()
    got = sorted((repr(r.doc_id), r.ids, bytes(r.decoded)) for r in rows)
    assert got == sorted((repr(d.doc_id), LIBRARY.encode_ordinary(d.text or ""), (d.text or "").encode()) for d in ODD)


def test_no_rows_and_no_ids(spark, nothing):
    assert encode(nothing, VOCABULARY).count() == 0
    rows = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.decoded for r in decode(rows, VOCABULARY).collect()} == {1: None, 2: b""}
