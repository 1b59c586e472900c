from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lakebars.llm.differencing import differenced, near_equal_windows
from lakebars.llm.packing import pack
from lakebars.llm.tokens import byte_level_encoder

from odd_documents import ODD, nothing, odd  # noqa: F401  two of them are fixtures

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), min_size=1, max_size=60))
def test_windows_hold_every_item_within_capacity(sizes):
    sizes = np.array(sizes)
    place = near_equal_windows(sizes, 64)
    filled = np.bincount(place, sizes)
    assert len(place) == len(sizes) and filled.max() <= 64
    assert place.max() + 1 <= len(sizes)


def test_differencing_finds_the_known_partition():
    place, sums = differenced(np.array([8, 7, 6, 5, 4]), 2)  # the classic example ends at a difference of 2
    assert sorted(sums.tolist()) == [14, 16]
    assert sorted(np.bincount(place, [8, 7, 6, 5, 4]).tolist()) == [14, 16]


def test_an_item_over_capacity_is_an_error():
    with pytest.raises(ValueError):
        near_equal_windows(np.array([3, 70]), 64)


def test_fast_ids_are_those_of_the_library():
    whole, fast = Tokenizer.from_file(VOCABULARY), byte_level_encoder(VOCABULARY)
    for doc in ODD:
        text = (doc.text or "")[:50_000]
        assert fast(text).tolist() == whole.encode(text, add_special_tokens=False).ids


def test_pieces_make_up_the_documents(spark, odd):
    whole = Tokenizer.from_file(VOCABULARY)
    want = sorted(tuple([*whole.encode(d.text or "", add_special_tokens=False).ids, 1]) for d in ODD)
    pieces = pack(odd, VOCABULARY, group=16).toPandas()
    assert list(pieces.columns) == ["doc_id", "doc_tokens", "start", "length", "sequence_id", "offset", "ids"]
    ids = [np.frombuffer(x, "<u4").tolist() for x in pieces["ids"]]
    assert [len(x) for x in ids] == pieces["length"].tolist()
    # Pieces of one document, also of ids that repeat, chain from 0 to the document's length.
    by_start = {}
    for piece, content in zip(pieces.itertuples(), ids, strict=True):
        by_start.setdefault((repr(piece.doc_id), piece.doc_tokens), []).append((piece.start, content))
    total = sum(len(c) for parts in by_start.values() for _, c in parts)
    assert total == sum(map(len, want))
    unique = {repr(d.doc_id) for d in ODD if sum(o.doc_id == d.doc_id for o in ODD) == 1}
    for (doc_id, tokens), parts in by_start.items():
        if doc_id.removesuffix(".0") in unique:
            joined = [i for _, c in sorted(parts, key=lambda p: p[0]) for i in c]
            assert len(joined) == tokens and tuple(joined) in want
    for _, sequence in pieces.groupby("sequence_id"):
        sequence = sequence.sort_values("offset")
        ends = (sequence["offset"] + sequence["length"]).tolist()
        assert sequence["offset"].tolist() == [0, *ends[:-1]] and ends[-1] <= 2048


def test_no_rows(nothing):
    assert pack(nothing, VOCABULARY).count() == 0
