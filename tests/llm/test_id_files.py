from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakebars.llm.id_files import ENDING, pack_file, read_ids, unpack_file, write_ids
from lakebars.llm.mixing_coder import decode_blocks, encode_blocks
from lakebars.llm.tokens import WordEncoder
from lakebars.operators.scratch import scratch_path

from odd_documents import ODD, nothing, odd  # noqa: F401  two of them are fixtures

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 255), min_size=1, max_size=80), min_size=1, max_size=6), st.integers(2, 3))
def test_blocks_round_trip(blocks, digits):
    blocks = sorted((np.array(b, np.uint32) for b in blocks), key=len, reverse=True)
    coded = encode_blocks(blocks, digits)
    back = decode_blocks(coded, np.array([len(b) for b in blocks]), digits)
    assert [b.tolist() for b in back] == [b.tolist() for b in blocks]
    # A block does not depend on the blocks beside it.
    assert encode_blocks(blocks[-1:], digits) == coded[-1:]


def test_what_repeats_gets_shorter():
    ids = np.array([3, 900, 17, 4] * 1000, np.uint32)
    assert len(pack_file(0, 0, ["a"], [len(ids)], ids)) < len(ids) / 2


@pytest.mark.parametrize("ids", [[], [7], list(range(3000)), [5] * 2500, [0, 2**31, 2**32 - 1]])
def test_file_round_trip_and_damage(ids):
    ids = np.array(ids, np.uint32)
    content = pack_file(3, 4, ["x"], [len(ids)], ids, block=1000) + ENDING
    part, number, keys, counts, back = unpack_file(content)
    assert (part, number, keys, counts, back.tolist()) == (3, 4, ["x"], [len(ids)], ids.tolist())
    with pytest.raises(ValueError):
        unpack_file(content[:-1])
    if len(ids) > 1000:
        broken = bytearray(content)
        broken[-len(ENDING) - 40] ^= 1
        with pytest.raises(ValueError):
            unpack_file(bytes(broken))


def test_word_ids_are_those_of_the_library():
    library, words = Tokenizer.from_file(VOCABULARY), WordEncoder(VOCABULARY)
    texts = [(d.text or "")[:30_000] for d in ODD] + ["é don't we'll 'S '", "a<|startoftext|>b"]
    for text, ids in zip(texts, words.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_documents_come_back_in_order(spark, odd):
    library = Tokenizer.from_file(VOCABULARY)
    path = scratch_path(spark, "test-ids")
    write_ids(odd, path, VOCABULARY, file_ids=5000)
    rows = sorted(read_ids(spark, path).collect(), key=lambda r: r.start)
    order = sorted(ODD, key=lambda d: (d.doc_id is not None, d.doc_id or 0, d.text is not None, d.text or ""))
    assert [r.doc_id for r in rows] == [d.doc_id for d in order]
    start = 0
    for row, doc in zip(rows, order, strict=True):
        ids = [*library.encode(doc.text or "", add_special_tokens=False).ids, 1]
        assert (row.start, row.n_tokens, np.frombuffer(row.ids, "<u4").tolist()) == (start, len(ids), ids)
        start += len(ids)


def test_no_rows(spark, nothing):
    path = scratch_path(spark, "test-ids")
    write_ids(nothing, path, VOCABULARY)
    assert read_ids(spark, path).select(F.count("*")).first()[0] == 0
