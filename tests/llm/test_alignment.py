"""Alignment of two tokenizers against plain loops over the tokens."""

from __future__ import annotations

import hashlib
import json
from collections import Counter, namedtuple

import public_tokenizers
import pytest
import sentencepiece
from odd_documents import ODD, nothing, odd  # noqa: F401  fixtures
from tokenizers import Tokenizer

from lakebars.llm.alignment import MEASURES, align, byte_level_bytes
from lakebars.llm.tokens import byte_alphabet

PATHS = tuple(public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
Brute = namedtuple("Brute", "documents counts groups")


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def tokens_of(text, tokenizers):
    """The (id, bytes) of A and of B; none where they are not the text."""
    a, b = tokenizers
    alphabet = byte_alphabet()
    of_a = [(i, bytes(alphabet[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    of_b = [
        (i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
        for i in b.encode(text)
    ]
    same = all(b"".join(content for _, content in side) == (" " + text).encode() for side in (of_a, of_b))
    return (of_a, of_b) if same and text else ([], [])


def spans(tokens):
    at, found = 0, []
    for i, content in tokens:
        found.append((i, at, at + len(content)))
        at += len(content)
    return found


def brute(texts, tokenizers):
    """`(n_a, n_b, n_groups, n_links, n_best, count_sum, sha)` of each text, by loops."""
    linked, rows = [], []
    for text in texts:
        a, b = (spans(side) for side in tokens_of(text or "", tokenizers))
        ends = sorted({end for _, _, end in a} & {end for _, _, end in b})
        shown = []
        for side in (a, b):
            group, ids = 0, [[] for _ in ends]
            for i, _, e in side:
                ids[group].append(str(i))
                group += e == ends[group]
            shown.append([",".join(group) for group in ids])
        shown = ["|".join(group) for group in zip(*shown, strict=True)]
        pairs, first = [], 0
        for i, s, e in a:
            while first < len(b) and b[first][2] <= s:
                first += 1
            at = first
            while at < len(b) and b[at][1] < e:
                pairs.append((i, b[at][0]))
                at += 1
        linked.append(pairs)
        rows.append((len(a), len(b), len(ends), len(pairs), ";".join(shown)))
    counts = Counter(pair for pairs in linked for pair in pairs)
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(n, most.get(b, 0))
    documents = [
        (*row[:4], sum(counts[p] == most[p[1]] for p in pairs), sum(counts[p] for p in pairs))
        + (hashlib.sha256(row[4].encode()).hexdigest() if row[4] else "",)
        for row, pairs in zip(rows, linked, strict=True)
    ]
    return Brute(documents, counts, [row[4] for row in rows])


def test_by_hand(spark, tokenizers):
    docs = spark.createDataFrame([(1, "hello world"), (2, "hello world"), (3, "hello")], "doc_id long, text string")
    found = align(docs, *PATHS, keep_groups=True)
    rows = {r.doc_id: r for r in found.documents.collect()}
    assert rows[1][1:] == rows[2][1:]
    # Both cut between the words, so each group is one word; every word counts in all its documents.
    assert (rows[3].n_groups, rows[1].n_groups) == (1, 2)
    hello = [r for r in found.pairs.collect() if r["count"] == 3]
    assert hello and rows[3].count_sum == 3 * len(hello) == 3 * rows[3].n_links
    assert rows[1].groups.split(";")[0] == rows[3].groups


@pytest.mark.parametrize("chunk_bytes", [1, 400, 1 << 20])
def test_odd_documents_whatever_the_chunks(spark, odd, tokenizers, chunk_bytes):  # noqa: F811
    found = align(odd, *PATHS, chunk_bytes=chunk_bytes, keep_groups=True)
    want = brute([doc.text for doc in ODD], tokenizers)
    got = [(r.doc_id, *(r[m] for m in MEASURES), r.groups_sha256, r.groups) for r in found.documents.collect()]
    assert sorted(got, key=repr) == sorted(
        ((doc.doc_id, *row, groups) for doc, row, groups in zip(ODD, want.documents, want.groups, strict=True)), key=repr
    )
    assert {(r.a_id, r.b_id): r["count"] for r in found.pairs.collect()} == dict(want.counts)


def test_texts_that_b_does_not_give_back_have_no_tokens(spark, tokenizers):
    texts = ["a▁b", "plain", "tab\tand\nline", "<s> <unk> </s> <0x41>", "<|endoftext|>", "▁", "é ﻿ x y", " ", "  two"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(tuple(r) for r in align(docs, *PATHS).documents.collect())
    want = brute(texts, tokenizers).documents
    assert got == [(i, *row) for i, row in enumerate(want)]
    assert got[0][1:] == (0,) * 6 + ("",) and got[1][1] > 0


def test_nothing_in_nothing_out(spark, nothing):  # noqa: F811
    found = align(nothing, *PATHS)
    assert found.documents.collect() == [] and found.pairs.collect() == []


def test_a_hot_text_and_texts_that_are_all_empty(spark, tokenizers):
    docs = spark.range(3000).selectExpr("id as doc_id", "case when id % 3 = 0 then 'one hot text' when id % 3 = 1 then null else 'text ' || id end as text")
    got = {r.doc_id: tuple(r)[1:] for r in align(docs, *PATHS).documents.collect()}
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    assert [got[i] for i in range(3000)] == brute(texts, tokenizers).documents


def test_ids_must_be_ranks(tmp_path):
    with open(PATHS[0], encoding="utf-8") as file:
        spec = json.load(file)
    merges = spec["model"]["merges"]
    merges[0], merges[1] = merges[1], merges[0]
    changed = tmp_path / "other.json"
    changed.write_text(json.dumps(spec), encoding="utf-8")
    with pytest.raises(ValueError, match="ranks of its merges"):
        byte_level_bytes(str(changed))
