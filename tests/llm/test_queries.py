"""Every registered query of the subpackage over whole tables, against its SQL, a library or brute force."""

from __future__ import annotations

import os
import zlib
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from test_alignment import brute
from tokenizers import Tokenizer

import __spark_entry__ as registered
from lakebars.llm import queries as llm
from lakebars.llm.tokens import pattern, ranks_of

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
LARGER = os.environ.get("TEST_LARGER_DIR", "/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def texts(sf_dir=SF_DIR):
    return duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet' ORDER BY doc_id").fetchall()


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_queries_are_registered():
    assert registered.queries().keys() >= {*llm.queries(), "pipeline"}
    assert {int(name[2:].split("_")[0]) for name in llm.queries()} == set(range(1, 14))
    assert registered.oracle_sql().items() >= llm.oracle_sql().items()


@pytest.mark.parametrize("name", llm.oracle_sql())
def test_query_equals_its_sql(spark, oracle, name):
    got = llm.queries()[name](spark, SF_DIR)
    want = oracle.sql(llm.oracle_sql()[name])
    names = sorted(want.columns)
    assert sorted(got.columns) == names
    places = [want.columns.index(n) for n in names]
    rows = sorted((tuple(row[n] for n in names) for row in got.collect()), key=repr)
    assert rows == sorted((tuple(row[p] for p in places) for row in want.fetchall()), key=repr)


def test_op1_against_brute_force(spark):
    ids, vectors = zip(*duckdb.sql(f"SELECT vec_id, embedding FROM '{LARGER}/embeddings.parquet'").fetchall(), strict=True)
    ids, vectors = np.array(ids), np.array(vectors, float)
    got = {}
    for r in llm.op1_collision_ann(spark, LARGER).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert got.keys() == {int(i) for i in ids if i % 100 == 0}
    hits = 0
    for query, near in got.items():
        far = np.sqrt(((vectors - vectors[ids == query][0]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((ids, far)) if ids[i] != query][:10]
        hits += len({int(ids[i]) for i in order} & {v for _, v, _ in near})
        assert [r for r, _, _ in sorted(near)] == list(range(1, 11))
        assert all(abs(score - far[ids == v][0]) < 1e-12 for _, v, score in near)
    assert hits >= 0.9 * 10 * len(got)


def test_op3_against_the_library(spark):
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = llm.op3_packing(spark, LARGER).toPandas()
    pieces = {key: rows.sort_values("start") for key, rows in got.groupby("doc_id")}
    for doc_id, text in texts(LARGER):
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 1]
        at = 0
        for piece in pieces[doc_id].itertuples():
            assert (piece.start, piece.doc_tokens) == (at, len(ids))
            assert piece.ids_crc32 == crc(ids[at : at + piece.length])
            at += piece.length
        assert at == len(ids)
    used = got.groupby("sequence_id")["length"].sum()
    assert used.max() <= 2048 and used.sum() >= 0.98 * 2048 * len(used)
    for _, rows in got.sort_values("offset").groupby("sequence_id"):
        assert rows["offset"].tolist() == [0, *rows["length"].cumsum().tolist()[:-1]]


def test_op6_against_the_library(spark):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=pattern(), mergeable_ranks=ranks_of(path), special_tokens={})
    sha = lambda data: __import__("hashlib").sha256(data).hexdigest()
    want = []
    for doc_id, text in texts():
        ids = library.encode_ordinary(text or "")
        want.append((doc_id, len(ids), sha(",".join(map(str, ids)).encode()), sha((text or "").encode())))
    got = llm.op6_merge_replay(spark, SF_DIR).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert sorted(map(tuple, got.collect())) == want


def test_op10_against_the_library(spark):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want, start = [], 0
    for doc_id, text in texts():
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        want.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    got = llm.op10_mixing_coder(spark, SF_DIR).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(map(tuple, got.collect())) == want


def test_op11_against_brute_force(spark):
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = brute([text for _, text in texts()], (a, b)).documents
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    got = llm.op11_alignment(spark, SF_DIR).select(*names).collect()
    assert sorted(map(tuple, got)) == [(doc_id, *row) for (doc_id, _), row in zip(texts(), want, strict=True)]


def labels(column):
    return dict(duckdb.sql(f"SELECT doc_id, {column} FROM '{LARGER}/labels.parquet'").fetchall())


def test_op7_on_held_out_labels(spark):
    rows, known = llm.op7_cotraining(spark, LARGER).collect(), labels("quality")
    assert len(rows) == len(texts(LARGER))
    held = [(known[r.doc_id], r.predicted) for r in rows if r.held_out and known.get(r.doc_id) is not None]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)


def test_op8_on_held_out_labels(spark):
    rows, known = llm.op8_toxicity(spark, LARGER).collect(), labels("toxic")
    assert len(rows) == len(texts(LARGER))
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [(known[r.doc_id], r.predicted) for r in rows if r.held_out and known.get(r.doc_id) is not None]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)


def test_op9_on_held_out_documents(spark):
    rows = llm.op9_language_id(spark, LARGER).collect()
    known = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{LARGER}/documents.parquet'").fetchall())
    assert len(rows) == len(known)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(known[r.doc_id] == r.lang_pred for r in held) >= 0.97 * len(held)
