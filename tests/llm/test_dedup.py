from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from lakebars.llm.common import table
from lakebars.llm.exact_dedup import document_names, exact_dedup, without_copies

from odd_documents import ODD, nothing, odd  # noqa: F401  two of them are fixtures


def normal(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def brute(docs):
    groups = {}
    for doc in docs:
        groups.setdefault(normal(doc.text), []).append(doc.doc_id)
    found = []
    for doc in docs:
        ids = groups[normal(doc.text)]
        keep = min((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(normal(doc.text).encode()).hexdigest()
        found.append((doc.doc_id, keep, len(ids), doc.doc_id == keep, sha))
    return sorted(found, key=repr)


# A digest that is the same for many contents must not change anything.
DIGESTS = {
    "hash": F.xxhash64,
    "two values": lambda *columns: F.pmod(F.xxhash64(*columns), F.lit(2)),
    "one value": lambda *columns: F.lit(0).cast("long"),
}


@pytest.mark.parametrize("digest", DIGESTS)
@pytest.mark.parametrize("block", [7, 8192])
def test_groups_equal_brute_force(spark, odd, digest, block):
    docs = odd if block > 100 else odd.filter(F.coalesce(F.length("text"), F.lit(0)) < 1000)
    rows = [d for d in ODD if block > 100 or len(d.text or "") < 1000]
    found = exact_dedup(docs, block_bytes=block, digest=DIGESTS[digest])
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute(rows)


def test_no_rows(nothing):
    assert exact_dedup(nothing).count() == 0
    assert without_copies(nothing).columns == nothing.columns


def test_one_row_of_each_text_stays_with_all_columns(odd):
    kept = without_copies(odd)
    assert kept.columns == odd.columns
    texts = [normal(r.text) for r in kept.collect()]
    assert sorted(texts) == sorted({normal(d.text) for d in ODD})
    assert {r.doc_id for r in kept.filter(F.col("text").contains("quick brown")).collect()} == {1}


def test_a_column_of_any_name_stays(odd):
    docs = odd.withColumn("_SHA", F.lit("kept")).withColumn("_sha_", F.lit("too"))
    found = without_copies(docs)
    assert found.columns == docs.columns
    assert {(r["_SHA"], r["_sha_"]) for r in found.collect()} == {("kept", "too")}


def test_names_are_one_for_a_text_and_most_texts_take_several_rounds(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    found = document_names(docs).select("level", "name", "text_sha256").collect()
    assert len(found) == docs.count()
    assert len({(r.level, r.name) for r in found}) == len({r.text_sha256 for r in found})
    assert len({(r.level, r.name, r.text_sha256) for r in found}) == len({r.text_sha256 for r in found})
    assert sum(r.level > 0 for r in found) > len(found) / 2
