"""Fill-in-middle against plain Python, and its exact way back."""

from __future__ import annotations

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd_documents import ODD, nothing, odd  # noqa: F401  fixtures
from pyspark.sql import functions as F

from lakebars.llm.fill_middle import Marks, fill_in_middle, restored, unit_ends

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text, rearranged=50, suffix_first=80, marks=Marks()):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or any(mark in text for mark in marks) or h[2] % 100 >= rearranged:
        return n, "plain", None, None, text
    parts = {"P": marks.prefix + prefix, "S": marks.suffix + suffix, "M": marks.middle + middle}
    form, order = ("spm", "SPM") if h[3] % 100 < suffix_first else ("psm", "PSM")
    return n, form, len(prefix), len(middle), "".join(parts[part] for part in order)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" \t\n\x0b\x0c\r\x1f\xa0aé🎉 ", max_size=40))
def test_unit_ends(text):
    units = UNIT.findall(text)
    assert "".join(units) == text
    ends = unit_ends(text)
    assert len(ends) == len(units)
    assert all(text[:end] == "".join(units[: i + 1]) for i, end in enumerate(ends))


@pytest.mark.parametrize(("rearranged", "suffix_first"), [(50, 80), (100, 50), (0, 80)])
def test_odd_documents(odd, rearranged, suffix_first):  # noqa: F811
    found = fill_in_middle(odd, rearranged_percent=rearranged, suffix_first_percent=suffix_first)
    found = found.withColumn("back", restored(F.col("output"), F.col("form")))
    assert [c for c in found.columns if c not in ("form", "prefix_chars", "middle_chars", "output", "back")] == [
        *(c for c in odd.columns if c != "n"),
        "n",
    ]
    got = [(r.doc_id, r.text, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in found.collect()]
    want = [(d.doc_id, d.text, *brute(d.doc_id, d.text, rearranged, suffix_first), d.text or "") for d in ODD]
    assert sorted(got, key=repr) == sorted(want, key=repr)


TRICKY = ["<", "P>", "<P", "<S", ">", "<S>", "<M> x", "a<P>b", "< P> <S", "<<S >M<", "S>M> <", "🎉<P 漢 <", "\x1f a"]


def test_the_way_back_with_pieces_of_marks(spark):
    rows = [(i, " ".join(TRICKY[j] for j in range(len(TRICKY)) if i >> j & 1 and "<S>" not in TRICKY[j])) for i in range(1 << 9)]
    rows += [(1000 + i, text) for i, text in enumerate(TRICKY)]
    found = fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string"), rearranged_percent=100, suffix_first_percent=50)
    found = found.withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    assert all(r.back == r.text for r in found)
    assert {r.form for r in found} == {"plain", "spm", "psm"}
    assert {tuple(brute(r.doc_id, r.text, 100, 50)) for r in found} == {(r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in found}


def test_names_that_clash(spark, nothing):  # noqa: F811
    docs = spark.createDataFrame([(1, "a b c", "x", "y", "z")], "doc_id long, text string, Form string, OUTPUT string, _fim string")
    found = fill_in_middle(docs)
    assert found.columns == ["doc_id", "text", "_fim", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert found.first()["n"] == 3 and found.first()["_fim"] == "z"
    assert fill_in_middle(docs, prefix="x_").select("Form", "OUTPUT", "x_n").first() == ("x", "y", 3)
    assert fill_in_middle(nothing).collect() == []
    with pytest.raises(ValueError, match="prefix"):
        fill_in_middle(docs.withColumnRenamed("doc_id", "N"), doc_id="N")
