"""Fill-in-middle: a text's prefix, middle and suffix in another order, for models that learn to fill gaps.

A text is a run of units, each a word with the white space before it, or the
white space at its end. One match of the repeated unit over the whole text keeps
every repetition, and the ends of its captures are the number of units and all
places a cut can lie at. Only these numbers leave Python; hashes, cuts and
outputs are DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakebars.llm.common import fresh, text_of

SEED = "42"
REARRANGED_PERCENT = 50
SUFFIX_FIRST_PERCENT = 80


class Marks(NamedTuple):
    """What stands before each part; a text that holds one of them stays plain."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"


MARKS = Marks()
COLUMNS = ("n", "form", "prefix_chars", "middle_chars", "output")


@lru_cache
def _units() -> regex.Pattern:
    """Possessive, so that nothing is kept for ways back: the first way always reaches the end."""
    return regex.compile(r"([\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++)*+")


def unit_ends(text: str) -> list[int]:
    """Where each unit of `text` ends, in code points."""
    return _units().fullmatch(text).ends(1)


def _cuts(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    """The number of units, and the ends of the prefix and of the middle."""
    for texts, ones, twos in parts:
        rows = []
        for text, one, two in zip(texts, ones, twos, strict=True):
            ends = unit_ends(text)
            n = len(ends)
            low, high = sorted((one % (n + 1), two % (n + 1)))
            rows.append((n, ends[low - 1] if low else 0, ends[high - 1] if high else 0))
        yield pd.DataFrame(rows, columns=["n", "first", "second"])


def _draw(doc_id: str, seed: str, place: int) -> Column:
    """The `place`-th group of eight digits of the hash of seed and id, as an unsigned integer."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary"), 256)
    return F.conv(F.substring(digest, 8 * place + 1, 8), 16, 10).cast("long")


def fill_in_middle(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    seed: str = SEED,
    rearranged_percent: int = REARRANGED_PERCENT,
    suffix_first_percent: int = SUFFIX_FIRST_PERCENT,
    marks: Marks = MARKS,
    prefix: str = "",
) -> DataFrame:
    """`docs` with `n, form, prefix_chars, middle_chars, output`.

    `n` is the number of units. `form` is `plain`, `spm` (suffix, prefix, middle)
    or `psm` (prefix, suffix, middle), with a mark before each part; lengths are
    in code points and null for `plain`. Form and cuts follow from `seed` and
    `doc_id` alone, so rows that repeat an id are cut alike; a null id counts as
    an empty one. An empty or null text, and one that holds a mark, is `plain`;
    the output of a null text is empty. `prefix` stands before the new names;
    columns of `docs` that have them already are replaced.
    """
    names = {name: f"{prefix}{name}" for name in COLUMNS}
    new = {name.lower() for name in names.values()}
    if {doc_id.lower(), text.lower()} & new:
        raise ValueError(f"{doc_id} and {text} cannot be replaced; choose a prefix")
    whole = text_of(text)
    cuts = F.pandas_udf(_cuts, "n long, first long, second long")(whole, _draw(doc_id, seed, 0), _draw(doc_id, seed, 1))
    held = F.lit(False)
    for mark in marks:
        held = held | F.contains(whole, F.lit(mark))
    plain = (whole == "") | held | (_draw(doc_id, seed, 2) % 100 >= rearranged_percent)
    suffix_first = _draw(doc_id, seed, 3) % 100 < suffix_first_percent
    form = F.when(plain, "plain").when(suffix_first, "spm").otherwise("psm")

    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in new]
    found = fresh(docs.columns, "_fim")
    rows = docs.select(*kept, F.struct(cuts.alias("cut"), form.alias("form")).alias(found))
    at = lambda name: F.col(f"{found}.cut.{name}").cast("int")
    form = F.col(f"{found}.form")
    part = {
        "prefix": F.concat(F.lit(marks.prefix), F.substring(whole, F.lit(1), at("first"))),
        "middle": F.concat(F.lit(marks.middle), F.substring(whole, at("first") + 1, at("second") - at("first"))),
        "suffix": F.concat(F.lit(marks.suffix), F.substring(whole, at("second") + 1, F.char_length(whole))),
    }
    output = (
        F.when(form == "plain", whole)
        .when(form == "spm", F.concat(part["suffix"], part["prefix"], part["middle"]))
        .otherwise(F.concat(part["prefix"], part["suffix"], part["middle"]))
    )
    moved = lambda length: F.when(form != "plain", length.cast("long"))
    columns = dict(
        n=F.col(f"{found}.cut.n"),
        form=form,
        prefix_chars=moved(at("first")),
        middle_chars=moved(at("second") - at("first")),
        output=output,
    )
    return rows.select(*kept, *(column.alias(names[name]) for name, column in columns.items()))


def restored(output: Column, form: Column, marks: Marks = MARKS) -> Column:
    """The text that `output` was made of.

    No part holds a mark, and no mark ends as another begins, so the first mark
    of a kind found is the one that was put there.
    """
    first = {"spm": (marks.suffix, marks.prefix), "psm": (marks.prefix, marks.suffix)}

    def parts(order: str) -> dict[str, Column]:
        one, two = first[order]
        rest = F.split_part(output, F.lit(two), F.lit(2))
        return {
            one: F.substring(F.split_part(output, F.lit(two), F.lit(1)), F.lit(len(one) + 1), F.char_length(output)),
            two: F.split_part(rest, F.lit(marks.middle), F.lit(1)),
            marks.middle: F.split_part(rest, F.lit(marks.middle), F.lit(2)),
        }

    def joined(order: str) -> Column:
        found = parts(order)
        return F.concat(found[marks.prefix], found[marks.middle], found[marks.suffix])

    return F.when(form == "plain", output).when(form == "spm", joined("spm")).otherwise(joined("psm"))
