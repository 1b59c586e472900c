from __future__ import annotations

import random

import numpy as np
import pytest
from near_brute import smallest_reached
from odd_documents import Doc, ODD, nothing, odd, table_of  # noqa: F401  two of them are fixtures

from lakebars.llm import shingle_join
from lakebars.llm.components import components
from lakebars.llm.shingle_join import frequent_shingles, one_of_each_group, similar_groups
from lakebars.llm.signature_tree import links


def varied(rng, count, first_id=100):
    """Documents with shared passages, chains of near copies and exact copies."""
    words = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choices(words, k=30))
    docs = []
    for i in range(count):
        kind = rng.random()
        if docs and kind < 0.5:
            text = rng.choice(docs).text.split()
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = rng.choice(words)
            text = " ".join(text)
        else:
            text = " ".join(rng.choices(words, k=rng.choice([2, 4, 5, 12, 60, 150])))
            if kind > 0.8:
                text += " " + passage
        docs.append(Doc(first_id + i, text, "en", "a"))
    return docs


def found(rows):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows.collect()), key=repr)


def wanted(docs, *how):
    return sorted(((i, n, low) for i, _, n, low in smallest_reached(docs, *how)), key=repr)


@pytest.mark.parametrize(("words", "similarity"), [(3, (9, 10)), (5, (4, 5)), (2, (1, 2))])
def test_groups_equal_brute_force(spark, words, similarity, monkeypatch):
    monkeypatch.setattr(shingle_join, "BLOCK_SETS", 8)  # many blocks in a group
    docs = varied(random.Random(words), 250) + ODD
    got = similar_groups(table_of(spark, docs), words=words, similarity=similarity)
    assert found(got) == wanted(docs, words, *similarity)


def test_a_hot_group_of_near_copies_is_divided(spark, monkeypatch):
    monkeypatch.setattr(shingle_join, "BLOCK_SETS", 16)
    rng = random.Random(5)
    base = [f"b{i}" for i in range(200)]
    docs = []
    for i in range(150):
        text = list(base)
        text[rng.randrange(200)] = f"own{i}"
        docs.append(Doc(i, " ".join(text), "en", "a"))
    got = similar_groups(table_of(spark, docs))
    assert {r.component_id for r in got.collect()} == {0}


def test_no_rows(nothing):
    assert similar_groups(nothing).count() == 0
    assert one_of_each_group(nothing).columns == nothing.columns


def test_one_document_of_each_group_stays(spark, odd):
    kept = one_of_each_group(odd)
    assert kept.columns == odd.columns
    stays = [(i, t) for i, t, _, low in smallest_reached(ODD, 5, 4, 5) if low is None or i == low]
    assert sorted(map(repr, ((r.doc_id, r.text) for r in kept.collect()))) == sorted(map(repr, stays))


def test_frequent_shingles_only_order(spark):
    docs = varied(random.Random(1), 80)
    assert len(frequent_shingles(table_of(spark, docs), 3, "text", "doc_id")) > 0


@pytest.mark.parametrize("seed", range(40))
def test_trees_connect_what_brute_force_connects(seed):
    rng = random.Random(seed)
    num, den = rng.choice([(9, 10), (4, 5), (1, 2)])
    sets = []
    for _ in range(rng.randint(2, 80)):
        if sets and rng.random() < 0.6:
            new = set(rng.choice(sets))
            for _ in range(rng.randint(0, 1 + len(new) // 6)):
                new.add(rng.getrandbits(64))
                if len(new) > 1 and rng.random() < 0.5:
                    new.remove(rng.choice(sorted(new)))
        else:
            new = {rng.getrandbits(64) for _ in range(rng.choice([1, 2, 3, 10, 40, 120]))}
        sets.append(new)
    side = np.array([rng.randint(0, 1) if seed % 2 else 0 for _ in sets])
    between = len(set(side.tolist())) == 2

    def connected(pairs):
        group = list(range(len(sets)))
        for a, b in pairs:
            group = [group[a] if g == group[b] else g for g in group]
        names = {}
        return [names.setdefault(g, i) for i, g in enumerate(group)]

    similar = lambda a, b: den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    got = list(links(np.arange(len(sets)), arrays, side, num, den))
    want = [(a, b) for a in range(len(sets)) for b in range(a) if similar(a, b) and not (between and side[a] == side[b])]
    assert all(similar(a, b) for a, b in got)
    assert connected(got) == connected(want)


@pytest.mark.parametrize("seed", range(3))
def test_components_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    pairs = [(rng.randrange(60), rng.randrange(60)) for _ in range(25)]
    pairs += [(1000 + i, 1001 + i) for i in range(30)]  # a long chain
    pairs += [(5000, 5001 + i) for i in range(50)]  # a hub
    lowest = {}
    for a, b in pairs:
        lowest.setdefault(a, a), lowest.setdefault(b, b)
    for _ in lowest:
        for a, b in pairs:
            lowest[a] = lowest[b] = min(lowest[a], lowest[b])
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    alone = {a for a, b in pairs if a == b} - {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {k: v for k, v in lowest.items() if k not in alone}


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize(("small", "large", "similarity"), [(100, 300, (3, 10)), (60, 900, (1, 16)), (100, 199, (1, 2)), (100, 300, (1, 3))])
def test_sets_of_very_different_size_are_linked(small, large, similarity):
    members = np.array(random.Random(7).sample(range(1 << 40), large), np.uint64)
    sets = [np.sort(members), np.sort(members[:small])]
    found = list(links(np.array([5, 6]), sets, np.zeros(2, np.int64), *similarity))
    assert len(found) == 1 and set(found[0]) == {5, 6}
    assert not list(links(np.array([5, 6]), sets, np.zeros(2, np.int64), 9, 10))
