"""What a task holds beside its rows is bounded; the bounds do not change results."""

from __future__ import annotations

import tracemalloc

import numpy as np
import public_tokenizers
import tokenizers

from lakebars.llm import shingle_join, signature_tree, toxicity
from lakebars.llm.tokens import byte_level_encoder


def test_a_shingler_remembers_a_bounded_number_of_words():
    text = " ".join(f"w{i}" for i in range(200_000))
    used = shingle_join.Shingler(5)
    first = used(text)
    assert len(used._words) <= 1 << 16
    assert first.tolist() == used(text).tolist() == shingle_join.Shingler(5)(text).tolist()
    used("a b c d e f")
    assert used("w1 w2 w3 w4 w5 w6").tolist() == shingle_join.Shingler(5)("w1 w2 w3 w4 w5 w6").tolist()


def test_marks_of_a_bounded_number_of_words_are_remembered():
    marks = toxicity._Marks(toxicity.Lexicon(frozenset({"w"}), frozenset({"word"})))
    text = " ".join(f"{'word' if i % 3 else 'w'}{i} YOU b4d" for i in range(200_000))
    first = toxicity.features(text, marks)
    assert len(marks) <= 1 << 16
    assert first == toxicity.features(text, marks) == toxicity.features(text, toxicity._Marks(marks.lexicon))


def test_the_library_is_loaded_for_special_strings_only(monkeypatch):
    loaded, path = [], public_tokenizers.path("byte_bpe_50k.json")

    class Counted:
        @staticmethod
        def from_file(name):
            loaded.append(name)
            return whole

    whole = tokenizers.Tokenizer.from_file(path)
    monkeypatch.setattr(tokenizers, "Tokenizer", Counted)
    encode = byte_level_encoder.__wrapped__(path)
    encode("no special string here")
    assert loaded == []
    for text in ("a<|endoftext|>b", "<|endoftext|>"):
        assert encode(text).tolist() == whole.encode(text, add_special_tokens=False).ids
    assert loaded == [path]


def test_pairs_of_nodes_are_compared_a_few_at_a_time():
    rng = np.random.default_rng(5)
    common = rng.integers(0, 1 << 63, 800, np.uint64)
    sets = [np.unique(np.append(common, rng.integers(0, 1 << 63, 90, np.uint64))) for _ in range(512)]
    sizes = np.array([len(s) for s in sets])
    tree = signature_tree.SignatureTree(signature_tree.bitmaps(sets, 2048), sizes)
    tracemalloc.start()
    a, b = signature_tree.candidate_leaves(tree, tree, 4, 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(a) > 100_000 and (a < b).all()
    assert peak < 40 << 20
