"""Suffix trees, split groups, and the registered query of op10, against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from conftest_llm import prose
from test_dedup import brute_repeats
from tidemark.llm import repeats
from tidemark.llm.queries import op10_substring_dedup

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("depth", [1, 2, 5, 7, 12, 35])
def test_suffix_tree(depth):
    rng = np.random.default_rng(depth)
    for size in (depth, depth + 1, 60, 200):
        symbols = rng.integers(0, 2, max(size, depth)).astype(np.uint64)
        starts = np.arange(len(symbols) - depth + 1)
        order, shared = repeats.suffix_tree(symbols, starts, depth)
        cut = [tuple(symbols[i : i + depth].tolist()) for i in order]
        assert sorted(order.tolist()) == starts.tolist() and cut == sorted(cut)
        for a, b, n in zip(cut, cut[1:], shared.tolist()):
            assert n == next((i for i in range(depth) if a[i] != b[i]), depth)


def test_groups_are_split_until_they_fit(spark, monkeypatch):
    """One phrase in many contexts, one passage in many texts, and repeated rows: all far above a group."""
    rng = random.Random(5)
    phrase, passage = prose(rng, 12), prose(rng, 50)
    texts = [f"{prose(rng, rng.randrange(30))} {phrase if i % 2 else passage} {prose(rng, rng.randrange(30))}" for i in range(160)]
    texts += ["so it goes " * 40, "so it goes " * 25, passage, passage, None, ""]
    rows = [(i if i % 7 else None, t) for i, t in enumerate(texts)] + [(3, texts[3]), (3, texts[3]), (None, texts[0]), (None, texts[0])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute_repeats(rows, 20)
    for group, slab in ((repeats.GROUP_WORDS, repeats.SLAB_WORDS), (400, 100), (30, 1)):
        monkeypatch.setattr(repeats, "GROUP_WORDS", group)
        monkeypatch.setattr(repeats, "SLAB_WORDS", slab)
        made = Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in repeats.remove_repeats(frame, window=20, prefix=4).collect())
        assert made == want


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = Counter({(i, n, gone, hashlib.sha256(kept.encode()).hexdigest()): c for (i, n, gone, kept), c in brute_repeats(rows, 35).items()})
    made = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in op10_substring_dedup(spark, SF).collect())
    assert made == want and sum(r[2] for r in want) > 0
