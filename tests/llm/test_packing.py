"""Packing: the library's ids, the reduction against an exhaustive search, and places without gaps."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from tidemark.llm import packing as K
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
PATH = P.path("word_bpe_49k.json")


def expected(rows, capacity=4096, end=1):
    library, out = Tokenizer.from_file(PATH), Counter()
    for key, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, end], dtype="<u4")
        for piece, start in enumerate(range(0, len(ids), capacity)):
            own = ids[start : start + capacity]
            out[key, piece, start, len(own), zlib.crc32(own.tobytes())] += 1
    return out


def held(made, rows, capacity=4096):
    """All pieces are there, none overlaps another, no sequence has a gap or too much; how many sequences."""
    assert Counter(tuple(r)[:5] for r in made) == expected(rows, capacity)
    sequences = defaultdict(list)
    for r in made:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_op12(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    made = QUERIES["op12_best_fit_packing"](spark, SF).collect()
    total = sum(r.length for r in made)
    assert held(made, rows) == -(-total // 4096)  # no packing has fewer


@pytest.mark.parametrize("capacity", [16, 4096])
def test_nasty(spark, nasty, none, capacity):
    rows = [(r.doc_id, r.text) for r in nasty.collect()]
    rows += [(900, "<|startoftext|>a<|EndOfText|> B<|endoftext|>"), (901, "Don't. İI Σς x.y, (z). 'S Å 각 á. \x1c ½"), (902, "I.A. I.,.. a,b. É."), (902, "")]
    more = spark.createDataFrame(rows[-4:], "doc_id long, text string")
    docs = nasty.unionByName(more, allowMissingColumns=True).repartition(6)
    made = K.pack(docs, PATH, capacity=capacity)
    assert made.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    held(made.collect(), rows, capacity)
    assert K.pack(none, PATH).count() == 0


def optimum(items, capacity):
    items, best = sorted(items, reverse=True), [len(items)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for j in {used: j for j, used in enumerate(bins)}.values():  # one of each room
            if bins[j] + items[i] <= capacity:
                bins[j] += items[i]
                place(i + 1, bins)
                bins[j] -= items[i]
        bins.append(items[i])
        place(i + 1, bins)
        bins.pop()

    place(0, [])
    return best[0]


def test_reduction_keeps_the_optimum():
    rng, fixed = random.Random(4), 0
    for _ in range(800):
        capacity = rng.choice([10, 20, 37, 100])
        low = max(1, capacity // rng.choice([3, 4, 5, 20]))
        items = [rng.randrange(low, capacity + 1) for _ in range(rng.randrange(1, 10))]
        count = np.bincount(items, minlength=capacity + 1)
        plan = K.Plan(capacity)
        K.reduce_instance(plan, count)
        left = np.repeat(np.arange(capacity + 1), count).tolist()
        assert plan.fixed + optimum(left, capacity) == optimum(items, capacity)
        fixed += plan.fixed
    assert fixed > 1000


def test_best_fit_is_best_fit():
    """Range by range gives as many sequences, with the same room, as piece by piece."""
    rng = random.Random(6)
    for _ in range(200):
        capacity = rng.choice([20, 50, 100])
        items = [rng.randrange(1, rng.choice([capacity // 2, capacity]) + 1) for _ in range(rng.randrange(0, 60))]
        bins = []
        for w in sorted(items, reverse=True):
            fit = [j for j, used in enumerate(bins) if used + w <= capacity]
            if fit:
                bins[max(fit, key=lambda j: bins[j])] += w
            else:
                bins.append(w)
        plan = K.Plan(capacity)
        K.best_fit(plan, np.bincount(items, minlength=capacity + 1))
        used, slots = Counter(), K.Slots(plan)
        for w, n in Counter(items).items():
            for q in slots.place(np.full(n, w), np.arange(n))[0].tolist():
                used[q] += w
        assert sorted(used.values()) == sorted(bins)


def test_plan_is_bounded():
    rng = np.random.default_rng(1)
    for lengths in (rng.integers(1, 4097, 300_000), rng.integers(700, 2000, 50_000), np.minimum(4096, np.exp(rng.normal(5.5, 1.3, 300_000)).astype(int) + 1)):
        plan = K.make_plan(dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True)), strict=True)))
        assert len(plan.slots) < K.SLOTS_PER_LENGTH * 4096
        assert plan.sequences < 1.06 * lengths.sum() / 4096
