"""Kept (id, text) pairs of near dedup against brute-force components, by text and not by the id that names them."""

import random

from conftest_llm import prose
from test_dedup import LOWER, words
from tidemark.llm import jaccard


def kept_pairs(rows, shingle, percent):
    """One (id, text) of each component of linked sets: the least id, nulls last."""
    sets = []
    for _, t in rows:
        w = words((t or "").translate(LOWER))
        sets.append(frozenset(tuple(w[j : j + shingle]) for j in range(max(1, len(w) - shingle + 1))) if w else frozenset())
    left, groups = set(range(len(rows))), []
    while left:
        todo = [left.pop()]
        group = set(todo)
        while todo:
            a = sets[todo.pop()]
            near = {j for j in left if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j])}
            left -= near
            group |= near
            todo += near
        groups.append([rows[i] for i in group])
    least = lambda own: min((k is None, k or 0) for k, _ in own)
    return [{(k, t) for k, t in own if (k is None, k or 0) == least(own)} for own in groups]


def test_ids_null_or_repeated(spark):
    rng = random.Random(5)
    rows = [(None, prose(rng, 40)) for _ in range(12)] + [(7, prose(rng, 40)) for _ in range(8)] + [(i, prose(rng, 40)) for i in range(20, 25)]
    for i in (0, 1, 13, 20):  # near copies, under a null id and under the repeated one
        rows += [(None, rows[i][1] + " more"), (7, rows[i][1] + " again")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    made = [(r.doc_id, r.text) for r in jaccard.first_of_each(frame).collect()]
    want = kept_pairs(rows, 5, 80)
    assert len(want) == 25 and len(made) == len(set(made)) == len(want)
    assert all(len(own & set(made)) == 1 for own in want)
