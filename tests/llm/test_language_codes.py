"""Language ID: classifiers and decoder against a plain version, many languages, and the registered query."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import language_id as L
from tidemark.llm.queries import op7_language_id

SF = "/root/testdata/sf0.01"


def buckets(text):
    """One bucket for each letter byte with its two neighbours; what isn't a letter is a space."""
    seen = [32, *(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in text.encode()), 32]
    return [(((a << 16 | b << 8 | c) * 2654435761) % 2**32) >> 17 for a, b, c in zip(seen, seen[1:], seen[2:]) if b != 32]


def plain(rows, code):
    """Predictions of all rows by loops over dictionaries."""
    learned = [(t, g) for i, t, g in rows if t is not None and g is not None and zlib.crc32(str(i).encode()) % 4 != 2]
    languages = sorted({g for _, g in learned})
    counts = {g: Counter(b for t, h in learned if h == g for b in buckets(t)) for g in languages}
    share = {g: lambda b, c=counts[g]: (c[b] + 0.1) / (c.total() + 0.1 * L.BUCKETS) for g in languages}

    def odds(bit, b):
        sides = [[share[g](b) for g, word in zip(languages, code, strict=True) if word[bit] == s] for s in (1, -1)]
        yes, no = (sum(s) / len(s) if s else 1 / L.BUCKETS for s in sides)
        return max(-4.0, min(4.0, math.log(yes) - math.log(no)))

    def margins(t):
        found = buckets(t)
        return [6 * sum(odds(bit, b) for b in found) / max(len(found), 1) for bit in range(code.shape[1])]

    right = [[m * w > 0 for m, w in zip(margins(t), code[languages.index(g)], strict=True)] for t, g in learned]
    error = [min(max(1 - sum(c) / len(c), 0.001), 0.499) for c in zip(*right, strict=True)]
    weight = [math.log((1 - e) / e) for e in error]
    weight = [w * len(weight) / sum(weight) for w in weight]
    out = {}
    for i, t, _ in rows:
        if t is None or not any(c.isalpha() for c in t):
            out[i] = ("und", 0.0)
            continue
        m = margins(t)
        loss = [sum(w * math.log1p(math.exp(-x * c)) for w, x, c in zip(weight, m, word, strict=True)) for word in code]
        out[i] = (languages[loss.index(min(loss))], 1 / sum(math.exp(min(loss) - x) for x in loss))
    return out


def spoken(n_languages, n, seed=3):
    rng = random.Random(seed)
    words = [["".join(rng.choice("abcdefghijklmnopqrstuvwxyz\u00e9\u00f1") for _ in range(rng.randrange(2, 6))) for _ in range(8)] for _ in range(n_languages)]
    rows = [(i, " ".join(rng.choice(words[i % n_languages]) for _ in range(rng.randrange(1, 9))), f"l{i % n_languages}") for i in range(n)]
    return rows + [(n, None, "l0"), (n + 1, "", "l1"), (n + 2, "12 .", None), (n + 3, rows[0][1].upper(), None), (n + 4, rows[1][1] * 50, "l1")]


@pytest.mark.parametrize("n", [1, 2, 4, 7])
def test_against_plain_loops(spark, n):
    rows = spoken(n, 90)
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = L.train(frame)
    want = plain(rows, model.code)
    made = {r.doc_id: (r.lang_pred, r.score) for r in L.predict(frame, model).collect()}
    assert {i: p for i, (p, _) in made.items()} == {i: p for i, (p, _) in want.items()}
    assert all(made[i][1] == pytest.approx(want[i][1], abs=1e-4) for i in want)


def test_every_language_is_learned(spark, monkeypatch):
    """More languages than any fixed number, most of them rare."""
    monkeypatch.setattr(L, "HELD_LANGUAGES", 40)
    rows = [(i, t, g) for i, t, g in spoken(320, 320 * 5)]
    rows += [(10**6 + i, t, g) for i, (_, t, g) in enumerate(rows[:320])]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = L.train(frame)
    assert len(model.languages) == 320 and len({tuple(w) for w in model.code.tolist()}) == 320
    made = L.predict(frame.where("text is not null and length(text) > 20 and lang is not null"), model).collect()
    assert np.mean([r.lang_pred == r.lang for r in made]) > 0.95


def test_query(spark):
    made = op7_language_id(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()
    assert Counter((r.doc_id, r.held_out) for r in made) == Counter((d.doc_id, zlib.crc32(str(d.doc_id).encode()) % 4 == 2) for d in docs)
    lang = {d.doc_id: d.lang for d in docs}
    unseen = [r.lang_pred == lang[r.doc_id] for r in made if r.held_out and lang[r.doc_id] is not None]
    assert len(unseen) > 100 and np.mean(unseen) >= 0.99
    assert all(0 <= r.score <= 1 for r in made)
