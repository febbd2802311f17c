"""Exact, near and substring dedup against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest_llm import SCHEMA, prose
from tidemark.llm import exact_dedup, jaccard, repeats, scratch

GAP = re.compile(r"[\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_exact(nasty, none):
    rows = [(r.doc_id, r.text or "") for r in nasty.collect()]
    groups = defaultdict(list)
    for i, t in rows:
        groups[GAP.sub("", t)].append((i, t))
    want = Counter()
    for norm, own in groups.items():
        digest = hashlib.sha256(norm.encode()).hexdigest()
        best = min(own, key=lambda r: (-len(r[1]), r[0] is None, r[0] or 0))
        taken = False
        for r in own:
            kept = not taken and r == best
            taken = taken or kept
            want[r[0], best[0], len(own), kept, digest] += 1
    made = Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup.label(nasty).collect())
    assert made == want
    assert exact_dedup.label(none).count() == 0
    kept = exact_dedup.kept_rows(nasty)
    assert kept.columns == nasty.columns and kept.count() == len(groups)
    assert {GAP.sub("", r.text or "") for r in kept.collect()} == set(groups)


def test_tree_merge_of_many_runs(spark):
    frame = spark.range(400).selectExpr("id as doc_id", "repeat('x', cast(id % 7 as int)) as text").repartition(23)
    runs = exact_dedup.digest_runs(frame)
    made = exact_dedup.tree_merge(runs, fan_in=2).collect()
    assert sorted((r.best.id, r.n) for r in made) == [(i, len(range(i, 400, 7))) for i in range(7)]


def test_hot_copies(spark, monkeypatch):
    """A third of all rows are copies of one text, over all partitions; the kept rows' join is a shuffle."""
    rows = [(i if i % 5 else None, " the  same text " if i % 3 == 0 else f"text {i % 40}") for i in range(900)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    groups = defaultdict(list)
    for i, t in rows:
        groups[GAP.sub("", t)].append((-len(t), i is None, i))
    made = exact_dedup.label(frame).collect()
    want = Counter((i, min(groups[GAP.sub("", t)])[2], len(groups[GAP.sub("", t)])) for i, t in rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in made) == want and sum(r.kept for r in made) == len(groups)
    monkeypatch.setattr(scratch, "SENT_BYTES", 0)
    assert {GAP.sub("", r.text) for r in exact_dedup.kept_rows(frame).collect()} == set(groups) and exact_dedup.kept_rows(frame).count() == len(groups)


def components(rows, shingle, percent):
    """(shingles, least id reachable) by comparing all pairs."""
    sets = []
    for _, t in rows:
        w = words((t or "").translate(LOWER))
        sets.append(frozenset(tuple(w[j : j + shingle]) for j in range(max(1, len(w) - shingle + 1))) if w else frozenset())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[root(i)] = min(least.get(root(i), key), key)
    return Counter((rows[i][0], len(sets[i]), least.get(root(i)) if sets[i] else rows[i][0]) for i in range(len(rows)))


def made_by(frame, shingle, percent):
    return Counter((r.id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(frame, shingle=shingle, percent=percent).collect())


@pytest.mark.parametrize(("shingle", "percent"), [(3, 90), (5, 80), (1, 50)])
def test_near(nasty, shingle, percent):
    assert made_by(nasty, shingle, percent) == components([(r.doc_id, r.text) for r in nasty.collect()], shingle, percent)


def test_near_empty(none):
    assert jaccard.near_duplicates(none).count() == 0


def many_copies(spark):
    rng = random.Random(3)
    rows, bases = [], [prose(rng, 60).split() for _ in range(3)]
    common = prose(rng, 30)
    for i in range(240):
        copy = list(bases[i % 3])
        for _ in range(rng.randrange(4)):
            copy[rng.randrange(len(copy))] = f"w{rng.randrange(30)}"
        rows.append((i, " ".join(copy) if i % 4 else common + " " + prose(rng, rng.randrange(1, 40))))
    return rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def test_near_in_blocks_and_without_frequent_tokens(spark, monkeypatch):
    rows, frame = many_copies(spark)
    want = components(rows, 3, 90)
    assert made_by(frame, 3, 90) == want
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 7)
    monkeypatch.setattr(jaccard, "VISITORS", 5)
    assert made_by(frame, 3, 90) == want
    monkeypatch.setattr(jaccard, "BLOCK_TOKENS", 200)
    monkeypatch.setattr(jaccard, "FREQUENT_TOKENS", 0)
    assert made_by(frame, 3, 90) == want
    monkeypatch.setattr(scratch, "SENT_BYTES", 0)
    assert made_by(frame, 3, 90) == want


def test_a_small_stray_is_met_by_a_larger_member_of_another_block(spark, monkeypatch):
    """Each stray links only to one larger set, which the main component of the group holds."""
    rng = random.Random(5)
    base = [f"b{i}" for i in range(100)]
    rows = [(i, " ".join([*base[:i], f"x{i}", *base[i + 1 :]])) for i in range(30)]
    for i in range(40):
        large = base + [f"m{i}.{j}" for j in range(5)]
        lost = set(rng.sample(base, 6))
        rows += [(100 + i, " ".join(large)), (200 + i, " ".join(w for w in large if w not in lost))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = components(rows, 1, 90)
    assert {k[2] for k in want} == {0}
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 9)
    monkeypatch.setattr(jaccard, "VISITORS", 5)
    sets = jaccard._sets
    monkeypatch.setattr(jaccard, "_sets", lambda *a: sets(*a).withColumn("grp", F.lit(1).cast("long")))
    assert made_by(frame, 1, 90) == want


@pytest.mark.parametrize(("shingle", "percent", "kind"), [(3, 90, "put in"), (5, 80, "put in"), (1, 90, "left out")])
def test_strays_of_a_large_group(spark, monkeypatch, shingle, percent, kind):
    """Copies of one text too far from each other for a link, and pairs of such: those with words put in open few blocks."""
    rng = random.Random(9)
    base = [f"b{i}" for i in range(150)]
    rows = [(i, " ".join([*base[:i], f"x{i}", *base[i + 1 :]])) for i in range(60)]
    for i in range(200):
        if kind == "put in":
            changed = set(rng.sample(range(150), rng.randrange(8, 20)))
            copy = [f"c{i}.{j}" if j in changed else w for j, w in enumerate(base)]
        else:
            lost = set(rng.sample(base, rng.randrange(16, 40)))
            copy = [w for w in base if w not in lost]
        rows += [(100 + i, " ".join(copy))] + [(1000 + i, " ".join([*copy[1:], f"z{i}"]))] * (i % 8 == 0)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 9)
    sets, written, opened = jaccard._sets, jaccard.written, []
    monkeypatch.setattr(jaccard, "_sets", lambda *a: sets(*a).withColumn("grp", F.lit(1).cast("long")))

    def spied(df, name):
        table = written(df, name)
        if name == "opened-places":
            opened.append(table.count())
        return table

    monkeypatch.setattr(jaccard, "written", spied)
    want = components(rows, shingle, percent)
    assert {(1000, 100), (1008, 108)} <= {(i, c) for i, _, c in want}
    assert made_by(frame, shingle, percent) == want
    assert opened and (kind == "left out" or opened[0] < 3 * 225)  # of 225 strays; 31 blocks by each would be about 7000


def test_sets_without_a_partner_in_their_group_are_not_compared(spark, monkeypatch):
    """Of a group of unrelated texts, each with words of some text of another size, only those with a near copy are sent."""
    rng = random.Random(13)
    own = [[f"{'s' if j < 10 else 'a'}{i}.{j}" for j in range(20)] for i in range(300)]
    rows = [(i, " ".join(w)) for i, w in enumerate(own)]
    rows += [(1000 + i, " ".join([*(f"l{i}.{j}" for j in range(300)), *(x for w in own[i::10] for x in w[:10])])) for i in range(10)]
    rows += [(2000 + i, " ".join([*own[i][:-2], f"z{i}"])) for i in range(0, 300, 10)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 9)
    sets, written, sizes = jaccard._sets, jaccard.written, {}
    monkeypatch.setattr(jaccard, "_sets", lambda *a: sets(*a).withColumn("grp", F.when(F.col("n") > 200, 2).otherwise(1).cast("long")))

    def spied(df, name):
        table = written(df, name)
        sizes.setdefault(name, []).append(table.agg(F.sum(F.size("prefix"))).first()[0] if name == "links" and "prefix" in table.columns else table.count())
        return table

    monkeypatch.setattr(jaccard, "written", spied)
    want = components(rows, 1, 50)
    assert sum(c != i for i, _, c in want) == 30
    assert made_by(frame, 1, 50) == want
    assert sizes["fetch-sets"][0] == 60  # of 340 sets
    assert sizes["links"][0] < 1500  # words shown of the members of other blocks


@pytest.mark.parametrize("percent", [50, 70, 80, 90])
def test_differences_to_the_pivot_show_a_token_of_each_link(percent):
    """Of sets that link, one of them not to the pivot, the shown tokens hold a shared one that stands where both allow the link."""
    rng = random.Random(percent)
    whole, part, pairs = 100 + percent, 100 - percent, 0
    for _ in range(60):
        core = rng.sample(range(1, 400), rng.randrange(5, 60))
        sets = []
        for _ in range(40):
            near = rng.choice(sets) if sets and rng.random() < 0.6 else set(core)
            one = {x for x in near if rng.random() > rng.choice([0, 0.05, 0.3])} | set(rng.sample(range(400, 460), rng.randrange(rng.choice([1, 4, 20]))))
            sets.append(one or {1})
        arrays = [np.array(sorted(s), dtype=np.uint64) for s in sets]
        block = jaccard.Block(percent, among=True, ranks=True)
        for i, tokens in enumerate(arrays):
            block.add((i, 0), tokens, visits=i >= 12)
        pivot = block.pivot
        shown = {name[0]: (n, m, first.tolist()) for name, n, m, first in block.ranked if m}
        links = lambda a, b: 100 * len(a & b) >= percent * len(a | b)
        far = {i for i in shown if not links(sets[i], set(pivot.tolist()))}
        for a in far:
            for b in set(shown) - {a}:
                if links(sets[a], sets[b]):
                    (n, m, one), (k, j, two) = shown[a], shown[b]
                    both = [x for x in one if x in two]
                    pairs += 1
                    assert any(
                        whole * m + part * n - 2 * whole * one.index(x) >= whole * j - part * k and whole * j + part * k - 2 * whole * two.index(x) >= whole * m - part * n
                        for x in both
                    )
    assert pairs > 200


def test_one_name_for_all_groups(nasty, spark, monkeypatch):
    """All sets in one group of many blocks: strays and visitors of several components are all compared."""
    rows, _ = many_copies(spark)
    rng = random.Random(11)
    for i in range(60):  # bridges between components, and pairs
        one = rows[rng.randrange(240)][1].split()
        rows.append((1000 + i, " ".join(one[: len(one) * 9 // 10] + [f"b{i % 7}"] * rng.randrange(3))))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 9)
    monkeypatch.setattr(jaccard, "VISITORS", 5)
    for name in ("one", "two"):
        sets = jaccard._sets
        group = F.lit(1).cast("long") if name == "one" else F.pmod("d1", F.lit(2)).cast("long")
        with monkeypatch.context() as m:
            m.setattr(jaccard, "_sets", lambda *a, group=group: sets(*a).withColumn("grp", group))
            for shingle, percent in ((3, 90), (2, 70)):
                assert made_by(frame, shingle, percent) == components(rows, shingle, percent)


def test_first_of_each(nasty):
    """One (id, text) of each component stays, known by what links and not by an id that unrelated texts may share."""
    from test_first_of_each import kept_pairs

    made = jaccard.first_of_each(nasty)
    assert made.columns == nasty.columns
    left = [(r.doc_id, r.text or "") for r in made.collect()]
    want = kept_pairs([(r.doc_id, r.text or "") for r in nasty.collect() if words(r.text)], 5, 80)
    blank = {(r.doc_id, r.text or "") for r in nasty.collect() if not words(r.text)}
    assert len(left) == len(set(left)) == len(want) + len(blank) and blank <= set(left)
    assert all(len(own & set(left)) == 1 for own in want)


def chain(spark):
    """Texts of which only neighbours link, so that a component is as long as its table."""
    w = [f"w{i}" for i in range(400)]
    return [(1000 - i, " ".join(w[i : i + 100])) for i in range(0, 60)]


def test_long_chain(spark):
    rows = chain(spark)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert made_by(frame, 1, 95) == components(rows, 1, 95)


def brute_repeats(rows, window):
    seen = Counter()
    split = [words(t) for _, t in rows]
    for w in split:
        seen.update(tuple(w[i : i + window]) for i in range(len(w) - window + 1))
    out = Counter()
    for (key, _), w in zip(rows, split, strict=True):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out[key, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)] += 1
    return out


@pytest.mark.parametrize(("window", "prefix"), [(35, 8), (6, 3), (4, 4)])
def test_substrings(nasty, window, prefix):
    rows = [(r.doc_id, r.text) for r in nasty.collect()]
    made = Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in repeats.remove_repeats(nasty, window=window, prefix=prefix).collect())
    assert made == brute_repeats(rows, window)


def test_substrings_of_few_words(spark):
    """Texts over two words, full of loops and overlapping repeats."""
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice(["a", "b"]) for _ in range(rng.randrange(60)))) for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    made = Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in repeats.remove_repeats(frame, window=12, prefix=3).collect())
    assert made == brute_repeats(rows, 12)


def test_substrings_empty(none, spark):
    assert repeats.remove_repeats(none).count() == 0
    assert SCHEMA and prose
