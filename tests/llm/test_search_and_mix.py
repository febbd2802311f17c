"""Nearest neighbours, mixing, language ID and HTML against brute force or known answers."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import ann, html_text, language_id, mixing

NAN, INF = float("nan"), float("inf")


def neighbours(rows, is_query, k=10):
    good = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    dim = Counter(len(v) for _, v in good).most_common(1)[0][0] if good else 0
    good = [(i, v) for i, v in good if len(v) == dim]
    out = {}
    for i, q in good:
        if is_query(i):
            out[i] = sorted((float(np.sqrt(((v - q) ** 2).sum())), j) for j, v in good if j != i)[:k]
    return out


def test_small_tables_are_searched_whole(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.0]), (100, [0.5, 0.5]), (3, None), (200, [0.0, 0.0]), (4, [NAN, 1.0]), (5, [INF, 1.0]), (6, [None, 1.0]), (None, [1.0, 1.0]), (7, [1.0, 2.0, 3.0]), (8, []), (300, [9.0, 9.0])]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, leaf string, rank int")
    made = defaultdict(list)
    for r in ann.nearest(frame, lambda i: i % 100 == 0).orderBy("query_id", "rank").collect():
        assert r.rank == len(made[r.query_id]) + 1
        made[r.query_id].append((r.score, r.vec_id))
    assert dict(made) == neighbours(rows, lambda i: i % 100 == 0)
    assert ann.nearest(frame.limit(0), lambda i: i % 100 == 0).count() == 0
    assert ann.nearest(frame.where("vec_id = 0"), lambda i: i % 100 == 0).count() == 0


def test_recall_and_hot_vectors(spark):
    rng = np.random.default_rng(2)
    centers = rng.normal(size=(12, 16))
    points = [(i, (centers[i % 12] + 0.2 * rng.normal(size=16)).tolist()) for i in range(2000)] + [(5000 + i, centers[0].tolist()) for i in range(1000)]
    frame = spark.createDataFrame(points, "vec_id long, embedding array<double>").repartition(6)
    want = neighbours(points, lambda i: i % 100 == 0)
    made = defaultdict(list)
    for r in ann.nearest(frame, lambda i: i % 100 == 0).collect():
        made[r.query_id].append((r.score, r.vec_id))
    assert set(made) == set(want)
    found = sum(len({i for _, i in made[q]} & {i for _, i in want[q]}) for q in want)
    assert found >= 0.9 * sum(map(len, want.values()))
    known = {q: dict((i, s) for s, i in neighbours(points, lambda i, q=q: i == q, k=10**6)[q]) for q in list(want)[:3]}
    assert all(known[q][i] == s for q in known for s, i in made[q])


def test_structured_vectors_need_few_leaves(spark):
    """Clustered vectors: the measured recall holds, and a query visits a small part of the tree."""
    rng = np.random.default_rng(6)
    centers = rng.normal(size=(300, 32))
    x = centers[rng.integers(0, 300, 20_000)] + 0.25 * rng.normal(size=(20_000, 32))
    frame = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>").repartition(4)
    made = ann.nearest(frame, lambda i: i % 100 == 0).collect()
    found, visits, leaves, recall = defaultdict(set), made[0].visits, made[0].leaves, made[0].recall
    for r in made:
        found[r.query_id].add(r.vec_id)
    hits = 0
    for q in range(0, 20_000, 100):
        away = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        away[q] = np.inf
        hits += len(set(np.argsort(away)[:10].tolist()) & found[q])
    assert recall >= 0.9 and hits >= 0.9 * 2000 and leaves > 50 and visits < leaves / 5


def test_very_large_and_small_components(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(60, 4))
    for scale in (2.0**530, 2.0**-530):
        frame = spark.createDataFrame([(i, (v * scale).tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
        made = ann.nearest(frame, lambda i: i % 20 == 0).collect()
        want = neighbours(list(enumerate(x.tolist())), lambda i: i % 20 == 0)
        assert len(made) == 30
        assert all(any(r.vec_id == i and r.score / scale == pytest.approx(s) for s, i in want[r.query_id]) for r in made)


def test_tree_visits_every_leaf():
    x = np.random.default_rng(1).normal(size=(900, 5))
    tree = ann.fit_tree(x)
    order = list(tree.visit(x[0]))
    assert sorted(order) == list(range(tree.leaves)) and tree.leaves > 10
    assert set(tree.assign(x)) <= set(order)


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    total, out, left = sum(sizes.values()), {}, set(names)
    while left:
        rest = total - sum(out.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
        over = {s for s in left if share[s] > 3 * sizes[s]}
        if not over:
            return out | share
        out |= {s: 3.0 * sizes[s] for s in over}
        left -= over
    return out


def test_mix(nasty, none, spark):
    rows = nasty.collect()
    sizes = Counter()
    for r in rows:
        sizes[r.source] += size_of(r.text)
    want = targets(dict(sizes))
    taken = Counter()
    made = mixing.mix(nasty).collect()
    by_size = {v: k for k, v in sizes.items()}
    assert Counter((r.doc_id, r["size"]) for r in made) == Counter((r.doc_id, size_of(r.text)) for r in rows)
    for r in made:
        source = by_size[r.source_size]
        assert r.target == pytest.approx(want[source]) and 0 <= r.taken <= 3 * r["size"]
        taken[source] += r.taken
    assert all(taken[s] == math.floor(want[s] + 0.5) for s in sizes)
    again = mixing.mix(nasty.repartition(2)).collect()
    key = lambda r: (repr(r.doc_id), r["size"], r.source_size, r.taken)
    assert sorted(map(key, again)) == sorted(map(key, made))
    mixed = mixing.mixed_rows(nasty, n_chars="n_chars")
    assert mixed.columns == nasty.columns
    got = Counter()
    for r in mixed.collect():
        got[r.source] += size_of(r.text)
        assert r.n_chars in (len(r.text), None)
    assert got == Counter({s: n for s, n in taken.items() if n})
    assert mixing.mix(none).count() == 0 and mixing.mixed_rows(none).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert [(r["size"], r.target, r.taken) for r in mixing.mix(blank).collect()] == [(0, 0.0, 0)] * 2


def test_mix_targets_water_fill(spark):
    rng = random.Random(4)
    for _ in range(5):
        sizes = {f"s{i}": rng.choice([0, 1, 5, 50, 1000]) for i in range(rng.randrange(1, 9))} | {None: 3}
        frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        made = {r.source: r.target for r in mixing.source_targets(frame).collect()}
        want = targets(sizes)
        assert all(made[s] == pytest.approx(want[s]) for s in sizes)


def speech(rng, vocabulary, n):
    return " ".join(rng.choice(vocabulary) for _ in range(n))


VOCABULARIES = {
    "en": "the and with that from this have which their would there about people other".split(),
    "de": "der und mit das von nicht eine ist auch werden über für schön größe".split(),
    "fr": "le et avec que dans une est pas pour être très où été français".split(),
    "es": "el y con que para una es no por más está año español también".split(),
    "it": "il e con che per una è non più sono della anche perché città".split(),
    "nl": "de en met dat van niet een is ook worden over voor zijn geen".split(),
}


def speakers(spark, languages):
    rng = random.Random(8)
    rows = [(i, speech(rng, VOCABULARIES[g], rng.randrange(3, 60)), g) for i, g in enumerate(languages * 60)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


@pytest.mark.parametrize("n", [2, 4, 6])
def test_language_held_out(spark, n):
    docs = speakers(spark, list(VOCABULARIES)[:n])
    model = language_id.train(docs)
    assert len({tuple(w) for w in model.code.tolist()}) == n
    made = language_id.predict(docs, model).withColumn("out", language_id.held_out()).where("out").collect()
    assert len(made) >= 14 * n and sum(r.lang == r.lang_pred for r in made) >= 0.97 * len(made)
    assert all(0 <= r.score <= 1 for r in made)


def test_language_never_reads_labels_of_held_out_rows(spark):
    docs = speakers(spark, ["en", "de"])
    lied = docs.withColumn("lang", F.when(language_id.held_out(), "zz").otherwise(F.col("lang")))
    assert language_id.train(lied).languages == ["de", "en"]


def test_language_edges(nasty, none, spark):
    model = language_id.train(speakers(spark, ["en", "de", "fr"]))
    made = language_id.predict(nasty, model).collect()
    assert len(made) == nasty.count()
    for r in made:
        blank = not any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == blank and (not blank or (r.score == 0.0 and r.ambiguous))
    assert language_id.predict(none, model).count() == 0
    assert language_id.train(none) is None
    assert {r.lang_pred for r in language_id.predict(nasty, None).collect()} == {"und"}


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><article>no</article>";</script></head><body class="home-page">
<header><h1>Site</h1></header><nav><ul><li><a href=/>Home page</a></li></ul></nav><!-- <p>no</p> --><div class="ad">Buy this now</div><div id="cookie-notice"><p>We use cookies on this site</p></div>
<main><article class="post"><h1>A &amp; B</h1><p>First   paragraph,<br>with <b>bold</b>
and <a href="x">a link</a>.<aside>Related things</aside><p>Second &eacute;&nbsp;one &#8212; end.</p><ul><li>item one</li><li>item two</li></ul><div class="advert">No</div>
<form><p>Your mail</p><input name=x></form><section id="comments"><p>I like this text, said a reader with very many words of praise for it</p></section></article></main>
<div class="sidebar"><p>Other articles that one might read as well, with a long text</p></div><footer>&copy; Site</footer></body></html>"""
WANT = "A & B\nFirst paragraph, with bold and a link.\nSecond é one — end.\nitem one\nitem two"


def test_main_text():
    assert html_text.main_text(PAGE, html_text.PRIOR) == WANT
    assert html_text.main_text(PAGE.replace("<main>", "").replace("</main>", ""), html_text.PRIOR) == WANT
    plain = PAGE.replace('<main><article class="post">', "<div>").replace("</article></main>", "</div>")
    assert html_text.main_text(plain, html_text.PRIOR) == WANT
    for page in (None, "", "   ", "<p>", "<!-- x", "<script>x", "<div class='ad'>x</div>"):
        assert html_text.main_text(page, html_text.PRIOR) == ""
    assert html_text.main_text("no tags &lt;here&gt;", html_text.PRIOR) == "no tags <here>"
    assert html_text.main_text("<article><p>cut off in the midd", html_text.PRIOR) == "cut off in the midd"
    long = "<article>" + "<p>word word</p>" * 20000 + "</article>"
    assert html_text.main_text(long, html_text.PRIOR).count("\n") == 19999


def test_boilerplate_by_name():
    inside = lambda attributes: html_text.main_text(f"<article><p>one two</p><div {attributes}><p>three</p></div><p>four</p></article>", html_text.PRIOR)
    outside = lambda attributes: html_text.main_text(f"<body><div {attributes}>one</div><div><p>two three four</p></div></body>", html_text.PRIOR)
    for attributes in ('class="comments"', 'class="commentList"', 'id="reader_comments"', "class=ad", 'class="x advert-box"', 'role="navigation"', 'class="share-buttons"', "hidden", 'style="display: none"', 'class="newsletter signup"'):
        assert inside(attributes) == "one two\nfour", attributes
    for attributes in ('class="commentary"', 'class="shadow"', 'class="header"', 'class="load"', 'id="adaptive"', 'class="article-header"'):
        assert inside(attributes) == "one two\nthree\nfour", attributes
    for attributes in ('class="header"', 'id="site-header"', 'role="banner"', 'class="top menu"', 'id="sidebar"'):
        assert outside(attributes) == "two three four", attributes
    assert outside('class="article-header"') == "one\ntwo three four"


def test_best_span():
    rng = random.Random(1)
    for _ in range(200):
        v = np.array([rng.choice([-3, -1, 0, 2, 4]) for _ in range(rng.randrange(12))], dtype=float)
        a, z = html_text.best_span(v)
        best = max([0.0] + [v[i:j].sum() for i in range(len(v)) for j in range(i + 1, len(v) + 1)])
        assert v[a:z].sum() == best


def test_pages(spark):
    rows = [(1, "u1", PAGE), (2, None, None), (None, "u3", ""), (1, "u1", PAGE)]
    pages = spark.createDataFrame([(*r, "old") for r in rows], "page_id long, url string, html string, text string")
    weights = html_text.learn(pages)
    assert set(weights) == set(html_text.PRIOR) and weights["content"] > 0 > weights["tag"]
    made = html_text.extract(pages, weights).collect()
    assert Counter((r.page_id, r.text) for r in made) == Counter({(1, WANT): 2, (2, ""): 1, (None, ""): 1})
    assert html_text.extract(pages.limit(0), html_text.learn(pages.limit(0))).count() == 0
