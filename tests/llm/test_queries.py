"""Registered queries over whole small tables against the libraries, the source and brute force."""

import base64
import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import tiktoken
from tokenizers import Tokenizer

from test_dedup import components
from tidemark.llm.queries import QUERIES
from tidemark.llm.token_counts import token_counts

SF = "/root/testdata/sf0.001"


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def hexed(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def test_op1(spark):
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = Counter()
    for r in table(spark, "documents").select("doc_id", "text").collect():
        n = len(library.encode(r.text or "", add_special_tokens=False).ids)
        want[r.doc_id, len((r.text or "").encode()), n, n > 512] += 1
    assert Counter(map(tuple, QUERIES["op1_token_counts"](spark, SF).collect())) == want


def test_op1_frequent_long_pre_tokens(spark):
    """A long rule and a long run of blanks in every text."""
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    rows = [(i, f"a{i} {'-' * 300} b{' ' * 200}c {'é' * 30}") for i in range(60)]
    made = token_counts(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), P.path("byte_bpe_50k.json"), P.PATTERN)
    assert {r.doc_id: r.n_tokens for r in made.collect()} == {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in rows}


def test_op2(spark):
    turns = defaultdict(list)
    for r in table(spark, "conversations").orderBy("conv_id", "turn").collect():
        turns[r.conv_id].append((r.role or "", r.text or ""))
    turns[-7] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    made = {r.conv_id: r for r in QUERIES["op2_chat_format"](spark, SF).collect()}
    assert set(made) == set(turns)
    for key, own in turns.items():
        loss = "".join(t for role, t in own if role == "assistant")
        r = made[key]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(own), hexed("".join(f"{a}\n{t}\n" for a, t in own)), len(loss), hexed(loss))
        assert r.formatted_chars > sum(len(t) for _, t in own)


def test_op3(spark):
    rows = table(spark, "embeddings").select("vec_id", "embedding").collect()
    good = [(r.vec_id, np.array(r.embedding, dtype=float)) for r in rows if r.embedding and all(x is not None and np.isfinite(x) for x in r.embedding) and any(r.embedding)]
    ids, x = np.array([i for i, _ in good]), np.stack([v for _, v in good])
    found = defaultdict(list)
    made = QUERIES["op3_nearest_neighbours"](spark, SF).orderBy("query_id", "rank").collect()
    for r in made:
        found[r.query_id].append((r.vec_id, r.score))
    asked = [i for i in ids.tolist() if i % 100 == 0]
    hits = 0
    for q in asked:
        away = np.sqrt(((x - x[ids == q][0]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((ids, away)) if ids[i] != q][:10]
        hits += len({int(ids[i]) for i in order} & {i for i, _ in found[q]})
        assert len(found[q]) == 10 and all(s == away[ids == i][0] for i, s in found[q])
    assert set(found) == set(asked) and hits >= 9 * len(asked) and all(r.recall >= 0.9 for r in made)


def test_op5(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, "documents").select("doc_id", "text").collect()]
    made = Counter((r.doc_id, r.n_shingles, r.component_id) for r in QUERIES["op5_ngram_jaccard"](spark, SF).collect())
    assert made == components(rows, 3, 90)


def test_op9(spark):
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for r in table(spark, "documents").select("doc_id", "text").collect():
        ids = library.encode_ordinary(r.text or "")
        want[r.doc_id, len(ids), hexed(" ".join(map(str, ids))), hexed(r.text or "")] += 1
    assert Counter(map(tuple, QUERIES["op9_byte_bpe"](spark, SF).collect())) == want
