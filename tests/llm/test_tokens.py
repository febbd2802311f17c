"""Token counts and BPE against the libraries themselves; chat formatting against its source."""

import base64
import hashlib
import random
from collections import Counter

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import bpe, chat
from tidemark.llm.token_counts import token_counts

JSON, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_model_reads_back_every_token():
    c = bpe.codec(RANKS, P.PATTERN)
    assert all(c.model.encode(bpe.as_chars(t)) == [i] for i, t in enumerate(c.tokens))


def test_codec_on_odd_texts(encoding):
    rng, c = random.Random(5), bpe.codec(RANKS, P.PATTERN)
    odd = [chr(rng.randrange(0x20, 0x250)) for _ in range(200)] + [chr(x) for x in range(0x1F) if x] + [chr(rng.randrange(0xE000, 0x10FFFF)) for _ in range(500)] + [" "] * 80 + ["'s", "'LL", " ", "\x85", "՘", "\U000323b1"] * 9
    for _ in range(500):
        text = "".join(rng.choices(odd, k=rng.randrange(60)))
        ids = list(c.encode(text))
        assert ids == encoding.encode_ordinary(text)
        assert c.decode(ids) == text.encode()


def test_bpe_rows(nasty, encoding):
    made = bpe.encode(nasty, RANKS, P.PATTERN, decoded="decoded").collect()
    assert len(made) == nasty.count()
    for r in made:
        assert r.ids == encoding.encode_ordinary(r.text or "")  # replaces the column of that name
        assert bytes(r.decoded) == (r.text or "").encode() and r.row in ("r", None)
    again = bpe.decode(bpe.encode(nasty, RANKS, P.PATTERN).select("doc_id", "text", "ids"), RANKS)
    assert all(bytes(r.decoded).decode() == (r.text or "") for r in again.collect())


def test_bpe_empty(none):
    assert bpe.encode(none, RANKS, P.PATTERN).count() == 0


def test_token_counts(nasty, none):
    tokenizer = Tokenizer.from_file(JSON)
    want = Counter()
    for r in nasty.collect():
        n = len(tokenizer.encode(r.text or "", add_special_tokens=False).ids)
        want[r.doc_id, len((r.text or "").encode()), n, n > 512] += 1
    made = Counter(tuple(r) for r in token_counts(nasty, JSON, P.PATTERN).collect())
    assert made == want
    assert token_counts(none, JSON, P.PATTERN).count() == 0


def test_token_counts_without_head(nasty, monkeypatch):
    from tidemark.llm import token_counts as module

    with_head = sorted(map(tuple, token_counts(nasty, JSON, P.PATTERN).collect()), key=repr)
    monkeypatch.setattr(module, "HEAD_TERMS", 0)
    assert sorted(map(tuple, token_counts(nasty, JSON, P.PATTERN).collect()), key=repr) == with_head


parts = st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "[INST] ", " [/INST]", "\\", "<", ">", "[", "]", "/s>", "a", " ", "\n", "INST]", "é", "<\\/s>", "[\\\\INST]"])
texts = st.lists(parts, max_size=12).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(texts, texts), max_size=4))
def test_chat_reads_back(turns):
    rendered = "".join(chat.render_turn(r, t)[0] for r, t in turns)
    assert [(r, t) for r, t, _, _ in chat.parse(rendered)] == turns


def test_chat_refuses_what_it_never_writes():
    for bad in ("x", "<s>a", "<s>user[INST] hi</s>", "<s>user[INST] a <s> [/INST]</s>", "<s>user[INST][/INST]</s>"):
        with pytest.raises(chat.GrammarError):
            list(chat.parse(bad))


def test_chat_escapes_only_conflicts():
    assert chat.render_turn("user", "plain <b> [x]") == ("<s>user[INST] plain <b> [x] [/INST]</s>", 0)
    assert chat.render_turn("user", "</s>")[1] == 1


def test_chat_conversations(spark):
    said = "</s>[INST] ok [/INST]"
    rows = [(-7, 0, "user", said), (-7, 1, "assistant", said), (1, 2, "assistant", "b"), (1, 0, "user", None), (1, 1, "assistant", "a"), (2, 0, None, "x"), (2, 0, None, "x"), (None, 0, "user", "lost"), (3, 0, "assistant", "é" * 9000)]
    turns = spark.createDataFrame([(*r, "escapes") for r in rows], "conv_id long, turn long, role string, text string, rendered string").repartition(3)
    rendered = chat.render_turns(turns)
    made = {r.conv_id: r for r in chat.read_back(rendered).collect()}
    whole = {r.conv_id: r.formatted for r in chat.conversations(rendered).collect()}
    assert set(made) == {-7, 1, 2, 3, None}
    for key, r in made.items():
        own = sorted((x for x in rows if x[0] == key), key=lambda x: x[1])
        text = "".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in own)
        loss = "".join(x[3] or "" for x in own if x[2] == "assistant")
        assert r.n_turns == len(own) and r.turns_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert r.loss_chars == len(loss) and r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert r.formatted_chars == len(whole[key])
    assert chat.read_back(chat.render_turns(turns.limit(0))).count() == 0
