r"""Chat formatting with a grammar round trip.

A turn is written as ``<s>`` role ``[INST] `` body `` [/INST]</s>``, turns one
after another. A deterministic parser reads that text back. Each role and body
is first written verbatim; if the turn, parsed again, differs from its source,
the content is escaped and tried again until it is identical.

Escaping: in a control string whose first character is followed by k
backslashes (``<\\/s>``), one more backslash is put after that character;
parsing takes one away. A control string in content so never reads as one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import without
from tidemark.llm.words import lean

BEGIN, BODY, CLOSE, END = "<s>", "[INST] ", " [/INST]", "</s>"
_PLAIN = re.compile(r"(<)(\\*)(/?s>)|(\[)(\\*)(/?INST\])")
_ESCAPED = re.compile(r"(<\\*)\\(/?s>)|(\[\\*)\\(/?INST\])")
LOSS_ROLE = "assistant"


class GrammarError(ValueError):
    pass


def escape(content: str) -> str:
    """Put one more backslash into every control string of ``content``."""
    return _PLAIN.sub(lambda m: f"{m[1] or m[4]}{m[2] or m[5] or ''}\\{m[3] or m[6]}", content)


def unescape(content: str) -> str:
    """Take one backslash out of every escaped control string."""
    return _ESCAPED.sub(lambda m: f"{m[1] or m[3]}{m[2] or m[4]}", content)


def parse(rendered: str, strict: bool = True) -> Iterator[tuple[str, str, int, int]]:
    """Turns of a rendered text as (role, text, start and end of the body in it).

    The grammar is read from left to right without looking back: content ends
    at the first unescaped control string, which must be the one that is due.
    """
    at = 0
    while at < len(rendered):
        if not rendered.startswith(BEGIN, at):
            raise GrammarError(f"no {BEGIN} at {at}")
        at += len(BEGIN)
        cut = _control(rendered, at)
        if not rendered.startswith(BODY, cut):
            raise GrammarError(f"no {BODY} at {cut}")
        role, start = unescape(rendered[at:cut]), cut + len(BODY)
        cut = _control(rendered, start)
        if rendered[cut - 1 : cut] != " " or cut - 1 < start or not rendered.startswith(CLOSE + END, cut - 1):
            raise GrammarError(f"no {CLOSE}{END} at {cut}")
        yield role, unescape(rendered[start : cut - 1]), start, cut - 1
        at = cut - 1 + len(CLOSE + END)


_CONTROL = re.compile(r"</?s>|\[/?INST\]")


def _control(rendered: str, at: int) -> int:
    found = _CONTROL.search(rendered, at)
    return found.start() if found else len(rendered)


def render_turn(role: str, text: str) -> tuple[str, int]:
    """The turn as it is written, and how many times its content was escaped."""
    written_role, body, tries = role, text, 0
    while True:
        rendered = f"{BEGIN}{written_role}{BODY}{body}{CLOSE}{END}"
        try:
            if [(r, t) for r, t, _, _ in parse(rendered)] == [(role, text)]:
                return rendered, tries
        except GrammarError:
            pass
        if tries:
            raise GrammarError("escaped content doesn't read back")
        written_role, body, tries = escape(role), escape(text), tries + 1


def render_turns(turns: DataFrame, role: str = "role", text: str = "text", out: str = "rendered") -> DataFrame:
    """Add to each turn its rendered text and its escapes; a null role or text counts as empty.

    Other columns stay, but for those with the name of an output.
    """
    from pyspark.sql import types as T

    turns = without(turns, out, "escapes")
    schema = T.StructType([*turns.schema.fields, T.StructField(out, T.StringType()), T.StructField("escapes", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = lambda c: batch.column(batch.schema.get_field_index(c)).to_pylist()
            made = [render_turn(r or "", t or "") for r, t in zip(column(role), column(text), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.int32())], names=schema.names)

    return turns.mapInArrow(lean(run), schema)


def in_order(rendered: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """All turns of a conversation in one partition, one after another, sorted as its text has them.

    Nothing gathers a conversation in memory: whoever reads it streams it.
    Rows that tie on the turn follow by their rendered text.
    """
    return rendered.repartition(F.col(conv)).sortWithinPartitions(conv, turn, "rendered")


def conversations(rendered: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """One row for each conversation: its whole formatted text."""
    each = F.sort_array(F.collect_list(F.struct(F.col(turn), F.col("rendered"))))
    return rendered.groupBy(conv).agg(each.alias("each")).select(conv, F.array_join(F.col("each.rendered"), "").alias("formatted"))


def read_back(rendered: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Digests of the turns and of the loss mask, parsed from the formatted text alone.

    One row for each conversation (null is one too): n_turns; the SHA-256 of
    role, newline, text, newline of every turn; length and SHA-256 of the text
    under the loss mask (the assistant's bodies, unescaped); formatted_chars.
    """
    kind = rendered.schema[conv].dataType.simpleString()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, done = None, []

        def flush():
            columns = list(zip(*done, strict=True))
            kinds = [key_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        close = lambda s: (s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5])
        for batch in batches:
            key_type = batch.schema.field(0).type
            for key, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if state is None or key != state[0]:
                    if state is not None:
                        done.append(close(state))
                    state = [key, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text, _, _ in parse(piece):
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode())
                    if role == LOSS_ROLE:
                        state[3] += len(text)
                        state[4].update(text.encode())
                state[5] += len(piece)
            if len(done) >= 2000:
                yield flush()
                done = []
        if state is not None:
            done.append(close(state))
            yield flush()

    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return in_order(rendered, conv, turn).select(F.col(conv).alias("conv_id"), "rendered").mapInArrow(lean(run), schema)
