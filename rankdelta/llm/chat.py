"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole, encoded once with character offsets, and its
sorted turn spans meet the token spans by binary search: the tokens inside an
assistant text carry the loss.  Turn markers are added to the tokenizer as
tokens of their own, so no token reaches over the edge of a text.  A text
cannot forge a marker: every ``<|`` in it gets a backslash (``<\\|``; one more
if there are some already), which reading back takes off again.

A conversation longer than ``TURNS`` turns or ``CHARS`` characters is rendered
in consecutive parts of whole turns, so that no part outgrows a task.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
TURNS = 64
CHARS = 1 << 20
LOSS_ROLE = "assistant"

_HIDE, _SHOW = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_PARSE = re.compile(re.escape(TURN) + "(.*?)" + re.escape(TEXT) + "(.*?)" + re.escape(END), re.S)


def escape(text: str) -> str:
    return _HIDE.sub(lambda m: f"<{m[1]}\\|", text)


def unescape(text: str) -> str:
    return _SHOW.sub(lambda m: f"<{m[1]}|", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text and the spans of the texts that carry the loss."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        role, text = escape(role), escape(text)
        start = at + len(TURN) + len(role) + len(TEXT)
        parts += [TURN, role, TEXT, text, END]
        if role == LOSS_ROLE and text:
            spans.append((start, start + len(text)))
        at = start + len(text) + len(END)
    return "".join(parts), spans


def mask(spans: list[tuple[int, int]], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """1 for each token inside a span; both lists are sorted."""
    out = np.zeros(len(starts), np.int8)
    if spans and len(starts):
        lo, hi = np.array(spans, np.int64).T
        first, last = np.searchsorted(ends, lo, side="right"), np.searchsorted(starts, hi, side="left")
        for a, b in zip(first, last, strict=True):
            out[a:b] = 1
    return out


def masked_spans(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Character spans under the mask, one per run of masked tokens."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags, [0]))))
    return [(int(starts[a]), int(ends[b - 1])) for a, b in zip(edge[::2], edge[1::2], strict=True)]


def turns_of(formatted: str) -> list[tuple[str, str]]:
    return [(unescape(r), unescape(t)) for r, t in _PARSE.findall(formatted)]


_loaded: dict[str, object] = {}


def tokenizer(path: str):
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import AddedToken, Tokenizer, processors
        t = Tokenizer.from_file(path)
        t.post_processor = processors.ByteLevel(trim_offsets=False)
        t.add_special_tokens([AddedToken(m, normalized=False, special=True) for m in (TURN, TEXT, END)])
        _loaded[path] = t
    return _loaded[path]


PARTS = pa.schema([
    ("conv_id", pa.int64()), ("block", pa.int64()), ("part", pa.int64()), ("n_turns", pa.int64()),
    ("formatted", pa.string()), ("token_ids", pa.list_(pa.int32())), ("loss_mask", pa.list_(pa.int8())),
    ("loss_spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])
PARTS_DDL = ("conv_id long, block long, part long, n_turns long, formatted string, token_ids array<int>, "
             "loss_mask array<byte>, loss_spans array<struct<start:int,end:int>>")


def _rows(batches, columns) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(b.column(c).to_pylist() for c in columns), strict=True)


def _format(path: str):
    def emit(held):
        t = tokenizer(path)
        rendered = [render(turns) for _, turns in held]
        rows = []
        for (key, turns), (text, spans), enc in zip(
                held, rendered, t.encode_batch([r[0] for r in rendered], add_special_tokens=False), strict=True):
            offsets = np.array(enc.offsets, np.int64).reshape(-1, 2)
            flags = mask(spans, offsets[:, 0], offsets[:, 1])
            under = masked_spans(flags, offsets[:, 0], offsets[:, 1])
            rows.append(dict(zip(("conv_id", "block", "part"), key, strict=True)) | {
                "n_turns": len(turns), "formatted": text, "token_ids": enc.ids, "loss_mask": flags,
                "loss_spans": [{"start": a, "end": b} for a, b in under]})
        return pa.RecordBatch.from_pylist(rows, schema=PARTS)

    def run(batches):
        held, size, key, turns, chars, part = [], 0, None, [], 0, 0
        for conv, block, role, text in _rows(batches, ("conv_id", "block", "role", "text")):
            new = key != (conv, block)
            if turns and (new or chars + len(text) > CHARS):
                held.append(((*key, part), turns))
                size += chars
                part, turns, chars = 0 if new else part + 1, [], 0
                if size >= CHARS:
                    yield emit(held)
                    held, size = [], 0
            elif new:
                part = 0
            key = (conv, block)
            turns.append((role, text))
            chars += len(text)
        if turns:
            held.append(((*key, part), turns))
        if held:
            yield emit(held)
    return run


def format_conversations(conversations: DataFrame, *, tokenizer_path: str = TOKENIZER) -> DataFrame:
    """Formatted parts: conv_id, block, part, n_turns, formatted, token_ids, loss_mask, loss_spans.

    Rows of a conversation are ordered by (turn, role, text), nulls first; null
    role and null text are empty strings; repeated rows are turns of their own;
    rows without conv_id form one conversation.  Empty assistant texts carry no
    token.  Only assistant texts are under the mask, without their markers.
    Other columns are not read; an empty table gives no rows.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.floor(F.col("turn") / TURNS).cast("long").alias("block"),
        F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "turn", "role", "text")
    return rows.mapInArrow(_format(tokenizer_path), PARTS_DDL)


DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                    ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
DIGEST_DDL = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digests(batches):
    key, state, out = None, None, []

    def end():
        n, turns, chars, loss, size = state
        out.append(dict(zip(DIGEST.names, (key[0], n, turns.hexdigest(), chars, loss.hexdigest(), size), strict=True)))

    for conv, text, spans in _rows(batches, ("conv_id", "formatted", "loss_spans")):
        if key != (conv,):
            if key:
                end()
            key, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            if len(out) >= 5000:
                yield pa.RecordBatch.from_pylist(out, schema=DIGEST)
                out = []
        for role, said in turns_of(text):
            state[0] += 1
            state[1].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
        for s in spans:
            under = unescape(text[s["start"]: s["end"]])
            state[2] += len(under)
            state[3].update(under.encode("utf-8", "surrogatepass"))
        state[4] += len(text)
    if key:
        end()
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=DIGEST)


def digests(parts: DataFrame) -> DataFrame:
    """Per conversation, read back from the formatted text and the mask.

    Parts of a conversation stream through one task in order, with two running
    hashes as the only state.
    """
    rows = parts.select("conv_id", "block", "part", "formatted", "loss_spans")
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "block", "part").mapInArrow(_digests, DIGEST_DDL)
