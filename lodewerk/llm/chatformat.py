"""Chat formatting on tokens.

Each turn becomes START, a reserved id for its role, the tokens of its content,
END; a conversation begins with BEGIN.  Contents are encoded apart from one
another and from the control ids, so no token spans a border and no content can
produce a control id.  The loss mask is a running sum of +1 where an
assistant's content begins and -1 behind its END.  Control strings in contents
are escaped (``<|`` becomes ``<\\|``, ``<\\|`` becomes ``<\\\\|`` and so on), so
that text made from the ids can be parsed again; ``parse`` undoes everything.

Turns stand in order of (turn, role, text), nulls first.  Results by case: rows
without a conversation id are left out; a null text is an empty content and a
role that isn't known has an id of its own, both untrained; repeated rows are
as many turns; an empty table gives no rows.  Other columns don't matter.

The tokenizer's file is a parameter; workers read it from the path given.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textarrays as ta

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
ROLES = ("system", "user", "assistant", "tool")
CONTROLS = ("<|begin|>", "<|start|>", "<|end|>", *(f"<|{r}|>" for r in ROLES), "<|other|>")
BEGIN, START, END, FIRST_ROLE = range(4)
OTHER = FIRST_ROLE + len(ROLES)
TRAINED = FIRST_ROLE + ROLES.index("assistant")
SEGMENTS = 2048
PIECE = 4 << 20
_OPEN, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<(\\*)\\\|")


def escape(text: str) -> str:
    return _OPEN.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


@cache
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the other cores belong to other tasks
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.encode_special_tokens = True  # the vocabulary's own control strings are text in a content
    return made


def control(path: str, which: int) -> int:
    """Control ids follow the vocabulary."""
    return tokenizer(path).get_vocab_size() + which


def assemble(contents: np.ndarray, sizes: np.ndarray, roles: np.ndarray, turns: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, mask, offsets of the conversations) from the contents' tokens one after another, tokens and role by turn, turns by conversation."""
    conversation = np.repeat(np.arange(len(turns)), turns)
    # a turn takes 3 ids more than its content, a conversation one more
    begin = np.cumsum(sizes + 3) - (sizes + 3) + conversation + 1
    total = int(sizes.sum()) + 3 * len(sizes) + len(turns)
    ids = np.zeros(total, np.int32)
    first = np.concatenate([[0], np.cumsum(turns)])
    offsets = np.concatenate([[0], np.cumsum(sizes + 3)])[first] + np.arange(len(turns) + 1)
    ids[offsets[:-1]] = base + BEGIN
    ids[begin], ids[begin + 1], ids[begin + 2 + sizes] = base + START, base + roles, base + END
    ids[ta.ranges(begin + 2, sizes)] = contents
    step = np.zeros(total + 1, np.int8)
    mine = roles == TRAINED
    np.add.at(step, begin[mine] + 2, 1)
    np.add.at(step, begin[mine] + 3 + sizes[mine], -1)
    return ids, np.cumsum(step[:-1], dtype=np.int8), offsets


def pieces(batches: Iterator[pa.RecordBatch], size: int = PIECE) -> Iterator[pa.RecordBatch]:
    """The batches in slices of whole conversations with about so many bytes of text, at least one conversation each."""
    for batch in batches:
        texts = batch.column(1).flatten().field("text")
        held = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 16)])
        offsets = batch.column(1).offsets.to_numpy()
        for lo, hi in ta.blocks(held[offsets - offsets[0]], size):
            yield batch.slice(lo, hi - lo)


def format_chats(turns: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """(conv_id, turns, input_ids, loss_mask) of every conversation. One shuffle, of the texts."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, base = tokenizer(path), control(path, 0)
        for batch in pieces(batches):
            lists = batch.column(1)
            flat = lists.flatten()
            counts = np.diff(lists.offsets.to_numpy())
            texts = [escape(t or "") for t in flat.field("text").to_pylist()]
            roles = np.array([FIRST_ROLE + ROLES.index(r) if r in ROLES else OTHER for r in flat.field("role").to_pylist()], np.int64)
            parts, sizes = [np.zeros(0, np.int32)], []
            for lo in range(0, len(texts), SEGMENTS):
                for e in encode.encode_batch(texts[lo : lo + SEGMENTS], add_special_tokens=False):
                    parts.append(np.array(e.ids, np.int32))
                    sizes.append(len(parts[-1]))
            ids, mask, offsets = assemble(np.concatenate(parts), np.array(sizes, np.int64), roles, counts, base)
            at = pa.array(offsets.astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), ta.ints(counts), pa.ListArray.from_arrays(at, pa.array(ids)), pa.ListArray.from_arrays(at, pa.array(mask))], ["conv_id", "turns", "input_ids", "loss_mask"])

    rows = turns.filter(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("bigint").alias("conv_id"), F.struct(F.col("turn").cast("bigint").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")).alias("x"))
    gathered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("x")).alias("x"))
    return gathered.mapInArrow(scan, "conv_id bigint, turns bigint, input_ids array<int>, loss_mask array<tinyint>")


def parse(ids: list[int], path: str = TOKENIZER) -> list[tuple[str | None, str]]:
    """The (role, content) turns of one conversation's ids; a role that wasn't known is None."""
    base, out, at = control(path, 0), [], 1
    if not ids or ids[0] != base + BEGIN:
        raise ValueError("no conversation")
    while at < len(ids):
        end = ids.index(base + END, at)
        role = ids[at + 1] - base - FIRST_ROLE
        out.append((ROLES[role] if role < len(ROLES) else None, unescape(tokenizer(path).decode(ids[at + 2 : end], skip_special_tokens=False))))
        at = end + 1
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
