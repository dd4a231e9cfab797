"""Chat formatting by token-level assembly (operator 3)."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut
from .tokens import plain_bpe

# The template: a turn is TURN role TEXT text END. Each mark is one reserved id
# above the vocabulary, and its string in the formatted text.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
FIRST_RESERVED = 50_257
RESERVED = {TURN: FIRST_RESERVED, TEXT: FIRST_RESERVED + 1, END: FIRST_RESERVED + 2}
# Control strings of this and other templates. None holds its own first
# character twice, so occurrences never overlap.
CONTROLS = (
    TURN, TEXT, END, "<|endoftext|>", "<|startoftext|>", "<|im_start|>", "<|im_end|>", "<|system|>", "<|user|>",
    "<|assistant|>", "<s>", "</s>", "[INST]", "[/INST]",
)
_TAILS = "|".join(re.escape(c[1:]) for c in CONTROLS)
_ESCAPE = re.compile(rf"([<\[])(\\*)({_TAILS})")
_UNESCAPE = re.compile(rf"([<\[])\\(\\*)({_TAILS})")


def escape(text: str) -> str:
    """One backslash more after the first character of every control string."""
    return _ESCAPE.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2\3", text)


def assemble(turns: list[dict], trained: str) -> tuple[str, np.ndarray, np.ndarray]:
    """Formatted text, ids, and the loss mask of one conversation. Segments come
    encoded; where each starts is the prefix sum of their lengths, and the mask
    is the prefix sum of +1 and -1 at the ends of what is trained on: a trained
    turn's text and its end mark."""
    text, segments, loss = [], [], []
    for turn in turns:
        text += [TURN, turn["role"], TEXT, turn["text"], END]
        segments += [[RESERVED[TURN]], turn["role_ids"], [RESERVED[TEXT]], turn["text_ids"], [RESERVED[END]]]
        loss += [False, False, False, *[turn["role"] == trained] * 2]
    lengths = np.array([len(s) for s in segments], dtype=np.int64)
    ends = np.cumsum(lengths)
    ids = np.concatenate([np.asarray(s, dtype=np.int32) for s in segments]) if segments else np.zeros(0, np.int32)
    change = np.zeros(len(ids) + 1, dtype=np.int64)
    on = np.array(loss, dtype=bool)
    np.add.at(change, (ends - lengths)[on], 1)
    np.add.at(change, ends[on], -1)
    return "".join(text), ids, np.cumsum(change[:-1]).astype(np.int8)


def format_chats(conversations: DataFrame, trained: str = "assistant", tokenizer: str | None = None) -> DataFrame:
    """One row per conversation of ``conversations(conv_id, turn, role, text)``:
    ``conv_id, formatted, ids, loss_mask``.

    Rows are encoded where they are read, then gathered per conversation, ordered
    by turn, role, text; a conversation is one row, as long as its turns are.
    Control strings inside roles and texts are escaped before they are encoded, so
    only the template makes reserved ids. Null roles and texts count as empty, a
    null turn comes first, repeated rows are turns of their own, rows without
    conv_id are one conversation. Other columns are ignored; an empty table gives
    an empty result.
    """
    kinds = "conv_id long, turn long, role string, text string, role_ids array<int>, text_ids array<int>"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, _ = plain_bpe(tokenizer)
        for batch in batches:
            role = [escape(x or "") for x in batch.column("role").to_pylist()]
            text = [escape(x or "") for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("turn"), pa.array(role, pa.string()), pa.array(text, pa.string()),
                 *[pa.array([bpe(x) for x in c], pa.list_(pa.int32())) for c in (role, text)]],
                ["conv_id", "turn", "role", "text", "role_ids", "text_ids"],
            )

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        role = escape(trained)
        for batch in batches:
            rows = [assemble(turns.as_py(), role) for turns in batch.column("turns")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array([r[0] for r in rows], pa.string()),
                 pa.array([r[1] for r in rows], pa.list_(pa.int32())), pa.array([r[2] for r in rows], pa.list_(pa.int8()))],
                ["conv_id", "formatted", "ids", "loss_mask"],
            )

    encoded = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"),
    ).mapInArrow(encode, kinds)
    turns = encoded.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text", "role_ids", "text_ids"))).alias("turns")
    )
    return turns.mapInArrow(join, "conv_id long, formatted string, ids array<int>, loss_mask array<tinyint>")


def read_back(chats: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``conv_id, turns, loss_text`` from the ids and mask alone: turns are
    ``(role, text)``; ``loss_text`` is what the mask covers, marks left out."""
    kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, decode = plain_bpe(tokenizer)

        def plain(ids: np.ndarray) -> str:
            return unescape(decode(ids.tolist()).decode("utf-8"))

        for batch in batches:
            turns, losses = [], []
            for ids, mask in zip(batch.column("ids"), batch.column("loss_mask")):
                ids, mask = ids.values.to_numpy(), mask.values.to_numpy()
                marks = np.flatnonzero(ids >= FIRST_RESERVED)
                begin, middle, end = marks[0::3], marks[1::3], marks[2::3]
                turns.append([
                    {"role": plain(ids[b + 1 : m]), "text": plain(ids[m + 1 : e])} for b, m, e in zip(begin, middle, end)
                ])
                # A trained stretch ends with its mark, so each is unescaped alone.
                losses.append("".join(plain(ids[m + 1 : e][mask[m + 1 : e] == 1]) for m, e in zip(middle, end)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(turns, kind), pa.array(losses, pa.string())], ["conv_id", "turns", "loss_text"]
            )

    return chats.select("conv_id", "ids", "loss_mask").mapInArrow(
        run, "conv_id long, turns array<struct<role: string, text: string>>, loss_text string"
    )


PROBE = "</s>[INST] ok [/INST]"


def op3_chat_format(spark, sf_dir: str) -> DataFrame:
    probe = spark.createDataFrame(
        [(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string"
    )
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    chats = cut(format_chats(rows.unionByName(probe)), "chats")
    said = read_back(chats)
    lengths = chats.select("conv_id", F.char_length("formatted").cast("long").alias("formatted_chars"))
    text = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return said.join(lengths, said.conv_id.eqNullSafe(lengths.conv_id)).select(
        said.conv_id, F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(text, "UTF-8"), 256).alias("turns_sha256"), F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.encode(F.col("loss_text"), "UTF-8"), 256).alias("loss_sha256"), "formatted_chars",
    )


SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, length(role) + length(text) + 23
    + len(regexp_extract_all(role || chr(10) || text,
        '[<\[]\\*(\|turn\|>|\|text\|>|\|end\|>|\|endoftext\|>|\|startoftext\|>|\|im_start\|>|\|im_end\|>|\|system\|>|\|user\|>|\|assistant\|>|s>|/s>|INST\]|/INST\])')) AS chars
  FROM c
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
