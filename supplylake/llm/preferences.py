"""Preference formatting of chosen and rejected conversations.

The turns that both begin with are rendered once as the prompt; what follows is
a completion of each, in token ids with labels that count only assistant turns.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, ordered_shards, saved, scan_tasks, split_points
from .token_files import Encoder

#: Label of tokens that do not count in training.
MASKED = -100
ASSISTANT = "assistant"
TURNS = "array<struct<turn: long, role: string, text: string>>"
#: Pairs rendered and encoded together.
TOGETHER = 256


def head(role: str) -> str:
    return f"<|{role}|>\n"


def tail() -> str:
    return "<|end|>\n"


def segments(turns: list[tuple[str, str]]) -> list[tuple[str, bool]]:
    """Rendered pieces of turns and whether they count: an assistant's text with its
    end mark does, heads and other turns don't."""
    out = []
    for role, text in turns:
        own = role == ASSISTANT
        out += [(head(role), False), (text + tail(), own)]
    return out


def common_turns(chosen: list, rejected: list) -> int:
    n = 0
    for a, b in zip(chosen, rejected):
        if a != b:
            break
        n += 1
    return n


def split_pair(chosen: list, rejected: list) -> tuple[list, list, list]:
    """Segments of the prompt and of both completions.  Where both go on with an
    assistant turn its head ends the prompt."""
    n = common_turns(chosen, rejected)
    prompt, a, b = segments(chosen[:n]), segments(chosen[n:]), segments(rejected[n:])
    if a and b and a[0] == b[0] == (head(ASSISTANT), False):
        prompt, a, b = [*prompt, a[0]], a[1:], b[1:]
    return prompt, a, b


def plain_turns(turns) -> list[tuple[str, str]]:
    return [(t["role"] or "", t["text"] or "") for t in turns or []]


PAIR_SCHEMA = ("pair_id long, prompt_turns int, prompt string, chosen string, rejected string, prompt_ids array<int>, "
               "chosen_ids array<int>, chosen_labels array<int>, rejected_ids array<int>, rejected_labels array<int>")


def _formatted(pairs: list[tuple[int | None, list, list]], encoder: Encoder) -> pa.RecordBatch:
    parts = [split_pair(a, b) for _, a, b in pairs]
    ids, cut = encoder.encode(pa.array([s for p in parts for side in p for s, _ in side], pa.string()))
    rows, k = [], 0
    for (name, chosen, rejected), sides in zip(pairs, parts):
        row = {"pair_id": None if name == NULL_ID else name, "prompt_turns": common_turns(chosen, rejected)}
        for side, label in zip(sides, ("prompt", "chosen", "rejected")):
            tokens, labels = [], []
            for _, counts in side:
                piece = ids[cut[k]:cut[k + 1]].tolist()
                tokens += piece
                labels += piece if counts else [MASKED] * len(piece)
                k += 1
            row |= {label: "".join(s for s, _ in side), f"{label}_ids": tokens, f"{label}_labels": labels}
        rows.append(row)
    numbers = pa.list_(pa.int32())
    kinds = [("pair_id", pa.int64()), ("prompt_turns", pa.int32()), ("prompt", pa.string()), ("chosen", pa.string()),
             ("rejected", pa.string()), ("prompt_ids", numbers), ("chosen_ids", numbers), ("chosen_labels", numbers),
             ("rejected_ids", numbers), ("rejected_labels", numbers)]
    return pa.RecordBatch.from_pylist(rows, pa.schema(kinds))


def format_preferences(pairs: DataFrame, tokenizer: str) -> DataFrame:
    """Per row of ``pairs`` (``pair_id``, ``chosen`` and ``rejected`` as arrays of turns with
    ``role`` and ``text``): the prompt, both completions as text and ids, and their labels.

    Turns are equal when role and text are; a null role or text is an empty one; a null
    or empty side has an empty completion; equal sides have two empty completions; an
    empty table gives no rows; other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                encoder = encoder or Encoder.of_worker(tokenizer)
                rows = batch.slice(at, TOGETHER).to_pylist()
                yield _formatted([(r["pair_id"], plain_turns(r["chosen"]), plain_turns(r["rejected"])) for r in rows], encoder)

    return pairs.select("pair_id", "chosen", "rejected").mapInArrow(run, PAIR_SCHEMA)


def conversations_of(turns: DataFrame) -> DataFrame:
    """``conv_id, turns``: a row for each conversation, its turns in order of ``turn``,
    then role and text; repeated turns stay."""
    turn = F.struct(F.col("turn").cast("long").alias("turn"), "role", "text")
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def sampled_pairs(turns: DataFrame) -> DataFrame:
    """A pair for each conversation with an assistant turn: ``chosen`` is the conversation
    up to its last assistant turn, ``rejected`` the same with that turn's text from the
    next conversation in order of ``conv_id`` that has one (after the last: the first).

    A null ``conv_id`` is one conversation, the first.  Ranges of ids are dealt to tasks
    once, and the conversation that starts a range is copied to the end of the one
    before.
    """
    last = F.expr("size(turns) - array_position(reverse(transform(turns, t -> coalesce(t.role, '') = 'assistant')), true) + 1")
    having = (conversations_of(turns).filter("exists(turns, t -> t.role = 'assistant')")
              .select(F.col("conv_id").alias("doc_id"), F.slice("turns", F.lit(1), last.cast("int")).alias("turns")))
    ids = turns.filter("role = 'assistant'").select(F.col("conv_id").alias("doc_id"))
    points = split_points(ids, "doc_id", scan_tasks(turns))
    rows = ordered_shards(having, points, ["doc_id", "turns"], ["ahead"], look_ahead=True)
    first = (ids.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc_id")).agg(F.min("doc_id")).first()[0])
    start = having.filter(F.coalesce("doc_id", F.lit(NULL_ID)) == F.lit(first)).first() if first is not None else None
    reply = start.turns[-1].text if start else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["pair_id", "chosen", "rejected"]
        last = None

        def rows_of(found):
            out = []
            for row, text in found:
                other = [*row["turns"][:-1], row["turns"][-1] | {"text": text}]
                out.append({"pair_id": None if row["doc_id"] == NULL_ID else row["doc_id"],
                            "chosen": row["turns"], "rejected": other})
            turn = pa.list_(pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())]))
            return pa.RecordBatch.from_pylist(out, pa.schema(list(zip(names, [pa.int64(), turn, turn]))))

        for batch in batches:
            found = []
            for row in batch.to_pylist():
                if last is not None and last["shard"] == row["shard"]:
                    found.append((last, row["turns"][-1]["text"]))
                    last = None
                if not row["ahead"]:
                    last = row
            yield rows_of(found)
        if last is not None:  # only the last shard has nothing ahead
            yield rows_of([(last, reply)])

    return rows.mapInArrow(run, f"pair_id long, chosen {TURNS}, rejected {TURNS}")


#: Turns of a conversation that one row holds, by their numbers.
WINDOW = 1024


def _bits(value, width: int):
    return F.pmod(F.xxhash64(value) if isinstance(value, str) else value, F.lit(1 << width))


def whole_pairs(turns: DataFrame, window: int = WINDOW) -> DataFrame:
    """A pair for each conversation: ``chosen`` is the whole conversation, ``rejected`` the
    next one in an order in which conversations with equal first, and then equal second,
    turns lie together (after the last: the first); so common beginnings of any length
    occur.  No conversation and no turn is left out.

    A conversation whose turn numbers reach ``window`` is paired in windows of so many
    numbers, a row each, so that a hot ``conv_id`` is many rows; a null ``conv_id`` is one
    conversation, a null turn number is in the first window.  Repeated turns stay; a single
    conversation is paired with itself; an empty table gives no pairs; columns besides
    ``conv_id, turn, role, text`` are not read.
    """
    turn = F.struct(F.col("turn").cast("long").alias("turn"), "role", "text")
    part = F.coalesce(F.floor(F.col("turn") / window), F.lit(0))
    convs = turns.groupBy("conv_id", part.alias("part")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    said = [F.xxhash64(F.get("turns", F.lit(k))["role"], F.get("turns", F.lit(k))["text"]) for k in (0, 1)]
    key = (_bits(said[0], 22) * (1 << 41) + _bits(said[1], 20) * (1 << 21) + _bits(F.xxhash64("conv_id", "part"), 21)).cast("long")
    convs = saved(convs.select(key.alias("doc_id"), "conv_id", "part", "turns"), "conversations")
    points = split_points(convs, "doc_id", scan_tasks(convs))
    order = ["conv_id", "part"]
    rows = ordered_shards(convs, points, ["doc_id", *order, "turns"], [F.asc_nulls_first(c) for c in order], look_ahead=True)
    start = convs.orderBy("doc_id", *[F.asc_nulls_first(c) for c in order]).limit(1).collect()
    turned = pa.list_(pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())]))
    schema = pa.schema([("pair_id", pa.int64()), ("chosen", turned), ("rejected", turned)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None

        def pair(row: dict, other: list) -> dict:
            return {"pair_id": row["conv_id"], "chosen": row["turns"], "rejected": other}

        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                found = []
                for row in batch.slice(at, TOGETHER).to_pylist():
                    if last is not None and last["shard"] == row["shard"]:
                        found.append(pair(last, row["turns"]))
                        last = None
                    if not row["ahead"]:
                        last = row
                yield pa.RecordBatch.from_pylist(found, schema)
        if last is not None:  # only the last shard has nothing ahead
            yield pa.RecordBatch.from_pylist([pair(last, [t.asDict() for t in start[0].turns])], schema)

    return rows.mapInArrow(run, f"pair_id long, chosen {TURNS}, rejected {TURNS}")
