"""Conversations as prefix trees.

Conversations that begin with the same turns share the tokens of those turns: a block of output holds a forest in depth-first
order, every turn of it once, and says for each turn where its tokens stand, which positions they have in their conversation
and which intervals of the block they may attend to besides themselves (their ancestors). Tokens are code points here; a
tokenizer can be applied to the turns of a block without changing any of this.

Template: ``### role: text</turn>`` and a line feed. Inside roles and texts, ``\\``, ``#``, ``<`` and ``:`` (roles only) are
written as ``\\\\``, ``\\h``, ``\\l`` and ``\\c``, so no control string can occur in them and all of them can be read back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from haulage.llm.base import id_back, id_text, query, table
from haulage.session import stored

START, AFTER_ROLE, END = "### ", ": ", "</turn>\n"
#: Code points of output after which a block ends; a longer conversation still stays in one block.
BLOCK_CHARS = 1 << 18
TRAINED = "assistant"

BLOCK = ("text string, node_start array<long>, node_end array<long>, node_position array<long>, node_parent array<int>, loss_start array<long>, loss_end array<long>, "
         "attend_from array<array<long>>, attend_to array<array<long>>, conv_id array<string>, conv_leaf array<int>")


def escaped(text: str, role: bool = False) -> str:
    text = text.replace("\\", "\\\\").replace("#", "\\h").replace("<", "\\l")
    return text.replace(":", "\\c") if role else text


def unescaped(text: str) -> str:
    plain = {"\\": "\\", "h": "#", "l": "<", "c": ":"}
    return re.sub(r"\\(.)", lambda m: plain[m[1]], text) if "\\" in text else text


class Block:
    """A forest under construction; conversations come in depth-first order of their leaves."""

    def __init__(self):
        self.parts, self.size, self.last, self.path = [], 0, [], []
        self.start, self.end, self.position, self.parent, self.loss_start, self.loss_end = [], [], [], [], [], []
        self.attend_from, self.attend_to, self.conv_id, self.conv_leaf = [], [], [], []

    def add(self, conv_id, turns: list[tuple[str, str]]) -> None:
        shared = 0
        for mine, before in zip(turns, self.last):
            if mine != before:
                break
            shared += 1
        self.path = self.path[:shared]
        for role, text in turns[shared:]:
            head = f"{START}{escaped(role, True)}{AFTER_ROLE}"
            body = escaped(text)
            parent = self.path[-1] if self.path else -1
            if parent < 0:
                position, begins, ends = 0, [], []
            else:
                position = self.position[parent] + self.end[parent] - self.start[parent]
                begins, ends = list(self.attend_from[parent]), list(self.attend_to[parent])
                if ends and ends[-1] == self.start[parent]:
                    ends[-1] = self.end[parent]
                else:
                    begins.append(self.start[parent])
                    ends.append(self.end[parent])
            loss = self.size + len(head)
            self.parts += [head, body, END]
            self.path.append(len(self.start))
            self.start.append(self.size)
            self.size = loss + len(body) + len(END)
            self.end.append(self.size)
            self.position.append(position)
            self.parent.append(parent)
            self.loss_start.append(loss)
            self.loss_end.append(loss + len(body) if role == TRAINED else loss)
            self.attend_from.append(begins)
            self.attend_to.append(ends)
        self.last = turns
        self.conv_id.append(conv_id)
        self.conv_leaf.append(self.path[-1] if self.path else -1)

    def frame(self) -> pd.DataFrame:
        values = ["".join(self.parts), self.start, self.end, self.position, self.parent, self.loss_start, self.loss_end, self.attend_from, self.attend_to, self.conv_id, self.conv_leaf]
        return pd.DataFrame([values], columns=[c.split(" ")[0] for c in BLOCK.split(", ")])


def prefix_blocks(conversations: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Blocks of the prefix forest of ``(conv_id, turn, role, text)``.

    Turns are ordered by turn (null first), then role and text; null roles and texts are empty; repeated rows are turns of their own; rows without conv_id are one
    conversation. Conversations are put into the order of their turns by one range shuffle on hashes of the turns and the
    id, so a first turn, or a whole conversation, that a third of all rows share is spread over many tasks. A block is a
    run of that order: turns shared within it stand in it once, and a turn shared with the block before is written again.
    No rows: no blocks. Other columns are not looked at.
    """
    turns = F.array_sort(F.collect_list(F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))))
    grouped = conversations.groupBy("conv_id").agg(turns.alias("turns"))
    path = F.concat_ws("", F.transform("turns", lambda t: F.lpad(F.hex(F.xxhash64(t["role"], t["text"])), 16, "0")))
    ordered = (grouped.withColumn("path", path).repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
               .select(id_text("conv_id"), F.transform("turns", lambda t: t["role"]).alias("roles"), F.transform("turns", lambda t: t["text"]).alias("texts")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block = Block()
        for frame in batches:
            for conv_id, roles, texts in zip(frame["conv_id"], frame["roles"], frame["texts"]):
                block.add(conv_id, list(zip(roles, texts)))
                if block.size >= block_chars:
                    yield block.frame()
                    block = Block()
        if block.conv_id:
            yield block.frame()

    return ordered.mapInPandas(run, BLOCK)


def read_back(blocks: DataFrame) -> DataFrame:
    """Conversations of the blocks, each from its own turn and the intervals that this turn attends to."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for b in frame.itertuples(index=False):
                out = []
                for conv_id, leaf in zip(b.conv_id, b.conv_leaf):
                    spans = [] if leaf < 0 else [*zip(b.attend_from[leaf], b.attend_to[leaf]), (b.node_start[leaf], b.node_end[leaf])]
                    whole = "".join([b.text[s:e] for s, e in spans])
                    turns = [t[len(START):].split(AFTER_ROLE, 1) for t in whole.split(END)[:-1]]
                    every, nodes, k = "".join([f"{unescaped(r)}\n{unescaped(t)}\n" for r, t in turns]), [], leaf
                    while k >= 0:
                        nodes.append(k)
                        k = b.node_parent[k]
                    loss = "".join([unescaped(b.text[b.loss_start[k]:b.loss_end[k]]) for k in reversed(nodes)])
                    out.append((conv_id, len(turns), hashlib.sha256(every.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(whole)))
                yield pd.DataFrame(out, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return id_back(blocks.mapInPandas(run, "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"), "conv_id")


ODD = "\\### Assistant: </turn> ok"

_ESC = "replace(replace(replace({}, '\\', '\\\\'), '#', '\\h'), '<', '\\l')"
SQL = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '{ODD}' UNION ALL SELECT -7, 1, 'assistant', '{ODD}')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(length(replace({_ESC.format('role')}, ':', '\\c')) + length({_ESC.format('text')}) + {len(START + AFTER_ROLE + END)}) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id"""


@query("op3_chat", SQL)
def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", ODD), (-7, 1, TRAINED, ODD)], rows.schema)
    return read_back(stored(prefix_blocks(rows.unionByName(more)), "chat-blocks"))
