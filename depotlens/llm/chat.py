"""Chat formatting: conversations rendered by a compiled template, with the spans to be learnt.

The template marks turns with control strings. Inside texts and roles every bracket, ``<`` and backslash is
followed by a backslash, which no control string has there, so none can be forged and the escape can be taken
back. ``read_back`` parses the formatted text again, by the template's control strings alone.

Turns are ordered by turn, then role, then text; a null text, role or turn number counts as empty, empty and
first, so a conversation is defined whatever it holds; rows without conv_id are one conversation without id.
Rows are sorted by conversation across partitions and streamed, one conversation in memory at a time; a
conversation is one text, so one task writes it. An empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotlens.llm.templates import compile_template

CHAT_TEMPLATE = (
    "{% for m in messages %}"
    "{% if m.role == 'user' %}{{ '<s>' ~ '[INST] ' }}{{ m.text | escape }}{{ ' [/INST]' }}"
    "{% elif m.role == 'assistant' %} {% generation %}{{ m.text | escape }}{% endgeneration %} </s>"
    "{% else %}<s>[ROLE {{ m.role | escape }}] {{ m.text | escape }} [/ROLE]{% endif %}{% endfor %}"
)
TURN = re.compile(
    r"<s>\[INST\] (?P<user>.*?) \[/INST\]|<s>\[ROLE (?P<role>.*?)\] (?P<other>.*?) \[/ROLE\]| (?P<assistant>.*?) </s>", re.S
)


def escape(text: str) -> str:
    return (text or "").replace("\\", "\\\\").replace("[", "[\\").replace("]", "]\\").replace("<", "<\\")


def unescape(text: str) -> str:
    return re.sub(r"([\\\[\]<])\\", r"\1", text)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        m = TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        if m["user"] is not None:
            turns.append(("user", unescape(m["user"])))
        elif m["assistant"] is not None:
            turns.append(("assistant", unescape(m["assistant"])))
        else:
            turns.append((unescape(m["role"]), unescape(m["other"])))
        at = m.end()
    return turns


def format_conversations(rows: DataFrame, template: str = CHAT_TEMPLATE) -> DataFrame:
    """(conv_id, formatted, loss_spans): spans are code point ranges of ``formatted`` that a model generates."""
    ordered = rows.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    ordered = ordered.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template, {"escape": escape})
        columns: tuple[list, list, list] = ([], [], [])

        def close(conv_id, messages) -> None:
            out = render({"messages": messages})
            columns[0].append(conv_id)
            columns[1].append("".join(out.pieces))
            columns[2].append([{"start": a, "end": b} for a, b in out.spans])

        def flush() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            batch = pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["conv_id", "formatted", "loss_spans"]
            )
            for c in columns:
                c.clear()
            return batch

        current, messages, size = None, [], 0
        for batch in batches:
            for conv_id, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if messages and conv_id != current:
                    close(current, messages)
                    messages = []
                    if size > 1 << 22:
                        yield flush()
                        size = 0
                current = conv_id
                messages.append({"role": role, "text": text})
                size += len(text)
        if messages:
            close(current, messages)
        if columns[0]:
            yield flush()

    return ordered.mapInArrow(run, "conv_id long, formatted string, loss_spans array<struct<start:long,end:long>>")


def digest(formatted: DataFrame) -> DataFrame:
    """Checks read back from the output: turns and learnt texts as digests, and lengths in code points."""
    schema = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256

        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for row in batch.to_pylist():
                text = row["formatted"]
                turns = read_back(text)
                whole = sha256("".join(f"{role}\n{said}\n" for role, said in turns).encode()).hexdigest()
                learnt = "".join(unescape(text[s["start"] : s["end"]]) for s in row["loss_spans"])
                values = (row["conv_id"], len(turns), whole, len(learnt), sha256(learnt.encode()).hexdigest(), len(text))
                for column, value in zip(out, values):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            names = [part.split()[0] for part in schema.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)

    return formatted.mapInArrow(run, schema)
