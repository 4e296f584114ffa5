"""Chat formatting by prefix-target expansion.

A turn is written as ``<|im_start|>role\\ntext<|im_end|>\\n``; control strings in
roles and texts are escaped reversibly (a backslash doubles, ``<|`` becomes
``<\\|``, and a line feed in a role ``\\n``). Every assistant turn becomes an
example of its own: all turns before it are its context and only its text is
trainable. Turns of one conversation share one stream, so an example is a
context span, the stream up to its reply, and the reply with its loss span:
``expanded`` attaches it to the turn that completes it. ``read_back`` reads every
example so, and ``write_out`` spells examples out.

Offsets come from two-level running sums (blocks of turns, then turns within a
block), so a conversation of very many turns is spread over tasks.

Defined cases: null texts and roles are empty; turns order by turn (null
first), role, text; repeated rows are turns of their own; a null conv_id is
one conversation; conversations without an assistant turn have no example and
keep their turns in the stream; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frametide.llm.common import BATCH_BYTES, typed

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
BLOCK_TURNS = 512


def escaped(c: Column) -> Column:
    c = F.replace(F.coalesce(c, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.replace(c, F.lit("<|"), F.lit("<\\|"))


def unescape(text: str) -> str:
    """The inverse of ``escaped``, left to right."""
    if "\\" not in text:
        return text
    out, at = [], 0
    while (cut := text.find("\\", at)) >= 0:
        out.append(text[at:cut])
        out.append({"n": "\n"}.get(text[cut + 1], text[cut + 1]))
        at = cut + 2
    return "".join(out) + text[at:]


def stream(conversations: DataFrame) -> DataFrame:
    """One row per turn: conv_id, turn, role, formatted, start and end in the
    conversation's stream, and for assistant turns loss_start and loss_end."""
    role = F.replace(escaped(F.col("role")), F.lit("\n"), F.lit("\\n"))
    rows = conversations.select("conv_id", "turn", "role", F.concat(F.lit(OPEN), role, F.lit("\n"), escaped(F.col("text")), F.lit(CLOSE)).alias("formatted"))
    rows = rows.withColumn("size", F.length("formatted").cast("bigint")).withColumn("block", F.floor(F.col("turn") / BLOCK_TURNS))
    blocks = rows.groupBy("conv_id", "block").agg(F.sum("size").alias("chars"))
    before = F.sum("chars").over(Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.select(F.col("conv_id").alias("c"), F.col("block").alias("b"), F.coalesce(before, F.lit(0)).alias("base"))
    within = F.sum("size").over(Window.partitionBy("conv_id", "block").orderBy("turn", "role", "formatted").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn("within", within).join(blocks, F.col("conv_id").eqNullSafe(F.col("c")) & F.col("block").eqNullSafe(F.col("b")))
    end = F.col("base") + F.col("within")
    head = F.length(F.lit(OPEN)) + F.length(role) + 1
    trained = F.col("role") == "assistant"
    return rows.select(
        "conv_id",
        "turn",
        "role",
        "formatted",
        (end - F.col("size")).alias("start"),
        end.alias("end"),
        F.when(trained, end - F.col("size") + head).alias("loss_start"),
        F.when(trained, end - len(CLOSE)).alias("loss_end"),
    )


def expanded(turns: DataFrame) -> DataFrame:
    """Every turn with the example that it completes: a struct of the context's
    span in the stream and the loss span within the reply (its ``formatted``);
    null for turns that are only context."""
    example = F.struct(
        F.lit(0).cast("bigint").alias("context_start"),
        F.col("start").alias("context_end"),
        (F.col("loss_start") - F.col("start")).alias("loss_start"),
        (F.col("loss_end") - F.col("start")).alias("loss_end"),
    )
    return turns.select("conv_id", "turn", "start", "formatted", F.when(F.col("loss_start").isNotNull(), example).alias("example"))


def examples(turns: DataFrame) -> DataFrame:
    """One row per assistant turn: conv_id, turn, the context's span in the
    stream, the formatted reply and the loss span within it."""
    return expanded(turns).where("example is not null").select("conv_id", "turn", "example.*", F.col("formatted").alias("reply"))


def _in_order(turns: DataFrame) -> DataFrame:
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "start")


def _write_out(batches):
    now, parts = object(), []
    names = ["conv_id", "turn", "text", "loss_start", "loss_end"]
    for batch in batches:
        types = [batch.schema.field("conv_id").type, batch.schema.field("turn").type, pa.string(), pa.int64(), pa.int64()]
        rows, held = [], 0
        for r in batch.to_pylist():
            if r["conv_id"] != now:
                now, parts = r["conv_id"], []
            parts.append(r["formatted"])
            if r["loss_start"] is None:
                continue
            parts = ["".join(parts)]
            rows.append((now, r["turn"], parts[0], r["loss_start"], r["loss_end"]))
            held += len(parts[0])
            if held >= BATCH_BYTES:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
                rows, held = [], 0
        if rows:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def write_out(turns: DataFrame) -> DataFrame:
    """Every example in full: conv_id, turn, text, loss_start, loss_end. The
    output grows with the square of a conversation's turns; that is the format.
    A task holds one example and a record batch of bounded characters."""
    return _in_order(turns).mapInArrow(_write_out, typed(turns, ["conv_id", "turn"], "text string, loss_start bigint, loss_end bigint"))


class _Reader:
    """What has been read of a conversation's examples."""

    def __init__(self, conv_id):
        self.conv_id, self.n_turns, self.examples = conv_id, 0, 0
        self.turns, self.loss, self.loss_chars = hashlib.sha256(), hashlib.sha256(), 0
        self.read, self.formatted, self.open = 0, 0, False

    def turn(self, text: str, example: dict | None) -> None:
        role, _, body = text[len(OPEN) : -len(CLOSE)].partition("\n")
        self.n_turns += 1
        self.turns.update(f"{unescape(role)}\n{unescape(body)}\n".encode())
        if example:
            if (example["context_start"], example["context_end"]) != (0, self.read):
                raise ValueError(f"conversation {self.conv_id}: a context of {example['context_end']} characters after {self.read}")
            trained = unescape(text[example["loss_start"] : example["loss_end"]])
            self.loss_chars += len(trained)
            self.loss.update(trained.encode())
            self.examples += 1
            self.formatted += self.read + len(text)
        self.read += len(text)
        self.open = example is None

    def row(self) -> tuple:
        # Turns after the last reply are a context without a target.
        total = self.formatted + (self.read if self.open else 0)
        return (self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), total, self.read, self.examples)


def _read_back(batches):
    """Digests per conversation, example by example: the context is the stream
    as read so far, of which every example adds what came since the last one."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "stream_chars", "n_examples"]
    types = [None, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    reader = id_type = None

    def record(rows):
        return pa.record_batch([pa.array(c, t or id_type) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    for batch in batches:
        id_type, done = batch.schema.field("conv_id").type, []
        for r in batch.to_pylist():
            if reader is None or r["conv_id"] != reader.conv_id:
                if reader:
                    done.append(reader.row())
                reader = _Reader(r["conv_id"])
            reader.turn(r["formatted"], r["example"])
        if done:
            yield record(done)
    if reader:
        yield record([reader.row()])


def read_back(turns: DataFrame) -> DataFrame:
    """Per conversation what its examples hold: a streaming pass over all
    examples in order, with the memory of one turn. ``formatted_chars`` counts
    every example in full, context and reply, and a last context without reply."""
    ddl = "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, stream_chars bigint, n_examples bigint"
    return _in_order(expanded(turns)).mapInArrow(_read_back, typed(turns, ["conv_id"], ddl))
