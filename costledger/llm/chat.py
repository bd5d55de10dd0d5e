"""Chat formatting by event sourcing (operator 8).

A conversation is a log of events: ``open`` (role), ``delta`` (text is
appended), ``edit`` (text is replaced) and ``regenerate`` (text is dropped,
deltas follow).  Events are partitioned by conversation and message, so one
very long conversation is spread over tasks, sorted by sequence number and
folded, one message at a time, into final messages.  Each is rendered as

    <|role|>\\n text <|end|>\\n

where every ``<`` and ``|`` inside a role or text is followed by a backslash,
so no marker can occur in one and undoing it is exact.

Defined results: a null text or role is empty; an event with the sequence
number of the one before it in its message was delivered twice and counts
once; an event of another kind changes nothing; rows of one turn are messages
of their own, ordered by role and text; a null conversation or turn is a value
like any other and sorts first; an empty table gives no rows; other columns
are ignored."""
from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import identified, map_arrow, slices

OPEN, CLOSE, MIDDLE = "<|", "<|end|>\n", "|>\n"
#: Every marker has one of these, not followed by a backslash.
SPECIAL = ("<", "|")
KEYS = ["conv_id", "turn", "copy"]
ASSISTANT = "assistant"


def escaped(text: Column) -> Column:
    for c in SPECIAL:
        text = F.replace(text, F.lit(c), F.lit(c + "\\"))
    return text


def unescaped(text: Column) -> Column:
    for c in reversed(SPECIAL):
        text = F.replace(text, F.lit(c + "\\"), F.lit(c))
    return text


def event_log(turns: DataFrame) -> DataFrame:
    """The log that streaming ``turns`` (conv_id, turn, role, text) could
    have left: (conv_id, turn, copy, seq, kind, role, text).  ``copy`` is the
    row's place in the files, so rows of one turn are told apart without
    meeting in one task.  By the text's hash, a message comes as two deltas,
    as a draft that is regenerated, or as a draft that is edited."""
    rows = identified(turns.select("conv_id", "turn", "role", "text"), "copy").select(
        *KEYS, F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    cut = F.floor(F.length("text") / 2).cast("int")
    nothing = F.lit(None).cast("string")

    def event(kind, text=nothing):
        return F.struct(F.lit(kind).alias("kind"), text.alias("text"))

    first = F.col("text").substr(F.lit(1), cut)
    deltas = [event("delta", first), event("delta", F.col("text").substr(cut + 1, F.length("text")))]
    way = F.pmod(F.xxhash64("text"), F.lit(3))
    events = (F.when(way == 0, F.array(event("open"), *deltas))
              .when(way == 1, F.array(event("open"), event("delta", F.reverse(first)), event("regenerate"), *deltas))
              .otherwise(F.array(event("open"), event("delta", F.upper(first)), event("edit", F.col("text")))))
    return (rows.select(*KEYS, "role", F.posexplode(events).alias("seq", "e"))
            .select(*KEYS, "seq", "e.kind", F.when(F.col("seq") == 0, F.col("role")).alias("role"), "e.text"))


def fold(events: DataFrame) -> DataFrame:
    """(conv_id, turn, copy, role, text): the final messages of a log."""
    def run(batches):
        import pyarrow as pa

        key, role, parts, last, out = None, "", [], None, []

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)],
                                              [*KEYS, "role", "text"])

        started, kinds = False, None
        for b in slices(batches, "text"):
            kinds = kinds or [*(b.schema.field(c).type for c in KEYS), pa.string(), pa.string()]
            for *k, seq, kind, who, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if not started or k != key:
                    if started:
                        out.append((*key, role, "".join(parts)))
                    started, key, role, parts, last = True, k, "", [], None
                elif seq == last:
                    continue
                last = seq
                if kind == "open":
                    role = who or ""
                elif kind == "delta":
                    parts.append(text or "")
                elif kind == "edit":
                    parts = [text or ""]
                elif kind == "regenerate":
                    parts = []
            if out:
                yield batch(out)
                out = []
        if started:
            yield batch([*out, (*key, role, "".join(parts))])

    types = dict(events.dtypes)
    dealt = (events.select(*KEYS, "seq", "kind", "role", "text")
             .repartition(*KEYS).sortWithinPartitions(*KEYS, "seq"))
    return map_arrow(dealt, run, ", ".join(f"{k} {types[k]}" for k in KEYS) + ", role string, text string")


def rendered(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, copy, segment, loss_first, loss_end): a row per
    message; a conversation's text is its segments by turn, those of one turn
    by role and text.  The loss mask, in code points of the segment, covers an
    assistant's text."""
    head = F.concat(F.lit(OPEN), escaped(F.col("role")), F.lit(MIDDLE))
    body = escaped(F.col("text"))
    graded = F.col("role") == ASSISTANT
    return messages.select(
        *KEYS, F.concat(head, body, F.lit(CLOSE)).alias("segment"),
        F.when(graded, F.length(head)).alias("loss_first"),
        F.when(graded, F.length(head) + F.length(body)).alias("loss_end"))


def parsed(segments: DataFrame) -> DataFrame:
    """The messages of a rendered output, with the text under the mask."""
    whole = F.col("segment")
    end = F.instr(whole, MIDDLE)
    role = whole.substr(F.lit(len(OPEN) + 1), end - len(OPEN) - 1)
    text = whole.substr(end + len(MIDDLE), F.length(whole) - end - len(MIDDLE) - len(CLOSE) + 1)
    loss = whole.substr(F.col("loss_first") + 1, F.col("loss_end") - F.col("loss_first"))
    return segments.select(*KEYS, unescaped(role).alias("role"), unescaped(text).alias("text"),
                           unescaped(loss).alias("loss"), F.length(whole).alias("chars"))


def conversation_digests(messages: DataFrame) -> DataFrame:
    """A row per conversation.  A digest runs over its messages in order, as
    a stream: a task holds one batch, however long a conversation is."""
    types = dict(messages.dtypes)

    def run(batches):
        import hashlib

        import pyarrow as pa

        kinds = None
        started, key, out = False, None, []

        def row():
            return key, n, turns.hexdigest(), graded, loss.hexdigest(), chars

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)],
                                              ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for b in slices(batches, "text"):
            kinds = kinds or [b.schema.field("conv_id").type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            for conv, role, text, marked, size in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if not started or conv != key:
                    if started:
                        out.append(row())
                    started, key, n, graded, chars = True, conv, 0, 0, 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                turns.update(f"{role}\n{text}\n".encode())
                if marked is not None:
                    loss.update(marked.encode())
                    graded += len(marked)
                n, chars = n + 1, chars + size
            if out:
                yield batch(out)
                out = []
        if started:
            yield batch([*out, row()])

    dealt = (messages.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text", "copy")
             .select("conv_id", "role", "text", "loss", F.col("chars").cast("long")))
    return map_arrow(dealt, run, f"conv_id {types['conv_id']}, n_turns long, turns_sha256 string, loss_chars long, "
                     "loss_sha256 string, formatted_chars long")


def format_chats(events: DataFrame, path: str) -> None:
    rendered(fold(events)).write.parquet(path)


def read_chats(spark: SparkSession, path: str) -> DataFrame:
    return parsed(spark.read.parquet(path))


def op8_chat(spark, sf_dir: str) -> DataFrame:
    from .common import table
    told = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    ok = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-7, 0, "user", ok), (-7, 1, ASSISTANT, ok)], told.schema)
    path = f"{ensure_checkpoint_dir(spark)}/chats-{uuid.uuid4().hex}"
    format_chats(event_log(told).unionByName(event_log(added)), path)
    return conversation_digests(read_chats(spark, path))


OP8_SQL = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')) v(conv_id, turn, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
       CAST(sum(13 + length(replace(replace(role || text, '<', '<\'), '|', '|\'))) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""
