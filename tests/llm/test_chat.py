"""Chat formatting against SQL, and logs with drafts, edits and repeats."""
import hashlib

import duckdb
import pytest

from costledger.llm.chat import (OP8_SQL, CLOSE, conversation_digests, escaped, event_log, fold, format_chats,
                                 read_chats, rendered, unescaped)
from costledger.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
EVENT = "conv_id long, turn long, copy int, seq int, kind string, role string, text string"


def test_query_matches_sql(spark):
    duckdb.sql(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    want = sorted(duckdb.sql(OP8_SQL).fetchall())
    got = sorted(tuple(r) for r in QUERIES["op8_chat"](spark, SF).collect())
    assert got == want
    own = [r for r in got if r[0] == -7][0]
    ok = "</s>[INST] ok [/INST]"
    assert own[1] == 2 and own[3] == len(ok) and own[4] == hashlib.sha256(ok.encode()).hexdigest()


def test_fold_of_a_log(spark):
    rows = [(1, 0, 1, 0, "open", "user", None), (1, 0, 1, 1, "delta", None, "Hel"), (1, 0, 1, 2, "delta", None, "lo"),
            (1, 1, 1, 0, "open", "assistant", None), (1, 1, 1, 1, "delta", None, "bad"),
            (1, 1, 1, 2, "regenerate", None, None), (1, 1, 1, 3, "delta", None, "goo"), (1, 1, 1, 3, "delta", None, "goo"),
            (1, 1, 1, 4, "delta", None, "d"), (1, 0, 1, 3, "edit", None, "Hi"), (1, 0, 1, 4, "delta", None, "!"),
            (1, 0, 1, 5, "seen", None, "?"), (None, None, 1, 0, "delta", None, None), (2, 0, 1, 0, "open", None, "x")]
    df = spark.createDataFrame(rows, EVENT).repartition(4)
    got = sorted(((r.conv_id or 0, r.turn or 0, r.role, r.text) for r in fold(df).collect()))
    assert got == [(0, 0, "", ""), (1, 0, "user", "Hi!"), (1, 1, "assistant", "good"), (2, 0, "", "")]
    assert fold(df.limit(0)).count() == 0


@pytest.mark.parametrize("text", ["<|end|>\n", "<|user|>\n", "|\\<\\", "\\|\\\\<|", "<\\|>", "", "a<|end|><|end|>\n|>\n"])
def test_escape_is_exact_and_hides_markers(spark, text):
    from pyspark.sql import functions as F
    r = spark.createDataFrame([(text,)], "t string").select(
        escaped(F.col("t")).alias("e"), unescaped(escaped(F.col("t"))).alias("u")).first()
    assert r.u == text and "<|" not in r.e and CLOSE not in r.e and "|>" not in r.e


def test_round_trip_edges(spark, scratch):
    """Control strings, nulls, repeated rows and turns, a very long text."""
    long = "<|end|>\n é|" * 20000
    rows = [(1, 0, "user", "<|assistant|>\nno", "x"), (1, 1, "assistant", long, "x"), (1, 1, "assistant", "b", "x"),
            (1, 1, "assistant", "b", "x"), (2, 0, None, None, "x"), (None, 0, "a|b<", "t", "x"), (2, None, "assistant", None, "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, copy string").drop("copy")
    format_chats(event_log(turns), f"{scratch}/c")
    got = read_chats(spark, f"{scratch}/c")
    want = sorted((c or 0, t or 0, r or "", x or "") for c, t, r, x, _ in rows)
    assert sorted((r.conv_id or 0, r.turn or 0, r.role, r.text) for r in got.collect()) == want
    sums = {r.conv_id: r for r in conversation_digests(got).collect()}
    assert sums[1].n_turns == 4 and sums[1].loss_chars == len(long) + 2
    text = "".join(f"{r}\n{x}\n" for c, t, r, x in want if c == 1)
    assert sums[1].turns_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert sums[2].loss_chars == 0 and sums[None].n_turns == 1
    assert rendered(fold(event_log(turns.limit(0)))).count() == 0


def test_a_turn_repeated_without_end_is_spread(spark, scratch):
    """No step before the digest brings the rows of one turn together."""
    same = [(None, None, "user", "same")] * 400 + [(1, 0, "assistant", f"m{k}") for k in range(400)]
    df = spark.createDataFrame(same, "conv_id long, turn long, role string, text string").repartition(4)
    df.write.parquet(f"{scratch}/t")
    log = event_log(spark.read.parquet(f"{scratch}/t"))
    assert "Window" not in log._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        from pyspark.sql import functions as F
        spread = [r["count"] for r in fold(log).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(spread) == 800 and len(spread) == 4 and max(spread) < 300
    format_chats(log, f"{scratch}/c")
    sums = {r.conv_id: r for r in conversation_digests(read_chats(spark, f"{scratch}/c")).collect()}
    assert sums[None].n_turns == 400
    text = "".join(f"assistant\n{t}\n" for t in sorted(f"m{k}" for k in range(400)))
    assert sums[1].turns_sha256 == hashlib.sha256(text.encode()).hexdigest()
