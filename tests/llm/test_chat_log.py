"""Chat logs: regenerations by brute force, roles of any characters, the log of the registered query."""

import random

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from usagetally.llm import chat


def brute_fold(events):
    """(conv, message) -> (role, text) of the messages that remain."""
    logs = {}
    for conv, message, seq, kind, text in events:
        logs.setdefault((conv, message), []).append((seq, kind, text or ""))
    out, opened, redone = {}, {}, {}
    for key, log in logs.items():
        log.sort()
        opened[key], role, said = log[0][0], "", ""
        for seq, kind, text in log:
            if kind == "open":
                role = role or text
            elif kind == "delta":
                said += text
            else:
                said = text if kind == "edit" else ""
                if kind == "regenerate":
                    redone[key] = seq
        out[key] = role, said
    return {k: v for k, v in out.items() if not any(c == k[0] and m < k[1] and r > opened[k] for (c, m), r in redone.items())}


def test_regenerations_by_brute_force(spark):
    """Long conversations, so that earlier messages lie in other blocks; a conversation without an id."""
    rng, events = random.Random(2), []
    for conv, size in ((1, 400), (2, 5), (3, 70), (None, 150)):
        seq = 0
        for message in range(size):
            for kind in ["open", *rng.choices(["delta", "edit", "delta"], k=rng.randrange(4))]:
                events.append((conv, message, seq, kind, rng.choice(["a", "b ", None, "user"])))
                seq += 1
            if rng.random() < 0.06:
                back = rng.randrange(max(0, message - 90), message + 1)
                events += [(conv, back, seq, "regenerate", None), (conv, back, seq + 1, "delta", "again")]
                seq += 2
    rng.shuffle(events)
    df = spark.createDataFrame(events, "conv_id long, message long, seq long, kind string, text string").repartition(3)
    got = {(r.conv_id, r.message): (r.role, r.text) for r in chat.fold(df).collect()}
    want = brute_fold(events)
    assert got == want and 50 < len(want) < 500
    assert chat.overtaken(df.where("kind <> 'regenerate'")).count() == 0


def test_roles_of_any_characters(spark):
    parts = ["\x00", "\\", "\n", "n", "\\n", "\x01", "<|", "<\\|", "a"]
    rng, roles = random.Random(3), ["\x00", "\\\x00n", "a\x00b", ""]
    roles += ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 9))) for _ in range(400)] + ["\\" * 5_000 + "n\n"]
    df = spark.createDataFrame([(r,) for r in roles], "role string")
    back = df.select("role", chat.escape_role(F.col("role")).alias("written")).select(
        "role", "written", chat.unescape_role(F.col("written")).alias("back")).collect()
    assert all(r.role == r.back and "\n" not in r.written and "<|" not in r.written for r in back)


def test_the_querys_log_holds_regenerations(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text")
    rows = rows.union(rows.limit(7))                              # shared turns
    events = chat.events_of(rows).cache()
    kinds = {r.kind: r["count"] for r in events.groupBy("kind").count().collect()}
    assert kinds["regenerate"] > 2 and events.where("message.role = 'user~'").count() == 0
    assert events.groupBy("conv_id").agg(F.max("seq").alias("m")).where("m > 8").count() > 0       # one sequence a conversation
    folded = chat.fold(events)
    assert folded.where("message.role like '%~'").count() == 0
    said = sorted((r.conv_id, r.turn, r.role or "", r.text or "") for r in rows.collect())
    assert sorted((r.conv_id, r.message.turn, r.role, r.text) for r in folded.collect()) == said
