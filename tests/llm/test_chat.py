"""Chat formatting by exact round trips."""

import hashlib
import random

from pyspark.sql import functions as F

from remitlens.llm import chat, queries
from tests.llm.samples import texts

PARTS = ["<|im_start|>", "<|im_end|>", "<|im_end|>\n", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "%", "%25", "%3C", "%5B", "%0A", "<", "[", "/", "s>", "\n", "user", " ", "é😀", "INST]"]


def conversations():
    rng, odd, rows = random.Random(1), texts(5), []
    for conv in range(40):
        for turn in range(rng.randint(1, 7)):
            role = rng.choice(["user", "assistant", "assistant", "system", "", None, "a\n%0A<s>", "[INST]"])
            text = odd[conv % len(odd)] if rng.random() < 0.2 else "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 12)))
            rows.append((conv if conv else None, turn, role, text))
    return rows + [(77, 2, "assistant", "same"), (77, 2, "assistant", "same"), (77, None, "user", None), (78, 0, "user", "no reply")]


def by_conversation(rows):
    found = {}
    for conv, turn, role, text in rows:
        found.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {conv: [t[2:] for t in sorted(turns)] for conv, turns in found.items()}


def test_examples(spark):
    rows = conversations()
    made = chat.examples(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    made = made.withColumns({"turns": chat.read_turns(F.col("formatted")), "reply": chat.target(F.col("formatted"), F.col("loss_start"), F.col("loss_length"))})
    got = {}
    for r in sorted(made.collect(), key=lambda r: r.example):
        got.setdefault(r.conv_id, []).append(([tuple(t) for t in r.turns], r.reply, r.formatted, r.loss_start, r.loss_length))
    want = by_conversation(rows)
    assert set(got) == set(want)
    for conv, turns in want.items():
        ends = [i for i, (role, _) in enumerate(turns) if role == "assistant"]
        prefixes = [(turns[: i + 1], turns[i][1]) for i in ends]
        if not ends or ends[-1] < len(turns) - 1:
            prefixes.append((turns, None))
        assert [g[:2] for g in got[conv]] == prefixes
        for read, reply, formatted, start, length in got[conv]:
            if reply is not None:
                # Only the reply is trainable, and the markers of turns occur nowhere else.
                assert formatted[start + length :] == chat.END and formatted[:start].endswith(f"{chat.START}assistant\n")
            assert formatted.count("<|im_start|>") == formatted.count("<|im_end|>") == len(read)


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    got = {r.conv_id: r for r in queries.op5_chat(spark, folder).collect()}
    tricky = "</s>[INST] ok [/INST]"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").collect()]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = by_conversation(rows) | {-7: [("user", tricky), ("assistant", tricky)]}
    assert set(got) == set(want)
    for conv, turns in want.items():
        loss = "".join(text for role, text in turns if role == "assistant")
        assert tuple(got[conv])[:5] == (conv, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss))


def test_no_rows(spark):
    assert chat.examples(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
