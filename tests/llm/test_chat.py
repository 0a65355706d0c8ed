import hashlib

from refillcast.llm.chat import conversation_digest, conversation_examples

SCHEMA = "conv_id long, turn long, role string, text string, n_examples string, stop string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


ROWS = [
    (1, 0, "system", "be <|end|> kind"),
    (1, 1, "user", "a\\<b [x\\] \\\\"),
    (1, 2, "assistant", "</s>[INST] ok [/INST]"),
    (1, 3, "user", None),
    (1, 4, "assistant", "é😀 <\\|sep|>"),
    (1, 5, "user", "bye"),
    (2, 0, "user", "alone"),
    (3, 0, "assistant", None),
    (4, 0, None, "who"),
    (4, None, "assistant", "first"),
    (5, 0, "assistant", "same"),
    (5, 0, "assistant", "same"),
    (None, 0, "user", "q"),
    (None, 1, "assistant", "r"),
]


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv] = (len(own), sha(turns), len(loss), sha(loss))
    return out


def test_round_trip(spark):
    got = conversation_digest(conversation_examples(frame(spark, ROWS))).collect()
    assert {r["conv_id"]: tuple(r)[1:5] for r in got} == expected(ROWS)


def test_examples_are_prefixes_with_one_trainable_reply(spark):
    got = conversation_examples(frame(spark, [r for r in ROWS if r[0] == 1])).orderBy("example").collect()
    assert [r["loss_chars"] > 0 for r in got] == [True, True, False]
    for short, long in zip(got, got[1:]):
        assert long["text"].startswith(short["text"])
    for r in got[:2]:
        after = r["text"][r["loss_start"] + r["loss_chars"] :]
        assert after == "<|end|>"
    assert got[0]["text"].count("<|start|>") == 3
    # No control string stands inside a text.
    inner = got[0]["text"][got[0]["loss_start"] :][: got[0]["loss_chars"]]
    assert "</s>" not in inner and "[INST]" not in inner


def test_empty_table(spark):
    assert conversation_digest(conversation_examples(frame(spark, []))).collect() == []


def test_long_conversation(spark):
    rows = [(9, t, "assistant" if t % 2 else "user", f"[{t}] " * 20) for t in range(300)]
    got = conversation_digest(conversation_examples(frame(spark, rows))).collect()
    assert {r["conv_id"]: tuple(r)[1:5] for r in got} == expected(rows)
