import hashlib
import json
import random

from pyspark.sql import functions as F

from salesforge.llm import chat_format as C

SCHEMA = "conv_id long, turn long, role string, text string, raw string, layout int"


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_digests_of_mixed_conversations(spark):
    rng = random.Random(3)
    bits = ["</s>", "[INST]", "[/INST]", "<s>", "\\", "[ROLE=x]", "a", "é", "\n", "]", '"', "{", "日"]
    text = lambda: "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))
    rows = []
    for c in range(120):
        shape = rng.choice([["user", "assistant"], ["system", "user", "assistant"], ["assistant", "assistant"],
                            ["user", "assistant", "user", "assistant"], ["tool", "user"], ["ro\\le]", None, "human"]])
        rows += [(c, n, role, text() if rng.random() < 0.9 else None) for n, role in enumerate(shape)]
    rows += [(200, 0, "user", "tie b"), (200, 0, "user", "tie a"), (201, 0, "user", "x"), (201, 0, "user", "x"),
             (None, 0, "assistant", "no id"), (202, None, "user", "no turn"), (202, 1, "assistant", "y")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got = {r["conv_id"]: r for r in C.digests(df).collect()}
    by = {}
    for c, turn, role, t in rows:
        by.setdefault(c, []).append((-1 if turn is None else turn, role or "", t or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        assert got[c]["n_turns"] == len(turns)
        assert got[c]["turns_sha256"] == _sha("".join(f"{r}\n{t}\n" for _, r, t in turns))
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), _sha(loss))


def test_each_layout_has_its_mapping(spark):
    layouts = [
        ({"prompt": "p", "response": "r"}, [("user", "p"), ("assistant", "r")]),
        ({"output": "r", "instruction": None}, [("user", ""), ("assistant", "r")]),
        ({"system": "s", "instruction": "p", "output": "r"}, [("system", "s"), ("user", "p"), ("assistant", "r")]),
        ({"messages": [{"role": "tool", "content": "x"}, {"content": "y", "role": "user"}]}, [("tool", "x"), ("user", "y")]),
        ({"conversations": [{"from": "human", "value": "x"}, {"from": "gpt", "value": "y"}]},
         [("user", "x"), ("assistant", "y")]),
        ({"unknown": 1}, None), ({"messages": []}, None), ([1, 2], None),
    ]
    raws = [(i, json.dumps(x)) for i, (x, _) in enumerate(layouts)] + [(90, "no json {"), (91, None)]
    got = {r["conv_id"]: r["turns"] for r in C.canonical(spark.createDataFrame(raws, "conv_id long, raw string")).collect()}
    for i, (_, want) in enumerate(layouts):
        assert (got[i] and [tuple(t) for t in got[i]]) == want
    assert got[90] is None and got[91] is None


def test_fingerprint_ignores_order_and_length():
    a = {"messages": [{"role": "x", "content": "y"}]}
    b = {"messages": [{"content": "1", "role": "2"}] * 3}
    assert C.fingerprint(C.field_paths(a)) == C.fingerprint(C.field_paths(b)) != C.fingerprint(C.field_paths({"m": a}))


def test_loss_mask_covers_the_assistant_texts(spark):
    df = spark.createDataFrame([([("user", "a<b"), ("assistant", "c[d"), ("assistant", "")],)],
                               "turns array<struct<role:string,text:string>>")
    (row,) = df.select(C.formatted(F.col("turns")).alias("f")).withColumn("m", C.loss_mask_udf("f")).collect()
    assert [row["f"][m["start"]: m["end"]] for m in row["m"]] == ["c\\[d", ""]


def test_empty_table(spark):
    assert C.digests(spark.createDataFrame([], SCHEMA)).count() == 0


def test_odd_records_have_null_turns(spark):
    odd = ['{"messages":[{"role":"user"},{"content":"x"}]}', '{"messages":[{"role":{},"content":"x"}]}', "[" * 100_000,
           '{"messages":[{"role":[],"content":"x"}]}', '{"prompt":{},"response":"x"}', "null", "[]", "3", "", None,
           '{"messages":[{"role":"user","content":"x"},["role"]]}']
    fine = ['{"messages":[{"role":null,"content":"x"}]}', '{"prompt":null,"response":2.5}']
    rows = [(i, raw, "t", "l", 1) for i, raw in enumerate([*odd, *fine])]
    df = spark.createDataFrame(rows, "conv_id long, raw string, turns string, Layout string, read int")
    got = C.canonical(df).orderBy("conv_id").collect()
    assert all(r["turns"] is None and r["layout"] for r in got[: len(odd)])
    assert [[tuple(t) for t in r["turns"]] for r in got[len(odd):]] == [[("", "x")], [("user", ""), ("assistant", "2.5")]]
    assert got[0].asDict().keys() == {"conv_id", "raw", "read", "layout", "turns"}
