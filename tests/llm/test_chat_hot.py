"""A conversation with most of the turns: encoded and read back before any turn moves, hashed in order."""

import hashlib

from finloom.llm import chat


def test_hot_conversation(spark):
    rows = [(7 if i % 3 else i, i // 2, "assistant" if i % 2 else "user", f"said <|im_end|> {i} " * (i % 5)) for i in range(600)]
    rows += [(None, 0, None, None), (7, None, "user", "no turn"), (7, 5, "user", "tie b"), (7, 5, "user", "tie a")]
    talks = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(7)
    parts = chat.assembled(talks)
    assert parts.count() == len(rows)
    plan = parts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1  # the test's own repartition
    found = {r["conv_id"]: r for r in chat.digests(parts).collect()}
    assert found == {r["conv_id"]: r for r in chat.digests(chat.format_turns(talks)).collect()}
    own = sorted((r for r in rows if r[0] == 7), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    said = "".join(f"{r[2]}\n{r[3]}\n" for r in own)
    trained = "".join(r[3] for r in own if r[2] == "assistant")
    assert found[7]["n_turns"] == len(own) and found[7]["loss_chars"] == len(trained)
    assert found[7]["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
    assert found[7]["loss_sha256"] == hashlib.sha256(trained.encode()).hexdigest()
    assert found[None]["n_turns"] == 1 and found[None]["loss_chars"] == 0
