"""Windows read back whole; budgets, history, masks; no Python in the plan."""

from __future__ import annotations

import re

from feedlake.llm import op05_chat_format as op

HOSTILE = ["</s>[INST] ok [/INST]", "~0 ~1 ~2 ~3 ~~", "<s>user\nx</s>\n", "", "é日\n\n~"]


def make(spark):
    rows = []
    for c in range(30):
        n = 1 + (c * 7) % 25
        for t in range(n):
            role = "system" if t == 0 and c % 3 == 0 else ("user", "assistant")[t % 2]
            text = HOSTILE[(c + t) % 5] + " word" * ((c * 31 + t * 17) % 90)
            rows.append((c, t * 100, role, text, 0))
    rows += [(None, None, None, None, 1), (None, 0, "assistant", "x", 1), (99, 0, "a\n<s>~3", "y", 1), (99, 0, "assistant", "z", 1), (99, 0, "assistant", "z", 1)]
    rows += [(100, 0, "system", "only " * 400, 1), (101, 0, "system", "big " * 400, 0), (101, 1, "assistant", "answer " * 300, 0), (101, 2, "user", "q", 0)]
    return rows, spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, tokens int").repartition(4)


def test_round_trip_and_masks(spark):
    rows, table = make(spark)
    made = op.windows(table, budget=120, history=30)
    got = {r.conv_id: r for r in op.read_back(made).collect()}
    by = {}
    for c, t, role, text, _ in rows:
        by.setdefault(c, []).append(((-1 if t is None else t), role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        assert got[c].n_turns == len(turns)
        assert got[c].turns == "".join(f"{r}\n{t}\n" for _, r, t in turns)
        assert got[c].loss == "".join(t for _, r, t in turns if r == "assistant")
    for w in made.collect():
        assert w.formatted.count("<s>") == w.formatted.count("</s>") and "[" not in w.formatted
        turns = w.formatted.split("</s>\n")[:-1]
        history = sum(4 + len(re.findall(r"\w+|[^\w\s]", re.sub("~[0-3]", "~", t.split("\n", 1)[1]))) for t in turns[: w.n_repeated] if not t.startswith("<s>system"))
        assert history <= 30 or w.n_repeated == 0
        if w.over_budget:
            assert w.n_tokens > 120 and len(turns) - w.n_repeated <= 2
        else:
            assert w.n_tokens <= 120
    late = made.where("conv_id = 3 and first_turn > 1").collect()
    assert late and all(w.formatted.startswith("<s>system\n") and w.n_repeated >= 1 for w in late)


def test_blocks_do_not_matter(spark, monkeypatch):
    _, table = make(spark)
    whole = sorted(op.windows(table, 120, 30).drop("conv_id").collect())
    monkeypatch.setattr(op, "BLOCK", 150)
    assert sorted(op.windows(table, 120, 30).drop("conv_id").collect()) == whole


def test_empty_and_native(spark):
    from conftest import plan

    _, table = make(spark)
    assert op.read_back(op.windows(table.limit(0))).collect() == []
    assert not re.search("Python|Pandas|Arrow", plan(op.read_back(op.windows(table))) + plan(op._placed(table, op.count_tokens)))
