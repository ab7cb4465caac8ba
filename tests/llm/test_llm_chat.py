from itertools import product

import numpy as np
import pytest

from lapengine.llm import chat as C
from lapengine.llm.registry import QUERIES, table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return C.train(C.transcripts(table(spark, SF, "conversations")))


def best_path(model, seen):
    """Every state sequence, scored one by one."""
    def score(path):
        total = model.start[path[0]] + sum(model.move[a, b] for a, b in zip(path, path[1:], strict=False))
        return total + sum(e[k, x[f]] for k, x in zip(path, seen, strict=True) for f, e in enumerate(model.emit))
    return max(product(range(len(C.STATES)), repeat=len(seen)), key=score), score


TEXTS = ["User: hi there?\nAssistant: hello.\nmore of it", "### Human:\nwhat?\n\n### Assistant:\nthis.", "no marker\nat all", "<|system|>\nBe good.\n<|user|>\nhi",
         "Q: x\nA: y\nQ: z", "user : odd", "", "\n\n\n", "[Instructions]: a\nb"]


def test_viterbi_is_brute_force(model):
    for t in TEXTS:
        lines = t.split("\n")[:5]
        seen = C.observe(lines)
        got = tuple(model.viterbi(seen).tolist())
        want, score = best_path(model, seen)
        assert np.isclose(score(got), score(want)), t
        assert C.STATES[got[0]][1] and all(C.STATES[b][1] or C.STATES[a][0] == C.STATES[b][0] for a, b in zip(got, got[1:], strict=False))


def test_markers():
    assert [C.marker(x)[0] for x in ("User: a", "### Assistant:", "### Human", "<|system|>", "**Bot**: x", "[Instructions]: y", "a: b", "the user: x",
                                     "Userland: x", "", "assistant")] == \
        ["user", "assistant", "user", "system", "assistant", "system", "assistant", "none", "none", "none", "none"]


def test_rendering(spark, model):
    rows = [(t, "x", 1) for t in [None, *TEXTS, "é " * 30000 + "\nUser: x"]] * 2
    df = spark.createDataFrame(rows, "transcript string, states string, turns int")
    got = C.parse(df, model).collect()
    assert len(got) == len(rows)
    for r in got:
        lines = r.transcript.split("\n") if r.transcript else []
        assert len(r.parsed.states) == len(lines)
        assert r.parsed.rendered == "".join(f"<|im_start|>{t.role}\n{t.content}<|im_end|>\n" for t in r.parsed.turns)
        assert len(r.parsed.turns) == sum(C.STATES[k][1] for k in r.parsed.states)
    assert got[0].parsed.rendered == ""
    assert [(t.role, t.content) for t in got[1].parsed.turns][:1] == [("user", "hi there?")]
    assert [(t.role, t.content) for t in got[2].parsed.turns] == [("user", "what?"), ("assistant", "this.")]
    assert C.parse(df.limit(0), model).collect() == []


def test_transcripts_of_nulls_repeats_and_large_conversations(spark, model, monkeypatch):
    rows = [(1, 0, "user", "a\nb", 5), (1, 1, "assistant", None, 5), (1, 1, "assistant", None, 5), (2, 0, None, "free", 5), (2, 1, "tool", "x", 5),
            (None, 0, "user", "lost", 5), (None, 0, "user", "lost", 5), (3, None, "user", "lost too", 5), (4, 300, "user", "page 1", 5), (4, 2, "user", "page 0", 5)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part int")
    got = C.transcripts(df).collect()
    assert sum(r.n_turns for r in got) == len(rows)
    assert all(len(r.states) == len(r.transcript.split("\n")) for r in got)
    assert sorted((r.conv_id or 0, r.page if r.page is not None else -1) for r in got) == [(0, -1), (1, 0), (2, 0), (3, -1), (4, 0), (4, 1)]
    one = next(r for r in got if r.conv_id == 1)
    assert [C.STATES[k] for k in one.states if C.STATES[k][1]] == [("user", True), ("assistant", True), ("assistant", True)] and one.n_turns == 3
    assert C.transcripts(df.limit(0)).collect() == []
    monkeypatch.setattr(C, "PAGE_ROWS", 10)
    many = spark.createDataFrame([(7, i % 5, "user", f"t{i}", 0) for i in range(200)] + [(8, 0, "user", "same", 0)] * 95,
                                 "conv_id long, turn long, role string, text string, part int")
    got = C.transcripts(many).collect()
    assert sum(r.n_turns for r in got) == 295 and len([r for r in got if r.conv_id == 7]) > 10 and len([r for r in got if r.conv_id == 8]) > 3


def test_training_on_nothing(spark):
    empty = spark.createDataFrame([(None, None), ("", [])], "transcript string, states array<int>")
    assert len(C.train(empty).viterbi(C.observe(["a", "b"]))) == 2


def test_held_out_accuracy_of_the_query(spark):
    got = QUERIES["op9_chat_formatting"](spark, SF).collect()
    turns = table(spark, SF, "conversations").count()
    assert sum(r.n_turns for r in got) == turns
    held = [r for r in got if r.held_out]
    assert sum(r.n_right for r in held) > 0.8 * sum(r.n_lines for r in held) > 0
