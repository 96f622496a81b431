"""Chat logs as they come, training sets that resume, budgets and two-sided histories."""

from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from turnmill import fixed
from turnmill.functions.chat import render_messages
from turnmill.operators import corpus, history, models
from turnmill.sources import readers, training

KINDS = [
    ("hi", "hi"), (5, ""), (2.5, ""), (True, ""), (None, ""), ([{"type": "text", "text": "a"}], ""), ({"text": "a"}, ""),
    ("", ""), ("5", "5"), ("null", "null"), ('{"a": 1}', '{"a": 1}'), ("é\n\"\\\t😀", "é\n\"\\\t😀"),
]


def write(path, rows):
    path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows) + "\n\n", encoding="utf-8")


def test_kinds_of_content(spark, tmp_path):
    calls = [{"name": "f", "arguments": {"b": 1, "a": "x"}}, {"function": {"name": "g", "arguments": '{"k":  2}'}}]
    messages = [{"role": "user", "content": c} for c, _ in KINDS]
    messages += [{"role": "assistant", "content": 7, "tool_calls": calls}, {"role": "assistant"}]
    write(tmp_path / "log.jsonl", [{"conversations": messages, "more": 1}])
    row = readers.read_chat_log(spark, str(tmp_path / "log.jsonl")).first()
    assert [m.content for m in row.conversations] == [w for _, w in KINDS] + ["", ""]
    assert [tuple(c) for c in row.conversations[-2].tool_calls] == [("f", '{"b":1,"a":"x"}'), ("g", '{"k":  2}')]
    one = spark.createDataFrame([row]).select(render_messages(F.col("conversations"))).first()[0]
    assert one.startswith("<|im_start|>user\nhi<|im_end|>\n<|im_start|>user\n<|im_end|>\n")


def test_keys_are_stable(spark, tmp_path):
    """Equal lines are numbered, also where they are heavy; files cut otherwise give the same keys."""
    lines = [json.dumps({"conversations": [{"role": "user", "content": f"q{i % 40}"}]}) for i in range(100)]
    lines += [lines[0]] * 60 + ["{broken", "{broken"]
    write(tmp_path / "one.jsonl", lines)
    (tmp_path / "two").mkdir()
    for n in range(3):
        write(tmp_path / "two" / f"{n}.jsonl", lines[::-1][n::3])
    once = readers.read_chat_log(spark, str(tmp_path / "one.jsonl")).collect()
    again = readers.read_chat_log(spark, str(tmp_path / "two"), share=0.05, min_rows=5, size=7).collect()
    assert len({r.conv_id for r in once}) == len(lines) and sorted(map(repr, once)) == sorted(map(repr, again))
    assert sum(r.conversations is None for r in once) == 2


def test_training_set_resumes(spark, tmp_path):
    chats = [{"conversations": [{"role": "user", "content": f"q{i}"}, {"role": "assistant", "content": "a" * i}]} for i in range(37)]
    write(tmp_path / "a.jsonl", [*chats, chats[0], "{broken", {"conversations": [{"role": "assistant", "content": " "}]}])
    write(tmp_path / "b.jsonl", chats[:3])
    sources, path = {"a": str(tmp_path / "a.jsonl"), "b": str(tmp_path / "b.jsonl")}, str(tmp_path / "set")
    assert len(training.write_training_set(spark, sources, path)) == 4
    rows = training.read_training_set(spark, path).collect()
    assert len({r.conv_id for r in rows}) == 42 and sum(r.split == "val" for r in rows) == 5
    assert sum(r.prompt is None for r in rows) == 1
    texts = {r.conv_id: r.text for r in rows}
    spans = training.read_training_set(spark, path, "spans").collect()
    assert len(spans) == 42
    assert all(set(texts[s.conv_id][s.start : s.end]) <= {"a", " "} for s in spans)
    before = sorted((p, p.stat().st_mtime_ns) for p in (tmp_path / "set").rglob("*"))
    assert training.write_training_set(spark, sources, path) == []
    assert sorted((p, p.stat().st_mtime_ns) for p in (tmp_path / "set").rglob("*")) == before
    (tmp_path / "set/spans/split=val/_SUCCESS").unlink()  # as a job that didn't end leaves it
    assert training.write_training_set(spark, sources, path) == ["spans/val"]
    assert sorted(map(tuple, training.read_training_set(spark, path, "spans").collect())) == sorted(map(tuple, spans))
    with pytest.raises(ValueError, match="made from"):
        training.write_training_set(spark, sources, path, seed=1)


@pytest.mark.parametrize("unit", ["words", "letters"])
def test_budgets_cut_the_text(spark, monkeypatch, unit):
    def letters():
        """A tokenizer that takes each visible character for a token."""

        def predict(text: np.ndarray) -> np.ndarray:
            return np.array([[x for i, c in enumerate(t) if not c.isspace() for x in (i, i + 1)] for t in text], dtype=object)

        return predict

    for name, n in (("SFT_BUDGET", 5), ("RL_PROMPT_BUDGET", 3), ("RL_COMPLETION_BUDGET", 1)):
        monkeypatch.setattr(fixed, name, n)
    texts = ["", " ", "a", " a  b ", "a\n\nb\tc  d　e f", "我认为答案是A😀", "  one two three four five six  ", "a b c d e", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    offsets = None if unit == "words" else models.token_offsets(letters)
    for r in corpus.apply_budgets(df, offsets=offsets).collect():
        text = r.text
        if text is None:
            assert r.sft_text is None
            continue
        if unit == "words":
            spans, at = [], 0
            for w in text.split():
                at = text.index(w, at)
                spans.append((at, at + len(w)))
                at += len(w)
        else:
            spans = [(i, i + 1) for i, c in enumerate(text) if not c.isspace()]
        n = len(spans)
        assert r.n_tokens == n and r.over_sft == (n > 5) and r.over_prompt == (n > 3)
        assert r.sft_text == (text if n <= 5 else text[: spans[4][1]])
        assert r.completion_text == (text if n <= 1 else text[: spans[0][1]])
        assert r.prompt_text == (text if n <= 3 else text[spans[n - 3][0] :])


DIALOGUE = [
    ("user", "hello", True), ("assistant", "hi", True), ("user", "again", True), ("assistant", "lost", False),
    ("user", "quiet", True), ("user", " ", True), ("assistant", "to a blank", True), ("user", "q", True),
    ("assistant", " clear ", True), ("user", "next", True), ("assistant", "ok", None), ("user", "CLEAR", True),
    ("assistant", "to a command", True), ("user", "new", True), ("assistant", "fine", True), ("user", "last", True),
]


@pytest.mark.parametrize("size", [None, 1, 3])
def test_dialogue(spark, size):
    rows = [("s" if n % 2 else None, i, role, text, ok) for n in range(2) for i, (role, text, ok) in enumerate(DIALOGUE)]
    log = spark.createDataFrame(rows, "session string, seq long, role string, text string, ok boolean").repartition(3)
    limits = {} if size is None else {"share": 0.1, "min_rows": 1, "size": size}
    got = history.dialogue(log, ["seq"], **limits).orderBy("session", "seq").collect()
    one = [(r.role, r.message, r.segment, r.position, r.start, r.end) for r in got[: len(got) // 2]]
    assert one == [
        ("user", "hello", 0, 1, 0, 6), ("assistant", "hi", 0, 2, 6, 9), ("user", "quiet", 0, 3, 9, 15), ("user", "q", 0, 4, 15, 17),
        ("assistant", "clear", 0, 5, 17, 23), ("user", "new", 1, 1, 0, 4), ("assistant", "fine", 1, 2, 4, 9), ("user", "last", 1, 3, 9, 14),
    ]
    assert len(got) == 2 * len(one)
