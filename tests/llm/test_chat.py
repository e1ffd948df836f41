"""Chat formatting: folding of events, reversible escapes, loss mask, pieces."""

import hashlib
import random

import pytest

from tidemark.llm.chat_format import MESSAGE, escape, format_chats, log_of, read_back, render, unescape

LOG = "conv_id long, turn long, seq long, role string, kind string, text string"


def test_escapes_are_reversible_and_hide_control_strings():
    r = random.Random(1)
    for _ in range(3000):
        text = "".join(r.choice(["\\", "#", "###", "</turn>", "<", "/turn>", "a", "\n", ": ", "user"]) for _ in range(r.randint(0, 12)))
        shown = escape(text)
        assert unescape(shown) == text and "###" not in shown and "</turn>" not in shown
        rendered, start, end = render(text, text)
        m = MESSAGE.fullmatch(rendered)
        assert m and unescape(m[1]) == text and unescape(m[2]) == text and rendered[start:end] == shown


def test_events_fold_into_final_messages(spark):
    rows = [
        (1, 0, 0, "user", "message", "Hi"), (1, 1, 0, "assistant", "message", "He"), (1, 1, 1, "assistant", "delta", "llo"), (1, 1, 2, None, "edit", "Hello!"), (1, 1, 3, "assistant", "delta", " Bye"),
        (1, 2, 0, "user", "delta", "No"), (1, 2, 1, "user", "delta", " opening"), (1, 3, 0, "assistant", "message", "first"), (1, 3, 1, "assistant", "regenerate", "ignored"), (1, 3, 2, "assistant", "delta", "second"),
        (2, None, 0, None, "message", None), (None, 0, 0, "assistant", "message", "no conversation"),
    ]
    pieces = format_chats(spark.createDataFrame(rows, LOG)).collect()
    text = {p.conv_id: p.text for p in pieces}
    assert text[1] == "### user: Hi</turn>\n### assistant: Hello! Bye</turn>\n### user: No opening</turn>\n### assistant: second</turn>\n"
    assert text[2] == "### : </turn>\n" and text[None] == "### assistant: no conversation</turn>\n"
    learned = [p.text[m.start : m.end] for p in pieces if p.conv_id == 1 for m in p.mask]
    assert learned == ["Hello! Bye", "second"]


@pytest.mark.parametrize("piece_chars", [1_000_000, 50])
def test_digests_read_back(spark, piece_chars):
    r = random.Random(2)
    said = lambda: "".join(r.choice(["### Assistant: ", "</turn>", "\\", "#", "word ", "é", "\n"]) for _ in range(r.randint(0, 30)))
    rows = [(c, t, r.choice(["user", "assistant", "system", "a: b", None]), r.choice([said(), None, said() * 50])) for c in range(20) for t in range(r.randint(1, 12))] + [(99, t, "assistant", "x" * t) for t in range(500)]
    r.shuffle(rows)
    table = spark.createDataFrame([(*x, "s") for x in rows], "conv_id long, turn long, role string, text string, kind string")
    got = {x.conv_id: x for x in read_back(format_chats(log_of(table), piece_chars=piece_chars)).collect()}
    for c in {x[0] for x in rows}:
        turns = [(role or "", text or "") for _, _, role, text in sorted((x for x in rows if x[0] == c), key=lambda x: x[1])]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256) == (len(turns), hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest())
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[c].formatted_chars == sum(len(render(a, b)[0]) for a, b in turns)


def test_no_conversations(spark):
    assert read_back(format_chats(spark.createDataFrame([], LOG))).count() == 0
