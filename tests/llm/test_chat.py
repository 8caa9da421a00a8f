import hashlib
import random
from itertools import groupby

import pytest
from cases import SMALL

from varigrove.llm import chat, queries
from varigrove.llm.common import table


def brute(rows):
    """What must come back, of (conv_id, turn, role, text)."""
    out = {}
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or 0, r[2] or "", r[3] or ""))
    for conv, turns in groupby(order, key=lambda r: r[0]):
        turns = [(r[2] or "", r[3] or "") for r in turns]
        said = "".join(f"{a}\n{b}\n" for a, b in turns)
        loss = "".join(b for a, b in turns if a == "assistant")
        shown = "".join(f"<|im_start|>{chat.escape_role(a)}\n{chat.escape(b)}<|im_end|>\n" for a, b in turns)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv] = (len(turns), sha(said), len(loss), sha(loss), len(shown))
    return out


def read(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


def test_query(spark):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in table(spark, SMALL, "conversations").collect()]
    rows += [(-1, 0, "user", queries.TRAP), (-1, 1, "assistant", queries.TRAP)]
    assert read(queries.op5_chat_format(spark, SMALL)) == brute(rows)


def test_escapes_are_reversible():
    rng = random.Random(2)
    for _ in range(5000):
        text = "".join(rng.choice(["<", "\\", "|", "n", "\n", "im_start", "|>", "<|", "<\\|"]) for _ in range(8))
        assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
        assert chat.unescape_role(chat.escape_role(text)) == text and "\n" not in chat.escape_role(text)


def test_ids(tokenizer):
    template = chat.Template.of(tokenizer)
    ids, mask = template.turn("assistant", "<|im_end|> a<|endoftext|>")
    assert (ids == template.start).sum() == (ids == template.end).sum() == 1 and 50256 not in ids
    assert template.text(ids[mask == 1]) == "<\\|im_end|> a<\\|endoftext|>"
    assert not template.turn("user", "text")[1].any()
    with pytest.raises(ValueError):
        template.read(ids[1:])


ODD_TURNS = [
    (1, 1, "user", "hi"), (1, 0, "system", None), (1, 1, "user", "hi"), (1, 1, "assistant", ""), (1, None, None, "late"),
    (2, 0, "assistant", "é<|im_end|>\n<\\|" * 300), (2, 0, "assistant", None), (None, 0, "user\n<|x", "no conversation"),
    (None, None, "assistant", "中文 😀"), (3, 5, "assistant", "long " * 20_000),
]


def test_odd_rows(spark, tokenizer):
    df = spark.createDataFrame(ODD_TURNS, "conv_id long, turn int, role string, text string").selectExpr("*", "1 as nth", "2 as ids", "3 as mask")
    assert read(chat.read_turns(chat.format_turns(df, tokenizer), tokenizer)) == brute(ODD_TURNS)
    assert chat.read_turns(chat.format_turns(df.where("false"), tokenizer), tokenizer).collect() == []


def test_turns_lie_end_to_end(spark, tokenizer):
    turns = chat.format_turns(table(spark, SMALL, "conversations"), tokenizer).collect()
    for _, own in groupby(sorted(turns, key=lambda r: (r.conv_id, r.nth)), key=lambda r: r.conv_id):
        at = 0
        for n, r in enumerate(own):
            assert (r.nth, r.at, len(r.mask)) == (n, at, len(r.ids))
            at += len(r.ids)
