from collections import defaultdict

import pytest

from lodewerk.llm import chatformat as c


@pytest.mark.parametrize("text", ["", "<|end|>", r"<\|end|> <\\|", "<|<|start|>|>", "|> <", "é\n\t  <|im_start|>ü"])
def test_escape_round_trip(text):
    assert c.unescape(c.escape(text)) == text
    assert "<|" not in c.escape(text)


def brute(turns):
    """Turn by turn."""
    base, t = c.control(c.TOKENIZER, 0), c.tokenizer(c.TOKENIZER)
    ids, mask = [base], [0]
    for _, role, text in turns:
        content = t.encode(c.escape(text or ""), add_special_tokens=False).ids
        on = int(role == "assistant")
        ids += [base + c.START, base + (c.FIRST_ROLE + c.ROLES.index(role) if role in c.ROLES else c.OTHER), *content, base + c.END]
        mask += [0, 0] + [on] * (len(content) + 1)
    return ids, mask


def test_whole_table_equals_brute_force_and_parses_back(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    want = defaultdict(list)
    for r in table.collect():
        want[r.conv_id].append((r.turn, r.role, r.text))
    got = c.format_chats(table).collect()
    assert len(got) == len(want)
    for r in got:
        turns = sorted(want[r.conv_id])
        assert (list(r.input_ids), list(r.loss_mask)) == brute(turns)
        assert c.parse(list(r.input_ids)) == [(role, text) for _, role, text in turns]


def test_cases(spark):
    rows = [(1, 1, "assistant", "a<|end|>b", 5), (1, 0, "user", None, 5), (1, 1, "assistant", "a<|end|>b", 5), (None, 0, "user", "x", 5), (2, None, None, "<|endoftext|>", 5), (2, 0, "wizard", "", 5), (3, 0, "user", "word " * 200_000, None)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, input_ids int")
    got = {r.conv_id: r for r in c.format_chats(table).collect()}
    assert set(got) == {1, 2, 3}
    assert c.parse(list(got[1].input_ids)) == [("user", ""), ("assistant", "a<|end|>b"), ("assistant", "a<|end|>b")]
    assert c.parse(list(got[2].input_ids)) == [(None, "<|endoftext|>"), (None, "")]
    assert 50256 not in got[2].input_ids and sum(got[2].loss_mask) == 0
    assert sum(got[1].loss_mask) == sum(1 for x in got[1].loss_mask if x) == 2 * (1 + len(c.tokenizer(c.TOKENIZER).encode(c.escape("a<|end|>b"), add_special_tokens=False).ids))
    assert c.format_chats(table.limit(0)).count() == 0


def test_pieces_are_whole_conversations():
    import pyarrow as pa

    turns = [[{"turn": 1, "role": "user", "text": "x" * n} for n in sizes] for sizes in ([5, 5], [100], [], [1] * 50, [3])]
    kind = pa.list_(pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())]))
    batch = pa.RecordBatch.from_arrays([pa.array(range(5)), pa.array(turns, kind)], ["conv_id", "x"])
    for part in (batch, batch.slice(1), batch.slice(1, 3)):
        for size in (1, 60, 1 << 20):
            got = list(c.pieces([part], size))
            assert [i for g in got for i in g.column(0).to_pylist()] == part.column(0).to_pylist()
            assert [x for g in got for x in g.column(1).to_pylist()] == part.column(1).to_pylist()
    assert len(list(c.pieces([batch], 60))) > 2
