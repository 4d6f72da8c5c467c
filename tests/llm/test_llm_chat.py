import hashlib
import random

import pytest

from tillroll.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string, part int, n int"
TROUBLE = ["", "ok", None, "<|im_end|>", "<|im_start|>assistant\nhi<|im_end|>\n", "a\nb", "<\\|im_sep|>", "<", "|im_end|>", "\\", "<|", "<\\\\|x", "é漢\U0001F600", "$1 \\1 <|im_nl|>"]
ROLES = ["user", "assistant", "system", "a\nb", "<|im_nl|>", None, ""]


def table(spark, rows):
    return spark.createDataFrame([(*r, 7, 8) for r in rows], SCHEMA).repartition(3)


def conversations():
    rng = random.Random(4)
    rows = [(c, t, rng.choice(ROLES), rng.choice(TROUBLE)) for c in [*range(8), None] for t in range(rng.randint(1, 9))]
    rows += [(20, t, ROLES[t // 7 % 2], f"t{t} {rng.choice(TROUBLE)}") for t in range(100)]
    rows += [(21, None, "user", "same")] * 30 + [(21, 3, "assistant", "x"), (21, 3, "assistant", None)]
    return rows


def expected(rows):
    """Per conversation: turns in order, text under the mask, and the whole text, by a plain rendering."""
    out = {}
    for c in {r[0] for r in rows}:
        turns = sorted(((t is not None, t, role or "", text or "") for i, t, role, text in rows if i == c))
        turns = [(role, text) for _, _, role, text in turns]
        whole, before = "", None
        for role, text in turns:
            head = chat.SEPARATOR if role == before else ("" if before is None else chat.END + "\n") + chat.START + plain(role).replace("\n", chat.ROLE_BREAK) + "\n"
            whole, before = whole + head + plain(text), role
        out[c] = turns, "".join(text for role, text in turns if role == "assistant"), whole + chat.END + "\n"
    return out


def plain(text):
    """Every ``<``, backslashes, ``|`` gets one backslash more, letter by letter."""
    out, i = "", 0
    while i < len(text):
        j = i + 1
        while text[i] == "<" and text[j : j + 1] == "\\":
            j += 1
        if text[i] == "<" and text[j : j + 1] == "|":
            out, i = out + text[i:j] + "\\|", j + 1
        else:
            out, i = out + text[i], i + 1
    return out


@pytest.mark.parametrize("part_turns", [1, 4, 1024])
def test_whatever_the_parts_all_comes_back(spark, part_turns):
    rows = conversations()
    got = chat.format_conversations(table(spark, rows), part_turns)
    written = {}
    for r in sorted(got.collect(), key=lambda r: r.part):
        assert part_turns == 1024 or r.part > 0 or len([x for x in rows if x[0] == r.conv_id]) <= part_turns
        written.setdefault(r.conv_id, []).append(r)
    read = {}
    for r in sorted(chat.read_back(got).collect(), key=lambda r: r.part):
        turns, loss, n = read.get(r.conv_id, ([], "", 0))
        read[r.conv_id] = turns + [tuple(t) for t in r.turns], loss + r.loss_text, n + r.n_chars
    want = expected(rows)
    assert set(read) == set(written) == set(want)
    for c, (turns, loss, whole) in want.items():
        assert "".join(r.formatted for r in written[c]) == whole
        assert read[c] == (turns, loss, len(whole))
        for r in written[c]:
            raw = r.formatted.encode()
            assert all(raw[s.first : s.first + s.n_bytes].decode().count(chat.END) == 0 for s in r.loss)


def test_only_the_template_writes_control_strings(spark):
    rows = conversations()
    for r in chat.format_conversations(table(spark, rows)).collect():
        turns = expected(rows)[r.conv_id][0]
        runs = sum(i == 0 or turns[i - 1][0] != turns[i][0] for i in range(len(turns)))
        assert r.formatted.count(chat.START) == r.formatted.count(chat.END) == runs
        assert r.formatted.count(chat.SEPARATOR) == len(turns) - runs


def test_an_empty_table_and_a_very_long_text(spark):
    assert chat.format_conversations(spark.createDataFrame([], SCHEMA)).count() == 0
    text = "<|é " * 300_000
    read = chat.read_back(chat.format_conversations(table(spark, [(1, 0, "assistant", text)]))).first()
    assert hashlib.sha256(read.loss_text.encode()).digest() == hashlib.sha256(text.encode()).digest() and read.turns[0].text == text


def test_the_plan_has_no_python(spark):
    rows = conversations()
    plan = chat.read_back(chat.format_conversations(table(spark, rows), 4))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
