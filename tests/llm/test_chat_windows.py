from __future__ import annotations

import hashlib
import random
import urllib.parse
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from loanops.llm import chat_windows
from loanops.llm.chat_windows import Template
from loanops.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, key long, start long, block long, piece string"
CONTROLS = Template().controls


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, "p") for r in rows], SCHEMA)


def escaped(text):
    out = []
    for i, c in enumerate(text):
        out.append(c)
        # A backslash goes behind the first character and the backslashes that follow it, if the rest of a control string is next.
        k = i
        while k > 0 and text[k] == "\\":
            k -= 1
        if any(text[k] == s[0] and text.startswith(s[1:], i + 1) for s in CONTROLS):
            out.append("\\")
    return "".join(out)


def piece_of(role, text):
    name = "?" if role is None else urllib.parse.quote_plus(role)
    return f"<s>{name}\n{escaped(text or '')}</s>\n"


def by_hand(rows, budget=2048, history=256):
    """(conversation, start, n_context, n_turns, n_tokens, formatted, loss) by walking through each conversation."""
    grouped = defaultdict(list)
    for conv, turn, role, text in rows:
        grouped[conv].append((turn, role, text))
    out, span = [], chat_windows.BLOCK * budget
    for conv, own in grouped.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        line, at = [], 0
        for _, role, text in own:
            piece = piece_of(role, text)
            cost = -(-len(piece.encode()) // 4)
            line.append((at, cost, piece, role))
            at += cost
        system = line[0] if line[0][3] == "system" else None
        room = max(budget - history - (system[1] if system else 0), budget // 4)
        windows = []
        for t in line:
            if windows and t[0] // span == windows[-1][0][0] // span and t[0] + t[1] - windows[-1][0][0] <= room:
                windows[-1].append(t)
            else:
                windows.append([t])
        for w in windows:
            start = w[0][0]
            context = [t for t in line if t[0] < start and (t is system or t[0] >= start - history)]
            text, loss = "".join(t[2] for t in context), []
            for t in w:
                if t[3] == "assistant":
                    body = t[2].index("\n") + 1
                    loss.append((len(text) + body, len(t[2]) - body - 5))
                text += t[2]
            out.append((conv, start, len(context), len(w), sum(t[1] for t in context + w), text, tuple(loss)))
    return sorted(out, key=repr)


def got(frame):
    return sorted(((*r[:6], tuple(tuple(x) for x in r[6])) for r in map(tuple, frame.collect())), key=repr)


def some_rows(seed, conversations=12, turns=60, size=300):
    draw = random.Random(seed)
    bits = [*CONTROLS, "\\", "<", "[", "/s>", "é", "日本", "\n", "</s>\n", "<\\s>", " word ", " more words "]
    rows = []
    for conv in range(conversations):
        for turn in range(draw.randrange(1, turns)):
            role = "system" if turn == 0 and draw.random() < 0.6 else draw.choice(["user", "assistant", "assistant", "tool use", None, "système\n"])
            text = "".join(draw.choice(bits) for _ in range(draw.randrange(size))) if draw.random() < 0.9 else draw.choice([None, ""])
            rows.append((conv if conv else None, turn if turn else draw.choice([None, 0]), role, text))
    return rows


@pytest.mark.parametrize("budget,history", [(2048, 256), (300, 100), (64, 0), (100, 99)])
def test_against_a_walk(spark, budget, history):
    rows = some_rows(budget)
    assert got(chat_windows.chat_windows(table(spark, rows), budget=budget, history=history)) == by_hand(rows, budget, history)


def test_blocks_and_ranges_change_nothing(spark):
    """One conversation of many blocks, sorted into many ranges."""
    draw = random.Random(4)
    rows = [(5, i, "system" if i == 0 else ("user", "assistant")[i % 2], "x" * draw.randrange(40)) for i in range(6000)]
    rows += [(6, 0, "user", "y")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert got(chat_windows.chat_windows(table(spark, rows).repartition(5), budget=64, history=20)) == by_hand(rows, 64, 20)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_windows_keep_the_budget(spark):
    rows = [(c, i, ("user", "assistant")[i % 2], "word " * ((c * 7 + i * 13) % 90)) for c in range(9) for i in range(50)]
    for r in chat_windows.chat_windows(table(spark, rows), budget=256, history=64).collect():
        assert r["n_tokens"] <= 256 and r["n_turns"] > 0


def test_escaping_is_reversible(spark):
    template, draw = Template(), random.Random(2)
    bits = [*CONTROLS, "\\", "\\\\", "<", "[", "s>", "/s>", "<SYS>>", "INST]", "x"]
    texts = ["".join(draw.choice(bits) for _ in range(draw.randrange(12))) for _ in range(3000)]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select("t", template.escape(F.col("t")).alias("e"))
    for t, e, back in frame.select("t", "e", template.unescape(F.col("e"))).collect():
        assert back == t and not any(c in e for c in CONTROLS)


@pytest.mark.parametrize("controls", [("<s>", "</s>", "x"), ("<s>", "</s>", "a\\b"), ("ab", "bc", "<s>", "</s>"), ("[INST]",)])
def test_bad_templates(controls):
    with pytest.raises(ValueError):
        Template(controls=controls)


def test_long_turns_and_systems_stay_whole(spark):
    rows = [(1, 0, "system", "s" * 9000), (1, 1, "user", "u" * 90_000), (1, 2, "assistant", "a" * 100), (1, 3, "user", "b")]
    windows = chat_windows.chat_windows(table(spark, rows), budget=200, history=50)
    assert got(windows) == by_hand(rows, 200, 50)
    assert max(r["n_tokens"] for r in windows.collect()) > 200


def test_ties_and_repeated_rows_stay(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "assistant", "a"), (1, 0, "user", "b"), (None, None, None, None), (None, None, None, None)]
    windows = {r["conv_id"]: r for r in chat_windows.chat_windows(table(spark, rows)).collect()}
    assert windows[1]["formatted"] == "<s>assistant\na</s>\n" + "<s>user\nb</s>\n" * 2
    assert windows[None]["formatted"] == "<s>?\n</s>\n" * 2


def test_empty_table(spark):
    assert chat_windows.chat_windows(table(spark, [])).collect() == []


def test_query_reads_back(spark, tmp_path):
    rows = [r for r in some_rows(8, 9, 400) if r[1] is not None and r[0] is not None]
    table(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    rows += [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    chars = defaultdict(int)
    for r in by_hand(rows):
        chars[r[0]] += len(r[5])
    for r in QUERIES["op11_chat_windows"](spark, str(tmp_path)).collect():
        own = sorted((x for x in rows if x[0] == r["conv_id"]), key=lambda x: x[1])
        turns = "".join(f"{role or ''}\n{text or ''}\n" for _, _, role, text in own)
        loss = "".join(text or "" for _, _, role, text in own if role == "assistant")
        assert r["n_turns"] == len(own) and r["turns_sha256"] == hashlib.sha256(turns.encode()).hexdigest()
        assert r["loss_chars"] == len(loss) and r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert r["formatted_chars"] == chars.pop(r["conv_id"])
    assert not chars


def test_plan_has_no_python(spark):
    plan = QUERIES["op11_chat_windows"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
