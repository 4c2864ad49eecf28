import hashlib

import pytest

from shelfgap.llm import chat
from shelfgap.llm.queries import HOSTILE_TEXT, QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, window string, pos string, n string"


def conversations(spark, turns):
    return spark.createDataFrame([(*t, "x", "x", "x") for t in turns], SCHEMA).repartition(4)


def long_conversation(conv, turns, system=True):
    out = [(conv, 0, "system", "be kind and brief")] if system else []
    for k in range(len(out), turns):
        role = ("user", "assistant")[k % 2]
        out.append((conv, k, role, f"{role} {k} " + "word " * (k * 37 % 60 + (500 if k % 29 == 7 else 0))))
    return out


CASES = [
    *long_conversation(1, 120),
    *long_conversation(2, 61, system=False),
    (3, 0, "user", HOSTILE_TEXT),
    (3, 1, "assistant", HOSTILE_TEXT + "\\0 \\1 \\\\ <|"),
    (4, 0, "assistant", None),
    (4, 1, None, "no role"),
    (4, 1, "ro\nle<|im_start|>\\2", "odd role"),
    (5, None, "user", ""),
    (5, 0, "user", "|> starts oddly"),
    (5, 0, "user", "|> starts oddly"),
    (5, 7_000_000, "assistant", "far ahead<"),
    (None, 0, "user", "no conversation"),
    (None, 1, "assistant", "none <|im_end|>\n"),
]


def want(turns):
    out = {}
    for conv in {t[0] for t in turns}:
        own = [t for t in turns if t[0] == conv]
        own.sort(key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or ""))
        lines = "".join(f"{r or ''}\n{x or ''}\n" for _, _, r, x in own)
        loss = "".join(x or "" for _, _, r, x in own if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv] = (len(own), sha(lines), len(loss), sha(loss))
    return out


@pytest.mark.parametrize("budget, history", [(2048, 256), (300, 60), (64, 16)])
def test_digests_of_windows(spark, budget, history):
    windows = chat.format_windows(conversations(spark, CASES), budget, history).cache()
    got = {r.conv_id: tuple(r)[1:5] for r in chat.window_digests(windows).collect()}
    assert got == want(CASES)
    for w in chat.read_turns(windows).collect():
        assert len(w.turns) == w.formatted.count(chat.END)
        assert w.n_tokens <= budget or stands_alone(w)


def stands_alone(w):
    return len(w.turns) == w.n_context + 1 and [t.role for t in w.turns[: w.n_context]] in ([], ["system"])


def test_long_system_turns_and_long_turns_keep_the_budget(spark):
    roles, sizes, turns = ("user", "assistant"), {}, []
    for system in (3, 400, 890, 900, 1904, 5000):
        for turn in (5, 700, 1500, 2030, 2100):
            conv = len(sizes)
            sizes[conv] = system, turn
            turns.append((conv, 0, "system", "rule " * system))
            turns += [(conv, k, roles[k % 2], "word " * (turn if k % 3 == 0 else 60)) for k in range(1, 30)]
    found = chat.read_turns(chat.format_windows(conversations(spark, turns), 2048, 256)).collect()
    assert sum(len(w.turns) - w.n_context for w in found) == len(turns)
    for w in found:
        system, turn = sizes[w.conv_id]
        assert w.n_tokens <= 2048 or (stands_alone(w) and max(turn, system) + system + 8 > 2048)
        if system <= 890 or w.n_context:
            assert (w.turns[0].role == "system") == (system <= 890)


def test_a_run_of_letters_counts_by_its_length(spark):
    turns = [(1, 0, "user", "x" * 200_000), (1, 1, "assistant", "ok"), (1, 2, "user", " " * 100_000 + "!" * 100_000)]
    found = sorted(chat.format_windows(conversations(spark, turns)).collect(), key=lambda w: w.window)
    assert [w.n_tokens > 2048 for w in found] == [True, False, True]
    assert [w.n_context for w in found] == [0, 0, 0]


def test_windows_keep_the_system_turn_and_limited_history(spark):
    windows = chat.format_windows(conversations(spark, long_conversation(1, 120)), 300, 60)
    found = sorted(chat.read_turns(windows).collect(), key=lambda w: w.window)
    assert len(found) > 5 and found[0].n_context == 0
    before = []
    for w in found:
        context = [tuple(t) for t in w.turns[: w.n_context]]
        if before:
            assert context[0] == before[0] and context[0][0] == "system"
            assert context[1:] == before[len(before) - len(context) + 1 :]
        before += [tuple(t) for t in w.turns[w.n_context :]]
        masked = [chat_text for r, chat_text in map(tuple, w.turns[w.n_context :]) if r == "assistant"]
        assert [w.formatted[s.start : s.end] for s in w.loss] == masked


def test_empty_table(spark):
    empty = conversations(spark, CASES).limit(0)
    assert chat.window_digests(chat.format_windows(empty)).count() == 0


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    turns = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    turns += [(-1, 0, "user", HOSTILE_TEXT), (-1, 1, "assistant", HOSTILE_TEXT)]
    got = {r.conv_id: tuple(r)[1:5] for r in QUERIES["op5_chat_windows"](spark, sf_dir).collect()}
    assert got == want(turns)
