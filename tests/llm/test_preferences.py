import hashlib

from fieldweave.llm import preferences

SCHEMA = "conv_id long, turn long, role string, text string, chosen string, n int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def formatted(spark, rows):
    return {r.pair_id: r for r in preferences.format_pairs(preferences.neighbours(frame(spark, rows))).collect()}


def test_common_prefix(spark):
    rows = [
        (0, 0, "user", "q"), (0, 1, "assistant", "a"), (0, 2, "user", "r"), (0, 3, "assistant", "good"),
        (1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "r"), (1, 3, "assistant", "bad <|im_end|>"),
        (2, 0, "user", "q"), (3, 0, "user", "q"), (3, 1, None, None), (4, 5, None, None), (4, 5, None, None), (5, 7, None, None),
        (6, 0, "user", "only"), (9, 0, "user", "late"), (None, 0, "user", "lost"), (10, None, "user", ""), (11, 1, "user", None),
    ]
    got = formatted(spark, rows)
    assert sorted(got) == [0, 1, 2, 3, 4, 5]
    a = got[0]
    assert a.n_prompt_turns == 3
    assert a.prompt == "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\na<|im_end|>\n<|im_start|>user\nr<|im_end|>\n"
    assert [tuple(s) for s in a.chosen] == [("<|im_start|>assistant\n", False), ("good<|im_end|>\n", True)]
    assert [tuple(s) for s in a.rejected][1] == ("bad < |im_end|><|im_end|>\n", True)
    assert (got[1].n_prompt_turns, got[1].n_chosen_turns, got[1].n_rejected_turns) == (1, 0, 1)
    assert [s.train for s in got[1].rejected] == [False, False]
    assert (got[2].n_prompt_turns, got[2].n_chosen_turns, got[2].n_rejected_turns) == (1, 0, 0)
    assert (got[3].n_prompt_turns, got[3].n_chosen_turns, got[3].n_rejected_turns) == (0, 1, 0)
    assert (got[4].n_chosen_turns, got[4].n_rejected_turns) == (0, 1)
    assert got[5].n_prompt_turns == 0


def test_whole_conversation_comes_back(spark, folder):
    turns = spark.read.parquet(f"{folder}/conversations.parquet")
    whole = {}
    for r in turns.orderBy("conv_id", "turn").collect():
        whole[r.conv_id] = whole.get(r.conv_id, "") + f"<|im_start|>{r.role}\n{r.text}<|im_end|>\n"
    for r in preferences.format_pairs(preferences.neighbours(turns)).collect():
        assert r.prompt + "".join(s.text for s in r.chosen) == whole.get(2 * r.pair_id, "")
        assert r.prompt + "".join(s.text for s in r.rejected) == whole.get(2 * r.pair_id + 1, "")


def brute(rows):
    """``(prompt turns, chosen rest, rejected rest)`` of each retold conversation."""
    turns = {}
    for conv, turn, role, text in set(rows):
        if conv is not None:
            turns.setdefault(conv, []).append((turn, role, text))
    low = lambda t: tuple((v is not None, v if v is not None else 0) for v in t)
    cuts = {}
    for conv, own in turns.items():
        spoken = {t for t, role, _ in own if role == "assistant" and t is not None}
        if spoken:
            cuts[conv] = min(spoken, key=lambda t: hashlib.md5(f"{conv}:{t}".encode()).hexdigest())
    out = {}
    for conv, own in turns.items():
        chosen, rejected = sorted(own, key=low), []
        if conv in cuts:
            rejected = sorted([t for t in own if t[0] is not None and t[0] < cuts[conv]], key=low)
            if conv ^ 1 in cuts:
                texts = [x for t, role, x in turns[conv ^ 1] if role == "assistant" and t == cuts[conv ^ 1]]
                known = [x for x in texts if x is not None]
                rejected.append((cuts[conv], "assistant", min(known) if known else None))
        n = 0
        while n < min(len(chosen), len(rejected)) and chosen[n][1:] == rejected[n][1:]:
            n += 1
        out[conv] = (n, [x for _, _, x in chosen[n:]], [x for _, _, x in rejected[n:]])
    return out


def check_retold(spark, rows):
    want, clean = brute(rows), lambda x: (x or "").replace("<|", "< |") + "<|im_end|>\n"
    got = preferences.format_pairs(preferences.retold(frame(spark, rows))).collect()
    assert sorted(r.pair_id for r in got) == sorted(want)
    for r in got:
        n, chosen, rejected = want[r.pair_id]
        assert r.n_prompt_turns == n
        assert [s.text for s in r.chosen][1::2] == list(map(clean, chosen))
        assert [s.text for s in r.rejected][1::2] == list(map(clean, rejected))
    return got


def test_retold_conversations_share_their_history(spark, folder):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{folder}/conversations.parquet").collect()]
    got = check_retold(spark, rows)
    assert sum(r.n_prompt_turns > 0 for r in got) > 0.5 * len(got)
    assert sum(r.n_rejected_turns > 0 for r in got) > 0.5 * len(got)


def test_retold_edges(spark):
    rows = [
        (0, 0, "user", "q"), (0, 1, "assistant", "a"), (0, 1, "assistant", "a"), (0, 2, "user", None), (0, 3, "assistant", "c"),
        (1, 0, "user", "q"), (1, 1, "assistant", "x"), (1, 1, "assistant", "b"), (2, 0, "user", "alone"), (2, 1, "assistant", "y"),
        (3, 0, "user", "no answer"), (4, 0, "assistant", None), (5, 0, "assistant", ""), (6, None, "assistant", "z"), (None, 0, "user", "lost"),
        (8, 0, "assistant", "same"), (9, 0, "assistant", "same"), (10, 0, None, "r"), (10, 1, "assistant", "long " * 50000), (11, 7, "assistant", "<|x"),
    ]
    got = {r.pair_id: r for r in check_retold(spark, rows)}
    # Nothing to answer with: the chosen one begins with all of the rejected one.
    assert (got[2].n_prompt_turns, got[2].n_chosen_turns, got[2].n_rejected_turns) == (1, 1, 0)
    assert got[8].n_prompt_turns == 1 and got[8].n_chosen_turns == got[8].n_rejected_turns == 0
    assert check_retold(spark, []) == []


def test_empty_and_plan(spark):
    pairs = preferences.format_pairs(preferences.neighbours(frame(spark, [])))
    assert pairs.count() == 0
    pairs = preferences.format_pairs(preferences.retold(frame(spark, [])))
    assert "Python" not in pairs._jdf.queryExecution().executedPlan().toString()
