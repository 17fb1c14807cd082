from supplylake.llm.preferences import MASKED, PAIR_SCHEMA, TURNS, format_preferences, sampled_pairs, split_pair, whole_pairs
from supplylake.llm.queries import tokenizer_path

from .test_token_files import plain


def T(*turns):
    return [(k, *t) for k, t in enumerate(turns)]


def brute(chosen, rejected):
    chosen, rejected = ([(r or "", t or "") for _, r, t in (x or [])] for x in (chosen, rejected))
    n = 0
    while n < min(len(chosen), len(rejected)) and chosen[n] == rejected[n]:
        n += 1
    prompt = "".join(f"<|{r}|>\n{t}<|end|>\n" for r, t in chosen[:n])
    sides = []
    shared_head = n < len(chosen) and n < len(rejected) and chosen[n][0] == rejected[n][0] == "assistant"
    if shared_head:
        prompt += "<|assistant|>\n"
    for turns in (chosen[n:], rejected[n:]):
        text, ids, labels = "", [], []
        for k, (r, t) in enumerate(turns):
            head = [] if shared_head and k == 0 else plain(f"<|{r}|>\n")
            body = plain(t + "<|end|>\n")
            text += ("" if shared_head and k == 0 else f"<|{r}|>\n") + t + "<|end|>\n"
            ids += head + body
            labels += [MASKED] * len(head) + (body if r == "assistant" else [MASKED] * len(body))
        sides.append((text, ids, labels))
    return n, prompt, sides


def test_pairs_against_brute_force(spark):
    a, u, s = "assistant", "user", "system"
    pairs = [
        (1, T((u, "Hi"), (a, "Hello there.")), T((u, "Hi"), (a, "Go away!"))),
        (2, T((s, "Be kind"), (u, "Q"), (a, "A1"), (u, "Q2"), (a, "A2")), T((s, "Be kind"), (u, "Q"), (a, "A1"), (u, "Other"), (a, "A3"))),
        (3, T((u, "same"), (a, "same")), T((u, "same"), (a, "same"))),
        (4, [], T((u, "x"))), (5, None, None), (None, T((None, None), (a, None)), T((None, None), (a, ""))),
        (6, T((u, "x"), (a, "y")), T((u, "x"))), (6, T((u, "x"), (a, "y")), T((u, "x"))), (7, T((u, "x")), T((a, "x" * 50_000))),
    ]
    table = spark.createDataFrame([(*p, "clash") for p in pairs], f"pair_id long, chosen {TURNS}, rejected {TURNS}, prompt string")
    got = format_preferences(table, tokenizer_path())
    assert got.columns == [c.split()[0] for c in PAIR_SCHEMA.split(", ")]
    rows = got.collect()
    assert len(rows) == len(pairs)
    by = {r.pair_id: r for r in rows}
    for name, chosen, rejected in pairs:
        n, prompt, sides = brute(chosen, rejected)
        r = by[name]
        assert (r.prompt_turns, r.prompt) == (n, prompt)
        assert (r.chosen, r.chosen_ids, r.chosen_labels) == sides[0]
        assert (r.rejected, r.rejected_ids, r.rejected_labels) == sides[1]
    assert format_preferences(table.limit(0), tokenizer_path()).count() == 0


def test_sampled_pairs(spark):
    rows = []
    for c in [5, 1, 9, 3, 20, None, 7]:
        rows += [(c, 1, "assistant", f"first {c}"), (c, 0, "user", f"q {c}"), (c, 2, "user", f"again {c}"),
                 (c, 3, "assistant", None if c == 3 else f"last {c}"), (c, 4, "user", "bye")]
    rows += [(4, 0, "user", "no answer"), (9, 0, "user", "q 9"), (6, None, None, None), (None, None, "user", "")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    got = {r.pair_id: r for r in sampled_pairs(table).collect()}
    order = [None, 1, 3, 5, 7, 9, 20]
    assert set(got) == set(order)
    for k, c in enumerate(order):
        after = order[(k + 1) % len(order)]
        r = got[c]
        assert r.chosen[-1].text == (None if c == 3 else f"last {c}") and r.chosen[:-1] == r.rejected[:-1]
        assert r.rejected[-1].text == (None if after == 3 else f"last {after}") and r.rejected[-1].role == "assistant"
    assert len(got[9].chosen) == 5 and sampled_pairs(table.limit(0)).count() == 0


def test_head_of_the_assistant_ends_the_prompt():
    prompt, a, b = split_pair([("user", "x"), ("assistant", "y")], [("user", "x"), ("assistant", "z")])
    assert prompt[-1] == ("<|assistant|>\n", False) and a == [("y<|end|>\n", True)] and b == [("z<|end|>\n", True)]


def test_whole_conversations_are_paired_by_their_beginnings(spark):
    rows = []
    for c in range(120):  # 3 first turns, 2 second turns under each, then own ones
        said = [f"hello {c % 3}", f"yes {c % 6}", f"well {c % 12}", f"only {c}"]
        rows += [(c, k, "user" if k % 2 == 0 else "assistant", t) for k, t in enumerate(said[:1 + c % 4])]
    rows += [(None, None, None, None), (None, 3, "user", ""), (500, 0, "system", "alone"), (7, 1, "assistant", "yes 1")]
    rows += [(600, k, "user", f"{k}") for k in range(25)]
    table = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, turns string").repartition(6)
    got = whole_pairs(table, window=10).collect()
    held = sorted(((r.pair_id, *(tuple(t) for t in r.chosen)) for r in got), key=str)
    want = {}
    for c, n, r, t in rows:
        want.setdefault((c, (n or 0) // 10), []).append((n, r, t))
    assert held == sorted(((c, *sorted(ts, key=lambda t: (t[0] is not None, t[0], t[1] or "", t[2] or ""))) for (c, _), ts in want.items()), key=str)
    # Each is rejected once, and neighbours share their beginnings wherever others have them.
    assert sorted((tuple(map(tuple, r.rejected)) for r in got), key=str) == sorted((tuple(map(tuple, r.chosen)) for r in got), key=str)
    depth = [sum(1 for _ in iter_common(r.chosen, r.rejected)) for r in got]
    assert {0, 1, 2} <= set(depth) and sum(d >= 1 for d in depth) > 110 and sum(d >= 2 for d in depth) > 60
    one = whole_pairs(table.filter("conv_id = 500")).collect()
    assert len(one) == 1 and one[0].chosen == one[0].rejected
    assert whole_pairs(table.limit(0)).count() == 0


def iter_common(a, b):
    for x, y in zip(a, b):
        if (x.role, x.text) != (y.role, y.text):
            return
        yield x
