import random

from supplylake.llm.decontamination import EDITS, FRAGMENT, LEAST, Fragments, find_leaks, normalized, without_leaks

from .cases import LONG, awkward, empty, prose
from .test_ngram_join import frame


def plain(text):
    codes = normalized([text], 0)[0]
    return "".join(map(chr, codes)).strip()


def nearest(pattern, text):
    """Fewest edits of the pattern against any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        last, row = row, [i]
        for j, t in enumerate(text, 1):
            row.append(min(last[j - 1] + (p != t), last[j] + 1, row[j - 1] + 1))
    return min(row)


def brute(texts, items):
    out = set()
    for k, item in items:
        item = plain(item or "")
        if len(item) < LEAST:
            continue
        width = min(FRAGMENT, len(item))
        parts = {item[a:a + width] for a in [*range(0, len(item) - width + 1, FRAGMENT // 2), len(item) - width]}
        for i, text in texts:
            if any(nearest(p, plain(text or "")) <= int(width * EDITS) for p in parts):
                out.add((i, k))
    return out


def typos(rng, text, times):
    chars = list(text)
    for _ in range(times):
        k = rng.randrange(len(chars))
        kind = rng.randrange(3)
        if kind == 0:
            chars[k] = rng.choice("qzjx")
        elif kind == 1:
            del chars[k]
        else:
            chars.insert(k, rng.choice("qzjx"))
    return "".join(chars)


def test_fragments_within_the_edit_budget(spark):
    rng = random.Random(5)
    items = [(k, prose(700 + k, rng.choice([6, 14, 25]))) for k in range(8)]
    texts = []
    for i in range(90):
        k, item = rng.choice(items)
        start = rng.randrange(max(1, len(item) // 3))
        piece = typos(rng, item[start:start + rng.randint(60, 140)].upper(), rng.randint(0, 9))
        texts.append((i, f"{prose(i, 12)} -- {piece}{rng.choice([' ', '.', chr(10)])}{prose(i + 200, 8)}"))
    table = spark.createDataFrame(items, "item_id long, text string")
    got = find_leaks(frame(spark, texts), table).collect()
    want = brute(texts, items)
    assert {(r.doc_id, r.item_id) for r in got} == want and len(want) > 20
    by_id = dict(texts)
    for r in got:
        hull = plain(by_id[r.doc_id][r.start:r.end])
        assert nearest(hull[:40], plain(dict(items)[r.item_id])) <= 14
    kept = without_leaks(frame(spark, texts), table)
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in texts} - {i for i, _ in want}


def test_awkward_rows(spark):
    docs = awkward(spark)
    words = LONG.split()
    items = spark.createDataFrame([(1, " ".join(words[30_000:30_040])), (1, None), (2, ""), (None, "too short"),
                                   (3, "日本語 テキスト endoftext 日本語 テキスト")], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in find_leaks(docs, items).collect()} == {(4, 1), (9, 1)}
    assert find_leaks(empty(spark), items).count() == 0
    assert find_leaks(docs, items.limit(0)).count() == 0
    kept = without_leaks(docs, items)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 2
    assert without_leaks(docs, items.limit(0)).count() == docs.count()


def test_a_leak_does_not_cross_documents():
    item = prose(1, 30)
    half = len(item) // 2

    class Item:
        item_id, text = 1, item[:78]

    found = Fragments([Item])
    assert found.leaks([item[:39], item[39:78]]) == []
    assert len(found.leaks(["x " + item[:half] + item[half:], ""])) == 1


def test_with_step_1_every_passage_of_a_fragment_is_found_wherever_it_starts(spark):
    rng = random.Random(9)
    item = plain(prose(77, 60))
    texts = []
    for start in range(0, len(item) - FRAGMENT + 1):
        passage = item[start:start + FRAGMENT]
        texts.append((2 * start, f"{prose(start, 5)} {passage}"))
        texts.append((2 * start + 1, f"x {passage[:1]}{typos(rng, passage[1:-1], int(FRAGMENT * EDITS))}{passage[-1:]} {prose(start, 5)}"))
    table = spark.createDataFrame([(1, item)], "item_id long, text string")
    # Edits that leave blanks side by side cost one more where they become one.
    within = {i for i, t in texts if nearest(item[i // 2:i // 2 + FRAGMENT], plain(t)) <= int(FRAGMENT * EDITS)}
    got = {r.doc_id for r in find_leaks(frame(spark, texts), table, step=1).collect()}
    assert within <= got and len(within) > 0.98 * len(texts)
    assert without_leaks(frame(spark, texts), table, step=1).count() == len(texts) - len(got)


def test_with_step_1_nothing_but_fragments_within_the_budget_is_found(spark):
    rng = random.Random(15)
    items = [(k, prose(730 + k, 20)) for k in range(3)]
    texts = [(i, f"{prose(i, 6)} {typos(rng, items[i % 3][1][7 + i:90 + i], rng.randint(3, 14))}") for i in range(18)]
    want = set()
    for k, item in items:
        item = plain(item)
        parts = [item[a:a + FRAGMENT] for a in range(len(item) - FRAGMENT + 1)]
        want |= {(i, k) for i, t in texts if any(nearest(p, plain(t)) <= int(FRAGMENT * EDITS) for p in parts)}
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in find_leaks(frame(spark, texts), table, step=1).collect()}
    assert got == want and 0 < len(want) < len(texts)


def rows(items):
    return [type("Item", (), {"item_id": k, "text": t}) for k, t in items]


def test_short_items_are_found_as_they_are():
    items = rows([(1, "Who wrote Hamlet in 1600?"), (2, "2 + 2"), (3, "日本"), (4, "who wrote what"), (5, "!!"), (6, "who wrote Hamlet")])
    texts = ["So: who wrote HAMLET, in 1600", "who wrote Hamlets in 1600", "a 2 (2) b", "22", "日本 x", "日本人", "who wrote", "", "q who wrote what?",
             "who wrote", "what"]
    got = {(f[0], f[1]) for f in Fragments(items).leaks(texts)}
    assert got == {(0, 1), (0, 6), (2, 2), (4, 3), (8, 4)}
    places = {(f[0], f[1]): f[2:] for f in Fragments(items).leaks(texts)}
    assert places[0, 6] == (1, 0, 4, 20) and places[2, 2] == (1, 0, 2, 6)
    assert Fragments(rows([(1, None), (2, "...")])).leaks(texts) == []


def test_items_just_above_the_least_miss_nothing_within_their_budget():
    rng = random.Random(6)
    for size in range(LEAST, 31):
        item = plain(prose(40 + size, 12))[:size].strip()
        item += "x" * (size - len(item))
        found = Fragments(rows([(1, item)]), 1)
        budget = int(found.edits[0])
        assert found.bound[0] >= 1 and budget <= int(size * EDITS)
        texts = [f"{prose(i, 4)} {typos(rng, item, rng.randint(0, 3))} {prose(i + 50, 4)}" for i in range(60)]
        got = {f[0] for f in found.leaks(texts)}
        assert got == {i for i, t in enumerate(texts) if nearest(item, plain(t)) <= budget}, size


def test_a_repeated_word_costs_bounded_memory(monkeypatch):
    """Every q-gram of the text is at hundreds of places of the item."""
    import tracemalloc

    from supplylake.llm import decontamination as D
    texts = ["begin " + "word " * 800 + "end", "word " * 9, prose(3, 50)]
    items = rows([(1, "word " * 60), (2, prose(9, 30))])
    whole = Fragments(items, 30).leaks(texts)
    monkeypatch.setattr(D, "PAIRS", 4000)
    tracemalloc.start()
    got = Fragments(items, 30).leaks(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sorted(got) == sorted(whole) and {(f[0], f[1]) for f in got} == {(0, 1)}
    assert peak < 150e6


def test_stretches_find_what_the_whole_text_does(monkeypatch):
    from supplylake.llm import decontamination as D
    rng = random.Random(3)
    items = [(k, prose(800 + k, 30)) for k in range(4)]
    texts = [" ".join([prose(i, 10)] + [typos(rng, rng.choice(items)[1][5:90], rng.randint(0, 4)) for _ in range(12)]) for i in range(6)]
    want = Fragments(rows(items), 1).leaks(texts)
    monkeypatch.setattr(D, "PAIRS", 100)
    assert sorted(Fragments(rows(items), 1).leaks(texts)) == sorted(want) and len(want) > 10
