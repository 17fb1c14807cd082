import random

from supplylake.llm.components import connected_components
from supplylake.llm.ngram_join import keep_one_of_each, ngram_components

from .cases import awkward, empty, prose
from .test_fingerprints import shingles


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(d)
    least = {r: min((d for d in v if d is not None), default=None) for r, v in ids.items()}
    return [(d, len(sets[i]), least[find(i)] if sets[i] else d) for i, (d, _) in enumerate(rows)]


def frame(spark, rows):
    return awkward(spark, [(d, t, None, None, None, None, None, None, None) for d, t in rows])


def order(r):
    return tuple((x is not None, x or 0) for x in r)


def same(spark, rows):
    got = ngram_components(frame(spark, rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=order) == sorted(brute(rows), key=order)


def edit(rng, text, times):
    words = text.split()
    for _ in range(times):
        k = rng.randrange(len(words))
        kind = rng.random()
        if kind < 0.6:
            words[k] = "x%d" % rng.randrange(10**6)
        elif kind < 0.8:
            del words[k]
        else:
            words.insert(k, "y%d" % rng.randrange(10**6))
    return " ".join(words)


def test_groups_at_the_border_of_the_threshold(spark):
    rng = random.Random(4)
    rows = []
    for g in range(14):
        base = prose(g, rng.choice([6, 20, 60, 150, 400]))
        for _ in range(rng.randint(1, 9)):
            rows.append((len(rows), edit(rng, base, rng.randint(0, 1 + len(base.split()) // 22))))
    chain = prose(99, 200).split()
    for k in range(12):  # each links to the next only
        rows.append((len(rows), " ".join(chain[k * 12:] + [f"c{k}x{i}" for i in range(k * 12)])))
    passage = prose(77, 70)
    rows += [(len(rows) + i, f"{prose(500 + i, 30 + i)} {passage} {prose(900 + i, 20)}") for i in range(25)]
    rng.shuffle(rows)
    same(spark, rows)


def test_many_near_copies_without_a_base(spark):
    rng = random.Random(6)
    base = prose(5, 240)
    rows = [(1000 - i, edit(rng, base, rng.randint(3, 7))) for i in range(60)]
    same(spark, rows)


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = ngram_components(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=order) == sorted(brute(rows), key=order)
    assert ngram_components(empty(spark)).count() == 0
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=lambda x: (x is None, x)) == [0, 1, 2, 3, 4, 6, 7, 12, None]


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 200)], "a long, b long")
    got = {r.node: r.label for r in connected_components(links).collect()}
    assert got == {**{i: 0 for i in range(61)}, 200: 0, 100: 100, 101: 100}
