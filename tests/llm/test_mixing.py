import re

import pytest

from supplylake.llm.mixing import mix_sources

from .cases import awkward, empty, prose


def targets(sizes, weights=(5, 2, 1), share=1.0, most=3.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s])
    names += [None] if None in sizes else []
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, out = share * sum(sizes.values()), set(names), {}
    while free:
        unit = left / sum(w[s] for s in free)
        above = {s for s in free if unit * w[s] >= most * sizes[s]}
        if not above:
            out.update({s: unit * w[s] for s in free})
            break
        for s in above:
            out[s] = most * sizes[s]
            left -= out[s]
        free -= above
    return out


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_targets_sizes_and_repeatability(spark):
    rows = [(i, prose(i, 3 + i % 40), None, ["s1", "s2", "s10", "é", None][min(4, i % 9)], None, None, None, None, None)
            for i in range(900)]
    docs = awkward(spark, rows).repartition(7)
    got = mix_sources(docs).collect()
    again = mix_sources(docs.repartition(3)).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + words(r[1])
    want = targets(sizes)
    taken = {}
    assert len(got) == 900
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken == r.copies * r.size <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s in want:
        assert abs(taken[s] - want[s]) <= 43


def test_awkward_rows(spark):
    docs = awkward(spark)
    got = mix_sources(docs).collect()
    assert len(got) == docs.count()
    assert sorted(r.size for r in got) == sorted(words(r.text) for r in docs.collect())
    assert mix_sources(empty(spark)).count() == 0


def test_inclusion_weights(spark):
    rows = [(i, "a b c d", None, "s" if i % 2 else "t", None, None, 1.0 + 8 * (i % 4 < 2), None, None) for i in range(4000)]
    got = mix_sources(awkward(spark, rows), weights=(1.0, 1.0), share=0.5, weight="score").collect()
    heavy = sum(r.taken for r in got if r.doc_id % 4 < 2)
    light = sum(r.taken for r in got if r.doc_id % 4 >= 2)
    assert abs(heavy + light - 8000) <= 8 and 6 < heavy / light < 13
