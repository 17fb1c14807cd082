import hashlib

import numpy as np
import pyarrow as pa

from supplylake.llm.fingerprints import Fingerprinter, fingerprint, fingerprint_edits
from supplylake.llm.words import shingle_sets

from .cases import awkward, empty, prose


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def test_shingle_sets_equal_python_sets():
    texts = [None, "", " ", "a b", "A b", "a b c d e f", prose(3, 300), prose(3, 290), "Ä ä x y z w", "a\x0bb\x0cc d e f", "x" * 5000 + " y z"]
    sets = shingle_sets(pa.array(texts))
    for i, a in enumerate(texts):
        assert len(sets[i]) == len(shingles(a))
        for j, b in enumerate(texts):
            assert len(np.intersect1d(sets[i], sets[j])) == len(shingles(a) & shingles(b))


def test_edits_against_brute_force(spark):
    docs = awkward(spark)
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()),
                  key=lambda r: (-1 if r[0] is None else r[0], r[1]))
    got = fingerprint_edits(docs).collect()
    assert len(got) == len(rows)
    want = []
    for k, (doc, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edit = text[:len(text) - half] + after[:half]
        want.append((doc, len(text), hashlib.sha256(edit.encode()).hexdigest(), text, edit, after))
    order = lambda r: (-1 if r[0] is None else r[0], r[1], r[2])
    for g, w in zip(sorted(map(tuple, got), key=order), sorted(want, key=order)):
        assert g[:3] == w[:3]
        for value, other in ((g[5], w[4]), (g[6], w[5])):
            a, b = shingles(w[3]), shingles(other)
            true = len(a & b) / len(a | b) if a | b else 1.0
            assert abs(value - true) < 0.12, (w[0], value, true)
    by_text = {}
    for r in fingerprint(docs).collect():
        by_text.setdefault(r.doc_id, set()).add(r.fingerprint)
    assert len(by_text[5]) == 1 and by_text[1] == by_text[2] == by_text[3] == {""}


def test_one_row_and_no_rows(spark):
    assert fingerprint_edits(empty(spark)).count() == 0
    row = fingerprint_edits(awkward(spark).filter("doc_id = 7")).first()
    assert row.near_next == 1.0 and row.n_chars == 7


def test_small_sets_estimate_without_bias():
    maker = Fingerprinter()
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(60):
        both = rng.integers(0, 2**63, 6, dtype=np.uint64)
        a = np.unique(np.concatenate([both, rng.integers(0, 2**63, 3, dtype=np.uint64)]))
        b = np.unique(np.concatenate([both, rng.integers(0, 2**63, 3, dtype=np.uint64)]))
        errors.append(maker.likeness(maker.values(a), maker.values(b)) - 0.5)
    assert abs(np.mean(errors)) < 0.08
    x = maker.values(both)
    assert (maker.unpacked(maker.packed(x)) == x).all()
