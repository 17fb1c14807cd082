import random
import zlib

import numpy as np
from pyspark.sql import Row

from supplylake.llm.toxicity import Index, isotonic, score_toxicity, without_toxic

from .cases import awkward, empty, prose

BAD = ["vile", "scummy", "rotten", "nasty"]


def corpus(spark, n=1200):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.2
        words = prose(i, rng.randint(5, 80)).split()
        if toxic:
            for _ in range(rng.randint(1, 6)):
                words.insert(rng.randrange(len(words)), rng.choice(BAD) + rng.choice(["", ",", "!"]))
        rows.append((i, " ".join(words), None, None, None, None, None, None, None))
        labels.append((i, int(toxic) if rng.random() > 0.02 else int(not toxic), toxic))
    return rows, labels


def test_block_max_search_is_exact():
    rng = np.random.default_rng(3)
    terms = 40
    idf = rng.random(terms) + 0.5

    def some(e):
        t = np.sort(rng.choice(terms, rng.integers(0, 6), replace=False))
        return Row(example=e, toxic=int(rng.random() < 0.5), words=int(rng.integers(10, 90)), terms=t.tolist(),
                   counts=rng.integers(1, 5, len(t)).tolist())

    rows = [some(e) for e in range(700)]
    index = Index.of(idf, rows, 0.5)
    matrix = np.zeros((len(index.example), terms + 1))
    for i, e in enumerate(index.example):
        at, weight = index.vector(idf, rows[e])
        matrix[i, at] = weight
    for _ in range(200):
        row = some(-1)
        at, weight = index.vector(idf, row)
        every = matrix[:, at] @ weight
        found, near = index.nearest(row, 25)
        best = np.sort(every)[::-1]
        assert np.allclose(near, best[:len(near)]) and np.allclose(every[found], near)
        assert len(near) == min(len(every), int((every >= best[min(24, len(every) - 1)] - 1e-9).sum()))


def test_isotonic_is_monotone():
    x, y = np.array([0, .1, .2, .3, .4, .4]), np.array([0, 1, 0, 1, 1, 1.0])
    starts, values = isotonic(x, y)
    assert (np.diff(values) > 0).all() and starts[0] == 0


def test_held_out_labels_are_learned_from_and_found(spark):
    rows, labels = corpus(spark)
    known = spark.createDataFrame([(i, y) for i, y, _ in labels], "doc_id long, toxic int")
    got = {r.doc_id: r for r in score_toxicity(awkward(spark, rows), known).collect()}
    right = 0
    for i, _, truth in labels:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= got[i].score <= 1 and got[i].predicted == int(got[i].score >= 0.7)
        right += got[i].predicted == int(truth)
    assert right / len(labels) > 0.97
    # Labels of held-out rows are never read.
    turned = known.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 3 = 1 then 1 - toxic else toxic end as toxic")
    again = {r.doc_id: r.score for r in score_toxicity(awkward(spark, rows), turned).collect()}
    assert again == {i: r.score for i, r in got.items()}
    kept = without_toxic(awkward(spark, rows), known)
    assert kept.columns == awkward(spark).columns
    assert kept.count() == sum(r.predicted == 0 for r in got.values())


def test_awkward_rows_and_no_labels(spark):
    docs = awkward(spark)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in score_toxicity(docs, none).collect()} == {0.0}
    some = spark.createDataFrame([(0, 1), (0, 0), (5, 1), (6, None), (None, 1), (7, 0)], "doc_id long, toxic int")
    got = score_toxicity(docs, some).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert score_toxicity(empty(spark), some).count() == 0


def test_texts_without_telling_terms_have_their_nearest_examples(spark):
    rows, labels = corpus(spark)
    learned = [i for i, _, toxic in labels if zlib.crc32(str(i).encode()) % 3 != 1 and not toxic]
    copies = {5000 + i: i for i in learned[:20]}
    fields = len(rows[0]) - 2
    rows += [(c, rows[i][1].upper(), *[None] * fields) for c, i in copies.items()]
    rows += [(9000, "...", *[None] * fields), (9001, "Zyx", *[None] * fields)]
    known = spark.createDataFrame([(i, y) for i, y, _ in labels], "doc_id long, toxic int")
    got = {r.doc_id: r for r in score_toxicity(awkward(spark, rows), known).collect()}
    assert all(got[c].neighbours[0] == i and len(got[c].neighbours) == 3 for c, i in copies.items())
    assert got[9000].neighbours == [] and len(got[9001].neighbours) == 3


def test_whole_vectors_against_brute_force(monkeypatch):
    """Texts with telling terms, other words and words that no example holds, against
    every example's dense vector; most blocks of unlike examples stay closed."""
    from collections import Counter

    from supplylake.llm import toxicity as T
    monkeypatch.setattr(T, "FREQUENT", 30)
    monkeypatch.setattr(T, "BLOCK", 16)
    rng = random.Random(12)
    tongues = [[f"{c}{prose(k, 1)}{k}" for k in range(120)] for c in "abcd"]

    def text():
        words = rng.choices(rng.choice(tongues), k=rng.randint(0, 60)) + rng.choices(["vileness", "scum"], k=rng.choice([0, 0, 0, 2]))
        return " ".join(words + [f"unseen{rng.randint(0, 9)}"] * rng.randint(0, 2))
    examples = [text() for _ in range(900)]
    telling = ["vileness", "scum", "vile*"]
    vocabulary = sorted({w for t in examples[:700] for w in T.TERM.findall(t)} - set(telling))
    terms = telling + vocabulary
    idf = np.array([rng.uniform(1, 6) for _ in terms])
    unseen = 7.0

    def counted(texts):
        size, unknown, held, ids, counts = T.count_terms(texts, T.Numbered(terms))
        return T.Counts(size, unknown, np.concatenate(([0], np.cumsum(held))), ids, counts)

    def dense(t):
        words = Counter(T.TERM.findall(t.lower()))
        total, v, rest = sum(words.values()), np.zeros(len(terms) + 1), 0.0
        for w, n in words.items():
            for i, name in enumerate(terms):
                if name == w or name.endswith("*") and len(w) >= len(name) and w.startswith(name[:-1]):
                    v[i] += n * idf[i]
            rest += 0 if w in terms else (n * unseen) ** 2
        v[:3] *= 100 / max(total, 1)
        norm = np.sqrt((v[3:] ** 2).sum() + rest)
        v[3:] *= T.OTHERS / norm if norm else 0
        v[-1] = T.REST
        return v / np.sqrt((v[:3] ** 2).sum() + T.REST ** 2 + (T.OTHERS ** 2 if norm else 0))

    index = T.Index.build(idf, np.arange(900), np.zeros(900), counted(examples), 0.1, 3, unseen)
    matrix = np.array([dense(examples[e]) for e in index.example])
    assert len(index.example) == sum(bool(t) for t in examples)
    queries = [t for t in (text() for _ in range(300)) if t]
    for t, (found, near) in zip(queries, index.search(counted(queries), 25)):
        every = matrix @ dense(t)
        best = np.sort(every)[::-1]
        assert np.allclose(near[:25], best[:25]) and np.allclose(every[found], near)
    assert index.opened < 0.6 * len(queries) * index.most.shape[1]
    own = np.arange(50)
    for i, (found, near) in zip(own, index.search(counted([examples[e] for e in index.example[:50]]), 25, own)):
        assert i not in found[np.isfinite(near)]


def test_words_are_counted_without_remembering_strange_ones():
    """Only words that hold terms are numbered, in texts of ASCII and others alike."""
    from collections import Counter

    from supplylake.llm import toxicity as T
    terms = ["vile", "vile*", "vilen*", "scum", "straße", "été", "x_1"]
    numbered = T.Numbered(terms)
    rng = random.Random(4)
    known = ["vile", "VILENESS", "vilest", "vil", "Scum", "scummy", "x_1", "straße", "ÉTÉ", "İ", "٣"]
    texts = [None, "", "...", "a\x00b\x1fc\x85d", "vile-vile;VILE"]
    for i in range(300):
        words = [rng.choice(known) if rng.random() < 0.3 else f"w{rng.randrange(10 ** 6)}" for _ in range(rng.randrange(40))]
        texts.append(rng.choice([" ", ", ", "\n\t", "'"]).join(w for w in words if i % 2 or w.isascii()))
    size, unknown, held, ids, counts = T.count_terms(texts, numbered)
    cut = np.concatenate(([0], np.cumsum(held)))
    for i, text in enumerate(texts):
        words = Counter(T.TERM.findall((text or "").lower()))
        right = Counter()
        for w, n in words.items():
            for t in [w, *(w[:k] + "*" for k in T.STEMS if len(w) > k)]:
                if t in terms:
                    right[terms.index(t)] += n
        assert size[i] == words.total()
        assert unknown[i] == sum(n * n for w, n in words.items() if w not in terms)
        assert list(zip(ids[cut[i]:cut[i + 1]], counts[cut[i]:cut[i + 1]])) == sorted(right.items())
    assert set(numbered) == {*terms, "vileness", "vilest"}


def test_postings_are_gathered_for_some_texts_at_once(monkeypatch):
    """Short postings of several texts and long ones add up to the plain sums, however
    many are gathered at once, and the steps are far fewer than the texts."""
    from supplylake.llm import toxicity as T
    monkeypatch.setattr(T, "FREQUENT", 5)
    rng = np.random.default_rng(9)

    def some(e):
        t = np.unique((200 * rng.random(rng.integers(0, 30)) ** 2).astype(int))
        return Row(example=e, toxic=0, words=int(rng.integers(30, 90)), terms=t.tolist(), counts=rng.integers(1, 5, len(t)).tolist())

    idf = rng.random(200) + 0.5
    index = Index.of(idf, [some(e) for e in range(500)], 0.5)
    counts = T.Counts.listed([some(-1) for _ in range(150)])
    weight, _ = index.weights(counts)
    plain = np.zeros((150, index.matrix.shape[1]))
    for i in range(150):
        for j in range(counts.cut[i], counts.cut[i + 1]):
            own = index.post[index.begin[counts.terms[j]]:index.begin[counts.terms[j] + 1]].view(T.POSTING)
            plain[i, own["place"]] += weight[j] * own["weight"]
    steps, counted = [], np.bincount
    monkeypatch.setattr(T.np, "bincount", lambda *a, **k: steps.append(1) or counted(*a, **k))
    for long, gathered, most in ((10 ** 6, 10 ** 6, 1), (10 ** 6, 5000, 75), (10 ** 6, 1, 150), (20, 1 << 18, 151), (1, 1, 300)):
        monkeypatch.setattr(T, "LONG", long)
        monkeypatch.setattr(T, "GATHERED", gathered)
        steps.clear()
        assert np.allclose(index._rarer(counts, weight), plain, atol=1e-12)
        assert len(steps) <= most


def test_workers_get_small_batches_and_search_apart_from_the_join(spark, monkeypatch):
    """Texts and counted terms reach a worker a few at a time, whatever a batch of Spark's
    holds by default; scores are stored before documents are shuffled, and are the same."""
    from supplylake.llm import toxicity as T
    rows, labels = corpus(spark)
    docs, known = awkward(spark, rows).coalesce(1), spark.createDataFrame([(i, y) for i, y, _ in labels], "doc_id long, toxic int")
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    plain, before = {r.doc_id: r.score for r in score_toxicity(docs, known).collect()}, spark.conf.get(setting)
    of, slices = T.Counts.of, T.text_slices

    def small(batches):
        for batch in batches:
            assert batch.nbytes < 1 << 16, batch.nbytes
            yield batch

    def few(batch):
        assert batch.num_rows <= 100 or not isinstance(batch, T.pa.RecordBatch), batch.num_rows
        return of(batch)

    monkeypatch.setattr(T, "BATCH", "32k", raising=False)
    monkeypatch.setattr(T, "text_slices", lambda batches, *limit: slices(small(batches) if limit else batches, *limit))
    monkeypatch.setattr(T, "row_slices", lambda batches, cut=T.row_slices: cut(small(batches), 100))
    monkeypatch.setattr(T.Counts, "of", few)
    assert {r.doc_id: r.score for r in score_toxicity(docs, known).collect()} == plain
    assert spark.conf.get(setting) == before
    assert "MapInArrow" not in without_toxic(docs, known)._jdf.queryExecution().toString()


def test_a_broadcast_index_finds_the_same():
    import pickle
    rng = np.random.default_rng(6)

    def some(e):
        t = np.unique(rng.integers(0, 400, rng.integers(1, 30)))
        return Row(example=e, toxic=0, words=int(rng.integers(30, 90)), terms=t.tolist(), counts=rng.integers(1, 5, len(t)).tolist())

    index = Index.of(rng.random(400) + 0.5, [some(e) for e in range(300)], 0.5)
    there = Index(**pickle.loads(pickle.dumps(index.parts(), 5)))
    for row in [some(-1) for _ in range(50)]:
        for a, b in zip(index.nearest(row, 9), there.nearest(row, 9)):
            assert np.allclose(a, b)


def test_terms_are_summed_where_texts_are_read(spark, monkeypatch):
    """The examples with each word and beginning of a word are counted slice by slice, with
    no row for each word of a text; the sums are those of a row for each."""
    from pyspark.sql import functions as F
    from supplylake.llm import toxicity as T
    texts = [("Straße_1 ÉTÉ été vilest vileness VILEST", 1), ("", 0), ("abcd abcde abcdefgh x\u0301y ١٢ vileness", 0),
             ("vileness été_été Ⅷ ½ İstanbul ΟΔΟΣ", 1), (None, 1)]
    rows = spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate(texts)], "example long, text string, toxic int")
    words = rows.select("toxic", F.array_distinct(F.regexp_extract_all(
        F.lower(F.coalesce("text", F.lit(""))), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))).alias("words"))
    begun = F.array_distinct(F.transform(F.filter("words", lambda w, i: F.length(w) > i),
                                         lambda w, i: F.concat(F.substring(w, 1, i), F.lit("*"))))
    want = (words.select("toxic", F.explode(F.concat("words", *[begun] * 4)).alias("term")).groupBy("term")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("a")))
    want = {r.term: (r.n, r.a) for r in want.collect()}
    monkeypatch.setattr(T, "SLICE", 40)
    sums = T.term_sums(rows.coalesce(1))
    assert {r.term: (r.n, r.a) for r in sums.collect()} == want and want["vileness"] == (3, 2) and want["été"] == (1, 1)
    assert "Generate" not in sums._jdf.queryExecution().optimizedPlan().toString()
