import random
import re
import zlib
from collections import Counter, defaultdict

from supplylake.llm import spelling
from supplylake.llm.spelling import cut_lengths, near_pairs, spelling_variants, variant_roots

from .cases import awkward, empty, prose

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, one_in):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if one_in and h % one_in == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}
    near = defaultdict(set)
    for w in words:
        for v in near_words(w, words):
            near[w].add(v)
            near[v].add(w)
    form = {w: v for w in near for v in [min(near[w], key=lambda v: (-words[v], v))] if words[v] >= 2 * words[w]}
    out = {}
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n, len(near[w]), words.get(form.get(w)))
    return out


def near_words(w, words):
    """Those that one replacement or insertion makes of ``w``."""
    letters = {c for v in words for c in v}
    for i in range(len(w) + 1):
        for c in letters:
            for v in {w[:i] + c + w[i:], w[:i] + c + w[i + 1:]} - {w}:
                if v in words and abs(len(v) - len(w)) <= 1:
                    yield v


def check(spark, docs, one_in=0):
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling_variants(docs, one_in).collect()}
    want = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], one_in)
    assert got == want
    return got


def misspelt(seed, vocabulary, words):
    rng = random.Random(seed)
    names = sorted(set(prose(seed, vocabulary).split()))
    out = []
    for _ in range(words):
        w = rng.choice(names[:rng.randint(1, len(names))])
        if rng.random() < 0.3:
            i = rng.randrange(len(w))
            w = w[:i] + rng.choice(["", "x", w[i] * 2, "é", "ß"]) + w[i + 1:]
        out.append(w.upper() if rng.random() < 0.1 else w)
    return " ".join(out)


def test_against_brute_force(spark):
    docs = spark.createDataFrame([(i, misspelt(i % 5, 300, 400), i) for i in range(40)], "doc_id long, text string, word int")
    got = check(spark, docs, 5)
    assert any(v[0] for v in got.values()) and any(v[1] != v[0] and v[0] for v in got.values())


def test_hot_nodes_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(spelling, "TOGETHER", 3)
    docs = spark.createDataFrame([(i, misspelt(1, 200, 300)) for i in range(12)], "doc_id long, text string")
    check(spark, docs, 7)


def test_letters_ends_and_repeats(spark):
    words = ["aaaaa", "aaaaaa", "aaaaaaa", "aaaab", "baaaa", "abaaa", "Ärger", "ärger", "àrger", "stra÷e", "straße", "strasse",
             "abcde", "abcdef", "xabcde", "abxcde", "abde", "abcd", "bcdea", "ééééé", "éééé", "éééééé"]
    text = " ".join(w for k, w in enumerate(words) for _ in range(3 + k % 4))
    check(spark, spark.createDataFrame([(1, text), (2, "straße_STRASSE5aaaaa"), (2, "straße_STRASSE5aaaaa")], "doc_id long, text string"))


def test_very_long_words_cost_few_levels(spark):
    assert len(cut_lengths(100_000)) < 50 and cut_lengths(30)[-2:] == [24, 36] and cut_lengths(7) == [0, 1, 2, 3, 4, 6, 8]
    rng = random.Random(4)
    base = "".join(rng.choice("abcdefgh") for _ in range(900))
    words = [base, base[:-1], base[1:], base[:450] + base[451:], base[:25] + "z" + base[25:], base + "q", base[:300] + "z" + base[301:],
             base[:24], base[:25], base[:23], base[:36], base[:35] + "z", base[:37], base[:24] + base[25:37], base[:10] + base[11:36]]
    pairs = {tuple(sorted(p)) for p in near_pairs(spark.createDataFrame([(w,) for w in words], "word string")).collect()}

    def one(a, b):
        a, b = sorted((a, b), key=len)
        k = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
        return a != b and (a[k:] == b[k + 1:] or len(a) == len(b) and a[k + 1:] == b[k + 1:])
    assert pairs == {tuple(sorted((a, b))) for a in words for b in words if one(a, b)}


def test_chain_of_forms(spark):
    chain = [(f"w{i}", f"w{i + 1}" if i < 21 else None) for i in range(22)]
    got = dict(tuple(r) for r in variant_roots(spark.createDataFrame(chain, "word string, form string")).collect())
    assert got == {f"w{i}": "w21" for i in range(22)}


def test_awkward_rows(spark):
    check(spark, awkward(spark), 3)
    assert spelling_variants(empty(spark)).count() == 0
    assert spelling_variants(spark.createDataFrame([(1, None), (2, ""), (3, "a bb 123")], "doc_id long, text string")).count() == 0


def test_meetings_are_compared_without_lambdas(spark):
    """A state meets every edge beside it, and Spark does not compile functions with lambdas."""
    words = spark.createDataFrame([("abcde",), ("abcdf",), ("abcdef",), ("abxdef",)], "word string")
    cuts = cut_lengths(6)
    entering, edges = spelling.trie_levels(spelling.ways(words, cuts), cuts)
    met = spelling.edited(entering(2), edges(2))
    assert "lambdafunction" not in met._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.text, r.node, r.position) for r in met.collect()} == {("abcde", ">abx", 2), ("abcdf", ">abx", 2)}
