import random

import corpus_pipeline
from supplylake.llm.mixing import mix_sources, repeated_by_mix
from supplylake.llm.queries import tokenizer_path
from supplylake.llm.token_files import Encoder

from .cases import SCHEMA, awkward, empty, prose
from .test_ngram_join import edit
from .test_toxicity import BAD


def corpus(spark, path):
    rng = random.Random(12)
    rows, labels = [], []
    item = prose(4000, 18)
    for i in range(360):
        words = prose(i, rng.randint(20, 90)).split()
        toxic = i % 6 == 0
        if toxic:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
        text = " ".join(words)
        if i % 15 == 7:
            text = f"{text} {item}"
        rows.append((i, text, "en", f"s{i % 3}", len(text)))
        if i % 2 == 0:
            labels.append((i, 1, int(toxic)))
    rows += [(400 + k, edit(rng, rows[k][1], 1), "en", "s1", 9) for k in range(1, 40) if len(rows[k][1].split()) > 60]
    rows += [(3, rows[3][1], "en", "s0", 5), (900, None, None, None, None), (901, "", "en", None, 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")


def test_every_stage_takes_effect(spark, tmp_path):
    corpus(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "tokens"]
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/out{k}")
        docs = spark.read.parquet(f"{tmp_path}/out{k}")
        kept[name] = [r.doc_id for r in docs.select("doc_id").collect()]
        assert name == "tokens" or docs.columns == columns
    clean = {i for i in range(360) if i % 6}
    assert sum(i % 6 == 0 and i < 360 for i in kept["toxicity"]) <= 2 and clean <= set(kept["toxicity"])
    alive = set(kept["near_duplicates"])
    assert len(kept["near_duplicates"]) == len(alive) and clean <= alive and sum(400 < i < 900 for i in alive) <= 2
    assert {900, 901} <= alive
    assert all(i % 15 != 7 for i in kept["decontamination"]) and {i for i in clean if i % 15 != 7} <= set(kept["decontamination"])
    mixed = spark.read.parquet(f"{tmp_path}/out3")
    before = spark.read.parquet(f"{tmp_path}/out2")
    want = {r.doc_id: r.copies for r in mix_sources(before).collect() if r.copies and r.size}
    times = {i: kept["mixing"].count(i) for i in set(kept["mixing"])}
    assert times == want and max(times.values()) <= 3
    assert sorted(kept["tokens"]) == sorted(kept["mixing"])
    encoder = Encoder(tokenizer_path())
    size = {r.doc_id: len(encoder.tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in mixed.collect()}
    got = spark.read.parquet(f"{tmp_path}/out4").collect()
    assert all(r.n_tokens == size[r.doc_id] for r in got)
    end = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == end
        end += r.n_tokens
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, got))


def test_awkward_and_empty_tables(spark, tmp_path):
    spark.createDataFrame([(0, 1, 1), (5, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(0, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (awkward(spark), empty(spark)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(tmp_path))
            assert docs.columns == [c.split()[0] for c in SCHEMA.split(", ")]
        stage(spark, docs, str(tmp_path)).count()


def test_repeated_rows_share_their_copies(spark):
    rows = [(1, "a b c", None, "s", None, None, None, None, None)] * 5 + [(2, "d e", None, "s", None, None, None, None, None)]
    docs = awkward(spark, rows)
    got = sorted(r.doc_id for r in repeated_by_mix(docs, weights=(1.0,), share=1.6).collect())
    want = sorted(r.doc_id for r in mix_sources(docs, weights=(1.0,), share=1.6).collect() for _ in range(r.copies))
    assert got == want
