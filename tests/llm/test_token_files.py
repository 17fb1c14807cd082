import zlib

import numpy as np
import pytest

from supplylake.llm.queries import tokenizer_path
from supplylake.llm.token_files import (Encoder, ShardReader, ShardWriter, read_documents, read_token_files,
                                        write_token_files)

from .cases import awkward, empty, prose


def plain(text):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = True
    return t.encode(text or "", add_special_tokens=False).ids


def test_pieces_encode_as_whole_texts():
    import pyarrow as pa
    texts = ["", "a", " a", "a ", "  a  b", "don't 'tis it's", "x\u00a0 y", "x \u00a0y", "\n\nA\nB \n C", "a.b,c!! d$$$ e",
             "日本 語\u3000テ キスト", "é.ü ñ, ß", "12 34.5 6\t7\r\n8", "<|endoftext|> end", "tab\t x", "a\n b", "a \nb", "x\u2028 y", prose(1, 400)]
    ids, cut = Encoder(tokenizer_path()).encode(pa.array(texts))
    for k, t in enumerate(texts):
        assert ids[cut[k]:cut[k + 1]].tolist() == plain(t), t


def test_round_trip_and_digests(spark, tmp_path):
    docs = awkward(spark)
    folder, shards = write_token_files(docs, tokenizer_path(), f"file://{tmp_path}/out")
    got = sorted(map(tuple, read_token_files(shards).collect()), key=lambda r: r[1])
    rows = sorted(((r.doc_id, r.text) for r in docs.collect()),
                  key=lambda r: (-1 if r[0] is None else r[0], r[1] or ""))
    start, want = 0, []
    for doc, text in rows:
        ids = np.array(plain(text) + [2], "<u4")
        want.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == want
    some = {r.doc_id: r.ids for r in read_documents(shards, [7, 12, 99]).collect()}
    assert some == {7: plain("one two") + [2], 12: plain("日本語 テキスト <|endoftext|> # 2") + [2]}


def test_empty_table(spark):
    _, shards = write_token_files(empty(spark), tokenizer_path())
    assert read_token_files(shards).count() == 0


def test_reader_opens_only_the_frames_it_needs_and_sees_damage(tmp_path):
    import zstandard
    writer = ShardWriter()
    ids = {d: np.arange(d * 3, d * 3 + 40_000, dtype=np.uint32) for d in range(6)}
    for d, x in ids.items():
        writer.document(d, x)
    data = writer.bytes()
    path = tmp_path / "s.zst"
    path.write_bytes(data)
    reader = ShardReader(str(path))
    seen = []
    plain_frame = reader.frame
    reader.frame = lambda k: seen.append(k) or plain_frame(k)
    assert (reader.get(3)[0] == ids[3]).all() and len(seen) == 1
    with zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True) as whole:
        assert whole.read(4 * 40_000) == ids[0].tobytes()
    bad = bytearray(data)
    bad[200] ^= 1
    path.write_bytes(bytes(bad))
    with pytest.raises(Exception):
        list(ShardReader(str(path)).documents())


def test_literals_of_added_tokens_are_these_tokens(spark):
    import pyarrow as pa
    from tokenizers import Tokenizer
    untouched = Tokenizer.from_file(tokenizer_path())
    end = "<|endoftext|>"
    texts = [f"a {end} b", end, f"{end}{end}", f"a  {end}  b", f" {end}", f"a\n{end}\nb", f"a \n {end}\n\n b", "a  ", "b", f"<|{end}|>",
             "<|endof", "text|>", f"x{end}y", f"\u00a0{end}\u3000z", f"  {end}a", "c   ", f"{end} end", prose(1, 300)]
    ids, cut = Encoder(tokenizer_path(), added=True).encode(pa.array(texts))
    for k, t in enumerate(texts):
        assert ids[cut[k]:cut[k + 1]].tolist() == untouched.encode(t, add_special_tokens=False).ids, t
    assert ids[:4].tolist() == [64, 220, 50256, 275]
    _, shards = write_token_files(awkward(spark), tokenizer_path(), added=True)
    got = {r.doc_id: r.ids for r in read_documents(shards, [12]).collect()}
    assert got[12] == untouched.encode("日本語 テキスト <|endoftext|> # 2", add_special_tokens=False).ids + [2]


def test_rows_of_one_id_are_dealt_to_several_shards(spark):
    """A third of the rows with null ids and equal texts, and many of one id."""
    from collections import Counter
    rows = [(None, "same text again")] * 400 + [(7, f"text {k % 5}") for k in range(400)] + [(k, f"own {k}") for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    _, shards = write_token_files(docs, tokenizer_path())
    assert max(r.documents for r in shards.collect()) < 300
    got = sorted(map(tuple, read_token_files(shards).collect()), key=lambda r: r[1])
    sizes = Counter((d, zlib.crc32(np.array(plain(t) + [2], "<u4").tobytes())) for d, t in rows)
    assert Counter((d, crc) for d, _, _, crc in got) == sizes
    assert [d is None for d, *_ in got] == sorted((d is None for d, _ in rows), reverse=True)
    assert [d for d, *_ in got if d is not None] == sorted(d for d, _ in rows if d is not None)
    assert all(b[1] == a[1] + a[2] for a, b in zip(got, got[1:]))
    assert len({crc for d, _, _, crc in got if d == 7}) == 6


def test_frames_leave_the_writer_as_they_close():
    out = []
    writer = ShardWriter(out.append)
    for d in range(4):
        writer.document(d, np.arange(50_000, dtype=np.uint32))
        assert writer.held <= 50_000 and len(out) == d
    writer.finish()
    assert not writer.kept and len(out) == 6
