import io
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from bandwatch.llm import packing, token_files, token_lengths
from bandwatch.llm.tokenizing import BYTE_BPE, WORD_BPE, TextEncoder, vocabulary

CODERS = {name: TextEncoder(vocabulary(name), 50) for name in (BYTE_BPE, WORD_BPE)}
DOCS = "doc_id long, text string, start string, ids string, row string"


def whole(name, text):
    t = Tokenizer.from_file(vocabulary(name))
    t.encode_special_tokens = True
    return t.encode(text, add_special_tokens=False).ids


REAL = {name: Tokenizer.from_file(vocabulary(name)) for name in CODERS}
for t in REAL.values():
    t.encode_special_tokens = True


@pytest.mark.parametrize("name", list(CODERS))
@settings(max_examples=600, deadline=None)
@given(text=st.text(st.sampled_from(list("aZé ÉßİΣσ\n\n  .,|'s\t\r\x0b\x1c\xa0 ́​1９½_-#漢字ªº😀<endoftext>")), max_size=40))
def test_cached_words_give_the_ids_of_whole_texts(name, text):
    assert np.frombuffer(CODERS[name].encode(text), "<u4").tolist() == REAL[name].encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", list(CODERS))
def test_real_texts(spark, name):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    for text, e in zip(texts, REAL[name].encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(CODERS[name].encode(text), "<u4").tolist() == e.ids


PLAIN = {name: Tokenizer.from_file(vocabulary(name)) for name in CODERS}  # as the library gives it, no flag set
PARTS = ["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|", "|>", "a", " ", "\n", "  ", "é", "it's", "1.", "endoftext"]


@pytest.mark.parametrize("name", list(CODERS))
@settings(max_examples=400, deadline=None)
@given(text=st.lists(st.sampled_from(PARTS), max_size=12).map("".join))
def test_added_tokens_are_those_of_the_untouched_tokenizer(name, text):
    assert np.frombuffer(CODERS[name].encode(text), "<u4").tolist() == PLAIN[name].encode(text, add_special_tokens=False).ids


def test_added_tokens_in_the_operators(spark):
    docs = spark.createDataFrame([(1, "a <|endoftext|> b"), (2, "c <|startoftext|>d"), (3, "e")], "doc_id long, text string")
    assert PLAIN[BYTE_BPE].encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    ids = {name: {r.doc_id: t.encode(r.text, add_special_tokens=False).ids for r in docs.collect()} for name, t in PLAIN.items()}
    start, want = 0, []
    for doc_id, found in sorted(ids[BYTE_BPE].items()):
        want.append((doc_id, start, len(found) + 1, [*found, 0]))
        start += len(found) + 1
    got = token_files.read_token_files(token_files.write_token_files(docs)).collect()
    assert sorted(map(tuple, got)) == want
    counts = sorted(n for r in token_lengths.token_counts(docs).collect() for n in [r.length] * r.n_docs)
    assert counts == sorted(map(len, ids[BYTE_BPE].values()))
    packed = {r.doc_id: r.ids for r in packing.pack(docs, size=64).collect()}
    assert packed == {k: [*v, 2] for k, v in ids[WORD_BPE].items()}


@pytest.mark.parametrize("name", list(CODERS))
@settings(max_examples=200, deadline=None)
@given(texts=st.lists(st.none() | st.text(st.sampled_from(list("abZé \n\n .,)|'s\t\r\x1c\xa0\u2003１9漢😀")), max_size=20), max_size=12))
def test_texts_of_a_lot_keep_their_own_ids(name, texts):
    import pyarrow as pa

    for kind in (pa.string(), pa.large_string()):
        got = CODERS[name].encode_all(pa.array([*texts, "x"], kind).slice(0, len(texts)))
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == [REAL[name].encode(t or "", add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("name", list(CODERS))
def test_a_word_is_looked_up_once_a_lot(name, monkeypatch):
    """The time of a text follows from its distinct words, without marks after them; large texts come alone."""
    import pyarrow as pa

    from bandwatch.llm import tokenizing

    code, asked = TextEncoder(vocabulary(name)), []
    lots, lot = [], code._lot
    monkeypatch.setattr(code, "_lot", lambda texts: lots.append(len(texts)) or lot(texts))
    monkeypatch.setattr(code.stems, "encode", lambda word: asked.append(word) or code._stem(word))
    text = " ".join(["so word, word. word; word"] * 500)
    got = code.encode_all(pa.array([text] * 5))
    assert len(asked) == len(set(asked)) <= 3 and lots == [5]  # the first word differs
    assert all(np.frombuffer(x, "<u4").tolist() == REAL[name].encode(text, add_special_tokens=False).ids for x in got)
    lots.clear()
    monkeypatch.setattr(tokenizing, "LOT_BYTES", 2 * len(text))
    assert code.encode_all(pa.array(["a", text * 3, text, text, text])) == [code.encode(t) for t in ("a", text * 3, text, text, text)]
    assert lots[:4] == [1, 1, 2, 1]


def odd_documents(spark):
    rows = [(5, "one two three", "x", "y", "z"), (None, "no id", None, None, None), (2, None, "", "", ""), (3, "", "", "", ""),
            (2, "again two", "", "", ""), (5, "one two three", "x", "y", "z"), (9, "long word " * 30_000, "", "", ""),
            (-4, "first", "", "", "")]
    return spark.createDataFrame(rows, DOCS)


def brute_tokens(rows, name, end):
    return [(r.doc_id, [*REAL[name].encode(r.text or "", add_special_tokens=False).ids, end]) for r in rows]


def test_token_files_round_trip(spark):
    docs = odd_documents(spark)
    key = lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or "")
    want, start = [], 0
    for doc_id, ids in brute_tokens(sorted(docs.collect(), key=key), BYTE_BPE, 0):
        want.append((doc_id, start, len(ids), ids))
        start += len(ids)
    manifest = token_files.write_token_files(docs)
    got = [tuple(r) for r in token_files.read_token_files(manifest).collect()]
    assert sorted(got, key=lambda r: r[1]) == want
    some = {(r.doc_id, r.start) for r in token_files.read_token_files(manifest, doc_ids=[9, 2]).collect()}
    assert some == {(d, s) for d, s, _, _ in want if d in (9, 2)}
    crc = {r.start: r.ids_crc32 for r in token_files.read_token_files(manifest, digest=True).collect()}
    assert crc == {s: zlib.crc32(np.array(i, "<u4").tobytes()) for _, s, _, i in want}


def test_token_files_of_nothing(spark):
    manifest = token_files.write_token_files(spark.createDataFrame([], DOCS))
    assert manifest.count() == 0 and token_files.read_token_files(manifest).count() == 0


def test_a_damaged_frame_is_found_and_others_are_read():
    out = io.BytesIO()
    writer = token_files.TokenFileWriter(out, 2)
    for i in range(3):
        writer.add(i, np.arange(100 + i))
    writer.finish()
    raw = bytearray(out.getvalue())
    reader = token_files.TokenFileReader(io.BytesIO(raw), len(raw))
    raw[int(reader.places[1]) + 12] ^= 255
    reader = token_files.TokenFileReader(io.BytesIO(raw), len(raw))
    assert reader.tokens(0).tolist() == list(range(100)) and reader.tokens(2).tolist() == list(range(102))
    with pytest.raises(Exception):
        reader.tokens(1)


def test_length_table(spark):
    lengths = [0, 3, 3, 5000, 1024, 1023, 2, 0, 70_000]
    frame = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)] + [(99, None)], "doc_id long, n_tokens long")
    table = token_lengths.length_table(frame)
    got = {r.length: r for r in table.collect()}
    assert set(got) == set(lengths)
    for n, r in got.items():
        assert r.n_docs == lengths.count(n)
        assert (r.n_docs_from, r.n_tokens_from) == (sum(x >= n for x in lengths), sum(x for x in lengths if x >= n))
        assert (r.n_docs_upto, r.n_tokens_upto) == (sum(x <= n for x in lengths), sum(x for x in lengths if x <= n))
        assert r.truncated_tokens == sum(min(x, n) for x in lengths) and r.share_upto == pytest.approx(r.n_docs_upto / len(lengths))
    for limit in (0, 1, 4, 999, 10**6):
        assert token_lengths.truncated_at(table, limit).first()[0] == sum(min(x, limit) for x in lengths)
    assert token_lengths.token_counts(spark.createDataFrame([], DOCS)).count() == 0


def test_token_counts_by_brute_force(spark):
    docs = odd_documents(spark)
    want = sorted(len(i) - 1 for _, i in brute_tokens(docs.collect(), BYTE_BPE, 0))
    got = sorted(n for r in token_lengths.token_counts(docs).collect() for n in [r.length] * r.n_docs)
    assert got == want


def test_packing_puts_every_id_in_one_piece(spark):
    docs = odd_documents(spark)
    want = sorted(((d is not None, d or 0, i) for d, i in brute_tokens(docs.collect(), WORD_BPE, 2)))
    pieces = packing.pack(docs, size=64).collect()
    by_place = sorted(pieces, key=lambda r: (r.sequence_id, r.offset))
    filled = {}
    for r in by_place:
        assert r.offset == filled.get(r.sequence_id, 0) and len(r.ids) == r.length
        filled[r.sequence_id] = r.offset + r.length
    assert sorted(filled) == list(range(len(filled))) and all(filled[s] == 64 for s in list(filled)[:-1])
    docs_back, open_doc = [], []
    for r in by_place:
        assert r.start == len(open_doc)
        open_doc += r.ids
        if len(open_doc) == r.doc_tokens:
            docs_back.append((r.doc_id is not None, r.doc_id or 0, open_doc))
            open_doc = []
    assert sorted(docs_back) == want and not open_doc
    assert packing.pack(spark.createDataFrame([], DOCS)).count() == 0


def test_hilbert_keys_visit_neighbours():
    bits, n = 3, 3
    cells = np.stack(np.meshgrid(*[np.arange(8)] * n), -1).reshape(-1, n)
    keys = packing.hilbert_keys(cells, bits)
    path = cells[np.argsort(keys)]
    assert sorted(keys.tolist()) == list(range(8**n)) and (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_neighbours_on_the_curve_share_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = packing.encoded(docs, vocabulary(WORD_BPE), 2).join(docs.select("doc_id", "lang"), "doc_id").orderBy("key").select("lang").collect()
    same = np.mean([a.lang == b.lang for a, b in zip(rows, rows[1:])])
    chance = sum((n / len(rows)) ** 2 for n in (sum(r.lang == x for r in rows) for x in {r.lang for r in rows}))
    assert same > chance + 0.2


def test_queries_equal_brute_force(spark):
    from bandwatch.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.001"
    docs = sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").collect(), key=lambda r: r.doc_id)
    start, want = 0, []
    for doc_id, ids in brute_tokens(docs, BYTE_BPE, 0):
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = QUERIES["op3_token_files"](spark, sf_dir).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == want
    lengths = sorted(n - 1 for _, _, n, _ in want)
    got = QUERIES["op6_token_counts"](spark, sf_dir).collect()
    assert sorted(n for r in got for n in [r.length] * r.n_docs) == lengths
    ids = dict(brute_tokens(docs, WORD_BPE, 2))
    pieces = QUERIES["op7_packing"](spark, sf_dir).collect()
    filled = {}
    for r in sorted(pieces, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled.get(r.sequence_id, 0) and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id][r.start:r.start + r.length], "<u4").tobytes())
        filled[r.sequence_id] = r.offset + r.length
    covered = sorted((r.doc_id, r.start, r.length) for r in pieces)
    assert sum(n for _, _, n in covered) == sum(map(len, ids.values())) and max(filled.values()) <= 4096
    assert [n for _, n in sorted(filled.items())][:-1] == [4096] * (len(filled) - 1)


def test_packing_gets_its_texts_in_small_batches(spark):
    from bandwatch.llm.stage import BATCH_BYTES

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.unset(name)
        packing.pack(odd_documents(spark))
        assert spark.conf.get(name) == str(BATCH_BYTES)
    finally:
        spark.conf.set(name, before)
