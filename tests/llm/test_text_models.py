"""Language ID, token files and the piece codec."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from orderlake.llm import langid, queries, sp_codec, token_files

SF = "/root/testdata/sf0.001"
BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def test_language_held_out_accuracy(spark):
    out = queries.op8_language_bloom(spark, "/root/testdata/sf0.01").toPandas()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").toPandas()
    both = out.merge(docs, on="doc_id")
    assert len(out) == len(docs) and out.score.between(0, 1).all()
    assert (both.held_out == both.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)).all()
    test = both[both.held_out & both.lang.notna()]
    assert len(test) > 100 and (test.lang == test.lang_pred).mean() > 0.98


def test_language_edge_cases(spark, make_docs):
    rng = random.Random(0)
    say = lambda words, n=30: " ".join(rng.choice(words) for _ in range(n))          # noqa: E731
    a, b = ["alpha", "beta", "gamma"], ["žluť", "kůň", "příliš"]
    rows = [(k, say(a), "xa") for k in range(40)] + [(100 + k, say(b), "xb") for k in range(20)]
    odd = [(901, None, "xa"), (902, "", "xb"), (903, "12 34 !? 日"[:6], None), (904, "q", None), (905, say(b, 200_000), None),
           (906, "БГД", None), (907, say(a).upper(), "xb")]
    out = {r.doc_id: r for r in langid.identify(make_docs(rows + odd)).collect()}
    assert len(out) == 67
    assert [out[k].lang_pred for k in (901, 902, 903)] == ["und"] * 3 and out[901].score == 0
    assert out[904].lang_pred in ("xa", "xb") and out[906].lang_pred == "xa" and out[906].score == 0
    assert out[905].lang_pred == "xb" and out[907].lang_pred == "xa"
    kept = langid.keep_known(make_docs(rows + odd))
    ids = {r.doc_id for r in kept.collect()}
    assert {k for k, _, _ in rows} | {905, 907} <= ids and not ids & {901, 902, 903, 906}
    assert kept.columns == ["doc_id", "text", "lang", "source"]


def test_language_without_labels_or_rows(spark, make_docs):
    none = make_docs([(1, "abc", None), (2, None, None)])
    assert {r.lang_pred for r in langid.identify(none).collect()} == {"und"}
    assert langid.keep_known(none).count() == 2
    empty = none.filter("doc_id < 0")
    assert langid.identify(empty).count() == 0 and langid.keep_known(empty).count() == 0
    clash = make_docs([(k, "alpha beta", "xa") for k in range(12)]).withColumnRenamed("source", "score")
    assert langid.keep_known(clash).columns == clash.columns


def test_any_number_of_languages(spark, make_docs):
    """More languages than the bits of two mask words, each with words of its own."""
    rng = random.Random(6)
    words = {f"l{n:03}": ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8)) for _ in range(6)]
             for n in range(140)}
    rows = [(8 * n + k, " ".join(rng.choice(w) for _ in range(30)), lang) for n, (lang, w) in enumerate(words.items())
            for k in range(8)]
    out = {r.doc_id: r for r in langid.identify(make_docs(rows)).collect()}
    assert len(out) == len(rows) and sum(r.held_out for r in out.values()) > 100
    assert all(out[i].lang_pred == lang for i, _, lang in rows)
    assert langid.keep_known(make_docs(rows)).count() == len(rows)


def test_no_language_trains_on_nothing(spark, make_docs):
    """A language keeps a training text where its rows are many for the sample, or share an id."""
    for rows in (3000, 10**9, 4 * 10**9, 10**12):
        assert langid._limit(rows, 0, 3000) / 2**63 == pytest.approx(3000 / rows, rel=1e-6)
    rows = [(i, " ".join([w] * 9), lang) for i, w, lang in [(1, "alpha", "xa"), (2, "gamma", "xb"), (4, "zeta", "xc")]
            for _ in range(50)]
    assert not any(zlib.crc32(str(i).encode()) % 4 == 2 for i, _, _ in rows)
    model = langid.fit(make_docs(rows), train_docs=1)
    assert len(model.langs) == 3 and (model.false > 0).all()
    assert list(model.predict(["alpha alpha", "gamma", "zeta"]).lang_pred) == ["xa", "xb", "xc"]


def test_slices_of_long_texts_agree(monkeypatch):
    table = np.zeros(1 << langid.SLOT_BITS, np.uint8)
    table[::3] = 1
    table[::2] |= 2
    model, text = langid.Filter(["a", "b"], table), "Some words, über and éàü 12. " * 400
    whole = model.predict([text, "x", None])
    monkeypatch.setattr(langid, "SLICE", 1000)
    cut = model.predict([text, "x", None])
    assert (whole.lang_pred == cut.lang_pred).all() and np.allclose(whole.score, cut.score, atol=0.01)


ODD = ["", "a", " a", "  a", "a  b", "a   b", "a \n b", "a\n\n b\n", "\n", "  ", " ", "a ", "it's  I'll 'd", "x\t y\t\t z",
       "日本 語 　 a", "<|endoftext|> a", "a\u2003 b", "é à\x1c b", "1 2  3", " \n  \n", "▁", "▁a ▁▁b", "a\x00b", "𝔸 x", " " * 500 + "x",
       "ab" * 3000]


def _random_texts(seed, n=1500):
    rng = random.Random(seed)
    return ["".join(rng.choice("aeinrst  ▁'thoL1é日\n\0\t.,　𝔸") for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_pieces_are_whole_text_ids():
    coder, lib = token_files.Pieces(BPE), Tokenizer.from_file(BPE)
    lib.encode_special_tokens = True
    texts = ODD + _random_texts(1)
    want = [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in coder.ids(texts)] == want
    token_files.MEMO, before = 50, token_files.MEMO
    try:
        assert [x.tolist() for x in token_files.Pieces(BPE).ids(texts)] == want
    finally:
        token_files.MEMO = before


@pytest.mark.parametrize("n,top", [(0, 1), (1, 1), (3, 300), (4, 70_000), (1001, 1 << 25), (5000, 40)])
def test_control_byte_codec(n, top):
    ids = np.random.default_rng(n).integers(0, top, n).astype(np.uint32)
    order, control, data = token_files.encode_ids(ids)
    assert (token_files.decode_ids(order, control, data, n) == ids).all() and len(control) == -(-n // 4)
    counts = np.bincount(ids)[order] if n else np.zeros(0)
    assert (np.diff(counts) <= 0).all()                          # the most frequent first


def test_token_files(spark, make_docs, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 50)
    rows = [(k * 7 % 101, t) for k, t in enumerate(ODD)] + [(500, None), (None, "null id"), (501, "word " * 400), (501, "twin")]
    out = token_files.token_round_trip(make_docs(rows, 4), BPE).collect()
    lib = Tokenizer.from_file(BPE)
    lib.encode_special_tokens = True
    want = sorted((-1 if i is None else i, zlib.crc32(np.array(ids := lib.encode(t or "", add_special_tokens=False).ids + [2],
                                                               "<u4").tobytes()), len(ids)) for i, t in rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.ids_crc32, r.n_tokens) for r in out) == want
    at = 0
    for r in sorted(out, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    ids = [-1 if r.doc_id is None else r.doc_id for r in sorted(out, key=lambda r: r.start)]
    assert ids == sorted(ids)


def test_token_files_query_and_empty(spark, make_docs):
    assert token_files.token_round_trip(make_docs([(1, "a")]).filter("doc_id < 0"), BPE).count() == 0
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    lib, at = Tokenizer.from_file(BPE), 0
    for r, (i, t) in zip(queries.op6_ranked_token_files(spark, SF).orderBy("doc_id").collect(), docs, strict=True):
        ids = lib.encode(t or "", add_special_tokens=False).ids + [2]
        assert tuple(r)[:4] == (i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


@pytest.fixture(scope="module")
def pieces():
    return sp_codec.Model(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)


def test_codec_equals_the_library(pieces):
    own, lib = pieces
    texts = ODD + _random_texts(2)
    for t, ids in zip(texts, own.encode(texts), strict=True):
        assert ids.tolist() == lib.encode(t), repr(t)
        assert own.decode(ids) == lib.decode(ids.tolist()) == t.replace("▁", " "), repr(t)


def test_codec_forgets_and_recalls(pieces, monkeypatch):
    own, lib = pieces
    monkeypatch.setattr(sp_codec, "MEMO", 20)
    monkeypatch.setattr(sp_codec, "CHARS", 40)
    own.memo.clear()
    texts = _random_texts(3, 1200)
    assert [x.tolist() for x in own.encode(texts)] == [lib.encode(t) for t in texts]


def test_codec_query_and_tables(spark, make_docs, pieces):
    _, lib = pieces
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries.op10_suffix_array_pieces(spark, SF).collect():
        ids = lib.encode(docs[r.doc_id])
        assert (r.n_ids, r.ids_crc32, r.round_trip) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), True)
    assert sp_codec.codec_round_trip(make_docs([(1, "a")]).filter("doc_id < 0"), PIECES).count() == 0
    rows = [(1, None), (2, ""), (2, ""), (None, "a  b"), (3, "word " * 30_000)]
    out = sp_codec.codec_round_trip(make_docs(rows), PIECES).collect()
    assert len(out) == 5 and all(r.round_trip for r in out) and {r.n_ids for r in out if r.doc_id in (1, 2)} == {0}
    back = sp_codec.decode_documents(sp_codec.encode_documents(make_docs(rows), PIECES), PIECES).collect()
    assert all((r.text or "") == r.decoded for r in back)


def test_model_types_are_read():
    import sentencepiece

    proto = sentencepiece.SentencePieceProcessor(model_file=PIECES).serialized_model_proto()
    assert sp_codec.model_type(proto) == sp_codec.BPE
    assert sp_codec.model_type(b"") == 1 and sp_codec.model_type(b"\x12\x02\x18\x04") == 4


def test_wide_vocabularies(monkeypatch):
    """32-bit ids and characters give the ids that 16 bits give."""
    texts = ["Ein Text über 上, mit\nZeilen", "the  quick   brown fox", "", "▁x"]
    want = [x.tolist() for x in sp_codec.Model(PIECES).encode(texts)]
    wide = sp_codec.Model(PIECES)
    wide.kind, wide.wide = np.dtype("<u4"), np.uint32
    wide.code, wide.patterns = wide.code.astype(np.uint32), wide.patterns.astype(np.uint32)
    assert [x.tolist() for x in wide.encode(texts)] == want


def test_pieces_put_together_from_known_words(monkeypatch):
    """A known word with marks behind it isn't encoded again, and the ids are those of the whole text."""
    import public_tokenizers
    coder = token_files.Pieces(public_tokenizers.path("byte_bpe_50k.json"))
    asked, encode = [], coder._encode
    monkeypatch.setattr(coder, "_encode", lambda texts: asked.extend(texts) or encode(texts))
    texts = ["x word word, word. word.\nNext, word!? word;\nNext word", "x ça ça. don't. don't, a²., é\u0301. 上, 上午. a.b. x:\n\nA a.\n",
             "x word.\n Next word.\nNext. word.\r\nA Word,.;\nÉté:  word. \n a"]
    for k in range(2):
        asked.clear()
        for t, ids in zip(texts, coder.ids(texts), strict=True):
            assert ids.tolist() == coder.tokenizer.encode(t, add_special_tokens=False).ids, t
        if k:
            assert not asked
    asked.clear()
    again = ["x word: ça, ça;\nNext: word.\nWord,"]
    assert next(coder.ids(again)).tolist() == coder.tokenizer.encode(again[0], add_special_tokens=False).ids
    assert not any("word" in a or "ça" in a or "Next" in a for a in asked), asked
