import hashlib
import random

import pytest
import sentencepiece

from tidemark.llm import pieces

MODEL = pieces.model_bytes()
LIBRARY = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
TEXTS = [
    "", " ", "a  b", "  a ", "\n", "a\x00b", "é▁x", "▁", "▁▁ x", "<s> </s> <0x0A>", "日本語テキスト", "\t\ta", "😀",
    "x" * 3000, " " * 50, "a" + " " * 17 + "b", "aaab" * 500, "\r\n  \r", "naïvé ▁▁a ▁", "a b",
]


def random_texts():
    rng = random.Random(3)
    mixed = ["".join(rng.choice(" ▁abthe \n日😀é\x00") for _ in range(rng.randint(0, 60))) for _ in range(500)]
    return mixed + ["".join(rng.choice("abthernigso") for _ in range(rng.randint(0, 90))) for _ in range(200)]


def test_ids_and_text_equal_the_library():
    encoder = pieces.Encoder(MODEL)
    for text in TEXTS + random_texts():
        cuts = pieces.cuts_of(text)
        encoder.learn([cuts])
        ids = [i for cut in cuts for i in encoder.kept[cut][0]] + [encoder.vocabulary.end]
        assert ids == LIBRARY.encode(text, add_eos=True)
        assert encoder.vocabulary.decode(ids) == LIBRARY.decode(ids)


def test_heap_and_matrix_agendas_agree():
    vocabulary = pieces.Vocabulary(MODEL)
    cuts = [cut for text in TEXTS + random_texts() for cut in pieces.cuts_of(text)]
    assert vocabulary.encode_cuts(cuts) == [vocabulary.encode_cut(cut) for cut in cuts]


def test_a_difference_to_the_library_is_an_error(monkeypatch):
    encoder = pieces.Encoder(MODEL)
    monkeypatch.setattr(encoder.vocabulary, "encode_cuts", lambda cuts: [[5]] * len(cuts))
    with pytest.raises(ValueError, match="differ"):
        encoder.learn([pieces.cuts_of("hello")])


def test_edges(docs_of, edge_rows):
    df = docs_of(edge_rows)
    encoded = pieces.encode(df, MODEL)
    rows = encoded.collect()
    want = sorted((str(i), tuple(LIBRARY.encode(t or "", add_eos=True))) for i, t, *_ in edge_rows)
    assert sorted((str(r.doc_id), tuple(r.ids)) for r in rows) == want
    for r in rows:
        assert r.n_tokens == len(r.ids) and r.decoded == LIBRARY.decode(r.ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, r.ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()
    back = {(str(r.doc_id), r.text) for r in pieces.decode(encoded, MODEL).collect()}
    assert back == {(str(r.doc_id), r.decoded) for r in rows}


def test_decode_of_nothing(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [2])], "doc_id long, ids array<int>")
    assert [r.text for r in pieces.decode(df, MODEL).collect()] == ["", "", ""]


def test_empty_table(docs_of):
    assert pieces.encode(docs_of([]), MODEL).count() == 0


def test_query(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in pieces.op9_sentencepiece(spark, sf).collect():
        ids = LIBRARY.encode(texts[r.doc_id] or "", add_eos=True)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()
