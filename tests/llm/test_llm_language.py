from zlib import crc32

import zstandard

from tidemark.llm import language_zstd as z


def test_edges(docs_of, edge_rows):
    df = docs_of(edge_rows)
    dictionaries = z.learn(df)
    assert set(dictionaries) == {lang for _, t, lang, _ in edge_rows if lang and t}
    rows = z.identify(df, dictionaries).collect()
    assert len(rows) == len(edge_rows)
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred in dictionaries) == letters and 0 <= r.score <= 1
        if not letters:
            assert r.lang_pred == "und" and r.score == 0
    assert "n_chars" in rows[0].asDict() and rows[0]["key"] == "x"


def test_nothing_learned(docs_of, edge_rows):
    assert z.learn(docs_of([])) == {}
    rows = z.identify(docs_of(edge_rows), {}).collect()
    assert {r.lang_pred for r in rows} == {"und"}
    assert z.identify(docs_of([]), {"en": b"abc"}).count() == 0


def test_ties_go_to_the_first_language():
    classifier = z.Classifier({"b": b"same words here", "a": b"same words here"})
    lang, score, rejected = classifier.classify("same words here")
    assert (lang, score, rejected) == ("a", 0.5, True)


def test_held_out_accuracy_and_reruns(spark):
    sf = "/root/testdata/sf0.01"
    rows = z.op10_language_zstd(spark, sf).collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert sorted(rows) == sorted(z.op10_language_zstd(spark, sf).collect())


def test_sizes_by_hand(spark):
    """Every prediction again, with dictionaries and a compressor set up here."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    dictionaries = z.learn(docs.where("crc32(CAST(doc_id AS STRING)) % 4 <> 2"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    tools = {
        lang: zstandard.ZstdCompressor(
            level=z.LEVEL, write_content_size=False, write_dict_id=False,
            dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT))
        for lang, content in dictionaries.items()}
    for r in z.op10_language_zstd(spark, sf).collect():
        text = texts[r.doc_id]
        if not any(c.isalpha() for c in text or ""):
            assert r.lang_pred == "und"
            continue
        sizes = {lang: len(tool.compress(text.lower().encode())) for lang, tool in tools.items()}
        least = min(sizes.values())
        # a prepared dictionary may choose other matches by a few bytes
        assert sizes[r.lang_pred] <= least + 8 and abs(len(sizes) - len(dictionaries)) == 0


def test_more_languages_than_are_learned(docs_of, monkeypatch):
    monkeypatch.setattr(z, "MOST_LANGUAGES", 2)
    rows = [(i, f"some text {i} of a language", f"l{i % 5}" if i < 20 else "l3", "s") for i in range(60)]
    assert set(z.learn(docs_of(rows))) == {"l0", "l3"}


def test_copies_and_long_texts_do_not_fill_a_dictionary(docs_of, monkeypatch):
    """A third of the rows is one text: its pieces come once. A text of 2 MB gives some pieces, not all of them."""
    monkeypatch.setattr(z, "SAMPLE_PIECES", 50)
    rows = [(i, "copied words " * 40 if i % 3 == 0 else f"words of their own {i} " * 20, "en", "s") for i in range(120)]
    rows.append((500, "".join(f"long {i} " for i in range(250_000)), "en", "s"))
    content = z.learn(docs_of(rows))["en"]
    assert content.count(b"copied words " * 20) <= 1
    assert len(content) <= 50 * z.PIECE_BYTES and b"long " in content
