"""The pipeline on a small corpus with one case for every decision."""

import pytest
import sentencepiece

import corpus_pipeline
from tarmac.llm import pieces

LANGUAGES = {
    "en": "the house and the garden were old but the people in the town liked them very much and went there ",
    "de": "das alte haus und der garten waren sehr klein aber die leute in der stadt mochten sie und gingen oft hin ",
}


@pytest.fixture
def corpus(spark, tmp_path):
    rows = [(i, f"{LANGUAGES[lang]} {' '.join(f'{lang}{(i * 37 + k) % 1009}x' for k in range(60))}", lang)
            for i in range(40) for lang in [("en", "de")[i % 2]]]
    item = " ".join(f"question{k}" for k in range(16))
    rows += [
        (100, rows[0][1], "en"), (101, rows[0][1] + " more", "en"),       # copies of 0
        (102, None, "en"), (103, "", None), (104, "12345 !!!", "en"),     # no language
        (105, LANGUAGES["en"] + item, "en"),                              # holds the benchmark item
        (106, LANGUAGES["de"] + "password=abcdefgh123 sonst nichts", "de"),
    ]
    frame = spark.createDataFrame(
        [(i, t, lang, "s", len(t or "")) for i, t, lang in rows],
        "doc_id bigint, text string, lang string, source string, n_chars bigint")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item), (2, None)], "item_id bigint, text string").write.parquet(
        str(tmp_path / "benchmark.parquet"))
    return str(tmp_path), {i: t for i, t, _ in rows}


def test_pipeline(spark, corpus):
    path, texts = corpus
    kept = {r.doc_id: r for r in corpus_pipeline.run(spark, path).collect()}
    assert set(kept) == {*range(40), 106}
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    texts[106] = texts[106].replace("password=abcdefgh123", "[SECRET]")
    for i, row in kept.items():
        assert list(row.ids) == library.encode(texts[i], add_eos=True) and row.n_tokens == len(row.ids)
        assert row.round_trip and row.n_chars == len(texts[i])


def test_stages_return_the_columns_of_documents(spark, corpus):
    path, _ = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, path).columns == docs.columns
        assert stage(spark, docs.limit(0), path).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), path).count() == 0


def test_language_stage_decides(spark, corpus):
    """A text of random letters goes; labelled documents, short and mixed ones stay."""
    path, texts = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet")
    rows = [(200, "qzx wvk jqp xkz vqj zzx kwq pxv jjk qwx zvk " * 3), (201, "the old house"),
            (202, LANGUAGES["en"] + LANGUAGES["de"])]
    more = spark.createDataFrame([(i, t, None, "s", len(t)) for i, t in rows], docs.schema)
    kept = {r.doc_id for r in corpus_pipeline.language(spark, docs.unionByName(more), path).collect()}
    assert kept == {*texts, 201, 202} - {102, 103, 104}
