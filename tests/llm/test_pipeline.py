"""The pipeline against a plain computation, and what each stage hands on."""

import public_tokenizers

import corpus_pipeline as pipeline
from caretide.llm import bpe, decontaminate, langid, pii
from tests.llm.conftest import SF_DIR
from tests.llm.test_simhash import brute_fingerprint, roots


def test_stages_hand_on_the_columns_of_documents(spark, docs, none):
    for name, stage in pipeline.STAGES:
        empty = stage(spark, none, SF_DIR)
        assert empty.collect() == []
        if name != pipeline.STAGES[-1][0]:
            assert tuple(stage(spark, docs, SF_DIR).columns) == pipeline.COLUMNS


def test_rejected_documents_go(spark, docs, rows):
    kept = pipeline.identify_language(spark, docs, SF_DIR).collect()
    with_letters = [t for _, t in rows if any(c.isalpha() for c in t or "")]
    assert sorted(r.text for r in kept) == sorted(with_letters)


def test_whole_pipeline(spark, documents):
    """Every decision made anew in plain Python; the language model is the operator's."""
    got = {r.doc_id: r for r in pipeline.run(spark, SF_DIR).collect()}
    rows = {r.doc_id: r.text for r in documents.collect()}
    model = langid.fit(documents.where(~langid.held_out()))
    named = langid.predict(documents, model, "doc_id").collect()
    kept = sorted(r.doc_id for r in named if r.lang_pred != "und")

    fps = {d: brute_fingerprint(rows[d]) for d in kept}
    near = [(a, b) for a in kept for b in kept if a < b and (fps[a] ^ fps[b]).bit_count() <= 3]
    root = roots(kept, near)
    kept = [d for d in kept if root[d] == d]

    windows = set()
    for item in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect():
        words = decontaminate.words(item.text)
        size = min(10, len(words))
        windows |= {tuple(words[i:i + size]) for i in range(len(words) - size + 1) if words}
    sizes = {len(w) for w in windows}

    def clean(text):
        words = decontaminate.words(text)
        return not any(tuple(words[i:i + n]) in windows
                       for n in sizes for i in range(len(words) - n + 1))

    kept = [d for d in kept if clean(rows[d])]
    assert sorted(got) == kept and len(kept) < len(rows)
    encoding = bpe.tokenizer(
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    for d in kept:
        assert not pii.base_spans(got[d].decoded)
        assert got[d].ids == encoding.encode_ordinary(got[d].decoded)
        if not pii.base_spans(rows[d]) and not pii.loose_spans(rows[d]):
            assert got[d].decoded == rows[d]
