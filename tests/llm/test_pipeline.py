"""The corpus pipeline: every stage on its predecessor's rows, edges included."""

import corpus_pipeline as P
import edge
from marketlake.llm import rules
from tokenizers import Tokenizer

from marketlake.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_and_their_columns(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["quality rules", "line dedup", "near duplicates", "benchmark decontamination", "tokens"]
    for k, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, "/root/testdata/sf0.001")
        before = docs
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        assert 0 < docs.count() <= before.count()
        assert {r.doc_id for r in docs.collect()} <= {r.doc_id for r in before.collect()}
        if k < 4:
            assert docs.columns == COLUMNS
        if name == "quality rules":
            assert docs.count() == rules.ledger(before).filter(rules.passes("v1")).count()
    library = Tokenizer.from_file(tokenizer_path())
    for r in docs.collect():
        texts = {x.doc_id: x.text for x in before.collect()}
        assert r.n_tokens == len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)


def test_awkward_documents_and_no_documents(spark):
    for docs in (edge.edge_docs(spark), edge.empty_docs(spark)):
        docs = docs.select(*COLUMNS)
        for _, stage in P.STAGES:
            out = stage(spark, docs, "/root/testdata/sf0.001")
            assert out.count() <= docs.count()
