"""The stages in order, and what each keeps."""

import re

import corpus_pipeline
import public_tokenizers
from tokenizers import Tokenizer

from soldscope.llm.common import table

SMALL = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark, tmp_path):
    docs = table(spark, SMALL, "documents")
    columns = docs.columns
    rows = [docs.count()]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        if i < 4:
            assert after.columns == columns
            rows.append(after.count())
            if name == "exact_dedup":
                assert after.select("text").distinct().count() == after.count() == docs.select("text").distinct().count()
            if name == "secrets":
                texts = {r.doc_id: r.text for r in docs.collect()}
                for r in after.collect():
                    assert r.n_chars == len(r.text) and not re.search(r"[0-9a-f]{24,}|AKIA[A-Z0-9]{16,}", r.text)
                    assert r.text == texts[r.doc_id] or corpus_pipeline.MASK in r.text
            docs = after
        else:
            assert after.select("doc_id").distinct().count() == docs.count()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_duplicates", "secrets", "packing"]
    assert rows == sorted(rows, reverse=True) and rows[3] == rows[4] and rows[1] < rows[0]


def test_stages_on_odd_rows(spark, odd, nothing):
    for docs in (odd, nothing):
        for name, stage in corpus_pipeline.STAGES[1:4]:
            found = stage(spark, docs, SMALL)
            assert found.columns == docs.columns and found.count() <= docs.count()
        whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        sizes = [len(whole.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in docs.collect()]
        assert corpus_pipeline.STAGES[4][1](spark, docs, SMALL).count() == sum(-(-n // 2048) for n in sizes)
