"""The pipeline's stages on a small corpus and on odd tables."""

from __future__ import annotations

import corpus_pipeline
import pytest
from llm_cases import frame, odd_texts, words
from test_decontaminate import direct


@pytest.fixture
def folder(spark, tmp_path):
    texts = [(i, words(80, 10 + i)) for i in range(40)]
    bench = [(i, words(30, 5000 + i)) for i in range(3)]
    texts += [(100, texts[3][1]), (101, texts[4][1] + " tail"), (102, words(20, 900) + " " + bench[1][1]), (103, words(30, 901) + " token=abcdef0123456789 end"), (104, None), (105, ""), (106, "12 34 !!")]
    frame(spark, texts, clash=False).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path), texts, bench


def test_stages(spark, folder):
    path, texts, bench = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, path)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        out.write.parquet(f"{path}/{name}")
        docs = spark.read.parquet(f"{path}/{name}")
        seen[name] = {r["doc_id"]: r.asDict() for r in docs.collect()}
    assert set(seen["language_id"]) == {i for i, t in texts if t and any(c.isalpha() for c in t)}
    assert set(seen["ngram_jaccard_join"]) == set(seen["language_id"]) - {100, 101}
    assert set(seen["benchmark_decontamination"]) == {i for i, r in seen["ngram_jaccard_join"].items() if not direct(r["text"], bench)[4]} == set(seen["ngram_jaccard_join"]) - {102}
    assert seen["secret_scan"][103]["text"].endswith("[SECRET] end") and "token=" not in seen["secret_scan"][103]["text"]
    assert seen["secret_scan"][103]["n_chars"] == len(seen["secret_scan"][103]["text"])
    last = seen["bpe_encoding"]
    assert set(last) == set(seen["secret_scan"]) and all(len(r["token_ids"]) == r["n_tokens"] > 0 for r in last.values())
    assert {r["doc_id"]: r["n_tokens"] for r in corpus_pipeline.run(spark, path).collect()} == {i: r["n_tokens"] for i, r in last.items()}


def test_odd_and_empty_tables(spark, folder):
    path, _, _ = folder
    odd = frame(spark, odd_texts(), clash=False)
    for docs in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, path)
            assert out.count() <= len(odd_texts())
            assert [c for c in docs.columns if c not in out.columns] == []
