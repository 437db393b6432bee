"""The pipeline against plain versions of its stages."""

import hashlib

import duckdb
import numpy as np
import pandas as pd
from tokenizers import Tokenizer

import corpus_pipeline
from skerry.llm.common import tokenizer_path
from skerry.llm.sql import ORACLE
from tests.llm import brute
from tests.llm.test_jaccard import brute as components


def plain(sf_dir):
    con = duckdb.connect()
    docs = con.execute(f"SELECT * FROM read_parquet('{sf_dir}/documents.parquet')").df()
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM read_parquet('{sf_dir}/benchmark.parquet')")

    def ids(name, where, table):
        con.register("documents", table)
        return {r[0] for r in con.execute(f"SELECT doc_id FROM ({ORACLE[name]}) WHERE {where}").fetchall()}

    counts = []
    docs = docs[docs.doc_id.isin(ids("op7_quality", "kept", docs))]
    counts.append(len(docs))
    texts = brute.lines_rewritten(dict(zip(docs.doc_id, docs.text)))
    counts.append(len(texts))
    first = {k for k, (_, c) in components(texts).items() if k == c}
    texts = {k: t for k, t in texts.items() if k in first}
    counts.append(len(texts))
    left = pd.DataFrame({"doc_id": list(texts), "text": list(texts.values())})
    bad = ids("op10_decontamination", "TRUE", left)
    texts = {k: t for k, t in texts.items() if k not in bad}
    counts.append(len(texts))
    return texts, counts


def test_pipeline(spark, sf_dir):
    want, counts = plain(sf_dir)
    library = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    library.no_truncation()
    library.no_padding()
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert set(got) == set(want)
    for k, text in want.items():
        ids = library.encode(text, add_special_tokens=False).ids
        assert got[k].ids_sha256 == hashlib.sha256(np.asarray(ids, dtype="<u4").tobytes()).hexdigest()
    assert counts == sorted(counts, reverse=True)


def test_stages_give_the_columns_of_documents(spark, sf_dir, documents):
    docs = documents.limit(60)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).columns == documents.columns, name
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "jaccard_join", "decontamination", "bpe_encoding"]
