"""The registered queries on the smallest tables, against brute force, libraries or DuckDB."""

import hashlib
import html
import re
import sys
import zlib
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from seasonlab.llm import queries as q  # noqa: E402
from seasonlab.llm.bpe import ByteBPE  # noqa: E402
from seasonlab.llm.lang_id import held_out, identify  # noqa: E402
from seasonlab.llm.oracles import ORACLES  # noqa: E402
from seasonlab.llm.packing import pack_documents  # noqa: E402


def table(sf, name, columns):
    return duckdb.sql(f"SELECT {columns} FROM '{sf}/{name}.parquet'").fetchall()


def result(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_op1_takes_the_article(spark, sf_small):
    got = {r["page_id"]: r for r in q.op1_html_extract(spark, sf_small).collect()}
    for page_id, page in table(sf_small, "pages", "page_id, html"):
        article = re.sub(r"</?(b|i|em|strong|a|span)\b[^>]*>", "", re.search(r"<article>(.*?)</article>", page, re.S)[1])
        expected = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", article)).split())
        assert got[page_id]["text"] == expected and got[page_id]["n_chars"] == len(expected)


def test_op2_matches_brute_force(spark, sf_small):
    rows = table(sf_small, "embeddings", "vec_id, embedding, label")
    assert result(q.op2_embedding_dedup(spark, sf_small), "vec_id", "n_links", "component_id", "kept") == brute.near_vectors(rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, sf_small, name):
    con = duckdb.connect()
    for t in ("conversations", "pages", "embeddings", "documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_small}/{t}.parquet'")
    relation = con.sql(ORACLES[name])
    columns = sorted(relation.columns)
    df = q.QUERIES[name](spark, sf_small)
    assert sorted(df.columns) == columns
    order = [relation.columns.index(c) for c in columns]
    assert sorted(map(repr, (tuple(r[c] for c in columns) for r in df.collect()))) == sorted(repr(tuple(r[i] for i in order)) for r in relation.fetchall())


def test_op4_matches_the_library(spark, sf_small):
    ranks = ByteBPE.load(q.BPE_RANKS, q.BPE_PATTERN).ranks
    library = tiktoken.Encoding("own", pat_str=q.BPE_PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r["doc_id"]: r for r in q.op4_byte_bpe(spark, sf_small).collect()}
    for doc_id, text in table(sf_small, "documents", "doc_id, text"):
        ids = library.encode_ordinary(text or "")
        assert got[doc_id]["n_tokens"] == len(ids)
        assert got[doc_id]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[doc_id]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_op5_cuts_and_packs_every_id(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").repartition(5)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = {d: [*library.encode(t or "", add_special_tokens=False).ids, 1] for d, t in table(sf_small, "documents", "doc_id, text")}
    pieces = [r.asDict() for r in pack_documents(docs, q.WORD_BPE).collect()]
    assert brute.check_packing(pieces, expected, 2048) < 0.01
    for r in q.op5_packing(spark, sf_small).collect():
        ids = np.array(expected[r["doc_id"]][r["start"] : r["start"] + r["length"]], "<u4")
        assert r["ids_crc32"] == zlib.crc32(ids.tobytes())


def test_op6_matches_brute_force(spark, sf_small):
    docs = table(sf_small, "documents", "doc_id, text")
    assert result(q.op6_substring_dedup(spark, sf_small), "doc_id", "n_words", "n_removed", "kept_sha256") == brute.without_repeats(docs)


def test_op7_matches_brute_force(spark, sf_small):
    docs = table(sf_small, "documents", "doc_id, text")
    assert result(q.op7_minhash_dedup(spark, sf_small), "doc_id", "class_id", "kept") == brute.near_texts(docs)


def test_op8_matches_brute_force(spark, sf_small):
    rows = table(sf_small, "embeddings", "vec_id, embedding, label")
    assert result(q.op8_exact_topk(spark, sf_small), "query_id", "rank", "vec_id", "score") == brute.top_products(rows)


def test_op9_is_right_on_held_out_rows(spark, sf_small):
    lang = dict(table(sf_small, "documents", "doc_id, lang"))
    rows = q.op9_language_id(spark, sf_small).collect()
    assert len(rows) == len(lang) and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    own = [r for r in rows if r["held_out"] and lang[r["doc_id"]] is not None]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in own) >= 0.95 * len(own)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_op9_rejects_a_language_left_out_of_the_fit(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").where(F.col("text").rlike(r"\p{L}") & F.col("lang").isNotNull())
    long = docs.where(held_out("doc_id") & (F.length("text") >= 200))
    for out in ("de", "en", "es", "fr"):
        rows = identify(long, q.fit_languages(docs.where(F.col("lang") != out)), keep=[F.col("lang")]).collect()
        other, own = [r["accepted"] for r in rows if r["lang"] == out], [r["accepted"] for r in rows if r["lang"] != out]
        assert other and sum(other) <= 0.05 * len(other) and sum(own) >= 0.98 * len(own)


def test_pipeline_matches_brute_force(spark, sf_small, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    columns, before = docs.columns, None
    for name, stage in corpus_pipeline.STAGES:
        before = [(r["doc_id"], r["text"]) for r in docs.collect()] if "text" in docs.columns else None
        out = str(tmp_path / name.replace(" ", "-"))
        stage(spark, docs, sf_small).write.parquet(out)
        docs = spark.read.parquet(out)
        if name != "packing":
            assert docs.columns == columns
        if name == "MinHash near-dedup":
            assert sorted(r["doc_id"] for r in docs.collect()) == [d for d, _, kept in brute.near_texts(before) if kept]
        if name == "substring dedup":
            want = {d: (n, digest) for d, _, n, digest in brute.without_repeats(before)}
            for r in docs.collect():
                lost, digest = want[r["doc_id"]]
                if lost:
                    assert hashlib.sha256(r["text"].encode()).hexdigest() == digest and r["n_chars"] == len(r["text"])
                else:
                    assert r["text"] == dict(before)[r["doc_id"]]
    assert {"doc_id", "sequence_id", "offset", "length"} <= set(docs.columns)
