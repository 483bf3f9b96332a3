"""Token-id files against the tokenizers library: layout, dictionary, round trip, short reads and edge cases."""

import hashlib
import zlib

import numpy as np
import pytest

from jobloom.llm import queries, token_files

P = pytest.importorskip("public_tokenizers")
RANKS = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def encode():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    return lambda text: [*tok.encode(text or "", add_special_tokens=False).ids, 0]


def digest(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def check(spark, docs, got, encode):
    want = sorted(((r.doc_id is not None, r.doc_id or 0, len(ids), digest(ids)) for r in docs.select("doc_id", "text").collect() for ids in [encode(r.text)]))
    rows = sorted(got.collect(), key=lambda r: r.start)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in rows) == want
    assert [(r.doc_id is not None, r.doc_id or 0) for r in rows] == [w[:2] for w in want]  # ascending
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens


def test_registered_query(spark, docs, encode):
    check(spark, docs, queries.op13_token_files(spark, "/root/testdata/sf0.001"), encode)


def test_edges_layout_and_short_reads(spark, edge_docs, no_docs, encode, tmp_path):
    path = str(tmp_path / "a")
    token_files.write(edge_docs, path, RANKS, block_bytes=200)
    check(spark, edge_docs, token_files.token_table(spark, path), encode)
    blocks = spark.read.parquet(f"{path}/blocks").orderBy("block").collect()
    assert len(blocks) > 3 and all(len(b.doc_ids) == len(b.offsets) == len(b.n_tokens) and b.offsets[0] == 0 for b in blocks)
    kept = spark.read.parquet(f"{path}/_dictionary").first()
    assert {b.dictionary_sha256 for b in blocks} == {kept.sha256} == {hashlib.sha256(bytes(kept.dictionary)).hexdigest()}
    asked = token_files.read_documents(spark, path, [2, 4, 6, 77])
    texts = {r.doc_id: r.text for r in edge_docs.collect()}
    assert sorted((r.doc_id, list(r.ids)) for r in asked.collect()) == sorted((i, encode(texts[i])) for i in (2, 2, 4, 6))
    assert "PushedFilters: [Or(" in asked._jdf.queryExecution().toString()
    assert token_files.read_documents(spark, path, []).count() == 0
    none = str(tmp_path / "none")
    token_files.write(no_docs, none, RANKS)
    assert token_files.token_table(spark, none).count() == 0 and token_files.read_documents(spark, none, [1]).count() == 0


def test_dictionary_makes_short_documents_smaller_and_is_checked(spark, docs, tmp_path, encode):
    short = docs.selectExpr("doc_id", "substring(text, 1, 300) AS text")
    with_it, without = (token_files._encoded(short, RANKS, d, 0, 2).selectExpr("sum(length(frame))").first()[0] for d in (token_files.train_dictionary(docs, RANKS), b""))
    assert with_it < 0.9 * without
    assert token_files.train_dictionary(docs.limit(3), RANKS) == b""  # too few
    path = str(tmp_path / "b")
    token_files.write(docs, path, RANKS)
    other = spark.createDataFrame([(hashlib.sha256(b"x").hexdigest(), bytearray(b"x"))], "sha256 string, dictionary binary")
    other.write.mode("overwrite").parquet(f"{path}/_dictionary")
    with pytest.raises(Exception, match="another dictionary"):
        token_files.token_table(spark, path).collect()
    wide = str(tmp_path / "c")
    token_files.write(docs.limit(20), wide, RANKS, vocabulary_size=100_000)
    assert spark.read.parquet(f"{wide}/blocks").first().id_bytes == 4
    check(spark, docs.limit(20), token_files.token_table(spark, wide), encode)


def test_many_copies_of_one_id(spark, encode):
    docs = spark.range(3000).selectExpr("if(id % 3 = 0, 7, id) AS doc_id", "concat('text ', id % 5) AS text").repartition(5)
    check(spark, docs, token_files.round_trip(docs, RANKS), encode)
