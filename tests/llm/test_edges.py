"""Repeated rows in the pipeline, dictionaries from few pages, empty tables and odd ids."""

import zlib

import corpus_pipeline as P
import pytest

from paddock.llm import token_files, warc
from paddock.llm.common import stage

TEXT = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"


def test_near_stage_leaves_one_of_repeated_rows(spark, tmp_path):
    rows = [(1, TEXT, "a"), (1, TEXT, "a"), (2, TEXT, "b"), (3, "", "c"), (3, None, "c"), (None, "lone words that no other text has at all", "d"), (None, "lone words that no other text has at all", "e"), (4, "short", "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string")
    out = P.near_stage(spark, docs, str(tmp_path)).collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in out) == sorted([(1, TEXT), (3, ""), (0, rows[5][1]), (4, "short")])
    assert P.near_stage(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_stages_take_empty_tables(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, n_chars long")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, function in P.STAGES:
        docs = stage(function(spark, docs, str(tmp_path)), "empty")
        assert docs.count() == 0, name


@pytest.mark.parametrize("pages", [[(1, "u", "<p>one</p>")], [(i, "u", "same text") for i in range(30)], [(1, "u", None), (2, "u", "")], [(i, f"u{i}", "x" * 50_000) for i in range(9)]])
def test_few_pages_still_make_a_dictionary(spark, tmp_path, pages):
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    known = warc.build_dictionary(df)
    assert bool(known) == any(h for _, _, h in pages)
    got = warc.read_archives(warc.write_archives(warc.decide(df), str(tmp_path), known)).collect()
    assert sorted((r["page_id"], r["payload_bytes"]) for r in got) == sorted((i, len(h or "")) for i, _, h in pages)


def test_token_files_take_texts_as_ids_and_are_smaller_than_two_bytes_an_id(spark, tmp_path):
    tokenizers = pytest.importorskip("tokenizers")
    path = token_files.default_tokenizer()
    library = tokenizers.Tokenizer.from_file(path)
    rows = [(f"id{i:03d}", f"{TEXT} {i % 7} {TEXT}") for i in range(200)] + [(None, "null id"), ("", None), ("é", "x" * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id string, text string").repartition(3)
    manifest = token_files.write_shards(docs, str(tmp_path), path).cache()
    m = manifest.collect()
    assert len(m) == 1 and m[0]["n_bytes"] < 0.75 * 2 * m[0]["n_tokens"] and m[0]["n_symbols"] < m[0]["n_tokens"] / 2
    start, want = 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, (r[0] or "").encode())):
        ids = library.encode(t or "", add_special_tokens=False).ids + [1]
        want.append((i, start, len(ids), zlib.crc32(b"".join(v.to_bytes(4, "little") for v in ids))))
        start += len(ids)
    assert sorted(map(tuple, token_files.read_shards(manifest, "string").collect()), key=lambda r: r[1]) == want


def test_every_shard_has_a_grammar_however_many_partitions(spark, tmp_path):
    path = token_files.default_tokenizer()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 32)
    try:
        m = token_files.write_shards(docs, str(tmp_path), path).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(m) == 1 and m[0]["n_symbols"] < 0.9 * m[0]["n_tokens"] and m[0]["n_bytes"] < 1.9 * m[0]["n_tokens"]
