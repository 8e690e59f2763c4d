import zlib

import duckdb
import pytest

import corpus_pipeline
from millrace.llm import decontaminate, language_id, line_dedup, minhash, threshold_search

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize(("module", "table"), [(line_dedup, "documents"), (threshold_search, "embeddings")])
def test_against_sql(spark, module, table):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    ours = module.query(spark, FOLDER)
    theirs = con.sql(f"SELECT {', '.join(ours.columns)} FROM ({module.SQL})").fetchall()
    assert sorted(map(str, map(tuple, ours.collect()))) == sorted(map(str, theirs))


def test_stages_act(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "minhash", "decontaminate", "byte_bpe"]
    first = corpus_pipeline.languages(spark, docs, FOLDER).collect()
    assert {r["doc_id"] for r in first} == {r["doc_id"] for r in docs.collect() if any(c.isalpha() for c in r["text"])}
    assert all(r["lang"] != language_id.UND for r in first)
    kept = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, FOLDER).collect()}
    wanted = minhash.brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert kept == {k for k, v in wanted.items() if v[2]}
    rows = docs.orderBy("doc_id").collect()
    bad = decontaminate.brute([r["text"] for r in rows], duckdb.sql(f"SELECT item_id, text FROM '{FOLDER}/benchmark.parquet'").fetchall())
    assert {r["doc_id"] for r in corpus_pipeline.decontaminated(spark, docs, FOLDER).collect()} == {r["doc_id"] for r, b in zip(rows, bad, strict=True) if not b[4]}
    assert corpus_pipeline.lines(spark, docs, FOLDER).columns == list(corpus_pipeline.COLUMNS)


def test_run_equals_brute_force(spark, tmp_path):
    import hashlib

    import tiktoken

    from millrace.llm import byte_bpe

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    out = {r["doc_id"]: r for r in corpus_pipeline.run(spark, FOLDER).collect()}
    # Lines by the SQL of their query over the rows with letters; then near-duplicates, windows and tokens by hand.
    con = duckdb.connect()
    con.sql(f"CREATE TABLE documents AS SELECT * FROM '{FOLDER}/documents.parquet' WHERE regexp_matches(text, '\\p{{L}}')")
    cleaned = dict(con.sql(f"SELECT doc_id, text FROM ({line_dedup.SQL})").fetchall())
    assert cleaned.keys() == {r["doc_id"] for r in docs if any(c.isalpha() for c in r["text"] or "")}
    groups = minhash.brute(list(cleaned.items()))
    kept = sorted(k for k, v in groups.items() if v[2])
    bad = decontaminate.brute([cleaned[k] for k in kept], duckdb.sql(f"SELECT item_id, text FROM '{FOLDER}/benchmark.parquet'").fetchall())
    wanted = [k for k, b in zip(kept, bad, strict=True) if not b[4]]
    data, pattern = byte_bpe.vocabulary()
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=byte_bpe.parse_ranks(data), special_tokens={})
    assert sorted(out) == wanted
    for k in wanted:
        ids = library.encode_ordinary(cleaned[k])
        assert list(out[k]["ids"]) == ids and out[k]["decoded_sha256"] == hashlib.sha256(cleaned[k].encode()).hexdigest()


def test_run_on_nulls_repeats_and_empty_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, id string, dg string"
    text = "the cat sat on the mat and looked at the dog in the garden all day long "
    a, b = [k for k in range(10, 99) if zlib.crc32(str(k).encode()) % 3 != 1][:2]  # ids that teach
    rows = [(1, None, "en", "s", 0), (2, "", None, None, 0), (3, "123 456", "en", "s", 7), (a, text, "en", None, 9), (a, text, "en", None, 9), (None, text, None, "s", 9), (b, "die katze sitzt auf der matte und schaut " * 3, "de", "s", 9)]
    for name, some in (("some", rows), ("none", [])):
        folder = str(tmp_path / name)
        spark.createDataFrame([(*r, "x", "y") for r in some], schema).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        out = corpus_pipeline.run(spark, folder).collect()
        assert [r["doc_id"] for r in sorted(out, key=lambda r: r["doc_id"] or 0)] == ([a, a, b] if some else [])
