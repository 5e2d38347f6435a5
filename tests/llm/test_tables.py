"""WARC files, mixing, the registered queries and the pipeline."""

import gzip

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from docgate.llm import bpe, catalog, common, mixing, warc

DATA = "/root/testdata/sf0.001"


def pages_of(spark):
    rows = [(n, f"http://h/{n} é", f"<p>{n % 7}</p>" if n % 2 else f"é{n}", n) for n in range(200)]
    rows += [(200, None, None, 0), (201, "u", "", 0), (None, "n", "<p>1</p>", 0), (300, "t", "tie", 0), (300, "t", "tie", 0)]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, payload int")


def test_warc_round_trip(spark):
    pages = pages_of(spark)
    folder = common.scratch(spark, "warc-test")
    manifest = warc.write(pages, folder, roll_bytes=3000)
    assert manifest.count() > 3
    read = warc.read(manifest, folder).collect()
    rows = pages.collect()
    assert len(read) == len(rows)
    largest = {}
    for r in rows:
        if r["page_id"] is not None:
            key = r["html"] or ""
            largest[key] = max(largest.get(key, -1), r["page_id"])
    by_id = {r["page_id"]: r["html"] or "" for r in rows}
    responses = {r["page_id"]: r["payload"].decode() for r in read if r["record_type"] == "response"}
    for r in read:
        text = by_id[r["page_id"]]
        assert r["payload_bytes"] == len(text.encode()) and r["payload_digest"] == warc.digest(text.encode())
        if r["record_type"] == "revisit":
            assert r["refers_to"] == largest[text] and responses[r["refers_to"]] == text
        else:
            assert r["page_id"] == largest[text]
    assert sum(r["page_id"] == 300 and r["record_type"] == "response" for r in read) == 1


def test_warc_is_deterministic_and_empty_tables_work(spark):
    pages = pages_of(spark)
    sums = [
        sorted(r["sha256"] for r in warc.write(pages, common.scratch(spark, "warc-test")).collect())
        for _ in range(2)
    ]
    assert sums[0] == sums[1]
    folder = common.scratch(spark, "warc-test")
    assert warc.read(warc.write(pages.limit(0), folder), folder).count() == 0


def test_warc_files_do_not_depend_on_partitions(spark):
    ids = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(77)).when(F.col("id") % 1000 == 1, F.lit(None))
        .when(F.col("id") == 2, F.lit(2**63 - 1)).when(F.col("id") == 4, F.lit(-(2**63)))
        .otherwise(F.col("id") * 1000).alias("page_id"),
        F.lit("u").alias("url"), F.concat(F.lit("p"), F.col("id") % 9000).alias("html"),
    )
    folders = [common.scratch(spark, "warc-test") for _ in range(2)]
    manifests = [
        warc.write(pages, folder, roll_bytes=100_000)
        for pages, folder in zip((ids, ids.orderBy(F.rand(3)).repartition(7)), folders)
    ]
    files = [sorted(map(tuple, m.collect())) for m in manifests]
    assert files[0] == files[1] and sum(f[1] for f in files[0]) == 20_000
    found = warc.ranges(ids)
    assert len(found.shards) == len(found.firsts) + 1 and (found.parts > 1).any()
    read = warc.read(manifests[0], folders[0], ("page_id",))
    assert read.where("page_id = 77").count() == ids.where("page_id = 77").count()


def test_damage_is_noticed():
    data = warc.record(1, "u", b"payload", None).replace(b"payload\r\n", b"pay1oad\r\n")
    import io

    with pytest.raises(ValueError):
        list(warc.parse(io.BytesIO(gzip.compress(data))))


def test_mixing_reaches_its_margins(spark):
    rows = [
        (n, "w " * (20 + n % 100), ("en", "de", "fr")[min(n % 7, 2)], f"s{min(n % 9, 3)}") for n in range(3000)
    ]
    rows += [(None, None, None, None), (5000, "", "en", "s1")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    settings = mixing.Settings(sweeps=30)
    names = [f"_{m}" for m in mixing.MARGINS]
    cells = mixing.placed(docs).groupBy(*names).agg(F.sum("_tokens").alias("tokens"))
    fitted = mixing.raked(cells.toDF(*mixing.MARGINS, "tokens"), settings)
    for margin in mixing.MARGINS:
        found = fitted.groupBy(margin).agg(F.sum("share").alias("s"), F.sum("fitted").alias("f")).collect()
        norm = sum(r["s"] ** settings.temper for r in found)
        assert all(abs(r["f"] - r["s"] ** settings.temper / norm) < 1e-6 for r in found)
    sampled = mixing.sample(docs, settings)
    assert sampled.count() == len(rows)
    expected, total = sampled.agg(F.sum(F.col("_tokens") * F.col("_probability")), F.sum("_tokens")).first()
    assert abs(expected / total - settings.keep) < 1e-6
    assert mixing.sample(docs.limit(0)).count() == 0


def test_the_mixed_stage_has_the_tempered_shares(spark):
    rows = [
        (n, "w " * (70 + n % 100), ("de", "fr")[n % 2] if n % 20 == 0 else "en", f"s{min(n % 9, 3)}", 1)
        for n in range(4000)
    ]
    rows += [(n, "w " * 20, "en", "s1", 1) for n in range(5000, 5200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    found = mixing.placed(corpus_pipeline.mixed(spark, docs, DATA))
    tokens = lambda df, m: dict(map(tuple, df.groupBy(f"_{m}").agg(F.sum("_tokens")).collect()))
    for margin in mixing.MARGINS:
        before, after = tokens(mixing.placed(docs), margin), tokens(found, margin)
        total, kept = sum(before.values()), sum(after.values())
        goals = {k: (v / total) ** corpus_pipeline.MIX.temper for k, v in before.items()}
        norm = sum(goals.values())
        assert abs(kept / total - corpus_pipeline.MIX.keep) < 0.02
        assert all(abs(after[k] / kept - goal / norm) < 0.02 for k, goal in goals.items())
    assert "Python" not in found._jdf.queryExecution().toString()
    assert corpus_pipeline.mixed(spark, docs.limit(0), DATA).count() == 0


def test_mixing_is_native(spark):
    df = catalog.op5_mixing(spark, DATA)
    assert "Python" not in df._jdf.queryExecution().toString()


def test_mixing_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    expected = con.sql(catalog.ORACLE["op5_mixing"]).fetchall()
    assert sorted(map(tuple, catalog.op5_mixing(spark, DATA).collect())) == sorted(expected)


@pytest.mark.parametrize("name", [n for n in catalog.QUERIES if n != "op5_mixing"])
def test_queries_return_a_row_for_every_row(spark, name):
    tables = {"op4": "embeddings", "op7": "conversations", "op8": "pages"}
    source = spark.read.parquet(f"{DATA}/{tables.get(name.split('_')[0], 'documents')}.parquet")
    n = source.select("conv_id").distinct().count() + 1 if name == "op7_chat" else source.count()
    assert catalog.QUERIES[name](spark, DATA).count() == n


def test_pipeline_stages_keep_columns_and_take_effect(spark):
    docs = common.table(spark, DATA, "documents")
    extra = docs.limit(3).unionByName(docs.limit(2)).withColumn("text", F.lit(None).cast("string"))
    docs = common.written(docs.unionByName(extra), "docs")
    ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = common.written(stage(spark, docs, DATA), "stage")
        assert docs.columns[:5] == list(corpus_pipeline.COLUMNS)
        own = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert own <= ids and own
        ids = own
    path = catalog.public_tokenizers.path("byte_bpe_50k.json")
    back = bpe.decode(docs, path)
    assert back.where("decoded <> coalesce(text, '')").count() == 0
