import pytest

from docgate.operators import chunks as ops
from docgate.operators import routing
from docgate.plans import catalog, inputs
from docgate.sources.messages import publish_files, read_messages, stream_messages
from docgate.streaming.ingest import StreamingIngest, folder_sink

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def inbox(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("inbox"))
    publish_files(inputs.messages(spark, SMOKE).repartition(5), path)
    return path


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()))


CHUNK = ("message_id", "doc_id", "chunk_no", "chunk_text", "source_url")


def test_stream_equals_batch(spark, inbox, tmp_path):
    ingest = StreamingIngest(folder_sink(f"{tmp_path}/c"), folder_sink(f"{tmp_path}/q"))
    stream = stream_messages(spark, inbox, files_per_batch=2)
    ingest.start(stream, f"{tmp_path}/checkpoint").awaitTermination()
    batch = read_messages(spark, inbox)
    stored = spark.read.parquet(f"{tmp_path}/c")
    assert stored.select("batch_id").distinct().count() == 3
    assert rows(stored, *CHUNK) == rows(ops.chunks_from_events(batch), *CHUNK)
    parked = spark.read.parquet(f"{tmp_path}/q")
    want = routing.quarantine(ops.resolve_fields(batch))
    assert rows(parked, "message_id", "reason", "data") == rows(want, "message_id", "reason", "data")
    assert parked.where("quarantined_at IS NULL").count() == 0
    # A restart finds nothing new.
    ingest.start(stream, f"{tmp_path}/checkpoint").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/c").count() == stored.count()


def test_a_batch_delivered_twice_is_stored_once(spark, inbox, tmp_path):
    ingest = StreamingIngest(folder_sink(f"{tmp_path}/c"), folder_sink(f"{tmp_path}/q"))
    batch = read_messages(spark, inbox)
    ingest.process_batch(batch, 0)
    once = spark.read.parquet(f"{tmp_path}/c").count()
    ingest.process_batch(batch, 0)
    assert spark.read.parquet(f"{tmp_path}/c").count() == once


def test_duplicates_inside_a_batch_can_be_dropped(spark, inbox, tmp_path):
    batch = read_messages(spark, inbox)
    ingest = StreamingIngest(
        folder_sink(f"{tmp_path}/c"), folder_sink(f"{tmp_path}/q"), drop_duplicates=True
    )
    ingest.process_batch(batch.union(batch), 0)
    assert spark.read.parquet(f"{tmp_path}/c").count() == ops.chunks_from_events(batch).count()


def test_failing_quarantine_is_tried_again_and_then_fails_unless_rejects_may_be_lost(spark, inbox, tmp_path):
    tries = []

    def broken(df, batch_id):
        tries.append(batch_id)
        raise RuntimeError("quarantine is down")

    batch = read_messages(spark, inbox)
    with pytest.raises(RuntimeError):
        StreamingIngest(folder_sink(f"{tmp_path}/c"), broken).process_batch(batch, 0)
    assert tries == [0, 0]
    ingest = StreamingIngest(folder_sink(f"{tmp_path}/c"), broken, lose_rejects=True)
    ingest.start(stream_messages(spark, inbox), f"{tmp_path}/checkpoint").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/c").count() > 0


def test_a_new_checkpoint_leaves_earlier_batches_alone(spark, inbox, tmp_path):
    ingest = StreamingIngest(folder_sink(f"{tmp_path}/c"), folder_sink(f"{tmp_path}/q"))
    stream = stream_messages(spark, inbox)
    ingest.start(stream, f"{tmp_path}/one").awaitTermination()
    once = spark.read.parquet(f"{tmp_path}/c").count()
    ingest.start(stream, f"{tmp_path}/two").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/c").count() == 2 * once


def test_failing_chunk_sink_fails_the_batch_and_a_restart_delivers_it_again(spark, inbox, tmp_path):
    def broken(df, batch_id):
        raise RuntimeError("table is down")

    parked = folder_sink(f"{tmp_path}/q")
    stream = stream_messages(spark, inbox)
    with pytest.raises(Exception, match="table is down"):
        StreamingIngest(broken, parked).start(stream, f"{tmp_path}/checkpoint").awaitTermination()
    ingest = StreamingIngest(folder_sink(f"{tmp_path}/c"), parked)
    ingest.start(stream, f"{tmp_path}/checkpoint").awaitTermination()
    want = ops.chunks_from_events(read_messages(spark, inbox)).count()
    assert spark.read.parquet(f"{tmp_path}/c").count() == want


def test_the_query_streams_a_table_that_is_a_folder_of_files(spark, tmp_path):
    docs = spark.createDataFrame(
        [(n, f"text {n}", "web") for n in range(40)], "doc_id long, text string, source string"
    )
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    want = ops.chunks_from_events(inputs.messages(spark, str(tmp_path)))
    columns = ("message_id", "doc_id", "chunk_no", "chunk_text")
    assert rows(catalog.stream_ingest(spark, str(tmp_path)), *columns) == rows(want, *columns) != []
