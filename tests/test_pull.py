import pytest
from pyspark.errors import StreamingQueryException

from docgate.sources.messages import publish_files, stream_messages
from docgate.streaming.pull import BoundedPull

LAYOUT = "message_id string, data binary, charset string"


@pytest.fixture
def inbox(spark, tmp_path):
    """Ten files of two messages, in order of arrival."""
    path = f"{tmp_path}/inbox"
    for n in range(10):
        rows = [(f"m{n}-{k}", b'{"trace_id":"t%d"}' % n, "utf-8") for k in range(2)]
        publish_files(spark.createDataFrame(rows, LAYOUT).coalesce(1), path)
    return path


def pulled(spark, inbox, tmp_path, trace, **bounds):
    pull = BoundedPull(trace, f"{tmp_path}/found-{trace}", **bounds)
    found = pull.run(stream_messages(spark, inbox, files_per_batch=1), f"{tmp_path}/checkpoint")
    commits = [p for p in (tmp_path / "checkpoint" / "commits").glob("[0-9]*")]
    return pull, sorted(r["message_id"] for r in found.collect()), len(commits)


def test_ends_at_the_first_file_that_has_it(spark, inbox, tmp_path):
    pull, found, commits = pulled(spark, inbox, tmp_path, "t0")
    assert found == ["m0-0", "m0-1"] and pull.found and pull.batches == commits == 1
    # The rest was not taken: the next pull goes on behind it.
    pull, found, commits = pulled(spark, inbox, tmp_path, "t2")
    assert found == ["m2-0", "m2-1"] and pull.batches == 2 and commits == 3


def test_bounds(spark, inbox, tmp_path):
    pull, found, commits = pulled(spark, inbox, tmp_path, "t8", max_batches=3)
    assert found == [] and not pull.found and pull.batches == commits == 3
    pull, found, _ = pulled(spark, inbox, tmp_path, "nowhere", max_batches=99)
    assert found == [] and pull.batches == 7
    with pytest.raises(ValueError):
        BoundedPull("t", "p", max_batches=0)


def test_other_failures_are_not_hidden(spark, inbox, tmp_path):
    blocked = tmp_path / "blocked"
    blocked.write_text("a file where a folder should be")
    pull = BoundedPull("t0", str(blocked))
    with pytest.raises(StreamingQueryException):
        pull.run(stream_messages(spark, inbox, files_per_batch=1), f"{tmp_path}/checkpoint")
