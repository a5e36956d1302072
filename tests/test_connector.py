"""The index sink through a connector: a registered data source that records what it
is given, attempts that failed included."""

import json
import os
import uuid

import pytest
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from fanwrite.options import FanoutOptions
from fanwrite.sinks import IndexSink, RejectSink
from fanwrite.sources.messages import message_log_stream, messages_from_events, write_message_log
from fanwrite.sources.tables import events_from_table, read_table
from fanwrite.streaming import FanoutJob, run_until_done

ONCE = {"availableNow": True}


def recorder_source():
    """An index whose documents are lines of JSON: upserts by ``doc_id`` in the order of
    commits.  (Defined in a function, so that workers get it by value.)"""

    class RecorderWriter(DataSourceWriter):
        def __init__(self, options):
            self.root, self.fail_at = options["root"], options.get("failat")

        def write(self, iterator):
            path = f"{self.root}/attempt-{uuid.uuid4().hex}"
            with open(path, "w") as f:
                for row in iterator:
                    f.write(json.dumps(row.asDict()) + "\n")
                    if self.fail_at == row["doc_id"] and not os.path.exists(self.root + "/failed"):
                        open(self.root + "/failed", "w").close()
                        raise RuntimeError("injected connector failure")
            message = WriterCommitMessage()
            message.path = path
            return message

        def commit(self, messages):
            with open(self.root + "/commits", "a") as f:
                f.write(json.dumps([m.path for m in messages if m]) + "\n")

        def abort(self, messages):
            open(self.root + "/aborted", "a").close()

    class Recorder(DataSource):
        @classmethod
        def name(cls):
            return "recorder"

        def schema(self):
            return "doc_id string, evt string, sev string, missing string"

        def writer(self, schema, overwrite):
            return RecorderWriter(self.options)

    return Recorder


def index(root):
    """The documents an index would hold after the commits."""
    docs, commits = {}, [json.loads(line) for line in open(root + "/commits")]
    for paths in commits:
        batch = [json.loads(line) for p in paths for line in open(p)]
        assert len({d["doc_id"] for d in batch}) == len(batch)  # each document once a batch
        docs |= {d["doc_id"]: d for d in batch}
    return docs, len(commits)


@pytest.fixture()
def job(spark, sf_small, scratch):
    spark.dataSource.register(recorder_source())
    os.makedirs(scratch + "/index")
    events = events_from_table(read_table(spark, sf_small, "events"))
    messages = messages_from_events(events)
    for k in range(3):  # in order of time: a connector's index takes what comes last
        write_message_log(messages.where(f"floor(offset * 3 / 1000) = {k}"), scratch + "/log", files=1, append=k > 0)

    def make(**options):
        opts = FanoutOptions(row_key="id", index_id_field="sun")
        sink = IndexSink(
            scratch + "/unused", opts, connector="recorder", connector_options={"root": scratch + "/index"} | options, fields=("evt", "sev", "missing"), batch_first=False
        )
        return FanoutJob(opts, [sink], rejects=RejectSink(scratch + "/rejects"))

    return make


def start(spark, scratch, job):
    return job.start(message_log_stream(spark, scratch + "/log", max_files_per_trigger=1), scratch + "/ckpt", trigger=ONCE)


def latest(spark, sf_small):
    rows = read_table(spark, sf_small, "events").orderBy("ts", "event_id").collect()
    return {str(r["user_id"]): {"doc_id": str(r["user_id"]), "evt": r["event_type"], "sev": str(r["value"]), "missing": None} for r in rows}


def test_flat_documents_latest_per_id(spark, sf_small, scratch, job):
    run_until_done(start(spark, scratch, job()), 300)
    docs, commits = index(scratch + "/index")
    assert commits == 3 and docs == latest(spark, sf_small)


def test_failed_attempt_is_retried(spark, sf_small, scratch, job):
    with pytest.raises(Exception, match="injected connector failure"):
        run_until_done(start(spark, scratch, job(failat="7")), 300)
    assert os.path.exists(scratch + "/index/aborted")
    run_until_done(start(spark, scratch, job(failat="7")), 300)
    docs, commits = index(scratch + "/index")
    attempts = [f for f in os.listdir(scratch + "/index") if f.startswith("attempt")]
    assert commits == 3 and docs == latest(spark, sf_small)
    assert len(attempts) > sum(len(json.loads(line)) for line in open(scratch + "/index/commits"))  # what failed was not committed


def test_a_connector_needs_fields():
    with pytest.raises(ValueError, match="fields"):
        IndexSink("/x", FanoutOptions(), connector="recorder")
