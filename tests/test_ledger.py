"""A stream's batches and the table they go to: a batch that is run again writes nothing."""

import shutil

import pytest
from conftest import CONDITION, PATIENT

from clinlake.sources import tables
from clinlake.streaming import ingest


def test_a_replayed_batch_writes_nothing(spark, raw, tmp_path, monkeypatch):
    tables.ensure_schema(spark, "ledger")
    bronze, checkpoint, table = str(tmp_path / "bronze"), str(tmp_path / "checkpoint"), "ledger.silver_patient"

    def run():
        ingest.stream_upsert(spark, bronze, "Patient", table, checkpoint).awaitTermination()

    def state():
        return tables._snapshots(spark, table)[-1], sorted(r.fhir_patient_id for r in spark.table(table).collect())

    raw(PATIENT, CONDITION).write.mode("append").parquet(bronze)
    run()
    first = state()
    assert first[1] == ["p-31"]
    # A driver lost after the snapshot and before the stream's own commit: the batch comes again.
    shutil.rmtree(f"{checkpoint}/commits")
    run()
    assert state() == first
    # One lost before the snapshot is shown: the batch is not noted and is done by the next run.
    raw({**PATIENT, "id": "p-40"}).write.mode("append").parquet(bronze)
    with monkeypatch.context() as m:
        m.setattr(tables, "write_overwrite", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(Exception, match="lost"):
            run()
    assert state() == first
    run()
    after = state()
    assert after[1] == ["p-31", "p-40"]
    shutil.rmtree(f"{checkpoint}/commits")
    run()
    assert state()[1] == after[1]


def test_a_new_checkpoint_is_another_stream_and_other_publishes_keep_the_ledger(spark, raw, tmp_path):
    tables.ensure_schema(spark, "ledger")
    bronze, table = str(tmp_path / "bronze"), "ledger.second_patient"
    raw(PATIENT).write.parquet(bronze)
    for name in ("one", "two"):
        ingest.stream_upsert(spark, bronze, "Patient", table, str(tmp_path / name)).awaitTermination()
    ids = [ingest.stream_id(spark, str(tmp_path / n)) for n in ("one", "two")]
    assert [tables.last_batch(spark, table, i) for i in ids] == [0, 0] and ids[0] != ids[1]
    tables.publish(spark.table(table), table)
    assert [tables.last_batch(spark, table, i) for i in ids] == [0, 0]
    assert tables.last_batch(spark, table, "other") == -1
