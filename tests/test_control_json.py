import datetime as dt
import json
import os

from millrace.sinks import ledger as L
from millrace.sources import import_control_records, read_batch_records, read_watermark_record

UTC = dt.timezone.utc


def dump(path, obj):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        json.dump(obj, f, indent=2)


def test_batch_records_both_file_shapes(spark, workdir):
    dump(f"{workdir}/batch/b1.json", {"batch_id": "batch_20260429_085308", "files": [],
                                      "process_date": "2026-04-29",
                                      "watermark_ts": "2026-04-29T08:53:08.213460+00:00"})
    dump(f"{workdir}/batch/b2.json", {"batch_id": "b2", "files": ["s3://x/a.csv", "s3://x/b.csv"],
                                      "process_date": "2026-04-30", "watermark_ts": "2026-04-30T00:00:00Z",
                                      "status": "SUCCESS", "records_processed": 7,
                                      "job_end_time": "2026-04-30T00:05:00"})
    dump(f"{workdir}/batch/b3.json", {"batch_id": "b3", "files": [{"file_path": "s3://x/c.csv"}],
                                      "process_date": "2026-05-01", "watermark_ts": "2026-05-01T00:00:00Z"})
    rows = {r.batch_id: r for r in read_batch_records(spark, f"{workdir}/batch").collect()}
    assert rows["batch_20260429_085308"].files == []
    assert rows["b2"].files == ["s3://x/a.csv", "s3://x/b.csv"] and rows["b2"].records_processed == 7
    assert rows["b3"].files == ["s3://x/c.csv"] and rows["b3"].status == "PLANNED"
    assert rows["b2"].process_date == dt.date(2026, 4, 30)
    assert rows["b2"].watermark_ts.astimezone(UTC) == dt.datetime(2026, 4, 30, tzinfo=UTC)


def test_import_into_ledger(spark, workdir):
    dump(f"{workdir}/wm.json", {"last_processed_time": "2026-04-29T08:53:08.213460+00:00"})
    dump(f"{workdir}/batch/b.json", {"batch_id": "b", "files": ["f.csv"], "process_date": "2026-04-29",
                                     "watermark_ts": "2026-04-29T08:53:08.213460+00:00",
                                     "status": "SUCCESS"})
    w = read_watermark_record(spark, f"{workdir}/wm.json").first().last_processed_time
    assert w.astimezone(UTC) == dt.datetime(2026, 4, 29, 8, 53, 8, 213460, tzinfo=UTC)
    control = f"{workdir}/control"
    import_control_records(spark, control, f"{workdir}/batch", f"{workdir}/wm.json")
    assert L.current_watermark(spark, control) == dt.datetime(2026, 4, 29, 8, 53, 8, 213460, tzinfo=UTC)
    assert L.latest_batch(spark, control).first().batch_id == "b"
    assert L.pending_batch(spark, control) is None
