import os
from datetime import datetime, timedelta, timezone

import pytest
from landed import put

from landfall.streaming.slots import landed_slots, slot_report

START = datetime(2024, 1, 1)
HOUR = timedelta(hours=1)
SCHEMA = "entity string, slot timestamp, landed_at timestamp"


def at(hours):
    return START + hours * HOUR


def reported(spark, folder, drops, grace=HOUR, schema=SCHEMA, **options):
    """The report after every drop of arrivals, each its own run of the same stream."""
    for n, drop in enumerate(drops):
        spark.createDataFrame(drop, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        sink = slot_report(stream, grace=grace, **options).writeStream.format("parquet").option("path", f"{folder}/out")
        sink.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    got = spark.read.schema("entity string, slot timestamp, status string, landed_at timestamp").parquet(f"{folder}/out")
    hours = lambda t: None if t is None else (t - START) / HOUR
    rows = [(r["entity"], hours(r["slot"]), r["status"], hours(r["landed_at"])) for r in got.collect()]
    return sorted(rows, key=str)


def expected(arrivals, wait=2, delay=1 / 6):
    """The same by hand: hours as numbers."""
    mark = max(a[2] for a in arrivals) - delay
    rows = [(e, float(s), "late", float(t)) for e, s, t in arrivals if t > s + wait]
    for entity in {a[0] for a in arrivals}:
        in_time = {s for e, s, t in arrivals if e == entity and t <= s + wait}
        at = min(in_time, default=None)
        while at is not None and at + wait < mark:
            if at not in in_time:
                rows.append((entity, float(at), "absent", None))
            at += 1
    return sorted(rows, key=str)


ARRIVALS = [
    ("a", 0, 0.5), ("b", 1, 1.5), ("a", 1, 2), ("a", 3, 4), ("c", 0, 4.25), (None, 4, 5), ("a", 2, 6), ("b", 2, 6), ("a", 3, 6.5),
    ("c", 6, 7), ("a", 7, 8), ("a", 7, 8), (None, 5, 9), ("b", 9, 11), ("a", 12, 12.5),
]


@pytest.mark.parametrize("cuts", [[], [5], [1, 4, 9, 13]])
def test_absent_and_late_whatever_the_runs(spark, folder, cuts):
    edges = [0, *cuts, len(ARRIVALS)]
    rows = [(e, at(s), at(t)) for e, s, t in ARRIVALS]
    drops = [rows[a:b] for a, b in zip(edges, edges[1:])]
    assert reported(spark, folder, drops) == expected(ARRIVALS)


def test_nothing_in_time_nulls_and_empty_drops(spark, folder):
    """Without an arrival in time no slot is expected; rows without slot or time are left out."""
    drops = [[], [("a", at(0), at(9)), ("a", None, at(3)), ("b", at(1), None)], []]
    assert reported(spark, folder, drops) == [("a", 0.0, "late", 9.0)]
    with pytest.raises(ValueError):
        slot_report(spark.createDataFrame([], SCHEMA), every=timedelta(0))


def test_slots_are_cut_and_a_silent_entity_goes_on_missing(spark, folder):
    rows = [("a", at(0.4), at(0.5)), ("b", at(20_000.2), at(20_000.5))]
    got = reported(spark, folder, [rows], grace=timedelta(0))
    assert len(got) == 19_999 and {r[0] for r in got} == {"a"} and {r[2] for r in got} == {"absent"}


def test_slots_of_landed_files(spark, folder):
    for name, hours in (("erp_1_20240101_00.xml", 0.5), ("erp_2_20240101_02.xml", 2.5), ("erp_3_x_y.xml", 3), ("crm_1_20240101_05.xml", 6)):
        path = put(f"{folder}/landing", name, "<a/>")
        when = at(hours).replace(tzinfo=timezone.utc).timestamp()
        os.utime(path, (when, when))
    stream = slot_report(landed_slots(spark, f"{folder}/landing", "yyyyMMddHH")).writeStream.format("parquet")
    stream.option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(f"{folder}/out")
    assert sorted((r["entity"], r["slot"], r["status"]) for r in got.collect()) == [("erp", at(1), "absent"), ("erp", at(3), "absent"), ("erp", at(4), "absent")]
