import os
from datetime import datetime

import pytest
from landed import put, response, rows
from pyspark.sql import functions as F

import landfall.plans.batch as batch
from landfall.plans.batch import LoadMismatch, TargetConflict, load_batch, read_bronze
from landfall.plans.loads import FIELDS, KEEP, loads_spec
from landfall.samples.landing import write_landing
from landfall.sinks.cleanup import delete_loaded, same_time
from landfall.sinks.layer import write_layer

RUN_TS = datetime(2024, 1, 15, 10, 30)
GOOD = '[{"t10_id":1,"t06_placa":"A"},{"t10_id":2,"t10_senha_mobile_cast":"secret"}]'


@pytest.fixture
def spec(folder):
    return loads_spec(f"{folder}/landing", f"{folder}/bronze", "erp")


def landed(spec):
    return sorted(os.listdir(spec.landing))


def outcomes(result, column="disposition"):
    name = F.substring_index("SourceFileName", "/", -1)
    return {r[0]: r[1] for r in result.files.select(name, column).collect()}


def test_bronze_layout(spark, spec):
    put(spec.landing, "a_b_15012024_10.xml", response(GOOD))
    result = load_batch(spark, spec, RUN_TS)
    assert result.path == f"{spec.target}/listaCargas-15012024-10.parquet"
    assert (result.status, result.rows, result.rejects, result.rejects_path) == (0, 2, 0, "")
    bronze = spark.read.parquet(result.path)
    assert bronze.dtypes == [
        *[(c, "string") for c in KEEP],
        ("SourceFileName", "string"),
        ("NumRows", "string"),
        ("ProcessedDate", "string"),
        ("ProcessedTime", "timestamp"),
        ("SourceName", "string"),
    ]
    assert rows(bronze, "t10_id", "t06_placa", "NumRows", "ProcessedDate", "SourceName") == [
        ("1", "A", "2", "15-01-2024", "erp"),
        ("2", None, "2", "15-01-2024", "erp"),
    ]
    assert len(bronze.inputFiles()) == 1


@pytest.mark.parametrize("fmt, compression", [("orc", "snappy"), ("json", "gzip"), ("csv", "gzip")])
def test_other_formats(spark, spec, fmt, compression):
    put(spec.landing, "a_b_d_h.xml", response(GOOD))
    other = spec.but(fmt=fmt, compression=compression)
    load_batch(spark, other, RUN_TS)
    result = load_batch(spark, other, RUN_TS, clean=True)
    assert result.deleted == 1
    got = read_bronze(spark, other).load(result.path)
    assert rows(got, "t10_id", "t06_placa", "NumRows") == [("1", "A", "2"), ("2", None, "2")]


def test_read_options(spark, spec):
    put(spec.landing, "a_b_d_h.xml", response(GOOD))
    put(spec.landing, "a_b_d_h.txt", response(GOOD))
    put(f"{spec.landing}/more", "a_c_d_h.xml", response(GOOD))
    options = {"pathGlobFilter": "*.xml", "recursiveFileLookup": "true"}
    result = load_batch(spark, spec.but(read_options=options), RUN_TS)
    assert outcomes(result) == {"a_b_d_h.xml": "loaded", "a_c_d_h.xml": "loaded"}


@pytest.mark.parametrize("splittable", [False, "exact"])
def test_staged_copy_is_removed(spark, spec, folder, monkeypatch, splittable):
    monkeypatch.setattr(batch, "work_folder", lambda spark, label: f"{folder}/work")
    put(spec.landing, "a_b_d_h.xml", response(GOOD))
    assert load_batch(spark, spec.but(splittable=splittable), RUN_TS).rows == 2
    assert sorted(os.listdir(f"{folder}/work")) == ["counts", "dispositions"]


def test_all_fields(spark, spec):
    put(spec.landing, "a_b_d_h.xml", response(GOOD))
    assert len(FIELDS) == len(set(FIELDS)) == 69
    bronze = spark.read.parquet(load_batch(spark, spec.but(keep=()), RUN_TS).path)
    assert tuple(bronze.columns[:69]) == FIELDS
    assert rows(bronze, "t10_senha_mobile_cast") == [(None,), ("secret",)]


@pytest.mark.parametrize("splittable", [True, False, "exact"])
def test_rejects(spark, spec, splittable):
    put(spec.landing, "a_b_d_h.xml", response(GOOD, "[]", None, '[{"t10_id":'))
    put(spec.landing, "a_c_d_h.xml", "<e><ns1:listaCargasResponse><resParam>x</status></ns1:listaCargasResponse></e>")
    put(spec.landing, "plain.xml", response(GOOD))
    result = load_batch(spark, spec.but(splittable=splittable), RUN_TS)
    assert (result.rows, result.rejects) == (2, 5)
    rejects = spark.read.parquet(result.rejects_path)
    got = {r.reject_reason: r.rejected_text for r in rejects.collect()}
    assert got["empty"] == "[]" and got["missing"] is None
    assert got["malformed"] == '[{"t10_id":' and got["bad_file_name"] == GOOD
    assert "<resParam>x</status>" in got["corrupt_xml"]
    assert outcomes(result) == {"a_b_d_h.xml": "loaded", "a_c_d_h.xml": "loaded", "plain.xml": "bad_file_name"}


def test_rerun_gives_the_same_bronze(spark, spec):
    put(spec.landing, "a_b_d_h.xml", response(GOOD))
    first = rows(spark.read.parquet(load_batch(spark, spec, RUN_TS).path))
    assert rows(spark.read.parquet(load_batch(spark, spec, RUN_TS).path)) == first


def test_clean_up(spark, spec):
    put(spec.landing, "a_b_d_h.xml", response(GOOD))
    put(spec.landing, "c d_e_d_h.xml", response(GOOD, "[]"))
    put(spec.landing, "none_x_d_h.xml", "<e></e>")
    put(spec.landing, "plain.xml", response(GOOD))
    result = load_batch(spark, spec, RUN_TS, clean=True, report_unread=True)
    assert result.deleted == 2
    assert landed(spec) == ["none_x_d_h.xml", "plain.xml"]
    assert outcomes(result, "outcome") == {
        "a_b_d_h.xml": "deleted",
        "c%20d_e_d_h.xml": "deleted",
        "none_x_d_h.xml": "kept",
        "plain.xml": "kept",
    }
    assert outcomes(result)["none_x_d_h.xml"] == "no_records"


def test_clean_up_keeps_what_is_new_or_changed(spark, spec, folder):
    for name in ("a_b_d_h.xml", "a_c_d_h.xml", "a_d_d_h.xml"):
        put(spec.landing, name, response(GOOD))
    result = load_batch(spark, spec, RUN_TS)
    put(spec.landing, "late_b_d_h.xml", response(GOOD))
    changed = put(spec.landing, "a_c_d_h.xml", response(GOOD, GOOD))
    os.utime(changed, (1, 1))
    os.remove(os.path.join(spec.landing, "a_d_d_h.xml"))
    result = delete_loaded(spark, result.files, f"{folder}/log")
    got = {r[0].rsplit("/", 1)[-1]: r[1] for r in result.select("SourceFileName", "outcome").collect()}
    assert got == {"a_b_d_h.xml": "deleted", "a_c_d_h.xml": "changed", "a_d_d_h.xml": "already_gone"}
    assert landed(spec) == ["a_c_d_h.xml", "late_b_d_h.xml"]


def test_a_retried_deletion_finds_its_files_gone(spark, spec, folder):
    put(spec.landing, "a_b_d_h.xml", response(GOOD))
    files = load_batch(spark, spec, RUN_TS).files
    for log, outcome in (("first", "deleted"), ("second", "already_gone")):
        assert rows(delete_loaded(spark, files, f"{folder}/{log}"), "outcome") == [(outcome,)]


def test_empty_landing_is_a_no_op(spark, spec):
    os.makedirs(spec.landing)
    result = load_batch(spark, spec, RUN_TS, clean=True)
    assert (result.status, result.rows, result.path, result.deleted) == (0, 0, "", 0)
    assert not os.path.exists(spec.target)


def test_batch_without_rows_still_writes_its_table(spark, spec):
    put(spec.landing, "a_b_d_h.xml", response("[]"))
    result = load_batch(spark, spec, RUN_TS)
    assert (result.rows, result.rejects) == (0, 1)
    assert spark.read.parquet(result.path).count() == 0


def test_failing_sink_leaves_landing_alone(spark, spec, folder):
    put(spec.landing, "a_b_d_h.xml", response(GOOD))
    put(folder, "bronze", "a file where the folder should be")
    with pytest.raises(Exception):
        load_batch(spark, spec, RUN_TS, clean=True)
    assert landed(spec) == ["a_b_d_h.xml"]


def test_short_write_is_noticed(spark, spec, monkeypatch):
    put(spec.landing, "a_b_d_h.xml", response(GOOD))

    def lossy(df, path, *args, **options):
        return write_layer(df.limit(1) if "bronze" in path else df, path, *args, **options)

    monkeypatch.setattr(batch, "write_layer", lossy)
    with pytest.raises(LoadMismatch):
        load_batch(spark, spec, RUN_TS, clean=True)
    assert landed(spec) == ["a_b_d_h.xml"]


def test_overwrite_never_drops_cleaned_files(spark, spec):
    put(spec.landing, "a_b_d_h.xml", response(GOOD))
    assert load_batch(spark, spec, RUN_TS, clean=True).deleted == 1
    put(spec.landing, "a_c_d_h.xml", response(GOOD))
    with pytest.raises(TargetConflict):
        load_batch(spark, spec, RUN_TS, clean=True)
    assert landed(spec) == ["a_c_d_h.xml"]
    result = load_batch(spark, spec.but(mode="append"), RUN_TS, clean=True)
    assert result.deleted == 1
    assert spark.read.parquet(result.path).count() == 4


def test_identity_of_several_files(spark, spec):
    put(spec.landing, "a_b_20240101_23.xml", response(GOOD))
    put(spec.landing, "a_b_20240102_01.xml", response(GOOD))
    assert load_batch(spark, spec, RUN_TS).path.endswith("/listaCargas-20240102-01.parquet")


def test_one_file_with_most_rows(spark, spec):
    """The hot file is read in many tasks and loses nothing."""
    payloads = ["[" + ",".join(f'{{"t10_id":{i}}}' for i in range(p * 50, p * 50 + 50)) + "]" for p in range(400)]
    put(spec.landing, "hot_b_d_h.xml", response(*payloads))
    for n in range(5):
        put(spec.landing, f"small_{n}_d_h.xml", response(GOOD))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        result = load_batch(spark, spec.but(splittable=True), RUN_TS, clean=True)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    bronze = spark.read.parquet(result.path)
    assert (result.rows, result.deleted) == (20010, 6)
    assert len(bronze.inputFiles()) > 1
    hot = bronze.where("SourceFileName like '%hot%'").select(F.col("t10_id").cast("int"))
    assert hot.exceptAll(spark.range(20000).select(F.col("id").cast("int"))).count() == 0
    assert hot.count() == 20000


def test_file_count_is_a_parameter_not_a_size(spark, spec):
    for n in range(6):
        put(spec.landing, f"a_b_d_{n}.xml", response(GOOD))
    one = load_batch(spark, spec.but(files=1), RUN_TS)
    assert len(spark.read.parquet(one.path).inputFiles()) == 1
    many = load_batch(spark, spec, RUN_TS)
    assert len(spark.read.parquet(many.path).inputFiles()) > 1


def test_latest_by_date(spark, spec):
    for token in ("31-01-2024_9", "01-02-2024_1", "15-01-2024_23"):
        put(spec.landing, f"a_b_{token}.xml", response(GOOD))
    result = load_batch(spark, spec.but(date_format="dd-MM-yyyy"), RUN_TS)
    assert result.path.endswith("-01-02-2024-1.parquet")


def test_the_xml_is_read_once(spark, spec, monkeypatch):
    put(spec.landing, "a_b_d_h.xml", response(GOOD))
    seen = []
    original = batch.scan
    monkeypatch.setattr(batch, "scan", lambda *a, **k: seen.append(original(*a, **k)) or seen[-1])
    load_batch(spark, spec.but(splittable=True), RUN_TS)
    plan = batch.expand(seen[0], spec)._jdf.queryExecution().executedPlan().toString()
    assert len(seen) == 1
    assert plan.count("from_xml") == 1 and plan.count("from_json") == 1 and "Exchange" not in plan


def test_reload_after_losing_a_landed_file(spark, spec):
    for name in ("a_b_15012024_10.xml", "a_c_15012024_10.xml"):
        put(spec.landing, name, response(GOOD, "broken"))
    first = load_batch(spark, spec, RUN_TS)
    before = rows(spark.read.parquet(first.path)), rows(spark.read.parquet(first.rejects_path))
    os.remove(f"{spec.landing}/a_b_15012024_10.xml")
    second = load_batch(spark, spec, RUN_TS, clean=True)
    assert (rows(spark.read.parquet(first.path)), rows(spark.read.parquet(first.rejects_path))) == before
    assert second.deleted == 1 and landed(spec) == []


def test_append_writes_no_file_twice(spark, spec):
    append = spec.but(mode="append")
    put(spec.landing, "a_b_15012024_10.xml", response(GOOD, "broken"))
    load_batch(spark, append, RUN_TS)
    put(spec.landing, "a_c_15012024_10.xml", response(GOOD))
    result = load_batch(spark, append, RUN_TS)
    assert spark.read.parquet(result.path).count() == 4 and spark.read.parquet(result.rejects_path).count() == 1
    put(spec.landing, "a_b_15012024_10.xml", response(GOOD.replace('"A"', "null")))
    with pytest.raises(TargetConflict):
        load_batch(spark, append, RUN_TS)
    assert spark.read.parquet(result.path).count() == 4


def test_interrupted_clean_up_is_finished_first(spark, spec, monkeypatch):
    put(spec.landing, "a_b_15012024_10.xml", response(GOOD))
    put(spec.landing, "a_b_15012024_11.xml", response(GOOD))

    def lost(*args):
        os.remove(f"{spec.landing}/a_b_15012024_11.xml")
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(batch, "delete_loaded", lost)
        with pytest.raises(OSError):
            load_batch(spark, spec, RUN_TS, clean=True)
    with pytest.raises(TargetConflict):
        load_batch(spark, spec, RUN_TS)
    result = load_batch(spark, spec, RUN_TS, clean=True)
    assert (result.deleted, result.path, landed(spec)) == (1, "", [])
    assert os.listdir(spec.target) == ["listaCargas-15012024-11.parquet"] and not os.path.exists(spec.ledger_path)


@pytest.mark.parametrize("a, b, same", [(5000, 5999, True), (5001, 5001, True), (5001, 5002, False), (5000, 6000, False), (5999, 6000, False)])
def test_change_times_by_their_precision(a, b, same):
    assert same_time(a, b) == same_time(b, a) == same


@pytest.mark.parametrize("splittable", [False, "exact"])
def test_salvaged_payloads_are_loaded_and_cleaned(spark, spec, splittable):
    put(spec.landing, "a_b_d_h.xml", response(GOOD, '[{"t10_id":9},{"t10_id":'))
    result = load_batch(spark, spec.but(salvage=True, splittable=splittable), RUN_TS, clean=True)
    assert (result.rows, result.rejects, result.deleted) == (3, 1, 1)
    assert rows(spark.read.parquet(result.path), "t10_id", "NumRows") == [("1", "3"), ("2", "3"), ("9", "3")]
    assert rows(spark.read.parquet(result.rejects_path), "reject_reason", "rejected_text") == [("broken_tail", '{"t10_id":')]


@pytest.mark.parametrize("splittable", [False, True, "exact"])
def test_files_without_records_are_counted(spark, spec, splittable):
    put(spec.landing, "a_b_d_h.xml", response(GOOD))
    put(spec.landing, "a_c_d_h.xml", "<e><other/></e>")
    put(spec.landing, "a_d_d_h.xml", "")
    assert load_batch(spark, spec.but(splittable=splittable), RUN_TS).unread == 2


def test_outcome_of_a_failed_load(spark, spec, monkeypatch):
    put(spec.landing, "a_b_d_h.xml", response(GOOD))
    with monkeypatch.context() as patch:
        patch.setattr(batch, "load_frame", lambda *a, **k: (_ for _ in ()).throw(LoadMismatch("rows are missing")))
        result = load_batch(spark, spec, RUN_TS, clean=True, raise_errors=False)
    assert (result.status, result.rows, result.deleted, result.message) == (1, 0, 0, "LoadMismatch: rows are missing")
    assert landed(spec) == ["a_b_d_h.xml"]
    result = load_batch(spark, spec, RUN_TS, raise_errors=False)
    assert (result.status, result.rows, result.unread, result.message) == (0, 2, 0, "")


def test_renamed_and_resent_files_load_no_row(spark, spec):
    spec = spec.but(fingerprints=True)
    other = '[{"t10_id":3},null,{"t10_id":5}]'
    put(spec.landing, "a_b_15_10.xml", response(GOOD, other, "[]"))
    put(spec.landing, "z_b_15_10.xml", response(other, GOOD, "[]"))  # the same content in another order
    first = load_batch(spark, spec, RUN_TS)
    assert (first.rows, first.unread) == (5, 0)
    assert outcomes(first) == {"a_b_15_10.xml": "loaded", "z_b_15_10.xml": "resent"}
    # Loading the same landing again repeats the batch; the ledger does not grow.
    again = load_batch(spark, spec, RUN_TS, clean=True)
    assert (again.rows, again.deleted, landed(spec)) == (5, 2, [])
    assert spark.read.parquet(spec.fingerprints_path).count() == 1
    put(spec.landing, "renamed_b_16_11.xml", response(GOOD, other, "[]"))
    resent = load_batch(spark, spec, RUN_TS, clean=True)
    assert (resent.rows, resent.path, resent.deleted, landed(spec)) == (0, "", 1, [])
    put(spec.landing, "renamed_b_17_12.xml", response(GOOD, other))  # one payload less
    put(spec.landing, "new_b_17_12.xml", response(None))
    changed = load_batch(spark, spec, RUN_TS, clean=True)
    assert (changed.rows, changed.rejects, changed.deleted) == (5, 1, 2)
    assert spark.read.parquet(f"{spec.target}/*").count() == 10


def test_landed_files_are_filled_over_batches(spark, folder):
    records = spark.range(0, 1200, 1, 1).selectExpr("to_json(struct(id)) as record", "cast(2000 + id % 3 as string) as date_token", "'10' as hour_token")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        assert write_landing(records, folder, per_file=300) == 6  # two files for each of three years, not one per batch and year
        assert write_landing(records, f"{folder}/small", per_file=30) == 42
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    landed = spark.read.format("binaryFile").load(folder).selectExpr("cast(content as string) as text").collect()
    assert sum(r.text.count('"id"') for r in landed) == 1200
