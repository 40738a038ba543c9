import pytest

from landfall.session import DEFAULTS, object_store_conf, object_store_conf_from_env, session, work_folder
from landfall.sinks.cleanup import path_in_store, store_options


def test_settings_are_read_back(spark):
    same = session({"spark.sql.session.timeZone": "UTC"})
    assert same.sparkContext is spark.sparkContext
    for name in DEFAULTS:
        assert spark.conf.get(name) == DEFAULTS[name]


def test_object_store_settings():
    env = {"HOST_MINIO": "http://store:9000", "AWS_ACESS_KEY": "key", "AWS_SECRET_KEY": "secret"}
    conf = object_store_conf_from_env(env)
    assert conf == object_store_conf("http://store:9000", "key", "secret")
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert conf["spark.hadoop.fs.s3a.impl"] == "org.apache.hadoop.fs.s3a.S3AFileSystem"
    with pytest.raises(KeyError):
        object_store_conf_from_env({})


def test_deleter_uses_the_same_store():
    options = store_options(object_store_conf("http://store:9000", "key", "secret"))
    assert options == {
        "access_key": "key",
        "secret_key": "secret",
        "endpoint_override": "store:9000",
        "scheme": "http",
        "region": "us-east-1",
    }
    assert store_options({}) == {"scheme": "https"}
    assert path_in_store("s3a://bucket/a%20b/c.xml") == "bucket/a b/c.xml"
    assert path_in_store("file:/x/a%20b.xml") == "/x/a b.xml"


def test_work_folders_are_new_and_below_the_shared_root(spark):
    first, second = work_folder(spark, "x"), work_folder(spark, "x")
    assert first != second
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.landfall.local.root")
    assert f"{root.rstrip('/')}/x-" in first
