import pickle

import pytest
from pyarrow import fs

from lake_ingest.operators.listing import list_objects
from lake_ingest.sources import store
from lake_ingest.sources.datasources import ByteRangeReader, ObjectListingReader
from lake_ingest.sources.store import SECRET_OPTION, StoreOptions, open_store, open_uri, store_options
from tests.conftest import rows

SETTINGS = {
    "endpoint": "http://store.example:9000", "endpoint.region": "eu-1", "path.style.access": "true",
    "connection.ssl.enabled": "false", "access.key": "name-of-key", "secret.key": "very-hidden",
}


@pytest.fixture
def configured(spark):
    for name, value in SETTINGS.items():
        spark.conf.set(f"spark.hadoop.fs.s3a.{name}", value)
    yield store_options(spark)
    for name in SETTINGS:
        spark.conf.unset(f"spark.hadoop.fs.s3a.{name}")


@pytest.fixture
def opened(monkeypatch):
    """The arguments with which a file system for a store is made; none is reached."""
    calls = []
    monkeypatch.setattr(store.fs, "S3FileSystem", lambda **arguments: calls.append(arguments) or fs.LocalFileSystem())
    return calls


def test_session_settings_reach_the_file_system(configured, opened):
    want = {
        "region": "eu-1", "endpoint_override": "store.example:9000", "scheme": "http", "force_virtual_addressing": False,
        "access_key": "name-of-key", "secret_key": "very-hidden",
    }
    assert open_store("s3a://lake/in", configured)[1] == "lake/in"
    assert open_uri("s3a://lake/in/a%20b.csv", configured)[1] == "lake/in/a b.csv"
    carried = pickle.loads(pickle.dumps(configured))
    open_store("s3://lake/in/", carried)
    through_options = StoreOptions.of_option(configured.as_option())
    open_store("s3a://lake", through_options)
    assert opened == [want] * 4


def test_data_sources_open_the_store_with_them(configured, opened, tmp_path):
    options = {"path": "s3a://lake/in", "tasks": "2"} | configured.as_option()
    with pytest.raises(FileNotFoundError):
        ObjectListingReader(options).partitions()
    assert opened[0]["endpoint_override"] == "store.example:9000"
    assert ByteRangeReader(options).store == configured


def test_a_bucket_has_settings_of_its_own():
    options = StoreOptions((("bucket.b.endpoint", "https://other"), ("endpoint", "http://all"), ("connection.ssl.enabled", "true")))
    assert options.arguments("b")["endpoint_override"] == "other" and options.arguments("b")["scheme"] == "https"
    assert options.arguments("a")["scheme"] == "http"
    anonymous = StoreOptions((("aws.credentials.provider", "org.apache.hadoop.fs.s3a.AnonymousAWSCredentialsProvider"),))
    assert anonymous.arguments("a") == {"anonymous": True}
    assert StoreOptions((("endpoint", "host"), ("connection.ssl.enabled", "false"))).arguments("a")["scheme"] == "http"


def test_secrets_are_not_shown(spark, configured, put):
    assert "very-hidden" not in repr(configured) and "name-of-key" not in repr(configured)
    assert "store.example" in repr(configured)
    # Spark hides the values of options whose names match its setting.
    redacted = spark._jvm.org.apache.spark.sql.internal.SQLConf.get().redactOptions(
        spark._jvm.PythonUtils.toScalaMap({SECRET_OPTION: "very-hidden"})
    )
    assert "very-hidden" not in redacted.toString()
    listed = list_objects(spark, put("a.txt", "x"))
    assert rows(listed, "key") == [("a.txt",)]
    assert "very-hidden" not in listed._jdf.queryExecution().toString()


def test_other_roots_need_no_settings(configured, tmp_path):
    assert open_store(str(tmp_path), configured)[1] == str(tmp_path)
    assert open_store(f"file:{tmp_path}", configured)[1] == str(tmp_path)
