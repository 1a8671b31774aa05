"""Session and catalog binding."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Mapping

from pyspark.sql import SparkSession

# Adaptive execution splits skewed join partitions and coalesces small ones at run time.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Noting the source line of every expression costs more than planning the queries here.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app_name: str, catalog_conf: Mapping[str, str] | None = None, master: str | None = None
) -> SparkSession:
    """A session on the built-in Parquet catalog, or on any catalog given as Spark settings.

    Without ``master`` the launcher (spark-submit) decides where the job runs.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**DEFAULTS, **(catalog_conf or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def rest_catalog_conf(
    name: str,
    uri: str,
    warehouse: str,
    *,
    s3_endpoint: str | None = None,
    region: str | None = None,
    scope: str = "PRINCIPAL_ROLE:ALL",
    token_uri: str | None = None,
    credential_env: tuple[str, str] = ("CATALOG_CLIENT_ID", "CATALOG_CLIENT_SECRET"),
) -> dict[str, str]:
    """Spark settings for an Iceberg REST catalog on S3-compatible storage.

    Secrets come from the environment only. The Iceberg runtime must be on the class path.
    """
    client_id, client_secret = (os.environ[v] for v in credential_env)
    access_key = os.environ["AWS_ACCESS_KEY_ID"]
    secret_key = os.environ["AWS_SECRET_ACCESS_KEY"]
    region = region or os.environ.get("AWS_REGION", "us-east-1")
    catalog = f"spark.sql.catalog.{name}"
    s3a = "spark.hadoop.fs.s3a"
    conf = {
        "spark.sql.defaultCatalog": name,
        "spark.sql.extensions": (
            "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions"
        ),
        catalog: "org.apache.iceberg.spark.SparkCatalog",
        f"{catalog}.catalog-impl": "org.apache.iceberg.rest.RESTCatalog",
        f"{catalog}.uri": uri,
        f"{catalog}.warehouse": warehouse,
        f"{catalog}.credential": f"{client_id}:{client_secret}",
        f"{catalog}.scope": scope,
        f"{catalog}.oauth2-server-uri": token_uri or f"{uri.rstrip('/')}/v1/oauth/tokens",
        f"{catalog}.token-refresh-enabled": "false",
        f"{catalog}.io-impl": "org.apache.iceberg.aws.s3.S3FileIO",
        f"{catalog}.client.region": region,
        f"{catalog}.s3.access-key-id": access_key,
        f"{catalog}.s3.secret-access-key": secret_key,
        f"{s3a}.access.key": access_key,
        f"{s3a}.secret.key": secret_key,
        f"{s3a}.endpoint.region": region,
        f"{s3a}.aws.credentials.provider": (
            "org.apache.hadoop.fs.s3a.SimpleAWSCredentialsProvider"
        ),
    }
    if s3_endpoint:
        conf |= {
            f"{catalog}.s3.endpoint": s3_endpoint,
            f"{catalog}.s3.path-style-access": "true",
            f"{s3a}.endpoint": s3_endpoint,
            f"{s3a}.path.style.access": "true",
            f"{s3a}.connection.ssl.enabled": str(s3_endpoint.startswith("https")).lower(),
        }
    return conf


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Only where that is unset (tests, local mode) is a temporary folder chosen and set.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(named)
        return named.rstrip("/")
    if spark.sparkContext.getCheckpointDir() is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lake-ingest-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")
