"""File access inside tasks, for local paths and for object stores alike."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from urllib.parse import unquote

from pyarrow import fs
from pyspark.sql import SparkSession

# Its name says "secret", so that Spark shows no value.
SECRET_OPTION = "store_secret"
# Ends of the names of settings that may be shown.
_SHOWN = ("endpoint", "region", "access", "enabled", "provider")
_READ_BUFFER = 1024 * 1024


@dataclass(frozen=True, repr=False)
class StoreOptions:
    """How tasks reach an S3-compatible store: settings ``fs.s3a.*`` of the session.

    They travel with a task's function, or as an option whose name Spark redacts in plans and logs. Where no
    keys are set, the process's own credentials count, as for Spark's reader.
    """

    settings: tuple[tuple[str, str], ...] = ()

    def __repr__(self) -> str:
        shown = ", ".join(f"{n}={v if n.endswith(_SHOWN) else '***'}" for n, v in self.settings)
        return f"StoreOptions({shown})"

    def __reduce__(self):
        return StoreOptions, (self.settings,)

    def as_option(self) -> dict[str, str]:
        """The settings as one option of a data source."""
        return {SECRET_OPTION: json.dumps(self.settings)} if self.settings else {}

    @staticmethod
    def of_option(options: Mapping[str, str]) -> StoreOptions:
        held = json.loads(options.get(SECRET_OPTION, "[]"))
        return StoreOptions(tuple((name, value) for name, value in held))

    def arguments(self, bucket: str) -> dict[str, object]:
        """Arguments of the file system for a bucket, whose own settings go before those of all."""
        held = dict(self.settings)

        def get(name: str) -> str | None:
            return held.get(f"bucket.{bucket}.{name}", held.get(name))

        out: dict[str, object] = {"region": get("endpoint.region")}
        if endpoint := get("endpoint"):
            scheme, _, host = endpoint.rpartition("://")
            tls = (get("connection.ssl.enabled") or "true").lower() != "false"
            out |= {"endpoint_override": host, "scheme": scheme or ("https" if tls else "http")}
            out["force_virtual_addressing"] = (get("path.style.access") or "false").lower() != "true"
        if "AnonymousAWSCredentialsProvider" in (get("aws.credentials.provider") or ""):
            out["anonymous"] = True
        elif get("access.key"):
            out |= {"access_key": get("access.key"), "secret_key": get("secret.key")}
            out["session_token"] = get("session.token")
        return {name: value for name, value in out.items() if value is not None}


def store_options(spark: SparkSession) -> StoreOptions:
    """The session's settings for S3-compatible stores, as ``session.rest_catalog_conf`` and launchers set them."""
    prefix = "spark.hadoop.fs.s3a."
    found = {name: value for name, value in spark.conf.getAll.items() if name.startswith(prefix)}
    return StoreOptions(tuple(sorted((name[len(prefix) :], value) for name, value in found.items())))


def open_store(root: str, options: StoreOptions | None = None) -> tuple[fs.FileSystem, str]:
    """File system and base path of a root such as ``/data``, ``file:/data`` or ``s3a://bucket/in``."""
    if root.startswith("s3a://"):
        root = "s3://" + root[len("s3a://") :]
    if root.startswith("s3://") and options is not None and options.settings:
        path = root[len("s3://") :].rstrip("/")
        return fs.S3FileSystem(**options.arguments(path.split("/")[0])), path
    if "://" not in root and root.startswith("file:"):
        root = root[len("file:") :]
    if "://" not in root:
        return fs.LocalFileSystem(), root.rstrip("/") or "/"
    store, base = fs.FileSystem.from_uri(root)
    return store, base.rstrip("/") or "/"


def open_uri(uri: str, options: StoreOptions | None = None) -> tuple[fs.FileSystem, str]:
    """File system and path of a file as Spark's metadata column names it, with its odd signs escaped."""
    if uri.startswith(("s3a://", "s3://")):
        return open_store(unquote(uri), options)
    return fs.FileSystem.from_uri(uri)


def join(base: str, key: str) -> str:
    """Path of a key; one that leaves its root is refused, for a folder knows such segments."""
    if any(segment in (".", "..") for segment in key.split("/")):
        raise PermissionError(f"not a key below the root: {key!r}")
    return f"{base.rstrip('/')}/{key}"


def _entries(store: fs.FileSystem, folder: str) -> Iterator[fs.FileInfo]:
    """A folder's entries; those of a local one pass by and are never held as a list."""
    if not isinstance(store, fs.LocalFileSystem):
        yield from store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        return
    try:
        entries = os.scandir(folder)
    except FileNotFoundError:
        return
    with entries:
        for entry in entries:
            try:
                stat, is_folder = entry.stat(), entry.is_dir()
            except FileNotFoundError:
                continue
            if is_folder:
                yield fs.FileInfo(entry.path, type=fs.FileType.Directory)
            else:
                yield fs.FileInfo(
                    entry.path, type=fs.FileType.File, size=stat.st_size, mtime_ns=stat.st_mtime_ns
                )


def subfolders(store: fs.FileSystem, folder: str) -> list[str]:
    return [info.path for info in _entries(store, folder) if info.type == fs.FileType.Directory]


def walk(store: fs.FileSystem, folder: str, recursive: bool = True) -> Iterator[fs.FileInfo]:
    """Files under a folder as they are found; hidden and empty ones too."""
    pending = [folder]
    while pending:
        for info in _entries(store, pending.pop()):
            if info.type == fs.FileType.Directory:
                if recursive:
                    pending.append(info.path)
            else:
                yield info


def read_range(store: fs.FileSystem, path: str, start: int, length: int) -> tuple[int, bytes]:
    """Size of a file and up to ``length`` of its bytes from ``start``."""
    with store.open_input_file(path) as file:
        size = file.size()
        if start >= size:
            return size, b""
        file.seek(start)
        return size, file.read(length)


def hash_range(store: fs.FileSystem, path: str, start: int, length: int) -> str:
    """MD5 of a byte range, read through a small buffer."""
    digest = hashlib.md5()
    with store.open_input_file(path) as file:
        file.seek(start)
        while length > 0 and (piece := file.read(min(length, _READ_BUFFER))):
            digest.update(piece)
            length -= len(piece)
    return digest.hexdigest()
