"""Objects of a store, reached from tasks through pyarrow's file systems.

One way for every name and size: Spark's own readers skip names that begin
with ``_`` or ``.`` and take ``[ ]`` in a path for a pattern."""
from __future__ import annotations

# Hadoop file-system schemes and the pyarrow name of the same store.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def store_opener(schemes=None):
    """A function (uri) -> (file system, path, prefix); ``prefix`` + a path
    of that file system is the object key.  Made of plain captured values, so
    it is shipped to executors by value."""
    schemes = dict(schemes or SCHEMES)

    def open_store(uri):
        import pyarrow.fs as pafs

        scheme, colon, rest = uri.partition(":")
        if not colon or "/" in scheme:                      # a plain local path
            return pafs.LocalFileSystem(), uri, "file:"
        if scheme == "file":
            return pafs.LocalFileSystem(), "/" + rest.lstrip("/"), "file:"
        host = rest.lstrip("/").partition("/")[0]
        name = schemes.get(scheme, scheme)
        fs, _ = pafs.FileSystem.from_uri(f"{name}://{host}")
        if name in ("hdfs", "viewfs"):
            return fs, rest.lstrip("/")[len(host):] or "/", f"{scheme}://{host}"
        return fs, rest.lstrip("/"), f"{scheme}://"
    return open_store
