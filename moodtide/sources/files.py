"""File systems for the few Python functions that open files themselves, on executors."""

from __future__ import annotations


def arrow_file_system(uri: str):
    """Arrow's file system and path of a qualified URI."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
