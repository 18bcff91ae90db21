"""A folder of its own for each writer of a path.

A stream's file sink skips batches that the log in its folder has, by number. A new
checkpoint starts at number 0 again, so it must not share a folder with an old one;
and batch files beside a log would never be read.
"""

from __future__ import annotations

import hashlib
import posixpath

from pyspark.sql import SparkSession

from ..sources.written import WRITER, exists, has_log


def checkpoint_mark(checkpoint: str) -> str:
    """A short name for the stream with this checkpoint."""
    checkpoint = checkpoint.rstrip("/")
    return f"{posixpath.basename(checkpoint)}-{hashlib.sha256(checkpoint.encode()).hexdigest()[:8]}"


def own_folder(path: str, checkpoint: str) -> str:
    """The folder of the stream with this checkpoint."""
    return f"{path.rstrip('/')}/{WRITER}{checkpoint_mark(checkpoint)}"


def checked_folder(spark: SparkSession, path: str, checkpoint: str) -> str:
    """``own_folder``, unless it holds rows that the checkpoint doesn't know of.

    So it is after a checkpoint was removed: the numbers of its batches begin anew, and
    rows would be taken for written ones and lost, or replace others.
    """
    folder = own_folder(path, checkpoint)
    if exists(spark, folder) and not exists(spark, f"{checkpoint.rstrip('/')}/metadata"):
        raise ValueError(f"{folder} was written with another checkpoint at {checkpoint}; choose a new one")
    return folder


def stream_folder(spark: SparkSession, path: str, checkpoint: str) -> str:
    """The folder of a stream's file sink. Refuses one whose log the checkpoint doesn't know."""
    folder = own_folder(path, checkpoint)
    return checked_folder(spark, path, checkpoint) if has_log(spark, folder) else folder


def batch_folder(path: str) -> str:
    return f"{path.rstrip('/')}/{WRITER}batch"
