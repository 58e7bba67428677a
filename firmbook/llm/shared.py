"""Shared folder for intermediate tables, and packed columns for wide shuffles."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from firmbook.llm.words import mix


def workspace(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which the driver and all executors share.

    Only a local master may go without that setting; it gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="firmbook-")
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def settle(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write a table to the shared folder and read it again: what follows starts there."""
    path = f"{folder}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def home(ids: np.ndarray, ranges: int) -> np.ndarray:
    """The range that an id is dealt to, by a hash: ids that go up in steps spread like any others."""
    return (mix(ids.astype(np.int64).view(np.uint64)) % np.uint64(ranges)).astype(np.int64)


def pack(values: np.ndarray) -> bytes:
    """8-byte integers as byte planes, so that the shuffle's compression drops the constant ones."""
    return np.ascontiguousarray(values, dtype="<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, dtype=np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    """As pack, of the steps between ascending values."""
    return pack(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)
