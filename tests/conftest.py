from __future__ import annotations

import os
import struct
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    import sparktiles

    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield sparktiles.register(session)
    session.stop()


class Wkb:
    """Little-endian WKB literals."""

    @staticmethod
    def point(*ordinates: float, code: int = 1) -> bytearray:
        return bytearray(struct.pack("<BI", 1, code) + np.array(ordinates, "<f8").tobytes())

    @staticmethod
    def path(points) -> bytes:
        return struct.pack("<I", len(points)) + np.array(points, "<f8").tobytes()

    @staticmethod
    def line(points) -> bytearray:
        return bytearray(struct.pack("<BI", 1, 2) + Wkb.path(points))

    @staticmethod
    def polygon(*rings) -> bytearray:
        return bytearray(struct.pack("<BII", 1, 3, len(rings)) + b"".join(map(Wkb.path, rings)))

    @staticmethod
    def multi(code: int, *members) -> bytearray:
        return bytearray(struct.pack("<BII", 1, code, len(members)) + b"".join(map(bytes, members)))

    @staticmethod
    def square(x: float, y: float, half: float) -> list[tuple[float, float]]:
        return [(x - half, y - half), (x + half, y - half), (x + half, y + half), (x - half, y + half), (x - half, y - half)]


@pytest.fixture(scope="session")
def wkb():
    return Wkb
