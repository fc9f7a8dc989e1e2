import os
import struct
import sys
import zlib
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def png(width=8, height=8, damage=None):
    def chunk(kind, body):
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    lines = b"".join(b"\0" + bytes((x * y * 31 + 7 * x) % 256 for x in range(width)) for y in range(height))
    packed = zlib.compress(lines)
    if damage == "flip":
        packed = bytes([packed[0] ^ 0xFF]) + packed[1:]
    head = struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)
    end = b"" if damage == "no_end" else chunk(b"IEND", b"")
    whole = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", packed) + end
    return whole[: len(whole) // 2] if damage == "half" else whole


def jpeg(spark, width=64, height=48):
    jvm = spark._jvm
    image = jvm.java.awt.image.BufferedImage(width, height, 1)
    for x in range(width):
        for y in range(height):
            image.setRGB(x, y, (x * 4 << 16) + (y * 5 << 8) + (x * y % 256))
    out = jvm.java.io.ByteArrayOutputStream()
    assert jvm.javax.imageio.ImageIO.write(image, "jpg", out)
    return bytes(out.toByteArray())


def webp(claimed=None):
    body = b"WEBPVP8X" + (10).to_bytes(4, "little") + bytes(4) + (99).to_bytes(3, "little") + (49).to_bytes(3, "little")
    return b"RIFF" + (claimed or len(body)).to_bytes(4, "little") + body


def with_thumbnail(picture):
    """The picture with itself in an application segment, as cameras leave it."""
    body = b"Exif\0\0" + picture
    return picture[:2] + b"\xff\xe1" + (len(body) + 2).to_bytes(2, "big") + body + picture[2:]


def in_riff(*chunks, claimed=None):
    body = b"WEBP" + b"".join(kind + len(data).to_bytes(4, "little") + data + bytes(len(data) % 2) for kind, data in chunks)
    return b"RIFF" + (claimed or len(body)).to_bytes(4, "little") + body


def bad_checksum(picture):
    """A flipped bit in the checksum of the last chunk before the end."""
    at = len(picture) - 13
    return picture[:at] + bytes([picture[at] ^ 1]) + picture[at + 1 :]


def put(root, files):
    for name, content in files.items():
        path = Path(root) / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content)


def tuples(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
