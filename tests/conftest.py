import os
import struct
import sys
import tempfile
import zlib

import numpy as np
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from featureflow.session import checkpoint_dir, local_session

    s = local_session(master="local[*]", shuffle_partitions=8)
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


def write_png(path: str, arr: np.ndarray) -> None:
    """PNG without an image library: RGB (h, w, 3) or grey (h, w) uint8."""
    arr = np.asarray(arr, dtype=np.uint8)
    h, w = arr.shape[:2]
    color = 2 if arr.ndim == 3 else 0
    raw = b"".join(b"\x00" + arr[y].tobytes() for y in range(h))

    def chunk(tag: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data) & 0xFFFFFFFF)

    png = (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, color, 0, 0, 0))
           + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(png)


def scratch() -> str:
    return tempfile.mkdtemp(prefix="ff-test-")
