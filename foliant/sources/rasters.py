"""Page rasters: a cache of PNG files addressed by their content, and thumbnails, made with the standard library and
numpy. Rendering itself is injected; rasters are 8-bit gray bytes with a width and a height."""
from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

SIGNATURE = b"\x89PNG\r\n\x1a\n"


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def png_bytes(gray: np.ndarray) -> bytes:
    """A gray raster (height, width) as a PNG file."""
    height, width = gray.shape
    rows = np.hstack([np.zeros((height, 1), np.uint8), gray.astype(np.uint8)])  # each begins with its filter: none
    return SIGNATURE + _chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)) + _chunk(b"IDAT", zlib.compress(rows.tobytes())) + _chunk(b"IEND", b"")


def read_png(content: bytes) -> np.ndarray:
    """The raster of a file that png_bytes() made."""
    width, height = struct.unpack(">II", content[16:24])
    at, data = 8, b""
    while at < len(content):
        size, kind = struct.unpack(">I4s", content[at : at + 8])
        data += content[at + 8 : at + 8 + size] if kind == b"IDAT" else b""
        at += size + 12
    return np.frombuffer(zlib.decompress(data), np.uint8).reshape(height, width + 1)[:, 1:]


def shrunk(gray: np.ndarray, edge: int) -> np.ndarray:
    """A raster whose longer side is at most `edge`, each pixel the mean of those that it stands for."""
    height, width = gray.shape
    scale = edge / max(height, width)
    if scale >= 1:
        return gray
    to = max(1, round(height * scale)), max(1, round(width * scale))
    cuts = [np.arange(n + 1) * size // n for n, size in zip(to, (height, width), strict=True)]
    sums = np.add.reduceat(np.add.reduceat(gray.astype(np.float64), cuts[0][:-1], axis=0), cuts[1][:-1], axis=1)
    return np.round(sums / np.outer(np.diff(cuts[0]), np.diff(cuts[1]))).astype(np.uint8)


def write_rasters(rasters: DataFrame, key: str, folder: str, edge: int | None = None, rebuild: bool = False) -> DataFrame:
    """(key, path, hash, width, height, status): each raster of (key, raster, width, height) as a PNG file below folder,
    its path made of the SHA-256 of the raster, so equal pages are one file and a task may be repeated. With `edge`, the
    files are thumbnails. A file that is there is left alone unless `rebuild`; what fails is a row's status."""
    kind = rasters.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs as pafs

        files, base = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            out = []
            for k, raw, w, h in zip(batch[key], batch["raster"], batch["width"], batch["height"], strict=True):
                try:
                    gray = np.frombuffer(raw, np.uint8).reshape(int(h), int(w))
                    digest = hashlib.sha256(raw).hexdigest()
                    path = f"{digest[:2]}/{digest}{'' if edge is None else f'-{edge}'}.png"
                    shown = gray if edge is None else shrunk(gray, edge)
                    there = files.get_file_info(f"{base}/{path}").type == pafs.FileType.File
                    if rebuild or not there:
                        files.create_dir(f"{base}/{digest[:2]}", recursive=True)
                        with files.open_output_stream(f"{base}/{path}", compression=None) as f:
                            f.write(png_bytes(shown))
                    out.append((k, path, digest, shown.shape[1], shown.shape[0], "success"))
                except Exception as e:  # noqa: BLE001  one page's failure is its row's
                    out.append((k, None, None, None, None, f"error: {type(e).__name__}"))
            done = pd.DataFrame(out, columns=[key, "path", "hash", "width", "height", "status"])
            yield done.astype({"width": "Int32", "height": "Int32"})

    return rasters.select(key, "raster", "width", "height").mapInPandas(run, f"{key} {kind}, path string, hash string, width int, height int, status string")
