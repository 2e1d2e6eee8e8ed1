"""Media columns: payloads as baseline JPEG files, read back as thumbnails.

A text's bytes, padded to whole rows, are stored without loss as the luminance of
a JPEG (see ``jpeg``). The stored bytes are then parsed and decoded like those of
any other image, and dimensions and a thumbnail hash are kept as features.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from rosterloom.llm import jpeg
from rosterloom.llm.common import mapped, slices, texts_of


def payload_of(text: str | None) -> bytes:
    """UTF-8 with spaces up to a positive multiple of a row; null is empty."""
    data = (text or "").encode("utf-8", "surrogatepass")
    return data + b" " * (-len(data) % jpeg.ROW or (0 if data else jpeg.ROW))


def shrink(image: np.ndarray, rows: int = 8, columns: int = 9) -> np.ndarray:
    """Means over a grid; a grid finer than the image repeats its samples."""
    def ends(n: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
        a = np.arange(parts) * n // parts
        return a, np.maximum(np.arange(1, parts + 1) * n // parts, a + 1)

    total = np.zeros((image.shape[0] + 1, image.shape[1] + 1), np.int64)
    total[1:, 1:] = image.astype(np.int64).cumsum(0).cumsum(1)
    (t, b), (left, right) = ends(image.shape[0], rows), ends(image.shape[1], columns)
    area = (b - t)[:, None] * (right - left)[None, :]
    return (total[np.ix_(b, right)] - total[np.ix_(t, right)] - total[np.ix_(b, left)] + total[np.ix_(t, left)]) / area


def thumbnail_hash(image: np.ndarray) -> str:
    """Difference hash: whether each of 8 x 8 cells is darker than its right neighbour."""
    small = shrink(image)
    return np.packbits(small[:, 1:] > small[:, :-1]).tobytes().hex()


def features(data: bytes, scans: list[jpeg.Scan], images: list[np.ndarray]) -> str:
    """Dimensions of the first image, number of images, and the hashes of all."""
    return f"jpeg:{scans[0].width}x{scans[0].height}:{len(scans)}:" + ",".join(map(thumbnail_hash, images)) if scans else "none"


#: What any bytes may raise that are no baseline JPEG.
_BROKEN = (ValueError, LookupError, ArithmeticError, MemoryError, TypeError, struct.error)


def images(files: list[list[jpeg.Scan] | None]) -> list[list[np.ndarray]]:
    """The decoded images of each file, none of a file whose scans are broken."""
    try:
        flat = iter(jpeg.thumbnails([s for scans in files for s in scans or ()]))
        return [[next(flat) for _ in scans or ()] for scans in files]
    except _BROKEN:
        # one by one, so that a broken file takes no other along
        return [[]] if len(files) == 1 else [images([scans])[0] for scans in files]


def encode(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media): each text of ``docs`` (doc_id, text) as a JPEG."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_bytes", T.LongType()), T.StructField("media", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = texts_of(batch)
            sizes = [len(t.encode("utf-8", "surrogatepass")) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(jpeg.write([payload_of(t) for t in texts]), pa.binary())], schema.names)

    return mapped(docs.select("doc_id", "text"), run, schema)


def decode(media: DataFrame, with_payload: bool = False) -> DataFrame:
    """Reads the column ``media``: payload_bytes, payload_sha256, tail_crc32 (of
    the payload's last 16 bytes), media_bytes, media_sha256, width, height, images
    and feature, with the other columns (of ``media`` only if ``with_payload``, as
    ``payload``). Bytes that are no baseline JPEG, or null, have a null payload
    and the feature ``none``."""
    rest = [f for f in media.schema.fields if f.name != "media"]
    own = [("payload_bytes", T.LongType()), ("payload_sha256", T.StringType()), ("tail_crc32", T.LongType()), ("media_bytes", T.LongType()), ("media_sha256", T.StringType()), ("width", T.IntegerType()), ("height", T.IntegerType()), ("images", T.IntegerType()), ("feature", T.StringType())] + [("payload", T.BinaryType())] * with_payload
    schema = T.StructType([*rest, *(T.StructField(n, t) for n, t in own)])

    def one(data: bytes | None, scans: list | None, images: list) -> tuple:
        if not scans:
            return (None, None, None, None if data is None else len(data), None if data is None else hashlib.sha256(data).hexdigest(), None, None, None, "none", None)
        payload = b"".join(x.tobytes() for x in images)
        return (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(data), hashlib.sha256(data).hexdigest(), scans[0].width, scans[0].height, len(scans), features(data, scans, images), payload)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "media"):
            parsed = []
            for data in batch.column("media").to_pylist():
                try:
                    parsed.append((data, jpeg.parse(data) if data else None))
                except _BROKEN:
                    parsed.append((data, None))
            rows = []
            for (data, scans), thumbs in zip(parsed, images([scans for _, scans in parsed])):
                rows.append(one(data, scans if thumbs else None, thumbs))
            columns = [batch.column(f.name) for f in rest] + [pa.array([r[k] for r in rows], {"payload": pa.binary()}.get(n, pa.string() if isinstance(t, T.StringType) else pa.int32() if isinstance(t, T.IntegerType) else pa.int64())) for k, (n, t) in enumerate(own)]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return mapped(media, run, schema)
