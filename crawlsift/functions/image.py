"""Pixels: decoding, resizing, packing."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

IMAGE = T.StructType(
    [
        T.StructField("height", T.IntegerType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("channels", T.IntegerType()),
        T.StructField("data", T.BinaryType()),
    ]
)
_ARROW_IMAGE = pa.struct(
    [
        ("height", pa.int32()),
        ("width", pa.int32()),
        ("channels", pa.int32()),
        ("data", pa.binary()),
    ]
)
# Published per-channel mean and deviation of the usual text-image model.
CHANNEL_MEAN = (0.48145466, 0.4578275, 0.40821073)
CHANNEL_STD = (0.26862954, 0.26130258, 0.27577711)
#: Bytes of model pixels that leave a worker at once: they may be many times the images they are of.
PIXEL_BYTES = 4 << 20


def pack_image(pixels: np.ndarray | None) -> dict | None:
    """Pixel array (height, width, 3) of bytes as a row; no padding whatever the size."""
    if pixels is None:
        return None
    height, width, channels = pixels.shape
    data = np.ascontiguousarray(pixels, dtype=np.uint8).tobytes()
    return {"height": height, "width": width, "channels": channels, "data": data}


def unpack_image(image) -> np.ndarray:
    """Pixel array of a packed image."""
    flat = np.frombuffer(image["data"], dtype=np.uint8)
    return flat.reshape(int(image["height"]), int(image["width"]), int(image["channels"]))


def decode_with(decoder: Callable[[bytes], np.ndarray | None]) -> Callable[[Column], Column]:
    """Column function that decodes image bytes in place with a Python decoder."""

    @F.arrow_udf(IMAGE)
    def decode(payload: pa.Array) -> pa.Array:
        rows = [
            None if not p.is_valid else pack_image(decoder(p.as_py())) for p in payload
        ]
        return pa.array(rows, _ARROW_IMAGE)

    # a later filter on the image must not decode it a second time
    return decode.asNondeterministic()


@F.arrow_udf(IMAGE)
def rgb_from_bgr(image: pa.Array) -> pa.Array:
    """Packed RGB from rows of Spark's image source: 1, 3 or 4 channels in BGR order."""
    rows = []
    for item in image:
        value = item.as_py()
        if value is None or value["height"] <= 0:
            rows.append(None)
            continue
        pixels = unpack_image(
            {
                "height": value["height"],
                "width": value["width"],
                "channels": value["nChannels"],
                "data": value["data"],
            }
        )
        if pixels.shape[2] == 1:
            pixels = np.repeat(pixels, 3, axis=2)
        rows.append(pack_image(pixels[:, :, 2::-1]))
    return pa.array(rows, _ARROW_IMAGE)


@lru_cache(maxsize=512)
def _weights(size_in: int, size_out: int) -> np.ndarray:
    """Antialiased linear interpolation along one axis as a (size_out, size_in) matrix.

    Half-pixel centres; the triangle is widened by the shrink factor and its weights are
    normalised where it leaves the image.
    """
    scale = size_in / size_out
    reach = max(scale, 1.0)
    centre = (np.arange(size_out) + 0.5) * scale
    distance = np.abs((np.arange(size_in) + 0.5)[None, :] - centre[:, None])
    weight = np.clip(1.0 - distance / reach, 0.0, None)
    return (weight / weight.sum(axis=1, keepdims=True)).astype(np.float32)


def resize_pixels(pixels: np.ndarray, height: int, width: int) -> np.ndarray:
    """``pixels / 255`` resized to (height, width, channels)."""
    rows = _weights(pixels.shape[0], height)
    columns = _weights(pixels.shape[1], width)
    scaled = pixels.astype(np.float32) / np.float32(255)
    return np.einsum("ij,jkc,lk->ilc", rows, scaled, columns, optimize=True).astype(np.float32)


def _map_pixels(frame: pd.DataFrame, make: Callable[[np.ndarray], np.ndarray]) -> pd.Series:
    """Apply ``make`` to the pixels of every packed image of a batch."""
    rows = frame.to_dict("records")
    out = [None if row["data"] is None else make(unpack_image(row)).ravel() for row in rows]
    return pd.Series(out, dtype=object)


def resize_images(image: Column, height: int, width: int) -> Column:
    """Resized pixels as ``array<float>`` of height x width x 3 in 0..1."""

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def resize(images: pd.DataFrame) -> pd.Series:
        return _map_pixels(images, lambda pixels: resize_pixels(pixels, height, width))

    return resize(image)


def model_pixels(pixels: np.ndarray, size: int, mean=CHANNEL_MEAN, std=CHANNEL_STD) -> np.ndarray:
    """Resized, per-channel normalised, channel first (3 x size x size)."""
    mean_row = np.asarray(mean, dtype=np.float32)
    std_row = np.asarray(std, dtype=np.float32)
    return ((resize_pixels(pixels, size, size) - mean_row) / std_row).transpose(2, 0, 1)


def similarity_pixels(
    image: Column, size: int = 224, mean=CHANNEL_MEAN, std=CHANNEL_STD
) -> Column:
    """``model_pixels`` as a column, some PIXEL_BYTES at a time."""
    values = 3 * size * size
    most = max(1, PIXEL_BYTES // (4 * values))

    def made(images: pa.Array) -> pa.Array:
        missing = np.array([not (x.is_valid and x["data"].is_valid) for x in images], dtype=bool)
        pixels = [model_pixels(unpack_image(x.as_py()), size, mean, std).ravel() for x, no in zip(images, missing) if not no]
        offsets = np.concatenate([[0], np.cumsum(np.where(missing, 0, values))]).astype(np.int32)
        flat = np.concatenate([np.empty(0, dtype=np.float32), *pixels])
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat), mask=pa.array(missing))

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def prepare(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for images in batches:
            for at in range(0, len(images), most):
                yield made(images.slice(at, most))

    return prepare(image)


def similarity_inputs(
    alt: Column, image: Column, tokenize: Callable[[Column], Column], size: int = 224
) -> Column:
    """``struct<input_ids, attention_mask, pixels>`` for a text-image model."""
    tokens = tokenize(alt)
    return F.struct(
        tokens["input_ids"].alias("input_ids"),
        tokens["attention_mask"].alias("attention_mask"),
        similarity_pixels(image, size).alias("pixels"),
    )
