"""Image bytes: signatures, sizes, screening; pixels: perceptual hash, quality, scoring.

Everything about bytes, sizes too, is column expressions: headers tell width and height without decoding. Pixels come
from Spark's ``image`` source (``spark.read.format("image").load(path).select("image.*")``, which reads JPEG, PNG and
BMP), or through a ``decoder`` that turns bytes into an H x W x 3 BGR array or None.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.schemas import MAX_BYTES, MAX_PIXELS

Decoder = Callable[[bytes], "np.ndarray | None"]
#: JPEG segments that are looked at for the frame header.
SEGMENTS = 512
PIXELS = ("height", "width", "nChannels", "data")


# -- bytes ------------------------------------------------------------------------------------------------


def mime_type(content: Column) -> Column:
    """The image type by signature, null where it is none of JPEG, PNG, WebP."""
    head = lambda hexes, start=1: F.substring(content, start, len(hexes) // 2) == F.unhex(F.lit(hexes))
    return F.when(head("FFD8FF"), "image/jpeg").when(head("89504E470D0A1A0A"), "image/png").when(head("52494646") & head("57454250", 9), "image/webp")


def screen_code(content: Column, width: Column | None = None, height: Column | None = None, max_bytes: int = MAX_BYTES, max_pixels: int = MAX_PIXELS) -> Column:
    """200, or why an upload is refused: 413 too many bytes, 400 too short, 415 other type, 400 not decodable
    (null size), 413 too many pixels; in this order. Without sizes the last two are left out."""
    size = F.octet_length(content)
    code = F.when(size > max_bytes, 413).when(content.isNull() | (size < 12), 400).when(mime_type(content).isNull(), 415)
    if width is not None and height is not None:
        code = code.when(width.isNull() | height.isNull(), 400).when(width.cast("long") * height > max_pixels, 413)
    return code.otherwise(200)


def number(digits: Column, start: int, size: int, little: bool = False) -> Column:
    """The integer of ``size`` bytes from byte ``start`` (1 is the first) of hexadecimal ``digits``."""
    at = lambda k, n: F.substring(digits, 2 * (start + k) - 1, 2 * n)
    text = F.concat(*[at(k, 1) for k in reversed(range(size))]) if little else at(0, size)
    return F.conv(text, 16, 10).cast("long")


def jpeg_size(content: Column, segments: int = SEGMENTS) -> Column:
    """Width and height of a JPEG's frame header: a walk over its segments, null if there is none among the first
    ``segments``."""

    def step(s: Column, _: Column) -> Column:
        x = F.hex(F.substring(content, s["at"], F.lit(9)))
        kind, size = F.substring(x, 3, 2), number(x, 3, 2)
        frame = kind.between("C0", "CF") & ~kind.isin("C4", "C8", "CC")
        alone = kind.between("D0", "D8") | (kind == "01")
        move = F.when(kind == "FF", s["at"] + 1).when(alone, s["at"] + 2).when(kind.isin("D9", "DA") | frame | (F.length(x) < 8), F.lit(0)).otherwise(s["at"] + 2 + size)
        here = (s["at"] > 0) & (F.substring(x, 1, 2) == "FF")
        found = here & frame & (F.length(x) == 18)
        return F.struct(
            F.when(here, move).otherwise(F.lit(0)).cast("int").alias("at"),
            F.when(found, number(x, 8, 2)).otherwise(s["width"]).alias("width"),
            F.when(found, number(x, 6, 2)).otherwise(s["height"]).alias("height"),
        )

    none = F.lit(None).cast("long")
    start = F.struct(F.lit(3).alias("at"), none.alias("width"), none.alias("height"))
    most = F.least(F.lit(segments), F.greatest(F.lit(1), F.floor(F.octet_length(content) / 2)).cast("int"))
    return F.aggregate(F.sequence(F.lit(1), most), start, step)


def image_size(content: Column) -> Column:
    """(width, height) from the header of a JPEG, PNG, WebP or BMP image, null for anything else or anything broken."""
    x = F.hex(F.substring(content, 1, 30))
    size = lambda w, h: F.struct(w.cast("int").alias("width"), h.cast("int").alias("height"))
    is_ = lambda start, hexes: F.substring(x, 2 * start - 1, len(hexes)) == hexes
    jpeg = jpeg_size(content)
    lossless = number(x, 22, 4, True)
    low14 = lambda v: v.bitwiseAND(0x3FFF)
    whole = lambda n: F.octet_length(content) >= n
    # BMP rows may run downwards, which a negative height says
    upright = lambda v: F.abs(F.when(v >= 2**31, v - 2**32).otherwise(v))
    found = (
        F.when(is_(1, "FFD8FF"), size(jpeg["width"], jpeg["height"]))
        .when(is_(1, "89504E470D0A1A0A") & is_(13, "49484452") & whole(24), size(number(x, 17, 4), number(x, 21, 4)))
        .when(is_(1, "52494646") & is_(9, "57454250565038") & whole(30), F.when(is_(16, "20") & is_(24, "9D012A"), size(low14(number(x, 27, 2, True)), low14(number(x, 29, 2, True))))
            .when(is_(16, "4C") & is_(21, "2F"), size(low14(lossless) + 1, low14(F.shiftright(lossless, 14)) + 1))
            .when(is_(16, "58"), size(number(x, 25, 3, True) + 1, number(x, 28, 3, True) + 1)))
        .when(is_(1, "424D") & whole(26), size(number(x, 19, 4, True), upright(number(x, 23, 4, True))))
    )
    return F.when((found["width"] > 0) & (found["height"] > 0), found)


def screen_content(files: DataFrame, max_bytes: int = MAX_BYTES, max_pixels: int = MAX_PIXELS, content_col: str = "content", sizes: bool = False) -> DataFrame:
    """``files`` with ``mime`` and ``screen_code``; uses ``width`` and ``height`` where the columns exist, or, with
    ``sizes``, what the header says."""
    content = F.col(content_col)
    sized = {"width", "height"} <= set(files.columns)
    of = image_size(content)
    width, height = (F.col("width"), F.col("height")) if sized else (of["width"], of["height"]) if sizes else (None, None)
    return files.withColumn("mime", mime_type(content)).withColumn("screen_code", screen_code(content, width, height, max_bytes, max_pixels))


# -- pixels -----------------------------------------------------------------------------------------------


def pixel_array(height: int, width: int, channels: int, data: bytes) -> np.ndarray:
    """A row of Spark's image source as an H x W x 3 BGR array."""
    image = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    return np.repeat(image, 3, axis=2) if channels == 1 else image[:, :, :3]


def grey(image: np.ndarray) -> np.ndarray:
    """Luma of a BGR image, ITU-R 601 weights."""
    return image[:, :, :3].astype(np.float64) @ np.array([0.114, 0.587, 0.299])


@lru_cache(maxsize=64)
def resize_weights(size: int, to: int) -> np.ndarray:
    """Lanczos (three lobes) weights from ``size`` samples to ``to``; widened when shrinking."""
    scale = max(size / to, 1.0)
    centre = (np.arange(to) + 0.5) * size / to - 0.5
    x = (np.arange(size)[None, :] - centre[:, None]) / scale
    w = np.where(np.abs(x) < 3, np.sinc(x) * np.sinc(x / 3), 0.0)
    return w / w.sum(axis=1, keepdims=True)


@lru_cache(maxsize=8)
def cosines(n: int) -> np.ndarray:
    """Orthonormal DCT-II matrix."""
    k, i = np.arange(n)[:, None], np.arange(n)[None, :]
    return np.cos(np.pi * (2 * i + 1) * k / (2 * n)) * np.where(k == 0, np.sqrt(1 / n), np.sqrt(2 / n))


def phash(image: np.ndarray, hash_size: int = 8) -> str:
    """Hexadecimal perceptual hash: low DCT frequencies of the shrunk grey image against their median."""
    if hash_size <= 0:
        raise ValueError("hash_size must be positive")
    n, g = 4 * hash_size, grey(image)
    small = np.clip(np.rint(resize_weights(g.shape[0], n) @ g @ resize_weights(g.shape[1], n).T), 0, 255)
    c = cosines(n)
    low = (c @ small @ c.T)[:hash_size, :hash_size]
    bits = "".join("1" if b else "0" for b in (low > np.median(low)).ravel())
    return f"{int(bits, 2):0{(hash_size * hash_size + 3) // 4}x}"


def quality(image: np.ndarray) -> tuple[float, float]:
    """(variance of the Laplacian, mean brightness)."""
    g = grey(image)
    p = np.pad(g, 1, mode="reflect") if min(g.shape) > 1 else np.pad(g, 1, mode="edge")
    lap = p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * g
    return float(lap.var()), float(g.mean())


def described(image: np.ndarray | None, hash_size: int) -> tuple:
    return (None, None, None) if image is None or not image.size else (phash(image, hash_size), *quality(image))


def describe_pixels(images: DataFrame, hash_size: int = 8, path_col: str = "origin") -> DataFrame:
    """(path, width, height, phash, blur, brightness) of rows of Spark's image source; null where it couldn't decode."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for path, h, w, c, data in b.itertuples(index=False):
                rows.append((path, w, h, *described(pixel_array(h, w, c, data), hash_size)) if h > 0 else (path, None, None, None, None, None))
            yield pd.DataFrame(rows, columns=["path", "width", "height", "phash", "blur", "brightness"]).astype({"width": "Int32", "height": "Int32"})

    return images.select(path_col, *PIXELS).mapInPandas(run, "path string, width int, height int, phash string, blur double, brightness double")


def describe_images(files: DataFrame, decoder: Decoder | None = None, hash_size: int = 8, path_col: str = "path", content_col: str = "content") -> DataFrame:
    """(path, sha256, width, height, phash, blur, brightness) of every file.

    Sizes are the header's and null where it can't be read. What needs pixels is null without a ``decoder``, or where
    it returns None.
    """
    size = image_size(F.col(content_col))
    rows = files.select(F.col(path_col).alias("path"), F.sha2(F.col(content_col), 256).alias("sha256"), size["width"].alias("width"), size["height"].alias("height"), F.col(content_col).alias("content"))
    if decoder is None:
        empty = F.lit(None)
        return rows.select("path", "sha256", "width", "height", empty.cast("string").alias("phash"), empty.cast("double").alias("blur"), empty.cast("double").alias("brightness"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [described(decoder(bytes(c)) if c is not None else None, hash_size) for c in b["content"]]
            yield pd.concat([b.drop(columns="content").astype({"width": "Int32", "height": "Int32"}), pd.DataFrame(found, columns=["phash", "blur", "brightness"], index=b.index)], axis=1)

    return rows.mapInPandas(run, "path string, sha256 string, width int, height int, phash string, blur double, brightness double")


def image_quality(described: DataFrame) -> DataFrame:
    """``described`` with ``quality_status`` and ``warnings`` for size, blur and brightness."""
    side = F.least("width", "height")
    warnings = F.array_compact(
        F.array(
            F.when(side < 64, "small"),
            F.when(F.col("blur") < 20, "very_blurred").when(F.col("blur") < 60, "blurred"),
            F.when(F.col("brightness") < 25, "dark").when(F.col("brightness") > 235, "bright"),
        )
    )
    return described.withColumn("quality_status", F.when(F.col("blur") < 20, "review").otherwise("acceptable")).withColumn("warnings", warnings)


def score_images(images: DataFrame, model_factory: Callable[[], Callable[[list[np.ndarray]], list[list[tuple]]]], id_col: str = "origin", batch: int = 32) -> DataFrame:
    """Detections of a user's model over rows of Spark's image source.

    ``model_factory()`` is called once per task and returns a function from a list of up to ``batch`` images to a
    list of rows (class_id, confidence, x1, y1, x2, y2) for each. Images that couldn't be decoded are left out.
    """
    kind = images.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = None
        for b in batches:
            b = b[b["height"] > 0]
            for lo in range(0, len(b), batch):
                some = b.iloc[lo : lo + batch]
                model = model or model_factory()
                made = model([pixel_array(h, w, c, data) for _, h, w, c, data in some.itertuples(index=False)])
                rows = [(i, k, *r) for i, found in zip(some[id_col], made, strict=True) for k, r in enumerate(found)]
                yield pd.DataFrame(rows, columns=[id_col, "pred_idx", "class_id", "confidence", "x1", "y1", "x2", "y2"])

    return images.select(id_col, *PIXELS).mapInPandas(run, f"{id_col} {kind}, pred_idx int, class_id int, confidence double, x1 double, y1 double, x2 double, y2 double")
