"""Media columns as interleaved document sequences.

HTML pages are parsed into one row per element, in reading order: runs of text and media references
(``img``, ``video``, ``audio``, ``source``, ``embed``), each with its position, alternative text and the
caption of the figure that holds it. References name their payload by digest (``sha256:<hex>``). Payloads are
kept once written, as 8-bit grey images (PGM), in a Parquet store keyed by digest; a hash join on the digest
resolves references to what is computed from the stored bytes. Positions and captions ride along, so nothing
has to be aligned afterwards.

Cases: null HTML or text counts as empty; an unresolved reference keeps its row with null payload columns;
equal payloads may be stored more than once but resolve to one row; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.session import small_batches, table, written

#: Payloads are padded with bytes 255 to a positive multiple of TILE = SIDE * SIDE samples.
SIDE, TILE = 24, 576
MEDIA_TAGS = ("img", "video", "audio", "source", "embed")
#: Elements whose text is never shown, and those that may stand in a head: any other one ends it.
SILENT_TAGS = ("script", "style", "title")
HEAD_TAGS = ("base", "link", "meta", "noscript", "script", "style", "template", "title")
BLOCK_TAGS = ("p", "div", "article", "section", "li", "ul", "ol", "h1", "h2", "h3", "h4", "h5", "h6", "table", "tr", "td", "th", "br", "nav", "blockquote", "pre", "figure", "figcaption", "body", "html")
SEQUENCE = "position int, kind string, text string, source string, digest string, alt string, caption string"
FEATURES = "digest string, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


class Sequencer(HTMLParser):
    """Collects the elements of one page in order.

    End tags may be missing: a head ends at the first element that can't stand in it (its text is a title or a
    script, else it ends the head too); a caption ends with its figure, at the next caption or at the end of the
    page; a template without end hides nothing. A caption belongs to all media of its figure, before or behind
    it; one without media is text.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.items: list[dict] = []
        self.words: list[str] = []
        self.silent: str | None = None
        self.figures: list[list[dict]] = []
        self.caption: list[str] | None = None
        self.templates: list[int] = []

    def flush(self) -> None:
        text = " ".join("".join(self.words).split())
        self.words = []
        if text:
            self.items.append({"kind": "text", "text": text})

    def end_caption(self) -> None:
        if self.caption is None:
            return
        text, self.caption = " ".join("".join(self.caption).split()), None
        if text:
            item = {"kind": "text", "text": text, "is_caption": bool(self.figures)}
            self.items.append(item)
            if self.figures:
                self.figures[-1].append(item)

    def end_figure(self) -> None:
        self.end_caption()
        self.flush()
        inside = self.figures.pop()
        media = [x for x in inside if x["kind"] == "media"]
        caption = " ".join(x["text"] for x in inside if x["kind"] == "text")
        for x in media:
            x["caption"] = caption or None
        for x in inside:
            x["is_caption"] = x["kind"] == "text" and bool(media)  # said by the media; else it stays as text

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.silent == "title" and tag not in HEAD_TAGS:
            self.silent = None
        if tag in SILENT_TAGS:
            self.silent = tag
        if tag == "template":
            self.flush()
            self.templates.append(len(self.items))
        if tag == "figcaption":
            self.end_caption()
            self.flush()
            self.caption = []
        elif tag in BLOCK_TAGS:
            if tag == "figure" or self.caption is None:
                self.end_caption()
                self.flush()
            else:
                self.caption.append(" ")
        if tag == "figure":
            self.figures.append([])
        if tag in MEDIA_TAGS:
            a = dict(attrs)
            source = a.get("src") or a.get("data-src") or ""
            if source:
                if self.caption is None:
                    self.flush()
                item = {"kind": "media", "source": source, "alt": a.get("alt"), "digest": source[7:].lower() if source.startswith("sha256:") else None}
                if self.figures:
                    self.figures[-1].append(item)
                self.items.append(item)

    def handle_endtag(self, tag: str) -> None:
        if tag == self.silent:
            self.silent = None
        if tag == "template" and self.templates:
            self.flush()
            del self.items[self.templates.pop() :]
        if tag == "figcaption":
            self.end_caption()
        elif tag == "figure" and self.figures:
            self.end_figure()
        elif tag in BLOCK_TAGS:
            if self.caption is None:
                self.flush()
            else:
                self.caption.append(" ")

    def handle_data(self, data: str) -> None:
        if self.silent is None:
            (self.words if self.caption is None else self.caption).append(data)

    def finish(self) -> list[dict]:
        self.close()
        self.end_caption()
        self.flush()
        while self.figures:
            self.end_figure()
        return [x for x in self.items if not x.get("is_caption")]


def elements(html: str | None) -> list[dict]:
    s = Sequencer()
    s.feed(html or "")
    return s.finish()


def sequences(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", kinds: tuple[str, ...] = ("text", "media")) -> DataFrame:
    """One row per element of the ``kinds`` asked for of each page: ``id_col`` and the columns of ``SEQUENCE``;
    positions count elements of all kinds."""
    small_batches(pages.sparkSession)
    kind = pages.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("kind", "text", "source", "digest", "alt", "caption")
        for b in batches:
            ids, places, rows = [], [], []
            for name, html in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for i, x in enumerate(elements(html)):
                    if x["kind"] in kinds:
                        ids.append(name)
                        places.append(i)
                        rows.append(x)
            columns = [pa.array([r.get(k) for r in rows], pa.string()) for k in names]
            yield pa.RecordBatch.from_arrays([pa.array(ids, b.schema.field(0).type), pa.array(places, pa.int32()), *columns], names=[id_col, "position", *names])

    return pages.select(id_col, html_col).mapInArrow(run, f"{id_col} {kind}, {SEQUENCE}")


def as_image(text: Column) -> Column:
    """The padded bytes of a text as a grey image of SIDE columns (PGM, 8-bit samples)."""
    n = F.octet_length(text)
    tiles = F.greatest(F.lit(1), F.ceil(n / TILE)).cast("int")
    header = F.concat(F.lit(f"P5\n{SIDE} "), (tiles * SIDE).cast("string"), F.lit("\n255\n"))
    return F.concat(header.cast("binary"), text.cast("binary"), F.unhex(F.repeat(F.lit("FF"), tiles * TILE - n)))


def store_texts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Write the texts as images to the shared folder; returns the stored (digest, n_bytes, media)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.sha2(text.cast("binary"), 256).alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"), as_image(text).alias("media"))
    return written(rows, "media-store")


def samples(media: bytes) -> np.ndarray:
    """The samples of a stored image."""
    head, size, depth, rest = media.split(b"\n", 3)
    width, height = map(int, size.split())
    if head != b"P5" or depth != b"255" or len(rest) != width * height:
        raise ValueError("not a stored image")
    return np.frombuffer(rest, np.uint8).reshape(height, width)


def describe(image: np.ndarray) -> str:
    """Size, mean, spread, mean step between neighbours and an 8-bin histogram."""
    counts = np.bincount(image.reshape(-1) >> 5, minlength=8)
    x = image.astype(np.int64)
    n, total, squares = x.size, int(x.sum()), int((x * x).sum())
    step = int(np.abs(np.diff(x, axis=1)).sum())
    values = (1000 * total // n, (1000 * squares // n) - (1000 * total * total) // (n * n), 1000 * step // n)
    return f"{image.shape[1]}x{image.shape[0]};mean={values[0]};var={values[1]};step={values[2]};hist=" + ",".join(map(str, counts.tolist()))


def read_features(store: DataFrame) -> DataFrame:
    """One row of ``FEATURES`` per digest, from the stored bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for media in b.column(2):
                m = media.as_py()
                image = samples(m)
                payload = image.tobytes()
                rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(m), hashlib.sha256(m).hexdigest(), describe(image)))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *columns], names=["digest", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    small_batches(store.sparkSession)
    rows = store.select("digest", "n_bytes", "media").mapInArrow(run, FEATURES)
    names = [c for c in rows.columns if c != "digest"]
    # equal digests have equal rows: any one will do, and it is chosen before the shuffle
    one = rows.groupBy("digest").agg(F.first(F.struct(*names)).alias("f"))
    # written, so that a join on it is a plain shuffle of both sides, whose hot digests Spark can split
    return written(one.select("digest", *[F.col(f"f.{c}").alias(c) for c in names]), "media-features")


def resolve(sequence: DataFrame, features: DataFrame) -> DataFrame:
    """``sequence`` with the columns of ``features`` for every media reference, null where there is none.

    Rows without a digest (text, and media elsewhere on the web) get keys that no digest equals, spread by hash.
    """
    spread = F.concat(F.lit("-"), F.xxhash64(*[c for c in sequence.columns if c != "digest"]).cast("string"))
    keyed = sequence.withColumn("__key", F.coalesce("digest", spread))
    return keyed.join(features.withColumnRenamed("digest", "__key"), "__key", "left").drop("__key")


def as_page(text: Column, caption: Column) -> Column:
    """A document as interleaved HTML: its lines are paragraphs; behind the first stands a figure whose payload
    is the whole text, by digest."""
    safe = lambda x: F.replace(F.replace(F.replace(x, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    lines = F.split(safe(text), "\n")
    figure = F.concat(F.lit('<figure><img alt="text" src="sha256:'), F.sha2(text.cast("binary"), 256), F.lit('"><figcaption>'), safe(caption), F.lit("</figcaption></figure>"))
    rest = F.when(F.size(lines) > 1, F.concat(F.lit("<p>"), F.array_join(F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(1))), "</p><p>"), F.lit("</p>"))).otherwise(F.lit(""))
    return F.concat(F.lit("<html><body><article><p>"), F.get(lines, F.lit(0)), F.lit("</p>"), figure, rest, F.lit("</article></body></html>"))


def op10_interleaved_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    html = as_page(F.coalesce("text", F.lit("")), F.coalesce("lang", F.lit("")))
    refs = sequences(docs.select("doc_id", html.alias("html")), "doc_id", kinds=("media",))
    out = resolve(refs, read_features(store_texts(docs)))
    return out.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "position", "caption")


def page_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every element of every page, in order. Pages here hold no references by digest; a table whose pages do goes
    through ``resolve`` with the features of its store."""
    return sequences(table(spark, sf_dir, "pages")).select("page_id", "position", "kind", "text", "source", "alt", "caption", "digest")


QUERIES = {"op10_interleaved_media": op10_interleaved_media, "page_sequences": page_sequences}
ORACLE: dict[str, str] = {}
