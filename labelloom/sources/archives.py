"""ZIP archives as a Spark source: large archives are read by many tasks.

An archive is cut into slices of its bytes. A task opens the archive where it lies (``pyarrow.fs``: local files, HDFS,
S3, GCS), reads the list of members at its end, and then the bytes of those members only that begin in its slice. The
driver lists archives and their sizes, nothing else.

An archive that is no ZIP file, or has a member that would escape from the folder it is unpacked to, is refused as a
whole: one row with ``error`` and no member. A member that can't be read is a row with ``error`` and no content.
"""

from __future__ import annotations

import hashlib
import posixpath
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from labelloom.session import written

SLICE = 128 << 20
CHUNK = 8 << 20
MEMBERS = "archive string, member string, content binary, error string"
DIGESTS = "archive string, archive_sha256 string"


def unsafe(member: str) -> bool:
    """Whether extracting ``member`` would leave the target directory."""
    name = member.replace("\\", "/")
    return name.startswith("/") or ":" in name.split("/")[0] or posixpath.normpath(name).split("/")[0] == ".."


def archives_under(path: str) -> list[tuple[str, int]]:
    """(path in its store, bytes) of the archive ``path``, or of all ``*.zip`` files under the folder ``path``."""
    from pyarrow import fs

    system, at = fs.FileSystem.from_uri(path)
    info = system.get_file_info(at)
    found = [info] if info.type == fs.FileType.File else [i for i in system.get_file_info(fs.FileSelector(at, recursive=True)) if i.type == fs.FileType.File and i.path.lower().endswith(".zip")]
    return sorted((i.path, i.size) for i in found)


@dataclass
class Slice(InputPartition):
    """Members of an archive, in the store of the URI ``base``, whose header begins at ``start`` or later, before
    ``end``."""

    base: str
    archive: str
    start: int
    end: int

    def opened(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.base)[0].open_input_file(self.archive)


def read_slice(part: Slice) -> Iterator[tuple]:
    with part.opened() as file:
        try:
            archive = zipfile.ZipFile(file)
        except (zipfile.BadZipFile, ValueError):
            # ValueError: files that are shorter than where a list of members would begin
            if part.start == 0:
                yield part.archive, None, None, "not_a_zip"
            return
        infos = [i for i in archive.infolist() if not i.is_dir()]
        if any(unsafe(i.filename) for i in infos):
            if part.start == 0:
                yield part.archive, None, None, "unsafe_member"
            return
        for i in infos:
            if part.start <= i.header_offset < part.end:
                try:
                    yield part.archive, i.filename, archive.read(i), None
                except RuntimeError as e:
                    # encrypted members, and ways of compression that Python doesn't know
                    yield part.archive, i.filename, None, "unsupported" if isinstance(e, NotImplementedError) else "encrypted"
                except (zipfile.BadZipFile, zlib.error, EOFError, OSError):
                    yield part.archive, i.filename, None, "broken"


class MemberReader(DataSourceReader):
    def __init__(self, options: dict[str, str], digest: bool):
        self.path, self.size, self.digest = options["path"], int(options.get("slicebytes", SLICE)), digest

    def partitions(self) -> list[InputPartition]:
        found = archives_under(self.path)
        if self.digest:
            return [Slice(self.path, archive, 0, n) for archive, n in found]
        return [Slice(self.path, archive, at, at + self.size) for archive, n in found for at in range(0, max(n, 1), self.size)]

    def read(self, partition: Slice) -> Iterator[tuple]:
        if not self.digest:
            yield from read_slice(partition)
            return
        digest = hashlib.sha256()
        with partition.opened() as file:
            while chunk := file.read(CHUNK):
                digest.update(chunk)
        yield partition.archive, digest.hexdigest()


class ZipMembers(DataSource):
    """Format ``zip_members``: rows of ``MEMBERS``. Options: path, sliceBytes."""

    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def schema(self) -> str:
        return MEMBERS

    def reader(self, schema) -> DataSourceReader:
        return MemberReader(self.options, False)


class ZipDigests(DataSource):
    """Format ``zip_digests``: rows of ``DIGESTS``, an archive a task."""

    @classmethod
    def name(cls) -> str:
        return "zip_digests"

    def schema(self) -> str:
        return DIGESTS

    def reader(self, schema) -> DataSourceReader:
        return MemberReader(self.options, True)


def read_archives(spark: SparkSession, path: str, slice_bytes: int = SLICE) -> DataFrame:
    """(source, archive_sha256, member, content, error): members of every ZIP archive under ``path``."""
    from labelloom.sources.files import source_name

    for source in (ZipMembers, ZipDigests):
        spark.dataSource.register(source)
    members = spark.read.format("zip_members").option("sliceBytes", slice_bytes).load(path)
    # a row for each archive, written so that its size is known when it meets the members
    digests = written(spark.read.format("zip_digests").load(path), "archive-digests")
    name = F.regexp_replace(F.substring_index("archive", "/", -1), "\\.[^.]*$", "")
    return members.join(digests, "archive").select(source_name(name).alias("source"), "archive_sha256", "member", "content", "error")
