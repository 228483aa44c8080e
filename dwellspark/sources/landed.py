"""Landed crawls as a data source: one file for each fetched page, read in splits that filters on portal and run prune.

A crawl lands ``portal=<name>/run_id=<run>/page=<number>.html``, and ``.failed`` where a page could not be fetched, in any
file system that Arrow knows by its address.  The reader lists the folders of portals and runs that the filters leave,
and packs the files of a run into splits of about ``splitBytes``; where those are more than FEW, small ones of a portal
share a split, so that splits grow with the files and bytes and not with the runs.  A page's time is its file's.  Rows
are ``schema.PAGE``.

Other files and folders are passed over; a page that is not UTF-8 is read with replacement characters; an address
without anything in it has no splits and no rows.  Portal and run are read from the names of their folders, with the
escapes of addresses; a null run is ``__HIVE_DEFAULT_PARTITION__``, as in Spark's own partitioned tables.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import timezone
from typing import Any
from urllib.parse import quote, unquote

from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, In, InputPartition

from ..schema import PAGE
from ..session import ship

NAME, NULL = "landed_crawl", "__HIVE_DEFAULT_PARTITION__"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
SPLIT_BYTES = 32 << 20
#: So many splits at most hold one run each; what opening a file costs, in bytes, where runs share a split.
FEW, OPEN_BYTES = 128, 64 << 10
_page = re.compile(r"page=(\d+)\.(html|failed)").fullmatch


@dataclass
class Split(InputPartition):
    """Files (page number, path, whether fetched) of a portal's runs, which their folders name, and what reading them costs."""

    portal: str | None
    files: list[tuple[int, str, bool]]
    cost: int = 0


def _value(folder: str, key: str) -> tuple[bool, str | None]:
    name = folder.rsplit("/", 1)[-1]
    if not name.startswith(key + "="):
        return False, None
    value = unquote(name[len(key) + 1 :])
    return True, None if value == NULL else value


class Crawl(DataSource):
    """Options: ``path``, the crawl's address, and ``splitBytes``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return PAGE

    def reader(self, schema: Any) -> DataSourceReader:
        return CrawlReader(self.options["path"], int(self.options.get("splitBytes", SPLIT_BYTES)))


class CrawlReader(DataSourceReader):
    def __init__(self, path: str, split_bytes: int):
        self.path, self.split_bytes, self.only = path, split_bytes, {}

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes equality and membership of portal and run; the rest is Spark's."""
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column in ("portal", "run_id") and isinstance(f, (EqualTo, EqualNullSafe, In)):
                values = set(f.value) if isinstance(f, In) else {f.value}
                self.only[column] = self.only.get(column, values) & values
            else:
                yield f

    def _folders(self, system: fs.FileSystem, within: str, key: str) -> Iterator[tuple[str, str | None]]:
        for info in system.get_file_info(fs.FileSelector(within, allow_not_found=True)):
            known, value = _value(info.path, key)
            if info.type == fs.FileType.Directory and known and (key not in self.only or value in self.only[key]):
                yield info.path, value

    def partitions(self) -> list[Split]:
        system, root = fs.FileSystem.from_uri(self.path)
        splits = []
        for portal_folder, portal in self._folders(system, root, "portal"):
            for run_folder, _ in self._folders(system, portal_folder, "run_id"):
                room = 0
                for info in sorted(system.get_file_info(fs.FileSelector(run_folder)), key=lambda i: i.path):
                    found = _page(info.base_name)
                    if not found or info.type != fs.FileType.File:
                        continue
                    if room <= 0:
                        splits.append(Split(portal, []))
                        room = self.split_bytes
                    splits[-1].files.append((int(found[1]), info.path, found[2] == "html"))
                    splits[-1].cost += max(info.size or 0, OPEN_BYTES)
                    room -= max(info.size or 0, 1)
        return self._packed(splits) if len(splits) > FEW else splits

    def _packed(self, splits: list[Split]) -> list[Split]:
        """Neighbours of one portal together, up to the size of a split."""
        out: list[Split] = []
        for split in splits:
            if out and out[-1].portal == split.portal and out[-1].cost + split.cost <= self.split_bytes:
                out[-1].files += split.files
                out[-1].cost += split.cost
            else:
                out.append(split)
        return out

    def read(self, partition: Split) -> Iterator[Row]:
        if partition is None:  # an empty crawl is read once, for nothing
            return
        system, _ = fs.FileSystem.from_uri(self.path)
        for number, path, fetched in partition.files:
            html = None
            if fetched:
                with system.open_input_stream(path) as stream:
                    html = stream.read().decode("utf-8", "replace")
            time = system.get_file_info(path).mtime
            _, run = _value(path.rsplit("/", 1)[0], "run_id")
            yield Row(partition.portal, run, number, None, html, time.astimezone(timezone.utc) if time else None)


def landed_crawl(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The landed pages of a crawl; filters on portal and run choose the folders that are listed."""
    ship(spark).dataSource.register(Crawl)
    spark.conf.set(PUSHDOWN, "true")
    return spark.read.format(NAME).option("path", path).option("splitBytes", str(split_bytes)).load()


def land(pages: DataFrame, path: str) -> None:
    """Writes pages (see schema.PAGE) as a crawl lands them; a page that is landed again is replaced."""

    def write(rows: Iterator[Row]) -> None:
        system, root = fs.FileSystem.from_uri(path)
        for r in rows:
            folder = "/".join([root, *(f"{k}={NULL if r[k] is None else quote(r[k], safe='')}" for k in ("portal", "run_id"))])
            system.create_dir(folder)
            with system.open_output_stream(f"{folder}/page={r['page_num']}.{'failed' if r['html'] is None else 'html'}") as stream:
                stream.write((r["html"] or "").encode())

    ship(pages.sparkSession)
    pages.foreachPartition(write)
