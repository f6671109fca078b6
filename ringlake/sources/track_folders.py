"""Track folders as a Spark data source: ``spark.read.format("track_folders")`` with the option ``table``, and a writer that commits.

A folder ``<path>/<slug>/track.json`` with the files that it names is one track. Tables: ``documents`` (the text of each
document), ``layouts``, ``items`` (points and ranges of all layers) and ``vertices`` (of the outlines). Files are opened where
their rows are read, on executors, by any store that pyarrow knows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, In, InputPartition, WriterCommitMessage

SCHEMAS = {
    "documents": "slug string, document string",
    "layouts": "slug string, layout_id string, name string, length_m double, direction string, active_years string, centerline string",
    "items": "slug string, layout_id string, kind string, layer_id string, i int, id string, label string, labels map<string,string>, number int, code string, direction string, scale int, marker double, lon double, lat double, start double, end double, members array<string>",
    "vertices": "slug string, layout_id string, seq int, lon double, lat double",
}
#: Tracks that one task reads, at least where there are many, and parts of the table at most.
TOGETHER, PARTS = 64, 4096


def register(spark: SparkSession) -> None:
    """Makes the format known to a session, and lets it hand filters on to the reader."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TrackFolders)


class TrackFolders(DataSource):
    """Options: the path, ``table`` (``items`` by default) and ``file`` (``track.json``)."""

    @classmethod
    def name(cls) -> str:
        return "track_folders"

    def schema(self) -> str:
        table = self.options.get("table", "items")
        if table not in SCHEMAS:
            raise ValueError(f"no table {table} in track folders; there are {', '.join(SCHEMAS)}")
        return SCHEMAS[table]

    def reader(self, schema) -> DataSourceReader:
        return Reader(self.options["path"], self.options.get("table", "items"), self.options.get("file", "track.json"))

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return Writer(self.options["path"], schema.names)


@dataclass
class Tracks(InputPartition):
    slugs: list[str]


def store_of(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def text_of(store, path: str) -> str | None:
    """A file's text; None where it is not there."""
    try:
        with store.open_input_stream(path) as f:
            return f.read().decode("utf-8")
    except FileNotFoundError:
        return None


def made_dir(store, path: str, made: set) -> None:
    """Makes a file's folder, unless one that is ``made`` holds it: a folder's files come together."""
    folder = path.rpartition("/")[0]
    if not any(m == folder or m.startswith(f"{folder}/") for m in made):
        made.clear()
        made.add(folder)
        store.create_dir(folder, recursive=True)


class Reader(DataSourceReader):
    """Deals out the tracks; a filter on ``slug`` picks folders, so no other file is opened."""

    def __init__(self, path: str, table: str, file: str):
        self.path, self.table, self.file, self.only = path, table, file, None

    def pushFilters(self, filters: list) -> Iterator:
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("slug",):
                self.only = {f.value} if self.only is None else self.only & {f.value}
            elif isinstance(f, In) and f.attribute == ("slug",):
                self.only = set(f.value) if self.only is None else self.only & set(f.value)
            else:
                yield f

    def partitions(self) -> list[Tracks]:
        from pyarrow import fs

        store, base = store_of(self.path)
        if self.only is None:
            slugs = sorted(i.base_name for i in store.get_file_info(fs.FileSelector(base, allow_not_found=True)) if i.type == fs.FileType.Directory and not i.base_name.startswith(("_", ".")))
        else:
            slugs = sorted(s for s in self.only if isinstance(s, str) and s)
        each = max(TOGETHER, -(-len(slugs) // PARTS))
        return [Tracks(slugs[a : a + each]) for a in range(0, len(slugs), each)] or [Tracks([])]

    def read(self, partition: Tracks) -> Iterator[tuple]:
        store, base = store_of(self.path)
        for slug in partition.slugs:
            text = text_of(store, f"{base}/{slug}/{self.file}")
            if text is None:
                continue
            yield from getattr(self, f"_{self.table}")(slug, text, store, base)

    def _documents(self, slug, text, store, base):
        yield slug, text

    def _layouts(self, slug, text, store, base):
        for x in json.loads(text).get("layouts") or []:
            yield slug, x.get("id"), x.get("name"), number(x.get("length_m")), x.get("direction"), x.get("active_years"), (x.get("geometry") or {}).get("centerline")

    def _items(self, slug, text, store, base):
        for x in json.loads(text).get("layouts") or []:
            for kind in ("point", "range"):
                for layer in x.get(f"{kind}_layers") or []:
                    for i, o in enumerate(layer.get("items") or []):
                        at = o.get("location") or [None, None]
                        labels = {k: v for k, v in (o.get("labels") or {}).items() if isinstance(v, str)}
                        yield (slug, x.get("id"), kind, layer.get("id"), i, o.get("id"), o.get("label"), labels, whole(o.get("number")), o.get("code"), o.get("direction"), whole(o.get("scale")), number(o.get("marker")), number(at[0]), number(at[1]), number(o.get("start")), number(o.get("end")), o.get("members"))

    def _vertices(self, slug, text, store, base):
        for x in json.loads(text).get("layouts") or []:
            file = (x.get("geometry") or {}).get("centerline")
            shape = text_of(store, f"{base}/{slug}/{file}") if file else None
            line = line_of(json.loads(shape)) if shape else []
            if len(line) > 1 and line[0] == line[-1]:
                line = line[:-1]
            for i, p in enumerate(line, 1):
                yield slug, x.get("id"), i, float(p[0]), float(p[1])


def number(x) -> float | None:
    return None if x is None else float(x)


def whole(x) -> int | None:
    return None if x is None else int(x)


def line_of(shape: dict) -> list:
    """The coordinates of a bare line, else of the feature with role outline, else of the first line."""
    if shape.get("type") == "LineString":
        return shape.get("coordinates") or []
    lines = [(f.get("properties") or {}, f["geometry"]) for f in shape.get("features") or [] if (f.get("geometry") or {}).get("type") == "LineString"]
    return next((g["coordinates"] for p, g in lines if p.get("role") == "outline"), lines[0][1]["coordinates"] if lines else [])


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class Writer(DataSourceWriter):
    """Writes rows ``(slug, file, content)`` as files. Each task writes under a name of its own beside the tracks; the files come to
    their places when all tasks have succeeded, and none does otherwise. What a task writes after an abort stays in a folder that
    readers skip."""

    def __init__(self, path: str, names: list[str]):
        if sorted(names) != ["content", "file", "slug"]:
            raise ValueError("track folders take rows of slug, file and content")
        self.path, self.names, self.job = path, names, uuid.uuid4().hex

    def write(self, rows: Iterator) -> Written:
        store, base = store_of(self.path)
        own, files, made = uuid.uuid4().hex, [], set()
        for r in rows:
            slug, file = r["slug"], r["file"]
            if not slug or not file or ".." in f"{slug}/{file}".split("/"):
                raise ValueError(f"no place for {slug}/{file}")
            to = f"{base}/_writing-{self.job}/{own}/{slug}/{file}"
            made_dir(store, to, made)
            with store.open_output_stream(to) as f:
                f.write((r["content"] or "").encode("utf-8"))
            files.append(f"{own}/{slug}/{file}")
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        store, base = store_of(self.path)
        made: set = set()
        for m in messages:
            for f in m.files if m else []:
                to = f"{base}/{f.partition('/')[2]}"
                made_dir(store, to, made)
                store.move(f"{base}/_writing-{self.job}/{f}", to)
        self._clear(store, base)

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(*store_of(self.path))

    def _clear(self, store, base: str) -> None:
        from pyarrow import fs

        if store.get_file_info(f"{base}/_writing-{self.job}").type == fs.FileType.Directory:
            store.delete_dir(f"{base}/_writing-{self.job}")
