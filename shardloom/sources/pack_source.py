"""A data source of pack indexes: a row for each entry, read from a pack's header, trailer and index by seeks.

``spark.read.format("rpack").load(folder)`` lists the packs below a folder and deals them out to ``splits`` tasks; payloads are never read.
Filters that compare pack, key or map with values are pushed down: packs are left out by name before they are opened, entries before they become rows. A pack
whose frame or index is broken has one row with its ``error`` and nulls beside it.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from .files import Folder
from .packs import read_index

STATS = ("height_lambda_tiles", "height_mean", "height_norm", "normal_dc_x", "normal_dc_y")
_HEAD = {"schema_version": pa.int32(), **dict.fromkeys(("game", "profile", "preset", "group", "cluster"), pa.string())}
_TEXT = ("alpha_mode", "channels", "colorspace", "format", "id", "key", "map", "sha256", "wrap_mode")
_ENTRY = {**dict.fromkeys(_TEXT, pa.string()), **dict.fromkeys(("height", "mip_levels", "width"), pa.int32()), **dict.fromkeys(("offset", "size"), pa.int64()), "stats": pa.struct([(s, pa.float64()) for s in STATS])}
ARROW = pa.schema([("pack", pa.string()), ("error", pa.string()), *_HEAD.items(), *sorted(_ENTRY.items())])
_NAMES = {pa.string(): "string", pa.int32(): "int", pa.int64(): "bigint"}
SCHEMA = ", ".join(f"`{f.name}` " + _NAMES.get(f.type, f"struct<{', '.join(f'{s}: double' for s in STATS)}>") for f in ARROW)


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class PackReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.splits = options["path"], max(1, int(options.get("splits", 64)))
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Equality with values, of the columns that say which entries are meant; all other filters stay with Spark."""
        for f in filters:
            column = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            if column not in ("pack", "key", "map"):
                yield f
                continue
            values = {f.value} if isinstance(f, EqualTo) else set(f.value)
            self.wanted[column] = self.wanted.get(column, values) & values

    def partitions(self) -> Sequence[Files]:
        names = self.wanted.get("pack")
        paths = [x.path for x in Folder(self.path).below() if x.base_name.endswith(".rpack") and (names is None or x.base_name in names)]
        return [Files(paths[i :: self.splits]) for i in range(min(self.splits, len(paths)))] or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        folder = Folder(self.path)
        for path in partition.paths:
            with folder.open(path) as f:
                text, error = read_index(f)
            rows = self._rows(path.rsplit("/", 1)[1], text, error)
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=ARROW)

    def _rows(self, pack: str, text: str | None, error: str | None) -> list[dict]:
        entry_filters = {c: v for c, v in self.wanted.items() if c != "pack"}
        if error:
            return [] if entry_filters else [{"pack": pack, "error": error}]
        index = json.loads(text)
        head = {"pack": pack} | {c: index.get(c) for c in _HEAD}
        return [{c: e.get(c) for c in _ENTRY} | head for e in index["entries"] if all(e.get(c) in v for c, v in entry_filters.items())]


class PackSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "rpack"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PackReader:
        return PackReader(self.options)
