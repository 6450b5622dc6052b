"""Sheets as a data source: ``spark.read.format("sheets").load(folder)``, a partition a file.

A file holds what a sheet service returns for a range with unformatted values:
JSON with ``values``, a list of rows of texts, numbers, flags and nulls, rows cut
behind their last value. The first row is the header, told by its place alone;
data rows are numbered from 2 and filled up to ``width`` cells. The options
``prefix`` and ``names`` choose files before any is opened. A file that can't be
read is one row with its ``error``; the others are read.

Filters on ``file`` are not pushed by the reader's own hook: in Spark 4.1.2 what one
plan pushes stays with the source, and later plans over the same frame lose rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "file string, row_index int, header array<string>, cells array<string>, kinds array<string>, error string"
#: Fixed value: cells of a row, columns A to AF.
WIDTH = 32
KINDS = {str: "text", bool: "flag", int: "number", float: "number", type(None): "blank"}


def cell(v: object) -> str | None:
    """A cell's value as text; flags as a sheet shows them, whole numbers without a point, as JSON keeps them apart from others."""
    if v is None or isinstance(v, str):
        return v
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    return json.dumps(v, ensure_ascii=False)


def rows_of(text: str, width: int) -> Iterator[tuple]:
    """``row_index, header, cells, kinds`` of a range's data rows."""
    values = json.loads(text).get("values") or []
    if not all(isinstance(r, list) for r in values):
        raise ValueError("a row is no list")
    fill = lambda r: (r + [None] * width)[:width]
    header = [cell(v) or "" for v in fill(values[0])] if values else []
    for i, r in enumerate(values[1:], 2):
        r = fill(r)
        yield i, header, [cell(v) for v in r], [KINDS.get(type(v), "other") for v in r]


@dataclass
class _File(InputPartition):
    path: str
    name: str


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder, self.width = options["path"], int(options.get("width", WIDTH))
        self.prefix, self.names = options.get("prefix", ""), json.loads(options.get("names", "null"))

    def _chosen(self, name: str) -> bool:
        return name.startswith(self.prefix) and (self.names is None or name in self.names)

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        store, top = fs.FileSystem.from_uri(self.folder if "://" in self.folder or self.folder.startswith("file:") else f"file://{self.folder}")
        found = store.get_file_info(fs.FileSelector(top, recursive=True))
        names = sorted((name_of(f.path[len(top) :].strip("/")), f.path) for f in found if f.type == fs.FileType.File and not f.base_name.startswith(("_", ".")))
        return [_File(p, n) for n, p in names if self._chosen(n)]

    def read(self, partition: _File) -> Iterator[tuple]:
        from pyarrow import fs

        try:
            store, _ = fs.FileSystem.from_uri(self.folder if "://" in self.folder or self.folder.startswith("file:") else f"file://{self.folder}")
            with store.open_input_stream(partition.path) as f:
                text = f.read().decode("utf-8")
            rows = [(partition.name, *r, None) for r in rows_of(text, self.width)]
        except (OSError, ValueError, AttributeError) as e:
            rows = [(partition.name, None, None, None, None, f"{type(e).__name__}: {e}")]
        yield from rows


def name_of(path: str) -> str:
    """A file's name is that of its folder's ``sheet=``, if it has one, else its own without its ending."""
    for part in reversed(path.split("/")):
        if part.startswith("sheet="):
            return part.removeprefix("sheet=")
    return path.rsplit("/", 1)[-1].rsplit(".", 1)[0]


class SheetSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sheets"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def read_sheets(spark: SparkSession, folder: str, width: int = WIDTH, prefix: str = "", names: Sequence[str] | None = None) -> DataFrame:
    """``file, row_index, header, cells, kinds, error`` of every sheet below a folder that workers can open.

    ``prefix`` and ``names`` choose files before any is opened. Blank rows keep
    their numbers. An empty sheet, or one with a header alone, has no rows.
    """
    spark.dataSource.register(SheetSource)
    reader = spark.read.format("sheets").option("width", width).option("prefix", prefix)
    return (reader if names is None else reader.option("names", json.dumps(list(names)))).load(folder)


def write_sheets(rows: DataFrame, sheet: str, order: str, cells: list[str], folder: str) -> None:
    """A range file a ``sheet``, whose rows are bounded as a sheet is; cells keep their types. Written below ``sheet=NAME``."""
    inner = lambda j: F.substring(j, F.lit(2), F.length(j) - 2)  # noqa: E731  of the JSON of a list
    row = lambda values: F.concat(F.lit("["), F.concat_ws(",", *[inner(F.to_json(F.array(v))) for v in values]), F.lit("]"))
    grouped = rows.select(sheet, order, row([F.col(c) for c in cells]).alias("r")).groupBy(sheet).agg(F.array_sort(F.collect_list(F.struct(order, "r"))).alias("rs"))
    all_rows = F.concat(F.array(row([F.lit(c) for c in cells])), F.col("rs.r"))
    text = F.concat(F.lit('{"values":['), F.array_join(all_rows, ","), F.lit("]}"))
    grouped.select(text.alias("value"), F.col(sheet).alias("sheet")).write.mode("overwrite").partitionBy("sheet").text(folder)
