"""`spark.read.format("zipped")`: delimited members of ZIP archives as a Spark data source.

The archives are named by a template such as `/bruto/{ano}/votos_{ano}_{uf}.zip`; each
placeholder takes its values from the option of its name (`ano="2022,2026"`). Every named
archive must exist. A placeholder may be a column of the schema: it holds the archive's
value, and a filter on it leaves whole archives unopened. Other columns are those of the
members, as text, and only the schema's are parsed.

A member is a partition of its own, since a ZIP stream can't be split; the largest start first.
"""

from __future__ import annotations

import fnmatch
import itertools
import string
import zipfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import csv
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, In, InputPartition
from pyspark.sql.types import IntegerType, LongType, StringType, StructType

from meshtally.sources.archives import _open

BLOCK_BYTES = 4 << 20
VALUE_TYPES = {StringType: (str, pa.string()), IntegerType: (int, pa.int32()), LongType: (int, pa.int64())}


class Member(InputPartition):
    """One member to read, with the values of its archive's placeholders."""

    def __init__(self, archive: str, name: str, values: dict):
        self.archive, self.name, self.values = archive, name, values


class ZippedReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: StructType):
        self.template = options["path"]
        self.holders = sorted({name for _, name, _, _ in string.Formatter().parse(self.template) if name})
        lacking = [h for h in self.holders if not options.get(h)]
        if lacking:
            raise ValueError(f"no values for {lacking} of {self.template}")
        self.values = {h: [v.strip() for v in options[h].split(",")] for h in self.holders}
        self.members = options.get("members", "*.csv").lower()
        self.national = options.get("national", "false").lower() == "true"
        self.sep, self.encoding = options.get("sep", ";"), options.get("encoding", "latin-1")
        self.schema = schema
        for field in schema:
            allowed = VALUE_TYPES if field.name in self.holders else {StringType: None}
            if type(field.dataType) not in allowed:
                raise ValueError(f"column {field.name} can't be {field.dataType.simpleString()}")

    def _typed(self, holder: str, value: str):
        kind = type(self.schema[holder].dataType) if holder in self.schema.names else StringType
        return VALUE_TYPES[kind][0](value)

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Keep the values that equality filters on placeholders allow; the rest is Spark's."""
        for f in filters:
            wanted = {EqualTo: lambda: [f.value], EqualNullSafe: lambda: [f.value], In: lambda: f.value}.get(type(f))
            holder = f.attribute[0] if wanted and len(f.attribute) == 1 else None
            if holder in self.holders:
                self.values[holder] = [v for v in self.values[holder] if self._typed(holder, v) in wanted()]
            else:
                yield f

    def partitions(self) -> list[Member]:
        found = []
        for combination in itertools.product(*[dict.fromkeys(self.values[h]) for h in self.holders]):
            values = dict(zip(self.holders, combination))
            archive = self.template.format(**values)
            with _open(archive) as raw, zipfile.ZipFile(raw) as z:  # the central directory only
                files = [i for i in z.infolist() if not i.is_dir()]
            found += [(i.file_size, archive, i.filename, values) for i in self._chosen(files)]
        return [Member(a, n, v) for _, a, n, v in sorted(found, key=lambda m: (-m[0], m[1], m[2]))]

    def _chosen(self, files: list[zipfile.ZipInfo]) -> list[zipfile.ZipInfo]:
        # A national member repeats those of the states.
        mine = [i for i in files if fnmatch.fnmatchcase(i.filename.lower(), self.members)]
        if self.national:
            return [i for i in mine if i.filename.upper().endswith("_BRASIL.CSV")]
        return mine if len(mine) == 1 else [i for i in mine if "BRASIL" not in i.filename.upper()]

    def read(self, partition: Member | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # what Spark asks for when no archive is left
            return
        names = [n for n in self.schema.names if n not in self.holders]
        with _open(partition.archive) as raw, zipfile.ZipFile(raw) as z, z.open(partition.name) as f:
            try:
                batches = csv.open_csv(
                    f, csv.ReadOptions(block_size=BLOCK_BYTES, encoding=self.encoding),
                    csv.ParseOptions(delimiter=self.sep, newlines_in_values=True),
                    csv.ConvertOptions(include_columns=names, column_types=dict.fromkeys(names, pa.string()),
                                       null_values=[""], strings_can_be_null=True))
            except (KeyError, pa.ArrowKeyError) as missing:
                raise ValueError(f"{partition.archive}, {partition.name}: {missing}") from missing
            for batch in batches:
                yield pa.RecordBatch.from_arrays(
                    [self._constant(n, partition, batch.num_rows) if n in self.holders else
                     batch.column(batch.schema.get_field_index(n)) for n in self.schema.names], self.schema.names)

    def _constant(self, holder: str, partition: Member, rows: int) -> pa.Array:
        kind = VALUE_TYPES[type(self.schema[holder].dataType)][1]
        return pa.repeat(pa.scalar(self._typed(holder, partition.values[holder]), kind), rows)


class Zipped(DataSource):
    @classmethod
    def name(cls) -> str:
        return "zipped"

    def schema(self) -> StructType:
        raise ValueError("give the schema: the wanted columns, as text, and placeholders")

    def reader(self, schema: StructType) -> ZippedReader:
        return ZippedReader(self.options, schema)


def register(spark: SparkSession) -> None:
    """Make the format known to a session, with filters handed to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Zipped)


def read_archives(spark: SparkSession, template: str, schema: StructType | str, sep: str = ";", encoding: str = "latin-1",
                  national: bool = False, **values: Iterable) -> DataFrame:
    """Rows of all archives that the template names with the given values of its placeholders."""
    register(spark)
    reader = spark.read.format("zipped").schema(schema).option("sep", sep).option("encoding", encoding)
    for name, several in values.items():
        reader = reader.option(name, ",".join(str(v) for v in several))
    return reader.option("national", str(national).lower()).load(template)
