"""Tables in files of other programs: delimited files with a byte order mark, manifests, database files, folders of pages, geographic dumps."""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import BinaryType, DoubleType, LongType, StringType, StructField, StructType

from castellan.operators.merging import first_wins
from castellan.workspace import hadoop

COUNTRY = (
    "id bigint, iso2 string, iso3 string, name string, latitude string, longitude string, translations map<string,string>, "
    "states array<struct<id:bigint,name:string,iso3166_2:string,latitude:string,longitude:string>>"
)


def read_table(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """A delimited file under a header, every field text. A byte order mark before the first name is no part of it."""
    df = spark.read.option("header", True).option("sep", sep).option("escape", '"').csv(path)
    return df.toDF(*[c.removeprefix("﻿").strip('"') if i == 0 else c for i, c in enumerate(df.columns)])


def read_manifest(spark: SparkSession, path: str, key: str = "DB-Key") -> DataFrame:
    """The rows of manifests whose key is all digits; the first row of a key, by file and place in it, wins. A manifest without the column fails."""
    df = read_table(spark, path)
    if key not in df.columns:
        raise ValueError(f"no column {key}")
    placed = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"))
    rows = placed.withColumn(key, F.trim(key)).filter(F.col(key).rlike(r"^[0-9]+$"))
    return first_wins(rows, [key], ["_file", "_block", "_at"]).select(*df.columns)


def newest(spark: SparkSession, pattern: str) -> str:
    """The last path by name that a pattern matches."""
    store, p = hadoop(spark, pattern)
    found = [str(s.getPath().toString()) for s in store.globStatus(p) or []]
    if not found:
        raise FileNotFoundError(pattern)
    return max(found, key=lambda f: f.rpartition("/")[2])


def page_index(spark: SparkSession, path: str, pattern: str = r"\.\./matches/(m\d+)\.html") -> DataFrame:
    """target and pages (their names, sorted, each once): which pages of a folder link to what the pattern's group finds."""
    raw = spark.read.text(path, wholetext=True)
    return link_index(raw.select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]*)\.[^./]*$", 1).alias("page"), "value"), "page", "value", pattern)


def link_index(pages: DataFrame, page: str, html: str, pattern: str) -> DataFrame:
    """target and pages of what the pattern's group finds in the html of pages. A target that all pages share fills one row with their names."""
    found = pages.select(page, F.explode(F.array_distinct(F.regexp_extract_all(html, F.lit(pattern), 1))).alias("target"))
    return found.groupBy("target").agg(F.array_sort(F.collect_set(page)).alias("pages"))


def read_countries(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Countries (id, iso2, iso3, name, latitude, longitude, translations) and their states (id, country_id, iso3, code, name, latitude,
    longitude) of a JSON dump, packed or not. A state's code is its ISO code, or else its country's and its number."""
    raw = spark.read.schema(COUNTRY).option("multiLine", True).json(path)
    s = raw.select(F.col("id").alias("country_id"), "iso3", F.explode("states").alias("s"))
    code = F.coalesce(F.nullif(F.trim("s.iso3166_2"), F.lit("")), F.concat("iso3", F.lit("-"), F.col("s.id").cast("string")))
    return raw.drop("states"), s.select("s.id", "country_id", "iso3", code.alias("code"), "s.name", "s.latitude", "s.longitude")


def read_cities(spark: SparkSession, path: str) -> DataFrame:
    """Cities of a delimited dump, packed or not, with numbers for their ids; blank fields are null."""
    df = read_table(spark, path)
    blank = df.select(*[F.nullif(F.trim(F.col(c)), F.lit("")).alias(c) for c in df.columns])
    return blank.withColumns({c: F.col(c).try_cast("bigint") for c in ("country_id", "state_id")})


def alternative_names(translations: Column) -> Column:
    """The entries of a map of names by language, sorted by language."""
    return F.array_sort(F.transform(F.map_entries(F.coalesce(translations, F.create_map().cast("map<string,string>"))), lambda e: F.struct(e["key"].alias("lang"), e["value"].alias("name"))))


class _Rows(InputPartition):
    def __init__(self, first: int, last: int):
        super().__init__((first, last))
        self.first, self.last = first, last


class DatabaseReader(DataSourceReader):
    """A table of a database file, in ranges of row ids; every executor must see the file."""

    def __init__(self, options: dict[str, str], schema: StructType):
        self.path, self.table, self.tasks = options["path"].removeprefix("file://"), options["table"].replace('"', '""'), int(options.get("tasks", "8"))
        self.columns = [(f.name, f.dataType) for f in schema.fields]

    def _open(self) -> sqlite3.Connection:
        return sqlite3.connect(f"file:{self.path}?mode=ro", uri=True)

    def partitions(self) -> list[_Rows]:
        with self._open() as con:
            least, most = con.execute(f'SELECT min(rowid), max(rowid) FROM "{self.table}"').fetchone()
        if least is None:
            return [_Rows(0, -1)]
        width = max(1, -(-(most - least + 1) // self.tasks))
        return [_Rows(a, min(a + width - 1, most)) for a in range(least, most + 1, width)]

    def read(self, part: _Rows) -> Iterator[tuple]:
        plain = {LongType: int, DoubleType: float, StringType: str, BinaryType: bytes}
        names = ", ".join('"' + n.replace('"', '""') + '"' for n, _ in self.columns)
        with self._open() as con:
            for row in con.execute(f'SELECT {names} FROM "{self.table}" WHERE rowid BETWEEN ? AND ? ORDER BY rowid', (part.first, part.last)):
                yield tuple(None if v is None else v if isinstance(v, plain[type(t)]) else self._as(v, plain[type(t)]) for v, (_, t) in zip(row, self.columns))

    @staticmethod
    def _as(value: object, kind: type) -> object:
        """A value of another kind than its column declares, or null: the file's columns are not bound to theirs."""
        try:
            return str(value).encode() if kind is bytes else kind(value)
        except ValueError:
            return None


class Database(DataSource):
    @classmethod
    def name(cls) -> str:
        return "castellan_database"

    def schema(self) -> StructType:
        with sqlite3.connect(f"file:{self.options['path'].removeprefix('file://')}?mode=ro", uri=True) as con:
            columns = con.execute("SELECT name, type FROM pragma_table_info(?)", (self.options["table"],)).fetchall()
        if not columns:
            raise ValueError(f"no table {self.options['table']}")
        kind = lambda t: LongType() if "INT" in t else DoubleType() if any(x in t for x in ("REAL", "FLOA", "DOUB")) else BinaryType() if "BLOB" in t else StringType()
        return StructType([StructField(n, kind((t or "").upper())) for n, t in columns])

    def reader(self, schema: StructType) -> DatabaseReader:
        return DatabaseReader(self.options, schema)


def read_database(spark: SparkSession, path: str, table: str, tasks: int = 8) -> DataFrame:
    """A table of a database file, read in tasks ranges of its row ids."""
    spark.dataSource.register(Database)
    return spark.read.format("castellan_database").option("path", path).option("table", table).option("tasks", tasks).load()
