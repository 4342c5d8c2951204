"""Player blocks of the line format, read by Spark's text source in byte ranges: a name line, then indented details.

No file passes through the driver and none is opened by path, so any store that Spark reads will do. Lines of a block that began in an earlier range find it by what each
range leaves behind, its last name line, one row a range.

Two dialects. ``strict``: only the player section counts, comments are skipped, a header ends a block, and a name line has one of four shapes. ``raw``: every unindented line that is no header
starts a block, the name line has one permissive shape, and details stand behind exactly two blanks. A name line of another shape is a row too, marked malformed; its details count for nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from castellan.functions import names
from castellan.functions.text import normalize_space
from castellan.sources.lines import sectioned_lines

#: The name line of the raw dialect.
RECORD = r"^(.*?) #(\S*)(?:\s+([A-Z]{3}))?(?:\s+\[(\d+)\])?(?:\s+(\S+))?\s*$"
DATE = r"^[0-9?]{4}\.[0-9?]{2}\.[0-9?]{2}$"


def whole(x: Column) -> Column:
    return F.when(x.rlike(r"^[+-]?[0-9]+$"), x.try_cast("int"))


def strict_name_line(line: Column) -> Column:
    """Struct of valid, name, title_token, federation, bracket_rating and birth_year of ``name... #title [FED] [rating] [date]``.

    The first word that starts with # is the title; federation and date may be absent, the rating may not."""
    words = F.filter(F.split(normalize_space(line), " "), lambda w: w != "")
    at = F.coalesce(F.array_position(F.transform(words, lambda w: w.startswith("#")), True), F.lit(0)).cast("int")
    rest = F.when(at > 0, F.slice(words, at + 1, F.size(words)))
    n, first, last = F.size(rest), F.get(rest, F.lit(0)), F.element_at(words, -1)
    fed, dated = F.coalesce(first.rlike("^[A-Z]{3}$"), F.lit(False)), F.coalesce(last.rlike(DATE), F.lit(False))
    rating = F.get(rest, fed.cast("int"))
    shaped = (n == 1 + fed.cast("int") + dated.cast("int")) & rating.startswith("[") & rating.endswith("]") & (F.length(rating) >= 2)
    return F.struct(
        F.coalesce((at > 0) & shaped, F.lit(False)).alias("valid"), F.array_join(F.slice(words, 1, F.greatest(at - 1, F.lit(0))), " ").alias("name"), F.substring(F.get(words, at - 1), 2, 1 << 20).alias("title_token"), F.when(fed, first).alias("federation"),
        whole(F.regexp_extract(rating, r"^\[(.*)\]$", 1)).alias("bracket_rating"), F.when(dated, whole(F.left(last, F.lit(4)))).alias("birth_year"))


def raw_name_line(line: Column) -> Column:
    part = lambda i: F.nullif(F.regexp_extract(line, RECORD, i), F.lit(""))
    year = whole(F.nullif(F.regexp_extract(part(5), r"^(\d{4})\.\?\?\.\?\?$", 1), F.lit("")))
    return F.struct(
        line.rlike(RECORD).alias("valid"), normalize_space(F.regexp_extract(line, RECORD, 1)).alias("name"), F.regexp_extract(line, RECORD, 2).alias("title_token"), part(3).alias("federation"), whole(part(4)).alias("bracket_rating"), year.alias("birth_year"))


def last_of_each(entries: Column, key: str) -> Column:
    """Of structs with one key the last."""
    return F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda later: later[key] == e[key]))


def strict_details(d: Column) -> dict[str, Column]:
    rest = lambda mark: F.transform(F.filter(d, lambda x: x.startswith(mark)), lambda x: F.substring(x, len(mark) + 1, 1 << 30))
    ids = F.transform(rest("%Bio "), lambda x: F.struct(F.substring_index(x, " ", 1).alias("source"), F.when(x.contains(" "), F.trim(F.substr(x, F.instr(x, " ") + 1))).otherwise("").alias("id")))
    fide = F.try_element_at(F.filter(ids, lambda i: i["source"] == "FIDE"), F.lit(-1))["id"]
    years = F.filter(rest("%Elo "), lambda x: whole(F.substring_index(x, ":", 1)).isNotNull() & x.contains(":"))
    values = lambda x: F.split(F.substr(x, F.instr(x, ":") + 1), ",")
    grid = F.transform(years, lambda x: F.struct(whole(F.substring_index(x, ":", 1)).alias("year"), F.transform(F.sequence(F.lit(0), F.lit(11)), lambda i: whole(F.get(values(x), i))).alias("months")))
    return {"fide_id": F.when(names.is_valid_fide_id(fide), fide.cast("bigint").cast("string")), "ids": ids, "elo": F.map_from_entries(last_of_each(grid, "year")), "aliases": rest("= ")}


def raw_details(d: Column) -> dict[str, Column]:
    bio, elo, alias = r"^  %Bio (\S+) (.+)$", r"^  %Elo (\d{4}):(.+)$", r"^  = (.+)$"
    got = lambda p, i: lambda x: F.regexp_extract(x, p, i)
    ids = F.transform(F.filter(d, lambda x: x.rlike(bio)), lambda x: F.struct(F.lower(got(bio, 1)(x)).alias("source"), F.trim(got(bio, 2)(x)).alias("id")))
    is_fide = lambda i: (i["source"] == "fide") & names.is_valid_fide_id(i["id"])
    others = F.transform(F.filter(ids, lambda i: ~is_fide(i)), lambda i: F.struct(F.when(i["source"] == "fide", "fide-raw").otherwise(i["source"]).alias("source"), i["id"].alias("id")))
    grid = F.transform(F.filter(d, lambda x: x.rlike(elo)), lambda x: F.struct(got(elo, 1)(x).cast("int").alias("year"), F.transform(F.split(got(elo, 2)(x), ","), lambda v: F.trim(v)).alias("months")))
    aliases = F.transform(F.filter(d, lambda x: x.rlike(alias)), lambda x: normalize_space(got(alias, 1)(x)))
    return {"fide_id": F.try_element_at(F.filter(ids, is_fide), F.lit(-1))["id"], "ids": others, "elo": F.map_from_entries(last_of_each(grid, "year")), "aliases": aliases}


def read_players(spark: SparkSession, path: str, dialect: str = "strict", limit: int | None = None) -> DataFrame:
    """A row for each block: file, line_no, line, malformed, record_no (of well-formed ones in the file, from 1), name, title_token, federation, bracket_rating, birth_year, fide_id, ids, elo
    (year to twelve ratings; in the raw dialect to its values as text), aliases. Rows of a file go by line_no.

    limit keeps the first well-formed blocks of each file; lines beyond them are dropped where they are read, before anything is grouped."""
    strict = {"strict": True, "raw": False}[dialect]
    s = sectioned_lines(spark, path)
    if strict:
        is_name = (F.col("section") == "PLAYER") & ~F.col("indented") & (F.col("line") != "") & ~F.col("line").startswith("#") & F.col("header").isNull()
        is_detail, shown = (F.col("section") == "PLAYER") & F.col("indented") & (F.col("line") != ""), F.col("line")
    else:
        is_name = (F.col("value") != "") & ~F.col("value").startswith("@") & ~F.col("value").startswith(" ")
        is_detail, shown = F.col("value").startswith(" "), F.col("value")
    parse, details = (strict_name_line, strict_details) if strict else (raw_name_line, raw_details)
    s = s.withColumns({"is_name": F.coalesce(is_name, F.lit(False)), "is_detail": F.coalesce(is_detail, F.lit(False)), "shown": shown})
    s = s.withColumn("well", F.when(F.col("is_name"), parse(F.col("shown"))["valid"]).otherwise(False))
    s = s.withColumn("mark", F.when(F.col("is_name"), F.col("line_no")).when(F.col("header").isNotNull() & F.lit(strict), 0))
    left = s.groupBy("file", "block").agg(F.max_by("mark", F.when(F.col("mark").isNotNull(), F.col("line_no"))).alias("mark"), F.count_if("well").alias("records"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    left = left.select(F.col("file").alias("f"), F.col("block").alias("b"), F.last("mark", True).over(earlier).alias("before"), F.coalesce(F.sum("records").over(earlier), F.lit(0)).alias("records_before"))
    here = Window.partitionBy("file", "block").orderBy("line_no")
    s = s.withColumns({"own": F.last("mark", True).over(here), "so_far": F.sum(F.col("well").cast("bigint")).over(here)}).join(left, (F.col("file") == F.col("f")) & (F.col("block") == F.col("b")))
    s = s.withColumns({"owner": F.coalesce("own", "before", F.lit(0)), "record_no": F.col("records_before") + F.col("so_far")}).filter("owner > 0 and (is_name or is_detail)")
    s = s.filter(F.col("record_no") <= limit) if limit is not None else s
    listed = F.transform(F.array_sort(F.collect_list(F.when(F.col("is_detail"), F.struct("line_no", "shown")))), lambda x: x["shown"])
    blocks = s.groupBy("file", F.col("owner").alias("line_no")).agg(F.max(F.when(F.col("is_name"), F.col("shown"))).alias("line"), F.min("record_no").alias("record_no"), listed.alias("details"))
    p = parse(F.col("line"))
    blocks = blocks.withColumn("p", p).withColumn("details", F.when(F.col("p.valid"), F.col("details")).otherwise(F.array().cast("array<string>")))
    well = lambda c: F.when(F.col("p.valid"), F.col(f"p.{c}")).alias(c)
    read = [well(c) for c in ("name", "title_token", "federation", "bracket_rating", "birth_year")]
    return blocks.select("file", "line_no", "line", (~F.col("p.valid")).alias("malformed"), F.when(F.col("p.valid"), F.col("record_no")).alias("record_no"), *read, *[v.alias(c) for c, v in details(F.col("details")).items()])


def last_block_wins(blocks: DataFrame) -> DataFrame:
    """Of blocks with one FIDE id the last in the file; blocks without one go."""
    return blocks.filter(F.col("fide_id").isNotNull()).groupBy("fide_id").agg(F.max_by(F.struct(*blocks.columns), F.struct("file", "line_no")).alias("b")).select("b.*")


def block_counts(blocks: DataFrame) -> DataFrame:
    """players (with a FIDE id, each once), without_fide_id and malformed."""
    return blocks.agg(F.count_distinct("fide_id").alias("players"), F.count_if(~F.col("malformed") & F.col("fide_id").isNull()).alias("without_fide_id"), F.count_if("malformed").alias("malformed"))
