"""Player, place and event registries: merging records of one entity, and the entries of normalisation tables."""

from __future__ import annotations

from unicodedata import normalize

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from castellan.functions import dates, names, text
from castellan.operators.players import latest, peak
from castellan.workspace import keep


def ordered_distinct(items: str, order: list[str]) -> Column:
    """The distinct elements of arrays gathered from a group, by first appearance in order."""
    by = F.struct(*order, F.col(items).alias("_items"))
    return F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(by)), lambda x: x["_items"])))


def merge_rating_months(months: DataFrame, key: str, prefer: str = "sparse") -> DataFrame:
    """key, year, month, rating from the records (column record, its order in line) of one key. Where they differ, the record of fewest rated
    months wins, the earlier one of equals; prefer="dense" turns that round."""
    rated = months.filter(F.col("rating").isNotNull())
    points = rated.groupBy(key, "line").agg(F.count("*").alias("points"))
    n = F.col("points") if prefer == "sparse" else -F.col("points")
    return rated.join(points, [key, "line"]).groupBy(key, "year", "month").agg(F.min_by("rating", F.struct(n, "line")).alias("rating"))


def merge_players(records: DataFrame) -> DataFrame:
    """One player for each FIDE id; records without one pass through.

    records: fide_id, line, name, titles (array), female, birth_year, federation, rated_months, aliases (array). The name is that of the first
    record, the federation that of the record of most rated months (the first of equals), the birth year the first known one; titles are
    united in order, and so are the aliases: each later record's own name, then those it lists, without the name that is kept."""
    first = F.min("line").over(Window.partitionBy("fide_id"))
    spelled = F.when(F.col("line") == first, F.col("aliases")).otherwise(F.concat(F.array("name"), F.col("aliases")))
    records = records.withColumn("aliases", F.when(F.col("fide_id").isNotNull(), spelled).otherwise(F.col("aliases")))
    by = F.struct("line")
    g = records.filter(F.col("fide_id").isNotNull()).groupBy("fide_id").agg(
        F.min("line").alias("line"), F.min_by("name", by).alias("name"), ordered_distinct("titles", ["line"]).alias("titles"), F.bool_or("female").alias("female"),
        F.min_by("birth_year", F.when(F.col("birth_year").isNotNull(), F.col("line"))).alias("birth_year"), F.max_by("federation", F.when(F.col("federation") != "", F.struct("rated_months", -F.col("line")))).alias("federation"),
        F.max("rated_months").alias("rated_months"), ordered_distinct("aliases", ["line"]).alias("aliases"))
    g = g.withColumn("aliases", F.filter("aliases", lambda a: (a != "") & (a != F.col("name"))))
    return g.select(records.columns).unionByName(records.filter(F.col("fide_id").isNull()))


def player_records(blocks: DataFrame) -> DataFrame:
    """Whole registry records of player blocks (sources.players.read_players, the raw dialect; malformed ones are left out): blocks of one FIDE id are one player, any other is its own.

    ref, fide_id, name, federation, titles, female, birth_year, ids (of other registries, by first appearance), aliases, history (years that have ratings, with twelve months), current_rating,
    peak, peak_year, peak_month. What merge_players and merge_rating_months say holds; without a FIDE id the reference is made of the name and federation."""
    b = blocks.filter(~F.col("malformed")).withColumn("key", F.coalesce("fide_id", F.concat_ws(":", F.lit("line"), "file", F.col("line_no").cast("string"))))
    b = b.withColumns({"line": F.col("line_no"), "t": names.title_tokens(F.coalesce("title_token", F.lit(""))), "federation": F.coalesce("federation", F.lit(""))})
    points = F.size(F.filter(F.flatten(F.map_values("elo")), lambda v: v != "?"))
    own = b.select(F.col("key").alias("fide_id"), "line", "name", F.col("t.titles").alias("titles"), F.col("t.female").alias("female"), "birth_year", "federation", points.alias("rated_months"), "aliases")
    merged = merge_players(own).withColumnRenamed("fide_id", "key").drop("line", "rated_months").withColumn("federation", F.coalesce("federation", F.lit("")))
    more = b.groupBy("key").agg(F.first("fide_id").alias("fide_id"), ordered_distinct("ids", ["line"]).alias("ids"))
    values = b.select("key", "line", F.explode("elo").alias("year", "months")).select("key", "line", "year", F.posexplode("months").alias("month", "value"))
    months = merge_rating_months(values.select("key", "line", "year", (F.col("month") + 1).alias("month"), F.col("value").try_cast("int").alias("rating")), "key")
    year = F.map_from_entries(F.collect_list(F.struct("month", "rating")))
    years = months.groupBy("key", "year").agg(year.alias("m")).select("key", F.struct("year", F.transform(F.sequence(F.lit(1), F.lit(12)), lambda i: F.try_element_at("m", i)).alias("months")).alias("y"))
    history = years.groupBy("key").agg(F.array_sort(F.collect_list("y")).alias("history"))
    r = merged.join(more, "key").join(history, "key", "left").withColumn("history", F.coalesce("history", F.array().cast(history.schema["history"].dataType)))
    made = F.concat(F.lit("player:syn:"), text.sha1_hex16(F.concat(F.lower(F.trim("name")), F.lit("|"), F.upper(F.trim("federation")))))
    best = peak(F.col("history"))
    return r.select(
        F.coalesce(F.concat(F.lit("player:fide:"), "fide_id"), made).alias("ref"), "fide_id", "name", "federation", "titles", "female", "birth_year", "ids", "aliases", "history", latest(F.col("history")).alias("current_rating"),
        best["value"].alias("peak"), best["year"].alias("peak_year"), best["month"].alias("peak_month"))


def merge_places(places: DataFrame) -> DataFrame:
    """One place for each ref: the name of least priority (then of least folded name), the first country and kind that are given, aliases
    united, legacy if any record is. places: ref, priority, name, country, kind, aliases (array), legacy."""
    rank = F.struct("priority", F.lower("name").alias("folded"), "name")
    given = lambda c: F.min_by(c, F.when(F.col(c) != "", rank)).alias(c)
    return places.groupBy("ref").agg(F.min("priority").alias("priority"), F.min_by("name", rank).alias("name"), given("country"), given("kind"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("aliases")))).alias("aliases"), F.bool_or("legacy").alias("legacy"))


def place_rows(cities: DataFrame, states: DataFrame, countries: DataFrame) -> DataFrame:
    """Cities as places under their state, or their country where the state is unknown; first-level divisions and cities of unknown
    countries are left out. cities: id, name, type, country_id, state_id; states: id, code; countries: id, iso3."""
    c = cities.filter("type is null or type <> 'adm1'").join(countries.select(F.col("id").alias("country_id"), "iso3"), "country_id")
    c = c.join(states.select(F.col("id").alias("state_id"), "code"), "state_id", "left")
    kind = F.when(F.col("type") == "adm2", "admin2").otherwise("city")
    ref = F.concat(F.lit("place:"), kind, F.lit(":"), F.col("iso3"), F.lit("-"), F.col("id"))
    parent = F.coalesce(F.concat(F.lit("place:admin1:"), F.col("code")), F.concat(F.lit("place:country:"), F.col("iso3")))
    return c.select(ref.alias("ref"), kind.alias("kind"), "name", F.col("iso3").alias("country"), parent.alias("parent_ref"))


def occurrences(records: DataFrame) -> DataFrame:
    """Event occurrences from tournament records: name, start and end (partial dates), format, source, ord. Unnamed and undated ones are left
    out, a missing end or start is the other one, reversed days are swapped; the first record names the occurrence."""
    r = records.withColumn("slug", text.slug(F.col("name"))).filter("name is not null and trim(name) not in ('', '?') and slug <> 'unknown'")
    start, end = dates.sanitize(F.coalesce("start", "end")), dates.sanitize(F.coalesce("end", "start"))
    r = r.filter(F.col("start").isNotNull() | F.col("end").isNotNull()).withColumn("s", start).withColumn("e", end)
    turned = dates.iso(F.col("s")) > dates.iso(F.col("e"))
    a, b = F.when(turned, F.col("e")).otherwise(F.col("s")), F.when(turned, F.col("s")).otherwise(F.col("e"))
    r = r.withColumn("ref", F.concat(F.lit("event:"), dates.compact(a), F.lit("-"), dates.compact(b), F.lit("-"), F.col("slug"))).withColumn("series", F.concat(F.lit("series:"), F.col("slug")))
    return r.groupBy("ref", "series").agg(F.min_by("name", "ord").alias("name"), F.min_by("format", "ord").alias("format"), F.array_sort(F.collect_set("name")).alias("aliases"), F.array_sort(F.collect_set("source")).alias("sources"))


def canonical_entries(names: DataFrame, section: str = "EVENT") -> tuple[DataFrame, DataFrame]:
    """Entries (canonical, aliases) and diagnostics (name, problem) of names: canonical, alias, priority.

    Canonical spellings of one key become one entry under the spelling of least priority, folded name and name; its other spellings, and those of an
    alias of the same key, are aliases. So is every spelling of another key, unless several entries claim the key or it is another's own.
    Names that the line format cannot hold go to the diagnostics."""
    problem = lambda c: F.when(F.col(c).isNotNull(), text.name_problem(text.normalize_space(F.col(c))))
    n = names.withColumns({"canonical": text.normalize_space(F.col("canonical")), "alias": text.normalize_space(F.col("alias"))}).withColumns({"cp": problem("canonical"), "ap": problem("alias")})
    n = n.withColumns({"ckey": spelling_key(F.col("canonical"), section), "akey": spelling_key(F.col("alias"), section)})
    unusable = n.filter("cp is not null").select(F.col("canonical").alias("name"), F.col("cp").alias("problem"))
    unusable = unusable.unionByName(n.filter("cp is null and ap is not null").select(F.col("alias").alias("name"), F.col("ap").alias("problem")))
    unusable = unusable.unionByName(n.filter("cp is null and ckey = ''").select(F.col("canonical").alias("name"), F.lit("nothing but marks").alias("problem")))
    good = n.filter("cp is null and canonical is not null and ckey <> ''")
    shown = good.groupBy("ckey").agg(F.min_by("canonical", F.struct("priority", F.lower("canonical").alias("f"), F.col("canonical").alias("raw"))).alias("canonical"))
    aliased = good.filter("alias is not null and ap is null").withColumn("own", (F.col("akey") == "") | (F.col("akey") == F.col("ckey")))
    spellings = good.select("ckey", F.col("canonical").alias("alias")).unionByName(aliased.filter("own").select("ckey", "alias"))
    claims = aliased.filter("not own").groupBy("akey").agg(F.count_distinct("ckey").alias("claims"))
    claimed = aliased.filter("not own").select("ckey", "akey", "alias").distinct().join(claims, "akey").join(shown.select(F.col("ckey").alias("akey"), F.lit(True).alias("heads")), "akey", "left")
    verdict = F.when(F.col("claims") > 1, "several targets").when(F.col("heads"), "is a canonical name")
    claimed = claimed.withColumn("problem", verdict)
    first = F.min_by("alias", F.struct(F.lower("alias").alias("f"), "alias")).alias("name")
    refused = claimed.filter("problem is not null").groupBy("ckey", "akey", "problem").agg(first).select("name", "problem")
    kept = spellings.unionByName(claimed.filter("problem is null").select("ckey", "alias")).distinct()
    sorted_aliases = F.transform(F.array_sort(F.collect_list(F.struct(F.lower("alias").alias("f"), "alias"))), lambda x: x["alias"])
    entries = shown.join(kept, "ckey").filter("alias <> canonical").groupBy("ckey").agg(sorted_aliases.alias("aliases"))
    entries = shown.join(entries, "ckey", "left").select("canonical", F.coalesce("aliases", F.array().cast("array<string>")).alias("aliases"))
    return entries, unusable.unionByName(refused).distinct()


#: Characters that do not tell spellings apart, by section.
IGNORED = {"SITE": "., -_()", "EVENT": ",. -_", "ROUND": ""}


def spelling_key(name: Column, section: str = "EVENT") -> Column:
    """NFC, folded case and single blanks, without the characters that the section ignores."""
    return F.translate(folded(text.normalize_space(name)), IGNORED[section], "")


def folded(x: Column) -> Column:
    """Composed letters with their case folded, in Arrow batches: Spark has neither."""

    def run(names: pd.Series) -> pd.Series:
        return names.map(lambda n: normalize("NFC", n).casefold() if n else n)

    return F.pandas_udf(run, "string")(x)


def section_problems(entries: DataFrame) -> DataFrame:
    """What a written section would get wrong: entries of section, line, canonical, alias (null for a canonical line)."""
    k = entries.withColumn("ckey", F.lower("canonical")).withColumn("akey", F.lower("alias"))
    heads = k.filter("alias is null")
    doubled = heads.groupBy("section", "ckey").agg(F.count("*").alias("n"), F.min("line").alias("line")).filter("n > 1").select("section", "line", F.lit("duplicate canonical").alias("problem"))
    several = k.filter("alias is not null").groupBy("section", "akey").agg(F.count_distinct("ckey").alias("n"), F.min("line").alias("line")).filter("n > 1").select("section", "line", F.lit("alias of several").alias("problem"))
    orphan = k.filter("alias is not null").join(heads.select("section", "ckey"), ["section", "ckey"], "left_anti").select("section", "line", F.lit("alias without canonical").alias("problem"))
    shadow = k.filter("alias is not null").join(heads.select("section", F.col("ckey").alias("akey"), F.col("ckey").alias("other")), ["section", "akey"]).filter("other <> ckey").select("section", "line", F.lit("alias is a canonical").alias("problem"))
    return doubled.unionByName(several).unionByName(orphan).unionByName(shadow)


def expand_frontier(links: DataFrame, seeds: DataFrame, rounds: int) -> DataFrame:
    """url, depth of pages reached from seeds (url) over links (source, target) in at most rounds steps, each once."""
    visited = seeds.select("url", F.lit(0).alias("depth")).distinct()
    front = visited
    for depth in range(1, rounds + 1):
        found = links.join(front, links["source"] == front["url"]).select(F.col("target").alias("url")).distinct()
        front = keep(found.join(visited.select("url"), "url", "left_anti").withColumn("depth", F.lit(depth)), "frontier")
        if front.isEmpty():
            break
        visited = keep(visited.unionByName(front), "visited")
    return visited


def unique_names(docs: DataFrame, base: str, order: str, longest: int = 150) -> DataFrame:
    """docs with file_name: base cut to longest characters, with -2, -3, ... behind repeats of the whole base.

    Where such names still meet (of a, a, a-2, or of long bases that differ behind the cut), all but the first get a hash of their base and order."""
    n = F.row_number().over(Window.partitionBy(base).orderBy(order))
    named = docs.withColumn("_n", n).withColumn("file_name", F.concat(F.substring(F.col(base), 1, longest), F.when(F.col("_n") > 1, F.concat(F.lit("-"), "_n")).otherwise("")))
    again = F.row_number().over(Window.partitionBy("file_name").orderBy(order))
    mark = F.concat(F.lit("-"), F.substring(F.sha1(F.concat_ws("|", base, F.col(order).cast("string"))), 1, 10))
    return named.withColumn("_again", again).withColumn("file_name", F.when(F.col("_again") == 1, F.col("file_name")).otherwise(F.concat("file_name", mark))).drop("_n", "_again")
