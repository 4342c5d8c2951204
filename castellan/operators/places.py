"""Places: locations in words, countries inferred from names, and the site, event and round entries of normalisation tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from castellan.functions import text
from castellan.operators.documents import lines, tag
from castellan.operators.registries import canonical_entries, folded, spelling_key

#: Sites that are no place.
NO_PLACE = ("?", "unknown", "n/a", "online")
LEAD = "Events taking place in"


def parse_location(name: Column, heading: Column) -> Column:
    """Struct of city, region and country from a place's name and a heading such as "Events taking place in City, Region, Country (until 1918)".

    Without a heading only the city is known; without a name the first part is the city."""
    given = F.trim(F.coalesce(name, F.lit("")))
    tail = F.trim(F.coalesce(heading, F.lit("")))
    tail = F.when(tail.startswith(LEAD), F.trim(F.substring(tail, len(LEAD) + 1, 1 << 30))).otherwise(tail)
    cut = lambda s: F.trim(F.rtrim(F.trim(F.substring_index(F.trim(s), "(", 1)), F.lit(")")))
    parts = F.filter(F.transform(F.split(tail, ","), cut), lambda s: s != "")
    n = F.size(parts)
    city = F.when((given == "") & (n > 0), F.get(parts, F.lit(0))).otherwise(given)
    rest = F.when(F.get(parts, F.lit(0)) == city, F.slice(parts, 2, F.greatest(n - 1, F.lit(0)))).otherwise(parts)
    m = F.size(rest)
    country = F.when(n > 0, F.when(m > 0, F.get(rest, m - 1)).otherwise(F.get(parts, n - 1)))
    region = F.when((n > 0) & (m > 1), F.array_join(F.slice(rest, 1, F.greatest(m - 1, F.lit(0))), ", "))
    return F.struct(city.alias("city"), region.alias("region"), country.alias("country"))


def city_ref(city: Column, country: Column) -> Column:
    """The reference of a city, by a hash of its name and country."""
    return F.concat(F.lit("place:city:"), text.sha1_hex16(F.concat(F.lower(F.trim(city)), F.lit("|"), F.lower(F.trim(F.coalesce(country, F.lit("")))))))


def is_physical(site: Column) -> Column:
    return ~(F.lower(site).isin(*NO_PLACE) | site.contains("://"))


def _named(places: DataFrame) -> DataFrame:
    """places with a row for each spelling."""
    return places.withColumn("spelling", F.explode(F.array_distinct(F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>"))))))


def infer_countries(places: DataFrame) -> DataFrame:
    """places (ref, name, country, kind, aliases) with the country of those without one filled in: by the first alias, in order of spelling, whose
    last part after a comma is the name of one country only; else by another place of the same name, if all such lie in one country."""
    blank = F.coalesce(F.col("country"), F.lit("")) == ""
    countries = _named(places.filter((F.col("kind") == "country") & ~blank)).groupBy(folded(text.normalize_space(F.col("spelling"))).alias("key"))
    codes = countries.agg(F.count_distinct("country").alias("n"), F.max("country").alias("code")).filter("n = 1").select("key", "code")
    without = places.filter(blank & F.col("ref").isNotNull()).select("ref", F.explode("aliases").alias("alias")).filter(F.col("alias").contains(","))
    ends = without.withColumn("key", folded(text.normalize_space(F.substring_index("alias", ",", -1)))).join(codes, "key")
    by_alias = ends.groupBy("ref").agg(F.min_by("code", "alias").alias("by_alias"))
    p = places.join(by_alias, "ref", "left").withColumn("country", F.when(blank, F.coalesce("by_alias", F.lit(""))).otherwise(F.col("country"))).drop("by_alias")
    p = p.withColumn("_key", spelling_key(F.col("name"), "SITE"))
    alike = p.filter("country <> ''").groupBy("_key").agg(F.count_distinct("country").alias("n"), F.max("country").alias("by_name")).filter("n = 1").drop("n")
    return p.join(alike, "_key", "left").withColumn("country", F.when(F.col("country") == "", F.coalesce("by_name", F.lit(""))).otherwise(F.col("country"))).select(*places.columns)


def place_groups(places: DataFrame) -> DataFrame:
    """key, country, display, priority, spellings and refs of places of one spelling key and country; the spelling of least priority, then of
    least folded name, shows. Countries should be inferred first."""
    p = places.withColumn("key", spelling_key(F.col("name"), "SITE")).withColumn("country", F.coalesce("country", F.lit("")))
    rank = F.struct("priority", F.lower("name").alias("folded"), F.col("name").alias("raw"))
    own = F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))
    return p.groupBy("key", "country").agg(F.min_by("name", rank).alias("display"), F.min("priority").alias("priority"), F.array_sort(F.array_distinct(F.flatten(F.collect_list(own)))).alias("spellings"), F.array_sort(F.collect_set("ref")).alias("refs"))


def matched_sites(sites: DataFrame, groups: DataFrame) -> DataFrame:
    """site, candidates, verdict, key and country of the distinct sites (column site): matched where one group bears the name, ambiguous where
    several do, standalone (a group of its own) where none does, not a place, or unusable."""
    s = sites.select(text.normalize_space(F.col("site")).alias("site")).filter("site <> ''").distinct()
    s = s.withColumns({"problem": text.name_problem(F.col("site")), "at": spelling_key(F.col("site"), "SITE")})
    spelled = groups.select("key", "country", F.explode("spellings").alias("x")).filter(text.name_problem(text.normalize_space(F.col("x"))).isNull())
    index = spelled.select(spelling_key(F.col("x"), "SITE").alias("at"), F.struct("key", "country").alias("g")).groupBy("at").agg(F.count_distinct("g").alias("n"), F.min("g").alias("g"))
    j = s.join(index, "at", "left").withColumn("candidates", F.coalesce("n", F.lit(0)))
    verdict = F.when(F.col("problem").isNotNull(), "unusable").when(~is_physical(F.col("site")), "not a place").when(F.col("candidates") == 1, "matched").when(F.col("candidates") > 1, "ambiguous").otherwise("standalone")
    j = j.withColumn("verdict", verdict)
    key = F.when(F.col("verdict") == "matched", F.col("g.key")).when(F.col("verdict") == "standalone", F.col("at"))
    country = F.when(F.col("verdict") == "matched", F.col("g.country")).when(F.col("verdict") == "standalone", "")
    return j.select("site", "candidates", "verdict", key.alias("key"), country.alias("country"))


def site_entries(places: DataFrame, events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries and diagnostics of the sites in use: those that event records (sites, place_names, place_refs) name or refer to, and the
    cities, venues and kindless places of the older collection (legacy). An entry of a country bears its code, and so do copies of its aliases."""
    groups = place_groups(infer_countries(places))
    named = matched_sites(events.select(F.explode(F.concat("sites", "place_names")).alias("site")), groups)
    by_ref = groups.select("key", "country", F.explode("refs").alias("ref"))
    legacy = places.filter(F.col("legacy") & F.coalesce("kind", F.lit("")).isin("city", "venue", "")).select("ref")
    referred = events.select(F.explode("place_refs").alias("ref")).unionByName(legacy).distinct().join(by_ref, "ref").select("key", "country")
    used = referred.unionByName(named.filter("key is not null").select("key", "country")).distinct()
    extra = named.filter("key is not null").groupBy("key", "country").agg(F.array_sort(F.collect_set("site")).alias("extra"), F.min(F.struct(F.lower("site").alias("f"), "site")).alias("first"))
    t = used.join(groups, ["key", "country"], "left").join(extra, ["key", "country"], "left")
    none = F.array().cast("array<string>")
    t = t.withColumns({"display": F.coalesce("display", "first.site"), "priority": F.coalesce("priority", F.lit(2)), "all": F.array_union(F.coalesce("spellings", none), F.coalesce("extra", none))})
    coded = F.col("country") != ""
    canonical = F.when(coded, F.concat_ws(" ", "display", "country")).otherwise(F.col("display"))
    aliases = F.when(coded, F.array_union("all", F.transform("all", lambda a: F.concat_ws(" ", a, F.col("country"))))).otherwise(F.col("all"))
    rows = t.select(canonical.alias("canonical"), F.explode(aliases).alias("alias"), "priority")
    entries, problems = canonical_entries(rows, "SITE")
    told = named.filter("verdict <> 'matched'").select(F.col("site").alias("name"), F.col("verdict").alias("problem"))
    return entries, problems.unionByName(told).distinct()


def event_entries(events: DataFrame, general: dict[str, list[str]] | None = None) -> tuple[DataFrame, DataFrame]:
    """Entries and diagnostics of event records (name, aliases, priority); general names with their aliases, if any are given, come first."""
    rows = events.select(F.col("name").alias("canonical"), F.explode_outer("aliases").alias("alias"), "priority")
    if general:
        listed = [(c, a, -1) for c, aliases in general.items() for a in (aliases or [None])]
        rows = rows.unionByName(events.sparkSession.createDataFrame(listed, "canonical string, alias string, priority int"))
    return canonical_entries(rows, "EVENT")


def round_entries(spark, most: int) -> DataFrame:
    """canonical and aliases of rounds 1 to most: in brackets, and below ten with a zero in front."""
    n = F.col("id").cast("string")
    bracket = lambda x: F.concat(F.lit("("), x, F.lit(")"))
    zero = F.concat(F.lit("0"), n)
    return spark.range(1, most + 1).select(n.alias("canonical"), F.array_sort(F.when(F.col("id") < 10, F.array(bracket(n), zero, bracket(zero))).otherwise(F.array(bracket(n)))).alias("aliases"))


def country_suffixes(places: DataFrame) -> DataFrame:
    """suffix, in brackets, and the code it stands for: names of three characters or more that belong to one country only."""
    c = _named(places.filter("kind = 'country' and country <> ''")).withColumn("spelling", text.normalize_space(F.col("spelling")))
    c = c.filter(text.name_problem(F.col("spelling")).isNull() & (F.length("spelling") >= 3)).groupBy(folded(F.col("spelling")).alias("key"))
    return c.agg(F.count_distinct("country").alias("n"), F.max("country").alias("code"), F.max("spelling").alias("s")).filter("n = 1").select(F.concat(F.lit("("), "s", F.lit(")")).alias("suffix"), "code")


def alternative_element(names: Column) -> Column:
    """The alternative names of a place, an array of lang and name; null if there are none."""
    one = F.transform(names, lambda n: F.concat(F.lit('      <ctml:altName lang="'), text.esc(n["lang"]), F.lit('">'), text.esc(n["name"]), F.lit("</ctml:altName>")))
    return F.when(F.size(names) > 0, lines("    <ctml:altNames>", F.array_join(one, "\n"), "    </ctml:altNames>"))


def place_element(ref: Column, kind: Column, name: Column, parts: dict[str, Column], names: Column | None = None) -> Column:
    """A place as XML: its name, the parts that are not blank in their order, then alternative names."""
    head = F.concat(F.lit('  <ctml:place ref="'), text.esc(ref), F.lit('" kind="'), kind, F.lit('">'))
    return lines(head, tag(4, "name", name), *(tag(4, k, v) for k, v in parts.items()), *([alternative_element(names)] if names is not None else []), "  </ctml:place>")
