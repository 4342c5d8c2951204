"""References of players and events by name: unique or unresolved, never a guess.

Both work on distinct keys, so a name that a third of all rows carry is resolved once, and nothing is collected by key: whether a candidate is alone is told by
the least and the greatest reference, which add up before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from castellan.functions import text

#: How a player was found, the strongest first.
METHODS = ("fide-id", "name-exact", "name-alias", "surname-unique")


def person_key(name: Column) -> Column:
    """Lower-case letters and digits of a name, single blanks between its parts. ``Family, Given`` keeps its order: see turned."""
    return F.trim(F.regexp_replace(F.lower(name), r"[^\p{L}\p{N}]+", " "))


def turned(name: Column) -> Column:
    """``Family, Given`` as ``Given Family``; null without a comma."""
    return F.when(name.contains(","), F.concat_ws(" ", F.substring(name, F.instr(name, ",") + 1, F.length(name)), F.substring_index(name, ",", 1)))


def player_candidates(players: DataFrame) -> DataFrame:
    """key, tier and ref: everything that a registry's players answer to. players: ref, name, fide_id, aliases (array).

    A name answers in the order it is written and, if it has a comma, turned; a family name of one part answers alone."""
    family = person_key(F.when(F.col("name").contains(","), F.substring_index("name", ",", 1)).otherwise(F.substring_index(text.normalize_space(F.col("name")), " ", -1)))
    aliases = F.coalesce("aliases", F.array().cast("array<string>"))

    def entries(tier: int, *keys: Column) -> Column:
        return F.transform(F.array(*keys), lambda k: F.struct(F.lit(tier).alias("tier"), k.alias("key")))

    by_alias = F.flatten(F.transform(aliases, lambda a: entries(2, person_key(a), person_key(turned(a)))))
    every = F.concat(entries(0, F.concat(F.lit("#"), F.trim("fide_id"))), entries(1, person_key(F.col("name")), person_key(turned(F.col("name")))), by_alias, entries(3, F.when(~family.contains(" "), family)))
    return players.select("ref", F.explode(F.array_distinct(every)).alias("e")).select("e.key", "e.tier", "ref").filter("key <> '' and key <> '#'")


def resolve_players(rows: DataFrame, players: DataFrame, name: str = "name", fide_id: str | None = None, fall_through: bool = False) -> DataFrame:
    """rows with player_ref, method and candidates (at the tier that decided: 0 for none, 2 for several).

    Tiers: FIDE id, name, alias, surname of one part. The strongest tier in which anyone answers decides: one candidate resolves, several leave the name unresolved,
    unless fall_through asks the weaker ones then. Unresolved names get a reference made of the name."""
    decided = player_candidates(players).groupBy("key", "tier").agg(F.min("ref").alias("low"), F.max("ref").alias("high"))
    best = F.struct((F.col("low") != F.col("high")).alias("many"), "tier", "low") if fall_through else F.struct("tier", (F.col("low") != F.col("high")).alias("many"), "low")
    decided = decided.groupBy("key").agg(F.min(best).alias("found"))
    asked = rows.select(F.col(name).alias("_name"), (F.trim(F.col(fide_id)) if fide_id else F.lit(None).cast("string")).alias("_id")).distinct()
    by_id = decided.filter("key like '#%'").select(F.col("key").alias("_k"), F.col("found").alias("_by_id"))
    by_name = decided.filter("key not like '#%'").select(F.col("key").alias("_n"), F.col("found").alias("_by_name"))
    found = asked.join(by_id, F.concat(F.lit("#"), F.col("_id")) == F.col("_k"), "left").join(by_name, person_key(F.col("_name")) == F.col("_n"), "left")
    one = F.coalesce(F.when(~F.col("_by_id.many"), F.col("_by_id")), F.col("_by_name") if fall_through else F.when(F.col("_by_id").isNull(), F.col("_by_name")))
    resolved = F.when(~F.col("_one.many"), F.col("_one.low"))
    made = F.concat(F.lit("player:syn:"), text.sha1_hex16(F.lower(F.trim("_name"))))
    many = F.coalesce(F.col("_one.many") | F.col("_by_id.many"), F.col("_by_id.many"), F.col("_one.many"))
    found = found.withColumn("_one", one).select(
        "_name", "_id", F.coalesce(resolved, made).alias("player_ref"), F.when(resolved.isNotNull(), F.element_at(F.lit(list(METHODS)), F.col("_one.tier") + 1)).otherwise("unresolved").alias("method"),
        F.when(resolved.isNotNull(), 1).when(many, 2).otherwise(0).alias("candidates"))
    same_id = F.trim(F.col(f"r.{fide_id}")).eqNullSafe(F.col("f._id")) if fide_id else F.lit(True)
    return rows.alias("r").join(found.alias("f"), F.col(f"r.{name}").eqNullSafe(F.col("f._name")) & same_id, "left").select("r.*", "player_ref", "method", "candidates")


def bucketed(df: DataFrame, start: str, end: str, days: int) -> DataFrame:
    """A row for each bucket of so many days that a closed interval of dates meets: _first (its first bucket) and _bucket."""
    at = lambda c: F.floor(F.datediff(F.col(c), F.lit("1970-01-01").cast("date")) / days).cast("int")
    return df.withColumn("_first", at(start)).withColumn("_bucket", F.explode(F.sequence("_first", F.greatest(at(end), F.col("_first")))))


def overlap_join(left: DataFrame, right: DataFrame, key: str, start: str, end: str, days: int = 32) -> DataFrame:
    """Pairs of rows of one key whose closed date intervals meet: left's columns, then right's as r_<name>.

    Both sides have key, start and end. An equi-join on key and bucket: a key of very many intervals is dealt over its buckets, and a pair comes out
    only of the first bucket that both meet, so nothing has to be told apart afterwards. An interval of n days takes 1 + n / days rows."""
    a, b = bucketed(left, start, end, days), bucketed(right.toDF(*[f"r_{c}" for c in right.columns]), f"r_{start}", f"r_{end}", days).withColumnsRenamed({"_first": "_r_first", "_bucket": "_r_bucket"})
    met = a.join(b, (F.col(key) == F.col(f"r_{key}")) & (F.col("_bucket") == F.col("_r_bucket")) & (F.col("_bucket") == F.greatest("_first", "_r_first")) & (F.col(start) <= F.col(f"r_{end}")) & (F.col(end) >= F.col(f"r_{start}")))
    return met.drop("_first", "_bucket", "_r_first", "_r_bucket")


def event_key(name: Column) -> Column:
    return text.slug(name, "")


def resolve_events(rows: DataFrame, occurrences: DataFrame, name: str = "event", start: str = "start", end: str = "end", days: int = 32) -> DataFrame:
    """rows with event_ref, event_method (alias-dates or unresolved) and candidates (0, 1 or 2 for several).

    rows have an event name and dates (end defaults to start); occurrences: ref, names (array: the occurrence's, its aliases, its series'), start, end. An occurrence is a candidate if one
    of its names is the row's and their dates meet; one candidate resolves, none or several leave the reference null, and so does a row without dates."""
    own = occurrences.select("ref", F.explode(F.array_distinct(F.transform("names", event_key))).alias("key"), F.col("start").cast("date").alias("start"), F.coalesce("end", "start").cast("date").alias("end"))
    own = own.filter("key <> ''").distinct()
    asked = rows.select(event_key(F.col(name)).alias("key"), F.col(start).cast("date").alias("start"), F.coalesce(end, start).cast("date").alias("end")).filter("key <> '' and start is not null").distinct()
    found = overlap_join(asked, own, "key", "start", "end", days).groupBy("key", "start", "end").agg(F.min("r_ref").alias("low"), F.max("r_ref").alias("high"))
    found = found.toDF("_key", "_start", "_end", "_low", "_high")
    same = (event_key(F.col(name)) == F.col("_key")) & (F.col(start).cast("date") == F.col("_start")) & (F.coalesce(end, start).cast("date") == F.col("_end"))
    ref = F.when(F.col("_low") == F.col("_high"), F.col("_low"))
    return rows.join(found, same, "left").select(
        *[rows[c] for c in rows.columns], ref.alias("event_ref"), F.when(ref.isNotNull(), "alias-dates").otherwise("unresolved").alias("event_method"), F.when(ref.isNotNull(), 1).when(F.col("_low").isNotNull(), 2).otherwise(0).alias("candidates"))


def event_ref_or_made(ref: Column, name: Column, start: Column, end: Column) -> Column:
    """The reference, or for an unresolved event one made of its dates and name."""
    return F.coalesce(ref, F.concat(F.lit("event:"), F.date_format(start, "yyyyMMdd"), F.lit("-"), F.date_format(F.coalesce(end, start), "yyyyMMdd"), F.lit("-"), text.slug(name)))
