"""Tournament documents from crosstables, as XML text made of expressions: one document a row, nothing collected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from castellan.functions import dates, names, text, vocabulary
from castellan.operators.registries import unique_names

NAMESPACE = "urn:ctml:2.0"


def tag(indent: int, name: str, value: Column) -> Column:
    """An indented element of the value; null, so no line at all, for a blank one."""
    return F.when(F.trim(value) != "", F.concat(F.lit(f"{' ' * indent}<ctml:{name}>"), text.esc(value), F.lit(f"</ctml:{name}>")))


def lines(*parts: Column | str) -> Column:
    """Lines one under the other; null ones are left out."""
    return F.concat_ws("\n", *(F.lit(p) if isinstance(p, str) else p for p in parts))


def attribute(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f' {name}="'), text.esc(value), F.lit('"')), F.lit(""))


def date_element(name: str, date: Column) -> Column:
    """A partial date with its parts as attributes, and its ISO text if it is a day of the calendar."""
    parts = F.concat(attribute("y", date["y"].cast("string")), attribute("m", date["m"].cast("string")), attribute("d", date["d"].cast("string")), attribute("iso", dates.iso(date)))
    return F.concat(F.lit(f"<ctml:{name}><ctml:"), dates.precision(date), parts, F.lit(f"/></ctml:{name}>"))


def person_element(display: Column, indent: int = 8, extract_suffix: bool = True) -> Column:
    """A name in parts; a blank one is Unknown."""
    pad = " " * indent

    def element(shown: Column, n: Column) -> Column:
        given = F.nullif(F.array_join(F.transform(n["given"], lambda g: F.concat(F.lit(f"{pad}  <ctml:given>"), text.esc(g), F.lit("</ctml:given>"))), "\n"), F.lit(""))
        known = lines(F.concat(F.lit(f"{pad}  <ctml:family>"), text.esc(n["family"]), F.lit("</ctml:family>")), given, tag(indent + 2, "suffix", n["suffix"]))
        unknown = (n["family"] == "") & (F.size(n["given"]) == 0)
        return lines(F.concat(F.lit(f'{pad}<ctml:name display="'), text.esc(shown), F.lit('">')), F.when(unknown, f"{pad}  <ctml:unstructured>Unknown</ctml:unstructured>").otherwise(known), f"{pad}</ctml:name>")

    def named(v: Column) -> Column:
        return text.bound({"shown": v["shown"], "n": names.split_normal(v["shown"], extract_suffix)}, lambda w: element(w["shown"], w["n"]))

    spelled = lambda v: F.when(v["d"] != "", v["d"]).otherwise("Unknown")
    return text.bound({"d": text.normalize_space(display)}, lambda v: text.bound({"shown": spelled(v)}, named))


def clean(value: Column) -> Column:
    """Text without superfluous blanks; null if nothing is left."""
    return F.nullif(text.normalize_space(value), F.lit(""))


def participant_element(p: Column, number: Column, system: Column, as_of: Column, source: Column, url: Column, resolver: Column) -> Column:
    """A participant: reference with name, federation, title and ids around it, rating at the date of as_of (an element), seed, score and notes."""
    capitals = lambda f: F.upper(text.normalize_space(F.coalesce(p[f], F.lit(""))))
    plain = {"name": text.normalize_space(p["name"]), "fed": capitals("fed"), "title": capitals("title"), "fide": F.trim(p["fide_id"]), "seed": text.int_like(p["seed"]).cast("string"), "own": text.int_like(p["source_id"]).cast("string")}

    def read(v: Column) -> Column:
        name, fed = F.nullif(v["name"], F.lit("")), names.federation_of(v["fed"])
        read = {"name": name, "fed": fed, "title": names.title_of(v["title"]), "who": names.player_ref(p["ref"], p["fide_id"], name, fed), "fide": F.when(names.is_valid_fide_id(v["fide"]), v["fide"]), "seed": v["seed"], "own_id": F.coalesce(v["own"], v["seed"])}
        return text.bound(read, element)

    def element(v: Column) -> Column:
        title, who, fide, own_id, seed = v["title"], v["who"], v["fide"], v["own_id"], v["seed"]
        ids = F.when(fide.isNotNull() | own_id.isNotNull(), lines("        <ctml:ids>", tag(10, "fideId", fide), tag(10, "internalId", F.concat(source, F.lit(":"), own_id)), "        </ctml:ids>"))
        unresolved = F.when(who["method"] == "unresolved", F.concat(F.lit('        <ctml:resolution method="unresolved" resolver="'), text.esc(resolver), F.lit('"/>')))
        rating = F.when(p["rating"].isNotNull(), lines(
            F.concat(F.lit('      <ctml:ratingSnapshot system="'), system, F.lit('" scope="standard">')), tag(8, "value", p["rating"].cast("string")), F.concat(F.lit("        "), as_of), "      </ctml:ratingSnapshot>"))
        note = text.notes(rank=p["rank"].cast("string"), raw_title=title["other"], club=clean(p["club"]), sex=clean(p["sex"]))
        return lines(
            F.concat(F.lit('    <ctml:participant id="'), F.format_string("p%04d", number), F.lit('">')), F.concat(F.lit("      <ctml:playerRef"), attribute("ref", who["ref"]), attribute("source", url), F.lit(">")), person_element(v["name"]),
            tag(8, "federation", v["fed"]), tag(8, "title", title["title"]), ids, unresolved, "      </ctml:playerRef>", rating, tag(6, "seed", seed), tag(6, "score", text.format_g(p["score"])), tag(6, "notes", note), "    </ctml:participant>")

    return text.bound(plain, read)


def usable(tables: DataFrame) -> DataFrame:
    """tables with skipped: why a crosstable makes no document (no event name, no named player, no start date), or null."""
    named = F.filter("players", lambda p: F.trim(p["name"]) != "")
    reason = F.when(F.trim(F.coalesce("event", F.lit(""))) == "", "no event").when(F.coalesce(F.size(named), F.lit(0)) < 1, "no named player").when(dates.parse_iso(F.col("start")).isNull(), "no start date")
    return tables.withColumn("skipped", reason)


def tournament_documents(tables: DataFrame, order: str = "ord") -> DataFrame:
    """id, file_name and xml for each usable crosstable; order numbers files of one name."""
    t = usable(tables).filter("skipped is null").withColumn("s", dates.parse_iso(F.col("start"))).withColumn("e", F.coalesce(dates.parse_iso(F.col("end")), F.col("s")))
    hashed = text.sha1_hex16(F.to_json(F.struct("event", "source", "start"), {"ignoreNullFields": "false"}))
    own = {"the_source": F.coalesce(clean(F.col("source")), F.lit("source")), "the_ref": F.when(F.trim("ref") != "", F.col("ref")).otherwise(hashed), "name": clean(F.col("event")), "at": clean(F.col("url"))}
    t = t.withColumns(own).withColumn("id", text.xml_id(F.lit("t"), F.replace("the_source", F.lit("-"), F.lit("_")), text.slug(F.col("the_ref")), dates.compact(F.col("s"))))
    t = t.withColumn("system", vocabulary.rating_system(F.col("rating_system"))).withColumn("resolver", F.coalesce(clean(F.col("reader")), F.col("the_source")))
    named = F.filter("players", lambda p: clean(p["name"]).isNotNull())
    shared = {"system": F.col("system"), "as_of": date_element("asOf", F.col("s")), "source": F.col("the_source"), "url": F.col("at"), "resolver": F.col("resolver")}
    people = text.bound(shared, lambda v: F.transform(named, lambda p, i: participant_element(p, i + 1, v["system"], v["as_of"], v["source"], v["url"], v["resolver"])))
    kind, place, country = vocabulary.event_format(F.coalesce("format", F.lit(""))), clean(F.col("place")), F.nullif(names.normalize_federation(F.coalesce("country", F.lit(""))), F.lit(""))
    event = F.when(clean(F.col("event_ref")).isNotNull(), lines(F.concat(F.lit("    <ctml:eventRef"), attribute("ref", clean(F.col("event_ref"))), F.lit(">")), tag(6, "name", F.col("name")), "    </ctml:eventRef>"))
    where = F.concat(F.lit("place:raw:"), text.sha1_hex16(F.lower(place)))
    where = F.when(place.isNotNull(), lines(
        F.concat(F.lit("    <ctml:placeRef"), attribute("ref", where), attribute("kind", F.when(place == country, "country").otherwise("unknown")), F.lit(">")), tag(6, "name", place), tag(6, "country", country), "    </ctml:placeRef>"))
    team = F.when(F.col("classification") == "team", "Source table was classified as team standings and should be reviewed before publication.")
    from_path = F.concat(F.lit("; source_path="), clean(F.col("source_path")))
    xml = lines(
        '<?xml version="1.0" encoding="UTF-8"?>', F.concat(F.lit(f'<ctml:tournament xmlns:ctml="{NAMESPACE}" ctmlVersion="2.0"'), attribute("id", F.col("id")), F.lit(">")), "  <ctml:header>", tag(4, "name", F.col("name")), event,
        tag(4, "eventType", F.nullif(kind, F.lit("unknown"))), tag(4, "cadence", vocabulary.event_cadence(F.col("cadence"), F.concat_ws(" ", "name", "notes"))),
        "    <ctml:dates>", F.concat(F.lit("      "), date_element("start", F.col("s"))), F.concat(F.lit("      "), date_element("end", F.col("e"))), "    </ctml:dates>", where, "  </ctml:header>",
        "  <ctml:participants>", F.array_join(people, "\n"), "  </ctml:participants>", tag(2, "notes", F.concat_ws(" ", clean(F.col("notes")), team)),
        F.concat(F.lit("  <ctml:source"), attribute("kind", F.col("the_source")), F.lit(">")), tag(4, "uri", F.col("at")), tag(4, "note", F.concat(F.lit("ref="), F.col("the_ref"), F.coalesce(from_path, F.lit("")))), "  </ctml:source>", "</ctml:tournament>", "")
    # names are dealt before the text is made, so that no document is shuffled
    t = t.withColumn("base", F.concat_ws("-", text.slug(F.when(F.trim("ref") != "", F.col("ref")).otherwise((F.col(order) + 1).cast("string"))), text.slug(F.col("event"), "event")))
    return unique_names(t, "base", order).select("id", "file_name", xml.alias("xml"))


def skip_counts(tables: DataFrame) -> DataFrame:
    """skipped (null: written) and how many crosstables."""
    return usable(tables).groupBy("skipped").agg(F.count("*").alias("tables"))
