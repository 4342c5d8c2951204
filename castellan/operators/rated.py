"""Screening of whole events by their players' ratings, and documents of a collection that has events and rated results only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from castellan.functions import dates, text
from castellan.operators.documents import lines, person_element, tag
from castellan.operators.places import city_ref, parse_location

SOURCE = "https://www.edochess.ca/"


def screened_crosstables(tables: DataFrame, floor: int) -> DataFrame:
    """tables with kept, reason and lowest: those of two or more players all of whom have a whole number of floor or more as their rating."""
    ratings = F.transform("players", lambda p: p["rating"])
    n, known = F.size(ratings), F.filter(ratings, lambda r: r.isNotNull())
    missing, below = n - F.size(known), F.size(F.filter(known, lambda r: r < floor))
    few = F.col("players").isNull() | (n < 2)
    reason = (
        F.when(few, "fewer than 2 players").when(missing > 0, F.format_string("%d of %d players unrated", missing, n))
        .when(below > 0, F.format_string(f"%d of %d players below {floor}", below, n)).otherwise(F.format_string(f"all %d players rated {floor}+", n))
    )
    return tables.withColumns({"kept": ~few & (missing == 0) & (below == 0), "reason": reason, "lowest": F.when(~few, F.array_min(known))})


def screened_events(events: DataFrame, results: DataFrame, key: str, rating: str, floor: int) -> DataFrame:
    """events with players, least, most, missing, below, kept and reason from their results. Events without results are rejected. Results are
    added up by event before they meet the events, so no event's rows are gathered."""
    r = F.col(rating)
    by = results.groupBy(key).agg(F.count("*").alias("players"), F.min(r).alias("least"), F.max(r).alias("most"), F.count_if(r.isNull()).alias("missing"), F.count_if(r < floor).alias("below"))
    j = events.join(by, key, "left").fillna(0, ["players", "missing", "below"])
    reason = (
        F.when(F.col("players") == 0, "no player rows").when(F.col("missing") > 0, F.format_string("%d missing/unrated player ratings", "missing"))
        .when(F.col("below") > 0, F.format_string(f"%d player ratings below {floor}", "below")).otherwise(F.format_string(f"all %d player ratings >= {floor}", "players"))
    )
    return j.withColumn("kept", (F.col("players") > 0) & (F.col("missing") == 0) & (F.col("below") == 0)).withColumn("reason", reason)


def kept_rows(results: DataFrame, screened: DataFrame, key: str) -> DataFrame:
    """The results of the events that were kept."""
    return results.join(screened.filter("kept").select(key), key, "left_semi")


def game_participants(games: DataFrame, keys: list[str], order: str) -> tuple[DataFrame, DataFrame]:
    """Participants (keys, name, id by first appearance, White first, then by name) and the games with white_id and black_id; games of an unnamed player or
    of a player against themselves have none. games: keys, order, white, black."""
    sides = F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("white").alias("name")), F.struct(F.lit(1).alias("side"), F.col("black").alias("name")))).alias("s")
    seen = games.select(*keys, order, sides).filter("s.name <> ''").groupBy(*keys, F.col("s.name").alias("name")).agg(F.min(F.struct(order, "s.side")).alias("first"))
    # one row for each player of an event: their list is as long as the event's field
    listed = seen.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("first", "name"))).alias("l")).select(*keys, F.posexplode("l").alias("n", "p"))
    people = listed.select(*keys, F.col("p.name").alias("name"), F.format_string("p%04d", F.col("n") + 1).alias("id"))
    side = lambda c: people.select(*keys, F.col("name").alias(c), F.col("id").alias(f"{c}_id"))
    j = games.join(side("white"), [*keys, "white"], "left").join(side("black"), [*keys, "black"], "left")
    valid = F.col("white_id").isNotNull() & F.col("black_id").isNotNull() & (F.col("white_id") != F.col("black_id"))
    return people, j.select(*games.columns, F.when(valid, F.col("white_id")).alias("white_id"), F.when(valid, F.col("black_id")).alias("black_id"))


def _date(name: str, date: Column) -> Column:
    part = lambda k: F.when(date[k].isNotNull(), F.concat(F.lit(f' {k}="'), date[k].cast("string"), F.lit('"')))
    return F.concat(F.lit(f"<ctml:{name}"), F.concat_ws("", part("y"), part("m"), part("d")), F.lit(' precision="'), dates.precision(date), F.lit('"/>'))


def rated_documents(tournaments: DataFrame, results: DataFrame, locations: DataFrame, event_refs: DataFrame) -> DataFrame:
    """tournament_id and xml of the tournaments that have a start date.

    tournaments: tournament_id, page_title, name, place_id, start_date_raw, end_date_raw, notes, source_url, source_path; results: tournament_id,
    row_index, row_kind (score rows count), player_id, player_name, edo, score, games, dev, class, note; locations: location_id, name, heading;
    event_refs: key, ref. The results of one tournament are its field of players, so they fit one row."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) == ""
    number = F.regexp_extract(F.coalesce("player_id", F.lit("")), r"^p(\d+)$", 1)
    synthetic = F.concat(F.lit("player:syn:"), text.sha1_hex16(F.concat(F.lower(F.trim(F.coalesce("player_name", F.lit("")))), F.lit("|"))))
    note = F.concat_ws("; ", *[F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{c}="), F.col(c).cast("string"))) for c in ("games", "dev", "class")], F.when(~blank("note"), F.col("note")))
    r = results.filter("row_kind = 'score'").withColumns({"ref": F.when(number != "", F.concat(F.lit("player:edo:"), number)).otherwise(synthetic), "made": number == "", "remark": note})
    fields = ("row_index", "player_id", "player_name", "edo", "score", "ref", "made", "remark")
    people = r.groupBy("tournament_id").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("people"))
    t = tournaments.withColumn("start", dates.parse_day_month_year(F.col("start_date_raw"))).filter("start is not null")
    t = t.withColumn("end", F.coalesce(dates.parse_day_month_year(F.col("end_date_raw")), "start"))
    place = locations.select(F.col("location_id").alias("place_id"), parse_location(F.col("name"), F.col("heading")).alias("place"))
    t = t.join(people, "tournament_id", "left").join(place, "place_id", "left").join(event_refs.select(F.col("key").alias("tournament_id"), F.col("ref").alias("event_ref")), "tournament_id", "left")
    first = lambda *c: F.coalesce(*[F.nullif(F.col(x), F.lit("")) for x in c])
    shown = first("page_title", "name", "tournament_id")

    def participant(p: Column, i: Column) -> Column:
        own_id = F.regexp_replace(F.coalesce(p["player_id"], F.lit("")), "^p", "")
        return lines(
            F.format_string('    <ctml:participant id="p%04d">', i + 1), F.concat(F.lit('      <ctml:playerRef ref="'), text.esc(p["ref"]), F.lit(f'" source="{SOURCE}">')), person_element(p["player_name"]),
            F.when(own_id != "", lines("        <ctml:ids>", F.concat(F.lit("          <ctml:internalId>edo:"), text.esc(own_id), F.lit("</ctml:internalId>")), "        </ctml:ids>")),
            F.when(p["made"], '        <ctml:resolution method="unresolved" resolver="castellan"/>'), "      </ctml:playerRef>",
            F.when(p["edo"].isNotNull(), lines('      <ctml:ratingSnapshot system="edo" scope="standard">', tag(8, "value", p["edo"].cast("int").cast("string")), F.concat(F.lit("        "), _date("asOf", F.col("start"))), "      </ctml:ratingSnapshot>")),
            tag(6, "score", text.format_g(p["score"].cast("double"))), tag(6, "notes", p["remark"]), "    </ctml:participant>")

    remarks = F.concat_ws(" ", F.when(~blank("name") & ~F.col("name").eqNullSafe(F.col("page_title")), F.concat(F.lit("Edo event name: "), "name")), F.when(~blank("notes"), F.col("notes")))
    reference = F.when(F.col("event_ref").isNotNull(), lines(F.concat(F.lit('    <ctml:eventRef ref="'), text.esc(F.col("event_ref")), F.lit('">')), tag(6, "name", shown), "    </ctml:eventRef>"))
    city = F.col("place.city")
    where = F.when(city != "", lines(F.concat(F.lit('    <ctml:placeRef ref="'), city_ref(city, F.col("place.country")), F.lit('" kind="city">')), tag(6, "name", city), "    </ctml:placeRef>"))
    origin = F.concat(F.lit("tournament_id="), F.col("tournament_id"), F.lit("; source_path="), F.coalesce("source_path", F.lit("")))
    listed = F.nullif(F.array_join(F.transform(F.coalesce("people", F.array().cast(people.schema["people"].dataType)), participant), "\n"), F.lit(""))
    xml = lines(
        '<?xml version="1.0" encoding="UTF-8"?>', F.concat(F.lit('<ctml:tournament xmlns:ctml="urn:ctml:1.0" ctmlVersion="1.3" id="t_edo_'), text.esc(F.col("tournament_id")), F.lit('">')), "  <ctml:header>", tag(4, "name", shown), reference,
        "    <ctml:dates>", F.concat(F.lit("      "), _date("start", F.col("start"))), F.concat(F.lit("      "), _date("end", F.col("end"))), "    </ctml:dates>", where, "  </ctml:header>", "  <ctml:participants>", listed, "  </ctml:participants>",
        tag(2, "notes", remarks), '  <ctml:source kind="edo">', tag(4, "uri", F.col("source_url")), tag(4, "note", origin), "  </ctml:source>", "</ctml:tournament>", "")
    return t.select("tournament_id", xml.alias("xml"))
