"""Tournament documents made of games: runs of games by event and site, participants by first appearance, references resolved or made.

A document is a table of parts (header, one part a participant, one a game, footer) with their order, so an event of any number of games is dealt over many tasks until
somebody wants it as one text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from castellan.functions import dates, text, vocabulary
from castellan.operators.documents import NAMESPACE, attribute, date_element, lines, person_element, tag
from castellan.operators.rated import game_participants
from castellan.operators.resolution import resolve_events, resolve_players
from castellan.operators.sessions import gap_sessions

GROUP = ["event_slug", "site_slug", "session"]
UNDATED = "Source PGN had no parseable date for any game in this group; 1970-01-01 is a placeholder, not a real date."
SCHEME = "zobrist-polyglot-1"


def game_fragment(white_id: Column, black_id: Column, source: Column, indent: int = 4, ply_count: bool = True) -> Column:
    """A game (columns round, result, eco, start_fen, ucis, termination, trajectory_fp, final_position_fp, null where there is none) as an element: its round, players by their ids and
    result as attributes; opening, start position, moves, termination, fingerprints and source under it, in this order."""
    pad = " " * indent
    moves = F.array_join(F.transform("ucis", lambda u, i: F.concat(F.lit(f'{pad}    <ctml:move ply="'), (i + 1).cast("string"), F.lit('" value="'), u, F.lit('"/>'))), "\n")
    plies = F.concat(F.lit(' plyCount="'), F.size("ucis").cast("string"), F.lit('"')) if ply_count else F.lit("")
    prints = [F.concat(F.lit(f'{pad}    <ctml:fingerprint scheme="{SCHEME}" scope="{scope}" value="'), F.coalesce(c, F.lit("")), F.lit('"/>')) for scope, c in (("trajectory", "trajectory_fp"), ("finalPosition", "final_position_fp"))]
    start = F.concat(F.lit(f'{pad}  <ctml:start standard="false"><ctml:fen>'), text.esc(F.col("start_fen")), F.lit("</ctml:fen></ctml:start>"))
    return lines(
        F.concat(F.lit(f"{pad}<ctml:game"), attribute("round", F.coalesce("round", F.lit("?"))), attribute("white", white_id), attribute("black", black_id), attribute("result", vocabulary.game_result(F.coalesce("result", F.lit("*")))), F.lit(">")),
        tag(indent + 2, "eco", F.col("eco")), start, F.when(F.size("ucis") > 0, lines(F.concat(F.lit(f'{pad}  <ctml:moves notation="uci"'), plies, F.lit(">")), moves, f"{pad}  </ctml:moves>")), tag(indent + 2, "termination", F.col("termination")),
        f"{pad}  <ctml:fingerprints>", *prints, f"{pad}  </ctml:fingerprints>", F.concat(F.lit(f"{pad}  <ctml:source"), attribute("kind", source), F.lit("/>")), f"{pad}</ctml:game>")


def grouped_games(games: DataFrame, order: str, max_gap: int = 21) -> tuple[DataFrame, DataFrame]:
    """The games with the group they belong to (GROUP) and their place in it (at), and one row a group: event, site, start and end (partial dates), undated.

    games: event, site, date (partial), white, black and the columns of game_fragment; order: a number that tells which came first."""
    blank = lambda c: F.coalesce(text.normalize_space(F.col(c)), F.lit(""))
    g = games.withColumns({"event": blank("event"), "site": blank("site"), "white": blank("white"), "black": blank("black"), "day": dates.approximate(F.col("date"))})
    g = g.withColumns({"day": F.when(F.col("date.y").isNotNull(), F.col("day")), "event_slug": text.slug(F.col("event")), "site_slug": text.slug(F.col("site"))})
    g = gap_sessions(g, GROUP[:2], "day", order, max_gap).withColumn("at", F.struct(F.col("day").isNull().alias("undated"), "day", F.col(order).alias("nth")))
    dated = lambda by: F.when(F.col("day").isNotNull(), by)
    heads = g.groupBy(*GROUP).agg(
        F.min_by("event", "at").alias("event"), F.min_by("site", "at").alias("site"), F.min_by("date", dated(F.struct("day", order))).alias("start"), F.max_by("date", dated(F.struct("day", -F.col(order)))).alias("end"))
    epoch = F.struct(*[F.lit(v).cast("int").alias(k) for k, v in (("y", 1970), ("m", 1), ("d", 1))])
    return g.drop("day"), heads.withColumns({"undated": F.isnull("start"), "start": F.coalesce("start", epoch), "end": F.coalesce("end", epoch)})


def document_parts(games: DataFrame, order: str, players: DataFrame, occurrences: DataFrame, places: DataFrame, source: str, max_gap: int = 21) -> tuple[DataFrame, DataFrame]:
    """Parts (GROUP, section, at, part) and documents (GROUP, id, event_ref, event_resolved) of games.

    players and occurrences: see resolution; places: site and ref, one for each site that is known. A game between a player and themselves, or without one of the names, is left out."""
    g, heads = grouped_games(games, order, max_gap)
    span = heads.withColumns({"from_day": dates.approximate(F.col("start")), "to_day": dates.approximate(F.col("end"))})
    span = resolve_events(span, occurrences, "event", "from_day", "to_day").join(places.select(F.col("site").alias("_site"), F.col("ref").alias("place_ref")), F.col("site") == F.col("_site"), "left")
    made = F.concat(F.lit("event:"), dates.compact(F.col("start")), F.lit("-"), dates.compact(F.col("end")), F.lit("-"), text.slug(F.col("event")))
    span = span.withColumns({"event_resolved": F.col("event_ref").isNotNull(), "event_ref": F.coalesce(F.col("event_ref").cast("string"), made), "place_ref": F.coalesce("place_ref", F.concat(F.lit("place:raw:"), text.sha1_hex16(F.lower(F.trim("site")))))})
    span = span.withColumn("id", F.concat(F.lit("t_"), text.slug(F.col("event")), F.lit("_"), dates.compact(F.col("start"))))
    named = lambda tag_name, ref, name: F.concat(F.lit(f"    <ctml:{tag_name}"), attribute("ref", ref), F.lit("><ctml:name>"), text.esc(name), F.lit(f"</ctml:name></ctml:{tag_name}>"))
    head = lines(
        '<?xml version="1.0" encoding="UTF-8"?>', F.concat(F.lit(f'<ctml:tournament xmlns:ctml="{NAMESPACE}" ctmlVersion="2.0"'), attribute("id", F.col("id")), F.lit(">")), "  <ctml:header>",
        F.concat(F.lit("    <ctml:name>"), text.esc(F.col("event")), F.lit("</ctml:name>")), named("eventRef", F.col("event_ref"), F.col("event")),
        "    <ctml:dates>", F.concat(F.lit("      "), date_element("start", F.col("start"))), F.concat(F.lit("      "), date_element("end", F.col("end"))), "    </ctml:dates>",
        F.when(F.col("site") != "", named("placeRef", F.col("place_ref"), F.col("site"))), "  </ctml:header>", "  <ctml:participants>")
    foot = lines("  </ctml:games>", F.when(F.col("undated"), f"  <ctml:notes>{UNDATED}</ctml:notes>"), F.concat(F.lit("  <ctml:source"), attribute("kind", F.lit(source)), F.lit("/>")), "</ctml:tournament>", "")
    people, paired = game_participants(g, GROUP, "at")
    people = resolve_players(people, players)
    person = lines(
        F.concat(F.lit('    <ctml:participant id="'), F.col("id"), F.lit('">')), F.concat(F.lit("      <ctml:playerRef"), attribute("ref", F.col("player_ref")), F.lit(">")), person_element(F.col("name"), 8, False),
        F.concat(F.lit('        <ctml:resolution method="'), F.col("method"), F.lit('"/>')), "      </ctml:playerRef>", "    </ctml:participant>")
    none = F.lit(None).cast(g.schema["at"].dataType)
    part = lambda df, section, at, number, value: df.select(*GROUP, F.lit(section).alias("section"), at.alias("at"), number.alias("number"), value.alias("part"))
    parts = part(span, 0, none, F.lit(""), head).unionByName(part(people, 1, none, F.col("id"), person)).unionByName(part(span, 2, none, F.lit(""), F.lit("  </ctml:participants>\n  <ctml:games>")))
    played = paired.filter("white_id is not null and black_id is not null")
    parts = parts.unionByName(part(played, 3, F.col("at"), F.lit(""), game_fragment(F.col("white_id"), F.col("black_id"), F.lit(source), 4, False))).unionByName(part(span, 4, none, F.lit(""), foot))
    return parts, span.select(*GROUP, "id", "event_ref", "event_resolved")


def whole_documents(parts: DataFrame, documents: DataFrame) -> DataFrame:
    """documents with xml: the parts of each put together in one text."""
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("section", "at", F.length("number").alias("digits"), "number", "part"))), lambda x: x["part"]), "\n")
    return documents.join(parts.groupBy(*GROUP).agg(joined.alias("xml")), GROUP)
