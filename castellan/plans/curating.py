"""Queries of the curation operators: registries compared, records clustered, exports screened, entries validated, corpora merged.

The tables stand in for the sources: customers for players and names, orders for records and games, order lines for rows of sheets and ratings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from castellan.operators import checks, clustering, places, players, registries, screening
from castellan.sinks.files import write_each
from castellan.sinks.registries import place_shards
from castellan.sources import facts, lines, registry
from castellan.sources.games import merge_games
from castellan.workspace import new_path

SUITE: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]] = {}


def query(sql: str):
    def register(f):
        SUITE[f.__name__] = (f, sql)
        return f

    return register


def rows(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").selectExpr(*(columns or ["*"]))


SAYS = {"family": "k % 7 = 0", "given": "k % 8 = 0", "federation": "k % 11 = 0", "title": "k % 9 = 0", "female": "k % 12 = 1", "suffix": "k % 14 = 1", "birth_year": "k % 16 = 1", "current_rating": "k % 17 = 0", "aliases": "k % 13 = 0", "peak": "k % 19 = 0", "history": "k % 23 = 0"}


@query("WITH c AS (SELECT c_custkey AS k FROM customer) SELECT CAST(k AS VARCHAR) AS fide_id, CASE WHEN k % 5 = 0 THEN 'lines' ELSE 'both' END AS side, "
       + ", ".join(f"CASE WHEN k % 5 > 0 THEN {w} END AS differs_{f}" for f, w in SAYS.items())
       + " FROM c UNION ALL SELECT 'S' || s_suppkey, 'registry', " + ", ".join("NULL" for _ in SAYS) + " FROM supplier")
def player_comparison(spark, sf_dir):
    alias = "named_struct('family', '{0}', 'given', array(c_name), 'suffix', cast(null as string))"
    a, b = alias.format("A"), alias.format("B")
    grid = "array(named_struct('year', 2001, 'months', concat(array({0}), array_repeat(cast(null as int), 10), array(cast(1500 + k % 3 as int)))))"
    own, other = grid.format("cast(1000 + k % 100 as int)"), grid.format("if(k % 23 = 0, cast(null as int), cast(1000 + k % 100 as int))")
    c = rows(spark, sf_dir, "customer", "*", "c_custkey as k")
    left = c.selectExpr("cast(k as string) as fide_id", "c_mktsegment as family", "array(c_name) as given", "cast(null as string) as suffix", "'N' || c_nationkey as federation", "array('GM') as titles", "k % 2 = 0 as female", "1900 + c_nationkey as birth_year", f"array({a}, {b}) as aliases", f"{own} as grid")
    right = c.filter("k % 5 > 0").selectExpr(
        "cast(k as string) as fide_id", "if(k % 7 = 0, 'X', c_mktsegment) as family", "if(k % 8 = 0, array('Y'), array(c_name)) as given", "if(k % 14 = 1, 'Jr', cast(null as string)) as suffix", "if(k % 11 = 0, null, 'N' || c_nationkey) as federation",
        "if(k % 9 = 0, array('IM'), array('GM')) as titles", "(k % 2 = 0) <> (k % 12 = 1) as female", "if(k % 16 = 1, null, 1900 + c_nationkey) as birth_year", f"if(k % 13 = 0, array({a}), array({b}, {a})) as aliases", f"{other} as grid",
        "cast(1500 + k % 3 + if(k % 17 = 0, 1, 0) as int) as current_rating", "cast(1500 + k % 3 as int) as peak", "2001 as peak_year", "if(k % 19 = 0, 11, 12) as peak_month")
    more = rows(spark, sf_dir, "supplier", "'S' || s_suppkey as fide_id")
    return players.compare_players(left, right.unionByName(more, allowMissingColumns=True))


SOURCES = ("chess-results", "twic", "edo", "nwchess-minev", "olimpbase", "other")


@query("""WITH f AS (SELECT o_orderkey AS idx, o_custkey AS ref, year(o_orderdate) AS y, o_orderpriority AS name, [100, 90, 80, 70, 60, 0][1 + o_orderkey % 6] AS trust, o_orderkey % 4 AS n FROM orders),
    c AS (SELECT ref, min(idx) AS cluster, count(*) AS size, arg_min(y, idx) AS y, arg_min(name, idx) AS name, arg_max(idx, (trust, n, least(n, idx % 3), least(n, idx % 2), -idx)) AS best FROM f GROUP BY 1),
    i AS (SELECT *, 'cluster-' || lpad(CAST(row_number() OVER (ORDER BY size DESC, y, name, cluster) AS VARCHAR), 6, '0') AS cluster_id FROM c)
    SELECT idx, cluster, cluster_id, size, best FROM f JOIN i USING (ref)""")
def fact_groups(spark, sf_dir):
    source = f"element_at(array({', '.join(map(repr, SOURCES))}), cast(1 + o_orderkey % 6 as int))"
    person = "transform(sequence(1, cast(o_orderkey % 4 as int)), i -> named_struct('ref', '', 'name', 'P' || i, 'fide_id', if(i <= o_orderkey % 3, '123456', ''), 'rating', if(i <= o_orderkey % 2, 2000, null)))"
    f = rows(spark, sf_dir, "orders", "o_orderkey as idx", "'e' || o_custkey as event_ref", "year(o_orderdate) as year", "month(o_orderdate) as month", "o_orderpriority as name", "lower(o_orderpriority) as key", "cast(array() as array<string>) as roster",
             f"{source} as source", f"if(o_orderkey % 4 = 0, slice({person}, 1, 0), {person}) as participants")
    member = clustering.clusters(f, clustering.linked_facts(f))
    return member.join(clustering.best_facts(f, member).withColumnRenamed("idx", "best"), "cluster").select("idx", "cluster", "cluster_id", "size", "best")


@query("""SELECT 'line' AS kind, sum(6 + CAST(k % 2 = 0 AS INT) + 2 * CAST(k % 3 = 0 AS INT) + 3 * CAST(k % 5 = 0 AS INT) + 2 * CAST(k % 7 = 0 AS INT)) AS n FROM (SELECT c_custkey AS k FROM customer) UNION ALL SELECT unnest(['record', 'alias', 'comment']), count(*) FROM customer
    UNION ALL SELECT 'elo', count(*) FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT 'fide_id', count(*) FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT 'event_rule', 2 * count(*) FROM customer WHERE c_custkey % 5 = 0""")
def line_counts(spark, sf_dir):
    """Customers written as sections of lines, counted from the files."""
    path = new_path(spark, "sections")
    k = "c_custkey % "
    rows(spark, sf_dir, "customer", f"concat_ws('\\n', '@PLAYER .', c_name, '  = alias', if({k}2 = 0, '\\t%Elo 2001:1', null), if({k}3 = 0, '  %Bio FIDE 1\\n  %Bio Edo 2', null), '# c', '  # no comment', '', if({k}5 = 0, '@EVENT x\\nOpen\\n  = O', null), if({k}7 = 0, '@WHAT\\nz', null)) as value").write.text(path)
    return lines.section_counts(spark, path)


@query("SELECT p_brand AS eco, p_name AS name, '1. ' || p_type AS pgn, 'u' || p_size AS uci, 'e ' || p_partkey AS epd FROM part")
def openings_file(spark, sf_dir):
    path = new_path(spark, "openings")
    rows(spark, sf_dir, "part", "p_brand as eco", "p_name as name", "'1. ' || p_type as pgn", "'u' || p_size as uci", "'e ' || p_partkey as epd").write.option("sep", "\t").option("header", True).csv(path)
    return registry.read_openings(spark, path)


#: About how many order lines lie in one file of crosstables.
LINES_A_FILE = 32768


@query("""SELECT 'E ' || l_orderkey AS name, 'r' || l_orderkey AS tid, 'src' AS source, CAST(strftime(min(l_shipdate), '%Y%m%d') AS INT) AS day, count(*) AS people, sum(CAST(l_quantity AS BIGINT)) AS ratings, count(*) FILTER (l_suppkey % 2 = 0) AS known
    FROM lineitem GROUP BY l_orderkey HAVING l_orderkey % 10 > 0""")
def crosstable_files(spark, sf_dir):
    """Orders written as arrays of crosstables, read as facts: those without a start and players without a name are left out.

    A reader takes in a file whole, so there are more files, not longer ones, where there are more lines. Each is written a crosstable at a time."""
    player = "named_struct('rank', cast(l_linenumber as bigint), 'name', ' P  ' || l_suppkey, 'fed', 'USA', 'title', '', 'rating', cast(l_quantity as bigint), 'score', cast(1.5 as double), 'fide_id', if(l_suppkey % 2 = 0, cast(10000 + l_suppkey as string), ''), 'ref', '')"
    li = rows(spark, sf_dir, "lineitem", "l_orderkey", "l_shipdate", f"{player} as p")
    t = li.groupBy("l_orderkey").agg(F.collect_list("p").alias("players"), F.min("l_shipdate").cast("date").cast("string").alias("start"))
    nameless = "if(l_orderkey % 3 = 0, concat(players, transform(slice(players, 1, 1), p -> named_struct('rank', p.rank, 'name', '  ', 'fed', p.fed, 'title', p.title, 'rating', p.rating, 'score', p.score, 'fide_id', p.fide_id, 'ref', p.ref))), players)"
    parts = max(16, rows(spark, sf_dir, "lineitem").count() // LINES_A_FILE)
    t = t.selectExpr(f"pmod(xxhash64(l_orderkey), {parts}) as part", "l_orderkey", f"to_json(named_struct('event', 'E ' || l_orderkey, 'format', 'swiss', 'source', 'src', 'ref', 'r' || l_orderkey, 'start', if(l_orderkey % 10 = 0, '', start), 'players', {nameless})) as j")
    path = new_path(spark, "crosstables")
    within = Window.partitionBy("part").orderBy("l_orderkey")
    t = t.withColumns({"n": F.row_number().over(within), "last": F.lead(F.lit(False), 1, True).over(within)})
    array = t.sortWithinPartitions("part", "n").selectExpr("part", "if(n = 1, '[', ',') || j || if(last, ']', '') as value")
    array.write.partitionBy("part").text(path)
    f = facts.crosstable_facts(spark, f"{path}/*/*.txt")
    day = F.col("start.y") * 10000 + F.col("start.m") * 100 + F.col("start.d")
    return f.select("name", "tid", "source", day.alias("day"), F.size("participants").cast("bigint").alias("people"), F.aggregate("participants", F.lit(0).cast("bigint"), lambda a, p: a + p["rating"]).alias("ratings"), F.size(F.filter("participants", lambda p: p["ref"].startswith("player:fide:"))).cast("bigint").alias("known"))


@query("""SELECT 'f' || l_orderkey AS file, CAST(3 + l_linenumber AS INT) AS row, CAST(CASE WHEN l_orderkey % 3 = 0 THEN CASE WHEN l_suppkey % 5 > 0 THEN 1000 + l_partkey % 2000 ELSE 0 END ELSE greatest(1000 + l_partkey % 2000, 900 + l_suppkey % 100) END AS INT) AS rating
    FROM lineitem WHERE l_orderkey % 3 < 2 AND l_linenumber < 7""")
def screened_sheets(spark, sf_dir):
    """Order lines as rows of sheets of three kinds of heading, one of them without ratings; lines of number 7 are no players."""
    text = "if(l_suppkey % 5 > 0, 'Elo ' || (1000 + l_partkey % 2000) || '*', '-')"
    cells = f"if(l_orderkey % 3 = 1, array(n, name, cast(1000 + l_partkey % 2000 as string), ' ' || (900 + l_suppkey % 100)), array(n, name, '', {text}))"
    li = rows(spark, sf_dir, "lineitem", "*", "if(l_linenumber = 7, '', l_linenumber || '.') as n", "if(l_linenumber = 7, 'Last update 1.1.', 'P' || l_suppkey) as name").selectExpr("'f' || l_orderkey as file", "cast(3 + l_linenumber as int) as row", f"{cells} as cells")
    heads = rows(spark, sf_dir, "lineitem", "l_orderkey").distinct().selectExpr("'f' || l_orderkey as file", "explode(array(struct(1 as row, array('A list') as cells), struct(2 as row, element_at(array(array('No.', ' Name', '', 'RTG'), array('Rank', 'Spieler', 'FIDE  Rtg', 'Elo'), array('No.', 'Name', 'Fed', 'Club')), cast(1 + l_orderkey % 3 as int)) as cells))) as h").select("file", "h.*")
    return screening.starting_ranks(heads.unionByName(li))


@query("""WITH m AS (SELECT l_suppkey AS key, l_orderkey % 5 AS line, year(l_shipdate) AS year, month(l_shipdate) AS month, CAST(max(l_quantity) AS INT) AS rating FROM lineitem GROUP BY 1, 2, 3, 4), p AS (SELECT key, line, count(*) AS points FROM m GROUP BY 1, 2)
    SELECT key, year, month, arg_min(rating, (points, line)) AS rating FROM m JOIN p USING (key, line) GROUP BY 1, 2, 3""")
def rating_month_merge(spark, sf_dir):
    m = rows(spark, sf_dir, "lineitem", "l_suppkey as key", "l_orderkey % 5 as line", "year(l_shipdate) as year", "month(l_shipdate) as month", "cast(l_quantity as int) as rating").groupBy("key", "line", "year", "month").agg(F.max("rating").alias("rating"))
    return registries.merge_rating_months(m, "key")


@query("""WITH c AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 6 > 0 THEN CAST(c_custkey % 500 + 1000 AS VARCHAR) ELSE 'k' || c_custkey END AS key, CASE WHEN c_custkey % 4 > 0 THEN 'N' || c_nationkey ELSE '' END AS fed, CAST(c_custkey % 2 > 0 AS INT) + CAST(c_custkey % 3 > 0 AS INT) AS points FROM customer),
    g AS (SELECT key, 'P ' || min(k) AS name, coalesce(arg_max(fed, (points, -k)) FILTER (fed <> ''), '') AS federation, bool_or(k % 3 = 1) AS female, arg_min(1900 + k % 80, k) FILTER (k % 5 > 0) AS birth_year, arg_min(1000 + k % 100, (points, k)) FILTER (k % 2 > 0) AS jan, arg_min(1100 + k % 50, (points, k)) FILTER (k % 3 > 0) AS feb FROM c GROUP BY 1),
    a AS (SELECT key, alias, min(pos) AS pos FROM (SELECT key, 'P ' || k AS alias, k * 10 AS pos FROM c UNION ALL SELECT key, 'P ' || (k + 500), k * 10 + 1 FROM c UNION ALL SELECT key, 'A' || (k % 9), k * 10 + 2 FROM c) GROUP BY 1, 2),
    i AS (SELECT key, string_agg(id, '+' ORDER BY pos) AS ids FROM (SELECT key, 'edo:' || (k % 7) AS id, min(k) AS pos FROM c GROUP BY 1, 2) GROUP BY 1), t AS (SELECT key, string_agg(title, '+' ORDER BY pos) AS titles FROM (SELECT key, CASE k % 3 WHEN 0 THEN 'GM' WHEN 1 THEN 'WIM' END AS title, min(k) AS pos FROM c WHERE k % 3 < 2 GROUP BY 1, 2) GROUP BY 1)
    SELECT CASE WHEN key NOT LIKE 'k%' THEN 'player:fide:' || key ELSE 'player:syn:' || substr(sha1(lower(name) || '|' || federation), 1, 16) END AS ref, name, federation, coalesce(titles, '') AS titles, female, birth_year, ids, coalesce(feb, jan) AS current_rating, greatest(jan, feb) AS peak,
      CASE WHEN feb IS NULL OR jan >= feb THEN 1 ELSE 2 END AS peak_month, (SELECT string_agg(alias, '+' ORDER BY pos) FROM a WHERE a.key = g.key AND alias <> name) AS aliases FROM g LEFT JOIN i USING (key) LEFT JOIN t USING (key) WHERE jan IS NOT NULL OR feb IS NOT NULL""")
def player_records(spark, sf_dir):
    """Customers as player blocks, several of one id, merged to whole records; those without any rating are not shown."""
    k = "c_custkey % "
    b = rows(spark, sf_dir, "customer", "'f' as file", "c_custkey as line_no", f"{k}8 = 9 as malformed", "'P ' || c_custkey as name", f"element_at(array('GM', 'WIM', '-'), cast(1 + {k}3 as int)) as title_token", f"if({k}4 > 0, 'N' || c_nationkey, null) as federation", f"if({k}5 > 0, cast(1900 + {k}80 as int), null) as birth_year",
             f"if({k}6 > 0, cast({k}500 + 1000 as string), null) as fide_id", f"array(named_struct('source', 'edo', 'id', cast({k}7 as string))) as ids", f"map(2000, array(if({k}2 > 0, cast(1000 + {k}100 as string), '?'), if({k}3 > 0, cast(1100 + {k}50 as string), '?'), '?')) as elo", f"array('P ' || (c_custkey + 500), 'A' || ({k}9)) as aliases")
    r = registries.player_records(b).filter("current_rating is not null")
    listed = lambda c: F.array_join(c, "+").alias(c)
    ids = F.array_join(F.transform("ids", lambda i: F.concat_ws(":", i["source"], i["id"])), "+").alias("ids")
    return r.select("ref", "name", "federation", listed("titles"), "female", "birth_year", ids, "current_rating", "peak", "peak_month", listed("aliases"))


@query("""SELECT 'place:' || kind || ':' || iso3 || '-' || c_custkey AS ref, kind, 'C' || (c_custkey % 50) AS name, iso3 AS country, CASE WHEN c_custkey % 40 < 25 THEN 'place:admin1:S-' || (c_custkey % 40) ELSE 'place:country:' || iso3 END AS parent_ref
    FROM (SELECT *, CASE WHEN c_custkey % 4 = 3 THEN 'admin2' ELSE 'city' END AS kind FROM customer WHERE c_custkey % 9 > 0 AND c_custkey % 4 <> 2) JOIN (SELECT n_nationkey, upper(substr(n_name, 1, 3)) || n_nationkey AS iso3 FROM nation) ON n_nationkey = c_nationkey""")
def city_places(spark, sf_dir):
    cities = rows(spark, sf_dir, "customer", "c_custkey as id", "'C' || (c_custkey % 50) as name", "element_at(array(null, 'city', 'adm1', 'adm2'), cast(1 + c_custkey % 4 as int)) as type", "if(c_custkey % 9 > 0, c_nationkey, 999) as country_id", "cast(c_custkey % 40 as int) as state_id")
    n = rows(spark, sf_dir, "nation")
    return registries.place_rows(cities, n.selectExpr("n_nationkey as id", "'S-' || n_nationkey as code"), n.selectExpr("n_nationkey as id", "upper(substr(n_name, 1, 3)) || n_nationkey as iso3"))


@query("""WITH n AS (SELECT n_nationkey, n_name, 'X' || n_nationkey AS code FROM nation), p AS (SELECT 'p' || c_custkey AS ref, 'town' || (c_custkey % 300) AS key, CASE WHEN c_custkey % 3 = 0 THEN 'X' || c_nationkey WHEN c_custkey % 5 = 0 THEN 'X' || c_nationkey ELSE '' END AS country FROM customer),
    u AS (SELECT key, max(country) AS code FROM p WHERE country <> '' GROUP BY 1 HAVING count(DISTINCT country) = 1)
    SELECT ref, CASE WHEN country = '' THEN coalesce(code, '') ELSE country END AS country FROM p LEFT JOIN u USING (key) UNION ALL SELECT 'c' || n_nationkey, code FROM n""")
def inferred_countries(spark, sf_dir):
    n = rows(spark, sf_dir, "nation", "'c' || n_nationkey as ref", "n_name as name", "'X' || n_nationkey as country", "'country' as kind", "cast(array() as array<string>) as aliases")
    c = rows(spark, sf_dir, "customer", "*").join(rows(spark, sf_dir, "nation", "n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
    c = c.selectExpr("'p' || c_custkey as ref", "'Town ' || (c_custkey % 300) as name", "if(c_custkey % 3 = 0, 'X' || c_nationkey, '') as country", "'city' as kind", "if(c_custkey % 5 = 0, array('Old Town,  ' || lower(n_name)), array('Town, Nowhere')) as aliases")
    return places.infer_countries(n.unionByName(c)).select("ref", "country")


@query("""WITH e AS (SELECT 'S' || (c_custkey % 3) AS section, c_custkey AS line, 'n' || (c_custkey % 700) AS ck, NULL AS ak FROM customer UNION ALL SELECT 'S' || (c_custkey % 3), c_custkey + 1000000, 'n' || (c_custkey % 800), CASE WHEN c_custkey % 10 = 0 THEN 'n' || (c_custkey % 700) ELSE 'a' || (c_custkey % 600) END FROM customer),
    h AS (SELECT DISTINCT section, ck FROM e WHERE ak IS NULL), a AS (SELECT * FROM e WHERE ak IS NOT NULL)
    SELECT section, min(line) AS line, 'duplicate canonical' AS problem FROM e WHERE ak IS NULL GROUP BY section, ck HAVING count(*) > 1 UNION ALL SELECT section, min(line), 'alias of several' FROM a GROUP BY section, ak HAVING count(DISTINCT ck) > 1
    UNION ALL SELECT section, line, 'alias without canonical' FROM a ANTI JOIN h USING (section, ck) UNION ALL SELECT DISTINCT a.section, line, 'alias is a canonical' FROM a JOIN h ON a.section = h.section AND a.ak = h.ck AND h.ck <> a.ck""")
def section_validation(spark, sf_dir):
    c = rows(spark, sf_dir, "customer", "'S' || (c_custkey % 3) as section", "c_custkey as line", "'N' || (c_custkey % 700) as canonical", "cast(null as string) as alias")
    a = rows(spark, sf_dir, "customer", "'S' || (c_custkey % 3) as section", "c_custkey + 1000000 as line", "'n' || (c_custkey % 800) as canonical", "if(c_custkey % 10 = 0, 'N' || (c_custkey % 700), 'a' || (c_custkey % 600)) as alias")
    found = registries.section_problems(c.unionByName(a))
    # a doubled canonical line makes an alias that is one come twice
    return found.filter("problem <> 'alias is a canonical'").unionByName(found.filter("problem = 'alias is a canonical'").distinct())


@query("""WITH g AS (SELECT o_orderpriority AS event, o_custkey % 300 AS round, 't' || (o_orderkey % 9) AS fp FROM orders WHERE o_orderstatus = 'F'), n AS (SELECT DISTINCT o_orderpriority AS event, o_custkey % 400 AS round, 't' || (o_orderkey % 11) AS fp FROM orders)
    SELECT 'added' AS verdict, * FROM n ANTI JOIN g USING (event, round) UNION ALL SELECT 'diverging', * FROM (FROM n SEMI JOIN g USING (event, round)) ANTI JOIN g USING (event, round, fp)""")
def corpus_merge(spark, sf_dir):
    """Orders as games of a slot (priority and a number of the customer): the finished ones are the corpus."""
    game = ("o_orderpriority as event", "o_custkey % {0} as round", "'t' || (o_orderkey % {1}) as trajectory_fp")
    old = rows(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").selectExpr(*(g.format(300, 9) for g in game))
    added, diverging = merge_games(old, rows(spark, sf_dir, "orders", *(g.format(400, 11) for g in game)), ["event", "round"])
    both = added.selectExpr("'added' as verdict", "event", "round", "trajectory_fp as fp").unionByName(diverging.selectExpr("'diverging' as verdict", "event", "round", "trajectory_fp as fp"))
    return both


@query("""WITH RECURSIVE e AS (SELECT DISTINCT o_custkey AS s, (o_custkey * 7 + o_orderkey) % 1500 AS t FROM orders), r AS (SELECT CAST(x AS BIGINT) AS url, 0 AS depth FROM range(3) AS v(x) UNION SELECT t, depth + 1 FROM r JOIN e ON s = url WHERE depth < 3)
    SELECT CAST(url AS VARCHAR) AS url, min(depth) AS depth FROM r GROUP BY 1""")
def link_frontier(spark, sf_dir):
    links = rows(spark, sf_dir, "orders", "cast(o_custkey as string) as source", "cast((o_custkey * 7 + o_orderkey) % 1500 as string) as target")
    return registries.expand_frontier(links, spark.range(3).selectExpr("cast(id as string) as url"), 3)


@query("""WITH o AS (SELECT 'open ' || (o_custkey % 40) AS n, 'open-' || (o_custkey % 40) AS slug, o_orderkey, CAST(o_orderdate AS DATE) AS a, CASE WHEN o_orderkey % 7 = 0 THEN CAST(o_orderdate AS DATE) ELSE CAST(o_orderdate AS DATE) - CAST(o_orderkey % 5 AS INT) END AS b FROM orders WHERE o_orderkey % 11 > 0 AND o_orderkey % 13 > 0)
    SELECT 'event:' || strftime(least(a, b), '%Y%m%d') || '-' || strftime(greatest(a, b), '%Y%m%d') || '-' || slug AS ref, 'series:' || slug AS series, count(*) AS records, arg_min(CASE WHEN o_orderkey % 2 = 0 THEN upper(n) ELSE n END, o_orderkey) AS name FROM o GROUP BY 1, 2""")
def turned_occurrences(spark, sf_dir):
    """Orders as records whose end lies before their start: the days are swapped; unnamed and undated ones go, an absent end is the start."""
    day = "if(o_orderkey % 13 = 0, null, named_struct('y', year({0}), 'm', month({0}), 'd', day({0})))"
    end = f"if(o_orderkey % 7 = 0, null, {day.format('date_sub(o_orderdate, cast(o_orderkey % 5 as int))')})"
    r = rows(spark, sf_dir, "orders", "if(o_orderkey % 11 = 0, ' ? ', if(o_orderkey % 2 = 0, 'OPEN ', 'open ') || (o_custkey % 40)) as name", f"{day.format('o_orderdate')} as start", f"{end} as end", "'swiss' as format", "cast(o_orderkey as string) as source", "o_orderkey as ord")
    return registries.occurrences(r).select("ref", "series", F.size("sources").cast("bigint").alias("records"), "name")


@query("""WITH m AS (SELECT CASE WHEN o_orderkey % 4 = 2 THEN 'x' || o_custkey ELSE CAST(o_custkey AS VARCHAR) END AS k, o_orderkey FROM orders WHERE o_orderkey % 9 > 0)
    SELECT k AS key, min(o_orderkey) AS first, 'https://chess-results.com/tnr' || k || '.aspx?lan=1' AS list_url, 'https://chess-results.com/tnr' || k || '.aspx?lan=1&art=0' AS starting_rank_url, 'https://chess-results.com/tnr' || k || '.aspx?lan=1&art=4' AS crosstable_url FROM m WHERE k NOT LIKE 'x%' GROUP BY 1""")
def manifest_pages(spark, sf_dir):
    m = rows(spark, sf_dir, "orders", "if(o_orderkey % 9 = 0, null, if(o_orderkey % 4 = 2, 'x' || o_custkey, if(o_orderkey % 4 = 1, ' ' || o_custkey || ' ', cast(o_custkey as string)))) as key", "o_orderkey as first")
    return screening.manifest(m, F.col("key"), "first").withColumn("key", F.trim("key"))


@query("""SELECT 2 * count(*) FILTER (c_custkey % 4 > 0) AS markers, true AS has_players, '@EVENT,@SITE' AS generated, count(*) FILTER (c_custkey % 4 = 0) * 2 AS replacement_characters, false AS usable FROM customer""")
def base_inspection(spark, sf_dir):
    value = rows(spark, sf_dir, "customer", "explode(element_at(array(array('x~y~'), array('@PLAYER', ' @Site x'), array('@event', '@other'), array('@Player', '@x y')), cast(1 + c_custkey % 4 as int))) as value")
    value = value.select(F.replace("value", F.lit("~"), F.lit("�")).alias("value"))
    return checks.base_problems(value).withColumn("generated", F.array_join("generated", ","))


PLACES = """WITH n AS (SELECT n_nationkey, n_name, upper(substr(n_name, 1, 3)) || n_nationkey AS iso3 FROM nation), p AS (
      SELECT 'place:country:' || iso3 AS ref, 'country' AS kind, n_name AS name, iso3 AS country, NULL AS parent FROM n
      UNION ALL SELECT 'place:city:' || iso3 || '-' || c_custkey, 'city', c_name || ' & co', iso3, 'place:country:' || iso3 FROM customer JOIN n ON n_nationkey = c_nationkey) """


@query(PLACES + """SELECT CASE kind WHEN 'country' THEN 'places-countries' ELSE 'places-cities-' || country END AS file, count(*) AS records, count(parent) AS with_parent, count(*) AS counted, count(parent) AS parents_counted, min(ref) AS first, max(name) AS last FROM p GROUP BY 1""")
def place_registry_files(spark, sf_dir):
    """Nations and customers written as place registries by kind and country, read back as places and counted by their tags."""
    n = rows(spark, sf_dir, "nation", "n_nationkey", "n_name as name", "upper(substr(n_name, 1, 3)) || n_nationkey as country")
    c = rows(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_name || ' & co' as name").join(n.drop("name"), F.col("c_nationkey") == F.col("n_nationkey"))
    p = n.selectExpr("'place:country:' || country as ref", "'country' as kind", "name", "country", "cast(null as string) as parent").unionByName(c.selectExpr("'place:city:' || country || '-' || c_custkey as ref", "'city' as kind", "name", "country", "'place:country:' || country as parent"))
    p = p.withColumn("xml", places.place_element(F.col("ref"), F.col("kind"), F.col("name"), {"country": F.col("country"), "parentRef": F.col("parent")}))
    folder = new_path(spark, "places")
    write_each(place_shards(p), folder)
    file = lambda c: F.regexp_extract(c, r"([^/]*)\.xml$", 1).alias("file")
    back = registry.read_places(spark, f"{folder}/*.xml").select(F.when(F.col("kind") == "country", "places-countries").otherwise(F.concat(F.lit("places-cities-"), "country")).alias("file"), "ref", "name", "parentRef")
    back = back.groupBy("file").agg(F.count("*").alias("records"), F.count("parentRef").alias("with_parent"), F.min("ref").alias("first"), F.max("name").alias("last"))
    tags = registry.element_counts(spark, f"{folder}/*.xml", "place", "parentRef").select(file("file"), F.col("records").alias("counted"), F.col("sub_records").alias("parents_counted"))
    return back.join(tags, "file")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 4 > 0 AND o_orderkey % 5 > 0 AND o_orderkey % 3 = 0 AND o_orderkey % 9 > 0")
def dates_out_of_order(spark, sf_dir):
    """Orders with a start and an end: a third end early, by 1 to 8 days; a fourth of the starts is a month only, a fifth of the ends no day of the calendar."""
    day = "named_struct('y', year({0}), 'm', month({0}), 'd', {1})"
    start = day.format("o_orderdate", "if(o_orderkey % 4 = 0, cast(null as int), day(o_orderdate))")
    other = "date_add(o_orderdate, cast(if(o_orderkey % 3 = 0, -(o_orderkey % 9), o_orderkey % 9) as int))"
    end = day.format(other, f"if(o_orderkey % 5 = 0, 99, day({other}))")
    o = rows(spark, sf_dir, "orders", "o_orderkey", f"{start} as start", f"{end} as end")
    return checks.dates_out_of_order(o, F.col("start"), F.col("end")).select("o_orderkey")


@query("""WITH m AS (SELECT CAST(o_custkey AS VARCHAR) AS k, min(o_orderkey) AS first FROM orders WHERE o_orderkey % 4 <> 2 GROUP BY 1)
    SELECT 'https://chess-results.com/tnr' || k || '.aspx?lan=1' || v.q AS url, v.kind, first FROM m, (VALUES (0, ''), (1, '&art=0'), (2, '&art=4')) AS v(kind, q)""")
def seed_urls(spark, sf_dir):
    m = rows(spark, sf_dir, "orders", "if(o_orderkey % 4 = 2, 'x', if(o_orderkey % 4 = 1, ' ', '')) || o_custkey as key", "o_orderkey as first")
    return screening.seed_urls(m, "key", "first")
