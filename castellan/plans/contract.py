"""Registered queries over the driver's tables and the SQL each must agree with.

The tables hold no tournaments, so each operator runs on a stand-in: order lines are participants, events are games, customers are players."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from castellan.chess import hashing
from castellan.functions import dates, links, names, pages, paths, text, vocabulary
from castellan.operators import admission, checks, clustering, documents, merging, moves, places, positions, rated, registries, sessions
from castellan.plans import culling, curating, database, reading, resolving
from castellan.sources import tables
from castellan.sources.games import headers, replayed
from castellan.workspace import keep

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


RATING_SQL = "CASE WHEN l_linenumber <> 7 THEN CAST(l_quantity AS INT) END"


@query("floor_admission", f"""
    SELECT l_orderkey, count(*) AS n_rows, count(*) FILTER (r IS NULL) AS missing, count(*) FILTER (r < 10) AS below, min(r) AS least, max(r) AS most,
      CASE WHEN count(*) FILTER (r IS NULL) > 0 THEN 'missing ratings' WHEN count(*) FILTER (r < 10) > 0 THEN 'below floor' ELSE 'kept' END AS reason,
      count(*) FILTER (r IS NULL) = 0 AND count(*) FILTER (r < 10) = 0 AS keep
    FROM (SELECT l_orderkey, {RATING_SQL} AS r FROM lineitem) GROUP BY l_orderkey""")
def floor_admission(spark, sf_dir):
    return admission.floor_profile(table(spark, sf_dir, "lineitem").select("l_orderkey", F.expr(RATING_SQL).alias("r")), ["l_orderkey"], F.col("r"), 10)


@query("floor_variants", """
    WITH r AS (SELECT l_suppkey, CAST(l_quantity AS INT) - 5 AS q FROM lineitem), z AS (SELECT l_suppkey, greatest(q, 0) AS q FROM r),
    top AS (SELECT l_suppkey, avg(q) AS t FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY q DESC) AS n FROM z WHERE q > 0) WHERE n <= 10 GROUP BY 1)
    SELECT z.l_suppkey, count(*) AS total, count(*) FILTER (q > 0) AS rated, count(*) FILTER (q <= 0) AS unrated, min(q) AS min_all, min(q) FILTER (q > 0) AS min_rated, max(q) AS max_rating,
      round(avg(q), 6) AS avg_all, round(avg(q) FILTER (q > 0), 6) AS avg_rated, coalesce(median(q) FILTER (q > 0), 0.0) AS median_rated, count(*) FILTER (q >= 40) AS strong, count(*) FILTER (q < 3) AS below,
      coalesce(round(any_value(t), 6), 0.0) AS top_avg, count(*) FILTER (q < 3) = 0 AS strict_all_players, round(avg(q), 6) >= 21 AS by_avg_all, round(avg(q) FILTER (q > 0), 6) >= 23 AS by_avg_rated,
      coalesce(round(any_value(t), 6), 0.0) >= 44 AS by_top_avg, max(q) >= 45 AS by_max, count(*) FILTER (q >= 40) >= 6 AS by_strong
    FROM z LEFT JOIN top ON z.l_suppkey = top.l_suppkey GROUP BY z.l_suppkey""")
def floor_variants(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", F.greatest(F.col("l_quantity").cast("int") - 5, F.lit(0)).alias("q"))
    p = admission.rating_profile(rows, ["l_suppkey"], "q", 3, 40)
    for name, out, threshold in (("strict_all_players", "strict_all_players", 0), ("avg_all", "by_avg_all", 21), ("avg_rated", "by_avg_rated", 23), ("top_avg", "by_top_avg", 44), ("max_rating", "by_max", 45), ("strong_count", "by_strong", 6)):
        p = admission.gate(p, name, threshold).withColumnRenamed("passes", out)
    return p


@query("admission_min_per_key", """
    WITH m AS (SELECT o_custkey, o_orderpriority, min(CASE WHEN o_orderstatus <> 'P' THEN CAST(floor(o_totalprice) AS INT) END) AS lowest FROM orders GROUP BY 1, 2)
    SELECT o_custkey, count(*) AS members, count(*) FILTER (lowest IS NULL) AS unrated, min(lowest) AS lowest FROM m GROUP BY 1 HAVING count(*) FILTER (lowest IS NULL) = 0 AND min(lowest) >= 20000""")
def admission_min_per_key(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("r", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice").cast("int")))
    return admission.admitted_by_lowest(o, ["o_custkey"], ["o_orderpriority"], "r", 20000)


@query("source_summary", "SELECT source, lang, count(*) AS total, count(*) FILTER (n_chars >= 500) AS kept FROM documents GROUP BY 1, 2")
def source_summary(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("source", "lang").agg(F.count("*").alias("total"), F.count_if(F.col("n_chars") >= 500).alias("kept"))


@query("normalize_space", r"SELECT doc_id, sha1(trim(regexp_replace(text, '[\s\x{0B}\x{85}\p{Z}]+', ' ', 'g'))) AS squeezed FROM documents")
def normalize_space(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha1(text.normalize_space(F.col("text"))).alias("squeezed"))


@query("slug", r"""SELECT page_id, coalesce(nullif(trim(regexp_replace(regexp_replace(lower(url), '[^\p{L}\p{N}\s_-]', '', 'g'), '[\s_-]+', '-', 'g'), '-'), ''), 'unknown') AS slug FROM pages""")
def slug(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.slug(F.col("url")).alias("slug"))


@query("xml_id", """SELECT p_partkey, substr(CASE WHEN trim(regexp_replace(raw, '[^A-Za-z0-9_.-]', '_', 'g'), '_.-') SIMILAR TO '[A-Za-z_].*' THEN trim(regexp_replace(raw, '[^A-Za-z0-9_.-]', '_', 'g'), '_.-')
    ELSE 't_' || trim(regexp_replace(raw, '[^A-Za-z0-9_.-]', '_', 'g'), '_.-') END, 1, 180) AS id FROM (SELECT p_partkey, p_size || '_' || p_brand || '_' || p_name AS raw FROM part)""")
def xml_id(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", text.xml_id(F.col("p_size").cast("string"), F.lit(""), F.col("p_brand"), F.col("p_name")).alias("id"))


@query("esc", """SELECT page_id, sha1(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;')) AS escaped FROM pages""")
def esc(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.sha1(text.esc(F.col("html"))).alias("escaped"))


@query("sha1_16", "SELECT c_custkey, 'player:syn:' || substr(sha1(lower(c_name) || '|' || c_mktsegment), 1, 16) AS ref, 'unresolved' AS method FROM customer")
def sha1_16(spark, sf_dir):
    r = names.player_ref(F.lit(None).cast("string"), F.lit("12"), F.col("c_name"), F.col("c_mktsegment"))
    return table(spark, sf_dir, "customer").select("c_custkey", r.alias("r")).select("c_custkey", "r.ref", "r.method")


@query("format_g", "SELECT l_orderkey, l_linenumber, count(*) AS n, CASE WHEN l_quantity / 2 = floor(l_quantity / 2) THEN CAST(CAST(l_quantity / 2 AS BIGINT) AS VARCHAR) ELSE CAST(l_quantity / 2 AS VARCHAR) END AS g FROM lineitem GROUP BY 1, 2, 4")
def format_g(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber", text.format_g(F.col("l_quantity") / 2).alias("g")).agg(F.count("*").alias("n"))


DISPLAY = "CASE c_custkey % 4 WHEN 0 THEN c_mktsegment || ', ' || c_name || ' Jr.' WHEN 1 THEN c_name || '  ' || c_mktsegment WHEN 2 THEN c_mktsegment || ', V' ELSE c_name END"


@query("split_name", f"""
    WITH d AS (SELECT c_custkey, {DISPLAY} AS d FROM customer), w AS (SELECT *, position(',' IN d) AS comma, list_filter(string_split(trim(substr(d, position(',' IN d) + 1)), ' '), lambda x: x <> '') AS rest, list_filter(string_split(d, ' '), lambda x: x <> '') AS ws FROM d)
    SELECT c_custkey, CASE WHEN comma > 0 THEN trim(substr(d, 1, comma - 1)) ELSE ws[-1] END AS family,
      CASE WHEN comma > 0 THEN array_to_string(CASE WHEN lower(rest[-1]) IN {names.SUFFIXES} THEN rest[:-2] ELSE rest END, ' ') ELSE array_to_string(ws[:-2], ' ') END AS given,
      CASE WHEN comma > 0 AND lower(rest[-1]) IN {names.SUFFIXES} THEN rest[-1] END AS suffix FROM w""")
def split_name(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", names.split_name(F.expr(DISPLAY)).alias("n"))
    return c.select("c_custkey", "n.family", F.array_join("n.given", " ").alias("given"), "n.suffix")


@query("title_tokens", """
    SELECT p_partkey, array_to_string(list_filter(string_split(t, '+'), lambda x: x IN ('GM', 'IM', 'FM', 'CM', 'WGM', 'WIM', 'WFM', 'WCM', 'NM')), '+') AS titles, len(list_filter(string_split(t, '+'), lambda x: x LIKE 'W%')) > 0 AS female
    FROM (SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'GM+WGM+gm' WHEN 1 THEN '-' WHEN 2 THEN 'w+im+Wx' WHEN 3 THEN 'IM+XX+fm' ELSE 'WC+FM+gm' END AS t FROM part)""")
def title_tokens(spark, sf_dir):
    t = names.title_tokens(F.expr("CASE p_size % 5 WHEN 0 THEN 'GM+WGM+gm' WHEN 1 THEN '-' WHEN 2 THEN 'w+im+Wx' WHEN 3 THEN 'IM+XX+fm' ELSE 'WC+FM+gm' END"))
    return table(spark, sf_dir, "part").select("p_partkey", t.alias("t")).select("p_partkey", F.array_join("t.titles", "+").alias("titles"), "t.female")


@query("federation", "SELECT s_suppkey, CASE WHEN upper(c) SIMILAR TO '[A-Z]{3}' THEN upper(c) ELSE '' END AS federation FROM (SELECT s_suppkey, substr(s_name, 1, 3 + s_suppkey % 2) AS c FROM supplier)")
def federation(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select("s_suppkey", names.normalize_federation(F.expr("substr(s_name, 1, 3 + cast(s_suppkey % 2 as int))")).alias("federation"))


@query("event_format", """SELECT doc_id, CASE WHEN lower(trim(t)) IN ('round-robin', 'swiss', 'match', 'team', 'knockout', 'scheveningen', 'other', 'unknown') THEN lower(trim(t)) WHEN lower(t) LIKE '%schweizer%' OR lower(t) LIKE '%swiss%' THEN 'swiss' WHEN lower(t) LIKE '%rundenturnier%' OR lower(t) LIKE '%round robin%' OR lower(t) LIKE '%round-robin%' THEN 'round-robin' WHEN lower(t) LIKE '%match%' THEN 'match' WHEN lower(t) LIKE '%team%' THEN 'team' ELSE 'unknown' END AS format
    FROM (SELECT doc_id, CASE doc_id % 8 WHEN 0 THEN 'Swiss ' || text WHEN 1 THEN ' Scheveningen ' WHEN 2 THEN 'simul' WHEN 3 THEN 'Round-Robin ' || text WHEN 4 THEN 'OTHER' ELSE text || CASE doc_id % 3 WHEN 0 THEN ' Match' ELSE '' END END AS t FROM documents)""")
def event_format(spark, sf_dir):
    t = F.expr("CASE doc_id % 8 WHEN 0 THEN 'Swiss ' || text WHEN 1 THEN ' Scheveningen ' WHEN 2 THEN 'simul' WHEN 3 THEN 'Round-Robin ' || text WHEN 4 THEN 'OTHER' ELSE text || CASE doc_id % 3 WHEN 0 THEN ' Match' ELSE '' END END")
    return table(spark, sf_dir, "documents").select("doc_id", vocabulary.event_format(t).alias("format"))


@query("cadence", r"""SELECT doc_id, CASE WHEN list_contains(w, 'blitz') THEN 'blitz' WHEN list_contains(w, 'rapid') OR list_contains(w, 'rapide') THEN 'rapid' END AS cadence
    FROM (SELECT doc_id, string_split_regex(lower(CASE doc_id % 5 WHEN 0 THEN 'Blitz-' WHEN 1 THEN 'Rapide ' ELSE '' END || text), '[^\p{L}\p{N}]+') AS w FROM documents)""")
def cadence(spark, sf_dir):
    t = F.expr("CASE doc_id % 5 WHEN 0 THEN 'Blitz-' WHEN 1 THEN 'Rapide ' ELSE '' END || text")
    return table(spark, sf_dir, "documents").select("doc_id", vocabulary.cadence(t).alias("cadence"))


@query("ids", "SELECT o_orderkey, regexp_full_match(CAST(o_orderkey * 37 AS VARCHAR), '[0-9]{4,12}') AS valid_fide FROM orders")
def ids(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", names.is_valid_fide_id((F.col("o_orderkey") * 37).cast("string")).alias("valid_fide"))


@query("results_terminations", """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN '1-0' WHEN 1 THEN '1/2-1/2' ELSE '*' END AS result, CASE o_orderkey % 7 WHEN 0 THEN 'timeout' WHEN 1 THEN 'normal' WHEN 2 THEN 'forfeit' WHEN 3 THEN 'unknown' WHEN 4 THEN 'adjudication' END AS termination,
    CASE WHEN o_orderkey % 2 = 0 THEN 'B' || CAST(10 + o_orderkey % 80 AS VARCHAR) END AS eco, CASE WHEN o_orderkey % 2 = 0 THEN CAST(2000 + o_orderkey % 80 AS INT) END AS elo FROM orders""")
def results_terminations(spark, sf_dir):
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", vocabulary.game_result(F.expr("CASE o_orderkey % 4 WHEN 0 THEN '1-0' WHEN 1 THEN '1/2-1/2' WHEN 2 THEN '2-0' END")).alias("result"), vocabulary.termination(F.expr("CASE o_orderkey % 7 WHEN 0 THEN ' Time Forfeit' WHEN 1 THEN 'normal' WHEN 2 THEN 'Rules infraction' WHEN 3 THEN 'unterminated ' WHEN 4 THEN 'ADJUDICATION' WHEN 5 THEN 'death' END")).alias("termination"),
        vocabulary.eco_code(F.concat(F.when(k % 2 == 0, "B").otherwise("F"), (10 + k % 80).cast("string"))).alias("eco"), vocabulary.elo(F.concat((2000 + k % 80).cast("string"), F.when(k % 2 == 0, " ").otherwise("?"))).alias("elo"))


@query("name_key_dups", r"""SELECT k AS name_key, count(*) AS n, min(p_partkey) AS first FROM (SELECT p_partkey, trim(regexp_replace(regexp_replace(p_name || ' ' || p_type, '[^A-Za-z0-9]+', ' ', 'g'), 'x^', '')) AS t, lower(trim(regexp_replace(p_name || ' ' || p_type, '[^A-Za-z0-9]+', ' ', 'g'))) AS k FROM part) GROUP BY 1 HAVING count(*) > 1""")
def name_key_dups(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumn("name_key", text.name_key(F.concat_ws(" ", F.lit("3rd"), "p_name", F.lit("Open"), "p_type", F.lit("1994"))))
    return p.groupBy("name_key").agg(F.count("*").alias("n"), F.min("p_partkey").alias("first")).filter("n > 1")


@query("pgn_date_parse", """SELECT o_orderkey, year(o_orderdate) AS y, CASE WHEN o_orderkey % 3 <> 2 THEN month(o_orderdate) END AS m, CASE WHEN o_orderkey % 3 = 0 THEN day(o_orderdate) END AS d,
    CASE o_orderkey % 3 WHEN 0 THEN 'day' WHEN 1 THEN 'month' ELSE 'year' END AS precision FROM orders""")
def pgn_date_parse(spark, sf_dir):
    raw = F.expr("CASE o_orderkey % 3 WHEN 0 THEN date_format(o_orderdate, 'yyyy.MM.dd') WHEN 1 THEN date_format(o_orderdate, 'yyyy.MM.') || '??' ELSE date_format(o_orderdate, 'yyyy') || '.13.45' END")
    o = table(spark, sf_dir, "orders").select("o_orderkey", dates.parse_pgn(raw).alias("t"))
    return o.select("o_orderkey", "t.y", "t.m", "t.d", dates.precision(F.col("t")).alias("precision"))


@query("iso_date_parse", """SELECT o_orderkey, year(o_orderdate) * 10000 + CASE WHEN o_orderkey % 4 < 3 THEN month(o_orderdate) * 100 ELSE 0 END + CASE WHEN o_orderkey % 4 < 2 THEN day(o_orderdate) ELSE 0 END AS compact,
    CASE WHEN o_orderkey % 4 < 2 THEN strftime(o_orderdate, '%Y-%m-%d') END AS iso FROM orders""")
def iso_date_parse(spark, sf_dir):
    raw = F.expr("CASE o_orderkey % 4 WHEN 0 THEN date_format(o_orderdate, 'yyyy-MM-dd') WHEN 1 THEN date_format(o_orderdate, 'yyyyMMdd') WHEN 2 THEN date_format(o_orderdate, 'yyyyMM') || '00' ELSE date_format(o_orderdate, 'yyyy') END")
    o = table(spark, sf_dir, "orders").select("o_orderkey", dates.parse_iso(raw).alias("t"))
    return o.select("o_orderkey", dates.compact(F.col("t")).cast("bigint").alias("compact"), dates.iso(F.col("t")).alias("iso"))


@query("text_date_parse", "SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m') ELSE strftime(o_orderdate, '%Y') END AS d FROM orders")
def text_date_parse(spark, sf_dir):
    raw = F.expr("CASE o_orderkey % 3 WHEN 0 THEN date_format(o_orderdate, 'd MMM yyyy') WHEN 1 THEN date_format(o_orderdate, 'MMM yyyy') ELSE date_format(o_orderdate, 'yyyy') END")
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.text(dates.parse_day_month_year(raw)).alias("d"))


@query("calendar_days", "SELECT o_orderkey, try_cast(printf('%04d-%02d-%02d', year(o_orderdate), month(o_orderdate), 28 + o_orderkey % 5) AS DATE) IS NOT NULL AS exists FROM orders")
def calendar_days(spark, sf_dir):
    d = F.expr("struct(year(o_orderdate) as y, month(o_orderdate) as m, cast(28 + o_orderkey % 5 as int) as d)")
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.is_calendar_day(d).alias("exists"))


@query("date_swap", "SELECT l_orderkey, l_linenumber, l_partkey, least(l_shipdate, o_orderdate) AS s, greatest(l_shipdate, o_orderdate) AS e FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def date_swap(spark, sf_dir):
    j = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return j.select("l_orderkey", "l_linenumber", "l_partkey", F.least("l_shipdate", "o_orderdate").alias("s"), F.greatest("l_shipdate", "o_orderdate").alias("e"))


def monthly(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.groupBy("user_id", F.dayofmonth("ts").alias("day"), F.hour("ts").alias("hour")).agg(F.max(F.when(F.col("event_type") != "error", F.floor("value").cast("int"))).alias("rating"))


MONTHLY_SQL = "SELECT user_id, day(ts) AS d, hour(ts) AS h, max(CASE WHEN event_type <> 'error' THEN CAST(floor(value) AS INT) END) AS r FROM events GROUP BY 1, 2, 3"


@query("latest_and_peak", f"""WITH m AS (SELECT * FROM ({MONTHLY_SQL}) WHERE r IS NOT NULL), p AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY r DESC, d, h) AS n, row_number() OVER (PARTITION BY user_id ORDER BY d DESC, h DESC) AS l FROM m)
    SELECT user_id, max(r) FILTER (l = 1) AS latest, max(r) FILTER (n = 1) AS peak, max(d) FILTER (n = 1) AS peak_year, max(h) FILTER (n = 1) AS peak_month, count(*) AS points FROM p GROUP BY 1""")
def latest_and_peak(spark, sf_dir):
    return sessions.latest_and_peak(monthly(spark, sf_dir), ["user_id"], "day", "hour", "rating")


@query("monthly_grid", f"SELECT user_id, d AS day, string_agg(h || ':' || coalesce(CAST(r AS VARCHAR), '?'), ',' ORDER BY h) AS cells FROM ({MONTHLY_SQL}) GROUP BY 1, 2")
def monthly_grid(spark, sf_dir):
    cell = F.struct("hour", F.concat(F.col("hour").cast("string"), F.lit(":"), F.coalesce(F.col("rating").cast("string"), F.lit("?"))).alias("c"))
    g = monthly(spark, sf_dir).groupBy("user_id", "day").agg(F.array_sort(F.collect_list(cell)).alias("x"))
    return g.select("user_id", "day", F.array_join(F.transform("x", lambda v: v["c"]), ",").alias("cells"))


def two_sides(spark, sf_dir):
    o = table(spark, sf_dir, "orders").filter("o_orderkey % 10 <> 3").select(F.col("o_orderkey").alias("k"), F.year("o_orderdate").alias("y"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("s"))
    li = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.min(F.year("l_shipdate")).alias("y"), F.min(F.when(F.col("l_linestatus") == "F", "F")).alias("s"))
    return o, li


SIDES_SQL = """WITH a AS (SELECT o_orderkey AS k, year(o_orderdate) AS y, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS s FROM orders WHERE o_orderkey % 10 <> 3),
    b AS (SELECT l_orderkey AS k, min(year(l_shipdate)) AS y, min(CASE WHEN l_linestatus = 'F' THEN 'F' END) AS s FROM lineitem GROUP BY 1), j AS (SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'left' WHEN a.k IS NULL THEN 'right' ELSE 'both' END AS side,
      CASE WHEN a.k IS NOT NULL AND b.k IS NOT NULL THEN a.y IS NOT DISTINCT FROM b.y END AS same_y, CASE WHEN a.k IS NOT NULL AND b.k IS NOT NULL THEN a.s IS NOT DISTINCT FROM b.s END AS same_s FROM a FULL OUTER JOIN b ON a.k = b.k)"""


@query("full_outer_diff", f"{SIDES_SQL} SELECT k, side, same_y, same_s FROM j")
def full_outer_diff(spark, sf_dir):
    return merging.full_outer_diff(*two_sides(spark, sf_dir), "k", ["y", "s"])


@query("field_mismatch_report", f"""{SIDES_SQL}, t AS (SELECT k, 'y' AS field FROM j WHERE side = 'both' AND NOT same_y UNION ALL SELECT k, 's' FROM j WHERE side = 'both' AND NOT same_s)
    SELECT field, count(*) AS mismatches, string_agg(CAST(k AS VARCHAR), ',' ORDER BY k) FILTER (n <= 8) AS samples FROM (SELECT *, row_number() OVER (PARTITION BY field ORDER BY k) AS n FROM t) GROUP BY 1""")
def field_mismatch_report(spark, sf_dir):
    return merging.mismatch_report(full_outer_diff(spark, sf_dir), "k", ["y", "s"])


GAMES_SQL = "SELECT event_id, user_id, event_type, CASE WHEN event_id % 11 <> 0 THEN CAST(ts AS DATE) END AS date FROM events"
SESSIONS_SQL = f"""WITH g AS ({GAMES_SQL}), l AS (SELECT *, lag(date) OVER w AS before FROM g WINDOW w AS (PARTITION BY user_id, event_type ORDER BY date NULLS LAST, event_id)),
    n AS (SELECT *, CASE WHEN date IS NOT NULL AND (before IS NULL OR date - before > 3) THEN 1 ELSE 0 END AS new FROM l),
    r AS (SELECT *, sum(new) OVER (PARTITION BY user_id, event_type ORDER BY date NULLS LAST, event_id ROWS UNBOUNDED PRECEDING) AS run, sum(new) OVER (PARTITION BY user_id, event_type) AS runs FROM n),
    s AS (SELECT event_id, user_id, event_type, date, CAST(CASE WHEN date IS NOT NULL THEN run WHEN runs = 1 THEN 1 ELSE 0 END AS BIGINT) AS session FROM r)"""


def games(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.when(F.col("event_id") % 11 != 0, F.to_date("ts")).alias("date"))


@query("gap_sessions", f"{SESSIONS_SQL} SELECT event_id, user_id, event_type, date, session FROM s")
def gap_sessions(spark, sf_dir):
    return sessions.gap_sessions(games(spark, sf_dir), ["user_id", "event_type"], "date", "event_id", 3)


@query("session_bounds", f'{SESSIONS_SQL} SELECT user_id, event_type, session, count(*) AS games, coalesce(min(date), DATE \'1970-01-01\') AS start, coalesce(max(date), DATE \'1970-01-01\') AS "end", min(date) IS NULL AS undated FROM s GROUP BY 1, 2, 3')
def session_bounds(spark, sf_dir):
    return sessions.session_bounds(gap_sessions(spark, sf_dir), ["user_id", "event_type"], "date")


@query("first_seen_numbering", """SELECT l_orderkey, l_suppkey, printf('p%04d', row_number() OVER (PARTITION BY l_orderkey ORDER BY f, l_suppkey)) AS number FROM (SELECT l_orderkey, l_suppkey, min(l_linenumber) AS f FROM lineitem GROUP BY 1, 2)""")
def first_seen_numbering(spark, sf_dir):
    return sessions.first_seen_numbers(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_suppkey", ["l_linenumber", "l_suppkey"])


@query("first_wins", "SELECT o_custkey, o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders) WHERE n = 1")
def first_wins(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return merging.first_wins(o.select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderdate"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("last_wins", "SELECT o_custkey, o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) WHERE n = 1")
def last_wins(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return merging.last_wins(o.select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderdate"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("insert_only_merge", "SELECT o_orderkey AS k, CAST(o_custkey AS BIGINT) AS v FROM orders WHERE o_orderkey % 3 = 0 UNION ALL SELECT l_orderkey, min(l_partkey) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 0) GROUP BY 1")
def insert_only_merge(spark, sf_dir):
    old = table(spark, sf_dir, "orders").filter("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("v"))
    return merging.insert_only(old, table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.min("l_partkey").alias("v")), ["k"])


@query("merge_first_non_null", """SELECT l_orderkey, arg_min(CASE WHEN l_discount > 0.03 THEN l_partkey END, (l_linenumber, l_partkey)) AS part, arg_min(CASE WHEN l_returnflag <> 'N' THEN l_returnflag END, (l_linenumber, l_partkey)) AS flag FROM lineitem GROUP BY 1""")
def merge_first_non_null(spark, sf_dir):
    """Lines of one number and part go as they lie in the file, as the SQL takes them."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "_metadata.file_path", "_metadata.row_index", F.when(F.col("l_discount") > 0.03, F.col("l_partkey")).alias("part"), F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).otherwise("").alias("flag"))
    return merging.first_non_null(li, ["l_orderkey"], ["l_linenumber", "l_partkey", "file_path", "row_index"], ["part", "flag"])


@query("argmax_record", "SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC, l_discount DESC, l_orderkey, l_linenumber, l_partkey) AS n FROM lineitem) WHERE n = 1")
def argmax_record(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount")
    return merging.first_wins(li, ["l_suppkey"], [-F.col("l_quantity"), -F.col("l_discount"), "l_orderkey", "l_linenumber", "l_partkey"]).drop("l_quantity", "l_discount")


@query("union_lists", "SELECT o_custkey, string_agg(o_orderpriority, '+' ORDER BY f) AS priorities FROM (SELECT o_custkey, o_orderpriority, min(o_orderkey) AS f FROM orders GROUP BY 1, 2) GROUP BY 1")
def union_lists(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.array("o_orderpriority").alias("one"))
    return o.groupBy("o_custkey").agg(F.array_join(registries.ordered_distinct("one", ["o_orderkey"]), "+").alias("priorities"))


@query("unique_claim_alias", "WITH a AS (SELECT p_name || ' ' || p_type || ' ' || p_size AS alias, p_brand, p_partkey FROM part) SELECT alias, min(p_brand) AS target FROM a WHERE alias NOT IN (SELECT alias FROM a WHERE p_partkey % 7 = 0) GROUP BY 1 HAVING count(DISTINCT p_brand) = 1")
def unique_claim_alias(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.concat_ws(" ", "p_name", "p_type", F.col("p_size").cast("string")).alias("alias"), F.col("p_brand").alias("target"), "p_partkey")
    return merging.unique_claims(p, "alias", "target", p.filter("p_partkey % 7 = 0"), "alias")


@query("unique_resolution", """WITH c AS (SELECT c_mktsegment || '-' || (c_custkey % 200) AS k, min(c_custkey) AS ref FROM customer GROUP BY 1 HAVING count(DISTINCT c_custkey) = 1)
    SELECT o_orderkey, ref FROM (SELECT o_orderkey, 'BUILDING-' || (o_orderkey % 200) AS k FROM orders) LEFT JOIN c USING (k)""")
def unique_resolution(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.concat_ws("-", "c_mktsegment", (F.col("c_custkey") % 200).cast("string")).alias("ck"), F.col("c_custkey").alias("ref"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("BUILDING-"), (F.col("o_orderkey") % 200).cast("string")).alias("k"))
    return merging.unique_or_unresolved(o, "k", c, "ck", "ref").select("o_orderkey", "ref")


@query("infer_parent_unique", "SELECT n_nationkey, n_name, r_name AS parent FROM nation LEFT JOIN region ON n_regionkey = r_regionkey AND r_regionkey <> 2")
def infer_parent_unique(spark, sf_dir):
    r = table(spark, sf_dir, "region").filter("r_regionkey <> 2")
    return table(spark, sf_dir, "nation").join(r, F.col("n_regionkey") == F.col("r_regionkey"), "left").select("n_nationkey", "n_name", F.col("r_name").alias("parent"))


@query("interval_overlap_join", """WITH s AS (SELECT user_id, event_type, min(ts) AS a, max(ts) AS b FROM events GROUP BY 1, 2, day(ts)), o AS (SELECT user_id, min(ts) AS oa, min(ts) + INTERVAL 2 DAY AS ob FROM events WHERE event_type = 'signup' GROUP BY 1)
    SELECT s.user_id, event_type, a, b, oa FROM s JOIN o ON s.user_id = o.user_id AND a <= ob AND b >= oa""")
def interval_overlap_join(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    s = e.groupBy("user_id", "event_type", F.dayofmonth("ts")).agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    o = e.filter("event_type = 'signup'").groupBy(F.col("user_id").alias("ou")).agg(F.min("ts").alias("oa")).withColumn("ob", F.expr("oa + INTERVAL 2 DAY"))
    return merging.overlapping(s, "user_id", "a", "b", o, "ou", "oa", "ob").select("user_id", "event_type", "a", "b", "oa")


for _name, (_f, _sql) in (culling.SUITE | curating.SUITE | database.SUITE | reading.SUITE | resolving.SUITE).items():
    query(_name, _sql)(_f)


@query("page_type_cross", "SELECT r_name, t AS page_type, 'https://example.org/tnr' || r_regionkey || '.aspx?art=' || a AS url FROM region, (VALUES ('rank', 1), ('pairings', 2), ('players', 0)) AS v(t, a)")
def page_type_cross(spark, sf_dir):
    kinds = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(a).alias("a")) for t, a in (("rank", 1), ("pairings", 2), ("players", 0))])
    r = table(spark, sf_dir, "region").withColumn("x", F.explode(kinds))
    return r.select("r_name", F.col("x.t").alias("page_type"), F.concat(F.lit("https://example.org/tnr"), F.col("r_regionkey"), F.lit(".aspx?art="), F.col("x.a")).alias("url"))


@query("token_jaccard_pairs", r"""WITH k AS (SELECT p_partkey, list_distinct(string_split(lower(p_name || ' ' || p_type), ' ')) AS w, split_part(p_name, ' ', 1) AS b, p_size FROM part)
    SELECT x.p_partkey AS a, y.p_partkey AS b, round(len(list_intersect(x.w, y.w)) / len(list_distinct(list_concat(x.w, y.w))), 6) AS jaccard FROM k x JOIN k y ON x.b = y.b AND x.p_size = y.p_size AND x.p_partkey < y.p_partkey""")
def token_jaccard_pairs(spark, sf_dir):
    words = text.key_words(text.name_key(F.concat_ws(" ", "p_name", "p_type")))
    k = table(spark, sf_dir, "part").select("p_partkey", words.alias("words"), F.split_part("p_name", F.lit(" "), F.lit(1)).alias("block"), "p_size")
    return clustering.scored_pairs(k, ["block", "p_size"], "p_partkey", "words", lambda x, y: F.round(text.words_jaccard(x, y), 6), "jaccard")


@query("sequence_ratio_pairs")
def sequence_ratio_pairs(spark, sf_dir):
    b = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("idx"), text.name_key(F.col("text")).alias("key"))
    pairs = b.alias("x").join(b.alias("y"), (F.substring("x.key", 1, 3) == F.substring("y.key", 1, 3)) & (F.col("x.idx") < F.col("y.idx")))
    return pairs.select(F.col("x.idx").alias("a"), F.col("y.idx").alias("b"), clustering.similarity(F.col("x.key"), F.col("y.key")).alias("similarity"))


@query("fact_clusters")
def fact_clusters(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    facts = p.select(F.col("p_partkey").alias("idx"), F.when(F.col("p_partkey") % 50 == 0, F.col("p_brand")).alias("event_ref"), F.col("p_size").alias("year"), (F.col("p_partkey") % 12 + 1).alias("month"), text.name_key(F.concat_ws(" ", "p_name", "p_type")).alias("key"), F.array("p_brand").alias("roster"))
    return clustering.components(clustering.linked_facts(facts))


@query("linked_blocks")
def linked_blocks(spark, sf_dir):
    """Orders as records of one block a year: names of a few words with many equal and near ones, rosters of the parts bought. Tested against brute force."""
    li = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    name = F.min_by(F.concat_ws(" ", "p_name", F.expr("if(l_orderkey % 2 = 0, 'cup', 'memorial cup')"), F.concat(F.lit("no"), F.col("l_partkey").cast("string"))), "l_partkey")
    o = li.groupBy("l_orderkey").agg(name.alias("words"), F.collect_set(F.col("l_partkey").cast("string")).alias("roster"), F.min("l_shipdate").alias("day"))
    facts = o.select(F.col("l_orderkey").alias("idx"), F.when(F.col("l_orderkey") % 97 == 0, F.concat(F.lit("e"), (F.col("l_orderkey") % 31).cast("string"))).alias("event_ref"), F.year("day").alias("year"), F.month("day").alias("month"), text.name_key(F.concat(F.lit("city "), F.col("words"))).alias("key"), "roster")
    facts = keep(facts, "facts")
    return clustering.components(clustering.linked_in_large_blocks(facts))


@query("connected_components", """WITH RECURSIVE e AS (SELECT DISTINCT o_custkey AS x, o_custkey + 7 AS y FROM orders), d AS (SELECT DISTINCT x, y FROM (SELECT x, y FROM e UNION ALL SELECT y, x FROM e)),
    r AS (SELECT DISTINCT x, x AS root FROM d UNION SELECT d.y, r.root FROM r JOIN d ON d.x = r.x WHERE r.root < d.y) SELECT x AS node, min(root) AS root FROM r GROUP BY 1""")
def connected_components(spark, sf_dir):
    e = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("a"), (F.col("o_custkey") + 7).alias("b"))
    return clustering.components(e)


@query("cluster_best", """SELECT l_orderkey, l_partkey AS best, n AS members FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey) AS n, row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END, l_quantity DESC, l_linenumber, l_partkey) AS r FROM lineitem) WHERE r = 1""")
def cluster_best(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").withColumn("priority", F.expr("CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END"))
    return li.groupBy("l_orderkey").agg(F.min_by("l_partkey", F.struct("priority", -F.col("l_quantity"), "l_linenumber", "l_partkey")).alias("best"), F.count("*").alias("members"))


@query("link_extract", """SELECT page_id, unnest(regexp_extract_all(html, '<a\\s[^>]*?href="([^"]*)"', 1)) AS href FROM pages""")
def link_extract(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.explode(text.links(F.col("html"))).alias("href"))


@query("canonical_url", r"""SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'https://www.home.org' ELSE CASE WHEN page_id % 3 = 1 THEN 'http' ELSE regexp_extract(lower(url), '^([a-z]+)://', 1) END || '://' || regexp_extract(lower(url), '://([^/?#]*)', 1) END
    || regexp_extract(url, '://[^/?#]*([^#?]*)', 1) || CASE WHEN page_id % 2 = 0 THEN '/x' ELSE '' END || regexp_extract(url, '[?][^#]*') AS url FROM pages""")
def canonical_url(spark, sf_dir):
    path, rest = F.regexp_extract("url", "://[^/?#]*([^#?]*)", 1), F.regexp_extract("url", "[?][^#]*", 0)
    head = F.expr(r"CASE page_id % 3 WHEN 0 THEN 'HTTP://Home.ORG' WHEN 1 THEN 'http://' || upper(regexp_extract(url, '://([^/?#]*)', 1)) ELSE regexp_extract(url, '^[a-z]+://[^/?#]*', 0) END")
    url = F.concat(head, path, F.when(F.col("page_id") % 2 == 0, "/x;params").otherwise(""), rest, F.lit("#part"))
    return table(spark, sf_dir, "pages").select("page_id", text.canonical_url(url, {"home.org": "www.home.org"}).alias("url"))


@query("html_text", r"""SELECT page_id, sha1(trim(regexp_replace(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(html, '(?is)<(script.*?</script|style.*?</style)>', ' ', 'g'), '(?s)<[^>]+>', ' ', 'g'),
    '&middot;', '·'), '&copy;', '©'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;?', '&', 'g'), '[\s\x{0B}\x{85}\p{Z}]+', ' ', 'g'))) AS body FROM pages""")
def html_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.sha1(text.html_text(F.col("html"))).alias("body"))


@query("digests", "SELECT doc_id, sha256(text) AS sha256 FROM documents")
def digests(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"))


@query("section_counts", """SELECT conv_id, section, count(*) AS lines, sum(strlen(text)) AS bytes FROM (SELECT *, last_value(CASE WHEN role <> 'assistant' THEN role END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS section FROM conversations) GROUP BY 1, 2""")
def section_counts(spark, sf_dir):
    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    c = table(spark, sf_dir, "conversations").withColumn("section", F.last(F.when(F.col("role") != "assistant", F.col("role")), True).over(w))
    return c.groupBy("conv_id", "section").agg(F.count("*").alias("lines"), F.sum(F.octet_length("text")).alias("bytes"))


@query("dq_range", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderdate > l_shipdate")
def dq_range(spark, sf_dir):
    j = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return checks.out_of_order(j, F.col("o_orderdate"), F.col("l_shipdate")).select("l_orderkey", "l_linenumber", "l_partkey")


@query("dq_self_ref", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey = l_suppkey")
def dq_self_ref(spark, sf_dir):
    return checks.same_both_sides(table(spark, sf_dir, "lineitem"), "l_partkey", "l_suppkey").select("l_orderkey", "l_linenumber", "l_partkey")


@query("dq_gap", """SELECT l_orderkey, n, "distinct", first, last, CASE WHEN n <> "distinct" AND (first <> 1 OR last - first + 1 <> "distinct") THEN 'both' WHEN n <> "distinct" THEN 'duplicate' ELSE 'gap' END AS problem
    FROM (SELECT l_orderkey, count(*) AS n, count(DISTINCT l_linenumber) AS "distinct", min(l_linenumber) AS first, max(l_linenumber) AS last FROM lineitem GROUP BY 1) WHERE n <> "distinct" OR first <> 1 OR last - first + 1 <> "distinct" """)
def dq_gap(spark, sf_dir):
    return checks.broken_sequences(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_linenumber")


@query("dq_dup_key", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def dq_dup_key(spark, sf_dir):
    return checks.repeated_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("dq_orphan", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def dq_orphan(spark, sf_dir):
    return checks.orphans(table(spark, sf_dir, "orders"), "o_orderkey", table(spark, sf_dir, "lineitem"), "l_orderkey").select("o_orderkey")


@query("dq_consistency", "SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_linestatus FROM lineitem WHERE (l_returnflag = 'A' AND l_linestatus <> 'F') OR (l_returnflag = 'R' AND l_linestatus <> 'O')")
def dq_consistency(spark, sf_dir):
    rules = {"A": "F", "R": "O"}
    li, bad = table(spark, sf_dir, "lineitem"), F.lit(False)
    for flag, status in rules.items():
        bad = bad | ((F.col("l_returnflag") == flag) & (F.col("l_linestatus") != status))
    return li.filter(bad).select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus")


@query("dq_count", "SELECT o_orderkey, o_orderkey % 6 AS stated, coalesce(found, 0) AS found FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS found FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey WHERE o_orderkey % 6 <> coalesce(found, 0)")
def dq_count(spark, sf_dir):
    heads = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % 6).alias("stated"))
    return checks.count_mismatch(heads, "o_orderkey", "stated", table(spark, sf_dir, "lineitem"), "l_orderkey")


@query("json_variant_int", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_variant_int(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", text.int_like(F.get_json_object("props", "$.k")).alias("k"))


@query("shard_key", "SELECT doc_id, CASE WHEN upper(substr(text, 1, 1)) SIMILAR TO '[A-Z]' THEN upper(substr(text, 1, 1)) ELSE 'OTHER' END AS shard FROM documents")
def shard_key(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.shard_key(F.col("text")).alias("shard"))


@query("rating_values", "SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN CAST(p_retailprice AS INT) WHEN p_size >= 10 THEN 100 + p_size ELSE 0 END AS rating FROM (SELECT p_partkey, p_size, floor(p_retailprice) AS p_retailprice FROM part)")
def rating_values(spark, sf_dir):
    raw = F.expr("CASE WHEN p_size % 2 = 0 THEN cast(floor(p_retailprice) as string) WHEN p_size >= 10 THEN 'Elo ' || (100 + p_size) || '?' ELSE 'n/a ' || p_size END")
    return table(spark, sf_dir, "part").select("p_partkey", text.rating_value(raw).alias("rating"))


@query("skip_limit", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 100 OFFSET 50")
def skip_limit(spark, sf_dir):
    return positions.offset_limit(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey"], 50, 100)


# Published move counts of the usual test positions.
MOVE_COUNTS = (
    ("rnbqkbnr/pppppppp/8/8/8/8/PPPPPPPP/RNBQKBNR w KQkq - 0 1", (20, 400, 8902, 197281, 4865609)),
    ("r3k2r/p1ppqpb1/bn2pnp1/3PN3/1p2P3/2N2Q1p/PPPBBPPP/R3K2R w KQkq - 0 1", (48, 2039, 97862, 4085603)),
    ("8/2p5/3p4/KP5r/1R3p1k/8/4P1P1/8 w - - 0 1", (14, 191, 2812, 43238, 674624)),
    ("r3k2r/Pppp1ppp/1b3nbN/nP6/BBP1P3/q4N2/Pp1P2PP/R2Q1RK1 w kq - 0 1", (6, 264, 9467)),
    ("r2q1rk1/pP1p2pp/Q4n2/bbp1p3/Np6/1B3NBn/pPPP1PPP/R3K2R b KQ - 0 1", (6, 264, 9467)),
    ("rnbq1k1r/pp1Pbppp/2p5/8/2B5/8/PPP1NnPP/RNBQK2R w KQ - 1 8", (44, 1486, 62379, 2103487)),
    ("r4rk1/1pp1qppp/p1np1n2/2b1p1B1/2B1P1b1/P1NP1N2/1PP1QPPP/R4RK1 w - - 0 10", (46, 2079, 89890)),
)
COUNTED = [(fen, d + 1, n) for fen, counts in MOVE_COUNTS for d, n in enumerate(counts)]


def _counted(spark, deepest):
    return spark.createDataFrame([(fen, d) for fen, d, n in COUNTED if n <= deepest], "fen string, depth int")


def _counts_sql(deepest):
    return f"SELECT * FROM (VALUES {', '.join(f'({fen!r}, CAST({d} AS INT), CAST({n} AS BIGINT))' for fen, d, n in COUNTED if n <= deepest)}) AS v(fen, depth, nodes)"


@query("perft_small", _counts_sql(9467))
def perft_small(spark, sf_dir):
    return moves.move_counts(_counted(spark, 9467), "fen", "depth")


@query("perft_full", _counts_sql(10**7))
def perft_full(spark, sf_dir):
    return moves.move_counts(_counted(spark, 10**7), "fen", "depth")


#: Public opening lines, and the moves they stand for.
LINES = (("e4 e5 Nf3 Nc6 Bb5 a6 Ba4 Nf6 O-O", "e2e4 e7e5 g1f3 b8c6 f1b5 a7a6 b5a4 g8f6 e1g1"), ("d4 d5 c4 dxc4 e3 b5 a4 c6", "d2d4 d7d5 c2c4 d5c4 e2e3 b7b5 a2a4 c7c6"), ("e4 c5 Nf3 d6 d4 cxd4 Nxd4 Nf6 Nc3 a6", "e2e4 c7c5 g1f3 d7d6 d2d4 c5d4 f3d4 g8f6 b1c3 a7a6"))


@query("pgn_roundtrip", f"SELECT c_custkey, split_part(v.ucis, '|', 1) AS ucis FROM customer JOIN (VALUES {', '.join(f'({i}, {u!r})' for i, (_, u) in enumerate(LINES))}) AS v(i, ucis) ON c_custkey % 3 = v.i")
def pgn_roundtrip(spark, sf_dir):
    game = F.concat(F.lit('[Event "x"]\n[White "'), F.col("c_name"), F.lit('"]\n\n1. '), F.element_at(F.array(*[F.lit(s) for s, _ in LINES]), (F.col("c_custkey") % 3 + 1).cast("int")), F.lit(" *"))
    g = headers(replayed(table(spark, sf_dir, "customer").select("c_custkey", game.alias("game")), hashing.derived_keys(), tasks=spark.sparkContext.defaultParallelism))
    return g.select("c_custkey", F.array_join("ucis", " ").alias("ucis"))


@query("trajectory_fp")
def trajectory_fp(spark, sf_dir):
    game = F.concat(F.lit("1. "), F.element_at(F.array(*[F.lit(s) for s, _ in LINES]), (F.col("c_custkey") % 3 + 1).cast("int")))
    g = replayed(table(spark, sf_dir, "customer").select("c_custkey", game.alias("game")), hashing.derived_keys(), tasks=spark.sparkContext.defaultParallelism)
    return g.groupBy("trajectory_fp", "final_position_fp").agg(F.count("*").alias("games"), F.min("c_custkey").alias("first"))


@query("link_classify", r"""SELECT page_id, href, CASE WHEN regexp_matches(lower(regexp_extract(href, '^[^?#]*')), '\.(css|js|png|jpe?g|gif|svg|ico|pdf|zip|mp3)$') THEN 'asset' WHEN regexp_matches(lower(href), '[?&](zeilen|prt|excel)=') THEN 'export'
    WHEN regexp_matches(lower(regexp_extract(href, '^[^?#]*')), 'cross|tabel') THEN 'crosstable' WHEN regexp_matches(lower(regexp_extract(href, '^[^?#]*')), '(^|[^0-9])(18|19|20)[0-9][0-9]([^0-9]|$)') THEN 'event'
    WHEN lower(regexp_extract(href, '^[^?#]*')) LIKE '%/' THEN 'section' ELSE 'page' END AS kind FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a\s[^>]*?href="([^"]*)"', 1)) AS href FROM pages)""")
def link_classify(spark, sf_dir):
    return link_extract(spark, sf_dir).select("page_id", "href", pages.link_kind(F.col("href")).alias("kind"))


SITE_PATH = "CASE page_id % 11 WHEN 0 THEN '/ind-gbr/hastings-1924.html' WHEN 1 THEN '/img/x1900.html' WHEN 2 THEN '/index.php' WHEN 3 THEN '/2024/Crossin.htm' WHEN 4 THEN '/Minev/files/a.HTM' WHEN 5 THEN '/events1900.html' WHEN 6 THEN '/a1950.PDF' WHEN 7 THEN '/search1999.html' WHEN 8 THEN '/ind-x/' WHEN 9 THEN '/2024/team.v2.php?y=1900' ELSE '/2024/2024in.html#t' END"
SITE_TEXT = "CASE page_id % 13 WHEN 0 THEN 'Final  Standings' WHEN 1 THEN ' Summary' WHEN 2 THEN 'USA2' WHEN 3 THEN '12½3' WHEN 4 THEN '3rd' WHEN 5 THEN 'Hastings 1924' WHEN 6 THEN 'W' WHEN 7 THEN '' WHEN 8 THEN 'Events 1900' WHEN 9 THEN 'Group B' WHEN 10 THEN '+=-' WHEN 11 THEN 'Sign guestbook' ELSE NULL END"


@query("site_link_classes", f"""WITH p AS (SELECT page_id, lower(regexp_extract(url, '://([^/?#]*)', 1)) AS host, {SITE_PATH} AS raw, trim(regexp_replace(coalesce({SITE_TEXT}, ''), ' +', ' ', 'g')) AS t FROM pages),
    f AS (SELECT *, lower(regexp_extract(raw, '^[^?#]*')) AS path, page_id % 4 > 0 AS same, coalesce(page_id % 5 > 0, true) AS http FROM p),
    g AS (SELECT *, regexp_extract(path, '([^/]*)/?$', 1) AS name, path LIKE '/ind-%' AS ind, path LIKE '/img/%' OR path LIKE '/search%' AS bad, lower(t) AS k, path LIKE '%/index.php' AS front, t = '' OR regexp_full_match(t, '[A-Z]{{2,5}}[0-9]?|[0-9]+([½./:-][0-9]+)?|[WDL]|[+=-]+') AS code FROM f),
    h AS (SELECT *, same AND NOT bad AND name NOT LIKE '%.pdf' AS here, k NOT IN ('', 'summary', 'sign guestbook') AND NOT code AS worded, regexp_matches(name, '(18|19|20)[0-9][0-9]') OR regexp_matches(path, '/(18|19|20)[0-9][0-9]/') AS dated FROM g)
    SELECT page_id, http AND here AND worded AND NOT front AS seed, http AND here AND worded AND NOT front AND ind AS individual_seed, http AND here AND worded AND dated AND NOT ind AS team_event,
      here AND path LIKE '/2024/%' AND (k IN ('final standings', 'group b') OR k = '3rd') AS detail, http AND regexp_matches(path, '[.]html?$') AND (name LIKE 'events%' OR k LIKE 'events %') AS era, http AND regexp_matches(path, '[.]html?$') AND path LIKE '%/minev/files/%' AS crosstable FROM h""")
def site_link_classes(spark, sf_dir):
    """Links made of the pages' hosts, paths of every class and texts of every kind, beside a parent in /2024."""
    p = table(spark, sf_dir, "pages").withColumn("host", F.lower(F.regexp_extract("url", "://([^/?#]*)", 1)))
    p = p.select("page_id", "host", F.expr(f"if(page_id % 5 > 0, 'HTTPS', 'ftp') || '://' || host || {SITE_PATH}").alias("u"), F.expr(SITE_TEXT).alias("t"), F.expr(r"'https://www.' || if(page_id % 4 > 0, regexp_replace(host, '^www[.]', ''), 'other.org') || '/2024/'").alias("start"))
    p = p.withColumn("parent", F.concat("start", F.lit("index.html")))
    u, t, start, parent = (F.col(c) for c in ("u", "t", "start", "parent"))
    return p.select(
        "page_id", links.is_summary_seed(u, t, start).alias("seed"), links.is_summary_seed(u, t, start, "individual").alias("individual_seed"), links.is_event_candidate(u, t, parent, start, "team").alias("team_event"), links.is_detail(u, t, parent, start, True).alias("detail"),
        links.is_era_page(u, t, F.col("host")).alias("era"), links.is_crosstable_file(u, F.col("host")).alias("crosstable"))


@query("crosstable_like", r"""SELECT page_id, regexp_matches(lower(t), 'final standings|## standings|crosstable|## the final group|stage:|round:') OR (lower(t) LIKE '%pos.%' AND lower(t) LIKE '%pts%' AND regexp_matches(lower(t), 'games|gms') AND regexp_matches(lower(t), ' 1 | 0 | ½ |1/2')) AS crosstable
    FROM (SELECT page_id, html || CASE page_id % 6 WHEN 0 THEN ' Final Standings' WHEN 1 THEN ' Pos. Name Pts Games 1/2' WHEN 2 THEN ' Pos. Pts gms ' WHEN 3 THEN ' kreuztabelle' WHEN 4 THEN ' Round: 3' ELSE '' END AS t FROM pages)""")
def crosstable_like(spark, sf_dir):
    t = F.expr("html || CASE page_id % 6 WHEN 0 THEN ' Final Standings' WHEN 1 THEN ' Pos. Name Pts Games 1/2' WHEN 2 THEN ' Pos. Pts gms ' WHEN 3 THEN ' kreuztabelle' WHEN 4 THEN ' Round: 3' ELSE '' END")
    return table(spark, sf_dir, "pages").select("page_id", pages.looks_like_crosstable(t).alias("crosstable"))


@query("html_table_mean", "SELECT s_suppkey, CAST(floor((1000 + s_nationkey + 2000) / 2) AS BIGINT) AS mean FROM supplier")
def html_table_mean(spark, sf_dir):
    html = F.concat(F.lit('<p><table class="CRs1"><tr><th>No.</th><th>RtgI</th></tr><tr><td>1</td><td><b>'), (F.col("s_nationkey") + 1000).cast("string"), F.lit("</b></td></tr><tr><td>2</td><td>2000</td></tr><tr><td>3</td><td>0</td></tr></table>"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", pages.rating_mean(html).cast("bigint").alias("mean"))


@query("player_merge", """WITH r AS (SELECT l_suppkey AS id, min(l_orderkey * 100 + l_linenumber) AS line FROM lineitem GROUP BY 1), x AS (SELECT l_suppkey, l_orderkey * 100 + l_linenumber AS line, max(l_returnflag) AS name, max(l_partkey) AS months, bool_or(l_discount > 0.09) AS female,
      max(CASE WHEN l_tax > 0.04 THEN CAST(l_quantity AS INT) END) AS year FROM lineitem GROUP BY 1, 2)
    SELECT l_suppkey AS id, min(line) AS line, arg_min(name, line) AS name, bool_or(female) AS female, arg_min(year, line) FILTER (year IS NOT NULL) AS birth_year, max(months) AS rated_months FROM x GROUP BY 1""")
def player_merge(spark, sf_dir):
    r = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("line")).agg(
        F.max("l_returnflag").alias("name"), F.max("l_partkey").alias("rated_months"), F.bool_or(F.col("l_discount") > 0.09).alias("female"), F.max(F.when(F.col("l_tax") > 0.04, F.col("l_quantity").cast("int"))).alias("birth_year"))
    r = r.select(F.col("l_suppkey").cast("string").alias("fide_id"), "line", "name", F.array("name").alias("titles"), "female", "birth_year", F.lit("USA").alias("federation"), "rated_months", F.array("name").alias("aliases"))
    return registries.merge_players(r).select(F.col("fide_id").cast("bigint").alias("id"), "line", "name", "female", "birth_year", "rated_months")


@query("place_merge", """SELECT p_brand AS ref, min(p_size) AS priority, arg_min(p_name, (p_size, lower(p_name), p_name)) AS name, arg_min(p_type, (p_size, lower(p_name), p_name)) FILTER (p_size % 2 = 0) AS country, bool_or(p_partkey % 50 = 0) AS legacy, count(*) AS n
    FROM (SELECT p_brand, p_size, p_name, min(p_type) AS p_type, min(p_partkey) AS p_partkey FROM part GROUP BY 1, 2, 3) GROUP BY 1""")
def place_merge(spark, sf_dir):
    p = table(spark, sf_dir, "part").groupBy("p_brand", "p_size", "p_name").agg(F.min("p_type").alias("t"), F.min("p_partkey").alias("k"))
    places = p.select(F.col("p_brand").alias("ref"), F.col("p_size").alias("priority"), F.col("p_name").alias("name"), F.when(F.col("p_size") % 2 == 0, F.col("t")).otherwise("").alias("country"), F.lit("city").alias("kind"), F.array("name").alias("aliases"), (F.col("k") % 50 == 0).alias("legacy"))
    n = places.groupBy("ref").agg(F.count("*").alias("n"))
    return registries.merge_places(places).join(n, "ref").select("ref", "priority", "name", "country", "legacy", "n")


@query("event_occurrences", """SELECT 'event:' || strftime(o_orderdate, '%Y%m%d') || '-' || strftime(o_orderdate, '%Y%m%d') || '-' || lower(o_orderpriority) AS ref, min(o_orderkey) AS first, count(*) AS n FROM (SELECT o_orderkey, o_orderdate, regexp_replace(regexp_replace(o_orderpriority, '[^A-Za-z0-9 -]', '', 'g'), '[ -]+', '-', 'g') AS o_orderpriority FROM orders) GROUP BY 1""")
def event_occurrences(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    day = F.struct(F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"), F.dayofmonth("o_orderdate").alias("d"))
    r = o.select(F.col("o_orderpriority").alias("name"), day.alias("start"), F.lit(None).cast("struct<y:int,m:int,d:int>").alias("end"), F.lit("swiss").alias("format"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("source"), F.col("o_orderkey").alias("ord"))
    return registries.occurrences(r).select("ref", F.element_at("sources", 1).cast("bigint").alias("first"), F.size("sources").cast("bigint").alias("n"))


ENTRY_NAMES = """
    WITH x AS (SELECT c_nationkey AS priority, CASE WHEN c_custkey % 17 = 0 THEN c_name ELSE CASE c_custkey % 3 WHEN 0 THEN 'Open ' WHEN 1 THEN 'OPEN-' ELSE 'open.  ' END || (c_custkey % 400) END AS canonical,
        CASE WHEN c_custkey % 19 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN 'open_' || (c_custkey % 400 + 1) WHEN c_custkey % 11 = 0 THEN 'o.p.e.n' || (c_custkey % 400) WHEN c_custkey % 23 = 0 THEN 'bad ' || c_name ELSE CASE c_custkey % 2 WHEN 0 THEN 'GP ' ELSE 'gp' END || (c_custkey % 1300) END AS alias FROM customer),
    n AS (SELECT priority, replace(canonical, '  ', ' ') AS canonical, alias, regexp_replace(lower(canonical), '[,. _-]', '', 'g') AS ck, regexp_replace(lower(alias), '[,. _-]', '', 'g') AS ak FROM x),
    good AS (SELECT * FROM n WHERE canonical NOT LIKE '%#%'), shown AS (SELECT ck, arg_min(canonical, (priority, lower(canonical), canonical)) AS canonical FROM good GROUP BY 1),
    al AS (SELECT *, ak = ck AS own FROM good WHERE alias NOT LIKE '%#%'), claims AS (SELECT ak, count(DISTINCT ck) AS n FROM al WHERE NOT own GROUP BY 1),
    cl AS (SELECT DISTINCT al.ck, ak, alias, CASE WHEN n > 1 THEN 'several targets' WHEN s.ck IS NOT NULL THEN 'is a canonical name' END AS problem FROM al JOIN claims USING (ak) LEFT JOIN shown s ON s.ck = ak WHERE NOT own),
    kept AS (SELECT ck, canonical AS alias FROM good UNION SELECT ck, alias FROM al WHERE own UNION SELECT ck, alias FROM cl WHERE problem IS NULL)
"""


def entries_of_customers(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    spelled = "CASE c_custkey % 3 WHEN 0 THEN 'Open ' WHEN 1 THEN 'OPEN-' ELSE 'open.  ' END || (c_custkey % 400)"
    other = """CASE WHEN c_custkey % 19 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN 'open_' || (c_custkey % 400 + 1) WHEN c_custkey % 11 = 0 THEN 'o.p.e.n' || (c_custkey % 400) WHEN c_custkey % 23 = 0 THEN 'bad ' || c_name
        ELSE CASE c_custkey % 2 WHEN 0 THEN 'GP ' ELSE 'gp' END || (c_custkey % 1300) END"""
    return registries.canonical_entries(c.select(F.expr(f"CASE WHEN c_custkey % 17 = 0 THEN c_name ELSE {spelled} END").alias("canonical"), F.expr(other).alias("alias"), F.col("c_nationkey").alias("priority")))


@query("canonical_entries", ENTRY_NAMES + "SELECT s.canonical, coalesce(string_agg(k.alias, '|' ORDER BY lower(k.alias), k.alias) FILTER (k.alias <> s.canonical), '') AS aliases FROM shown s JOIN kept k USING (ck) GROUP BY s.ck, s.canonical")
def canonical_entries(spark, sf_dir):
    return entries_of_customers(spark, sf_dir)[0].select("canonical", F.array_join("aliases", "|").alias("aliases"))


@query("entry_problems", ENTRY_NAMES + """SELECT canonical AS name, 'contains #' AS problem FROM n WHERE canonical LIKE '%#%' UNION SELECT alias, 'contains #' FROM n WHERE canonical NOT LIKE '%#%' AND alias LIKE '%#%'
    UNION SELECT name, problem FROM (SELECT arg_min(alias, (lower(alias), alias)) AS name, problem FROM cl WHERE problem IS NOT NULL GROUP BY ck, ak, problem)""")
def entry_problems(spark, sf_dir):
    return entries_of_customers(spark, sf_dir)[1]


DOCUMENT_SQL = r"""
    WITH p AS (SELECT l_orderkey AS k, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, 'Player, ' || l_partkey, l_quantity) AS n, l_linenumber AS rank, l_partkey AS part, l_quantity AS q, min(l_shipdate) OVER (PARTITION BY l_orderkey) AS day FROM lineitem),
    x AS (SELECT *, 'y="' || year(day) || '" m="' || month(day) || '" d="' || day(day) || '" iso="' || strftime(day, '%Y-%m-%d') || '"' AS date FROM p),
    b AS (SELECT k, any_value(date) AS date, any_value(day) AS day, string_agg('    <ctml:participant id="' || printf('p%04d', n) || '">
      <ctml:playerRef ref="player:syn:' || substr(sha1('player, ' || part || '|USA'), 1, 16) || '">
        <ctml:name display="Player, ' || part
        || '">
          <ctml:family>Player</ctml:family>
          <ctml:given>' || part || '</ctml:given>
        </ctml:name>
        <ctml:federation>USA</ctml:federation>
        <ctml:title>GM</ctml:title>
        <ctml:ids>
          <ctml:internalId>src-a:' || part
        || '</ctml:internalId>
        </ctml:ids>
        <ctml:resolution method="unresolved" resolver="src-a"/>
      </ctml:playerRef>
      <ctml:ratingSnapshot system="fide" scope="standard">
        <ctml:value>' || CAST(q AS BIGINT)
        || '</ctml:value>
        <ctml:asOf><ctml:day ' || date || '/></ctml:asOf>
      </ctml:ratingSnapshot>
      <ctml:seed>' || part || '</ctml:seed>
      <ctml:score>' || CAST(q AS BIGINT) || '.25</ctml:score>
      <ctml:notes>rank=' || rank || '</ctml:notes>
    </ctml:participant>', '
' ORDER BY n) AS people FROM x GROUP BY 1)
    SELECT 't_src_a_' || k || '_' || strftime(day, '%Y%m%d') AS id, k || '-open-' || k AS file_name, sha1('<?xml version="1.0" encoding="UTF-8"?>
<ctml:tournament xmlns:ctml="urn:ctml:2.0" ctmlVersion="2.0" id="t_src_a_' || k || '_' || strftime(day, '%Y%m%d') || '">
  <ctml:header>
    <ctml:name>Open &lt;' || k
        || '&gt;</ctml:name>
    <ctml:eventRef ref="event:' || k || '">
      <ctml:name>Open &lt;' || k || '&gt;</ctml:name>
    </ctml:eventRef>
    <ctml:eventType>swiss</ctml:eventType>
    <ctml:cadence>rapid</ctml:cadence>
    <ctml:dates>
      <ctml:start><ctml:day ' || date || '/></ctml:start>
      <ctml:end><ctml:day ' || date
        || '/></ctml:end>
    </ctml:dates>
    <ctml:placeRef ref="place:raw:' || substr(sha1('new york'), 1, 16) || '" kind="unknown">
      <ctml:name>New York</ctml:name>
      <ctml:country>USA</ctml:country>
    </ctml:placeRef>
  </ctml:header>
  <ctml:participants>
' || people
        || '
  </ctml:participants>
  <ctml:notes>a rapid one</ctml:notes>
  <ctml:source kind="src-a">
    <ctml:note>ref=' || k || '</ctml:note>
  </ctml:source>
</ctml:tournament>
') AS xml_sha1 FROM b
"""


@query("tournament_documents", DOCUMENT_SQL)
def tournament_documents(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    text_of = lambda v: F.lit(v).cast("string")
    player = F.struct(
        F.col("l_linenumber").cast("bigint").alias("rank"), F.concat(F.lit("Player, "), F.col("l_partkey").cast("string")).alias("name"), F.col("l_quantity").cast("bigint").alias("rating"), (F.col("l_quantity").cast("bigint") + 0.25).cast("double").alias("score"), F.lit("g").alias("title"), F.lit(" usa").alias("fed"),
        text_of(None).alias("fide_id"), F.col("l_partkey").cast("string").alias("seed"), text_of("x").alias("source_id"), text_of("").alias("sex"), text_of("").alias("club"), text_of("").alias("ref"))
    t = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(player)).alias("players"), F.min("l_shipdate").cast("date").cast("string").alias("start"))
    k = F.col("l_orderkey").cast("string")
    more = {"end": None, "place": " New  York", "country": "usa", "cadence": "fast", "notes": " a rapid one ", "rating_system": "fide", "url": None, "source_path": None, "classification": "individual", "reader": None, "format": "Swiss system", "source": "src-a"}
    t = t.select(F.col("l_orderkey").alias("ord"), F.concat(F.lit("Open <"), k, F.lit(">")).alias("event"), k.alias("ref"), F.concat(F.lit("event:"), k).alias("event_ref"), "start", "players", *(text_of(v).alias(c) for c, v in more.items()))
    return documents.tournament_documents(t).select("id", "file_name", F.sha1("xml").alias("xml_sha1"))


HEADINGS = "CASE c_custkey % 5 WHEN 1 THEN 'Events taking place in ' || c_mktsegment || ', Some (old) Region, Land (until 1918)' WHEN 2 THEN c_mktsegment WHEN 3 THEN ' A ,, B(x), C) ' WHEN 4 THEN '(' END"
PLACE_NAMES = "CASE WHEN c_custkey % 3 <> 0 THEN CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE ' ' || c_name || ' ' END END"


@query("location_parts", f"""WITH a AS (SELECT c_custkey, trim(coalesce({PLACE_NAMES}, '')) AS given, trim(coalesce({HEADINGS}, '')) AS h FROM customer),
    b AS (SELECT c_custkey, given, list_filter(list_transform(string_split(CASE WHEN starts_with(h, 'Events taking place in') THEN trim(substr(h, 23)) ELSE h END, ','), lambda s: trim(rtrim(trim(split_part(trim(s), '(', 1)), ')'))), lambda s: s <> '') AS parts FROM a),
    c AS (SELECT c_custkey, CASE WHEN given = '' AND len(parts) > 0 THEN parts[1] ELSE given END AS city, parts FROM b),
    d AS (SELECT *, CASE WHEN len(parts) > 0 AND parts[1] = city THEN parts[2:] ELSE parts END AS rest FROM c)
    SELECT c_custkey, city, CASE WHEN len(rest) > 1 THEN array_to_string(rest[1:len(rest) - 1], ', ') END AS region, CASE WHEN len(rest) > 0 THEN rest[len(rest)] WHEN len(parts) > 0 THEN parts[len(parts)] END AS country FROM d""")
def location_parts(spark, sf_dir):
    p = places.parse_location(F.expr(PLACE_NAMES), F.expr(HEADINGS))
    return table(spark, sf_dir, "customer").select("c_custkey", p.alias("p")).select("c_custkey", "p.city", "p.region", "p.country")


@query("whole_event_screening", f"""WITH r AS (SELECT l_orderkey AS k, count(*) AS players, min(r) AS least, max(r) AS most, count(*) FILTER (r IS NULL) AS missing, count(*) FILTER (r < 10) AS below FROM (SELECT l_orderkey, {RATING_SQL} AS r FROM lineitem WHERE l_linenumber <> 1) GROUP BY 1)
    SELECT o_orderkey, coalesce(players, 0) AS players, least, most, coalesce(missing, 0) AS missing, coalesce(below, 0) AS below, coalesce(missing = 0 AND below = 0, false) AS kept,
    CASE WHEN players IS NULL THEN 'no player rows' WHEN missing > 0 THEN missing || ' missing/unrated player ratings' WHEN below > 0 THEN below || ' player ratings below 10' ELSE 'all ' || players || ' player ratings >= 10' END AS reason FROM orders LEFT JOIN r ON k = o_orderkey""")
def whole_event_screening(spark, sf_dir):
    results = table(spark, sf_dir, "lineitem").filter("l_linenumber <> 1").select(F.col("l_orderkey").alias("o_orderkey"), F.expr(RATING_SQL).alias("r"))
    return rated.screened_events(table(spark, sf_dir, "orders").select("o_orderkey"), results, "o_orderkey", "r", 10)


PAIRED = "SELECT l_orderkey, l_linenumber AS n, CASE WHEN l_suppkey % 11 <> 0 THEN 'n' || l_suppkey % 13 END AS white, CASE WHEN l_partkey % 11 <> 0 THEN 'n' || l_partkey % 13 ELSE '' END AS black FROM lineitem"


@query("game_participants", f"""WITH g AS ({PAIRED}), s AS (SELECT l_orderkey, white AS name, n, 0 AS side FROM g UNION ALL SELECT l_orderkey, black, n, 1 FROM g),
    p AS (SELECT l_orderkey, name, 'p' || lpad(CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY min(n * 2 + side), name) AS VARCHAR), 4, '0') AS id FROM s WHERE name <> '' GROUP BY 1, 2)
    SELECT g.l_orderkey, g.n, CASE WHEN w.id <> b.id THEN w.id END AS white_id, CASE WHEN w.id <> b.id THEN b.id END AS black_id FROM g LEFT JOIN p w ON w.l_orderkey = g.l_orderkey AND w.name = g.white LEFT JOIN p b ON b.l_orderkey = g.l_orderkey AND b.name = g.black""")
def game_participants(spark, sf_dir):
    g = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").alias("n"), F.expr("CASE WHEN l_suppkey % 11 <> 0 THEN concat('n', l_suppkey % 13) END").alias("white"), F.expr("CASE WHEN l_partkey % 11 <> 0 THEN concat('n', l_partkey % 13) ELSE '' END").alias("black"))
    return rated.game_participants(g, ["l_orderkey"], "n")[1].select("l_orderkey", "n", "white_id", "black_id")


@query("link_index", r"""SELECT target, count(DISTINCT page_id) AS pages, min(page_id) AS least, max(page_id) AS most FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href="/([^"]*)"', 1)) AS target FROM pages) GROUP BY 1""")
def link_index(spark, sf_dir):
    found = tables.link_index(table(spark, sf_dir, "pages"), "page_id", "html", r'href="/([^"]*)"')
    return found.select("target", F.size("pages").cast("long").alias("pages"), F.array_min("pages").alias("least"), F.array_max("pages").alias("most"))


@query("site_matching", """WITH g AS (SELECT n_name AS spelling, n_nationkey AS k FROM nation UNION SELECT r_name, n_nationkey FROM nation JOIN region ON r_regionkey = n_regionkey UNION SELECT n_name || ', ' || r_name, n_nationkey FROM nation JOIN region ON r_regionkey = n_regionkey),
    i AS (SELECT lower(translate(spelling, '., -_()', '')) AS skey, count(DISTINCT k) AS n, min(k) AS k FROM g GROUP BY 1),
    s AS (SELECT DISTINCT trim(regexp_replace(x, '[ ]+', ' ', 'g')) AS site FROM (SELECT replace(n_name, '_', ' - ') AS x FROM nation UNION ALL SELECT lower(r_name) FROM region UNION ALL SELECT c_mktsegment FROM customer UNION ALL SELECT * FROM (VALUES ('Online'), ('http://a.b'), ('#x'), ('@x'), (' '), ('?'))))
    SELECT site, coalesce(n, 0) AS candidates, CASE WHEN site LIKE '%#%' OR substr(site, 1, 1) IN ('@', '%', '=', '>') THEN 'unusable' WHEN lower(site) IN ('?', 'unknown', 'n/a', 'online') OR site LIKE '%://%' THEN 'not a place' WHEN n = 1 THEN 'matched' WHEN n > 1 THEN 'ambiguous' ELSE 'standalone' END AS verdict
    FROM s LEFT JOIN i ON skey = lower(translate(site, '., -_()', '')) WHERE site <> ''""")
def site_matching(spark, sf_dir):
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    p = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").cast("string").alias("ref"), F.col("n_name").alias("name"), F.col("n_nationkey").cast("string").alias("country"), F.lit(0).alias("priority"), F.array("r_name", F.concat_ws(", ", "n_name", "r_name")).alias("aliases"))
    named = n.select(F.replace("n_name", F.lit("_"), F.lit(" - ")).alias("site")).unionAll(r.select(F.lower("r_name"))).unionAll(table(spark, sf_dir, "customer").select("c_mktsegment"))
    odd = spark.createDataFrame([("Online",), ("http://a.b",), ("#x",), ("@x",), (" ",), ("?",)], "site string")
    return places.matched_sites(named.unionAll(odd), places.place_groups(p)).select("site", F.col("candidates").cast("long").alias("candidates"), "verdict")


@query("local_paths", r"""WITH a AS (SELECT page_id, url, regexp_extract(url, '[?]([^#]*)', 1) AS q, list_filter(string_split(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '/'), lambda s: s <> '') AS p FROM pages),
    b AS (SELECT page_id, url, q, p[1:len(p) - 1] AS folders, CASE WHEN len(p) = 0 THEN 'index.html' WHEN contains(p[len(p)], '.') THEN p[len(p)] ELSE p[len(p)] || '.html' END AS file FROM a)
    SELECT page_id, array_to_string(list_concat(['html', lower(regexp_extract(url, '://([^/?#]*)', 1))], list_concat(folders, [CASE WHEN q = '' THEN file ELSE regexp_extract(file, '^(.*)[.][^.]*$', 1) || '-' || substr(sha1(q), 1, 10) || regexp_extract(file, '[.][^.]*$') END])), '/') AS path FROM b""")
def local_paths(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", paths.local_path(F.col("url")).alias("path"))
