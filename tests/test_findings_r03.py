"""Cases in which queries differed from their SQL or grew out of bounds."""

import json
import random

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Row
from pyspark.sql import functions as F

from castellan.operators import clustering, documents
from castellan.plans import contract, curating
from castellan.sources.games import merge_games

SF = "/root/testdata/sf0.001"


def test_level_lines_go_as_they_lie_in_the_file(spark, tmp_path):
    n = 4000
    lines = {"l_orderkey": [i // 2 for i in range(n)], "l_linenumber": [1] * n, "l_partkey": [7] * n, "l_discount": [0.05] * n, "l_returnflag": [("R", "A", "N")[i % 3] for i in range(n)]}
    pq.write_table(pa.table(lines).cast(pa.schema([("l_orderkey", "int64"), ("l_linenumber", "int32"), ("l_partkey", "int64"), ("l_discount", "double"), ("l_returnflag", "string")])), tmp_path / "lineitem.parquet", row_group_size=500)
    con = duckdb.connect(config={"threads": 1})
    con.sql(f"create view lineitem as select * from '{tmp_path}/lineitem.parquet'")
    want = con.sql(contract.ORACLES["merge_first_non_null"]).fetchall()
    got = contract.QUERIES["merge_first_non_null"](spark, str(tmp_path)).collect()
    assert len(want) == n // 2 and sorted(map(tuple, got)) == sorted(want)


def test_names_meet_only_where_enough_words_can_be_common(spark):
    """Names of words that all are frequent: all pairs that share 0.829 of the words of both meet, and of up to ten words no others do."""
    rnd = random.Random(5)
    vocabulary = [f"w{i}" for i in range(16)]
    keys = sorted({" ".join(rnd.sample(vocabulary[: max(n, 8)], n)) for n in range(1, 15) for _ in range(60)})
    keys += [f"{k} {rnd.choice(vocabulary)}" for k in keys[::3]]
    words = [(1990, "city", k, sorted(set(k.split()), key=lambda w: (vocabulary.index(w) * 7) % 16)) for k in sorted(set(keys))]
    m = clustering._met_by_words(spark.createDataFrame(words, "year int, block string, key string, words array<string>"), 0.29 / 0.35)
    x, y = m.filter("n = fewer").alias("x"), m.filter("n = more").alias("y")
    same = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("year", "block", "fewer", "more", "word")]
    met = {tuple(sorted(r)) for r in x.join(y, same).filter("x.key <> y.key").select("x.key", "y.key").collect()}
    sets = {k: set(w) for _, _, k, w in words}
    alike = {(k, l) for k in sets for l in sets if k < l and len(sets[k] & sets[l]) / len(sets[k] | sets[l]) >= 0.29 / 0.35}
    assert len(alike) > 100 and alike <= met
    assert {(k, l) for k, l in met if max(len(sets[k]), len(sets[l])) <= 10} == {(k, l) for k, l in alike if max(len(sets[k]), len(sets[l])) <= 10}


def test_more_crosstables_make_more_files(spark, tmp_path, monkeypatch):
    """Every file is one array, none far beyond the lines that a file should have."""
    monkeypatch.setattr(curating, "LINES_A_FILE", 100)
    monkeypatch.setattr(curating, "new_path", lambda spark, name: f"{tmp_path}/{name}")
    assert curating.crosstable_files(spark, SF).count() > 0
    files = [json.loads(f.read_text()) for f in tmp_path.glob("crosstables/*/*.txt")]
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    assert len(files) > 50 and max(sum(len(t["players"]) for t in f) for f in files) < 300
    assert sum(map(len, files)) == lines.select("l_orderkey").distinct().count()


def test_games_of_one_slot_are_not_paired(spark):
    """Slots are looked up, games are not joined with games: a crowded slot costs no more than its games."""
    old = spark.createDataFrame([("a", "1", "x"), ("a", "1", "y"), ("a", "1", None), ("b", "1", None)], "event string, round string, trajectory_fp string")
    new = spark.createDataFrame([("a", "1", "x"), ("a", "1", "z"), ("a", "1", "z"), ("a", "1", None), ("b", "1", "x"), ("c", "1", "x"), ("c", "1", "x"), (None, "1", "x")], "event string, round string, trajectory_fp string")
    added, diverging = merge_games(old, new, ["event", "round"])
    assert sorted(map(str, added.collect())) == sorted(map(str, [Row(event="c", round="1", trajectory_fp="x"), Row(event=None, round="1", trajectory_fp="x")]))
    assert [tuple(r) for r in diverging.collect()] == [("a", "1", "z")]
    plan = diverging._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and "LeftAnti" in plan and "Inner" not in plan


def test_values_bound_are_computed_once(spark):
    """A plan of a participant holds each of its white-space rules a few times, not once for each use of what they give."""
    text_of = lambda v: F.lit(v).cast("string")
    fields = {"rank": F.lit(1).cast("bigint"), "name": text_of(" De  Vries,  Jan Piet III"), "rating": F.lit(2000).cast("bigint"), "score": F.lit(1.5), "title": text_of("g"), "fed": text_of(" usa"), "fide_id": text_of(None), "seed": text_of("3"), "source_id": text_of("x"), "sex": text_of(""), "club": text_of(""), "ref": text_of("")}
    one = spark.range(1).select(F.struct(*[v.alias(n) for n, v in fields.items()]).alias("p"))
    made = documents.participant_element(F.col("p"), F.lit(1), text_of("fide"), text_of("<day/>"), text_of("s"), text_of(None), text_of("r"))
    df = one.select(made.alias("xml"))
    assert df._jdf.queryExecution().analyzed().toString().count(r"(?U)\\s+") < 20
    xml = df.first().xml
    assert "<ctml:family>De Vries</ctml:family>" in xml and "<ctml:given>Piet</ctml:given>" in xml and "<ctml:suffix>III</ctml:suffix>" in xml and "<ctml:title>GM</ctml:title>" in xml and "<ctml:federation>USA</ctml:federation>" in xml


def _joined(df) -> int:
    """Rows that the last join of a query gave when it ran."""
    node = df._jdf.queryExecution().executedPlan().executedPlan()
    while "Join" not in node.nodeName():
        node = node.plan() if "QueryStage" in node.nodeName() else node.children().head()
    return node.metrics().apply("numOutputRows").value()


def test_keys_are_scored_once_and_not_for_each_pair(spark, tmp_path):
    n = 400
    parts = {"p_partkey": list(range(0, 3 * n, 3)), "p_name": [f"red {('ring', 'bolt')[i % 2]}" for i in range(n)], "p_type": [("LARGE", "SMALL", "Ring", "RED")[i % 8 // 2] for i in range(n)], "p_size": [7] * (n - 9) + [8] * 8 + [None]}
    pq.write_table(pa.table(parts).cast(pa.schema([("p_partkey", "int64"), ("p_name", "string"), ("p_type", "string"), ("p_size", "int32")])), tmp_path / "part.parquet")
    con = duckdb.connect()
    con.sql(f"create view part as select * from '{tmp_path}/part.parquet'")
    want = con.sql(contract.ORACLES["token_jaccard_pairs"]).fetchall()
    df = contract.QUERIES["token_jaccard_pairs"](spark, str(tmp_path))
    got = [tuple(r) for r in df.collect()]
    assert len(got) == 391 * 390 // 2 + 8 * 7 // 2 and sorted(map(str, got)) == sorted(map(str, want))
    assert _joined(df) < 1000


def test_pairs_of_sliced_blocks_are_whole(spark, monkeypatch):
    """Blocks of many slices, keys of many pieces, null and empty keys, ids that occur twice: the pairs of brute force."""
    monkeypatch.setattr(clustering, "SLICE", 16)
    monkeypatch.setattr(clustering, "PIECE", 3)
    monkeypatch.setattr(clustering, "PAIRS_A_TASK", 1000)
    rnd = random.Random(7)
    rows = [(i, rnd.choice("aab"), rnd.choice(["x", "x", "x y", "", None, f"k{i}"])) for i in [*range(150), 5, 5, 77]] + [(900, None, "x"), (901, None, "x"), (902, "alone", "x")]
    records = spark.createDataFrame(rows, "id bigint, block string, key string")
    got = clustering.scored_pairs(records, ["block"], "id", "key", lambda x, y: F.length(x) + F.length(y), "score").collect()
    size = lambda k, l: None if k is None or l is None else len(k) + len(l)
    want = [(i, j, size(k, l)) for i, b, k in rows for j, c, l in rows if b is not None and b == c and i < j]
    assert len(want) > 5000 and sorted(map(str, map(tuple, got))) == sorted(map(str, want))
