"""Game files: the same games with the same numbers at any split size, line end and blank line."""

import random

import pytest

from castellan.sources.gamefiles import by_result, read_games, zipped


def made(n, seed):
    """Games as text, some over several lines, with comments that look like tags or results, without moves or without blank lines."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        tags = [f'[Event "E {i}"]', f'[White "A [{i}] \\"x\\" 1-0"]', '[ Result "*"]'][: rnd.randint(1, 3)]
        moves = rnd.choice([["1. e4 e5 2. Nf3", "Nc6 1-0"], ["1. d4 {a 1-0 b", "[%clk 0:01] } d5 (1... Nf6 *", "2. c4) 2. c4 1/2-1/2"], ["1. e4", "", "e5 ; end 0-1 not", "*"], ["*"], ["1. a3 0-1 "]])
        gap = rnd.choice([[""], [], ["", ""]])
        out.append([*tags, *gap, *moves, *rnd.choice([[""], [], ["", " "]])])
    return out


def plain(lines):
    return "\n".join(x.rstrip("\r") for x in lines).strip()


@pytest.mark.parametrize(("split", "end"), [("128m", "\n"), ("100", "\n"), ("333", "\r\n")])
def test_games_at_any_split(spark, tmp_path, split, end):
    games = made(30, 7)
    (tmp_path / "a.pgn").write_bytes(end.join(x for g in games for x in g).encode())
    (tmp_path / "b.pgn").write_bytes(end.join(games[3]).encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = read_games(spark, f"file://{tmp_path}/*.pgn").collect()
        a = sorted((r.game_no, r.game) for r in got if r.file.endswith("a.pgn"))
        assert a == [(i + 1, plain(g)) for i, g in enumerate(games)]
        assert [(r.game_no, r.game) for r in got if r.file.endswith("b.pgn")] == [(1, plain(games[3]))]
        some = read_games(spark, f"file://{tmp_path}/a.pgn", skip=11, limit=5).collect()
        assert sorted((r.game_no, r.game) for r in some) == a[11:16]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_moves_after_a_result_are_another_game(spark, tmp_path):
    text = '[Event "x"]\n\n1. e4 {0-1} 1-0 1. d4 (1. c4 *) d5 0-1\n\n1. a3 *\n[Event "y"]\n*\n'
    (tmp_path / "a.pgn").write_text(text)
    got = read_games(spark, f"file://{tmp_path}/a.pgn").orderBy("game_no").collect()
    assert [r.game for r in got] == ['[Event "x"]\n\n1. e4 {0-1} 1-0', "1. d4 (1. c4 *) d5 0-1", "1. a3 *", '[Event "y"]\n*']
    assert by_result("1. e4 e5") == ["1. e4 e5"] and by_result(" \n") == []


def test_zip_by_position(spark, tmp_path):
    (tmp_path / "a.pgn").write_text("\n".join(x for g in made(4, 1) for x in g))
    want = spark.createDataFrame([(1, "m1"), (3, "m3"), (6, "m6")], "game_no bigint, moves string")
    got = zipped(read_games(spark, f"file://{tmp_path}/a.pgn").select("game_no", "game"), want).orderBy("game_no").collect()
    assert [(r.game_no, r.game is not None, r.r_moves) for r in got] == [(1, True, "m1"), (2, True, None), (3, True, "m3"), (4, True, None), (6, False, "m6")]


def test_empty_files(spark, tmp_path):
    (tmp_path / "a.pgn").write_text("\n \n")
    assert read_games(spark, f"file://{tmp_path}/a.pgn").count() == 0
