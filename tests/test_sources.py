import json
import zipfile

from castellan.chess.hashing import derived_keys
from castellan.sources.gamefiles import read_games
from castellan.sources.games import headers, merge_games, playable, replayed
from castellan.sources.registry import count_records, read_crosstables, read_openings, read_places, read_sheets

GAMES = """[Event "Open"]
[Date "1994.07.??"]
[White "Ann"]
[Black "Bob"]
[WhiteElo "2400"]
[Result "1-0"]

1. e4 e5 2. Nf3 1-0

[Event "Open"]
[White "Cid"]
[Black "Cid"]
[Result "?"]

1. d4 d5 0-1

[Event "Bad"]
[White "Eve"]
[Black "Fay"]

1. e4 e4 *
"""


def test_games(spark, tmp_path):
    (tmp_path / "g.pgn").write_text(GAMES)
    g = headers(replayed(read_games(spark, str(tmp_path / "g.pgn")), derived_keys())).cache()
    rows = {r.white: r for r in g.collect()}
    assert rows["Ann"].ucis == ["e2e4", "e7e5", "g1f3"] and rows["Ann"].white_elo == 2400 and rows["Ann"].result == "1-0" and tuple(rows["Ann"].date) == (1994, 7, None)
    assert rows["Cid"].result == "*" and "no legal move" in rows["Eve"].error and rows["Eve"].trajectory_fp is None
    assert sorted(r.white for r in playable(g).collect()) == ["Ann", "Eve"]
    added, diverging = merge_games(g.filter("white = 'Ann'"), g.filter("white <> 'Eve'"), ["event", "white", "black"])
    assert [r.white for r in added.collect()] == ["Cid"] and diverging.count() == 0


def test_registries(spark, tmp_path):
    (tmp_path / "o.tsv").write_text('eco\tname\tpgn\tuci\tepd\nA00\t"Odd"\t1. a3\ta2a3\tx\n')
    assert read_openings(spark, str(tmp_path / "o.tsv")).first().name == '"Odd"'
    place = '<ctml:place ref="place:city:{0}" kind="city"><ctml:name>Town {0}</ctml:name><ctml:parentRef>place:country:ABW</ctml:parentRef><ctml:latitude>12.5</ctml:latitude></ctml:place>'
    for i in (1, 2):
        (tmp_path / f"places-{i}.xml").write_text(f'<ctml:places xmlns:ctml="urn:x">{place.format(i)}{place.format(i + 10)}</ctml:places>')
    assert sorted(r.name for r in read_places(spark, str(tmp_path / "places-*.xml")).collect()) == ["Town 1", "Town 11", "Town 12", "Town 2"]
    assert tuple(count_records(spark, str(tmp_path / "places-*.xml"), "ctml:place").first()) == (4, 2)
    (tmp_path / "c.json").write_text(json.dumps([{"event": "E", "format": "swiss", "players": [{"name": "A", "seed": 7, "score": 2.5}, {"name": "B", "seed": "7"}]}]))
    assert [p.seed for p in read_crosstables(spark, str(tmp_path / "c.json")).first().players] == ["7", "7"]
    with zipfile.ZipFile(tmp_path / "s.xlsx", "w") as z:
        ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>Name</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="C1"><v>5</v></c></row></sheetData></worksheet>')
    assert read_sheets(spark, str(tmp_path / "s.xlsx")).first().cells == ["Name", "", "5"]
