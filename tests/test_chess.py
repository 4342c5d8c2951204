import hashlib
import os
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from castellan.chess.hashing import derived_keys, fingerprints, position_hash, read_keys
from castellan.chess.notation import SanError, parse_game, play, resolve
from castellan.chess.position import START, Position, perft, uci
from castellan.operators import moves
from castellan.plans.contract import COUNTED

KIWIPETE = "r3k2r/p1ppqpb1/bn2pnp1/3PN3/1p2P3/2N2Q1p/PPPBBPPP/R3K2R w KQkq - 0 1"
ENDGAME = "8/2p5/3p4/KP5r/1R3p1k/8/4P1P1/8 w - - 0 1"
PROMOTIONS = "r3k2r/Pppp1ppp/1b3nbN/nP6/BBP1P3/q4N2/Pp1P2PP/R2Q1RK1 w kq - 0 1"


@pytest.mark.parametrize(("fen", "counts"), [(START, (20, 400, 8902)), (KIWIPETE, (48, 2039)), (ENDGAME, (14, 191, 2812)), (PROMOTIONS, (6, 264, 9467))])
def test_move_counts(fen, counts):
    assert tuple(perft(Position.from_fen(fen), d + 1) for d in range(len(counts))) == counts


def test_fen_round_trip():
    for fen in (START, KIWIPETE, ENDGAME):
        assert Position.from_fen(fen).fen() == " ".join(fen.split()[:4])
    with pytest.raises(ValueError):
        Position.from_fen("9/8/8/8/8/8/8/8 w - -")


def test_san():
    p = Position.from_fen()
    assert uci(resolve(p, "Nf3!?")) == "g1f3"
    with pytest.raises(SanError, match="no legal move"):
        resolve(p, "Ke2")
    with pytest.raises(SanError, match="ambiguous"):
        resolve(Position.from_fen("4k3/8/8/8/8/8/8/R3K2R w - -").after((4, 12, "")).after((60, 52, "")), "Rd1")
    with pytest.raises(SanError, match="not a move"):
        resolve(p, "1-0x")
    assert [u for u, _ in play("e4 e5 Nf3 Nc6 Bb5 a6 O-O".split())][-1] == "e1g1"


def test_game_text():
    tags, moves, result = parse_game('[Event "A \\"B\\""]\n[Round "1"]\n[Round "2"]\n\n1. e4 {best} e5 (1... c5 2. Nf3 (2. c3)) 2. Nf3+ $1 Nc6 ; note\n3.Bb5 a6# 1/2-1/2')
    assert tags == {"Event": 'A "B"', "Round": "2"}
    assert (moves, result) == (["e4", "e5", "Nf3", "Nc6", "Bb5", "a6"], "1/2-1/2")


def test_hashes():
    keys = derived_keys()
    assert read_keys("\n".join(f"0x{k:016X}," for k in keys)) == keys
    one, other = ([p for _, p in play(m.split())] for m in ("Nf3 Nf6 Nc3 Nc6", "Nc3 Nc6 Nf3 Nf6"))
    a, b = fingerprints(one, keys), fingerprints(other, keys)
    assert a[1] == b[1] and a[0] != b[0]  # one endpoint by two ways
    # an en passant square that no pawn can use does not count
    assert position_hash(Position.from_fen("4k3/8/8/8/4P3/8/8/4K3 b - e3"), keys) == position_hash(Position.from_fen("4k3/8/8/8/4P3/8/8/4K3 b - -"), keys)
    assert position_hash(Position.from_fen("4k3/8/8/8/3pP3/8/8/4K3 b - e3"), keys) != position_hash(Position.from_fen("4k3/8/8/8/3pP3/8/8/4K3 b - -"), keys)


@pytest.mark.parametrize(("fen", "depth", "nodes"), [(f, d, n) for f, d, n in COUNTED if n < 100_000])
def test_published_counts(fen, depth, nodes):
    assert perft(Position.from_fen(fen), depth) == nodes


def test_legal_moves_are_the_candidates_that_leave_no_check():
    chance = random.Random(5)
    for _ in range(30):
        p = Position.from_fen(chance.choice((START, KIWIPETE, ENDGAME, PROMOTIONS)))
        for _ in range(60):
            moves = p.legal()
            assert sorted(moves) == sorted(m for m in p.candidates() if not p.after(m).in_check(p.white))
            assert p.count() == len(moves)
            if not moves:
                break
            p = p.after(chance.choice(moves))
            assert Position.from_fen(p.fen()) == p


# Published fingerprints of moves under the 781 published keys, in the order they were published.
PUBLISHED = (
    ("", "89dffe8f5406d6237e8428fc8a89912f97175c7b72d3282aa4216868247cfbae", "463b96181691fc9c"),
    ("e2e4", "f4caae704c166a7e30380f4ade3a580e72218d6429885435fed80e08fdede0d1", "823c9b50fd114196"),
    ("e2e4 e7e5", "64ad2d50921adf0d62d0dfdf76b5625379628b34e60a86e40e5605fac6742fab", "0844931a6ef4b9a0"),
    ("c2c4 e7e5 b1c3", "bc9bc142c93f4c34ce5097cd09315da7e20173ef3aa052e2267b4908be818d3b", "bbf719d404992d74"),
    ("b1c3 e7e5 c2c4", "e386f8ee8bbf00145718d9b07d3276f3445e91db6771c6f8712460a2280695c4", "bbf719d404992d74"),
    ("e2e4 e7e5 f1c4 b8c6 d1h5 g8f6 h5f7", "1b94d3d89d69e839e0338b20c40e71b461ac347d501ebe929408ab2a90037129", "c3116e611017a62f"),
    ("e2e4 e7e5 g1f3 b8c6 f1c4 f8c5 e1g1", "968f46864648853b6831143e240bdf3718e2d55b0ae5b287941a3e22125eae5a", "c8162c4989019aab"),
    ("d2d4 d7d5 b1c3 b8c6 c1f4 c8f5 d1d2 d8d7 e1c1", "d7c881a8e5d62ba68e04b7d0c0d702b0895ec948b3872e6b1a2cf33daecc5cdd", "03f59b930d475ebb"),
    ("e2e4 a7a6 e4e5 d7d5 e5d6", "9d14f71fcfdd1044f7bd07354edf75d7f05bb04d59ebcccefbe915e86d0ff209", "49d76e2d212d595c"),
    ("a2a4 h7h5 a4a5 h5h4 a5a6 h4h3 a6b7 h3g2 b7a8q g2h1q", "f2080091bc06fa8692cdd55a15d5035f286e6f70d23fbf9643638962b40701b9", "e23dff4ec4e43cdd"),
)


@pytest.mark.skipif("POSITION_KEYS" not in os.environ, reason="POSITION_KEYS names a text file with the 781 published keys")
@pytest.mark.parametrize(("moves", "trajectory", "final"), PUBLISHED)
def test_published_fingerprints(moves, trajectory, final):
    steps = [Position.from_fen()]
    for move in moves.split():
        steps.append(steps[-1].push_uci(move))
    assert fingerprints(steps, read_keys(Path(os.environ["POSITION_KEYS"]).read_text())) == (trajectory, final)


def test_hash_by_differences_equals_hash_from_scratch():
    keys, chance = derived_keys(), random.Random(6)
    steps = [Position.from_fen(KIWIPETE)]
    while len(steps) < 60 and (moves := steps[-1].legal()):
        steps.append(steps[-1].after(chance.choice(moves)))
    assert fingerprints(steps, keys) == (hashlib.sha256(b"".join(position_hash(p, keys).to_bytes(8, "big") for p in steps)).hexdigest(), f"{position_hash(steps[-1], keys):016x}")


def test_move_tables(spark):
    df = spark.createDataFrame([(1, START), (2, None), (3, "nonsense"), (4, "7k/5Q2/6K1/8/8/8/8/8 b - - 0 1"), (5, "4k3/8/8/8/8/8/4r3/4K2R w K - 0 1")], "uci long, fen string")
    df = df.withColumnRenamed("uci", "id")
    assert {r.id: r["count"] for r in moves.legal_moves(df, "fen").groupBy("id").count().collect()} == {1: 20, 5: 3}
    assert {r.id: r["count"] for r in moves.pseudo_legal_moves(df, "fen").groupBy("id").count().collect()} == {1: 20, 4: 3, 5: 14}
    named = {r.id: (r.uci, r.error) for r in moves.resolved(df.withColumn("san", F.lit("Nf3")), "fen", "san").collect()}
    assert named[1] == ("g1f3", None) and named[5] == (None, "no legal move: Nf3") and named[2][0] is None and named[2][1]
    text = spark.createDataFrame([(1, "1. e4 (1. d4) e5 {x} 2. Nf3 *"), (2, None), (3, "")], "id int, game string")
    assert sorted((r.id, r.ply, r.san) for r in moves.mainline(text, "game").collect()) == [(1, 1, "e4"), (1, 2, "e5"), (1, 3, "Nf3")]
    deep = spark.createDataFrame([(START, 4), (START, 0), (START, 1), ("7k/5Q2/6K1/8/8/8/8/8 b - - 0 1", 3), (START, 4)], "fen string, depth int")
    assert {(r.fen, r.depth): r.nodes for r in moves.move_counts(deep, "fen", "depth").collect()} == {(START, 4): 197281, (START, 0): 1, (START, 1): 20, ("7k/5Q2/6K1/8/8/8/8/8 b - - 0 1", 3): 0}
