"""Algebraic notation and game text."""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

from castellan.chess.position import FILES, PAWN, PIECES, Move, Position, square_of, squares, uci

SAN = re.compile(r"^(?:(?P<castle>[O0]-[O0](?P<long>-[O0])?)|(?P<piece>[NBRQK])?(?P<file>[a-h])?(?P<rank>[1-8])?x?(?P<to>[a-h][1-8])(?:=?(?P<promotion>[NBRQ]))?)$")
RESULTS = ("1-0", "0-1", "1/2-1/2", "*")
TAG = re.compile(r'\[\s*(\w+)\s+"((?:[^"\\]|\\.)*)"[^\]]*\]')
TOKEN = re.compile(r"\{[^}]*\}|;[^\n]*|\$\d+|[()]|\d+\.(?:\.\.)?|\.+|[^\s(){};$.]+")


class SanError(ValueError):
    """What is wrong with a move: not a move, no legal move or ambiguous."""


def resolve(position: Position, san: str) -> Move:
    """The one legal move that a text names. Only the pieces of its kind that go to its square are tried for legality."""
    m = SAN.match(san.rstrip("+#!?"))
    if not m:
        raise SanError(f"not a move: {san}")
    if m["castle"]:
        home = 4 if position.white else 60
        to = home + (-2 if m["long"] else 2)
        fits = [(home, to, "")] if position.castles() >> to & 1 else []
    else:
        kind, to, promotion = PIECES.index(m["piece"] or "P"), square_of(m["to"]), (m["promotion"] or "").lower()
        asked = (kind == PAWN and to // 8 in (0, 7)) == bool(promotion)
        fits = [
            (q, to, promotion) for q in squares(position.movers(kind, to) if asked else 0)
            if (not m["file"] or FILES[q % 8] == m["file"]) and (not m["rank"] or q // 8 + 1 == int(m["rank"]))
        ]
    legal = [c for c in fits if not position.after(c).in_check(position.white)]
    if len(legal) != 1:
        raise SanError(f"{'ambiguous' if legal else 'no legal move'}: {san}")
    return legal[0]


def parse_game(text: str) -> tuple[dict[str, str], list[str], str]:
    """Tags, main-line moves and result of one game; comments, glyphs and variations are left out, the last of a repeated tag counts."""
    tags: dict[str, str] = {}
    at = 0
    while m := re.compile(r"\s*").match(text, at):
        at = m.end()
        if not text.startswith("[", at):
            break
        if t := TAG.match(text, at):
            tags[t[1]] = re.sub(r"\\(.)", r"\1", t[2])
            at = t.end()
        else:
            close = text.find("]", at)
            at = len(text) if close < 0 else close + 1
    moves, result, depth = [], "*", 0
    for m in TOKEN.finditer(text, at):
        token = m[0]
        if token == "(":
            depth += 1
        elif token == ")":
            depth = max(0, depth - 1)
        elif depth or token[0] in "{;$." or re.fullmatch(r"\d+\.+", token):
            continue
        elif token in RESULTS:
            result = token
            break
        elif move := token.rstrip("+#!?"):
            moves.append(move)
    return tags, moves, result


@functools.lru_cache(maxsize=1 << 14)
def step(position: Position, san: str) -> tuple[str, Position]:
    """A move and the position after it. Games share openings, so the latest answers are remembered, by position and text."""
    move = resolve(position, san)
    return uci(move), position.after(move)


def play(sans: list[str], fen: str | None = None) -> Iterator[tuple[str, Position]]:
    """("", start), then each move and the position after it."""
    p = Position.from_fen(fen) if fen else Position.from_fen()
    yield "", p
    for san in sans:
        move, p = step(p, san)
        yield move, p
