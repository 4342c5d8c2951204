"""Position hashes and game fingerprints.

The 781 random keys are a parameter: 768 for pieces on squares, four castling rights, eight en passant files, White to move. Two parties that
compare fingerprints must use one table; read_keys takes it from any text that lists it in hexadecimal."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence

from castellan.chess.position import PAWN, PAWN_HITS, Position, squares

KEYS = 781


def read_keys(text: str) -> list[int]:
    """All 16-digit hexadecimal numbers of a text, which must be 781."""
    keys = [int(x, 16) for x in re.findall(r"0[xX]([0-9A-Fa-f]{16})\b", text.replace("_", ""))]
    if len(keys) != KEYS:
        raise ValueError(f"{len(keys)} keys, not {KEYS}")
    return keys


def derived_keys(seed: int = 1) -> list[int]:
    """A table by rule, for uses that compare with nobody: the first eight bytes of SHA-256 of seed and number."""
    return [int.from_bytes(hashlib.sha256(f"{seed}:{i}".encode()).digest()[:8], "big") for i in range(KEYS)]


def placement(before: tuple[int, ...], after: tuple[int, ...], keys: Sequence[int]) -> int:
    """The exclusive or of the keys of all pieces on squares that differ between two placements of twelve sets."""
    h = 0
    for i, (a, b) in enumerate(zip(before, after)):
        for q in squares(a ^ b) if a != b else ():
            h ^= keys[64 * i + q]
    return h


def by_key(p: Position) -> tuple[int, ...]:
    """The twelve sets in the order of the keys: black, then white pawns, and so on by kind."""
    white, black = p.sides
    return tuple(k & side for k in p.kinds for side in (black, white))


def state(p: Position, keys: Sequence[int]) -> int:
    """Rights, side and en passant file. The file counts only if a pawn stands ready to take."""
    h = keys[780] if p.white else 0
    for i, right in enumerate("KQkq" if p.castling else ""):
        if right in p.castling:
            h ^= keys[768 + i]
    if p.ep is not None and PAWN_HITS[p.white][p.ep] & p.kinds[PAWN] & p.sides[not p.white]:
        h ^= keys[772 + p.ep % 8]
    return h


def position_hash(p: Position, keys: Sequence[int]) -> int:
    """The exclusive or of a position's keys."""
    return placement((0,) * 12, by_key(p), keys) ^ state(p, keys)


def fingerprints(positions: Sequence[Position], keys: Sequence[int]) -> tuple[str, str]:
    """Of the whole trajectory, start included (this alone may dedup games), and of the final position.

    Only the squares that change from one position to the next are hashed anew."""
    packed, before, h = [], (0,) * 12, 0
    for p in positions:
        now = by_key(p)
        h ^= placement(before, now, keys)
        before = now
        packed.append((h ^ state(p, keys)).to_bytes(8, "big"))
    return hashlib.sha256(b"".join(packed)).hexdigest(), packed[-1].hex()
