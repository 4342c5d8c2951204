"""Positions, moves and games in plain Python: what the Arrow-batched game operators run."""
