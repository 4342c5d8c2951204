"""Spans of long texts beyond ASCII: positions in code points, in time linear in the text."""

import time

from castellan.llm import secrets


def test_positions_and_time():
    a = secrets.automaton()
    took = []
    for n in (4_000, 32_000):
        piece = "é\U0001f600 password = s3cr3t{:06d}ß\n"
        text = "".join(piece.format(i) for i in range(n))
        began = time.time()
        spans = secrets.spans_of(text, a)
        took.append(time.time() - began)
        assert len(spans) == n and all(text[s:e] == f"password = s3cr3t{i:06d}" for i, (s, e, _) in enumerate(spans))
    assert took[1] < 24 * took[0] + 0.3
