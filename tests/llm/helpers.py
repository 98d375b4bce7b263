"""Small fixtures and brute-force versions."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, source)."""
    return spark.createDataFrame([(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows], DOCS)


def words(seed: int, n: int) -> list[str]:
    import random
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghij") for _ in range(r.randint(3, 8))) for _ in range(n)]
