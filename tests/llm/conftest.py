import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

#: Columns that clash with names the operators use inside.
EXTRA = ("_text", "key", "n", "size", "score", "label", "rank", "block", "part", "word", "times", "target")
SCHEMA = "doc_id long, text string, lang string, source string, " + ", ".join(f"`{c}` string" for c in EXTRA)


@pytest.fixture(scope="session")
def documents(spark):
    """Make a table from (doc_id, text, lang, source) rows, with clashing extra columns."""

    def make(rows):
        full = [(*r, *[None] * (4 - len(r)), *["x"] * len(EXTRA)) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(3)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Null, empty, short and very long texts, copies, edited copies, repeated rows, null ids."""
    rng = random.Random(4)
    vocabulary = ["".join(rng.choices("abcdeé", k=rng.randint(1, 6))) for _ in range(400)]
    text = lambda n: " ".join(rng.choices(vocabulary, k=n))
    passage = text(40)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one Two"), (5, "ONE two"), (6, "one two three four five"), (None, "one two")]
    base = text(120)
    rows += [(10, base), (11, base.upper().replace("É", "é")), (12, base), (None, base), (12, base)]
    for i in range(13, 40):
        words = base.split()
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    rows += [(i, f"{text(30)} {passage}\n{text(rng.randint(0, 60))}") for i in range(40, 70)]
    rows += [(70, text(30_000)), (71, "x" * 200_000 + " y"), (70, text(20))]
    return [(i, t, "en", rng.choice(["a", "b", None])) for i, t in rows]

