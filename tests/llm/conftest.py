import random

import pytest

WORDS = ("the of and river stone cloud market paper window garden engine winter silver "
         "mountain letter bridge copper forest signal harbor thunder valley").split()
CLASH = ["key", "size", "copy", "slot", "label", "vertex", "score", "body", "n", "bin", "shard", "features"]


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "", "s", "ing", "ed"]) + str(r.randint(0, 9) or "")
                    for _ in range(n))


def rows():
    base = prose(1, 120)
    near = base.split()
    near[60] = "changed"
    out = [(1, base, "a"), (2, base, "b"), (3, " ".join(near), "a"), (4, None, None), (5, "", "b"),
           (6, "two words", "a"), (7, "Two  WORDS", "b"), (8, prose(8, 6000), "c"),
           (9, "x" * 30000, "c"), (10, prose(10, 300) + "\n" + prose(10, 300), "a"),
           (None, "no id here at all, only words", "a"), (11, " \t\n", None), (1, base, "a")]
    out += [(20 * i, prose(100 + i, 40 + i), "abc"[i % 3]) for i in range(1, 40)]
    out += [(5001 + i, prose(200 + i % 3, 60), "b") for i in range(12)]
    return out


@pytest.fixture(scope="session")
def docs(spark):
    data = [(d, t, s, "en", *["clash"] * len(CLASH)) for d, t, s in rows()]
    cols = ", ".join(f"`{c}` string" for c in CLASH)
    return spark.createDataFrame(data, f"doc_id long, text string, source string, lang string, {cols}").repartition(3)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
