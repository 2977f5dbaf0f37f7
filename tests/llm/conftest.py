import random

import pytest

SYLLABLES = "the an er ing on re ti ou ha wh é ß ñ".split()


def words(rng, n):
    return [" ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(1))
            for _ in range(n)]


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text, source) rows: plain, copies with other white space, near copies,
    shared passages, empties, nulls, a very long text, ties and repeated rows."""
    rng = random.Random(11)
    passage = " ".join(words(rng, 60))
    rows = []
    for i in range(60):
        rows.append((i, " ".join(words(rng, rng.randint(1, 120))), f"s{i % 4}"))
    base = words(rng, 150)
    for i in range(60, 100):  # near copies with more and more edits
        w = list(base)
        for _ in range((i - 60) // 4):
            w[rng.randrange(len(w))] = "".join(rng.choices(SYLLABLES, k=4))
        rows.append((i, " ".join(w), "s1"))
    for i in range(100, 120):  # a shared passage among own words
        rows.append((i, " ".join(words(rng, 30)) + "\n" + passage + "\n" + " ".join(words(rng, 30)), "s2"))
    for i in range(120, 130):  # copies: white space differs, one longest, ties
        rows.append((i, rows[5][1].replace(" ", "  " if i < 125 else "\t"), "s3"))
    rows += [(130, "", "s0"), (131, None, None), (132, " \n\t ", "s0"), (133, "one two", "s0"), (134, "One TWO", "s0"),
             (135, " ".join(words(rng, 20_000)), "s0"), (136, "aa " * 500, "s0"), (137, "aa " * 500, "s1"),
             (138, "a" * 3000, "s1"), (139, "x\x0by\x0cz \x1c\x85   日本 🎉", "s1")]
    rows += [rows[5], rows[100]]  # repeated rows
    return rows


def frame(spark, rows):
    """The rows with further columns whose names operators use inside."""
    schema = ("doc_id long, text string, source string, key string, row string, rid string, gid string, digest string, "
              "n string, keep_id string, h string, q string")
    return spark.createDataFrame([(*r, *["x"] * 9) for r in rows], schema)


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return frame(spark, corpus).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return frame(spark, [])
