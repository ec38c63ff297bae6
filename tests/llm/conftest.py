import random

import pytest


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, id long, bucket int, ids string, score double"


def words(n, seed):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice(["re", "on", "the", "ñe", "ti", "ha", "st"]) for _ in range(rnd.randint(1, 4)))
                    for _ in range(n))


def odd_rows():
    """Nulls, empty, blank, very long and repeated texts, and extra columns
    whose names the operators use themselves."""
    long = words(30000, 1)
    texts = {1: "the cat sat on the mat", 2: None, 3: "", 4: " \n\t ", 5: long, 6: "a", 7: words(300, 2),
             8: words(300, 2), 9: words(299, 2) + " other", 10: "x" * 5000, 11: "é日本 𝄞 end", 12: "tail \n double  space ",
             13: words(300, 3), 14: words(40, 4), 15: 'password = "abcdef123456"', 16: None}
    rows = [(i, t, "en", "src", len(t or ""), "k", i, 0, "ids", 0.5) for i, t in texts.items()]
    rows += [rows[6], rows[0]]  # repeated rows
    rows.append((None, "no id here at all", None, None, None, None, None, None, None, None))
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    from ordermart.llm.common import ship
    ship(spark)
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def plain(odd):
    """Rows with an id, as a list of (doc_id, text)."""
    return [(r.doc_id, r.text) for r in odd.collect()]
