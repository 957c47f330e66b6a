import random

import duckdb
import pytest
from hypothesis import settings

from heronlake.sources.tables import table

settings.register_profile("unhurried", deadline=None, max_examples=60)
settings.load_profile("unhurried")

#: Further columns whose names the operators use for their own results or helpers.
CLASHES = ("score", "node", "bucket", "size", "taken", "n_lines", "removed", "piece", "rank", "uid", "root", "lang_pred",
           "_gone", "_lang", "_score", "_letters", "_n_removed", "doc", "_doc", "cut", "gone_id")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", {c} string" for c in CLASHES)


def messy_rows():
    rnd = random.Random(5)
    vocabulary = ["".join(rnd.choice("abcdefgéñ") for _ in range(rnd.randrange(2, 9))) for _ in range(300)]
    sentence = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    shared = "\n".join(sentence(9) for _ in range(4))
    rows = []
    for i in range(70):
        text = f"{sentence(rnd.randrange(3, 60))}\n{shared if i % 3 == 0 else sentence(12)}\n  Menu of the site \n{sentence(20)}"
        rows.append((i, text, "ab"[i % 2], None if i % 17 == 0 else f"s{i % 13}"))
    base = sentence(120).split(" ")
    for i in range(100, 125):  # near copies of one text, differently far from it
        words = list(base)
        for _ in range(rnd.randrange(0, 12)):
            words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
        rows.append((i, " ".join(words), "a", f"s{i % 11}"))
    rows += [(200, None, None, None), (201, "", "a", "s1"), (202, " \n\t ", None, "s2"), (203, "one", "b", "s3"),
             (204, "One  two", "b", "s3"), (205, "one two", "b", "s4"), (206, "12 34 !!", "a", "s4"),
             (207, "a" * 500, "a", "s5"), (208, "b" + "a" * 60, "a", "s5"), (209, sentence(4_000), "b", "s6"),
             (5, rows[5][1], "b", "s5"), (5, rows[5][1], "b", "s5"), (6, "another text of the same id", "a", "s6"),
             (None, rows[7][1], "a", "s7"), (None, None, "b", None), (300, rows[9][1], "b", "s8"), (301, rows[9][1], "a", None),
             (302, "<|endoftext|> and  blanks \n \n  of many\tkinds   x", "a", "s9")]
    return [(*r, len(r[1]) if r[1] is not None else None, *CLASHES) for r in rows]


@pytest.fixture(scope="session")
def messy(spark):
    return spark.createDataFrame(messy_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def messy_con():
    """The same rows as the view `documents` for SQL."""
    import pandas as pd

    con = duckdb.connect()
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    frame = pd.DataFrame(messy_rows(), columns=names).astype({"doc_id": "Int64", "n_chars": "Int64"})
    con.register("frame", frame)
    con.execute("CREATE TABLE documents AS SELECT * FROM frame")
    return con


@pytest.fixture(scope="session")
def small_documents(spark):
    return table(spark, "/root/testdata/sf0.01", "documents")


@pytest.fixture
def rows_of():
    """Rows in an order that allows comparing, nulls and all."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
