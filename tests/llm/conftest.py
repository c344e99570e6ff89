import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, _pw int, ids string, extra array<int>"


def corpus(n=60, seed=3):
    """Documents with copies, shared passages, ties, repeated rows, nulls, an empty and a long text."""
    rnd = random.Random(seed)
    vocabulary = [rnd.choice(["lo", "re", "mip", "süm", "Do", "é"]) + rnd.choice("abcdefg") + str(rnd.randrange(40)) for _ in range(300)]
    words = lambda k: [rnd.choice(vocabulary) for _ in range(k)]
    passage = words(60)
    texts: list = []
    for i in range(n):
        body = words(rnd.randint(0, 120))
        if i % 4 == 0:
            at = rnd.randint(0, len(body))
            body[at:at] = passage
        if i % 9 == 5 and texts:
            texts.append(rnd.choice(texts))
            continue
        texts.append(rnd.choice([" ", " ", "\n", "  "]).join(body))
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 2}", len(t or ""), "k", i, "x", [i]) for i, t in enumerate(texts)]
    rows += [(1000, None, None, None, None, None, None, None, None), (1001, "", "en", "s", 0, "", 1, "", []), (1002, " \t\n ", "en", "s", 3, "", 1, "", [])]
    rows += [(None, "no id " + " ".join(words(50)), "en", "s", 1, "", 1, "", []), rows[3], rows[3], (7, "another text with the id of seven", "en", "s", 1, "", 1, "", [])]
    rows.append((2000, " ".join(words(30_000)), "en", "s", 1, "", 1, "", []))
    rows += [(3000 + i, "a " * 300, "en", "s", 1, "", 1, "", []) for i in range(2)]
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows, tmp_path_factory):
    path = f"file://{tmp_path_factory.mktemp('docs')}/documents.parquet"
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
