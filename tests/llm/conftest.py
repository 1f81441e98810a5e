"""Rows that every text operator must take: nulls, empty and long texts, repeated rows, clashing columns."""

import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "doc string, node string, bucket string, term string, chunk string, tie string")


def prose(rnd, n, vocabulary=400):
    words = [f"w{rnd.randrange(vocabulary)}" for _ in range(n)]
    return " ".join(w.capitalize() if rnd.random() < 0.1 else w for w in words) + "."


@pytest.fixture(scope="session")
def rows():
    rnd = random.Random(5)
    base = [prose(rnd, rnd.randint(3, 120)) for _ in range(40)]
    texts = list(base)
    texts += base[:6]                                       # exact copies
    for t in base[6:16]:                                    # near copies
        words = t.split()
        words[len(words) // 2] = "changed"
        texts.append(" ".join(words) + " and a few more words")
    family = prose(rnd, 120)
    for k in range(45):                                     # a family larger than the list bound
        words = family.split()
        words[rnd.randrange(len(words))] = f"edit{k}"
        texts.append(" ".join(words))
    texts += [None, "", "   \n\t ", None, "one", "One two", "one  two", "x" * 5000, prose(rnd, 9000, 50),
              "<|endoftext|> a</s>[INST]", "é ñ ß İ　全角  end"]
    out = [(i, t) for i, t in enumerate(texts)]
    out += [out[3], out[3], (None, "no id"), (None, None), (out[5][0], "another text of a known id, six words")]
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(
        [(i, t, None if k % 3 else "en", None, 1, "d", "n", "b", "t", "c", "x") for k, (i, t) in enumerate(rows)],
        SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
