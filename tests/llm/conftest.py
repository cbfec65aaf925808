import random

import pytest

WORDS = "the of lake river stone cold morning under bright window letter paper seven".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="session")
def texts():
    """(doc_id, text, source): prose, copies, near copies, shared passages and odd cases."""
    rng = random.Random(5)
    passage = sentence(rng, 25)
    out = []
    for i in range(60):
        text = "\n".join(sentence(rng, rng.randint(5, 30)) for _ in range(rng.randint(1, 6)))
        if i % 5 == 0:
            text += "\n" + passage
        if i % 7 == 3:
            text = out[i - 3][1]
        if i % 11 == 5 and out[i - 2][1]:
            text = out[i - 2][1] + " End."
        out.append((i, text, f"s{i % 4}"))
    out += [(60, None, "s1"), (61, "", "s1"), (62, " \n\t", None), (63, "one", "s0"),
            (64, "one two three", "s0"), (65, "Zeile äöü ▁ 漢字 🙂 <s>", "s2"),
            (66, "word " * 3000, "s3"), (67, "x" * 5000, "s3"), (68, "aé" * 60, "s2"),
            (69, "# $ % & | < > *", "s2"), (70, passage, None), (71, passage.upper(), "s0"),
            (None, "no identifier but text here", "s0"), (70, passage, None),
            (72, "This work is licensed under the GNU General Public License, version 3.", "s0"),
            (73, "Mit license; MIT License\nReleased under THE mit license!", "s1")]
    return out


@pytest.fixture(scope="session")
def docs(spark, texts):
    """Extra columns have the names of columns the operators make."""
    rows = [(d, t, "en", s, None if t is None else len(t), "own", 7) for d, t, s in texts]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, "
              "shard string, kept int").repartition(3)


@pytest.fixture(scope="session")
def none(docs):
    return docs.limit(0)
