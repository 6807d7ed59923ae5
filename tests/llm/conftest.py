import random

import pytest

DDL = "doc_id long, text string, lang string, source string, n_chars long, size long, score double, kept string, n_lines string, length int, node long, a long, word string"
WORDS = "the of and to in is that for it was on be with as by at this are from or an".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    words = [r.choice(WORDS) + r.choice(["", "ing", "er", "ed", "tion"]) + r.choice(["", "", "s", "ly"]) for _ in range(n)]
    return " ".join(w + ("." if r.random() < 0.1 else "") for w in words)


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls everywhere, empty and long texts, ties, repeated rows, near copies; extra columns whose names the operators use themselves."""
    base = prose(1, 300)
    near = base.split()
    near[100:103] = ["quite", "other", "words"]
    line = "A line that some documents share."
    texts = [
        (1, base), (2, base), (3, " ".join(near)), (4, None), (5, ""), (6, "   \n\t\n "), (7, "one"), (8, "four words are here"), (9, prose(9, 40_000)),
        (10, f"{line}\n{prose(10, 80)}\n{line}"), (11, f"{prose(11, 80)}\n  a LINE that some documents share. "), (12, f"\n\n{line}"), (13, "é" * 30 + "𝄞" * 30 + " ñ"), (14, "x" * 5000),
        (15, "mail ann.b@c.example.com or +1 (212) 555-0187, 10.0.0.1 and 4111 1111 1111 1111."), (16, "the the the the " * 60), (17, "### && ** " * 100), (18, prose(18, 200)), (18, prose(19, 200)),
        (None, prose(20, 90)), (None, None), (None, prose(20, 90)),
    ]
    rows = [(i, t, ["en", "de", None][k % 3], ["a", "b", None, ""][k % 4], None if t is None else len(t), 7, 0.5, "x", "y", 3, 1, 2, "w") for k, (i, t) in enumerate(texts)]
    rows.append(rows[0])  # a repeated row
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return spark.createDataFrame(edge_rows, DDL)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DDL)


@pytest.fixture(scope="session")
def many_docs(spark):
    """A few hundred documents with copies, near copies, shared lines and junk."""
    r, rows = random.Random(3), []
    for i in range(240):
        text = "\n".join(prose(1000 + i * 7 + j, r.randint(20, 60)) for j in range(r.randint(1, 5)))
        if i % 11 == 0:
            text = " ".join(w + "###" for w in text.split())
        if i % 7 == 0:
            text += "\nThis page was made for all of you."
        if i % 13 == 5:
            text = rows[i - 5][1]
        if i % 17 == 9:
            words = rows[i - 3][1].split(" ")
            words[len(words) // 2] = "changed"
            text = " ".join(words)
        rows.append((i, text, ["en", "de"][i % 2], f"s{i % 5 if i % 3 else 0}", len(text)))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
