"""Small tables with the cases each operator has to define: nulls, empty and long texts, ties, repeated rows."""

import random

import pytest

LONG = 3000


@pytest.fixture(scope="session")
def texts():
    rng = random.Random(3)
    vocabulary = ["alpha", "beta", "Gamma,", "delta.", "é", "日本", "don't", "x1", "***", "the", "of"]
    passage = " ".join(rng.choice(vocabulary) + str(k % 7) for k in range(60))
    out = [None, "", " \n\t ", "one", "one two three", passage, passage, f"start {passage} end", "a " * 80]
    for _ in range(40):
        body = " ".join(rng.choice(vocabulary) + rng.choice(["", "", str(rng.randrange(50))]) for _ in range(rng.randrange(5, 120)))
        out.append(body + rng.choice(["", f"\n{passage}", f" {passage[:200]}", "\nsame line\nsame line"]))
    near = passage.split()
    for k in (3, 30, 58):
        changed = list(near)
        changed[k] = "other"
        out.append(" ".join(changed))
    out.append(" ".join(f"w{k % 1000}" for k in range(LONG)))
    out.append("\n".join(f"line {k} $$$" for k in range(300)))
    return out


@pytest.fixture(scope="session")
def docs(spark, texts):
    """Documents with rows repeated as a whole, by doc_id only, and without doc_id, and columns that clash."""
    rows = [(i, t, "src0" if i % 3 else None) for i, t in enumerate(texts)]
    rows += [(5, texts[5], "src0"), (7, "another text with the same id", "src1"), (None, texts[5], "src1"), (None, None, None)]
    schema = "doc_id long, text string, source string, n_chars long, kept string, spans int, copy int, rate double, n int, key int"
    return spark.createDataFrame([(*r, len(r[1] or ""), "k", 1, 2, 3.0, 4, 5) for r in rows], schema)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from yearwheel.llm.ship import ship

    ship(spark)
