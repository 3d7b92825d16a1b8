import random
import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

#: Extra columns that carry names the operators use inside.
CLASH = ("row", "key", "digest", "size", "s", "kind", "th", "_id", "grp", "rn", "hub", "shard", "k1", "_q_text", "ids", "path")


def table(spark, rows):
    """documents with (doc_id, text, source) rows, the other columns null and clashing extras."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASH)
    return spark.createDataFrame([(i, t, None, s, None, *["x"] * len(CLASH)) for i, t, s in rows], schema)


LONG = " ".join(f"w{i * i % 5003} and then" for i in range(4000))
EDGE = [(1, "Hello there, hello THERE world.", "a"), (1, "Hello there, hello THERE world.", "a"), (2, None, None), (None, "No id here at all.", "b"),
        (3, "", "a"), (4, LONG, "b"), (5, "A" * 3000, None), (6, "hello there, HELLO there world.", "a"), (7, " \t\n\x0b ", "c"),
        (8, "Ünïcode ÉÀ straße 日本語 \U0001f600 end", "c"), (9, LONG + " tail", "b")]


def corpus(seed, n=60):
    """Random documents with exact copies, near copies, shared passages and repeats inside one document."""
    rnd = random.Random(seed)
    vocab = ["".join(rnd.choices("abcdefghij", k=rnd.randint(1, 7))) for _ in range(300)]

    def sentence():
        return " ".join(rnd.choices(vocab, k=rnd.randint(2, 14))).capitalize() + rnd.choice(".!?")

    passages = [" ".join(sentence() for _ in range(6)) for _ in range(4)]
    out = []
    for i in range(n):
        kind = rnd.random()
        if out and kind < 0.15:
            t = rnd.choice(out)[1]
        elif out and kind < 0.4:
            w = rnd.choice(out)[1].split(" ")
            for _ in range(rnd.randint(1, 4)):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            t = " ".join(w)
        else:
            parts = [sentence() for _ in range(rnd.randint(1, 25))]
            if rnd.random() < 0.4:
                parts.insert(rnd.randrange(len(parts) + 1), "\n" + rnd.choice(passages) + "\n")
            if rnd.random() < 0.1:
                parts += parts[-6:]
            t = " ".join(parts)
        out.append((i, t, f"s{i % 4}"))
    return out


@pytest.fixture(scope="session")
def edge(spark):
    return table(spark, EDGE)


@pytest.fixture(scope="session")
def nothing(spark):
    return table(spark, [])
