"""Odd rows every operator has to take, and small helpers."""

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 97} of line {i % 13}" for i in range(6000))
ROWS = [
    (1, "The cat sat on the mat and looked at the moon.", "en", "b", 46),
    (1, "The cat sat on the mat and looked at the moon.", "en", "b", 46),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (4, " \t\n ", "en", "a", 4),
    (5, LONG, "en", None, len(LONG)),
    (None, "A row without an id, mail me at a.b@c.example or +1 (415) 555-0134.", "en", "é", 60),
    (1 << 60, "Ein großes Haus steht dort — 日本語 𝄞 ▁ end", "de", "a", 40),
    (7, "one", None, "zz", 3),
    (8, "12345 !!! 678", "en", "zz", 13),
    (5, "the same id with another text", "en", "b", 29),
    (9, "The cat sat on the mat and looked at the moon!", "en", "b", 46),
]
#: Names the operators use inside.
CLASHING = ["row", "h", "key", "size", "label", "node", "n", "v", "fp", "t", "b1", "taken", "target", "packed", "bucket", "tie"]


def odd(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.withColumns({c: F.lit("other") for c in CLASHING})


def empty(spark):
    return odd(spark).limit(0)


class Sets:
    """Union-find for brute force."""

    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
