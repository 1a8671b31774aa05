"""Small tables and plain re-computations for the tests of the corpus operators."""

from pyspark.sql import functions as F

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """Documents from ``(doc_id, text, lang, source)``, with columns whose names the operators use inside."""
    table = spark.createDataFrame(
        [(i, t, g, s, None if t is None else len(t)) for i, t, g, s in rows], DOCUMENTS
    )
    return table.withColumns({name: F.lit(-1) for name in ("key", "size", "kept", "_row", "root", "taken", "block")})


def found(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


class Groups:
    """Union-find."""

    def __init__(self, n):
        self.up = list(range(n))

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        self.up[self.find(a)] = self.find(b)

    def members(self):
        out = {}
        for x in range(len(self.up)):
            out.setdefault(self.find(x), []).append(x)
        return list(out.values())
