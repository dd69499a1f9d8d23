"""Plain-Python counterparts that the operators are held against."""

import re

SF = "/root/testdata/sf0.001"


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def shingles(text, width=5):
    w = words(text)
    if len(w) < width:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[k:k + width]) for k in range(len(w) - width + 1))


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


class Groups:
    """Union-find whose groups are named by their smallest member."""

    def __init__(self, members):
        self.up = {m: m for m in members}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def tie(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def documents(spark, rows):
    """Documents of (doc_id, text) with columns whose names operators use themselves."""
    return spark.createDataFrame(
        [(i, t, "x", k, "y", 1.5) for k, (i, t) in enumerate(rows)],
        "doc_id long, text string, row string, `key` int, spans string, score double")
