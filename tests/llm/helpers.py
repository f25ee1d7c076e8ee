"""Small tables with the awkward cases every operator must stand, and plain-Python references."""

import re

EDGE_TEXTS = [None, "", " \t\n", "a", "Same text here.", "Same text here.", "same  text here.", "é🎉 日本語 naïve", "word " * 3000, "1" * 2000,
              "The first line\nThe second line\n\nThe first line", "x" * 5000]


def documents(spark, texts=None, ids=None, extra=True):
    """A documents table with null ids and texts, repeated rows and a column with a clashing name."""
    texts = EDGE_TEXTS if texts is None else texts
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, ["en", "de", None][k % 3], "src0", len(t or ""), f"extra{k}", 1.0) for k, (i, t) in enumerate(zip(ids, texts))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, id string, score double")
    return df if extra else df.drop("id", "score")


def ascii_words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def components(n, links):
    """Smallest index of each node's component."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]
