"""Small tables with the awkward cases, and plain versions of what operators compute."""

import os
import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SF = "/root/testdata/sf0.001"
HAVE_DATA = os.path.isdir(SF)
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall((text or "").translate(_LOW))


def shingles(text, n):
    w = words(text)
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def sentence(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def awkward_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows and columns of names that operators use themselves."""
    rng = random.Random(7)
    base = sentence(rng, 120)
    near = base.split()
    near[60] = "other"
    rows = [(1, base, "en", "b", 1), (2, base, "en", "a", None), (3, " ".join(near), None, None, 1), (4, None, "en", "a", 0),
            (5, "", "en", "a", 0), (6, " \n\t ", "en", None, 3), (7, "One", "de", "b", 3), (8, "one", "de", "c", 3),
            (9, "Üb Éa one two", "fr", "c", 1), (9, "Üb Éa one two", "fr", "c", 1), (10, sentence(rng, 30000), "en", "é", 1),
            (11, "one\n\ntwo\n", "en", "a", 1), (12, base + "\n", "en", "c", 1)]
    df = spark.createDataFrame(rows, DOCS)
    for name in ("id", "n", "cls", "sig", "key", "site", "size", "p", "shard"):
        df = df.selectExpr("*", f"doc_id as `{name}`")
    return df


def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def as_dicts(df):
    return [r.asDict(recursive=True) for r in df.collect()]
