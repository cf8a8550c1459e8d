"""Awkward rows for the operators, and plain Python for what they should give."""

import random
import re

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, key string, cell string, body string,"
          " row string, bucket string, size string, component string, lang_pred string")
WORDS = re.compile(r"[^ \t-\r]+")


def rows(texts, langs=("en", "de", None), sources=("a", "b", None)):
    """Documents with the given texts; the further columns have the names operators use inside."""
    return [
        (i, t, langs[i % len(langs)], sources[i % len(sources)], None, *["x"] * 8) for i, t in enumerate(texts)
    ]


def frame(spark, texts, **options):
    return spark.createDataFrame(rows(texts, **options), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def awkward_texts(seed=1):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 7))) for _ in range(300)]
    base = [" ".join(r.choice(vocabulary) for _ in range(r.randint(1, 60))) for _ in range(25)]
    texts = [None, "", " ", "\n\n", "a", "A b\tc", "漢字かな交じり文", "🙂🙂", "1 2 3", "x" * 50_000, "ab " * 20_000]
    for b in base:
        words = b.split()
        words[r.randrange(len(words))] = r.choice(vocabulary)
        texts += [b, b, b.replace(" ", "\t\n"), " ".join(words), b.upper()]
    return texts
