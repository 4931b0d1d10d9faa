"""Documents with every awkward case, and an empty table of the same columns."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "score string, shard string, node long, key long, removed_words string")


def words(rng, n, vocabulary=400):
    return [rng.choice("abcdefghijklmnop") + str(rng.randrange(vocabulary)) for _ in range(n)]


def edge_rows(seed=1):
    rng = random.Random(seed)
    long = " ".join(words(rng, 30_000, 10**6))
    base = " ".join(words(rng, 80))
    texts = [None, "", "   ", "\n", "solo", "a b", "A  B", "a b c d e", base, base, base + " tail", long,
             "x" * 5_000, "123 456 !!! ???", "été ñandú straße", "日本 語", "\x00 odd \x7f",
             "\n".join([base, " ".join(words(rng, 12))]), " ".join(words(rng, 60)), " ".join(words(rng, 61))]
    rows = [(i, t, ["en", "fr", None][i % 3], ["s1", "s2", None, "s3"][i % 4], None if t is None else len(t),
             "clash", "clash", 7, 7, "clash") for i, t in enumerate(texts)]
    rows += [rows[8], rows[8]]                       # repeated rows
    rows.append((8, "another text under a repeated id", None, None, None, None, None, None, None, None))
    rows.append((None, base, None, None, None, None, None, None, None, None))
    rows.append((None, None, None, None, None, None, None, None, None, None))
    return rows


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)
