"""Small awkward inputs: nulls, empty and long texts, ties, repeated rows, clashing extra columns."""

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(n))


def awkward_rows():
    """Documents with near and exact copies, shared lines, nulls, blanks, a long text and a repeated row."""
    rng = random.Random(5)
    rows, line = [], sentence(rng, 9)
    for k in range(60):
        text = "\n".join([line] + [sentence(rng, rng.randrange(4, 30)) for _ in range(rng.randrange(1, 4))])
        rows.append([k, text])
    rows += [[60 + k, rows[k][1]] for k in range(6)]
    for k in range(8):  # near copies, a chain among them
        words = rows[10][1].split(" ")
        words[k * 2 % len(words)] = "changed"
        rows.append([70 + k, " ".join(words)])
    rows += [[80, None], [81, ""], [82, " \n\t "], [83, "one"], [84, "One"], [85, "a b c"], [86, sentence(rng, 20_000)]]
    rows += [[87, "Ünï cödé \U0001f600 <|endoftext|> x\x85y " + line], [None, "no id " + line], [None, None]]
    rows.append(list(rows[3]))
    sources = ["b", "a", None, "c", "d"]
    return [(i, t, "en", sources[n % 5] if n % 3 else "b", len(t or "")) for n, (i, t) in enumerate(rows)]


def documents(spark, rows=None):
    return spark.createDataFrame(awkward_rows() if rows is None else rows, DOCUMENTS).repartition(3)


def clashing(df):
    """The same rows with extra columns named like an operator's own ones."""
    from pyspark.sql import functions as F

    names = "score key size tie order row shards kept line words sketch pivot n_shingles target copy fits block"
    return df.withColumns({n: F.lit("extra") for n in names.split()})


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
