"""Small documents with the cases that every operator must take."""

import random

ODD = [
    "it's we'll 'tis don't!'s ''s  's \n's I'veab x's's", "   lead", "trail   ", "a \n\n b", "<|endoftext|>x <|endoftext|>  <|endoftext|>",
    "日本語 text ñandú 123 45a6", "a" * 1000, "ab" * 3000, "-" * 777 + "=  ", " 　x  y", "'", "a'", "'re", "x'r", "'l", "'ll'll", " ", "",
    "\r\n\r\n", "é̀ ́x", "½²x3", "🙂🙂 ok", "A <|startoftext|>b ÀÉİ Σς\x1c\x85x\xa0y", "  ́a é", "ſK \x01 \x01", "THE the The",
]


def documents(seed=1, n=120, words=300):
    """(doc_id, text) rows: shared passages, near copies, copies, nulls, empty texts, repeated rows and a long text."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)]
    passages = [" ".join(r.choice(vocabulary) for _ in range(r.randint(15, 90))) for _ in range(8)]
    rows = []
    for d in range(n):
        parts = [r.choice(passages) if r.random() < 0.4 else " ".join(r.choice(vocabulary) for _ in range(r.randint(1, 60))) for _ in range(r.randint(0, 6))]
        w = " ".join(parts).split(" ")
        rows.append((3 * d, " ".join(w)))
        for k in range(r.choice([0, 0, 0, 1, 4])):
            x = list(w)
            for _ in range(r.randint(0, 3)):
                x[r.randrange(len(x))] = r.choice(vocabulary)
            rows.append((3000 + 10 * d + k, " ".join(x)))
    rows += [(9000, None), (9001, ""), (9002, " \n"), (None, passages[0]), (None, passages[0] + " " + passages[1]), (9003, passages[2]), (9003, passages[2]),
             (9004, "a " * 500), (9005, "a b " * 300), (-5, passages[3]), (9006, " ".join(r.choice(vocabulary) for _ in range(20000))), (9007, "zz"), (9008, "ZZ"), (9009, "x y")]
    r.shuffle(rows)
    return rows


def frame(spark, rows, parts=3):
    """The rows with other columns, some named like those that operators make."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    return df.select("doc_id", "text", F.lit(None).cast("string").alias("lang"), F.lit("s").alias("source"), F.length("text").alias("n_chars"), F.lit(1).alias("id"),
                     F.lit(2).alias("row"), F.lit("x").alias("kept"), F.lit(3).alias("n_words"), F.lit(4).alias("component"))


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
