import random
import re

from pyspark.sql import functions as F

from lavra.llm import repetition


def brute(text, run):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    seen, mark = set(), [False] * len(words)
    for k in range(len(words) - run + 1):
        gram = tuple(words[k : k + run])
        if gram in seen:
            mark[k : k + run] = [True] * run
        seen.add(gram)
    return len(words), sum(mark)


def test_counts_equal_brute_force():
    r = random.Random(2)
    texts = [None, "", "!?", "a b c"] + [" ".join(r.choice("ab cd Ef".split()) + r.choice(["", ",", "-"]) for _ in range(r.randint(0, 120))) for _ in range(60)]
    texts += ["um dois três quatro cinco seis sete oito " * 500]
    n, rep = repetition.repeated_words(texts, 8)
    assert list(zip(n, rep, strict=True)) == [brute(t, 8) for t in texts]


def test_operator_edges(spark):
    s = "Um dois, três quatro cinco seis sete oito. "
    df = spark.createDataFrame([("a", s * 3, 0), ("b", s, 0), ("c", None, 0), ("d", " ", 0), ("a", s * 3, 0), ("e", s + s.upper().replace(",", " -"), 0)], "id string, t string, n_words int")
    got = {r.id: (r.n_words, r.n_repeated, round(r.repeated_share, 3)) for r in repetition.measure(df.withColumn("repeated_share", F.lit("x")), "t").collect()}
    assert got == {"a": (24, 16, 0.667), "b": (8, 0, 0.0), "c": (0, 0, 0.0), "d": (0, 0, 0.0), "e": (16, 8, 0.5)}
    assert repetition.measure(df.limit(0), "t").count() == 0
