import random

from pyspark.sql import functions as F

from lavra.llm import split


def brute(text, limit, overlap):
    """Cut positions found by trying every position from the limit down, strongest boundary first."""
    kinds = [set(map(int, b)) for b in split.boundaries(text)]
    out, start = [], 0
    while len(text) - start > limit:
        cut = None
        for strength, at in enumerate(kinds):
            least = start + (overlap + 1 if strength == 3 else max(overlap + 1, limit // 2))
            cut = next((p for p in range(start + limit, least - 1, -1) if p in at), None)
            if cut:
                break
        cut = cut or start + limit
        out.append((start, cut))
        start = cut - overlap
    return [*out, (start, len(text))] if text else []


def test_spans_equal_brute_force():
    r = random.Random(1)
    for _ in range(60):
        text = "".join(r.choice(["a", "bc", "é", "𝄞", " ", " ", ". ", "\n", "\n\n", "x" * 30]) for _ in range(r.randint(0, 400)))
        limit = r.randint(20, 80)
        overlap = r.randint(0, limit // 2)
        got = split.spans(text, limit, overlap)
        assert got == brute(text, limit, overlap)
        assert all(b - a <= limit for a, b in got) and all(x[1] - y[0] == overlap for x, y in zip(got, got[1:]))


def test_round_trip_and_edges(spark):
    long = ("frase curta. " * 40 + "\n\n") * 30 + "z" * 9000 + "𝄞é" * 3000
    rows = [("a", long, 1), ("b", "curto", 2), ("c", "", 3), ("d", None, 4), (None, "x" * 4001, 5), ("b", "curto", 2), ("e", " " * 4500, 6), ("f", "y" * 4000, 7)]
    df = spark.createDataFrame(rows, "id string, t string, piece_no int").withColumn("n_pieces", F.lit("clash"))
    out = split.split(df, "t").orderBy("id", "piece_no").collect()
    by = {}
    for r in out:
        by.setdefault(r.id, []).append(r)
    assert set(by) == {"a", "b", None, "e", "f"} and len(by["b"]) == 2 and len(by["f"]) == 1 and len(by[None]) == 2
    whole = by["a"][0].piece + "".join(r.piece[200:] for r in by["a"][1:])
    assert whole == long and all(len(r.piece) <= 4000 for r in out) and by["a"][0].n_pieces == len(by["a"])
    assert split.split(df.limit(0), "t").count() == 0
