import random

from pyspark.sql import functions as F

from lavra.llm import leaks
from lavra.llm.leaks import Index, LeakRule

R = random.Random(5)
WORDS = [f"{a}{b}" for a in ("ca", "do", "mi", "lu", "pe", "ra", "so", "ti") for b in ("lo", "na", "rto", "ves", "mba", "dor")]


def sentence(n):
    return " ".join(R.choice(WORDS) for _ in range(n))


ITEMS = [(k, sentence(R.choice([12, 45, 80])), None) for k in range(40)]


def brute(text, item, rule):
    """Longest accepted stretch over all alignments, by trying every start and end."""
    want, have = leaks.comparable_words(item), leaks.comparable_words(text)
    size, best = min(rule.least, len(want)), 0
    for off in range(-len(want), len(have)):
        hit = [0 <= i + off < len(have) and have[i + off] == w for i, w in enumerate(want)]
        for a in range(len(want)):
            for b in range(a + size, len(want) + 1):
                if hit[a] and hit[b - 1] and (b - a) - sum(hit[a:b]) <= (b - a) * rule.replaced:
                    best = max(best, b - a)
    return best


def corpus():
    out = []
    for k in range(60):
        _, text, _ = R.choice(ITEMS)
        ws = text.split()
        n = R.choice([10, 19, 20, 21, 30, len(ws)])
        a = R.randrange(max(1, len(ws) - n + 1))
        part = ws[a : a + n]
        for _ in range(R.choice([0, 0, 1, 2])):
            part[R.randrange(len(part))] = "trocada"
        out.append(f"{sentence(R.randint(0, 60))} {' '.join(part)} {sentence(R.randint(0, 60))}")
    return out


def test_search_finds_what_brute_force_finds():
    rule = LeakRule()
    index = Index(ITEMS, rule)
    hits = 0
    for text in corpus():
        want = {(i, n) for i, item, _ in ITEMS if (n := brute(text, item, rule))}
        assert {(h["item_id"], h["matched_words"]) for h in index.leaks(text)} == want
        hits += len(want)
    assert hits > 20


def test_wand_retrieves_all_above_the_threshold():
    index = Index(ITEMS, LeakRule(block=3))
    for _ in range(200):
        words = {R.choice(WORDS) for _ in range(R.randint(1, 45))}
        scores = [0.0] * len(ITEMS)
        for w in words:
            for k, x in zip(*index.posts.get(w, ([], [])), strict=True):
                scores[k] += x
        assert index.search(words) == [k for k, s in enumerate(scores) if s >= 1]


def test_operator_edges(spark):
    items = spark.createDataFrame([(1, "Numa vila, " + " ".join(WORDS[:25]) + " A) tatu; B) paca.", "B"), (2, None, None), (3, "", None)], "item_id bigint, text string, answer string")
    leaked = "NUMA  vi\u200bla " + " ".join(WORDS[:25]).upper().replace("A", "\u0410") + " paca"
    rows = [(1, leaked, "x"), (1, leaked, "x"), (2, None, "x"), (3, "", "x"), (4, " ".join(WORDS[:19]), "x"), (None, leaked, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, item_id string")
    got = [tuple(r) for r in leaks.find_leaks(df, "doc_id", "text", items).collect()]
    assert got == [(1, 1, 27, 31, True)]
    assert leaks.find_leaks(df, "doc_id", "text", items.limit(0)).count() == 0
    assert leaks.find_leaks(df.limit(0), "doc_id", "text", items).count() == 0


def test_many_items_give_the_same_by_joins(spark):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string, answer string")
    df = spark.createDataFrame(list(enumerate(corpus())), "doc_id bigint, text string")
    one, many = (sorted((r.doc_id, r.item_id) for r in leaks.find_leaks(df, "doc_id", "text", items, max_items=m).collect()) for m in (1000, 7))
    assert one == many and one


def test_every_leak_holds_a_run_of_equal_words():
    rule = LeakRule()
    assert [rule.run(n) for n in (1, 5, 6, 7, 12, 20, 45)] == [1, 5, 6, 3, 6, 5, 5]
    for _ in range(300):
        n = R.randint(20, 60)
        hit = [True] * n
        for k in R.sample(range(1, n - 1), min(n - 2, rule.allowed(n))):
            hit[k] = False
        assert max(map(len, "".join("x" if h else " " for h in hit).split())) >= rule.run(60)


def test_a_hundred_thousand_items_need_one_scan(spark):
    items = spark.range(100_000).select(F.col("id").alias("item_id"), F.concat_ws(" ", *[F.concat(F.lit(a), F.hex(F.pmod(F.xxhash64("id", F.lit(k)), F.lit(5000)))) for k, a in enumerate("abcdefghijklmnopqrstuv")]).alias("text"), F.lit(None).cast("string").alias("answer"))
    some = {r.item_id: r.text for r in items.where("item_id % 9973 = 0").collect()}
    docs = [(k, f"{sentence(30)} {t} {sentence(9)}") for k, t in some.items()] + [(-1, sentence(50))]
    got = leaks.find_leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), "doc_id", "text", items)
    assert sorted((r.doc_id, r.item_id) for r in got.collect()) == [(k, k) for k in sorted(some)]
