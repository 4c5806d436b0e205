import random

from conftest_llm import CLASHES, brute_shingles
from sitelens.llm import decontam

ITEMS = "item_id long, text string, doc_id string, q int"


def items(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in texts], ITEMS)


def brute(docs, texts, percent=80):
    out = set()
    for i, t in texts:
        q = brute_shingles(t)
        for d, text in docs:
            both = len(q & brute_shingles(text))
            if q and d is not None and i is not None and 100 * both >= percent * len(q):
                out.add((d, i, both, len(q)))
    return out


def answer(df):
    rows = df.collect()
    got = {(r["doc_id"], r["item_id"], r["shared"], r["item_shingles"]) for r in rows}
    assert len(got) == len(rows)
    return got


def test_against_brute_force(spark, docs):
    rng = random.Random(2)
    word = lambda: f"w{rng.randrange(3000)}"
    texts = [(i, " ".join(word() for _ in range(rng.choice([3, 6, 9, 20, 60, 130])))) for i in range(60)]
    rows = []
    for d in range(200):
        w = [word() for _ in range(rng.choice([10, 200, 1500]))]
        for _ in range(rng.randrange(4)):
            part = rng.choice(texts)[1].upper().split()
            for _ in range(rng.randrange(4)):
                part[rng.randrange(len(part))] = "changed"
            at = rng.randrange(len(w))
            w[at:at] = part
        rows.append((d, "  ".join(w)))
    rows += [(300, texts[0][1]), (301, texts[3][1] + "\n" + texts[4][1])]
    got = answer(decontam.contained_items(docs(rows, CLASHES), items(spark, texts)))
    assert got == brute(rows, texts) and len(got) > 30


def test_odd_rows(spark, docs, odd_texts):
    texts = [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "same text here"), (6, "a b c d e f g"), (6, "a b c d e f g"),
             (None, "one"), (7, " ".join(odd_texts[5].split()[100:140]))]
    rows = [*enumerate(odd_texts), (None, "one"), (8, "one")]
    got = answer(decontam.contained_items(docs(rows, CLASHES), items(spark, texts)))
    assert got == brute(rows, texts)
    assert decontam.contained_items(docs([]), items(spark, texts)).count() == 0
    assert decontam.contained_items(docs(["one"]), items(spark, [])).count() == 0


def test_shuffle_join_gives_the_same(spark, docs, monkeypatch):
    texts = [(i, " ".join(f"i{i}w{j}" for j in range(12))) for i in range(30)]
    rows = [(d, f"head {texts[d % 30][1]} tail") for d in range(90)] + [(99, "nothing of the kind is in here")]
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", 0)
    assert answer(decontam.contained_items(docs(rows), items(spark, texts))) == brute(rows, texts)


def test_stage_drops_only_contaminated(spark, docs):
    texts = [(1, "the quick brown fox jumps over the lazy dog again")]
    df = docs([(1, "x " + texts[0][1] + " y"), (2, "clean text with the quick brown fox in it"), (3, None), (None, "null id")], "q top")
    out = decontam.drop_contaminated(df, items(spark, texts))
    assert out.columns == df.columns
    assert {r["doc_id"] for r in out.collect()} == {2, 3, None}


def test_no_python_in_the_plan(spark, docs):
    plan = decontam.contained_items(docs(["a b c d e f"]), items(spark, [(1, "a b c d e")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
