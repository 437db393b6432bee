import random

import pytest

from skerry.llm import jaccard


def sets(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\v", " ").replace("\f", " ").replace("\r", " ").split(" ") if w]
    k = min(5, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()


def brute(texts):
    """Smallest id reachable over links of all pairs."""
    s = {k: sets(t) for k, t in texts.items()}
    root = {k: k for k in texts}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if s[a] and s[b] and 100 * len(s[a] & s[b]) >= 80 * len(s[a] | s[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: (len(s[k]), find(k)) for k in ids}


def run(spark, texts):
    d = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.components(d).collect()}


def test_documents(spark, texts):
    assert run(spark, texts) == brute(texts)


@pytest.mark.parametrize("seed", [1, 2])
def test_near_copies_around_the_threshold(spark, seed):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    common = [r.choice(vocabulary) for _ in range(30)]
    texts = {}
    for family in range(12):
        words = [r.choice(vocabulary) for _ in range(r.randint(8, 150))] + (common if family % 2 else [])
        for copy in range(6):
            w = list(words)
            for _ in range(r.randint(0, max(1, len(w) // 30))):
                w[r.randrange(len(w))] = r.choice(vocabulary)
            texts[100 * family + copy] = " ".join(w)
    assert run(spark, texts) == brute(texts)


def test_chains_and_the_exact_limit(spark):
    base = [f"a{i}" for i in range(40)]
    texts = {}
    for k in range(12):  # each step changes the end a little: neighbours link, ends do not
        texts[k] = " ".join(base[k:] + [f"b{i}" for i in range(k)])
    # sets of 8 and 10 shingles, the smaller inside the larger: exactly 0.8; and one of 9 in 12
    texts[50], texts[51] = " ".join(f"c{i}" for i in range(12)), " ".join(f"c{i}" for i in range(14))
    texts[60], texts[61] = " ".join(f"d{i}" for i in range(13)), " ".join(f"d{i}" for i in range(16))
    got = run(spark, texts)
    assert got == brute(texts)
    assert got[51][1] == 50 and got[61][1] == 61


def test_short_sequences(spark):
    texts = {1: "One two", 2: "one\ttwo", 3: "one two three", 4: "", 5: None, 6: "  \n", 7: "éÉ Two", 8: "éé two"}
    assert run(spark, texts) == brute(texts)


def test_many_copies_make_few_pairs(spark):
    text = " ".join(f"w{i}" for i in range(60))
    texts = {i: text for i in range(300)} | {1000 + i: text + f" tail{i}" for i in range(300)}
    assert set(v[1] for v in run(spark, texts).values()) == {0}


def test_keep_one(spark, texts):
    d = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id for r in jaccard.keep_one(d).collect()} == {k for k, (_, c) in brute(texts).items() if k == c}
