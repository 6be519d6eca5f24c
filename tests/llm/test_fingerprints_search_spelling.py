"""Operators 11 to 13: brute force, estimates, edge cases."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from seasonlab.llm import geometric_blocks as gb
from seasonlab.llm import queries as q
from seasonlab.llm.trie_pairs import spelling_variants
from seasonlab.llm.weighted_sampling import SAMPLES, arrival, fingerprint_documents, fingerprint_texts, likeness, weighted_samples

# 11: fingerprints


def weights(text):
    return Counter((text or "").encode().split())


def generalised_jaccard(a, b):
    every = set(a) | set(b)
    return sum(min(a[t], b[t]) for t in every) / max(1, sum(max(a[t], b[t]) for t in every))


def edits(rows):
    """(id, n, edited, next text) of rows in the operator's order, which the ids fix here."""
    rows = sorted(rows)
    for i, (d, t) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        cut = len(t) // 4
        yield d, len(t), t[: len(t) - cut] + after[:cut], after


def test_op11_matches_brute_force(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    got = {r["doc_id"]: r for r in q.op11_fingerprints(spark, sf_small).collect()}
    assert len(got) == len(rows)
    off_edited, off_next, prints, text_of = [], [], {}, dict(rows)
    for d, n, edited, after in edits(rows):
        r = got[d]
        assert r["n_chars"] == n and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        off_edited.append(r["near_edited"] - generalised_jaccard(weights(text_of[d]), weights(edited)))
        off_next.append(r["near_next"] - generalised_jaccard(weights(text_of[d]), weights(after)))
        assert prints.setdefault(text_of[d], r["fingerprint"]) == r["fingerprint"]
    for off in (off_edited, off_next):  # unbiased, and as close as so many samples are
        assert abs(np.mean(off)) < 0.02 and np.std(off) < 1.2 * 0.5 / SAMPLES**0.5


def test_collision_rate_is_generalised_jaccard(spark):
    rnd = random.Random(1)
    a = {t: rnd.choice([1, 2, 5, 30]) for t in range(60)}
    b = {t: rnd.choice([1, 3, 9]) for t in range(30, 100)}
    samples = 2000
    terms = spark.createDataFrame([(0, t, float(w)) for t, w in a.items()] + [(1, t, float(w)) for t, w in b.items()] + [(2, 7, 0.0), (2, 8, None)], "k int, t bigint, w double")
    out = {r["k"]: r["w"] for r in weighted_samples(terms, keys=["k"], term_col="t", weights=["w"], samples=samples).collect()}
    x, y = (np.array([out[k][i : i + 4] for i in range(0, 4 * samples, 4)]) for k in (0, 1))
    assert abs((x == y).mean() - generalised_jaccard(Counter(a), Counter(b))) < 4 * 0.5 / samples**0.5
    assert out[2] == ""
    with pytest.raises(ValueError):
        weighted_samples(terms, keys=["k"], term_col="t", weights=["w"], samples=6)


def test_arrivals_are_gamma_based(spark):
    """For weight S the least arrival of a term is exponential of rate S: the mean of its logarithm is -ln S minus Euler's constant."""
    terms = spark.range(40_000).withColumn("t", F.xxhash64("id"))
    for s in (1.0, 7.0):
        mean = terms.select(arrival(F.col("t"), F.lit(3), [F.lit(float(np.log(s)))])[0].alias("a")).agg(F.avg("a")).first()[0]
        assert abs(mean - (-np.log(s) - np.euler_gamma)) < 0.03


def test_fingerprint_edges(spark):
    rows = [(3, "a b c d e f g h"), (1, None), (2, ""), (5, "  \n\t"), (7, "é" * 9), (7, "é" * 9), (7, "other words"), (None, "nameless one"), (9, "w " * 30_000), (10, "x")]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id bigint, text string, fingerprint string, n bigint").repartition(4)
    out = fingerprint_documents(df).collect()
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_chars"]) for r in out) == sorted((-1 if d is None else d, len(t or "")) for d, t in rows)
    by = {r["doc_id"]: r for r in out if r["doc_id"] not in (7,)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert by[1]["fingerprint"] == by[2]["fingerprint"] == by[5]["fingerprint"] == "" and by[1]["near_next"] == 1.0 and by[1]["near_edited"] == 1.0
    assert by[2]["near_next"] == 0.0 and by[3]["edited_sha256"] == sha("a b c d e f " + "  \n") and by[10]["edited_sha256"] == sha("x")
    assert by[9]["n_chars"] == 60_000 and by[9]["edited_sha256"] == sha(("w " * 30_000)[:45_000] + "x")
    assert by[None]["edited_sha256"] == sha("nameless ")  # the first document is next to the last, and empty
    same = [r for r in out if r["doc_id"] == 7 and r["n_chars"] == 9]
    assert len(same) == 2 and same[0] == same[1]
    assert fingerprint_documents(df.limit(0)).count() == 0
    alone = fingerprint_documents(spark.createDataFrame([(1, "only one here")], "doc_id bigint, text string")).collect()[0]
    assert alone["near_next"] == 1.0 and alone["edited_sha256"] == sha("only one h" + "onl")


def test_fingerprints_are_native(spark, sf_small):
    texts = fingerprint_texts(spark.read.parquet(f"{sf_small}/documents.parquet"), keys=["doc_id"])
    plan = texts._jdf.queryExecution().executedPlan().toString() + q.op11_fingerprints(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan
    other = texts.select(F.col("doc_id").alias("other"), F.col("fingerprint").alias("b"))
    near = texts.join(other, texts.doc_id == other.other).agg(F.min(likeness(F.col("fingerprint"), F.col("b"))))
    assert near.first()[0] == 1.0


# 12: lexical search


def terms_of(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if ord(c) >= 128 or c.isalnum():
            word += c.lower() if c.isascii() else c
        elif word:
            out.append(word)
            word = ""
    return out


def ranked(docs, items, k):
    """Rows of (item_id, rank, doc_id, score) by scoring everything."""
    counts = [(d, Counter(terms_of(t))) for d, t in docs]
    big_n, big_l = sum(bool(c) for _, c in counts), sum(c.total() for _, c in counts)
    held = Counter(t for _, c in counts for t in c)
    out = []
    for item_id, text in items:
        asked, scored = Counter(terms_of(text)), []
        for d, c in counts:
            m = 75 + 25 * c.total() * big_n // big_l if c else 0
            score = sum(r * int(np.floor(1000 * np.log((2 * big_n + 2) / (2 * held[t] + 1)))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t, r in asked.items() if c[t])
            if score > 0:
                scored.append((-score, d is None, d or 0))
        out += [(item_id, n + 1, None if missing else d, -s) for n, (s, missing, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def found(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("block, postings, together", [(128, 400_000, 1024), (3, 60, 2)])
def test_search_matches_brute_force(spark, monkeypatch, block, postings, together):
    monkeypatch.setattr(gb, "SHARD_POSTINGS", postings)
    monkeypatch.setattr(gb, "ITEMS_TOGETHER", together)
    monkeypatch.setattr(gb.Search.__init__, "__defaults__", (block,))
    rnd = random.Random(3)
    word = lambda: f"w{int(rnd.paretovariate(0.6)) % 90}"
    docs = [(i, " ".join(word() for _ in range(rnd.choice([1, 5, 40, 200])))) for i in range(300)]
    docs += [(300, None), (301, ""), (302, " -!? "), (303, "w1 " * 5000), (304, docs[7][1]), (7, docs[7][1]), (None, docs[7][1]), (305, "W3 Ärger ärger ÄRGER w3.w3_w4\x00w5 中文 w3")]
    items = [(i, " ".join(word() for _ in range(rnd.choice([1, 3, 30])))) for i in range(7)]
    items += [(7, None), (8, ""), (9, "ÄRGER, w3; w3"), (9, "中文"), (10, "absent words"), (None, docs[7][1])]
    index = gb.index_documents(spark.createDataFrame([(*d, "clash") for d in docs], "doc_id bigint, text string, terms string").repartition(3))
    asked = spark.createDataFrame([(*i, "clash") for i in items], "item_id bigint, text string, doc_id string")
    assert found(gb.search(index, asked, k=6)) == ranked(docs, items, 6)
    assert gb.search(index.limit(0), asked).count() == 0 and gb.search(index, asked.limit(0)).count() == 0


def test_blocks_are_skipped_by_their_bounds():
    """Blocks fall away, and what is found is what scoring every document finds."""
    rnd = np.random.default_rng(5)
    topics = rnd.integers(0, 8, 4000)
    rows = [np.unique(np.r_[rnd.integers(0, 20, 6), 20 + 10 * t + rnd.integers(0, 10, 5)]) for t in topics]
    ends, term = np.cumsum([len(r) for r in rows]), np.concatenate(rows)
    impact = rnd.integers(1, 10**6, len(term))
    weight = np.r_[np.full(20, 300), np.full(80, 2500)]
    items = gb.Items([0, 1], [0, 1], [np.array([1, 2, 3, 31, 33, 35]), np.array([0, 5, 71])], [np.ones(6, int), np.array([1, 2, 1])], np.arange(100))
    own = gb.Search(items, weight, 5, block=32)
    own.shard(np.arange(4000), np.zeros(4000, bool), ends, term, impact)
    dense = np.zeros((4000, 100), np.int64)
    dense[np.repeat(np.arange(4000), np.diff(np.r_[0, ends])), term] = impact
    for best, terms, repeats in zip(own.best, items.terms, items.repeats, strict=True):
        score = dense[:, terms] @ (weight[terms] * repeats)
        order = np.lexsort((np.arange(4000), -score))[:5]
        assert best.doc.tolist() == order.tolist() and best.score.tolist() == score[order].tolist()
    every = sum(-(-int((term == t).sum()) // 32) for terms in items.terms for t in terms)
    assert own.blocks_scored < own.blocks and own.blocks_scored < 0.2 * every


def test_term_counts_fold_ascii_only():
    n, row, term, tf = gb.term_counts(pa.array(["Ab ab-É é", "", "é"]))
    assert n.tolist() == [4, 0, 1] and sorted(tf[row == 0].tolist()) == [1, 1, 2] and set(term[row == 2]) < set(term[row == 0])


# 13: spelling variants


def variants(words, ratio=5):
    near = {w: [v for v in words if one_apart(w, v)] for w in words}
    best = {w: min(vs, key=lambda v: (-words[v], v)) for w, vs in near.items() if vs}
    form = {w: v for w, v in best.items() if words[v] >= ratio * words[w]}
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None))
    return sorted(out)


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def test_variants_match_brute_force(spark):
    rnd = random.Random(8)
    words = {"".join(rnd.choice("aabé÷") for _ in range(rnd.randint(1, 5))): int(1 + rnd.paretovariate(0.4)) % 10**6 for _ in range(700)}
    words |= {"aaaaaaaaaa": 3, "aaaaaaaaa": 400, "aaaaaaaaaaa": 3, "a": 10**6, "x" * 300: 1, "x" * 301: 9}
    df = spark.createDataFrame([(w, n, "clash") for w, n in words.items()] + [(None, 4, "clash"), ("", 4, "clash"), ("lonely", None, "clash")], "word string, n bigint, root string").repartition(3)
    got = sorted(((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling_variants(df).collect()), key=lambda r: r[0])
    assert got == variants(words) and any(r[1] and r[2] != r[1] for r in got)
    halves = spark.createDataFrame([("abcdef", 3), ("abcdef", 2), ("abcdeg", 1)], "word string, n bigint")
    assert {r["word"]: (r["n"], r["form"], r["form_n"]) for r in spelling_variants(halves).collect()} == {"abcdef": (5, None, None), "abcdeg": (1, "abcdef", 5)}
    assert spelling_variants(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        spelling_variants(df, ratio=1)


def test_pair_groups_are_bounded_by_the_alphabet(spark):
    """A hub with every replacement of its first letter: one group, no listed pairs."""
    letters = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
    df = spark.createDataFrame([(c + "entre", 1 + (c == "z") * 9) for c in letters] + [("entre", 60)], "word string, n bigint")
    out = {r["word"]: (r["form"], r["n_near"], r["root"]) for r in spelling_variants(df).collect()}
    assert out["entre"] == (None, len(letters), "entre") and out["zentre"] == ("entre", len(letters), "entre") and out["centre"] == ("entre", len(letters), "entre")
