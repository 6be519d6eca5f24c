"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import random
import sys
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from seasonlab.llm import packing, probminhash, substring  # noqa: E402
from seasonlab.llm import queries as q  # noqa: E402
from seasonlab.llm.bpe import ByteBPE, decode_ids, encode_texts  # noqa: E402
from seasonlab.llm.cap_filters import near_duplicate_vectors  # noqa: E402
from seasonlab.llm.chat import format_conversations, read_back, read_loss, reply_paths  # noqa: E402
from seasonlab.llm.components import connected_components  # noqa: E402
from seasonlab.llm.html_extract import extract_main_text, main_text  # noqa: E402
from seasonlab.llm.lang_id import fit, identify  # noqa: E402
from seasonlab.llm.norm_topk import top_k_products  # noqa: E402
from seasonlab.llm.stages import dedup_stage, language_stage, substring_stage  # noqa: E402
from seasonlab.llm.url_filter import Rule, judge_urls, page_edges  # noqa: E402

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, class_id string"


def docs_of(spark, rows):
    return spark.createDataFrame([(d, t, lang, "s", len(t or ""), "x", "y") for d, t, lang in rows], DOCS)


def prose(rnd, n):
    return [rnd.choice("abcdefgh") + str(rnd.randint(0, 400)) for _ in range(n)]


# HTML


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<p>", ""), ("plain words", "plain words"), ("<p>a<p>b", "a b"), ("<p>x<b>y</b>z<br>w</p>", "xyz w"),
    ("<article><p>one &amp; two&nbsp;&#51;</p><div class='ad'>buy</div><p>four</p></article>", "one & two 3 four"),
    ("<body><p>The real text of it</p><script>if (a < b) '</p>'</script><form>name<p>in</form><footer>end", "The real text of it"),
    ("<article>a 1 < 2 <!-- no --> b</article>", "a 1 < 2 b"), ("<div hidden>no</div><main><h1>T</h1><ul><li>u<li>v</ul></main>", "T u v"),
    ("<article><p title='a > b'>in</p><section class=\"comments\"><article>said</article></section></article>", "in"),
])
def test_main_text(page, text):
    assert main_text(page) == text


REAL = "<article><h1>Head</h1><p>The whole article of the page with its words</p></article>"


@pytest.mark.parametrize("page", [
    f"<body><form id='aspnetForm'>{REAL}</form></body>", f"<body><div class='no-sidebar'><nav>Home</nav>{REAL}</div><footer>end</footer></body>",
    f"<div class='layout with-nav'>{REAL}</div>", f"<div id='page-header-fixed'><div class='ad'>buy</div>{REAL}</div>",
    f"<body><div class='no-comments'>{REAL}</div></body>", f"{REAL}<div class='comments'><article>said this</article></div>",
    f"<form>{REAL.replace('article>', 'div>')}<nav>Home</nav></form>", f"<div class='with-nav'>{REAL.replace('article>', 'div>')}</div>",
    *(f"<body><div><{raw}><g>x</div>{REAL}</body>" for raw in ("svg", "math", "object", "noscript", "template", "iframe")),
    f"<body><svg><path d='x'>{REAL}</body>", f"<body><div><svg></div>{REAL}<svg></svg></body>",
])
def test_main_text_keeps_a_wrapped_article(page):
    assert main_text(page) == "Head The whole article of the page with its words"


PROSE = "<p>The river rose over night and the road to the mill is closed until Friday.</p><p>Nobody was hurt, says the mayor.</p>"
SAID = "The river rose over night and the road to the mill is closed until Friday. Nobody was hurt, says the mayor."


@pytest.mark.parametrize("page", [
    f"<div><a href=1>Home</a> <a href=2>News</a> <a href=3>Sport</a></div><div>{PROSE}</div><p><a href=4>Imprint</a></p>",  # no class names
    f"<ul><li>Home<li>News<li>Sport</ul><div class=x1>{PROSE}</div><div>Next page</div>",  # opaque ones, and no links
    f"<div class=kopfzeile>Mein Blog</div><table><tr><td><a href=1>Start</a><td><a href=2>Wetter</a></table>{PROSE}<div class=fuss>Kontakt</div>",  # German ones
    f"<div class=a1><div class=b2><div><a href=x>Top</a></div><div class=c3>{PROSE}</div><div><a href=1>A dog swam</a> <a href=2>Grass is cut</a></div></div></div>",  # nested
])
def test_main_text_without_article_is_found_by_the_scan(page, monkeypatch):
    assert main_text(page) == SAID
    from seasonlab.llm import html_extract
    monkeypatch.setattr(html_extract, "best_stretch", lambda score: (0, len(score)))
    assert main_text(page) != SAID


@pytest.mark.parametrize("part", ["<p class='warning'>{}</p>", "<div class='legal-history'><p>{}</p></div>", "<section class='search-results'>{}</section>", "<p id=copyright-law>{}</p>"])
def test_class_words_take_nothing_from_an_article(part):
    said = "Wires that hang down may carry a current."
    assert main_text(f"<article>{PROSE}{part.format(said)}</article>") == f"{SAID} {said}"
    assert main_text(f"<article>{PROSE}<div class='ad-box'>{said}</div><ul class='share-links'><li>{said}</ul><div class='comments'>{said}</div></article>") == SAID


def test_best_stretch_is_the_quadratic_maximum():
    from seasonlab.llm.html_extract import best_stretch
    rnd = random.Random(12)
    for _ in range(2000):
        score = [rnd.choice([-3, -1, -0.5, 0, 0.5, 1, 2]) for _ in range(rnd.randint(0, 14))]
        every = [(sum(score[a:b]), -a, -b) for a in range(len(score)) for b in range(a + 1, len(score) + 1)]
        a, b = best_stretch(score)
        assert (sum(score[a:b]) if b else 0) == max([0, *(t for t, _, _ in every)])
        assert b == 0 or not any(t == sum(score[a:b]) and -x >= a and -y <= b and (-x, -y) != (a, b) for t, x, y in every if (-x, -y) != (a, b) and -x >= a and -y <= b)


def test_main_text_is_linear_and_keeps_rows(spark):
    long = "<article>" + "<p>word " * 50_000 + "</article>"
    rows = [(1, "u", long, "t"), (1, "u", long, "t"), (None, None, None, "t")]
    out = extract_main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string, body string"), keep=[F.col("page_id")])
    assert sorted((r["page_id"] or 0, len(r["text"])) for r in out.collect()) == [(0, 0), (1, 249_999), (1, 249_999)]
    assert main_text("<a " * 20_000) == "" and main_text("'<\"" * 20_000)


# Embeddings


def test_near_vectors_edges(spark):
    rnd = np.random.default_rng(3)
    base = rnd.normal(size=(4, 16))
    rows = [(i, (base[i % 4] + 0.03 * rnd.normal(size=16)).tolist(), i % 2) for i in range(60)]
    rows += [(100, rows[0][1], 0), (101, rows[0][1], 0), (102, [2 * x for x in rows[0][1]], 0), (103, rows[0][1], None), (104, None, 0)]
    rows += [(105, [], 0), (106, [0.0] * 16, 0), (107, [None] * 16, 0), (108, [float("nan")] * 16, 0), (109, [float("inf")] * 16, 0)]
    rows += [(110, [1.0, 2.0], 0), (111, [1.0, 2.001], 0), (112, [1.0] + [0.0] * 15, 1), (113, [0.999] + [0.0] * 15, 1)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").withColumn("node", F.lit("clash")).repartition(3)
    got = sorted(tuple(r) for r in near_duplicate_vectors(df).select("vec_id", "n_links", "component_id", "kept").collect())
    assert got == brute.near_vectors(rows)
    assert near_duplicate_vectors(df.limit(0)).count() == 0


def test_near_vectors_recall_and_hot_cluster(spark, monkeypatch):
    from seasonlab.llm import cap_filters
    monkeypatch.setattr(cap_filters, "BLOCK", 40)
    rnd = np.random.default_rng(5)
    center = rnd.normal(size=64)
    rows = [(i, (center + rnd.uniform(0.02, 0.16) * rnd.normal(size=64)).tolist(), 7) for i in range(300)]
    rows += [(1000 + i, rnd.normal(size=64).tolist(), 7) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = sorted(tuple(r) for r in near_duplicate_vectors(df).select("vec_id", "n_links", "component_id", "kept").collect())
    want = brute.near_vectors(rows)
    assert sum(r[1] for r in want) > 20_000  # thousands of pairs near the threshold
    assert sum(r[1] for r in got) >= 0.9999 * sum(r[1] for r in want) and [r[2:] for r in got] == [r[2:] for r in want]


def test_near_vectors_bound_both_sides_of_a_hot_filter(spark, monkeypatch):
    from seasonlab.llm import cap_filters
    rnd = np.random.default_rng(8)
    center = rnd.normal(size=64)
    rows = [(i, (center + 0.05 * rnd.normal(size=64)).tolist(), 7) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    monkeypatch.setattr(cap_filters, "BLOCK", 40)
    monkeypatch.setattr(cap_filters, "LOOKING", 60)
    groups, whole = [], cap_filters._meeting

    def meeting(found, nodes):
        met = whole(found, nodes)
        groups.extend(r["count"] for r in met.groupBy(*cap_filters.KEYS).count().collect())
        return met

    monkeypatch.setattr(cap_filters, "_meeting", meeting)
    got = sorted(tuple(r) for r in near_duplicate_vectors(df).select("vec_id", "n_links", "component_id", "kept").collect())
    assert got == brute.near_vectors(rows) and len(groups) > 100 and max(groups) < 200  # a filter's 600 vectors never meet in one group


@pytest.mark.parametrize("dim, threshold, noise", [(16, 0.98, 0.14), (32, 0.9, 0.33)])
def test_near_vectors_recall_follows_dimension_and_threshold(spark, dim, threshold, noise):
    rnd = np.random.default_rng(dim)
    base = rnd.normal(size=(300, dim))
    v = np.concatenate([base, base + noise * rnd.normal(size=base.shape), base + noise * rnd.normal(size=base.shape)])
    df = spark.createDataFrame([(i, x.tolist(), 7) for i, x in enumerate(v)], "vec_id bigint, embedding array<double>, label int")
    got = {r["vec_id"]: r["n_links"] for r in near_duplicate_vectors(df, threshold=threshold).collect()}
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    want = (unit @ unit.T >= threshold).sum(axis=1) - 1
    assert want.sum() > 500 and sum(got.values()) >= 0.999 * want.sum() and all(got[i] <= n for i, n in enumerate(want))


def test_near_vectors_hold_a_slice_of_the_looking_side():
    import weakref

    import pyarrow as pa

    from seasonlab.llm.cap_filters import _verify
    rnd = np.random.default_rng(9)
    alive, most = [], []

    def batches():
        for b in range(40):
            v = pa.array(rnd.normal(size=(50, 8)).tolist(), pa.list_(pa.float64()))
            batch = pa.RecordBatch.from_pydict({
                "label": [1] * 50, "filter": [1] * 50, "block": [0] * 50, "part": [0] * 50, "stored": [b == 0] * 50,
                "node": [b"%d" % (50 * b + i) for i in range(50)], "v": v, "copies": [1] * 50,
            })
            alive.append(weakref.ref(batch))
            yield batch
            del batch, v
            most.append(sum(r() is not None for r in alive))

    assert sum(b.num_rows for b in _verify(0.9)(batches())) > 0 and max(most) <= 3


# Chat


def test_reply_trees(spark):
    rows = [("c", 1, None, "system", "s", 0.0), ("c", 2, 1, "user", "hi", 1.0), ("c", 3, 2, "assistant", "bad", -1.0), ("c", 4, 2, "assistant", "good", 2.0),
            ("c", 5, 4, "user", None, None), ("c", 6, 4, "user", "more", 0.5), ("d", 1, 99, "user", "orphan", 0.0), ("e", 1, 2, "user", "x", 0.0), ("e", 2, 1, "user", "y", 0.0),
            (None, 1, None, "user", "z", 0.0), ("c", None, 1, "user", "nameless", 0.0)]
    nodes = spark.createDataFrame(rows, "conv_id string, node bigint, parent bigint, role string, text string, score double").withColumn("branch", F.lit("clash"))
    paths = reply_paths(nodes).collect()
    found = {}
    for p in paths:
        found.setdefault((p["conv_id"], p["branch"]), []).append((p["up"], p["node"]))
    assert {k: [n for _, n in sorted(v, reverse=True)] for k, v in found.items()} == {
        ("c", 1): [1, 2, 4, 6], ("c", 2): [1, 2, 4, 5], ("c", 3): [1, 2, 3], ("d", 1): [1], (None, 1): [1]}
    out = format_conversations(nodes, branches=1).select("conv_id", read_back(F.col("formatted")).alias("t"), read_loss(F.col("formatted"), F.col("loss_mask")).alias("loss")).collect()
    best = {r["conv_id"]: ([(t["role"], t["text"]) for t in r["t"]], r["loss"]) for r in out}
    assert best["c"] == ([("system", "s"), ("user", "hi"), ("assistant", "good"), ("user", "more")], ["good"]) and best["d"] == ([("user", "orphan")], [])
    assert format_conversations(nodes.limit(0)).count() == 0


def test_chat_escapes_are_reversible(spark):
    texts = ["<|im_end|>\n", "\\", "\\s\\p\\n", "<", "|im_end|>", "a<|b\\<\\|", "", "é👍<<||", "x" * 100_000]
    nodes = spark.createDataFrame([("c", i, i - 1 if i else None, "assis\ntant<|" if i % 2 else "assistant", t, 0.0) for i, t in enumerate(texts)],
                                  "conv_id string, node bigint, parent bigint, role string, text string, score double")
    r = format_conversations(nodes).select("formatted", "loss_mask", read_back(F.col("formatted")).alias("t"), read_loss(F.col("formatted"), F.col("loss_mask")).alias("loss")).collect()[0]
    assert [t["text"] for t in r["t"]] == texts and r["loss"] == texts[::2] and r["t"][1]["role"] == "assis\ntant<|"
    assert r["formatted"].count("<|im_end|>") == len(texts)
    for span in r["loss_mask"]:
        assert r["formatted"][span["turn_start"] :].startswith("<|im_start|>")


# BPE


def test_bpe_random_texts_and_long_pretokens():
    bpe = ByteBPE.load(q.BPE_RANKS, q.BPE_PATTERN)
    library = tiktoken.Encoding("own", pat_str=q.BPE_PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})
    rnd = random.Random(1)
    texts = ["".join(rnd.choice("ab \n\t\x1c\x85  éñ中文ʼs'sll've12٣!?…<|endoftext|>　👍🏽é") for _ in range(rnd.randint(0, 40))) for _ in range(4000)]
    texts += ["a" * 50_000 + "=-" * 5000 + "\n" * 5000 + " " * 7000 + "ab" * 9999, "", " ", "\n", " a", "a "]
    for text, ids in zip(texts, bpe.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text), repr(text[:60])


def test_bpe_tokens_encode_to_themselves():
    """What the rank queue assumes of a vocabulary."""
    bpe = ByteBPE.load(q.BPE_RANKS, q.BPE_PATTERN)
    for (_, i), ids in zip(bpe.ranks.items(), bpe.merge_words(list(bpe.ranks)), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == [i]


def test_bpe_rows(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "two  words", "x"), (3, "two  words", "x"), (None, "é", "x")], "doc_id bigint, text string, ids string")
    enc = encode_texts(df, q.BPE_RANKS, q.BPE_PATTERN, keep=[F.col("doc_id")])
    out = decode_ids(enc, q.BPE_RANKS, q.BPE_PATTERN).collect()
    assert sorted((r["doc_id"] or 0, bytes(r["decoded"]).decode()) for r in out) == [(0, "é"), (1, ""), (2, ""), (3, "two  words"), (3, "two  words")]
    assert encode_texts(df.limit(0), q.BPE_RANKS, q.BPE_PATTERN, keep=[F.col("doc_id")]).count() == 0


# Packing


def test_packing_edges(spark, monkeypatch):
    monkeypatch.setattr(packing, "FAN_IN", 3)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rnd = random.Random(4)
    rows = [(i, " ".join(prose(rnd, rnd.choice([0, 1, 3, 40, 400])))) for i in range(150)] + [(200, None), (201, "É \x1c　ß<|endoftext|>x\n\n'S"), (202, "w " * 9000)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id bigint, text string, bin string").repartition(10)
    expected = {d: [*library.encode(t or "", add_special_tokens=False).ids, 1] for d, t in rows}
    pieces = [r.asDict() for r in packing.pack_documents(df, q.WORD_BPE, sequence_tokens=256).collect()]
    assert brute.check_packing(pieces, expected, 256) < 0.03
    whole = [r.asDict() for r in packing.pack_documents(df, q.WORD_BPE, sequence_tokens=256, by_word=False).collect()]
    assert sum(p["length"] for p in whole) == sum(p["length"] for p in pieces)
    assert packing.pack_documents(df.limit(0), q.WORD_BPE).count() == 0
    again = packing.pack_documents(df.where("doc_id = 202").union(df.where("doc_id = 202")), q.WORD_BPE).collect()
    assert sum(r["length"] for r in again) == 2 * len(expected[202])


def test_folded_words_share_ids_and_encode_like_whole_texts():
    tokenizer = packing.Tokenizer(q.WORD_BPE, True)
    odd = [
        "", " ", "Été été$$$ ÉTÉ.", "a×. a÷. ß% ÿ# ŸY.", "it's 'SO' l'eau*** don't!", "x<|endoftext|>Y. <|", "\x01 a\x01.", "A\u0301. e\u0338 a<\u0338 =\u0338",
        "STRASSE-İı Σας. 漢字. 1a.2É_3", "\x1cA.\x85B;\u2028c", "a\tB.\x0b\x0cC",
    ]
    assert tokenizer.encode(odd) == tokenizer._encode(odd)
    assert tokenizer.encode([]) == []
    fresh = packing.Tokenizer(q.WORD_BPE, True)
    assert fresh.encode(["Été été$$$ ÉTÉ."]) == fresh._encode(["Été été$$$ ÉTÉ."])
    assert set(fresh.memory) == {"été".encode(), b"$$$", b"."}


# Substrings


@pytest.mark.parametrize("hot", [1, 256])
def test_substring_edges(spark, monkeypatch, hot):
    monkeypatch.setattr(substring, "HOT_PASSAGES", hot)
    rnd = random.Random(6)
    passage, short = prose(rnd, 60), prose(rnd, 34)
    rows = [(i, " ".join(prose(rnd, rnd.randint(0, 30)) + passage + prose(rnd, rnd.randint(0, 30)))) for i in range(25)]
    rows += [(30, " ".join(short)), (31, "  ".join(short)), (32, "\n".join(passage[:35])), (33, None), (34, ""), (35, "la " * 400), (36, " ".join(["x", *passage[1:40]]))]
    rows += [(37, " ".join(prose(rnd, 300))), (37, rows[0][1]), (38, "　".join(passage)), (39, ("do re mi " * 12) + " ".join(prose(rnd, 50)))]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id bigint, text string, starts string").repartition(4)
    out = substring.remove_repeats(df, keep=[F.col("doc_id"), F.col("starts")])
    got = sorted((r["doc_id"], r["n_words"], r["n_removed"], r["d"]) for r in out.withColumn("d", F.sha2("kept_text", 256)).collect())
    assert got == brute.without_repeats(rows)
    for r in out.collect():
        assert sum(b - a for a, b in r["removed"]) == r["n_removed"]
    twice = df.where("doc_id = 30 OR doc_id = 37").union(df.where("doc_id = 37"))
    assert sorted((r["doc_id"], r["n_words"] - r["n_removed"]) for r in substring.remove_repeats(twice, keep=[F.col("doc_id")]).collect()) == [(30, 34), (37, 0), (37, 0), (37, 0), (37, 0)]
    assert substring.remove_repeats(df.limit(0), keep=[F.col("doc_id")]).count() == 0


def test_suffix_automaton_counts_places():
    from collections import Counter
    rnd = random.Random(2)
    for _ in range(300):
        passages = [([rnd.choice([b"a", b"b", b"c"]) for _ in range(rnd.randint(3, 12))], rnd.choice([1, 1, 2])) for _ in range(rnd.randint(2, 6))]
        places = Counter()
        for words, times in passages:
            for i in range(len(words) - 2):
                places[tuple(words[i : i + 3])] += times
        automaton = substring.SuffixAutomaton()
        for words, times in passages:
            automaton.add(words, times)
        automaton.total()
        for words, _ in passages:
            assert automaton.repeats(words, 3) == [i for i in range(len(words) - 2) if places[tuple(words[i : i + 3])] > 1]


# Near-duplicate texts


def near_rows(rnd):
    base = prose(rnd, 120)
    rows = []
    for i in range(80):
        words = list(base)
        for at in rnd.sample(range(120), rnd.choice([0, 0, 1, 2, 3, 4, 6])):
            words[at] = f"new{i}"
        rows.append((i, " ".join(words)))
    rows += [(90, None), (91, ""), (92, " \n"), (93, "one two"), (94, "one\ttwo"), (95, "one two three four"), (96, "la " * 30), (97, "la " * 50)]
    return rows + [(100 + i, " ".join(prose(rnd, 50))) for i in range(20)] + [(5, rows[5][1])]


def test_near_texts_edges(spark):
    rows = near_rows(random.Random(8))
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id bigint, text string, bands string").repartition(4)
    out = probminhash.near_duplicate_classes(df)
    assert sorted((r["doc_id"], r["class_id"], r["kept"]) for r in out.collect()) == brute.near_texts(rows)
    assert probminhash.near_duplicate_classes(df.limit(0)).count() == 0
    nameless = spark.createDataFrame([(None, "a b c d e f"), (4, "a b c d e f"), (None, "z z z z z")], "doc_id bigint, text string")
    assert sorted(((r["doc_id"], r["class_id"], r["kept"]) for r in probminhash.near_duplicate_classes(nameless).collect()), key=repr) == [(4, 4, True), (None, 4, False), (None, None, True)]


def test_near_texts_without_leader_rounds(spark, monkeypatch):
    """What leaders leave is compared in blocks."""
    monkeypatch.setattr(probminhash, "LEADER_ROUNDS", 1)
    monkeypatch.setattr(probminhash, "BLOCK", 10)
    rows = near_rows(random.Random(9))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted((r["doc_id"], r["class_id"], r["kept"]) for r in probminhash.near_duplicate_classes(df).collect()) == brute.near_texts(rows)


def test_repeated_lines_lose_no_links():
    """Texts of similarity 0.8 whose own shingles repeat up to a thousand times share a band."""
    from seasonlab.llm.probminhash import band_hashes, signatures
    rnd = np.random.default_rng(9)
    for repeats in (1, 10, 100, 1000, 10**6):
        lost = 0
        for _ in range(300):
            value = rnd.integers(1, 2**63, 100).astype(np.uint64)
            texts = [np.sort(value[:90]), np.sort(np.r_[value[:80], value[90:]])]
            row, both = np.repeat([0, 1], 90), np.concatenate(texts)
            count = np.where(np.isin(both, value[:80]), 1, repeats)
            a, b = band_hashes(signatures(row, both, count, 2))
            lost += not (a == b).any()
        assert lost == 0, repeats


def test_probminhash_estimates_probability_jaccard():
    rnd = np.random.default_rng(1)
    shared, left, right = (rnd.integers(1, 1 << 62, n).astype(np.uint64) for n in (300, 60, 60))
    row = np.repeat([0, 1], 360)
    value = np.concatenate([shared, left, shared, right])
    agree = []
    for salt in range(20):
        s = probminhash.signatures(row, value + np.uint64(salt), np.ones(720, int), 2)
        agree.append((s[0] == s[1]).mean())
    assert abs(np.mean(agree) - 300 / 420) < 0.02
    assert (probminhash.signatures(row[:1], value[:1], np.ones(1, int), 1) == value[0]).all()


# Top-k


def test_top_k_edges(spark):
    rnd = np.random.default_rng(2)
    rows = [(i, (rnd.normal(size=8) * rnd.choice([0.01, 1, 30])).tolist(), 0) for i in range(200)]
    rows += [(250, rows[0][1], 0), (300, rows[0][1], 0), (301, None, 0), (302, [None] * 8, 0), (303, [float("nan")] * 8, 0), (350, [0.0] * 8, 0), (351, [-1e-9] * 8, 0)]
    schema = "vec_id bigint, embedding array<double>, label int"
    df = spark.createDataFrame(rows, schema).withColumn("score", F.lit("clash")).repartition(3)
    got = sorted(tuple(r) for r in top_k_products(df, F.col("vec_id") % 50 == 0).select("query_id", "rank", "vec_id", "score").collect())
    assert got == brute.top_products(rows)
    few = spark.createDataFrame([(0, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (None, [1.0, 0.0], 0), (0, [1.0, 0.0], 0), (50, [1.0], 0)], schema)
    assert [tuple(r) for r in top_k_products(few, F.col("vec_id") % 50 == 0).orderBy("rank").collect()] == [(0, 1, 1, 65536), (0, 2, None, 65536)]
    assert top_k_products(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_top_k_multiplies_large_components_exactly(spark):
    schema = "vec_id bigint, embedding array<double>, label int"
    rows = [(0, [1e6, 1.0], 0), (1, [1e6, 0.0], 0), (2, [1e6, 1.0], 0), (3, [-1e6, 5.0], 0), (4, [4e6, 1.0], 0)]
    got = sorted((r["rank"], r["vec_id"], r["score"]) for r in top_k_products(spark.createDataFrame(rows, schema), F.col("vec_id") % 50 == 0).collect())
    big = 256 * 10**6
    assert got == [(1, 4, 4 * big * big + 65536), (2, 2, big * big + 65536), (3, 1, big * big), (4, 3, -big * big + 256 * 1280)]
    for huge in (3e7, 2.0**52, 1e300):
        with pytest.raises(Exception, match="64 bits"):
            top_k_products(spark.createDataFrame([(0, [huge, 1.0], 0), (1, [huge, 1.0], 0)], schema), F.col("vec_id") % 50 == 0).collect()


def test_top_k_prunes_by_coordinates_and_lengths(spark, monkeypatch):
    """Both prunings are reached, and change nothing."""
    from seasonlab.llm import norm_topk
    rnd = np.random.default_rng(4)
    centers = rnd.normal(size=(12, 6))
    rows = [(i, ((centers[i % 12] + rnd.normal(size=6) * 0.05) * 2.0 ** rnd.integers(-3, 4)).tolist(), 0) for i in range(600)]
    seen = []
    whole = norm_topk._agreeing
    monkeypatch.setattr(norm_topk, "_agreeing", lambda q, c, v, n: seen.append((len(v), len(whole(q, c, v, n)))) or whole(q, c, v, n))
    ids, v = np.arange(600), np.floor(256 * np.array([r[1] for r in rows])).astype(np.int64)
    order = np.argsort(-np.linalg.norm(v.astype(float), axis=1), kind="stable")
    ids, v = ids[order], v[order]
    q_ids = np.arange(0, 600, 50)
    q = v[np.argsort(ids)][q_ids]
    score = q @ v.T
    score[ids[None, :] == q_ids[:, None]] = norm_topk.NO_SCORE
    beat = np.sort(score, axis=1)[:, -5]
    n, best, found = norm_topk._best(q, q_ids, beat, ids, v, np.linalg.norm(v.astype(float), axis=1), 5)
    for i in range(len(q_ids)):
        want = sorted((-int(s), int(d)) for s, d in zip(score[i], ids, strict=True))[:5]
        assert [(-int(s), int(d)) for s, d in zip(best[n == i], found[n == i], strict=True)] == want
    assert seen and sum(after for _, after in seen) < 0.7 * sum(before for before, _ in seen)


# Language


def test_language_edges(spark):
    en, fr = "the ship and the harbour were there that night ", "le navire est dans les rues avec une lune et des "
    rows = [(i, (en if i % 2 else fr) * (1 + i % 4), "en" if i % 2 else "fr") for i in range(40)] + [(50, None, "en"), (51, "", "en"), (52, "123 !?", "fr"), (53, en * 5000, None), (None, fr, "de")]
    docs = docs_of(spark, rows)
    model = q.fit_languages(docs)
    out = {r["doc_id"]: r for r in identify(docs, model, keep=[F.col("doc_id"), F.col("kept")]).collect()}
    assert all(out[d]["lang_pred"] == lang for d, _, lang in rows[:40]) and out[53]["lang_pred"] == "en" and out[None]["lang_pred"] == "fr"
    assert [(out[d]["lang_pred"], out[d]["score"], out[d]["accepted"]) for d in (50, 51, 52)] == [("und", 0.0, False)] * 3
    kept = language_stage(spark, docs, "")
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.where("doc_id IS NOT NULL").collect()) == [*range(40), 53]
    far = identify(docs_of(spark, [(1, "ж" * 50 + " щъ ыю", None)]), model, keep=[]).collect()[0]
    assert not far["accepted"] and far["lang_pred"] in ("en", "fr")
    empty = docs.limit(0)
    assert fit(empty, key=F.col("doc_id")).languages == [] and language_stage(spark, empty, "").count() == 0


def test_language_matches_plain_nearest_centroid(spark, sf_small):
    """Label and score against a plain version of the model's rule, text by text."""
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    model = q.fit_languages(docs)
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    for r in identify(docs, model, keep=[F.col("doc_id")]).collect():
        text = texts[r["doc_id"]]
        if not text or not any(c.isalpha() for c in text):
            assert (r["lang_pred"], r["score"], r["accepted"]) == ("und", 0.0, False)
            continue
        kept = "".join(c if c.isalpha() and c.isascii() or ord(c) >= 128 else " " for c in text.lower())
        raw = " ".join(["", *kept.split(" "), ""]).encode("utf-8")
        while b"  " in raw:
            raw = raw.replace(b"  ", b" ")
        v = np.zeros(2 << 12)
        for i in range(len(raw) - 1):
            v[((raw[i] << 8 | raw[i + 1]) * 2654435761 % 2**32) >> 20] += 1
        for i in range(len(raw) - 2):
            v[(1 << 12) + (((raw[i] << 16 | raw[i + 1] << 8 | raw[i + 2]) * 2246822519 % 2**32) >> 20)] += 1
        v = np.log1p(v) * model.idf
        cosine = model.centers @ (v / np.linalg.norm(v))
        assert r["lang_pred"] == model.languages[int(cosine.argmax())] and abs(r["score"] - cosine.max()) < 1e-4


def test_language_sample_is_bounded_in_rows(spark, monkeypatch):
    from seasonlab.llm import lang_id
    rows = [(1, f"the ship and the harbour {i % 50} {'abcdefghij'[i % 10] * (1 + i % 7)}", "en") for i in range(500)] + [(1, "le navire", "fr")] * 300
    seen, learn = [], lang_id.learn
    monkeypatch.setattr(lang_id, "learn", lambda counts, named: seen.append(sorted(named)) or learn(counts, named))
    fit(docs_of(spark, rows), key=F.col("doc_id"), rows_per_language=20)
    assert seen == [["en"] * 20 + ["fr"]]


# URLs


def test_url_components(spark):
    rules = [Rule("allow", "com", "/"), Rule("block", "bad.com", "/x/"), Rule("allow", "www.bad.com", "/x/"), Rule("block", "net", "/no/")]
    link = '<link rel="canonical" href="{}">'.format
    rows = [(1, "http://BAD.com/x/1?q#f", None), (2, "https://www.bad.com/x/1", link("http://a.net/no/")), (3, "http://alias.org/p", link("http://bad.com/x/9")),
            (4, "http://far.org/q#frag", link("http://alias.org/p")), (5, "http://clean.org/", link("http://far2.org/")), (6, None, None), (7, "no scheme", ""), (8, "http://far.org/q", None),
            (9, "http://r.org", '<META content="0; url=/rel" http-equiv=refresh>'), (10, "http://r.org/rel", link("//s.net/no/z")), (10, "http://r.org/rel", None), (11, "http://net/NO/", None)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("rule", F.lit("clash"))
    got = sorted(((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in judge_urls(df, rules).collect()))
    assert got == [(1, "bad.com", "/x/1", "bad.com/x/", "block"), (2, "www.bad.com", "/x/1", "www.bad.com/x/", "allow"), (3, "alias.org", "/p", None, "block"), (4, "far.org", "/q", None, "block"),
                   (5, "clean.org", "/", None, "allow"), (6, "", "", None, "allow"), (7, "", "", None, "allow"), (8, "far.org", "/q", None, "block"), (9, "r.org", "", None, "block"),
                   (10, "r.org", "/rel", None, "block"), (10, "r.org", "/rel", None, "block"), (11, "net", "/NO/", None, "allow")]
    moved = spark.createDataFrame([("http://clean.org/", "http://t.net/no/")], "src string, dst string")
    assert {r["page_id"]: r["verdict"] for r in judge_urls(df, rules, redirects=moved).collect()}[5] == "block"
    assert judge_urls(df.limit(0), rules).count() == 0 and judge_urls(df, [], html_col=None).where("verdict = 'allow'").count() == len(rows)


@pytest.mark.parametrize("url, html, dst", [
    ("http://h.org/x/y/p", '<link rel=canonical href="../z">', "h.org/x/z"), ("http://h.org/x/p", '<link rel=canonical href="?q=1">', "h.org/x/p?q=1"),
    ("http://h.org", '<link rel=canonical href="z">', "h.org/z"), ("http://h.org/x/p", '<base href="/b/c/"><link rel=canonical href="./z/">', "h.org/b/c/z/"),
    ("http://h.org/x", '<base href="//o.net/d/"><link rel=canonical href="../../z?a=1&#38;b=2&amp;c">', "o.net/z?a=1&b=2&c"), ("http://h.org/x", '<link rel=canonical href="http&#58;&#x2F;/o.net">', "o.net/"),
    ("http://h.org/a/b/c", '<link rel=canonical href="../..">', "h.org/"), ("http://h.org/a/", '<link rel=canonical href=".">', "h.org/a/"),
])
def test_links_are_resolved(spark, url, html, dst):
    from seasonlab.llm.url_filter import alias_of
    edges = page_edges(spark.createDataFrame([(url, html)], "url string, html string"))
    assert [r[0] for r in edges.select(alias_of(F.col("dst"))).collect()] == [dst]
    assert page_edges(spark.createDataFrame([(url, "<link rel=canonical href='#top'><link rel=canonical href='mailto:x'>")], "url string, html string")).count() == 0


def test_a_url_without_a_path_is_its_root(spark):
    rows = [(1, "http://c.org", '<link rel=canonical href="http://bad.net/x/">'), (2, "https://C.org/", None), (3, "http://c.org/a/../#f", None), (4, "http://c.org/a", None)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r["page_id"]: (r["path"], r["verdict"]) for r in judge_urls(df, [Rule("block", "net", "/x/")]).collect()}
    assert got == {1: ("", "block"), 2: ("/", "block"), 3: ("/a/../", "block"), 4: ("/a", "allow")}


def test_page_edges_takes_all_links(spark):
    page = """<!-- <link rel="canonical" href="http://no.net/1"> --><script>'<meta http-equiv="refresh" content="0; url=http://no.net/2">'</script>
        <link rel='alternate canonical' href='http://a.net/'><LINK href="http://b.net/" rel=canonical><link rel="canonicalized" href="http://no.net/3">
        <link rel="stylesheet" href="/canonical"><meta http-equiv=refresh content="0; url=http://c.net/"><meta http-equiv="refresh" content="0;URL='http://d.net/'">"""
    df = spark.createDataFrame([("http://s.org/", page), ("http://t.org/", '<link rel="canonical" href="/x"/>')], "url string, html string")
    assert sorted(r["dst"] for r in page_edges(df).collect()) == ["http://a.net/", "http://b.net/", "http://c.net/", "http://d.net/", "http://t.org/x"]


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(10, 60)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    out = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b").collect()}
    assert out == {**{i: 100 for i in range(100, 161)}, **{i: 5 for i in [5, *range(10, 60)]}, 200: 200, 201: 200}


def test_names_of_results_are_refused(spark):
    df = docs_of(spark, [(1, "some words", "en")])
    model = q.fit_languages(df.limit(0))
    for call, name in (
        (lambda c: extract_main_text(df, keep=c, html_col="text"), "text"), (lambda c: identify(df, model, keep=c), "Score"),
        (lambda c: encode_texts(df, q.BPE_RANKS, q.BPE_PATTERN, keep=c), "ids"), (lambda c: substring.remove_repeats(df, keep=c), "n_words"),
    ):
        with pytest.raises(ValueError, match="names of results"):
            call([F.col("kept").alias(name)])


# Stages


def test_stages_keep_clashing_columns(spark):
    rnd = random.Random(11)
    text = " ".join(prose(rnd, 80))
    docs = docs_of(spark, [(2, text, "en"), (1, text, "en"), (1, text, "en"), (3, " ".join(prose(rnd, 80)), "en"), (4, None, None), (5, "", None)])
    out = dedup_stage(spark, docs, "")
    assert out.columns == docs.columns and sorted(r["doc_id"] for r in out.collect()) == [1, 3, 4, 5]
    cut = substring_stage(spark, docs, "")
    assert cut.columns == docs.columns
    assert sorted((r["doc_id"], r["text"] == "", r["n_chars"]) for r in cut.collect())[:3] == [(1, True, 0), (1, True, 0), (2, True, 0)]
    assert {r["doc_id"]: r["text"] for r in cut.collect()}[4] is None
    for stage in (dedup_stage, substring_stage):
        assert stage(spark, docs.limit(0), "").count() == 0
