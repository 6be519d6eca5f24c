"""Spelling variants by a dictionary of trie node pairs.

The nodes of the trie of all words (their prefixes) and of the trie of the reversed
words (their suffixes) are numbered. A word stands in the dictionary under the pair
(prefix node, suffix node) of every split into two parts, and of every split that
skips one code point. Two words that skip a code point and share a pair differ by a
replacement there; a word that skips one and a whole word that share a pair differ by
that code point. So equal integer pairs are exact neighbours.

A pair names the code points before and behind one place, so it holds at most one
word for each code point of the alphabet and one whole word: groups are small
by construction, and neighbours are counted in them without listing pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasonlab.llm.common import scratch_folder, scratch_table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ROOT = 0  # number of the node of the empty prefix or suffix


def letter_runs(docs: DataFrame, *, keep: list[Column], text_col: str = "text", least: int = 1) -> DataFrame:
    """The ``keep`` columns and ``run``: every longest run of Latin letters (A-Z, a-z, U+00C0 to U+00FF) of at least ``least`` code points, A-Z in lower case."""
    found = F.regexp_extract_all(F.col(text_col), F.lit(f"[A-Za-zÀ-ÿ]{{{least},}}"), F.lit(0))
    runs = docs.select(*keep, F.explode(found).alias("run"))
    return runs.withColumn("run", F.translate("run", UPPER, LOWER))


def without_code_point(run: Column, place: Column) -> Column:
    """A text without the code point at ``place`` (from 0)."""
    return F.concat(F.substring(run, F.lit(1), place), F.substring(run, place + 2, F.length(run)))


def _numbered(parts: DataFrame, name: str, table) -> DataFrame:
    """A number above ROOT for each distinct part; written, so that it stays."""
    nodes = parts.where(F.col(name) != "").select(name).distinct()
    return table(nodes.withColumn(f"{name}_node", F.monotonically_increasing_id() + (ROOT + 1)), name)


def _with_node(rows: DataFrame, nodes: DataFrame, name: str) -> DataFrame:
    """Replace a part by its node's number. The empty part, which every word has, isn't looked up; others that many words share are split by the join."""
    empty = F.col(name) == ""
    rows = rows.withColumn(name, F.when(~empty, F.col(name)))
    found = rows.join(nodes, name, "left").withColumn(f"{name}_node", F.coalesce(f"{name}_node", F.lit(ROOT).cast("long")))
    return found.drop(name)


def _pairs(words: DataFrame, table) -> DataFrame:
    """``(prefix_node, suffix_node, word, n, skips, counts)``, a row for each split of each word.

    ``skips``: the split leaves out a code point. ``counts``: that code point is the first of
    a run of equal ones, so that a shorter word is met once however long the run is.
    """
    at = words.select("word", "n", F.explode(F.sequence(F.lit(0), F.length("word"))).alias("at"))
    splits = at.select("*", F.explode(F.array(F.lit(False), F.lit(True))).alias("skips")).where(~F.col("skips") | (F.col("at") < F.length("word")))
    rest = F.col("at") + F.when(F.col("skips"), 2).otherwise(1)
    repeated = (F.col("at") > 0) & (F.substring("word", F.col("at"), F.lit(1)) == F.substring("word", F.col("at") + 1, F.lit(1)))
    splits = splits.select(
        "word", "n", "skips", (F.col("skips") & ~repeated).alias("counts"),
        F.substring("word", F.lit(1), F.col("at")).alias("prefix"), F.substring("word", rest, F.length("word")).alias("suffix"),
    )
    whole = splits.where("NOT skips")
    forward, backward = _numbered(whole, "prefix", table), _numbered(whole, "suffix", table)
    return _with_node(_with_node(splits, forward, "prefix"), backward, "suffix")


def near_words(words: DataFrame, table) -> DataFrame:
    """``(word, n_near, best)`` of every word that has a neighbour: their number, and the most frequent one as (-n, word)."""
    pairs = table(_pairs(words, table), "pairs")
    member = F.struct((-F.col("n")).alias("n"), "word", "skips", "counts")
    groups = pairs.groupBy("prefix_node", "suffix_node").agg(F.collect_list(member).alias("held")).where(F.size("held") > 1)

    def others(m: Column) -> Column:
        near = F.filter("held", lambda x: F.when(x["skips"] & m["skips"], x["word"] != m["word"]).otherwise((x["skips"] & x["counts"]) | (m["skips"] & m["counts"])))
        return F.transform(near, lambda x: F.struct(x["n"].alias("n"), x["word"].alias("word")))

    met = groups.select(F.explode(F.transform("held", lambda m: F.struct(m["word"].alias("word"), others(m).alias("others")))).alias("m"))
    met = met.select("m.word", F.size("m.others").cast("long").alias("met"), F.array_min("m.others").alias("best")).where("met > 0")
    return met.groupBy("word").agg(F.sum("met").alias("n_near"), F.min("best").alias("best"))


def spelling_variants(words: DataFrame, *, ratio: int = 5) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for every distinct ``word`` with its frequency ``n``.

    Near words differ by exactly one inserted, deleted or replaced code point. A word's
    form is its most frequent near word (ties: the first in code-point order) if that is at least
    ``ratio`` (2 or more) times as frequent, else null; its root is where following
    forms ends, the word itself if it has none. n_near is 0 without near words.

    Rows that repeat a word are one word whose frequencies add up; null and empty words
    and null frequencies are left out; an empty table gives no rows. Other columns aren't read.
    """
    if ratio < 2:
        raise ValueError(f"ratio must be at least 2, or forms could go round in circles (got {ratio})")
    with scratch_folder(words.sparkSession, "spelling") as table:
        words = words.where("word <> '' AND n IS NOT NULL").groupBy("word").agg(F.sum("n").cast("long").alias("n"))
        words = table(words, "words")
        near = words.join(near_words(words, table), "word", "left")
        formed = (-F.col("best.n")) >= ratio * F.col("n")
        forms = near.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(formed, F.col("best.word")).alias("form"), F.when(formed, -F.col("best.n")).alias("form_n"),
        )
        forms = table(forms, "forms")
        roots = _roots(forms, table)
        out = forms.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
        return scratch_table(out, "variants")


def _roots(forms: DataFrame, table) -> DataFrame:
    """``(word, root)`` of every word with a form: pointers are doubled until all point to a word without one.

    A form is more frequent by the ratio, so a path is at most a logarithm of the largest frequency long.
    """
    at = table(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = table(at.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        at = step.drop("moved")
        if step.where("moved").isEmpty():
            return at
