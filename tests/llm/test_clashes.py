"""Constructed collisions, rules that share their text, and columns named like anything used inside."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing, near_dup, quality_rules, toxicity, url_filter
from tidemark.llm.words import Block, Words

DOCS = "doc_id long, text string, source string, _may boolean, _turn int, _id long, _from string, _sum long, repeats string, _wanted int, _tile int, _group int, h1 int, h2 int, half int"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, s, None, 7, -i, "x", 3, "r", 1, 2, 3, 4, 5, 6) for i, t, s in rows], DOCS)


@pytest.fixture(scope="module")
def thue_morse():
    """Two words of 4096 letters whose polynomial hashes modulo 2**64 agree at any base."""
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(4096))
    return one, one.translate(str.maketrans("ab", "ba"))


def test_words_of_equal_polynomials_are_told_apart(spark, thue_morse):
    one, other = thue_morse
    block = Block.of([f"{one} {other} {one}".encode()])
    words = Words.of(block)
    assert len(set(words.strong_hashes(block).tolist())) == 2
    rows = [(1, f"x y {one} z", "a"), (2, f"x y {other} z", "a"), (3, f"X y {one} z", "a")]
    found = near_dup.near_duplicates(documents(spark, rows), width=3, percent=85)
    assert {r.doc_id: r.component_id for r in found.collect()} == {1: 1, 2: 2, 3: 1}
    repeats = quality_rules.judge(quality_rules.RuleModel(None, np.array([0.0, 1.0]), 0.5), [f"x {one} y x {other} y".encode()])
    assert 0 in repeats[4].to_pylist()  # no window of three words is there twice


def test_strong_hashes_follow_the_words():
    rnd = random.Random(3)
    texts = [" ".join(rnd.choice(["a", "B", "b", "é", "long-word"]) for _ in range(rnd.randint(0, 9))).encode() for _ in range(50)]
    block = Block.of(texts)
    words = Words.of(block)
    for lower in (False, True):
        known = {}
        for word, made in zip([w for t in texts for w in t.split()], words.strong_hashes(block, lower).tolist(), strict=True):
            assert known.setdefault(word.lower() if lower else word, made) == made
        assert len(set(known.values())) == len(known)


def test_rules_that_share_their_text(spark):
    rules = spark.createDataFrame([("example.co", "m/", "block"), ("other.org", "/", "block")], "host string, path string, verdict string")
    pages = spark.createDataFrame(
        [(1, "http://example.com/zz", 5), (2, "http://example.co/m/", 6), (3, "http://a.other.org/x", 7)], "page_id long, url string, _keys int")
    found = {r.page_id: r for r in url_filter.judge(pages, rules).collect()}
    assert [found[i].verdict for i in (1, 2, 3)] == ["allow", "allow", "block"] and found[1].rule is None
    assert [found[i]["_keys"] for i in (1, 2, 3)] == [5, 6, 7]


def test_columns_of_any_name_stay(spark):
    rnd = random.Random(5)
    rows = [(i, " ".join(rnd.choice(["a", "b", "c", "d", "e"]) + str(rnd.randint(0, 50)) for _ in range(40)), "ab"[i % 2]) for i in range(20)]
    rows += [(100 + i, t, s) for i, t, s in rows[:5]]
    given = documents(spark, rows)
    left = near_dup.without_near_duplicates(given)
    assert left.columns == given.columns and sorted(map(tuple, left.collect())) == sorted(map(tuple, given.where("doc_id < 100").collect()))
    mixed = mixing.mix(given)
    made = mixing.repeated(given, mixed)
    assert made.columns == given.columns and made.exceptAll(given.crossJoin(spark.range(3)).drop("id")).isEmpty()
    times = {r.doc_id: r.repeats for r in mixed.collect()}
    assert made.groupBy("doc_id").count().where(F.col("count") < 1).isEmpty() and made.count() == sum(times.values())


def test_targets_are_met(spark):
    """The words taken of each source come near its target."""
    rnd = random.Random(6)
    rows = [(i, "w " * rnd.randint(1, 60), rnd.choice(["a", "a", "a", "b", "c", None])) for i in range(900)]
    found = mixing.mix(documents(spark, rows)).groupBy("source").agg(
        F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max("size").alias("largest"), F.max("source_size").alias("size")).collect()
    assert len(found) == 4
    for r in found:
        assert abs(r.taken - r.target) <= r.largest and r.target <= 3 * r["size"]


def test_document_frequencies_against_a_plain_count(spark, monkeypatch):
    texts = ["bad bad word", "good word", "Bad, day", "fine day", "bad luck", None, ""]
    given = documents(spark, [(i, t, "a") for i, t in enumerate(texts * 6)])
    labels = spark.createDataFrame([(i, 0, int("bad" in (t or "").lower())) for i, t in enumerate(texts * 6)] + [(999, 0, 1)], "doc_id long, quality int, toxic int")

    def counted():
        found = toxicity.document_frequencies(given, labels)
        return sorted(tuple(r) for r in found.where("kind < 1").select("kind", "word", *toxicity.CELLS).collect())

    by_cascades = counted()
    usable = {r.doc_id: r.label for r in toxicity.usable_labels(labels, "toxic").collect()}
    number = [sum(1 for i, t in enumerate(texts * 6) if t is not None and usable.get(i) == label) for label in (1, 0)]
    totals = [r for r in by_cascades if r[0] == -1]
    assert [sum(r[2] + r[3] for r in totals), sum(r[4] + r[5] for r in totals)] == number
    monkeypatch.setattr(toxicity, "MOST_LABELLED", 0)  # more labels than cascades hold: joined
    assert [r for r in counted() if r[0] == 0] == [r for r in by_cascades if r[0] == 0]
