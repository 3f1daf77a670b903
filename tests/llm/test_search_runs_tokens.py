"""Lexical search, periodic runs and token counts, held against plain versions and the public library."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tidemark.llm import lexical, periodic, queries, token_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
# Other columns have names that the operators use inside.
DOCS = (
    "doc_id long, text string, n long, terms string, times int, item int, score double, rank int, salt int, term string, "
    "n_words long, runs string, collapsed string, n_bytes long, n_tokens long, over_limit string")


def documents(spark, rows):
    return spark.createDataFrame([(i, t, *[None] * 14) for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(8)
    words = ["Alpha", "beta", "gamma,", "été", "x1", "the", "of", "ÉTÉ", "don't", "\x00z", "日本 語"]
    made = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 60)))) for i in range(60)]
    loops = [(i, " ".join(["a", "b", f"c{i}"] * rnd.randint(2, 9) + ["tail"])) for i in range(60, 90)]
    return made + loops + [
        (200, None), (201, ""), (202, " \n\t "), (203, "!!! ... \x7f"), (3, made[3][1]), (3, made[3][1]), (4, "other text"), (None, "beta beta the"),
        (None, "beta beta the"), (204, "the " * 30000), (205, " ".join(rnd.choice("ab") for _ in range(2000))), (206, "no_space" * 5000)]


# ---- lexical search --------------------------------------------------------


def term_list(text):
    return TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def plain_search(docs, items, k):
    held = [(i, Counter(term_list(t)), len(term_list(t))) for i, t in docs]
    n, total = sum(1 for _, _, c in held if c), sum(c for _, _, c in held)
    df = Counter(t for _, own, _ in held for t in own)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(term_list(t))
    out = []
    for i, own in wanted.items():
        scores = []
        for d, tf, c in held:
            m = 100 - 90 + (90 * c * n) // total if total else 0
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m)) for t in own if t in tf)
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(i, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=repr)


def items(spark, given):
    return spark.createDataFrame([(i, t, None, None) for i, t in given], "item_id long, text string, term string, item string")


@pytest.mark.parametrize("max_terms", [1 << 18, 6])
def test_search(spark, rows, max_terms):
    given = [
        (1, "the été of"), (2, "The Été, of alpha"), (3, "alpha beta gamma the"), (4, None), (5, "?!"), (6, "nowhere"), (None, "beta x1"), (7, "don't z 日本"),
        (1, "x1"), (8, "the été of")]
    found = lexical.search(documents(spark, rows), items(spark, given), k=4, max_terms=max_terms)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=repr) == plain_search(rows, given, 4)


def test_search_of_empty_tables(spark, rows):
    assert lexical.search(documents(spark, []), items(spark, [(1, "the")])).isEmpty()
    assert lexical.search(documents(spark, rows), items(spark, [])).isEmpty()
    assert lexical.search(documents(spark, [(1, "?"), (2, None)]), items(spark, [(1, "the")])).isEmpty()


def test_shared_sets_are_evaluated_once():
    rnd = random.Random(2)
    base = [sorted(rnd.sample(range(200), 12)) for _ in range(8)]
    own = [sorted({t for b in rnd.sample(base, 3) for t in b} | set(rnd.sample(range(200, 400), 3))) for _ in range(60)]
    own += [own[0], [5]]
    used = sorted({t for s in own for t in s})
    own = [[used.index(t) for t in s] for s in own]
    plan = lexical.shared_plan(own, len(used))
    reached = Counter()
    for i, s in enumerate(own):
        symbols = plan.flat[plan.offsets[i]:plan.offsets[i + 1]].tolist()
        assert sorted(t for k in symbols for t in plan.expanded(k)) == s  # each term once
        seen = set()
        while symbols:
            k = symbols.pop()
            if k >= plan.leaves:
                seen.add(k)
                symbols += [int(plan.left[k - plan.leaves]), int(plan.right[k - plan.leaves])]
        reached.update(seen)
    assert len(plan.left) and all(reached[k] > 1 for k in range(plan.leaves, plan.size))  # each node serves several items
    assert len(plan.left) + len(plan.flat) + len(used) < sum(map(len, own)) / 2  # fewer sums than one for each term of each item
    impact = np.array([[rnd.randint(0, 10**10) for _ in range(3)] for _ in used], np.int64)
    accumulators = np.zeros((plan.size, 3), np.int64)
    np.add.at(accumulators, plan.leaf, impact)
    assert (plan.totals(accumulators) == np.array([impact[s].sum(axis=0) for s in own])).all()


# ---- periodic runs ---------------------------------------------------------


def plain_runs(words, least=6, power=4):
    number = {}
    a = np.array([number.setdefault(w, len(number)) for w in words])
    out = []
    for q in range(1, len(a) // power + 1):
        steps = np.diff(np.concatenate([[0], (a[:-q] == a[q:]).astype(int), [0]]))
        for i, j in zip(np.flatnonzero(steps == 1).tolist(), np.flatnonzero(steps == -1).tolist(), strict=True):
            run = a[i:j + q]
            if len(run) >= max(least, power * q) and not any((run[:-p] == run[p:]).all() for p in range(1, q)):
                out.append((i, len(run), q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in drop)


@pytest.mark.parametrize("least, power", [(6, 4), (3, 3), (10, 5)])
def test_runs_of_random_texts(least, power):
    rnd = random.Random(least)
    for _ in range(200):
        texts = []
        for _ in range(rnd.randint(0, 4)):
            words = []
            while rnd.random() < 0.8:
                unit = [rnd.choice("abc" if rnd.random() < 0.8 else "abcdefghijk") for _ in range(rnd.choice([1, 1, 2, 3, 5, 7, 20, 60]))]
                words += unit * rnd.choice([1, 2, 4, 5, 9]) + unit[:rnd.randint(0, len(unit))]
            texts.append(" \n".join(words))
        if texts:
            counts, runs, left = (c.to_pylist() for c in periodic.judge((least, power), [t.encode() for t in texts]))
            for t, n, own, rest in zip(texts, counts, runs, left, strict=True):
                want = plain_runs(t.split(), least, power)
                assert [(r["start"], r["length"], r["period"]) for r in own] == want
                assert n == len(t.split()) and rest.decode() == collapsed(t.split(), want)


def test_periodic_runs_of_odd_rows(spark, rows):
    found = periodic.periodic_runs(documents(spark, rows)).collect()
    assert Counter(r.doc_id for r in found) == Counter(i for i, _ in rows)
    texts = {}
    for i, t in rows:
        texts.setdefault(i, set()).add(" ".join(WORD.findall(t or "")))
    for r in found:
        if r.doc_id not in (3, 4, None):
            words = texts[r.doc_id].pop().split(" ") if r.n_words else []
            want = plain_runs(words)
            assert (r.n_words, [tuple(x) for x in r.runs], r.collapsed) == (len(words), want, collapsed(words, want))
    assert periodic.periodic_runs(documents(spark, [])).isEmpty()
    with pytest.raises(ValueError):
        periodic.find_runs(np.zeros(9, np.int64), np.array([0, 9]), power=2)


def test_periodic_query(spark, data):
    texts = dict(map(tuple, spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()))
    found = queries.op12_periodic_runs(spark, data).collect()
    assert len(found) == len(texts)
    planted = 0
    for r in found:
        words = WORD.findall(texts[r.doc_id] or "")
        h, n = zlib.crc32(str(r.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
            planted += 1
        runs = plain_runs(words)
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2])) if runs else (None,) * 3
        milli = 1000 * best[1] // best[2] if runs else None
        digests = [hashlib.sha256(t.encode()).hexdigest() for t in ("".join(f"{s},{n},{q}\n" for s, n, q in runs), collapsed(words, runs))]
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) == (len(runs), *best, milli, *digests)
    assert planted > 5


# ---- token counts ----------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer_path(queries.PIECES))


def test_token_counts_equal_the_library(spark, rows, library):
    path = queries.tokenizer_path(queries.PIECES)
    found = token_counts.token_counts(documents(spark, rows), path, limit=100)
    want = sorted(((i, len((t or "").encode()), len(library.encode(t or ""))) for i, t in rows), key=repr)
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in found.collect()), key=repr) == want
    assert found.where("over_limit <> (n_tokens > 100)").isEmpty()
    assert token_counts.token_counts(documents(spark, []), path).isEmpty()


def test_counter(library):
    counter = token_counts.PieceCounter(queries.tokenizer_path(queries.PIECES), cached=50, part=300)
    assert counter.whole and all(counter.merged(p) == 1 for p in list(counter.whole)[::50])
    rnd = random.Random(1)
    letters = "aabcdethe   \n\tABéñ½Ⅷ🟡😀梦▁<s>/0123\x00　﻿'.,"
    for _ in range(2000):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60)))
        assert counter.count(text) == len(library.encode(text)), text
    for letters in ("ab ▁", "abcdefgh", " ▁", "the of "):  # long pre-tokens, runs of spaces, parts
        text = "".join(rnd.choice(letters) for _ in range(4000))
        assert counter.count(text) == len(library.encode(text))
    ids = [counter.number[c] for c in "internationalization"]
    assert counter._merged_short(ids) == counter._merged_long(ids)


def test_token_query(spark, data, library):
    found = queries.op13_token_counts(spark, data)
    texts = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    want = {r.doc_id: (len((r.text or "").encode()), len(library.encode(r.text or ""))) for r in texts}
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in found.collect()} == want
    assert found.where(F.col("over_limit") != (F.col("n_tokens") > 4096)).isEmpty()
