"""Features, weights, trained verdicts and the pipeline as a whole, against plain versions and held-out rows."""

import itertools
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from test_operators import reach, shingles
from tidemark.llm import chat, language, line_quality, queries
from tidemark.llm.sampling import held_out

TEXTS = [
    "", " \n\t\n", "One line, 12 | !!\nthe one the one\n\n  ~~ {x} été", "a", "é\n\x0b\nb b b b", "ab\n" * 50 + "#$% last",
    "x" * 3000 + "\n" + "y z " * 900, "日本 語 日本\nTHE the The", "tail\n"]
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
KINDS = [rb"[a-z]", rb"[A-Z]", rb"[0-9]", rb"[ \t\r\n\x0b\x0c]", rb"\|", rb"!", rb"[#*$%&<>@~^_=+]", rb"[.,;:?'\"()-]"]


def plain_lines(text):
    """Features of each line with a word, by itself, and its length."""
    own, before = [], []
    for line in text.encode().split(b"\n"):
        words = WORD.findall(line)
        again = 0
        for word in words:
            again += word in before[-3:]
            before.append(word)
        if words:
            counts = [len(re.findall(kind, line + b"\n")) for kind in KINDS]
            counts.append(len(line) + 1 - sum(counts))
            size = len(line)
            extra = [math.sqrt(again / len(words)), math.log1p(size) / 5, size / len(words) / 10]
            own.append(([math.sqrt(c / max(1, size)) for c in counts] + [min(3, x) for x in extra], size))
    return own


@pytest.mark.parametrize("made", [line_quality.lines_of, line_quality.lines_of_all])
def test_line_features_are_those_of_single_lines(made):
    lines = made([t.encode() for t in TEXTS])
    want, sizes, first = [], [], [0]
    for text in TEXTS:
        own = plain_lines(text)
        none = [0.0] * 12
        rows = [none, *(f for f, _ in own), none]
        want += [[*rows[i], *rows[i - 1], *rows[i + 1], 1.0] for i in range(1, len(own) + 1)]
        sizes += [size for _, size in own]
        first.append(len(want))
    assert lines.first.tolist() == first and lines.size.tolist() == sizes
    assert np.allclose(lines.dense, np.array(want))


def test_lines_weigh_as_long_as_they_are():
    lines = line_quality.lines_of([t.encode() for t in TEXTS])
    p = np.random.default_rng(1).random(len(lines.text))
    want = []
    for a, b in itertools.pairwise(lines.first):
        want.append(sum(p[a:b] * lines.size[a:b]) / sum(lines.size[a:b]) if b > a else 0.0)
    assert np.allclose(line_quality.good_share(p, lines), want)


def test_language_features_and_means():
    rnd = np.random.default_rng(2)
    texts = [t.encode() for t in TEXTS] + [bytes(rnd.integers(97, 123, 200_000, np.uint8)), b"", b"short"]
    ids, first = language.feature_ids(texts)
    again = language.features_of_all(texts)
    assert (again[0] == ids).all() and (again[1] == first).all()
    table = rnd.random((language.SUBWORDS + language.WHOLE, 3))
    found = language.means(table, ids, first)
    for text, a, b, mean in zip(texts, first[:-1], first[1:], found, strict=True):
        text = text.decode().lower().encode()
        shown = bytes(x if 97 <= x <= 122 or x >= 128 else 32 for x in text)
        triples = [shown[i:i + 3] for i in range(len(shown) - 2) if shown[i:i + 3] != b"   "]
        want = Counter((int.from_bytes(t) * 2654435761 % (1 << 32)) >> 16 for t in triples)
        own = ids[a:b]
        assert Counter(own[own < language.SUBWORDS].tolist()) == want
        cores = Counter(c for c in (re.sub(rb"[^a-z\x80-\xff]", b"", w) for w in WORD.findall(text)) if c)
        assert sorted(Counter(own[own >= language.SUBWORDS].tolist()).values()) == sorted(cores.values())
        assert np.allclose(mean, table[own].sum(axis=0) / len(own) if len(own) else 0)


def test_trained_rules_and_spans_on_held_out_rows(spark):
    """Recall and false alarms, as a constant answer is right most of the time."""
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    shares = [F.avg(F.when(F.col("mark") == m, F.col("hit").cast("double"))) for m in (1, 0)]
    toxic = queries.op5_toxicity(spark, folder).where("held_out").join(labels, "doc_id")
    caught, alarms = toxic.select(F.col("toxic").alias("mark"), (F.col("predicted") == 1).alias("hit")).agg(*shares).first()
    assert caught >= 0.75 and alarms <= 0.03
    rules = queries.op10_quality_rules(spark, folder).where("NOT base_failed").where(held_out(F.col("doc_id"), 3, 1)).join(labels, "doc_id")
    good, bad = rules.select(F.col("quality").alias("mark"), F.col("kept").alias("hit")).agg(*shares).first()
    assert good >= 0.97 and bad <= 0.1


def test_document_parts_and_no_messages(spark):
    kind = f"conv_id long, turn long, role string, parts array<{chat.PART}>"
    long = "<|x " * 300_000
    rows = [(7, 0, "assistant", [
        ("document", None, "s3", None, None, None, 3), ("text", long, None, None, None, None, None),
        ("document", None, None, None, None, None, None)])]
    turns = chat.format_turns(spark.createDataFrame(rows, kind))
    found = turns.first()
    assert [(a.position, a.type, a.ref, a.tokens) for a in found.attachments] == [(0, "document", "s3", 3072), (2, "document", None, 0)]
    assert found.attachment_tokens == 3072 and found.formatted.count("<|document|>") == 2
    assert chat.read_turns(turns).first().text == f"<|document|>{long}<|document|>"
    none = chat.format_turns(spark.createDataFrame([], kind))
    assert none.isEmpty() and chat.read_turns(none).isEmpty() and chat.read_back(none).isEmpty()


def test_pipeline_against_plain_stages(spark, data):
    """run() gives, by repeats of an id, what single operators, pairs of all texts and the tokenizer's library give."""
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{data}/documents.parquet")
    labels = spark.read.parquet(f"{data}/labels.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    source = {r.doc_id: r.source for r in docs.collect()}
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in text.items()}
    known = {r.doc_id for r in language.identify(docs, language.train(docs)).where("NOT rejected").collect()}
    scores = line_quality.score_quality(docs, line_quality.train(docs, labels)).collect()
    left = known & {r.doc_id for r in scores if r.score >= corpus_pipeline.LEAST_QUALITY}
    sets = {i: shingles(text[i], 5) for i in sorted(left)}
    root = reach(list(sets), [
        (a, b) for a, b in itertools.combinations(sets, 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])])
    left = {i for i in sets if root[i] == i}

    got = corpus_pipeline.run(spark, data).collect()
    times = Counter(r.doc_id for r in got)
    assert set(times) <= left and max(times.values()) <= 3
    own = Counter()
    taken = Counter()
    for i in left:
        own[source[i]] += size[i]
        taken[source[i]] += size[i] * times[i]
    weight = {s: (5, 2, 1)[n % 3] for n, s in enumerate(sorted(own, key=lambda s: (s is None, (s or "").encode())))}
    full: set = set()
    while True:
        rest = sum(own.values()) - sum(3 * own[s] for s in full)
        target = {s: weight[s] * rest / sum(weight[x] for x in own if x not in full) for s in own if s not in full}
        over = {s for s, x in target.items() if x > 3 * own[s]}
        if not over:
            break
        full |= over
    target |= {s: 3 * own[s] for s in full}
    for s in own:
        assert abs(taken[s] - target[s]) <= max(size[i] for i in left if source[i] == s)
        ratio = target[s] / own[s]
        assert all(math.floor(ratio + 1e-9) <= times[i] <= math.ceil(ratio - 1e-9) for i in left if source[i] == s and size[i])
    library = Tokenizer.from_file(queries.tokenizer_path())
    for r in got:
        assert r.round_trip and r.source == source[r.doc_id]
        assert r.ids == library.encode(text[r.doc_id] or "", add_special_tokens=False).ids and r.n_tokens == len(r.ids)
