"""Operators for training data, held against plain versions on small inputs with odd rows."""

import hashlib
import itertools
import random
import re
import unicodedata
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe, chat, components, crf, embedding_dup, language, line_quality, mixing, near_dup, queries, quality_rules,
    sampling, toxicity, url_filter)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, ids string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark, rows):
    return spark.createDataFrame([(i, t, g, s, None, None, None) for i, t, g, s in rows], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, ties and repeated rows, columns of clashing names."""
    rnd = random.Random(4)
    words = ["alpha", "beta", "Gamma", "delta.", "été", "x", "the", "of", "und", "que"]
    base = [rnd.choice(words) + str(rnd.randint(0, 40)) for _ in range(120)]
    near = base[:]
    near[60] = "other"
    rows = [
        (1, " ".join(base), "en", "a"), (2, " ".join(near), "en", "a"), (3, " ".join(base).upper(), "fr", None),
        (3, " ".join(base).upper(), "fr", None), (4, None, None, "b"), (5, "", "de", "b"), (6, " \n\t ", "es", "b"),
        (7, "one two", "en", "c"), (8, "one two", None, "c"), (9, "12 34 !!", "en", "c"), (None, "one two", "en", "a"),
        (10, " ".join(rnd.choice(words) for _ in range(20000)), "en", "a"), (11, "<|endoftext|> a²b \x1c 'll\n\n x", "en", "d"),
        (12, " ".join(rnd.choice(words) for _ in range(300)), "en", "Z"),
    ]
    return documents(spark, rows).cache()


def shingles(text, width):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not words:
        return set()
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)} or {tuple(words)}


def reach(nodes, links):
    root = {n: n for n in nodes}
    for _ in nodes:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    return root


@pytest.mark.parametrize("width, percent", [(3, 85), (5, 80)])
def test_near_duplicates(spark, odd, width, percent):
    rows = [(r.doc_id, shingles(r.text, width)) for r in odd.select("doc_id", "text").collect()]
    named = [(i, s) for i, s in rows if i is not None and s]
    links = [(a, b) for (a, x), (b, y) in itertools.combinations(named, 2) if 100 * len(x & y) >= percent * len(x | y)]
    root = reach({i for i, _ in rows if i is not None}, links)
    want = sorted((str(i), len(s), str(root.get(i)), root.get(i) == i) for i, s in rows)
    got = near_dup.near_duplicates(odd, width, percent).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in got) == want
    left = near_dup.without_near_duplicates(odd, width, percent)
    assert left.columns == odd.columns and sorted(str(r.doc_id) for r in left.collect()) == sorted(i for i, _, _, k in want if k)


def test_registers_and_estimate():
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 1 << 64, 4000, dtype=np.uint64))
    b = np.unique(np.concatenate([a[400:], rng.integers(0, 1 << 64, 400, dtype=np.uint64)]))
    equal = np.array([(near_dup.sketch(a) == near_dup.sketch(b)).sum()])
    n = np.array([float(len(a))])
    assert abs(near_dup.estimate(equal, n, n)[0] - 3600 / 4400) < 0.12
    assert near_dup.band_size(85) == 5 or (1 - 0.85 ** near_dup.band_size(85)) ** (256 // near_dup.band_size(85)) <= 1e-8


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 99), (7, 7)], "a long, b long")
    got = {r.id: r.component for r in components.components(links).collect()}
    assert got == {i: 0 for i in range(41)} | {99: 99, 100: 99}


def test_components_of_any_graph_and_with_more_links(spark):
    rng = np.random.default_rng(3)
    links = [tuple(map(int, x)) for x in rng.integers(0, 120, (70, 2))]
    later = [tuple(map(int, x)) for x in rng.integers(0, 120, (20, 2))]

    def plain(pairs):
        root = {x: x for p in pairs if p[0] != p[1] for x in p}
        for _ in root:
            for a, b in pairs:
                if a != b:
                    root[a] = root[b] = min(root[a], root[b])
        return root

    frame = lambda pairs: spark.createDataFrame(pairs, "a long, b long")
    labels = components.components(frame(links))
    assert {r.id: r.component for r in labels.collect()} == plain(links)
    assert {r.id: r.component for r in components.joined(labels, frame(later)).collect()} == plain(links + later)
    assert components.components(frame([(4, 4)])).isEmpty()


def test_bpe_is_that_of_the_library(spark, odd):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    own = Tokenizer.from_file(path)
    got = bpe.decoded(bpe.encoded(odd, path), path).select("doc_id", "ids", "decoded", "ids_sha256").collect()
    want = [(r.doc_id, own.encode(r.text or "", add_special_tokens=False).ids) for r in odd.select("doc_id", "text").collect()]
    assert sorted((str(r.doc_id), r.ids) for r in got) == sorted((str(i), ids) for i, ids in want)
    for r in got:
        assert r.decoded == own.decode(r.ids, skip_special_tokens=False)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, r.ids)).encode()).hexdigest()


def test_plain_pattern_cuts_the_same():
    import regex

    model = bpe.Bpe(queries.tokenizer_path())
    # Libraries know different versions of Unicode; what one does not know is left out.
    every = [chr(c) for c in range(0x3000) if unicodedata.category(chr(c)) != "Cn" and regex.match(r"\P{Cn}", chr(c))]
    every = [c for c in every if c.isalpha() == bool(regex.match(r"\p{L}", c))]
    for text in ["".join(every[i:i + 50]) + " a  b\n\n _x__! '" for i in range(0, len(every), 50)]:
        assert model._pieces(text) == regex.findall(bpe.PATTERN, text)


def test_mix_fills_to_the_targets(spark, odd):
    got = mixing.mix(odd).collect()
    assert len(got) == odd.count() and sorted(map(repr, got)) == sorted(map(repr, mixing.mix(odd).collect()))
    sizes = {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        assert r.taken <= 3 * r.size
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    capped, total = set(), sum(sizes.values())
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        share = {s: weight[s] * left / sum(weight[t] for t in sizes if t not in capped) for s in sizes if s not in capped}
        over = {s for s, x in share.items() if x > 3 * sizes[s]}
        if not over:
            break
        capped |= over
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(3 * sizes[r.source] if r.source in capped else share[r.source])
    assert mixing.repeated(odd, mixing.mix(odd)).count() == sum(r.repeats for r in got)


def test_chat_round_trip(spark):
    part = ("text", "a <|im_end|> <\\| b", None, None, None, None, None)
    image = ("image", None, "s3", 600, 100, None, None)
    rows = [
        (1, 0, "user", [part, image, ("audio", None, None, None, None, 1.5, None), ("what", None, None, None, None, None, None)]),
        (1, 1, "assistant", [part]), (1, 1, "assistant", [part]), (2, None, None, None), (None, 0, "a\\n\n<|x", [None])]
    turns = chat.format_turns(spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat.PART}>"))
    read = chat.read_turns(turns).collect()
    assert sum(r.text == "a <|im_end|> <\\| b" and r.loss_text == r.text for r in read) == 2
    assert {r.role for r in read} == {"user", "assistant", "", "a\\n\n<|x"}
    first = turns.where("turn = 0 AND conv_id = 1").first()
    assert [(a.position, a.type, a.tokens) for a in first.attachments] == [(1, "image", 512), (2, "audio", 38), (3, "what", 0)]
    assert first.attachment_tokens == 550 and first.formatted.endswith("<|image|><|audio|><|unknown|><|im_end|>\n")
    assert {r.conv_id: r.n_turns for r in chat.read_back(turns).collect()} == {1: 3, 2: 1, None: 1}


def test_embeddings(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(30, 8))
    rows = [(i, [float(x) for x in v], i % 2) for i, v in enumerate(base)]
    rows += [(100 + i, [float(x) for x in base[i % 6] + rng.normal(size=8) * 0.12], (i % 6) % 2) for i in range(40)]
    rows += [(200, rows[0][1], 0), (201, rows[0][1], 1), (202, None, 0), (203, [0.0] * 8, 0), (204, [float("nan")] * 8, 0),
             (205, [], 0), (206, rows[0][1], None), (207, [1.0, None], 0), (208, [2 * x for x in rows[0][1]], 0), (209, [1.0], 0)]

    def vector(v):
        v = np.array([np.nan if x is None else x for x in v or []], float)
        return v if len(v) and np.isfinite(v).all() and v.any() else None

    usable = [(i, vector(v), label) for i, v, label in rows if label is not None and vector(v) is not None]
    links = [
        (a, b) for (a, x, p), (b, y, q) in itertools.combinations(usable, 2)
        if p == q and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98]
    root = reach([i for i, _, _ in rows], links)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("links", F.lit(1))
    for tile in (1024, 4):
        got = embedding_dup.embedding_duplicates(frame, rows_per_tile=tile).collect()
        want = sorted((i, sum(i in link for link in links), root[i], root[i] == i) for i, _, _ in rows)
        assert sorted(map(tuple, got)) == want
    assert len(links) > 20


def test_url_filter(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x?y", "http://a.example.com/en/", "http://x.net/fr/#a",
            "http://net/es/1", "ftp://com", "http://com/", "http://example.com/de://x", "http://notexample.com/en/", "http://x.net"]
    pages = spark.createDataFrame([(i, u, "v") for i, u in enumerate(urls + urls)], "page_id long, url string, verdict string")
    rules = queries.URL_RULES
    got = {(r.page_id, r.rule, r.verdict) for r in url_filter.judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()}

    def judge(url):
        found = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (found[1].lower(), found[2]) if found else ("", "")
        fit = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fit)[1:] if fit else (None, "allow")

    assert got == {(i, *judge(u)) for i, u in enumerate(urls + urls)}
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert {r.verdict for r in url_filter.judge(pages, none).collect()} == {"allow"}


def test_cascade_is_exact_over_its_universe(spark):
    keys = spark.range(5000).select(F.xxhash64("id").alias("h1"), F.xxhash64(F.lit(1), "id").alias("h2"), "id")
    made = url_filter.build(keys.where("id % 7 = 0"), keys)
    rows = keys.toPandas()
    assert len(made.levels) > 1
    assert (made.contains(rows["h1"].to_numpy(), rows["h2"].to_numpy()) == (rows["id"] % 7 == 0).to_numpy()).all()


def test_marginals_are_those_of_all_paths():
    rng = np.random.default_rng(2)
    e, trans, first = rng.normal(size=11), rng.normal(size=(2, 2)), np.array([0, 4, 4, 11])
    got = crf.marginals(e, first, trans, 0.3)
    for a, b in ((0, 4), (4, 11)):
        total, one = 0.0, np.zeros(b - a)
        for path in itertools.product((0, 1), repeat=b - a):
            s = 0.3 * path[0] + sum(e[a + t] * x for t, x in enumerate(path)) + sum(trans[x, y] for x, y in zip(path, path[1:]))
            total += np.exp(s)
            one += np.exp(s) * np.array(path)
        assert np.allclose(got[a:b], one / total)
    long = rng.normal(size=3000)
    whole = crf.marginals(long, np.array([0, 3000]), trans, 0.0)
    assert np.allclose(whole[:900], crf.marginals(long[:2000], np.array([0, 2000]), trans, 0.0)[:900])


def base_counts(text):
    words = WORD.findall(text or "")
    runs = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    marked = {i + k for i, r in enumerate(runs) if runs.count(r) > 1 for k in range(3)} if len(words) < 3000 else None
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), marked


def test_quality_rules_count(spark, odd):
    more = documents(spark, [(20, "a b c a b c x\n# |\n# |\n\n\n" + "w " * 60, "en", "a"), (21, "é x a\x0bb", "en", "a")])
    model = quality_rules.RuleModel(None, np.array([0.0, 5.0]), 0.5)
    texts = odd.unionByName(more)
    got = quality_rules.apply_rules(texts, model).collect()
    want = {(str(r.doc_id), *base_counts(r.text)[:4]) for r in texts.collect()}
    assert {(str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines) for r in got} == want
    repeated = {r.doc_id: len(base_counts(r.text)[4]) for r in texts.collect() if base_counts(r.text)[4] is not None}
    assert all(r.n_repeat_words == repeated[r.doc_id] for r in got if r.doc_id in repeated)
    assert all(r.kept != r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in got)


def test_models_without_labels_and_odd_texts(spark, odd):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    n = odd.count()
    scores = toxicity.score_toxicity(odd, toxicity.train(odd, none)).collect()
    assert len(scores) == n and all(r.score == 0.5 and r.spans == [] for r in scores)
    assert all(r.score == 0.5 for r in line_quality.score_quality(odd, line_quality.train(odd, none)).collect())
    assert quality_rules.train(odd, none).weights is None
    found = {r.doc_id: r for r in language.identify(odd, language.train(odd)).collect()}
    for i in (4, 5, 6, 9):
        assert (found[i].lang_pred, found[i].score, found[i].rejected) == ("und", 0.0, True)
    assert 0 <= found[1].score <= 1 and found[1].lang_pred in {"en", "fr", "de", "es"}


def test_empty_tables(spark, odd):
    empty = odd.limit(0)
    path = queries.tokenizer_path()
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    pages = spark.createDataFrame([], "page_id long, url string")
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string")
    for frame in (
        near_dup.near_duplicates(empty), mixing.mix(empty), bpe.decoded(bpe.encoded(empty, path), path),
        toxicity.score_toxicity(empty, toxicity.train(empty, labels)), line_quality.good(empty, line_quality.train(empty, labels)),
        quality_rules.apply_rules(empty, quality_rules.train(empty, labels)), language.recognised(empty, language.train(empty)),
        embedding_dup.embedding_duplicates(vectors), url_filter.judge(pages, rules),
    ):
        assert frame.count() == 0


def letters(text):
    """The distinct words of a text by their lower-cased letters; bytes, as beginnings are cut by bytes."""
    cores = (re.sub(rb"[^a-z\x80-\xff]", b"", w.encode().lower()) for w in WORD.findall(text or ""))
    return {c for c in cores if c}


def test_toxic_words_are_counted_over_all_training_rows(spark):
    rnd = random.Random(6)
    plain = ["river", "Stone,", "maple", "quiet", "window", "été", "7"]
    plain += ["".join(rnd.choice("abcdeilmnorstu") for _ in range(rnd.randint(2, 9))) for _ in range(400)]
    rows, marks = [], []
    for i in range(360):
        toxic = i % 3 == 0
        # Two toxic words: one in short texts, one only in texts longer than what the fit takes.
        size, bad = (30, "zworgle") if i % 2 else (200, "hexfuddle")
        words = [rnd.choice(plain) for _ in range(size)]
        if toxic:
            words[size // 2] = bad
        rows.append((i, " ".join(words), "en", "a"))
        marks.append((i, 1, int(toxic)))
    rows += [(400, None, "en", "a"), (None, "zworgle", "en", "a"), (401, "river", "en", "a")]
    marks += [(400, 1, 1), (None, 1, 1), (402, 1, 1), (359, None, None)]
    docs, labels = documents(spark, rows), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    train_ids = {i for i, *_ in marks if i is not None and i < 400 and zlib.crc32(str(i).encode()) % 3 != 1}
    want = {}
    for i, text, *_ in rows:
        if i in train_ids:
            for core in letters(text):
                for kind, n in enumerate((None, *toxicity.PREFIXES)):
                    if n is None or len(core) >= n:
                        key = (kind, core[:n])
                        want.setdefault(key, [0, 0])[i % 3 != 0] += 1
    got = toxicity.document_frequencies(docs, labels).collect()
    assert sorted((r.kind, r.a0 + r.a1, r.b0 + r.b1) for r in got if r.kind >= 0) == sorted((k, *n) for (k, _), n in want.items())
    assert [sum(r[c] for r in got if r.kind < 0) for c in toxicity.CELLS] == [
        sum(i in train_ids and (i % 3 != 0) == other and zlib.crc32(t.encode()) % 2 == half for i, t, *_ in rows[:360])
        for other in (0, 1) for half in (0, 1)]
    model = toxicity.train(docs, labels, max_chars=400)
    fresh = documents(spark, [(1, "quiet maple hexfuddle river", "en", "a"), (2, "quiet maple window river", "en", "a")])
    found = {r.doc_id: r for r in toxicity.score_toxicity(fresh, model).collect()}
    assert [(s.start, s.end) for s in found[1].spans] == [(12, 21)] and found[2].spans == []
    assert found[1].score > 0.5 > found[2].score


def test_samples_keep_what_is_alike_and_learn_from_long_texts(spark):
    shared = " ".join(f"passage{i}" for i in range(40))
    rows = [(i, f"{shared} own{i}", "en", "a") for i in range(40)]
    rows += [(i, "equal " * 15, "en", "a") for i in range(40, 60)]
    rows += [(i, f"langue{i} était très longue " * 60, "fr", "a") for i in range(60, 80)]  # all longer than max_chars
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(i, int(i < 60), int(i % 2)) for i in range(80)], "doc_id long, quality int, toxic int")
    train_ids = [i for i in range(80) if zlib.crc32(str(i).encode()) % 3 != 1]
    texts, y, _ = sampling.labelled_sample(docs, labels, "quality", 50, 600)
    assert sorted(texts) == sorted({rows[i][1].encode() for i in train_ids}) and 0 < y.sum() < len(y)
    texts, y, _ = sampling.labelled_sample(docs, labels, "toxic", 10, 600)
    assert list(np.bincount(y)) == [10, 10] and all(len(t) <= 600 for t in texts)
    texts, y, _ = sampling.labelled_sample(docs, labels, "quality", 50, 10)  # the budget is 500 bytes a class
    assert set(y) == {0, 1} and sum(len(t) for t, mark in zip(texts, y) if mark) <= 500
    assert language.train(docs, max_chars=600).names == ["en", "fr"]


def test_last_comparison_is_exact(spark):
    docs = documents(spark, [(1, "one two three four five six", "en", "a"), (2, "x", "en", "a")])
    found = near_dup.full_sets(docs, docs.where("doc_id = 1").select(F.col("doc_id").alias("id")), 3)[1].collect()
    want = next(near_dup.shingle_sets([b"one two three four five six"], 3))
    assert [(r.id, r.n, r.shingles) for r in found] == [(1, 4, want.view(np.int64).tolist())]
    big = np.arange(671_091, dtype=np.int64)  # a hundred times this is no float32
    common = near_dup.common_counts([big, big], np.array([0]), np.array([1]))
    assert float((100 * common)[0, 0]) == 67_109_100
    high = np.int64(1) << 32  # shingles that are alike in 32 bits
    sets = [high * 5 + np.arange(10), high * 5 + np.arange(1, 10), high * 5 + np.arange(20, 30)]
    every = np.arange(3)
    assert near_dup.joining(every, np.array([10, 9, 10]), every, sets, every, every, 90) == [(0, 1)]


def test_texts_of_one_id_are_one_node(spark):
    own = " ".join(f"own{i}" for i in range(60))
    docs = documents(spark, [
        (1, "one two", "en", "a"), (2, "one two", "en", "a"), (2, own, "en", "a"), (3, own, "en", "a"), (4, "else", "en", "a")])
    got = {(r.doc_id, r.n_shingles): r.component_id for r in near_dup.near_duplicates(docs).collect()}
    assert got == {(1, 1): 1, (2, 1): 1, (2, 56): 1, (3, 56): 1, (4, 1): 4}
    assert sorted(r.doc_id for r in near_dup.without_near_duplicates(docs).collect()) == [1, 4]
