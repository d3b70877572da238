"""The operators of citymill.llm against brute force, round trips and held-out accuracy, and on odd inputs."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from citymill.llm import bpe, common, components, forest, markov, mixing, near, pages, private, queries, repeats, rules, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, spans string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def documents(spark, rows):
    """rows: (doc_id, text[, source]); with extra columns whose names clash with outputs."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), "x", "y") for r in rows]
    return spark.createDataFrame(full, DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties and repeated rows."""
    long = " ".join(f"wort{i % 977}" for i in range(20_000))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two"), (6, long), (7, long), (8, "One TWO three"), (8, "One TWO three"), (None, "no id here"), (9, "ab " * 400, None), (10, "é ß 日本語 🎉 " * 9, None)]
    return documents(spark, rows).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}


# 1


PAGE = "<html><head><title>T</title></head><body><nav><a>n{0}</a></nav><div class='box'>same words</div><article><h1>Title {0}</h1><p>Text &amp; more<p>next <b>wor</b>d{0}<br>line<div id=comments>c</div></article><aside>s</aside><footer>f</footer></body></html>"


def test_pages_lose_template_and_boilerplate(spark):
    rows = [(i, f"http://a.example/{i}", PAGE.format(i)) for i in range(20)] + [(20, None, None), (21, "http://b.example/", ""), (22, "x", "<p>plain</p><div class='box'>same words</div>"), (22, "x", "<p>a<b>b</b></p>"), (None, "y", "a<script>var a='<p>'</script> b")]
    table = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    for limit in (10**6, 0):  # broadcast, and joined
        got = collections.defaultdict(list)
        for r in pages.extract(table, broadcast_rows=limit).collect():
            got[r.page_id].append(r.text)
        assert got[3] == ["Title 3 Text & more next word3 line"] and got[20] == got[21] == [""] and got[None] == ["a b"]
        assert sorted(got[22]) == ["ab", "plain same words"]
    assert pages.extract(table.limit(0)).count() == 0


def test_recurring_subtree_goes_where_it_recurs(spark):
    body = "<html><body><div><p>{}</p><section><p>subscribe now</p></section></div></body></html>"
    rows = [(i, "http://a/x" if i < 20 else "http://b/x", body.format(f"own text {i}")) for i in range(22)]
    got = {r.page_id: r.text for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[5] == "own text 5" and got[21] == "own text 21 subscribe now"
    copies = [(i, "http://c/x", body.format("a copied page")) for i in range(30)]
    assert {r.text for r in pages.extract(spark.createDataFrame(copies, "page_id long, url string, html string")).collect()} == {"a copied page subscribe now"}


def test_pages_that_differ_only_in_paragraphs_of_articles_are_different(spark):
    body = "<html><body><nav>n</nav><article><h1>Title {0}</h1><p>own text {0}</p><div class='box'>same words</div></article><footer>f</footer></body></html>"
    rows = [(i, "http://a/x", body.format(i)) for i in range(20)] + [(20 + i, "http://b/x", body.format("b")) for i in range(20)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    for limit in (10**6, 0):
        got = {r.page_id: r.text for r in pages.extract(table, broadcast_rows=limit).collect()}
        assert [got[i] for i in range(20)] == [f"Title {i} own text {i}" for i in range(20)]
        assert {got[i] for i in range(20, 40)} == {"Title b own text b same words"}  # copies of one page are no template


@pytest.mark.parametrize("html", ["<", "<p", "a < b", "<div><p>x</div>y</p>", "<p a='>'>x", "<p a=\"", "<!-- x", "<script>x", "&am &#65; &nbsp;b"])
def test_broken_markup_is_read(html):
    assert isinstance(pages.main_text(html, pages.parse(html), set()), str)


def brute_template(rows, min_pages, share):
    """Repeated containers by their source, for pages without nesting rules: what a host's different pages have in common."""
    pages_of, hosts = collections.defaultdict(set), collections.defaultdict(set)
    for _, url, source in rows:
        host = pages.host_of(url)
        hosts[host].add(source)
        for box in re.findall(r"<section>.*?</section>", source):
            pages_of[host, box].add(source)
    return {(h, box) for (h, box), own in pages_of.items() if len(own) >= min_pages and len(own) >= share * len(hosts[h])}


def test_template_equals_a_count_by_source(spark):
    rng, rows = np.random.default_rng(1), []
    boxes = [f"<section><p>box {k}</p></section>" for k in range(12)]
    for i in range(400):
        own = [boxes[k] for k in sorted(rng.choice(12, 4, replace=False, p=[0.3, 0.2, 0.15, 0.1, 0.05, 0.05, 0.04, 0.03, 0.03, 0.02, 0.02, 0.01]))]
        rows.append((i, f"http://h{i % 5}.example/{i}", f"<body><article><p>own text {i % 350}</p>{''.join(own)}</article></body>"))
    template = brute_template(rows, 8, 0.5)
    got = {r.page_id: r.text for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert template and len({h for h, _ in template}) == 5
    for i, url, source in rows:
        left = [b for b in re.findall(r"<section>.*?</section>", source) if (pages.host_of(url), b) not in template]
        assert got[i] == " ".join([f"own text {i % 350}", *(re.sub("<[^>]*>", "", b) for b in left)])


def test_pages_with_one_shell_lose_it(spark):
    """Pages that differ in the paragraphs of their article only; whole names; elements round an article."""
    shell = "<nav>menu</nav><article><p>own text {0}</p><section><p>follow us everywhere</p></section></article>"
    rows = [(i, f"http://a.example/{i}", shell.format(i)) for i in range(40)]
    wraps = ["<article class='post has-sidebar'><p>kept</p></article>", "<div class='content no-sidebar'><p>kept</p></div>", "<section id='market-share'>kept</section>", "<div class='related-work'>kept</div>", "<form action=x><article>kept</article><input></form>", "<div class='modal'><main>kept</main></div>"]
    gone = ["<div class='site-footer'>x</div>kept", "<div class='sidebar-left'>x</div>kept", "<form><p>x</p></form>kept", "<ul class='share-buttons'><li>x</ul>kept", "<div id=cookie-banner>x</div><p>kept"]
    rows += [(100 + k, f"http://w{k}.example/", h) for k, h in enumerate(wraps + gone)]
    got = {r.page_id: r.text for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[i] for i in range(40)] == [f"own text {i}" for i in range(40)] and {got[100 + k] for k in range(len(wraps + gone))} == {"kept"}


def test_deep_and_long_pages(spark):
    import time

    for n in (8_000, 60_000):  # the work grows with the page
        source = "<div>" * n + "deep" + "</div>" * n
        began = time.perf_counter()
        page = pages.parse(source)
        found = pages.subtree_hashes(source, "h", page)
        assert len(set(found)) == n and pages.main_text(source, page, set()) == "deep" and time.perf_counter() - began < n / 4_000
    long = "<article>" + "".join(f"<p>word{i} &amp; <b>bo</b>ld</p>" for i in range(50_000)) + "</article>"
    assert pages.extract(spark.createDataFrame([(1, "u", long)], "page_id long, url string, html string")).first().text == " ".join(f"word{i} & bold" for i in range(50_000))


# 2


def test_markov_counts_and_likelihood(spark, sf_dir, texts):
    got = {r.doc_id: r for r in markov.op2_hidden_markov(spark, sf_dir).collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    count = collections.Counter(w for i, t in texts.items() if not held[i] for w in words(t))
    ends = sum(not h for h in held.values())
    n, v = sum(count.values()) + ends, len(count) + 1
    for i, t in texts.items():
        own = [count[w] for w in words(t)] + [ends]
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(own), sum(c > 0 for c in own), n)
        assert r.base_score == pytest.approx(sum(math.log10((c + 1) / (n + v + 1)) for c in own), rel=1e-9)
    out = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out) and all(math.isfinite(r.score) and r.score < 0 for r in got.values())


def test_forward_recursion_equals_all_paths():
    rng = np.random.default_rng(1)
    k, classes = 3, 5
    norm = lambda x: x / x.sum(-1, keepdims=True)
    model = markov.Model(norm(rng.random(k)), norm(rng.random((k, k))), norm(rng.random((k, classes))))
    lengths = np.array([4, 1, 3])
    sequence = rng.integers(0, classes, 8).astype(np.uint16)
    got, at = model.likelihoods(sequence, lengths), 0
    for n, value in zip(lengths, got, strict=True):
        total = 0.0
        for path in np.ndindex(*[k] * n):
            p = model.start[path[0]] * model.emit[path[0], sequence[at]]
            for t in range(1, n):
                p *= model.move[path[t - 1], path[t]] * model.emit[path[t], sequence[at + t]]
            total += p
        assert value == pytest.approx(math.log10(total))
        at += n


def test_baum_welch_raises_the_likelihood():
    rng = np.random.default_rng(2)
    sequence, lengths = rng.integers(0, 6, 600).astype(np.uint16), np.array([100, 200, 300])
    sequence[300:] %= 3
    norm = lambda x: x / x.sum(-1, keepdims=True)
    model, flat = markov.Model(np.full(2, 0.5), norm(rng.random((2, 2)) + 1), norm(rng.random((2, 6)))), np.full(6, 1e-9)
    before = -np.inf
    for _ in range(5):
        now = model.likelihoods(sequence, lengths).sum()
        assert now > before - 0.5
        before, into = now, markov.Model.zeros(2, 6)
        model.expected(sequence, lengths, into)
        assert into[2].sum() == pytest.approx(600)
        model = model.updated(into, flat)
    assert model.likelihoods(sequence, lengths).sum() > -600 * math.log10(6)


def test_expected_counts_are_those_of_whole_texts():
    """Against a plain forward and backward pass over each text, far longer than a segment."""
    rng = np.random.default_rng(7)
    lengths = np.array([1, 1000, 128, 129, 300, 1, 777])
    sequence = rng.integers(0, 6, lengths.sum()).astype(np.uint16)
    norm = lambda x: x / x.sum(-1, keepdims=True)
    model = markov.Model(norm(rng.random(3)), norm(rng.random((3, 3))), norm(rng.random((3, 6))))
    starts, moves, emits, at = np.zeros(3), np.zeros((3, 3)), np.zeros((3, 6)), 0
    for n in lengths.tolist():
        own = sequence[at : at + n]
        alpha, beta, scale = np.zeros((n, 3)), np.ones((n, 3)), np.zeros(n)
        for t in range(n):
            a = (model.start if t == 0 else alpha[t - 1] @ model.move) * model.emit[:, own[t]]
            scale[t] = a.sum()
            alpha[t] = a / scale[t]
        for t in range(n - 2, -1, -1):
            beta[t] = model.move @ (model.emit[:, own[t + 1]] * beta[t + 1]) / scale[t + 1]
        starts += alpha[0] * beta[0]
        for t in range(n):
            emits[:, own[t]] += alpha[t] * beta[t]
            if t:
                moves += np.outer(alpha[t - 1], model.emit[:, own[t]] * beta[t] / scale[t]) * model.move
        at += n
    into = markov.Model.zeros(3, 6)
    model.expected(sequence, lengths, into)
    assert np.allclose(into[0], starts) and np.allclose(into[1] * model.move, moves) and np.allclose(into[2], emits)


def test_markov_start_counts_all_training_texts(spark, monkeypatch):
    given, first = [], markov.first_model
    monkeypatch.setattr(markov, "first_model", lambda pairs, *rest: given.extend(pairs) or first(pairs, *rest))
    rows = markov.score(documents(spark, [(i, f"a{i % 7} b{i % 11} c") for i in range(4_500)])).collect()
    assert sum(int(times.sum()) for _, times in given) == rows[0].train_tokens


def test_markov_shares_texts_out_whole(monkeypatch):
    rng = np.random.default_rng(5)
    lengths = np.array([3, 50, 1, 20])
    sequence = rng.integers(0, 6, lengths.sum()).astype(np.uint16)
    norm = lambda x: x / x.sum(-1, keepdims=True)
    model, wanted, at = markov.Model(norm(rng.random(3)), norm(rng.random((3, 3))), norm(rng.random((3, 6)))), np.zeros((3, 6)), 0
    for n in lengths:
        own, at = sequence[at : at + n], at + n
        wanted += np.outer(norm(np.prod(model.emit[:, own], axis=1)), np.bincount(own, minlength=6))
    for tokens in (1 << 18, 8):
        monkeypatch.setattr(markov, "TOKENS_AT_ONCE", tokens)
        into = np.zeros((3, 6))
        model.shared_out(sequence, lengths, into)
        assert np.allclose(into, wanted)
    background = norm(rng.random(6))
    texts, at = markov._outstanding(sequence, lengths, background), 0
    for n, got in zip(lengths, texts, strict=True):
        c, at = np.bincount(sequence[at : at + n], minlength=6), at + n
        assert got == np.argmax(np.where(c > 0, c * np.log(np.maximum(c, 1) / (n * background)), -np.inf))


def test_markov_on_odd_rows(spark, odd, empty):
    rows = markov.score(odd).collect()
    assert len(rows) == 12 and sorted(r.n_tokens for r in rows)[:3] == [1, 1, 1]
    assert markov.score(empty).count() == 0
    assert {r.n_known for r in markov.score(documents(spark, [(i, "a b") for i in range(40) if zlib.crc32(str(i).encode()) % 7 == 2])).collect()} == {0}


# 3


def test_rules_equal_sql(spark, duck, sf_dir):
    df = rules.op3_rule_ledger(spark, sf_dir)
    result = duck.execute(rules.OP3_SQL)
    assert rows_of(df.columns, df.collect()) == rows_of([d[0] for d in result.description], result.fetchall())


def test_ledger_on_odd_rows(spark, odd, empty):
    rows = rules.ledger(odd).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == 12 and by[1].n_words == by[2].n_words == by[3].n_words == 0 and by[9].n_repeat_words == 400
    assert by[6].n_repeat_words == 20_000 and rules.ledger(empty).count() == 0
    lines = rules.ledger(documents(spark, [(1, "a b\n\na b\nc\na b")])).first()
    assert (lines.n_dup_lines, lines.n_lines) == (2, 4)


def test_ablations_add_up(spark, sf_dir):
    entries = rules.ledger(common.read(spark, sf_dir, "documents")).cache()
    kept = entries.where(rules.verdict("v1")).count()
    for r in rules.ablations(entries, "v1").collect():
        assert r.n_kept_without == kept + r.n_failed_alone
        assert r.n_failed == entries.where(F.col("failed_bits").bitwiseAND(F.lit(rules.BIT[r.rule])) != 0).count()


# 4


def vectors(spark, rows):
    return forest.usable(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))


def brute(rows, query, k=5):
    good = {i: np.array(v, float) for i, v in rows}
    unit = {i: v / np.linalg.norm(v) for i, v in good.items()}
    return sorted(((-round(float(unit[query] @ v), 12), i) for i, v in unit.items() if i != query))[:k]


def test_forest_recall(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    rows = [(r.vec_id, list(r.embedding)) for r in table]
    got = collections.defaultdict(dict)
    for r in forest.op4_projection_forest(spark, sf_dir).collect():
        got[r.query_id][r["rank"]] = (r.vec_id, r.score)
    hits = 0
    for q, found in got.items():
        expected = brute(rows, q)
        assert sorted(found) == [1, 2, 3, 4, 5]
        hits += len({i for _, i in expected} & {i for i, _ in found.values()})
    assert set(got) == {i for i, _ in rows if i % 50 == 0} and hits >= 0.9 * 5 * len(got)


def test_forest_recall_above_the_least_held(spark):
    table = np.random.default_rng(3).normal(size=(2 * forest.LEAST_HELD, 32)).astype(np.float32)
    rows = vectors(spark, [(i, v.tolist()) for i, v in enumerate(table)])
    got = collections.defaultdict(set)
    for r in forest.nearest(rows, rows.where("id % 50 = 0")).collect():
        got[r.query_id].add(r.vec_id)
    unit = table.astype(float) / np.linalg.norm(table.astype(float), axis=1, keepdims=True)
    hits = 0
    for q, found in got.items():
        score = unit @ unit[q]
        score[q] = -2
        hits += len(found & set(np.argsort(-score)[:5].tolist()))
    assert set(got) == set(range(0, len(table), 50)) and hits >= 0.9 * 5 * len(got)


def test_forest_ties_copies_and_useless_vectors(spark):
    same = [(i, [1.0, 0.0, 0.5]) for i in range(40)]
    rest = [(100, None), (101, [0.0, 0.0, 0.0]), (102, [float("nan"), 1.0, 0.0]), (103, [None, 1.0, 0.0]), (104, [float("inf"), 1.0, 0.0]), (150, [0.9, 0.1, 0.5]), (150, [0.9, 0.1, 0.5]), (None, [1.0, 1.0, 1.0]), (151, [2.0, 0.0, 1.0])]
    rows = vectors(spark, same + rest)
    got = [(r.query_id, r["rank"], r.vec_id) for r in forest.nearest(rows, rows.where("id IN (0, 150)").distinct(), least_depth=1, share=9.0).orderBy("query_id", "rank").collect()]
    assert [v for q, _, v in got if q == 0] == [1, 2, 3, 4, 5] and [v for q, _, v in got if q == 150] == [0, 1, 2, 3, 4]
    assert forest.nearest(vectors(spark, rest[:5]), rows.limit(1)).count() == 0
    two = vectors(spark, [(1, [1.0, 0.0]), (2, [0.0, 1.0])])
    assert [(r.query_id, r.vec_id) for r in forest.nearest(two, two.where("id = 1")).collect()] == [(1, 2)]


# 5


def test_toxicity_on_held_out_labels(spark):
    rng = np.random.default_rng(5)
    plain, bad = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(3000)], ["vile", "nasty", "awful"]
    rows, marks = [], []
    for i in range(700):
        own = list(rng.choice(plain, 60))
        toxic = i % 5 == 0
        if toxic:
            own[7:7] = list(rng.choice(bad, 3))
        rows.append((i, " ".join(own)))
        marks.append((i, int(toxic)))
    docs, labels = documents(spark, [*rows, (1000, None), (1001, "")]), spark.createDataFrame([*marks, (None, 1), (5000, None)], "doc_id long, toxic int")
    index = toxicity.train(docs, labels)
    got = {r.doc_id: r for r in toxicity.judge(docs, index).collect()}
    truth = dict(marks)
    assert all(got[i].predicted == truth[i] for i in truth) and got[1000].score == got[1001].score < 0.1
    assert got[0].neighbours and {n.label for n in got[0].neighbours} == {1}
    for text in (rows[0][1], "nasty abc vile"):  # block-max search equals a full scan
        vector = index.unit(index.counts(text))
        full = collections.defaultdict(float)
        for t, w in vector.items():
            for block, (at, weights) in index.postings.get(t, {}).items():
                for a, x in zip(at, weights, strict=True):
                    full[block * toxicity.BLOCK + int(a)] += w * x
        best = sorted(((s, r) for r, s in full.items()), key=lambda x: (-round(x[0], 12), x[1]))[: index.k]
        assert [round(s, 9) for s, _ in index.nearest(text)] == [round(s, 9) for s, _ in best]


def test_opened_blocks_hold_all_neighbours(spark):
    """Judged rows against a plain scan of all examples, with repeated rows, ties and a very long text."""
    rng = np.random.default_rng(9)
    topics = [["".join(rng.choice(list("abcdefghij"), 5)) for _ in range(60)] for _ in range(8)]
    rows = [(i, " ".join(rng.choice(topics[i % 8], int(rng.integers(5, 60))))) for i in range(900)]
    rows += [(2000, rows[3][1]), (2000, rows[3][1]), (2001, " ".join(rng.choice(sum(topics, []), 30_000)))]
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 8 == 0)) for i in range(900)], "doc_id long, toxic int")
    index = toxicity.train(docs, labels)
    assert len(index.ids) > 8 * toxicity.BLOCK
    whole = np.zeros((len(index.ids), len(index.words)))
    for r in range(len(index.ids)):
        whole[r, index.of[index.starts[r] : index.starts[r + 1]]] = index.weights[index.starts[r] : index.starts[r + 1]]
    for row in toxicity.judge(docs, index).collect():
        vector = np.zeros(len(index.words))
        for t, w in index.unit(index.counts(row.text)).items():
            vector[t] = w
        scores = whole @ vector
        best = sorted(((-round(x, 9), i) for x, i in zip(scores.tolist(), index.ids, strict=True) if x > 0))[: index.k]
        assert [(-round(n.similarity, 9), n.doc_id) for n in row.neighbours] == best


def test_toxicity_counts_every_word(spark):
    rng = np.random.default_rng(6)
    plain = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(400)]
    rows = [(i, " ".join([*rng.choice(plain, 40), *["vile"] * (i % 10 == 0)])) for i in range(600)]
    held = [zlib.crc32(str(i).encode()) % 5 == 0 for i in range(600)]
    once = next(i for i in range(600) if i % 10 and not held[i])
    rows[once] = (once, " ".join([*rng.choice(plain, 4), "gruesome", "horrid", "wicked", "foul"]))  # toxic words of one example only
    labels = spark.createDataFrame([(i, int(i % 10 == 0 or i == once)) for i in range(600)], "doc_id long, toxic int")
    clean = next(i for i in range(600) if i % 10 and not held[i] and i != once)
    docs = documents(spark, [*rows, (1000, rows[once][1]), (1001, rows[clean][1])])
    got = {r.doc_id: r for r in toxicity.judge(docs, toxicity.train(docs, labels)).collect()}
    assert got[1000].neighbours[0].doc_id == once and got[1000].predicted == 1
    assert got[1001].neighbours[0].doc_id == clean and got[1001].neighbours[0].similarity == pytest.approx(1) and got[1001].predicted == 0


def test_toxicity_without_labels(spark, odd, empty):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.judge(odd, toxicity.train(odd, none)).collect()} == {0.0}
    assert toxicity.judge(empty, toxicity.train(empty, none)).count() == 0


# 6


def test_bpe_equals_reference_library_and_round_trips(spark, sf_dir, texts):
    import tiktoken

    path, pattern = bpe.vocabulary()
    known = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    for r in bpe.op6_byte_bpe(spark, sf_dir).collect():
        ids = known.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(texts[r.doc_id].encode()).hexdigest())


def test_bpe_odd_rows_and_offsets(spark, odd, empty):
    path, pattern = bpe.vocabulary()
    rows = bpe.encode(odd, path, pattern, offsets=True).collect()
    originals = collections.Counter((t.text or "").encode() for t in odd.collect())
    assert collections.Counter(bytes(r.decoded) for r in rows) == originals
    for r in rows:
        text = bytes(r.decoded).decode()
        assert all(0 <= a <= b <= len(text) for a, b in zip(r.starts, r.ends, strict=True)) and (not r.ids or r.ends[-1] == len(text))
    assert bpe.encode(empty, path, pattern).count() == 0 and bpe.digests(empty, path, pattern).count() == 0


# 7


def linked(texts, size, percent):
    sets = {i: (frozenset(tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))) if (w := words(t)) else frozenset()) for i, t in texts.items()}
    parent, holders = {i: i for i in sets}, collections.defaultdict(list)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, own in sets.items():
        for j, both in collections.Counter(j for s in own for j in holders[s]).items():
            if 100 * both >= percent * (len(own) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
        for s in own:
            holders[s].append(i)
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_near_copies_equal_brute_force(spark, size, percent):
    rng = np.random.default_rng(size)
    base = [f"w{i}" for i in range(500)]
    texts = {}
    for g in range(12):
        own = list(rng.choice(base, 120))
        for c in range(12):
            copy = list(own)
            for _ in range(c // 2):
                copy[rng.integers(0, len(copy))] = f"new{rng.integers(0, 10**6)}"
            texts[g * 100 + c] = " ".join(copy)
    texts |= {5000 + k: f"{texts[0]} {' '.join(rng.choice(base, 15 * k))}" for k in range(4)}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near.groups(documents(spark, list(texts.items())), size, percent).collect()}
    assert got == linked(texts, size, percent)


def test_near_copies_on_odd_rows(spark, odd, empty):
    rows = near.groups(odd, 3, 85).collect()
    by = collections.defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    assert len(rows) == 12 and by[7][0].component_id == 6 and not by[7][0].kept and by[None][0].component_id is None and by[None][0].kept
    assert [(by[i][0].n_shingles, by[i][0].component_id) for i in (1, 2, 3, 4, 5)] == [(0, 1), (0, 2), (0, 3), (1, 4), (1, 5)] and [r.component_id for r in by[8]] == [8, 8]
    assert near.groups(empty).count() == 0


def test_links_of_repeated_ids_are_kept(spark):
    one, two = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    rows = [(5, one), (5, two), (9, f"{two} more"), (7, f"{one} more"), (7, f"{one} more")]
    got = {(r.doc_id, r.component_id) for r in near.groups(documents(spark, rows), 3, 85).collect()}
    assert got == {(5, 5), (9, 5), (7, 5)}
    kept = near.one_of_each(documents(spark, rows), 3, 85)
    assert kept.columns == documents(spark, rows).columns and sorted((r.doc_id, r.text) for r in kept.collect()) == sorted([(5, one), (5, two)])


def test_large_clusters_are_completed_by_blocks(spark, monkeypatch):
    """Clusters above a block: random deals, then blocks of different components."""
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in range(300)]
    texts = {}
    for c in range(90):  # a group in which many pairs are a little below the similarity
        copy = list(base)
        for i in rng.choice(300, int(rng.integers(4, 16)), replace=False):
            copy[i] = f"new{c}x{i}"
        texts[c] = " ".join(copy)
    for rows, deals in ((16, 0), (24, 1)):
        monkeypatch.setattr(near, "ROWS", rows)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in near.groups(documents(spark, list(texts.items())), 3, 85, deals=deals).collect()}
        assert got == linked(texts, 3, 85), (rows, deals)


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101)], "a long, b long")
    assert {r.node: r.label for r in components.smallest_labels(edges).collect()} == {**{k: 0 for k in range(41)}, 100: 100, 101: 100}


def test_components_in_stars_and_in_one_task(spark):
    """Edges that a task cannot hold at once give the labels of a plain walk, as those that it can."""
    draw = np.random.default_rng(3)
    pairs = [(int(a), int(b)) for a, b in draw.integers(0, 150, (110, 2))] + [(7, 7), (500, 500), (3, 9), (9, 3), (3, 9)]
    want = {x: x for p in pairs for x in p if p[0] != p[1]}
    while any(want[a] != want[b] for a, b in pairs if a != b):
        for a, b in pairs:
            if a != b:
                want[a] = want[b] = min(want[a], want[b])
    edges = spark.createDataFrame(pairs, "a long, b long").repartition(5)
    for together in (4, components.TOGETHER):
        rows = components.smallest_labels(edges, together).collect()
        assert {r.node: r.label for r in rows} == want and len(rows) == len(want)
    assert not components.smallest_labels(edges.limit(0)).count()


# 8


def test_mixing_meets_targets_and_limits(spark, sf_dir):
    rows = mixing.op8_pivotal_mix(spark, sf_dir).collect()
    again = {r.doc_id: r.taken for r in mixing.op8_pivotal_mix(spark, sf_dir).collect()}
    assert {r.doc_id: r.taken for r in rows} == again
    total = sum(r["size"] for r in rows)
    by = collections.defaultdict(list)
    for r in rows:
        by[r.source].append(r)
        assert r.taken in (0, r["size"], 2 * r["size"])
    assert sum(v[0].target for v in by.values()) == pytest.approx(1.5 * total)
    for v in by.values():
        assert v[0].source_size == sum(r["size"] for r in v) and v[0].target <= 2 * v[0].source_size
        assert abs(sum(r.taken for r in v) - v[0].target) <= max(r["size"] for r in v)


def test_targets_are_those_of_repeated_sharing(spark):
    sizes = {"a": 100.0, "b": 1000.0, "c": 30.0, "z": 400.0, None: 70.0}
    order = ["a", "b", "c", "z", None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    target, left, open_ = {}, 1.5 * sum(sizes.values()), set(order)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: 2 * sizes[s] for s in full}
        left -= sum(2 * sizes[s] for s in full)
        open_ -= full
    df = spark.createDataFrame([(1, s, int(n)) for s, n in sizes.items()], "doc_id long, source string, size long")
    assert {r.source: pytest.approx(r.target) for r in mixing.targets_of(df).collect()} == target


def test_meeting_keeps_words_and_expectation():
    rng = np.random.default_rng(8)
    s1, p1, s2, p2 = 30.0, 0.3, 70.0, 0.6
    found = [mixing.meet(s1, p1, s2, p2, u) for u in rng.random(20_000)]
    assert all(a in (0, 1) or b in (0, 1) for a, b in found) and all(0 <= x <= 1 for pair in found for x in pair)
    assert all(s1 * a + s2 * b == pytest.approx(s1 * p1 + s2 * p2) for a, b in found)
    assert np.mean([a for a, _ in found]) == pytest.approx(p1, abs=0.02) and np.mean([b for _, b in found]) == pytest.approx(p2, abs=0.02)


def test_mixing_in_a_deep_tree_and_on_odd_rows(spark, odd, empty):
    docs = documents(spark, [(i, "w " * (i % 7 + 1), "ab"[i % 2]) for i in range(600)])
    deep = mixing.mix(docs, rows_in_bucket=10, fan=3).collect()
    assert len(deep) == 600 and {r.doc_id: r.copies for r in deep} == {r.doc_id: r.copies for r in mixing.mix(docs.repartition(5), rows_in_bucket=10, fan=3).collect()}
    for s in "ab":
        assert abs(sum(r["size"] * r.copies for r in deep if r.source == s) - next(r.target for r in deep if r.source == s)) <= 7
    rows = mixing.mix(odd).collect()
    assert len(rows) == 12 and all(r.copies == 0 for r in rows if r.doc_id in (1, 2, 3)) and mixing.mix(empty).count() == 0


# 9


def removed(texts, length=200):
    data = [t.encode() for t in texts]
    count = collections.Counter(d[k : k + length] for d in data for k in range(len(d) - length + 1))
    out = []
    for d in data:
        mask = np.zeros(len(d), bool)
        for k in range(len(d) - length + 1):
            if count[d[k : k + length]] > 1:
                mask[k : k + length] = True
        runs = np.count_nonzero(np.diff(np.concatenate([[0], mask.view(np.int8)])) == 1)
        out.append((len(d), int(mask.sum()), int(runs), bytes(np.frombuffer(d, np.uint8)[~mask])))
    return out


def text_of(rng, n):
    return " ".join("".join(rng.choice(list("abcdefghijé"), rng.integers(1, 9))) for _ in range(n))


@pytest.mark.parametrize("hot", [repeats.HOT, 2])
def test_repeats_equal_brute_force(spark, hot):
    rng = np.random.default_rng(9)
    passages = [text_of(rng, n) for n in (36, 45, 60, 150)]
    texts = []
    for i in range(60):
        parts = [text_of(rng, int(rng.integers(5, 120)))]
        if i % 2:
            parts.insert(int(rng.integers(0, 2)), passages[i % 4])
        if i % 5 == 0:
            parts.append(parts[0])
        texts.append(" ".join(parts))
    texts += [texts[3], texts[3], "ab" * 500, "x" * 199, "x" * 200, "x" * 201, passages[0][:205], ""]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in repeats.remove(documents(spark, list(enumerate(texts))), hot=hot).collect()}
    assert [got[i] for i in range(len(texts))] == removed(texts)


def test_suffix_order_is_the_suffix_array():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 4, 5, 6, 7, 30, 31, 32, 300):
        for letters in (1, 2, 9):
            s = rng.integers(0, letters, n).astype(np.uint8)
            assert repeats.suffix_order(s, n).tolist() == sorted(range(n), key=lambda i: bytes(s[i:]))


def test_repeats_on_odd_rows(spark, odd, empty):
    rows = repeats.remove(odd).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == 12 and by[1].n_bytes == by[1].n_removed == 0 and by[6].n_removed == by[6].n_bytes and by[6].n_spans == 1 and by[9].n_removed == by[9].n_bytes
    assert repeats.remove(empty).count() == 0


# 10


SAMPLES = ["mail a.b@corp.com or A.B@corp.com", "call +1 (407) 555-7710 now", "407-555-7710", "card 4111 1111 1111 1111 and 4952935900253053", "from 192.168.3.4 to 8.8.8.8", 'token = "b44e15e09fd311c3cf3163b66d5a9875b883d8ce"', "Mrs. Anna Smith, then Anna Smith", "Госпожа Ольга Иванова", "IBAN DE89370400440532013000", "SSN 123-45-6789"]


def test_surrogates_keep_type_format_and_coreference(spark):
    docs = documents(spark, [*enumerate(SAMPLES), (50, None), (51, ""), (52, "Version 4.0. of 2024, no data; 3 of 10")])
    got = {r.doc_id: r for r in private.pseudonymise(docs, "k").collect()}
    assert got[50].text is None and got[51].text == "" and got[52].text == "Version 4.0. of 2024, no data; 3 of 10"
    for i, t in enumerate(SAMPLES):
        assert got[i].text != t and len(got[i].entities) >= 1
        for e in got[i].entities:
            assert got[i].text[e.start : e.end] == e.surrogate
    one, two = (e.surrogate for e in got[0].entities)
    assert one.lower() == two.lower() and two.endswith("@" + one.split("@")[1])
    assert re.sub(r"\D", "", got[1].entities[0].surrogate)[1:] == re.sub(r"\D", "", got[2].entities[0].surrogate) and got[1].entities[0].surrogate[9:12] == "555"
    a, b = (e.surrogate for e in got[3].entities)
    assert private._luhn(a.replace(" ", "")) and not private._luhn(b) and re.fullmatch(r"(\d{4} ){3}\d{4}", a)
    assert got[4].entities[0].surrogate.startswith("192.168.")
    assert re.fullmatch(r"[0-9a-f]{40}", got[5].entities[0].surrogate)
    assert got[6].entities[0].surrogate == got[6].entities[1].surrogate and got[6].entities[0].surrogate.split()[0] in private.GIVEN["latin", "f"]
    assert got[7].entities[0].surrogate.split()[0] in private.GIVEN["cyrillic", "f"]
    plain = got[8].entities[0].surrogate
    assert int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1
    assert private.pseudonymise(docs.limit(0), "k").count() == 0


def test_surrogates_are_distinct():
    for kind, entities in {"card": [f"{i:016d}" for i in range(2000)], "ip": [f"9.1.{i}.{j}" for i in range(40) for j in range(40)], "email": [f"u{i}@m.com" for i in range(2000)], "phone": [f"+1 (407) 555-{i:04d}" for i in range(2000)], "ssn": [f"111-22-{i:04d}" for i in range(2000)]}.items():
        assert len({private.KINDS[kind](e, "k") for e in entities}) == len(entities)
    assert len({private.permute(i, 997, "k") for i in range(997)}) == 997


def test_colliding_names_get_another_attempt(spark):
    names = [f"Zu{chr(97 + i // 10)}{chr(97 + i % 10)}" for i in range(60)]
    docs = documents(spark, [(i, f"Mr {n}") for i, n in enumerate(names)])
    for exceptions in (100, 0):  # further attempts, or longer names only
        attempts, width = private.name_attempts(docs, "k", exceptions, width=2)
        assert len({private.person(n, "", "k", attempts, width) for n in names}) == 60
        assert (attempts and width == 2) if exceptions else (not attempts and width > 2)


def test_queries_are_whole_and_named(spark):
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{k}" for k in range(1, 11)] and set(queries.ORACLE_SQL) <= set(queries.QUERIES)
