"""Results of the text operators against plain versions of their methods, and the odd rows that each of them defines."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strandwise.llm import exact_dups, fingerprints, html_text, mixing, packing, private_data, quality, toxicity, urls

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed: int, n: int) -> str:
    return " ".join(np.random.default_rng(seed).choice(WORDS, n))


def everything(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ------------------------------------------------------------------ html


def naive_parts(sizes):
    """Surge and dive points looked for line by line."""
    n, w, least = len(sizes), html_text.WINDOW, html_text.SURGE
    ahead, behind = [sum(sizes[i : i + w]) for i in range(n)], [sum(sizes[max(0, i - w + 1) : i + 1]) for i in range(n)]
    regions, i = [], 0
    while i < n:
        if sizes[i]:
            last, gap = i, 0
            for j in range(i, n):
                gap = 0 if sizes[j] else gap + 1
                last = j if sizes[j] else last
                if gap >= w:
                    break
            regions.append((i, last + 1))
            i = last + 1
        else:
            i += 1
    out = []
    for a, b in regions:
        rise, fall = [i for i in range(a, b) if ahead[i] >= least], [i for i in range(a, b) if behind[i] >= least]
        if rise:
            inside = [i for i in range(rise[0], fall[-1] + 1) if sizes[i]]
            out.append((inside[0], inside[-1] + 1))
    return out or [max(regions, key=lambda r: max(ahead[r[0] : r[1]]))] if regions else []


def test_html_distribution():
    rng = np.random.default_rng(1)
    for _ in range(400):
        sizes = np.where(rng.random(int(rng.integers(1, 40))) < 0.5, rng.integers(0, 60, 1), 0) * (rng.random() < 0.9)
        sizes = np.where(rng.random(len(sizes)) < 0.3, rng.integers(0, 300, len(sizes)), sizes).astype(np.int64)
        assert html_text.main_parts(sizes) == naive_parts(sizes.tolist()), sizes


@pytest.mark.parametrize("tag", ["article", "div"])
def test_html_distribution_decides(tag):
    """With and without an article element the blocks decide what of the unmarked lines is text."""
    story, links = [prose(i, 30) for i in range(4)], "".join(f"<li><a href=x>{prose(50 + i, 3)}</a></li>" for i in range(6))
    page = f"<body><p>Home</p><p>News</p><p>Sport</p><p>Arts</p><p>More</p><{tag}><p>{story[0]}</p><p>{story[1]}</p><ul>{links}</ul><p>{story[2]}</p><p>{story[3]}</p></{tag}><ul>{links}</ul><p>Imprint</p></body>"
    before = [] if tag == "article" else ["Arts", "More"]  # short lines within a block of the first surge
    assert html_text.main_text(page).split("\n") == before + story
    more = [prose(90 + i, 50) for i in range(2)]
    assert html_text.main_text(page.replace("<p>Imprint</p>", "".join(f"<p>{x}</p>" for x in more))).split("\n") == before + story + more
    few = page.replace("<p>Imprint</p>", f"<p>{prose(99, 12)}</p>")  # a low surge: text by itself, but not beside an article
    assert len(html_text.main_text(few).split("\n")) == len(before + story) + (tag == "div" and len(prose(99, 12)) >= html_text.SURGE)


def test_html_keeps_text():
    cases = {
        "<p>Hello <span class='ad'>Buy</span> world of text</p>": "Hello world of text",
        "<p>a <span class=ad>x <span>y</span> z</span> b</p>": "a b",
        '<div class="article-with-sidebar"><p>Long story.<p>Other.</div>': "Long story.\nOther.",
        '<div id="share-layout"><p>abc</p></div>': "abc",
        '<div class="content sidebar"><p>The only text of this page.</p></div>': "The only text of this page.",
        '<article><p>Story.</p><div class="site-comments"><p>' + prose(3, 90) + "</p></div></article>": "Story.",
        '<article><div class="entry-header"><h1>Head</h1></div><p>Story.</p><div class="reader-comments"><p>Reader.</p></div><div class="ad-slot">Buy</div></article>': "Head\nStory.",
        '<div class="has-sidebar"><p>Text.</p><div class="main-nav"><p>Menu</p></div></div>': "Text.",
        "<p>x</p>" * 3: "x\nx\nx",
    }
    for page, text in cases.items():
        assert html_text.main_text(page) == text, page


def test_html_rows(spark):
    schema = "page_id long, html string, text string, n_chars string, _row string"
    rows = [(1, "<p>a</p>", "t", "n", "r"), (1, "<p>a</p>", "t", "n", "r"), (None, None, None, None, None), (2, "<p>" + "word " * 200_000 + "</p>", "t", "n", "r")]
    out = html_text.extract_text(spark.createDataFrame(rows, schema))
    assert [(r.page_id, len(r.text), r.n_chars) for r in out.collect()] == [(1, 1, 1), (1, 1, 1), (None, 0, 0), (2, 999_999, 999_999)]
    assert html_text.extract_text(spark.createDataFrame([], schema)).count() == 0


# ------------------------------------------------------------------ personal data


@pytest.fixture(scope="module")
def tagger():
    contexts = [prose(i, 120) for i in range(60)]
    return private_data.fit(*private_data.labelled_windows(contexts, 8000, forms=(0, 1, 2, 3, 4, 5, 7)), passes=16)


def test_private_decoding_is_exact(tagger):
    texts = [prose(i, 40) + " " + private_data._value(k, np.random.default_rng(i), i % 8) + " " + prose(i + 9, 30 * (i % 3)) for i, k in enumerate(private_data.KINDS * 6)] + ["7", "call 555-123-4567"]
    codes = [private_data.char_classes(t) for t in texts]
    lengths = np.array([len(c) for c in codes])
    scores = private_data.scored(tagger, np.concatenate(codes), lengths)
    tags, at = private_data.decoded(tagger, scores, lengths), 0
    for n in lengths:
        assert (private_data.viterbi(scores[at : at + n][None].astype(float), tagger.trans.astype(float))[0] == tags[at : at + n]).all()
        at += n


def test_private_windows_meet_in_the_middle(tagger):
    """A character's scores are those of the window in which it stands nearest to the middle."""
    codes = private_data.char_classes(prose(4, 300))
    scores = private_data.scored(tagger, codes, np.array([len(codes)]))
    assert len(codes) > 2 * private_data.WINDOW
    starts = range(0, len(codes) - (private_data.WINDOW - private_data.HOP), private_data.HOP)
    for i in (0, 270, 440, 460, 470, 700, len(codes) - 1):
        at = min(starts, key=lambda s: abs(s + private_data.WINDOW / 2 - i - 0.5))
        window = np.zeros((1, private_data.WINDOW), np.int64)
        part = codes[at : at + private_data.WINDOW]
        window[0, : len(part)] = part
        assert np.allclose(private_data.emissions(tagger, window)[0, i - at], scores[i], atol=1e-4)


def test_private_network_without_exponentials(tagger, monkeypatch):
    """Texts go through the network that was trained, and no exponential is taken for a gate of a character."""
    rng = np.random.default_rng(8)
    x = rng.integers(1, private_data.CLASSES, (30, 70))
    e = tagger.embed[x.T]
    sides = [private_data._lstm(e[::k], w)[0][::k] for k, w in zip((1, -1), tagger.lstm, strict=True)]
    trained = (np.concatenate(sides, 2) @ tagger.out[:-1] + tagger.out[-1]).transpose(1, 0, 2)
    counted = []
    for name in ("exp", "tanh"):
        monkeypatch.setattr(np, name, lambda *a, real=getattr(np, name), **k: counted.append(a) or real(*a, **k))
    assert np.allclose(private_data.emissions(tagger, x), trained, atol=1e-4) and not counted


def test_private_scores_without_neighbours(tagger):
    """A text has the same scores alone and beside longer ones, whose windows pad its own."""
    texts = ["call 555-123-4567", prose(3, 20), prose(5, 60), "7", prose(6, 400)]
    codes = [private_data.char_classes(t) for t in texts]
    together, at = private_data.scored(tagger, np.concatenate(codes), np.array([len(c) for c in codes])), 0
    for c in codes:
        assert np.allclose(private_data.scored(tagger, c, np.array([len(c)])), together[at : at + len(c)], atol=1e-4)
        at += len(c)


def test_private_gradients():
    """The gradients of a direction of the network are those that small steps of its weights show, where no gate is shut."""
    rng = np.random.default_rng(4)
    x, w = rng.normal(0, 1, (9, 5, private_data.EMBEDDED)), rng.normal(0, 0.15, (private_data.EMBEDDED + private_data.HIDDEN + 1, 3 * private_data.HIDDEN))
    toward = rng.normal(0, 1, (9, 5, private_data.HIDDEN))
    loss = lambda x, w: (private_data._lstm(x, w)[0] * toward).sum()
    dw, dx = private_data._lstm_back(x, w, private_data._lstm(x, w)[1], toward)
    for given, whole, at in ((w, dw, 0), (x, dx, 1)):
        for _ in range(20):
            place, step = tuple(int(rng.integers(n)) for n in given.shape), np.zeros_like(given)
            step[place] = 1e-5
            up, down = (loss(*((x, w + k * step) if at == 0 else (x + k * step, w))) for k in (1, -1))
            assert abs((up - down) / 2e-5 - whole[place]) < 1e-3 * max(1, abs(whole[place]))


def test_private_held_out(tagger):
    """Values, a third in a form that the fit never saw, in texts that it never saw."""
    rng, found, right, made = np.random.default_rng(3), 0, 0, 0
    for i in range(240):
        kind = private_data.KINDS[i % 4]
        form = 6 if i // 4 % 3 == 0 else int(rng.choice([0, 1, 2, 3, 4, 5]))
        value, left, right_text = private_data._value(kind, rng, form), prose(500 + i, 20), prose(900 + i, 20)
        text = f"{left} {value} {right_text}"
        base = private_data.base_spans(text)
        spans = base + private_data.added_spans(tagger, [text], [base])[0]
        s, e = len(left) + 1, len(left) + 1 + len(value)
        made += 1
        found += any(k == kind and min(e, y) - max(s, x) >= 0.8 * (e - s) for k, x, y in spans)
        right += sum(x >= s - 8 and y <= e + 8 for _, x, y in spans) / max(1, len(spans))
    assert found >= 0.8 * made and right >= 0.8 * made
    plain = [prose(2000 + i, 300) for i in range(40)]
    assert not any(private_data.added_spans(tagger, plain, [[] for _ in plain]))


@pytest.mark.parametrize(("kind", "value", "fits"), [
    ("card", "4539 / 5787 / 6362 / 1486", True), ("card", "4539 / 5787 / 6362 / 1487", False), ("card", "4539578763621487", False), ("card", "453957876", False), ("ip", "10[.]0[.]0[.]255", True), ("ip", "10 dot 0 dot 0 dot 256", False),
    ("ip", "1.2.3.4:8080", True), ("ip", "1.2.3", False), ("phone", "555-123-4567", True), ("phone", "555-12", False), ("phone", "1234567890123456", False), ("email", "jane at example dot org", True), ("email", "JANE AT EXAMPLE DOT ORG", True), ("email", "jane example org", False), ("email", "a" * 90 + " [at] " + "b" * 90 + " [dot] com", True),
])
def test_private_exact_check(kind, value, fits):
    assert private_data.plausible(kind, value) == fits


def test_private_values_set_into_documents(spark):
    """Recall by kind and precision on prose of the corpus, with values that the fit never saw; numbers whose last digit doesn't
    check are set in as well, and nothing but the values may be found."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").filter("length(text) between 400 and 5000")
    model = private_data.fit_on_sample(docs)
    rng, texts, truth = np.random.default_rng(12), [], []
    for i, row in enumerate(docs.orderBy("doc_id").limit(400).collect()):
        kind, text = private_data.KINDS[i % 4], "".join("e" if c in "0123456789@" else c for c in row.text)
        at, value = text.find(" ", int(rng.integers(0, len(text) - 100))), private_data._value(private_data.KINDS[i % 4], rng, i // 4 % private_data.FORMS)
        wrong = "".join(map(str, rng.integers(0, 10, 16)))
        texts.append(f"{text[:at]} {value} {text[at + 1:]} {wrong if not private_data.luhn(wrong) else 'none'} end")
        truth.append((kind, at + 1, at + 1 + len(value)))
    base = [private_data.base_spans(t) for t in texts]
    more = private_data.added_spans(model, texts, base)
    found, stray = defaultdict(list), 0
    for b, m, (kind, s, e) in zip(base, more, truth, strict=True):
        found[kind].append(any(k == kind and min(e, y) - max(s, x) >= 0.6 * (e - s) for k, x, y in b + m))
        stray += sum(not (x < e and s < y) for _, x, y in m)
    assert all(sum(v) >= 0.85 * len(v) for v in found.values()) and stray <= 4


def test_private_rows(spark, tagger):
    schema = "doc_id long, text string, _found string, _row string, spans string"
    long = prose(1, 30_000) + " a.b@c.de"
    rows = [(1, "x 555-123-4567 y", "f", "r", "s"), (1, "x 555-123-4567 y", "f", "r", "s"), (None, None, None, None, None), (2, long, "f", "r", "s")]
    out = private_data.find_private(spark.createDataFrame(rows, schema), tagger)
    assert out.columns[:4] == ["doc_id", "text", "_found", "_row"]
    got = out.collect()
    assert got[0].spans == got[1].spans and got[0]._found == "f" and got[2].spans == "" and got[3].spans.split(",")[0] == f"email:{len(long) - 8}:{len(long)}"
    assert private_data.find_private(spark.createDataFrame([], schema), tagger).count() == 0


# ------------------------------------------------------------------ mixing, copies, urls: callers' columns


def test_callers_columns_stay(spark):
    names = ("each", "row_key", "_size", "_key", "_nth", "_copies", "_sha", "_again", "_found", "_scored", "_row", "members", "copies")
    docs = spark.createDataFrame([(i, prose(i % 7, 20), f"s{i % 3}") for i in range(40)], "doc_id long, text string, source string")
    odd = docs.select("*", *[F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")).alias(c) for c in names])
    for out in (mixing.mixed_documents(odd), exact_dups.without_copies(odd), toxicity.without_toxic(odd, toxicity.fit([], [])), toxicity.score_severity(odd, toxicity.fit([], [])), urls.judge_urls(odd.withColumn("url", F.lit("http://x.org/a")), urls.RULES)):
        rows = out.collect()
        assert set(odd.columns) <= set(out.columns) and rows
        assert all(r[c] == f"{c}-{r.doc_id}" for r in rows for c in names)


def test_mixing_is_systematic_sampling(spark):
    """Copies of each row by prefix sums in plain Python."""
    rows = [(i, None if i % 17 == 0 else prose(i, i % 60), None if i % 5 == 4 else f"s{i % 5}") for i in range(300)] + [(300, "a b", "s0")] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix_sources(docs).collect()
    assert len(got) == len(rows)
    by = defaultdict(list)
    for r in got:
        by[r.source].append(r)
    for part in by.values():
        rate = part[0].target / part[0].source_size
        assert all(r.copies in (int(rate), int(rate) + 1) and r.taken == r.size * r.copies for r in part)
        assert abs(sum(r.copies for r in part) - rate * len(part)) <= 1
    assert everything(mixing.mix_sources(docs)) == everything(mixing.mix_sources(docs.repartition(7)))
    copies = defaultdict(int)
    for r in got:
        copies[r.doc_id] += r.copies
    mixed = mixing.mixed_documents(docs).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in mixed} == {k: n for k, n in copies.items() if n}
    assert sorted(r.copies for r in got if r.doc_id == 300)[-1] - sorted(r.copies for r in got if r.doc_id == 300)[0] <= 1


# ------------------------------------------------------------------ fingerprints, quality, toxicity: ids and labels


def test_fingerprints_null_and_repeated_ids(spark):
    rows = [(None, "first of all"), (3, prose(3, 30)), (3, prose(4, 30)), (5, prose(5, 30)), (9, prose(9, 80))]
    got = fingerprints.edited_fingerprints(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, part string"), parts=4).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = []
    for n, (i, text) in enumerate(order):
        after, cut = order[(n + 1) % len(order)][1], len(text) // 4
        want.append((i, hashlib.sha256((text[: len(text) - cut] + after[:cut]).encode()).hexdigest()))
    assert sorted(((r.doc_id, r.edited_sha256) for r in got), key=repr) == sorted(want, key=repr)


def naive_signature(text):
    """Phrases by longest match in a list, and each share's least hash."""
    found, at = [], 0
    while at < len(text):
        n = next((n for n in range(1, len(text) - at + 1) if text[at : at + n] not in found), None)
        if n is None:
            break
        found.append(text[at : at + n])
        at += n
    hashes = fingerprints.phrase_hashes(dict.fromkeys(found or ([text] if text else [])))
    least = {}
    for h in hashes.tolist():
        k = h % fingerprints.MINIMA
        least[k] = min(least.get(k, 1 << 32), h >> 32)
    return least


def test_fingerprint_signature():
    for text in ("", "a", "abababababab", prose(1, 60), "é\U0001f600" * 9):
        least, sign = naive_signature(text), fingerprints.signature(fingerprints.phrase_hashes(*fingerprints.phrases(text)))
        assert {k for k in range(fingerprints.MINIMA) if sign[k] != 0xFFFF} == set(least)
        assert all(sign[k] == min(v * 0x9E3779B1 >> 7 & 0xFFFF, 0xFFFE) for k, v in least.items())


def naive_quality(net, data):
    """Filters at every place one by one; each chunk's maximum, then mean and maximum over chunks."""
    places = max(1, -(-max(len(data), 1) // quality.STRIDE))
    padded = list(data) + [0] * ((places - 1) * quality.STRIDE + quality.WIDTH - len(data))
    values = [[float(net.bias[f]) + sum(float(net.tables[k][padded[p * quality.STRIDE + k]][f]) for k in range(quality.WIDTH)) for f in range(quality.FILTERS)] for p in range(places)]
    half = quality.CHUNK // 2
    halves = -(-places // half)
    chunks = [values[c * half : (c + 2) * half] for c in range(max(1, halves - 1))]
    best = np.array([[max(0.0, max(v[f] for v in chunk)) for f in range(quality.FILTERS)] for chunk in chunks])
    return 1 / (1 + np.exp(-(np.concatenate([best.mean(0), best.max(0)]) @ net.top + net.final)))


def test_quality_is_a_convolution():
    net = quality.fit([prose(i, 40) for i in range(12)] + ["### " * 20] * 6, [1] * 12 + [0] * 6, passes=2)
    for n in (0, 1, 7, 300, 700):
        data = np.frombuffer(prose(n, 200).encode()[:n], np.uint8)
        assert abs(quality.score(net, data) - naive_quality(net, data)) < 1e-4


def test_fits_on_odd_labels(spark):
    docs = spark.createDataFrame([(i, prose(i, 40) + (" wretch villain" if i < 40 else "")) for i in range(160)] + [(0, "other text"), (None, None), (159, None)], "doc_id long, text string")
    label = "doc_id long, quality int, toxic int"
    odd = spark.createDataFrame([(i, int(i >= 40), int(i < 40)) for i in range(160)] + [(3, 0, 1), (3, 0, 0), (None, 1, 1), (7, None, None), (999, 1, 1)], label)
    model = toxicity.fit_on_labels(docs, odd)
    scored = {r.doc_id: r for r in toxicity.score_severity(spark.createDataFrame([(1, "oh wretch and villain"), (2, prose(7000, 30)), (3, None)], "doc_id long, text string"), model).collect()}
    assert [scored[i].toxic for i in (1, 2, 3)] == [True, False, False] and scored[1].severity > scored[2].severity
    assert (toxicity.fit_on_labels(docs, odd).weights == model.weights).all()
    for none in (odd.limit(0), odd.withColumn("toxic", F.lit(None).cast("int")), odd.withColumn("toxic", F.lit(0))):
        assert not toxicity.fit_on_labels(docs, none).weights.any()
    assert not toxicity.fit_on_labels(docs.limit(0), odd).weights.any()
    half = quality.score(quality.fit_on_labels(docs, odd.limit(0)), np.zeros(0, np.uint8))
    assert abs(half - 0.5) < 1e-6
    assert not quality.score_quality(docs, quality.fit_on_labels(docs, odd, 60)).filter("score is null").count()
    assert docs.select(quality.held_out(F.col("doc_id")).alias("x")).filter("x is null").count() == 0


def test_severity_is_calibrated(spark):
    """A text without telling words has about the labelled share of toxic texts as its chance, and the decision doesn't change."""
    rng = np.random.default_rng(31)
    toxic = [int(i % 10 == 0) for i in range(600)]
    texts = [prose(9000 + i, 40) + (f" {rng.choice(['wretch', 'villain', 'scoundrel'])}" if t and rng.random() < 0.9 else "") for i, t in enumerate(toxic)]
    model = toxicity.fit(texts, toxic)
    scored = toxicity.score_severity(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()
    plain = [r.toxic_chance for r in scored if not r.toxic]
    assert len(plain) > 500 and np.median(plain) < 0.1 and max(plain) < 0.5
    assert abs(np.mean([r.toxic_chance for r in scored]) - 0.1) < 0.05
    for r in scored[:50]:
        leaning = model.chances(toxicity.features(np.frombuffer(r.text.encode(), np.uint8)))
        assert r.toxic == bool(leaning[0] >= 0.5) and np.isclose(r.severity, model.likely(leaning).sum()) and 0 <= r.severity <= toxicity.GRADES


def test_severity_against_a_plain_sum():
    model = toxicity.fit([prose(i, 40) for i in range(60)] + [prose(i, 40) + " wretch villain wretch" for i in range(60, 90)], [0] * 60 + [1] * 30)
    text = "Wretch, villain wretch and alpha"
    counts = defaultdict(int)
    for f in toxicity.features(np.frombuffer(text.encode(), np.uint8)).tolist():
        counts[f] += 1
    value = sum(float(model.weights[f]) * np.log1p(n) for f, n in counts.items())
    assert np.allclose(model.chances(toxicity.features(np.frombuffer(text.encode(), np.uint8))), 1 / (1 + np.exp(model.cuts - value)))


# ------------------------------------------------------------------ packing


def test_bm25_against_the_formula():
    rng = np.random.default_rng(2)
    docs = [rng.integers(0, 60, int(rng.integers(1, 80))).astype("<u2") for _ in range(30)]
    idf = rng.random(1 << 16).astype(np.float32) + 0.1
    index = packing.Bm25(docs, idf, 33.0)

    def weight(t, d):
        tf = int((docs[d] == t).sum())
        return idf[t] * tf * (packing.K1 + 1) / (tf + packing.K1 * (1 - packing.B + packing.B * len(docs[d]) / 33.0)) if tf else 0.0

    for seed in range(30):
        terms = sorted(set(docs[seed].tolist()), key=lambda t: (-np.float32(weight(t, seed)), t))[: packing.QUERY_TERMS]
        assert sorted(index.queries[seed].tolist()) == sorted(terms)
        score = np.array([sum(weight(t, d) for t in terms) for d in range(30)])
        assert np.allclose(index.scores(seed), score, rtol=1e-4)
        used = rng.random(30) < 0.3
        found = index.neighbours(seed, used)
        assert set(found.tolist()) == {d for d in range(30) if score[d] and not used[d]} and (np.diff(index.scores(seed)[found]) <= 1e-6).all()


def test_packing_callers_columns_and_keys(spark):
    rows = [(None, None), (None, "a"), (1, "b c"), (1, "b c")] + [(10 + i, " ".join(f"{WORDS[i % 20]}{j * (i % 20 + 3) % 97}" for j in range(300))) for i in range(300)]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, ids string, content string")
    out = packing.pack(docs, index_tokens=20_000).collect()
    assert sum(r.start == 0 for r in out) == len(rows) and sum(r.length for r in out) == sum(r.doc_tokens for r in out if not r.start)
    fill = defaultdict(int)
    for r in out:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 2048 and sum(n < 2048 for n in fill.values()) <= len(rows) // 10
    same = defaultdict(list)
    for r in out:
        if r.doc_id is not None and r.doc_id >= 10 and not r.start:
            same[(r.doc_id - 10) % 20].append(r.sequence_id >> 40)
    split = sum(len(set(parts)) > 1 for parts in same.values())
    assert split <= len({r.sequence_id >> 40 for r in out})  # copies meet in one shard, but for those at a border of ranges


# ------------------------------------------------------------------ pipeline


def test_pipeline_on_odd_tables(spark, tmp_path):
    """Null ids, texts and sources, repeated rows, no label; then no document at all."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, None, None, None, None), (None, "alone without an id", "en", "a", 0), (1, "x y z", "en", "a", 0), (1, "x y z", "en", "a", 0), (2, "", "en", None, 0), (3, prose(3, 5000), "en", "b", 0), (4, prose(4, 60), "en", None, 0)]
    for name, part in (("some", rows), ("none", [])):
        spark.createDataFrame(part, schema).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/some/documents.parquet")
    for stage, left in zip([f for _, f in corpus_pipeline.STAGES[:3]], (7, 5, 5), strict=True):
        docs = stage(spark, docs, f"{tmp_path}/some")
        assert docs.columns == [c.split()[0] for c in schema.split(", ")] and docs.count() == left
    out = corpus_pipeline.run(spark, f"{tmp_path}/some").collect()
    assert {r.doc_id for r in out if r.length} <= {None, 1, 2, 3, 4} and sum(r.length for r in out) == sum(r.doc_tokens for r in out if not r.start)
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


# ------------------------------------------------------------------ quality: the sample that is fitted


def test_quality_sample_takes_an_id_once(spark):
    rows = [(i, f"text {i}") for i in range(399)] + [(0, f"copy {k}") for k in range(300)] + [(5, None), (None, "x"), (1000, "long " * 20_000)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, quality int")
    marks = [(i, i % 2) for i in range(399)] + [(0, 1)] * 300 + [(7, 0), (1000, 1), (2000, 1), (None, 1), (3, None)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    found = quality.fit_sample(docs, labels, 100).collect()
    assert 99 <= len(found) == len({r["_id"] for r in found})
    assert 49 <= sum(r.quality for r in found) <= 50 and all(r["_id"] is not None and r["_id"] < 399 and zlib.crc32(str(r["_id"]).encode()) % 5 for r in found)
    every = {r["_id"]: (r.quality, r.text) for r in quality.fit_sample(docs, labels, 10_000).collect()}
    want = {i: i % 2 for i in range(399) if zlib.crc32(str(i).encode()) % 5}
    want |= {i: 0 for i in (0, 7) if i in want}
    assert {i: q for i, (q, _) in every.items()} == want
    assert all(every[i][1] == ("copy 0" if i == 0 else "" if i == 5 else f"text {i}") for i in every)
    assert quality.fit_sample(docs.limit(0), labels, 10).count() == 0
