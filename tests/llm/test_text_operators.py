"""Text operators on small tables: brute force, round trips, and rows that are null, empty, repeated or oddly named."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strandwise.llm import exact_dups, fingerprints, html_text, mixing, near_dups, packing, private_data, quality, toxicity, urls

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed: int, n: int) -> str:
    return " ".join(np.random.default_rng(seed).choice(WORDS, n))


@pytest.fixture(scope="module")
def docs(spark):
    """Null, empty, blank, long, copied, nearly copied, repeated rows, a null id and a null source."""
    base = prose(1, 120)
    rows = [(1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \n ", "en", "b", 3), (4, base, "en", "b", 0), (5, base, "en", None, 0), (6, base.replace("alpha", "Alpha", 1) + " tail", "en", "b", 0), (7, prose(2, 20000), "en", "c", 0), (8, "one two", "en", "c", 0), (8, "one two", "en", "c", 0), (9, "ONE two", "en", "c", 0), (10, "é" * 50 + "\U0001f600 " + prose(3, 40), "fr", "c", 0)]
    rows += [(20 + i, prose(100 + i, 60), "en", "d", 0) for i in range(30)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def odd(docs):
    """Extra columns under names that the operators use themselves."""
    return docs.withColumns({c: F.lit("x") for c in ("copies", "rep", "band", "score", "predicted", "_sha", "_row", "severity", "toxic", "private", "component", "rule", "host", "size", "h")})


def pairs(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def brute_components(rows, k, percent):
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets[i] = {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    label = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                n = len(sets[a] & sets[b])
                if n and 100 * n >= percent * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
    return {i: (len(sets[i]), label[i]) for i in sets}


def test_near_duplicates(docs, odd):
    found = near_dups.near_duplicate_groups(odd, 4, 80)
    assert found.count() == docs.count()
    want = brute_components([(r.doc_id, r.text) for r in docs.collect()], 4, 80)
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found.collect()} == {(i, n, c, i == c) for i, (n, c) in want.items()}
    assert near_dups.without_near_duplicates(odd, 4).columns == odd.columns
    assert near_dups.near_duplicate_groups(docs.limit(0)).count() == 0


def test_near_duplicates_in_large_groups(spark):
    base = prose(5, 200).split()
    rows = []
    for i in range(150):
        rng = np.random.default_rng(i)
        text = list(base)
        for at in rng.integers(0, 200, 12):
            text[at] = WORDS[int(rng.integers(len(WORDS)))]
        rows.append((i, " ".join(text)))
    found = near_dups.near_duplicate_groups(spark.createDataFrame(rows, "doc_id long, text string"), 4, 80)
    want = brute_components(rows, 4, 80)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == want


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(0)
    hashes = rng.integers(0, 2**64, 3000, dtype=np.uint64)
    a, b = hashes[:2500], hashes[500:]
    ra, rb = near_dups.registers(a), near_dups.registers(b)
    assert (np.maximum(ra, rb) == near_dups.registers(hashes)).all()
    j = near_dups.likeliest_similarity(np.array([(ra > rb).sum()]), np.array([(ra < rb).sum()]), np.array([2500.0]), np.array([2500.0]))[0]
    assert abs(j - 2000 / 3000) < 0.15


def test_exact_groups(docs, odd):
    found = exact_dups.exact_groups(odd)
    by = defaultdict(list)
    for r in docs.collect():
        by[r.text or ""].append(r.doc_id)
    want = sorted(((i, max(ids), len(ids), i == max(ids), hashlib.sha256(t.encode()).hexdigest()) for t, ids in by.items() for i in ids), key=repr)
    assert pairs(found, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == want
    kept = exact_dups.without_copies(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect()) == sorted(max(ids) for ids in by.values())
    assert exact_dups.exact_groups(docs.limit(0)).count() == 0


def test_mixing(docs, odd):
    out = mixing.mix_sources(odd).collect()
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in out:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken <= 2 * r.size
    total, order = sum(sizes.values()), ["a", "b", "c", "d", None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    want, left, open_ = {}, 1.5 * total, list(order)
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not full:
            want |= share
            break
        for s in full:
            want[s] = 2.0 * sizes[s]
            left -= want[s]
        open_ = [s for s in open_ if s not in full]
    assert {s: round(t, 6) for s, t in target.items()} == {s: round(t, 6) for s, t in want.items()}
    assert abs(taken["d"] - target["d"]) <= 120
    assert [tuple(r) for r in mixing.mix_sources(odd).orderBy("doc_id", "copies").collect()] == sorted((tuple(r) for r in out), key=lambda r: (r[0], r[5]))
    mixed = mixing.mixed_documents(odd)
    assert mixed.columns == odd.columns and mixed.count() == sum(r.copies for r in out)
    assert mixing.mix_sources(docs.limit(0)).count() == 0


def test_packing_round_trip(docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [r for r in docs.collect() if r.doc_id != 8]
    rows.append(type(rows[0])(doc_id=99, text="end <|endoftext|> here", lang="", source="", n_chars=0))
    df = docs.sparkSession.createDataFrame(rows, SCHEMA)
    out = packing.pack(df).collect()
    by, seq = defaultdict(list), defaultdict(list)
    for r in out:
        by[r.doc_id].append(r)
        seq[r.sequence_id].append(r)
    for row in rows:
        ids, at = tokenizer.encode(row.text or "", add_special_tokens=False).ids + [1], 0
        for r in sorted(by[row.doc_id], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids)) and r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for pieces in seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert packing.pack(df.limit(0)).count() == 0


def test_packing_takes_neighbours():
    docs = [np.array(x) for x in ([5, 6, 7, 8], [50, 51, 52], [5, 6, 7, 9], [60, 61])]
    index = packing.Bm25(docs, np.ones(1 << 16, np.float32), 4.0)
    assert packing.chain(index, np.array([len(d) for d in docs]), 100)[:2] == [0, 2]


def test_fingerprints(docs):
    rows = sorted(((r.doc_id, r.text or "") for r in docs.dropDuplicates(["doc_id"]).collect()))
    got = {r.doc_id: r for r in fingerprints.edited_fingerprints(docs.dropDuplicates(["doc_id"]), parts=5).collect()}
    assert len(got) == len(rows)
    for n, (i, text) in enumerate(rows):
        after, cut = rows[(n + 1) % len(rows)][1], len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        r = got[i]
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and r.n_chars == len(text)
        assert (r.fingerprint, r.edited_fingerprint) == (fingerprints.fingerprint(text), fingerprints.fingerprint(edited))
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert got[4].near_next == 1.0 and got[7].near_edited > got[7].near_next
    assert fingerprints.edited_fingerprints(docs.limit(0)).count() == 0
    assert "".join(fingerprints.phrases("abababab")[0]) + fingerprints.phrases("abababab")[1] == "abababab"


def test_urls(spark):
    cases = [(1, "http://A.example.org/es/x"), (2, "https://example.org/en/12?q"), (3, "http://x.com/de/"), (4, "http://x.com/fr/a"), (5, None), (6, "no url"), (7, "http://badexample.org/es/"), (8, "http://org"), (9, "a://b://c/d"), (10, "http://net/#/es")]
    pages = spark.createDataFrame([(i, u, "x") for i, u in cases], "page_id long, url string, rule string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(pages, urls.RULES).collect()}
    assert got[1] == ("a.example.org", "/es/x", "example.org/es/", "block") and got[2][2:] == ("example.org/en/1", "block")
    assert got[3][3] == "block" and got[4][2:] == ("com/fr/", "allow") and got[5] == ("", "", None, "allow") == got[6]
    assert got[7][2] == "org/" and got[8] == ("org", "", None, "allow") and got[9][:2] == ("b:", "//c/d")
    assert urls.without_blocked(pages, urls.RULES).columns == pages.columns
    trie = urls.UrlTrie([("block", "a.com/x/y"), ("allow", "a.com/x/yz/"), ("block", "a.com")])
    assert [trie.find("a.com", p) for p in ("/x/yzz", "/x/yz/q", "", "/q")] == [("a.com/x/y", "block"), ("a.com/x/yz/", "allow"), ("a.com", "block"), ("a.com", "block")]


def test_html():
    page = """<html><head><title>T</title><style>p{}</style></head><body><header>Top</header><nav><ul><li><a href=x>Menu</a></ul></nav>
    <div class="cookie-notice">We use cookies on this page to make it better for all of our many readers everywhere.</div>
    <article><header><h1>Head &amp; line</h1></header><p>First   part&nbsp;one.</p><script>var t="</p>";</script><p>Second <b>bold</b>.<form><input>Sign up</form><p>Ok.
    <aside>See also</aside></article><div id="comments"><p>Reader said a lot of things about this article, all of them quite long and quite loud.</p></div><footer>&copy; end</footer></body></html>"""
    assert html_text.main_text(page) == "Head & line\nFirst part one.\nSecond bold.\nOk."
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<p></p>") == ""
    plain = "<div><a href=a>Home</a></div><div><p>" + "words of the story " * 10 + "</p><p>short</p></div><div><a href=b>Next</a> <a href=c>Last</a></div>"
    assert html_text.main_text(plain) == ("words of the story " * 10).strip() + "\nshort"


def test_html_table(spark):
    pages = spark.createDataFrame([(1, None, "x"), (2, "<p>caf&eacute; \U0001f600</p>", "x")], "page_id long, html string, text string")
    assert pairs(html_text.extract_text(pages), "page_id", "text", "n_chars") == [(1, "", 0), (2, "café \U0001f600", 6)]


def naive_base(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and private_data.luhn(d):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], private_data.KINDS.index(s[0])))


def test_base_patterns():
    rng = np.random.default_rng(4)
    assert private_data.luhn("4539578763621486") and not private_data.luhn("4539578763621487")
    for n in range(3000):
        text = "".join(rng.choice(list("01925.+- ()@ab"), int(rng.integers(0, 40))))
        assert private_data.base_spans(text) == naive_base(text), text
    for n in range(3000):
        text = "".join(rng.choice(list("ab@@..-_ "), int(rng.integers(0, 40))))
        assert private_data.base_spans(text) == naive_base(text), text
    assert private_data.base_spans("a" * 200000 + " b@c.de_f@g.hi") == [("email", 200001, 200007), ("email", 200007, 200014)]
    assert private_data.base_spans("4539 5787-6362 1486 a@b.c 1.2.3.4 +1 (555) 123-4567") == naive_base("4539 5787-6362 1486 a@b.c 1.2.3.4 +1 (555) 123-4567")


def test_private_data(spark):
    contexts = [prose(i, 120) for i in range(40)]
    model = private_data.fit(*private_data.labelled_windows(contexts, 1000), passes=8)
    x, y = private_data.labelled_windows([prose(i, 120) for i in range(50, 60)], 200, seed=99)
    tags = private_data.viterbi(private_data.emissions(model, x), model.trans)
    assert (tags == y).mean() > 0.95
    text = "é" * 3 + " mail a.b@c.de or ring (555) 123-4567 now"
    df = spark.createDataFrame([(1, text, "x"), (2, None, "x"), (3, "", "x")], "doc_id long, text string, spans string")
    got = {r.doc_id: r for r in private_data.find_private(df, model).collect()}
    assert got[1].n_email == 1 and "email:9:17" in got[1].spans and got[1].base_sha256 == hashlib.sha256(b"email:9:17").hexdigest()
    assert got[2].spans == got[3].spans == "" and got[2].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert private_data.masked(df, model).filter("doc_id = 1").first().text.startswith("ééé mail <email> or ring")


def test_private_data_sample(spark, docs, monkeypatch):
    """The sample is that of the least hashes, whatever share of them is looked at."""
    seen = []
    monkeypatch.setattr(private_data, "labelled_windows", lambda texts: (seen.append(texts), ())[1:] * 2)
    monkeypatch.setattr(private_data, "fit", lambda *_: None)
    for spare in (2, 10**6):
        monkeypatch.setattr(private_data, "SPARE", spare)
        private_data.fit_on_sample(docs, 5)
        private_data.fit_on_sample(docs.limit(0), 5)
    assert len(seen[0]) == 5 and seen[0] == seen[2] and seen[1] == seen[3] == []


def test_toxicity(spark, docs, odd):
    clean = [prose(i, 50) for i in range(60)]
    rude = [t + " wretch villain" for t in clean[:25]]
    model = toxicity.fit(clean + rude, [0] * 60 + [1] * 25)
    df = spark.createDataFrame([(1, prose(900, 30)), (2, prose(901, 30) + " Villain, wretch"), (3, None), (4, "")], "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.score_severity(df, model).collect()}
    assert [got[i].toxic for i in (1, 2, 3, 4)] == [False, True, False, False] and got[2].severity > got[1].severity
    assert (np.diff(model.cuts) >= 0).all()
    kept = toxicity.without_toxic(odd, model)
    assert kept.columns == odd.columns and kept.count() == docs.count()
    assert not toxicity.fit(clean, [0] * 60).weights.any()


def test_quality(spark, docs, odd):
    good, bad = [prose(i, 40) for i in range(60)], [re.sub(" ", "### ", prose(i, 40)) for i in range(100, 130)]
    net = quality.fit(good + bad, [1] * 60 + [0] * 30, passes=6)
    scores = lambda texts: [quality.score(net, np.frombuffer(t.encode(), np.uint8)) for t in texts]
    assert min(scores([prose(i, 40) for i in range(300, 310)])) > max(scores([re.sub(" ", "### ", prose(i, 40)) for i in range(400, 410)]))
    out = quality.score_quality(odd, net).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)
    held = docs.select("doc_id", quality.held_out(F.col("doc_id")).alias("x")).collect()
    assert all(r.x == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in held)


def test_pipeline(spark, docs, tmp_path):
    folder = str(tmp_path)
    documents = docs.dropDuplicates(["doc_id"]).unionByName(spark.createDataFrame([(500 + i, prose(700 + i, 50) + " wretch villain", "en", "d", 0) for i in range(12)], SCHEMA))
    documents.write.parquet(f"{folder}/documents.parquet")
    documents.select("doc_id", F.lit(1).alias("quality"), (F.col("doc_id") >= 500).cast("int").alias("toxic")).write.parquet(f"{folder}/labels.parquet")
    stage = spark.read.parquet(f"{folder}/documents.parquet")
    ids = []
    for _, f in corpus_pipeline.STAGES[:-1]:
        stage = f(spark, stage, folder)
        assert stage.columns == documents.columns
        ids.append({r.doc_id for r in stage.collect()})
    assert ids[0] == {r.doc_id for r in docs.collect()}
    assert ids[1] == ids[0] - {1, 4}
    assert ids[2] == ids[1] - {6, 9}  # 9 is 8 in other case
    assert ids[3] <= ids[2]
    assert {r.doc_id for r in corpus_pipeline.run(spark, folder).collect()} == ids[3]


def test_packing_finds_neighbours_of_all_shards(spark):
    rng = np.random.default_rng(5)
    pool = [f"{a}{b}" for a in WORDS for b in WORDS]
    topics = [rng.choice(pool, 12, replace=False) for _ in range(60)]
    rows = [(i, " ".join(rng.choice(topics[i % 60], 50)), "en", "a", 0) for i in range(240)]
    out = packing.pack(spark.createDataFrame(rows, SCHEMA), window=512, index_tokens=4000).collect()
    assert sorted(r.doc_id for r in out if not r.start) == list(range(240)) and sum(r.length for r in out) == sum(r.doc_tokens for r in out if not r.start)
    ids = {r.doc_id: np.frombuffer(r.ids, "<u2") for r in packing.tokenized(spark.createDataFrame(rows, SCHEMA)).collect()}
    seen = np.bincount(np.concatenate([np.unique(x) for x in ids.values()]), minlength=1 << 16)
    index = packing.Bm25([ids[i] for i in range(240)], np.log1p((240.5 - seen) / (seen + 0.5)).astype(np.float32), float(np.mean([len(x) for x in ids.values()])))
    windows = defaultdict(set)
    for r in out:
        windows[r.sequence_id].add(r.doc_id)
    met = 0
    for i in range(240):
        best = set(index.neighbours(i, np.arange(240) == i)[:3].tolist())
        met += any(i in w and best & w for w in windows.values())
    assert met >= 0.8 * 240
