import hashlib
import re
import time

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from mergeloom.llm import decontaminate, html_extract, language_id, licences, pii, toxicity
from mergeloom.llm.blocks import WORD, words

import cases

_A_Z = {c: c + 32 for c in range(65, 91)}


def word_list(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(_A_Z))


def leak_model(docs, items):
    windows = {}
    for item, text in items:
        w = word_list(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, owners = word_list(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    owners |= windows[tuple(w[i : i + n])]
        ids = ",".join(sorted(str(o) for o in owners if o is not None))
        out.append((doc, len(w), len(hit), len(owners - {None}), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


ITEMS = [(1, cases.prose(9, 30)), (2, "one two"), (2, cases.prose(9, 12)), (None, "straße"), (4, None), (5, "..."), (6, "word " * 12)]


def leak_docs():
    inside = cases.prose(9, 30).split()
    more = [" ".join(inside[3:13]), " ".join(inside[3:12]), "say " + cases.prose(9, 30).upper() + " end", "WORD " * 11, "word " * 9]
    return [r[:2] for r in cases.rows()] + [(100 + i, t) for i, t in enumerate(more)]


def test_decontamination(spark, monkeypatch):
    docs = cases.frame(spark, [(*r, None, None, None) for r in leak_docs()])
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    want = leak_model(leak_docs(), ITEMS)
    for block in (decontaminate.BLOCK_BYTES, 100):  # one block, and several
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
        got = decontaminate.decide(docs, items).drop("spans").collect()
        assert sorted(map(tuple, got), key=str) == want
    clean = decontaminate.clean(docs, items)
    assert clean.columns == docs.columns and clean.count() == sum(not r[-1] for r in want)
    assert decontaminate.decide(docs, items.limit(0)).where("contaminated").count() == 0
    assert decontaminate.decide(cases.empty(spark), items).count() == 0


def test_winnowing_guarantee():
    """Any ten shared words leave a shared fingerprint, wherever they stand."""
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 1 << 63, 300, dtype=np.uint64), rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    for at in range(0, 280, 7):
        b2 = b.copy()
        b2[at : at + 10] = a[50:60]
        x, y = decontaminate.grams(a, 5), decontaminate.grams(b2, 5)
        assert set(x[decontaminate.winnow(x)]) & set(y[decontaminate.winnow(y)])


def test_words_match_a_regex():
    texts = ["", "Ab  c1é", "x", "日本 a-b", "end", "é" * 50]
    w = words(pa.array(texts), WORD)
    for i, t in enumerate(texts):
        assert [w.word(j).decode() for j in range(w.rows[i], w.rows[i + 1])] == word_list(t)


def test_language(spark):
    texts = {"en": "the cat with the hat and the other thing ", "fr": "le chat avec le chapeau et une autre chose "}
    rows = [(i, texts["en" if i % 2 else "fr"] * (1 + i % 3), "en" if i % 2 else "fr", "s", 0) for i in range(80)]
    rows += [(100, None, "en", "s", 0), (101, "12 !", "fr", "s", 0), (None, texts["en"], None, "s", 0), (102, texts["fr"] * 3000, None, "s", 0)]
    docs = cases.frame(spark, rows)
    got = {r.doc_id: r for r in language_id.identify(docs).collect()}
    assert got[100].lang_pred == got[101].lang_pred == "und" and got[100].score == 0
    assert got[None].lang_pred == "en" and got[102].lang_pred == "fr"
    assert all(got[i].lang_pred == ("en" if i % 2 else "fr") and 0 <= got[i].score <= 1 for i in range(80))
    kept = language_id.accepted(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 2
    assert language_id.identify(cases.empty(spark)).count() == 0
    untaught = language_id.identify(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in untaught.collect()} == {"und"}


def test_language_counts_every_gram():
    """The vectorised n-grams equal a plain count, also across chunk edges."""
    text = "Été, là-bas!  x"
    norm = " été là bas x "
    points, offsets, letters = language_id.characters([text, ""])
    assert "".join(map(chr, points[offsets[0] : offsets[1]])) == norm and letters.tolist() == [sum(c.isalpha() for c in text), 0]
    old, language_id._AT_ONCE = language_id._AT_ONCE, 4
    try:
        got = sorted(int(b) for row, bs in language_id._pieces(points, offsets) for r, b in zip(row, bs) if r == 0)
    finally:
        language_id._AT_ONCE = old
    codes = np.array([ord(c) for c in norm], np.uint32)
    assert got == sorted(int(b) for n in (1, 2, 3) for b in language_id.buckets(codes, n))


def test_language_held_out(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    held = language_id.identify(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    right = held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.9


def test_toxicity_learns_pairs():
    """Of four terms, only two pairs are toxic: all six pairs look alike to an additive model."""
    rng = np.random.default_rng(4)
    rows, toxic = [], []
    for i in range(6000):
        pair = rng.choice([1, 2, 3, 4], 2, replace=False).tolist() if rng.random() < 0.4 else []
        rows.append(np.unique(np.array([*rng.integers(100, 140, 3), *pair], np.int32)))
        toxic.append(float(set(pair) in ({1, 2}, {3, 4})))
    m = toxicity.fit(rows, np.array(toxic))
    s = toxicity.sigmoid(m.raw(rows))
    assert ((s >= 0.5) == np.array(toxic)).mean() > 0.97


def test_toxicity_learns_terms_that_say_nothing_alone():
    """Each of two terms is as common in toxic texts as in others; which are toxic shows in both together."""
    rng = np.random.default_rng(4)
    rows, toxic = [], []
    for _ in range(1500):
        for terms in [(), (1,), (2,), (1, 2)]:
            rows.append(np.unique(np.array([*rng.integers(100, 400, 5), *terms], np.int32)))
            toxic.append(float(len(terms) != 1))
    toxic = np.array(toxic)
    for t in (1, 2):
        assert toxic[[t in r for r in rows]].mean() == toxic.mean()
    m = toxicity.fit(rows[:4000], toxic[:4000])
    s = toxicity.sigmoid(m.raw(rows[4000:]))
    assert ((s >= 0.5) == toxic[4000:]).mean() > 0.97
    assert m.known[np.unique(np.concatenate(rows[:4000]))].all()


def test_toxicity(spark):
    rows = [(i, cases.prose(i, 40) + (" idiot moron" if i % 4 == 0 else ""), "en", "s", 0) for i in range(400)]
    rows += [(900, None, "en", "s", 0), (901, "", "en", "s", 0), (902, "idiot " * 30000, "en", "s", 0), (None, "idiot", "en", "s", 0)]
    labels = [(i, 1, int(i % 4 == 0)) for i in range(400)] + [(3, 1, None), (None, 1, 1), (900, 0, 0)]
    docs, marks = cases.frame(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.decide(docs, marks).collect()}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    assert sum(got[i].predicted == int(i % 4 == 0) for i in range(400)) > 390
    assert got[900].score == got[901].score
    assert toxicity.decide(cases.empty(spark), marks).count() == 0
    assert {r.score < 1e-9 for r in toxicity.decide(docs, marks.limit(0)).collect()} == {True}


PII_TEXT = (
    "Mail a.b+c@x-1.example.com, bad@host x@y.z@w.v.u @q.r ; ip 10.0.0.255 256.1.1.1 1.2.3.4.5 "
    "card 4111 1111 1111 1111 4111111111111112 4111-1111-1111-1111 tel +1 (555) 123-4567 +12 345 é +49.30.1234567."
)


def pii_model(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        odd = sum(d[-1::-2]) + sum(sum(divmod(2 * x, 10)) for x in d[-2::-2])
        if 13 <= len(d) <= 19 and odd % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_pii_base_spans():
    rng = np.random.default_rng(8)
    alphabet = list("a1.@+- (5é0") + ["@x.y", "4111 1111 1111 1111", "+1 555 123 4567", "1.2.3.4"]
    texts = [PII_TEXT, "", "@", "a@b.c@d.e"] + ["".join(rng.choice(alphabet, 40)) for _ in range(3000)]
    for t in texts:
        assert pii.base_spans(t) == pii_model(t), t


def test_pii_long_runs():
    """Megabytes of digits, dots, spaces and @ in seconds."""
    start = time.perf_counter()
    assert pii.base_spans("7" * 1_000_000) == []
    assert pii.base_spans("1." * 500_000) == [("ip", 8 * i, 8 * i + 7) for i in range(125_000)]
    assert pii.base_spans("0" * 9000 + "1.2.3.4") == [("ip", 0, 9007)]
    for t in ("1 " * 500_000, "a@" * 500_000, "+1(" * 300_000, "+1" + "(" * 1_000_000, "x" * 1_000_000 + "@1"):
        assert pii.base_spans(t) == []
    assert time.perf_counter() - start < 30


def test_pii(spark):
    mail = " contact zorblat now at jo@mail.example.com please friend "
    rows = [(i, cases.prose(i, 30) + (mail if i < 3 else ""), "en", "s", 0) for i in range(60)]
    rows += [(100, None, "en", "s", 0), (101, PII_TEXT, "en", "s", 0), (101, PII_TEXT, "en", "s", 0), (None, mail, "en", "s", 0)]
    docs = cases.frame(spark, rows)
    got = pii.decide(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        text = next(t for i, t, *_ in rows if i == r.doc_id)
        spans = pii_model(text)
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest() and r.spans.startswith(base)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in spans) for k in pii.KINDS)
    terms = {rows[0][1][int(a) : int(b)] for s in next(r.spans for r in got if r.doc_id == 0).split(",") for k, a, b in [s.split(":")] if k == "term"}
    assert "zorblat" in terms and "jo" not in terms
    clean = next(r.text for r in pii.sanitise(docs).collect() if r.doc_id == 0)
    assert "zorblat" not in clean and "<EMAIL>" in clean and "jo@" not in clean
    assert pii.decide(cases.empty(spark)).count() == 0


def test_pii_terms_far_from_the_entity(spark):
    """A name is found wherever it stands, and every mention of it goes."""
    letter = "Zorblat writes. " + cases.prose(7, 40) + " yours zorblat, jo@mail.example.com " + cases.prose(8, 30) + " ZORBLAT"
    rows = [(i, letter if i < 3 else cases.prose(i, 60), "en", "s", 0) for i in range(60)]
    docs = cases.frame(spark, rows)
    got = next(r.spans for r in pii.decide(docs).collect() if r.doc_id == 0).split(",")
    found = [letter[int(a) : int(b)] for k, a, b in (s.split(":") for s in got) if k == "term"]
    assert found == ["Zorblat", "writes", "yours", "zorblat", "ZORBLAT"]
    clean = next(r.text for r in pii.sanitise(docs).collect() if r.doc_id == 0)
    assert "zorblat" not in clean.lower() and "<EMAIL>" in clean


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{x}}</style></head><body><nav><ul><li><a>M{0}</a></li></ul></nav>
<div class="ad">Buy {0}</div><article><h1>Head&amp;line {0}</h1><p>One <b>bold</b>   text{0}<br>next<p>Two &lt;x&gt; {0}
<div class="comments">Reader {0}</div></article><aside>Side</aside><form>F</form><footer>&copy; f</footer></body></html>"""


def test_html(spark):
    plain = "<body><div class='top'>Welcome all</div><div class='text'><p>Story {0} goes on for long.</p></div><div class='bot'>Good bye</div></body>"
    rows = [(i, "http://a.example/x", PAGE.format(i)) for i in range(6)] + [(10 + i, "https://b.example/", plain.format(i)) for i in range(8)]
    rows += [(20, None, None), (21, "c", ""), (22, "http://a.example/y", "<p>open <i>tags"), (None, "http://a.example/x", PAGE.format(0)), (0, "http://a.example/x", PAGE.format(0))]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("host", F.lit("x")).withColumn("low", F.lit("y"))
    got = {r.page_id: r for r in html_extract.extract(pages).collect()}
    assert html_extract.extract(pages).count() == len(rows)
    for i in range(6):
        assert got[i].text == f"Head&line {i}\nOne bold text{i} next\nTwo <x> {i}"
        assert got[i].n_chars == len(got[i].text)
    for i in range(8):
        assert got[10 + i].text == f"Story {i} goes on for long."  # the site's tree finds the frame
    assert got[20].text == got[21].text == "" and got[22].text == "open tags"
    assert html_extract.extract(pages.limit(0)).count() == 0


def test_html_copies_stay_whole(spark):
    """Equal pages are copies, not a template; nor is a passage that many articles share."""
    copy = "<article><p>Same words here.</p><p>And here.</p></article>"
    share = "<article><p>Shared passage.</p><p>Own {0}.</p></article>"
    rows = [(i, "http://a.example/", copy) for i in range(9)] + [(20 + i, "http://b.example/", share.format(i)) for i in range(9)]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got[0] == "Same words here.\nAnd here." and got[23] == "Shared passage.\nOwn 3."


def test_html_names_of_classes():
    """A class names a part of the page, not a wrapper around the article nor a part of it."""
    text = lambda html: html_extract.main_text(html, set())
    story = "<article><p>A story of some words.</p></article>"
    assert text(f"<div class='layout has-sidebar'>{story}</div>") == text(f"<div class='page-header'>{story}</div>") == "A story of some words."
    assert text(f"<form>{story}</form><div class='related'><article>Other</article></div>") == "A story of some words."
    inner = "<article><div class='article-header'>Head</div><p>Text <b class='ad'>buy</b> on.</p><div class='related-work'>Others</div><div id='comment-list'>{}</div></article>"
    assert text(inner.format("I like it. " * 50)) == "Head\nText on.\nOthers"
    assert text("<div class='site-footer'>foot</div><div>A story of some words.</div><div class='comments'>" + "So long. " * 50) == "A story of some words."


def test_html_template_larger_than_the_text(spark):
    menu = "".join(f"<div>Entry {c}</div>" for c in "abcdefghijkl")
    short = menu + "<p>A short story, number {0}.</p><div>Imprint</div>"
    near = "<h2>Heading that stays</h2>" + "".join(f"<div>Paragraph {c} that every copy of the text repeats.</div>" for c in "abcdefgh") + "<div>Paragraph that is edited in copy {0} only.</div>"
    rows = [(i, "http://s.example/", short.format(i)) for i in range(20)] + [(100 + i, "http://n.example/", near.format(i)) for i in range(20)]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    for i in range(20):
        assert got[i] == f"A short story, number {i}."
        assert got[100 + i].count("\n") == 9 and got[100 + i].endswith(f"in copy {i} only.")


def test_html_deep_pages():
    """Time grows with a page's length, whatever stays open."""
    for piece in ("<span>w ", "<div>w ", "<span>w<li>"):
        start = time.time()
        page = html_extract.parsed(piece * 100_000)
        html_extract.features(page)
        assert html_extract.main_text(piece * 100_000, {1}).count("w") == 100_000
        assert time.time() - start < 30


def low_model(pages):
    """Low keys of one host's pages from the definition of importance."""
    shown = {}
    for html in pages:
        content, rows = html_extract.features(html_extract.parsed(html))
        for node, feature, children, _, hint in rows:
            shown.setdefault(node, {}).setdefault((feature, children, hint), set()).add(content)
    low = set()
    for node, found in shown.items():
        m = len(set().union(*found.values()))
        if m < html_extract.LEAST_PAGES:
            continue

        def entropy(shares):
            return -sum(p * np.log(p) for p in shares) / np.log(m)

        texts = {f: 1 - entropy([1 / len(on)] * len(on)) for (f, c, _), on in found.items() if c < 0}
        shapes = {f: (c, len(on)) for (f, c, _), on in found.items() if c >= 0}
        shown_on = sum(n for _, n in shapes.values())
        g = 0.9 ** (sum(c * n for c, n in shapes.values()) / shown_on) if shapes else 1.0
        presentation = min(1.0, entropy([n / m for _, n in shapes.values()])) if shapes else 1.0
        importance = (1 - g) * presentation + g * (np.mean(list(texts.values())) if texts else 1.0)
        low |= {node} if importance * (0.5 if any(h for _, _, h in found) else 1) < html_extract.LEAST_IMPORTANCE else set()
        low |= {node ^ f for f, v in texts.items() if v < html_extract.LEAST_IMPORTANCE}
    return low


def test_html_tree_is_the_definition(spark):
    rng = np.random.default_rng(11)
    hosts = {}
    for h in range(4):
        for _ in range(24):
            bits = [f"<div class='m{j}'><i>Menu {j if rng.random() < 0.9 else rng.integers(99)}</i><b>x</b></div>" for j in range(5) if rng.random() < 0.85]
            bits += [f"<section class='post-header'><p>{cases.prose(int(rng.integers(1000)), 12)}</p></section>" for _ in range(int(rng.integers(1, 4)))]
            bits += ["<ul class='l'>" + "".join(f"<li>Item {rng.integers(3)}</li>" for _ in range(int(rng.integers(1, 15)))) + "</ul>"]
            hosts.setdefault(f"h{h}", []).append("<body>" + "".join(bits))
    rows = [(i, f"http://{h}/{i}", html) for h, pages in hosts.items() for i, html in enumerate(pages)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.host: set(r.low) for r in html_extract.noise(pages).collect()}
    key = {r.h: r.k for r in spark.createDataFrame([(h,) for h in hosts], "h string").select("h", F.xxhash64("h").alias("k")).collect()}
    for h, own in hosts.items():
        assert low_model(own) and got[key[h]] == low_model(own)


def test_licences(spark):
    lines = ["Released under the MIT License.", "licensed under the apache license, version 2.0", "Licensed under CC BY-NC 4.0."]
    rows = [(i, cases.prose(i, 30) + "\n" + (lines[i % 3] + "\n" if i % 2 else "") + cases.prose(i + 99, 20), "en", "s", 0) for i in range(40)]
    rows += [(100, None, "en", "s", 0), (101, "", "en", "s", 0), (None, lines[0], "en", "s", 0), (102, cases.prose(5, 9000) + "\n" + lines[0] * 1, "en", "s", 0), (1, rows[1][1], "en", "s", 0)]
    docs = cases.frame(spark, rows)
    got = licences.decide(docs).collect()
    assert len(got) == len(rows)
    families = {0: "MIT", 1: "Apache-2.0", 2: "CC-BY-NC"}
    for r in got:
        want = families[r.doc_id % 3] if r.doc_id is not None and r.doc_id < 40 and r.doc_id % 2 else "MIT" if r.doc_id in (None, 102) else ""
        assert r.families == want and r.n_found == int(bool(want)), r
    assert licences.decide(cases.empty(spark)).count() == 0
