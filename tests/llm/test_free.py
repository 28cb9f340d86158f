"""Near duplicates, leaks, toxicity, pieces, pages, licenses and the pipeline against plain Python."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.cases import CLASHING, EDGES, documents
from tidewatch.llm import leaks, licenses, pages, pieces, quality, simhash, toxicity
from tidewatch.llm.common import text_settings

SHORT = [x for x in EDGES if x is None or len(x) < 35000]
SYLLABLES = "an be co du er fi go ha in jo ku la mi no or pa qui re su ta".split()


@pytest.fixture(autouse=True)
def batches(spark):
    text_settings(spark)


def prose(seed, words, vocabulary=4000):
    draw = random.Random(seed)
    word = lambda n: "".join(SYLLABLES[n // 20**k % 20] for k in range(3))
    return " ".join(word(draw.randrange(vocabulary)) for _ in range(words))


# Near duplicates ------------------------------------------------------------------


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for bit in range(64):
            ones[bit] += h >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * ones[bit] > len(shingles))


def brute_components(prints, radius=2):
    root = {fp: fp for fp in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    some = sorted(root)
    for i, a in enumerate(some):
        for b in some[i + 1 :]:
            if (a ^ b).bit_count() <= radius:
                a_root, b_root = find(a), find(b)
                root[max(a_root, b_root)] = min(a_root, b_root)
    return {fp: find(fp) for fp in root}


def test_near_duplicates_match_brute_force(spark):
    long = prose(1, 900).split()
    texts = [*SHORT, *(prose(i, 40) for i in range(2, 30))]
    for i in range(25):  # near copies: one word changed in a long text
        copy = list(long)
        copy[i * 7] = "changed"
        texts.append(" ".join(copy))
    texts += [prose(5, 40)] * 5
    docs = documents(spark, texts, extra=CLASHING)
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == len(texts)
    want = Counter(brute_print(t) for t in texts)
    assert Counter(r["fp"] % 2**64 for r in rows) == want
    roots = brute_components(want)
    low = {}
    for r in rows:
        root = roots[r["fp"] % 2**64]
        if r["doc_id"] is not None:
            low[root] = min(low.get(root, r["doc_id"]), r["doc_id"])
    assert all(r["component_id"] == low.get(roots[r["fp"] % 2**64]) for r in rows)
    assert any(sum(x == root for x in roots.values()) > 3 for root in roots.values())
    kept = simhash.deduplicate(docs, simhash.Sketch())
    assert kept.columns == docs.columns and kept.count() == len(set(roots.values()))
    twice = docs.union(docs)
    assert simhash.deduplicate(twice, simhash.Sketch()).count() == kept.count()
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 and simhash.deduplicate(docs.limit(0)).count() == 0


def test_one_document_of_each_group_stays(spark):
    texts = [prose(i, 120) for i in range(20)]
    long = prose(99, 2000).split()
    for i in range(10):
        copy = list(long)
        copy[i * 150] = "other"
        texts.append(" ".join(copy))
    texts += [texts[1], texts[1].upper(), "", None, "few words"]
    docs = documents(spark, texts, extra=(*CLASHING, "a.b"))
    docs = docs.withColumn("held", F.expr("map(lang, n_chars)"))
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    kept = [r["text"] for r in kept.collect()]
    roots = brute_components({brute_print(t) for t in texts})
    assert len(kept) == len(set(roots.values())) and {roots[brute_print(t)] for t in kept} == set(roots.values())
    assert {*texts[:20], "few words"} <= set(kept) and len(kept) < len(texts) - 5


def test_the_index_loses_no_link(monkeypatch):
    draw = np.random.default_rng(3)
    base = draw.integers(0, 2**63, 40, dtype=np.uint64)
    flips = [b ^ np.uint64(1 << int(i)) ^ np.uint64(1 << int(j)) for b in base for i, j in draw.integers(0, 22, (30, 2))]
    fp = np.unique(np.concatenate([base, np.array(flips, np.uint64)]))
    rank = fp.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    fp = fp[np.argsort(rank)]
    x = simhash.bits(fp[:, None] ^ fp[None])
    i, j = np.nonzero((x <= 2) & (x > 0))
    want = [y.tolist() for y in simhash.stars(fp[i], fp[j])]
    none = np.zeros(len(fp), np.int64)
    for step in (simhash.STEP, 1 << 10):
        monkeypatch.setattr(simhash, "STEP", step)
        a, b = simhash.Index(fp, np.zeros(1, np.int64)).links(2)
        assert [y.tolist() for y in simhash.stars(fp[a], fp[b])] == want and len(want[0]) > 1000
    a, b = simhash.group_links(none, none, fp, simhash.Sketch())
    assert len(set(a.tolist())) == len(a) == len(want[0])


def test_the_index_keeps_groups_apart_and_shares_their_bits():
    draw = np.random.default_rng(8)
    sizes = draw.choice([1, 1, 2, 3, 16, 17, 40, 300], 80)
    groups = [np.unique(draw.integers(0, 2**9, n, dtype=np.uint64) ^ np.uint64(draw.integers(0, 2**60))) for n in sizes]
    groups = [g[np.argsort(np.array([int(x) for x in g], np.uint64))] for g in groups]
    fp = np.concatenate(groups)
    starts = np.cumsum([0, *map(len, groups)])[:-1]
    index = simhash.Index(fp, starts)
    assert len(index.pattern[-1]) == len(groups) and len(index.pattern) > 2
    for pattern, mask, start, own in zip(index.pattern[-1].tolist(), index.mask[-1].tolist(), starts.tolist(), groups):
        values = [int(x) for x in own]
        shared = ~0 & (2**64 - 1)
        for x in values:
            shared &= ~(x ^ values[0])
        assert mask == shared % 2**64 and pattern == values[0] & mask
    a, b = index.links(2)
    want = set()
    for start, own in zip(starts.tolist(), groups):
        i, j = np.nonzero(np.triu(simhash.bits(own[:, None] ^ own[None]) <= 2, 1))
        want |= set(zip((i + start).tolist(), (j + start).tolist()))
    assert set(zip(a.tolist(), b.tolist())) == want and len(want) > 500


def test_every_close_pair_shares_a_mask():
    for sketch in (simhash.Sketch(), simhash.Sketch(radius=3, blocks=6)):
        masks = [m % 2**64 for m in sketch.masks()]
        draw = random.Random(1)
        for _ in range(500):
            diff = sum(1 << b for b in draw.sample(range(64), sketch.radius))
            assert any(diff & m == 0 for m in masks)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(-5, -3), (-3, -9), (7, 7)]
    got = {r["fp"]: r["root"] for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {100 + i: 100 for i in range(1, 50)} | {-5: -9, -3: -9}


def test_hubs_have_homes_by_their_links(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HOME", 5)
    edges = [(1000, i) for i in range(300)] + [(2000, 2000 + i) for i in range(1, 200)] + [(2100, 999)] + [(5000, 5001)]
    got = {r["fp"]: r["root"] for r in simhash.components(spark.createDataFrame(edges * 2, "a long, b long")).collect()}
    want = {i: 0 for i in range(1, 300)} | {1000: 0} | {2000 + i: 999 for i in range(200)} | {5001: 5000}
    assert got == want


# Leaks ----------------------------------------------------------------------------


def brute_align(a, b):
    best = 0
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b, 1):
            new.append(max(0, row[j - 1] + (1 if x == y else -1), row[j] - 1, new[-1] - 1))
        best, row = max(best, *new), new
    return best


def test_alignment_matches_brute_force():
    draw = random.Random(4)
    for _ in range(200):
        a, b = ([draw.choice("abcde") for _ in range(draw.randrange(1, 12))] for _ in range(2))
        score, start, end = leaks.align(a, b)
        assert score == brute_align(a, b) and (not score or 0 <= start < end <= len(b))


def test_leaks_are_found_and_clean_texts_left(spark):
    items = [prose(100 + i, 40) for i in range(12)] + [None, "", "short one", prose(100, 40)]
    edited = items[3].split()
    for i in range(4, 40, 7):
        edited[i] = "other"
    texts = [*SHORT, *(prose(i, 200) for i in range(200, 230)), *[f"{prose(1, 90)} {items[2].upper()}. {prose(2, 90)}"] * 4]
    texts += [f"{prose(3, 50)} {' '.join(edited)} {prose(4, 50)}", prose(6, 30) + " " + items[5] + " " + prose(7, 800) + " " + items[6]]
    texts += [" ".join(items[7].split()[:8]) + prose(8, 100)]
    docs = documents(spark, texts, extra=CLASHING)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = leaks.find(docs, bench).collect()
    n = len(texts)
    want = {(n - 7 + i, 2) for i in range(4)} | {(n - 3, 3), (n - 2, 5), (n - 2, 6)}
    assert {(r["doc_id"], r["item_id"]) for r in rows if r["doc_id"] is not None} | {(n - 7 + i, 2) for i in range(4)} == want
    assert sum(r["item_id"] == 2 for r in rows) == 4
    exact = next(r for r in rows if r["item_id"] == 5)
    assert exact["score"] == 1.0 and texts[n - 2].split()[exact["start"] : exact["end"]] == items[5].split()
    kept = leaks.decontaminate(docs, bench)
    assert kept.columns == docs.columns and kept.count() == n - 6
    assert leaks.find(docs.limit(0), bench).count() == 0 and leaks.decontaminate(docs, bench.limit(0)).count() == n


def test_edited_copies_in_numbers_are_found(spark):
    item = prose(321, 40)
    edited = item.split()
    for i in range(4, 40, 7):
        edited[i] = "other"
    texts = [f"{prose(600, 50)} {item} {prose(601, 50)}"]
    texts += [f"{prose(610 + i, 50)} {' '.join(edited)} {prose(620 + i, 50)}" for i in range(9)]
    texts += [prose(630 + i, 150) for i in range(4)]
    docs = documents(spark, texts)
    bench = spark.createDataFrame([(1, item), (2, prose(322, 40))], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in leaks.find(docs, bench).collect()} == {(i, 1) for i in range(10)}
    assert {r["doc_id"] for r in leaks.decontaminate(docs, bench).collect()} == {10, 11, 12, 13}


# Toxicity -------------------------------------------------------------------------


def test_restores_disguised_words(spark):
    texts = ["the stupid idiot and the other moron are scum, said a stupid clown of moron and idiot"] * 30 + [prose(i, 50) for i in range(30)]
    model = toxicity.language_model(toxicity.char_counts(documents(spark, texts)))
    for disguised, plain in (("1d10t", "idiot"), ("stuuuupid", "stupid"), ("m0r0n", "moron"), ("i d i o t", "idiot"), ("$cum", "scum"), ("s.t.u.p.i.d", "stupid")):
        assert toxicity.restore(disguised, model) == plain
        assert plain in toxicity.words_of(f"and {disguised}, then", model, {})


def readings(token, edge):
    """All readings of a token with the cost of its channel."""
    found, last = [("", 0.0)], ""
    for c in token:
        if c.isalpha():
            step = [(c, 0.0)] + ([("", -0.5)] if c == last else [])
        elif c in toxicity.LEET:
            step = [(x, -0.7) for x in toxicity.LEET[c]] + [("", -1.5)]
        else:
            step = [("", 0.0)] + ([(" ", edge)] if edge is not None else [])
        found = [(word + x, cost + y) for word, cost in found for x, y in step if x != " " or word[-1:] not in ("", " ")]
        last = c
    return found


def letters_score(word, model):
    a = b = toxicity.EDGE
    total = 0.0
    for c in word if word.endswith(" ") or not word else word + " ":
        n = toxicity.EDGE if c == " " else toxicity.LETTERS.index(c)
        total, a, b = total + model[a, b, n], b, n
    return total


@pytest.mark.parametrize("edge", [None, -1.0, 0.0])
def test_restoring_finds_the_best_of_all_readings(spark, edge):
    model = toxicity.language_model(toxicity.char_counts(documents(spark, ["the stupid idiot and the other moron are scum"] * 9 + [prose(i, 50) for i in range(9)])))
    for token in ("1d10t", "1-d.10t", "s.t.u.p.i.d", "a--b", "-", "ssttuu", "3e3e", "t h e m o r o n", "@nd.the"):
        best = defaultdict(lambda: -np.inf)
        for word, cost in readings(token, edge):
            best[word.strip()] = max(best[word.strip()], cost + letters_score(word, model))
        got = toxicity.restore(token, model, edge)
        assert best[got] == pytest.approx(max(best.values()))


def test_long_runs_are_cut_into_words(spark):
    texts = ["the stupid idiot and the other moron are scum, said a stupid clown of moron and idiot"] * 30
    model = toxicity.language_model(toxicity.char_counts(documents(spark, texts)))
    plain = " ".join(texts[:40])
    words = {w for w in plain.replace(",", "").split() if len(w) > 2}
    for sign in " .-_":
        found = toxicity.words_of(sign.join(plain.replace(" ", "").replace(",", "")), model, {})
        assert len(words & found) >= 0.7 * len(words) and {"stupid", "idiot", "moron"} <= found
    assert toxicity.restore("1d10t" * 40, model) == "idiot" * 40


def test_scores_every_document(spark):
    docs = documents(spark, SHORT, extra=CLASHING)
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(6)], "doc_id long, quality int, toxic int")
    for some in (labels, labels.limit(0), labels.where("toxic = 1")):
        rows = toxicity.score_documents(docs, some).collect()
        assert len(rows) == len(SHORT) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert toxicity.score_documents(docs.limit(0), labels).count() == 0


def test_held_out_toxicity(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    scored = toxicity.score_documents(docs, labels).where("held_out").join(labels, "doc_id").select("score", "predicted", "toxic").collect()
    right = sum(r["predicted"] == r["toxic"] for r in scored) / len(scored)
    caught = sum(r["predicted"] for r in scored if r["toxic"]) / sum(r["toxic"] for r in scored)
    assert right > 0.97 and caught > 0.85


# Pieces ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary.load(corpus_pipeline.MODEL)


def brute_best(vocabulary, stream):
    """Best score over all segmentations."""
    best = [0.0] + [float("-inf")] * len(stream)
    for end in range(1, len(stream) + 1):
        for start in range(end):
            part = stream[start:end]
            score = vocabulary.ids[part][1] if part in vocabulary.ids else vocabulary.unknown if end - start == 1 else float("-inf")
            best[end] = max(best[end], best[start] + score)
    return best[-1]


def test_encoding_is_the_best_segmentation(vocabulary):
    library = sentencepiece.SentencePieceProcessor(model_file=corpus_pipeline.MODEL)
    texts = ["Hello world", "Two  spaces, and\nlines\tand tabs.", "Éàü straße niño coração", prose(1, 60), "a", "the quick brown fox jumps over it", "😀 x ﬁ"]
    for text in texts:
        stream = "▁" + text.replace(" ", "▁")
        ids = np.frombuffer(vocabulary.encode(stream), np.int32).tolist()
        assert sum(vocabulary.best(x)[0] for x in pieces.UNITS.findall(stream)) == brute_best(vocabulary, stream)
        assert library.decode(ids) == text == vocabulary.decode(np.array(ids))
        assert score_of(vocabulary, ids) >= score_of(vocabulary, library.encode(text))


def score_of(vocabulary, ids):
    by_id = {i: s for i, s in vocabulary.ids.values()}
    return sum(by_id.get(i, 0) for i in ids)


def test_ids_are_those_of_the_library(spark, vocabulary):
    library = sentencepiece.SentencePieceProcessor(model_file=corpus_pipeline.MODEL)
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").limit(300).collect()
    draw = random.Random(8)
    texts = [r["text"] for r in rows] + [t for t in EDGES if t] + ["the quick brown fox", "日本語 テキスト😀 " * 30, "aaab" * 700, " " * 70 + "x" + "\n \n" * 9]
    texts += ["".join(draw.choice("aabbe  \n\t.é😀") for _ in range(200)) for _ in range(100)]
    for chunk in (16_384, 64):
        for text in texts:
            if text:
                ids = np.frombuffer(vocabulary.encode("▁" + text.replace(" ", "▁"), chunk), np.int32).tolist()
                assert ids == library.encode(text), text[:80]
    docs = documents(spark, texts)
    assert all(r["ids"] == library.encode(r["text"] or "") for r in pieces.encode(docs, vocabulary, chunk=100).collect())


def test_round_trip_and_chunks(spark, vocabulary):
    texts = [*EDGES, "x" * 5000, "  gaps  " * 200, "日本語のテキスト😀" * 40, prose(3, 700)]
    docs = documents(spark, texts, extra=CLASHING)
    whole = pieces.decode(pieces.encode(docs, vocabulary), vocabulary).collect()
    chunked = pieces.decode(pieces.encode(docs, vocabulary, chunk=64), vocabulary)
    assert "_row" not in chunked.columns
    chunked = chunked.collect()
    assert len(whole) == len(chunked) == len(texts)
    for rows in (whole, chunked):
        assert all(r["decoded"] == (r["text"] or "") for r in rows)
    best = {r["text"]: r["ids"] for r in whole}
    assert all(score_of(vocabulary, r["ids"]) == score_of(vocabulary, best[r["text"]]) for r in chunked)
    assert pieces.encode(docs.limit(0), vocabulary).count() == 0


# Pages ----------------------------------------------------------------------------

PAGE = (
    '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="has-sidebar">'
    "<header><h1>Site</h1></header><nav><ul><li><a href='/x'>Menu</a></li></ul></nav><!-- a > b --><div class=\"ad\">Buy</div>"
    "<div class='cookie-notice'>We use <div>cookies</div></div><article><h1>Head &amp; line</h1><p>First <b>para\n graph<br>goes<p>Second&nbsp;one &lt;ok&gt; 3 < 4</p>"
    "<form><input name=q><p>Form</p></form><aside>Side</aside><div id=comments><p>Reader</p></div><ul><li>Point</li></ul></article><footer>&copy; f</footer></body></html>"
)


def test_blocks_of_a_page():
    assert [t for t, own in pages.blocks(PAGE) if own] == ["Head & line", "First para graph goes", "Second one <ok> 3 < 4", "Point"]
    assert all(own for _, own in pages.blocks(PAGE))
    for odd in (None, "", "<", "<p", "<div class=ad>lost<article><p>Found", "text only", "<!-- open", "<p>a</p></article></div>"):
        pages.blocks(odd)
    assert pages.blocks("<div class=ad>lost<article><p>Found") == [("Found", True)]


def brute_covered(streams, least, count):
    """Places covered by runs of `least` tokens, or whole blocks, that `count` pages share."""
    seen = defaultdict(set)
    for page, found in streams.items():
        for block in found:
            tokens = block.split(" ")
            for i in range(len(tokens) - least + 1):
                seen[tuple(tokens[i : i + least])].add(page)
            seen["whole", block].add(page)
    out = {}
    for page, found in streams.items():
        kept = []
        for block in found:
            tokens = block.split(" ")
            gone = [False] * len(tokens)
            for i in range(len(tokens) - least + 1):
                if len(seen[tuple(tokens[i : i + least])]) >= count:
                    gone[i : i + least] = [True] * least
            if len(seen["whole", block]) >= count:
                gone = [True] * len(tokens)
            if not all(gone):
                kept.append(" ".join(t for t, g in zip(tokens, gone) if not g))
        out[page] = "\n\n".join(kept)
    return out


def test_host_boilerplate_matches_brute_force(spark):
    common = prose(9, 30)
    streams = {}
    for i in range(12):
        first = f"{prose(40 + i, 12)} {' '.join(common.split()[i % 4 : 20 + i % 3])} {prose(60 + i, 9)}"
        streams[i] = [first, "Share this now", prose(80 + i, 20), *([prose(95, 25)] if i < 2 else [])]
    rows = [(i, f"http://a.example.org/{i}", "".join(f"<p>{b}</p>" for b in found), "x") for i, found in streams.items()]
    rows += [(99, "http://b.example.org/", f"<p>{common}</p>", "x"), (98, None, None, "x"), (97, "", "", "x"), (0, rows[0][1], rows[0][2], "y"), (96, "http://a.example.org/m", PAGE, "z")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, names string")
    got = pages.extract(table).collect()
    want = brute_covered(streams, 8, 3)
    assert len(got) == len(rows)
    for r in got:
        if r["page_id"] in want:
            assert r["text"] == want[r["page_id"]]
    text = {r["page_id"]: r["text"] for r in got}
    assert text[99] == common and text[98] == text[97] == "" and text[96].startswith("Head & line\n\n")
    assert pages.extract(table.limit(0)).count() == 0


def test_every_page_shows_what_its_host_repeats(spark):
    """Zones of pages with an article tell the boilerplate of pages without one; articles stay whole; teasers are not all."""
    note, story, quoted = prose(11, 15), prose(12, 30), prose(13, 25)
    rows = [(i, f"http://h.example/{i}", f"<nav>Go {i}</nav><article><p>{quoted}</p><p>{prose(200 + i, 9)}</p></article><footer>{note}</footer>") for i in range(3)]
    rows.append((3, "http://h.example/3", f"<p>{note}</p><p>{story} {' '.join(note.split()[2:14])}</p>"))
    rows.append((4, "http://h.example/4", f'<article class="teaser">Teaser</article><div id="story"><p>{story}</p></div><p>{note}</p>'))
    rows.append((5, "http://other.example/5", f"<p>{note}</p>"))
    rows.append((6, "http://h.example/6", f'<main><div class="search-results"><p>{quoted}</p></div></main><div>Posted</div>'))
    rows.append((7, "http://h.example/7", f"<article><p>{note}</p></article>"))
    table = spark.createDataFrame([(*r, "x") for r in rows] + [(None, None, None, None), (0, *rows[0][1:], "x")], "page_id long, url string, html string, host string")
    got = defaultdict(list)
    for r in pages.extract(table).collect():
        got[r["page_id"]].append(r["text"])
    assert [got[i] for i in range(3)] == [[f"{quoted}\n\n{prose(200 + i, 9)}"] * (2 if i == 0 else 1) for i in range(3)]
    assert got[3] == [story] and got[4] == [f"Teaser\n\n{story}"] and got[5] == got[7] == [note] and got[6] == [quoted] and got[None] == [""]
    assert pages.streams('<nav><p>a<script>x="</nav>"</script></p>b</nav>c')[-1] == ("c", "open")


def test_articles_are_weighed_by_what_their_host_repeats(spark, monkeypatch):
    """All pages go through the names of their host: a notice marked up as an article does not hide the open story."""
    seen = []
    lookup = pages.bit_map
    monkeypatch.setattr(pages, "bit_map", lambda grams: seen.append(grams.count()) or lookup(grams))
    note, story, other = prose(21, 40), prose(22, 25), prose(23, 60)
    rows = [(i, f"http://n.example/{i}", f"<article><p>{prose(300 + i, 12)}</p></article><footer>{note}</footer>") for i in range(3)]
    rows.append((3, "http://n.example/3", f"<article><p>{note}</p></article><div><p>{story}</p></div>"))
    rows.append((4, "http://n.example/4", f"<article><p>{other} {note}</p></article><div><p>{story}</p></div>"))
    rows.append((5, "http://m.example/5", f"<article><p>{note}</p></article><div><p>{story}</p></div>"))
    only = spark.createDataFrame(rows[:3], "page_id long, url string, html string")
    assert {r["text"] for r in pages.extract(only).collect()} == {prose(300 + i, 12) for i in range(3)} and seen == [34]
    got = {r["page_id"]: r["text"] for r in pages.extract(spark.createDataFrame(rows, only.schema)).collect()}
    assert got[3] == f"{note}\n\n{story}" and got[4] == f"{other} {note}" and got[5] == note


def test_pages_with_repeated_runs_are_not_looked_up_again(spark):
    """The last plan looks up only pages without hits; those with hits are read as they were written."""
    note, story = prose(24, 40), prose(25, 25)
    rows = [(i, f"http://k.example/{i}", f"<article><p>{prose(400 + i, 12)}</p></article><footer>{note}</footer>") for i in range(3)]
    rows.append((3, "http://k.example/3", f"<article><p>{note}</p></article><div><p>{story}</p></div>"))
    found = pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("look_up(") == 1
    assert {r["page_id"]: r["text"] for r in found.collect()} == {i: prose(400 + i, 12) for i in range(3)} | {3: f"{note}\n\n{story}"}


# Licenses -------------------------------------------------------------------------


def test_licenses(spark):
    mit, apache = dict(licenses.TEMPLATES[:1])["MIT"], licenses.TEMPLATES[3][1]
    edited = mit.replace("free of charge", "at no cost").replace("Software", "Program", 3)
    texts = [
        *SHORT,
        f"{prose(1, 300)} {mit} {prose(2, 300)}",
        f"{mit}\n{mit}",
        edited,
        f"{prose(3, 50)}. Released under the MIT License.\n{apache}",
        "This work is licensed under the GNU General Public License, version 3.",
        "the software and the license of the notice are in the copy",
        prose(4, 4000) + " Licensed under CC BY-NC 4.0.",
    ]
    docs = documents(spark, texts, extra=CLASHING)
    rows = licenses.scan(docs).collect()
    n = len(SHORT)
    found = Counter((r["doc_id"], r["license"]) for r in rows if r["doc_id"] is None or r["doc_id"] >= n)
    assert {k[0] for k in found} <= {None, *range(n, len(texts))} and not any(r["doc_id"] is not None and r["doc_id"] < n for r in rows)
    by_place = {i: Counter() for i in range(n, len(texts))}
    scanner = licenses.Scanner(licenses.TEMPLATES, licenses.Scan())
    for i in by_place:
        by_place[i].update(f[0] for f in scanner.find(texts[i]))
    assert [dict(by_place[i]) for i in by_place] == [{"MIT": 1}, {"MIT": 2}, {"MIT": 1}, {"MIT": 1, "Apache-2.0": 1}, {"GPL-3.0": 1}, {}, {"CC-BY-NC-4.0": 1}]
    assert licenses.scan(docs.limit(0)).count() == 0 and licenses.scan(docs, ()).count() == 0


def test_edited_licenses():
    """Words put in, short notices with a word changed, and notices without any one cue are found; others are not."""
    scanner = licenses.Scanner(licenses.TEMPLATES, licenses.Scan())
    found = lambda text: [f[0] for f in scanner.find(text)]
    mit = licenses.TEMPLATES[0][1]
    words = mit.split()
    for extra in (100, 140, 400, 3000):
        wide = " ".join([*words[:80], prose(extra, extra), *words[80:]])
        assert found(wide) == ["MIT"]
        assert found(f"{wide} {prose(7, 500)} {wide}") == ["MIT", "MIT"]
    assert found(f"{' '.join(words[:80])} Released under the BSD License. {prose(6, 900)} {' '.join(words[80:])}") == ["BSD", "MIT"]
    for text, name in (
        ("Released under an MIT License.", "MIT"), ("Distributed under the MIT License.", "MIT"), ("Code licensed under the BSD License", "BSD"),
        ("This is licensed under a GNU General Public License, version 3", "GPL-3.0"), ("Licensed under an Apache License, version 2.0", "Apache-2.0"),
    ):
        assert found(f"{prose(8, 90)} {text} {prose(9, 90)}") == [name]
    for text in ("Released under the Foo License.", "Licensed under the Apache License, Version 1.1.", "mit der Lizenz under the", "This work is licensed under a license.", "MIT"):
        assert found(text) == []
    for name, template in licenses.TEMPLATES:
        own = licenses.WORDS.findall(template.lower())
        if len(own) >= licenses.Scan().short:
            cues = scanner.cues[licenses.TEMPLATES.index((name, template))]
            assert sum(w not in cues for w in own) < licenses.Scan().least * len(own)


def brute_rise(pairs):
    """The length of the longest run that rises in both, by all earlier ends."""
    best = []
    for k, (_, j) in enumerate(pairs):
        best.append(1 + max((best[m] for m in range(k) if pairs[m][1] < j), default=0))
    return max(best, default=0)


def test_anchors_are_the_longest_rise():
    draw = random.Random(5)
    for _ in range(200):
        a, b = (draw.sample("abcdefghijklmnop", draw.randrange(14)) + ["x", "x"][: draw.randrange(3)] for _ in range(2))
        once = [(i, b.index(w)) for i, w in enumerate(a) if a.count(w) == 1 == b.count(w)]
        anchors = licenses.unique_anchors(a, b)
        assert set(anchors) <= set(once) and len(anchors) == brute_rise(once) == brute_rise(anchors)


def test_patience_is_an_alignment():
    draw = random.Random(2)
    for _ in range(100):
        a, b = ([draw.choice("abcdefghij") for _ in range(draw.randrange(15))] for _ in range(2))
        pairs = licenses.patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))


# The pipeline ---------------------------------------------------------------------


def test_pipeline_against_its_parts(spark, vocabulary):
    folder = "/root/testdata/sf0.001"
    rows = corpus_pipeline.run(spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {r["doc_id"]: r["text"] for r in quality.clean(docs).collect()}
    unique = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, quality.clean(docs), folder).collect()}
    roots = brute_components({brute_print(t) for t in kept.values()})
    first = {}
    for i in sorted(kept):
        first.setdefault(roots[brute_print(kept[i])], i)
    assert unique == set(first.values()) and len(unique) < len(kept)
    items = [r["text"] for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    ids = {r["doc_id"] for r in rows}
    assert ids <= unique and len(ids) == len(rows)
    for i in unique - ids:
        words = leaks.WORDS.findall(kept[i].lower())
        assert any(leaks.align(leaks.WORDS.findall(t.lower()), words)[0] >= 0.5 * len(t.split()) for t in items)
    decoded = pieces.decode(spark.createDataFrame([(r["doc_id"], r["ids"]) for r in rows], "doc_id long, ids array<int>"), vocabulary)
    changed = [r["doc_id"] for r in decoded.collect() if r["decoded"] != kept[r["doc_id"]]]
    assert len(changed) < 0.2 * len(rows) and all(any(c in kept[i] for c in "@+0123456789") for i in changed)


def test_stages_stand_odd_tables(spark):
    """Nulls, empty and long texts, ties, repeated rows and clashing names, through all five in turn."""
    folder = "/root/testdata/sf0.001"
    sentence = "A proper sentence stands here, it is long enough to stay and ends as it should."
    texts = [*EDGES, *[sentence] * 3, " ".join(f"{sentence[:-1]}, number {i}." for i in range(4000)), prose(1, 300), prose(2, 300)]
    docs = documents(spark, texts, extra=(*CLASHING, "a.b"))
    docs = docs.union(docs)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        rows = out.collect()
        assert rows
        if name != "encoding":
            assert out.columns == docs.columns
            docs = spark.createDataFrame(rows, out.schema)
    assert set(out.columns) == {"doc_id", "ids", "n_ids"}


def test_stages_stand_an_empty_table(spark):
    docs = documents(spark, EDGES[:8]).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "/root/testdata/sf0.001").count() == 0
