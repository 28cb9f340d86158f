"""Personal data, shards, line rules and URL rules against plain Python."""

from __future__ import annotations

import hashlib
import math
import re
import struct
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.cases import CLASHING, EDGES, documents
from tidewatch.llm import privacy, quality, sharding, urls

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base(text):
    found = {}
    for kind, pattern in PATTERNS.items():
        spans = []
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x.lstrip("0")[:9] or 0) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            spans.append(f"{kind}:{m.start()}:{m.end()}")
        found[kind] = spans
    return found


def check_base(rows):
    for text, row in rows:
        want = base(text)
        listed = ",".join(x for spans in want.values() for x in spans)
        assert {k: row[f"n_{k}"] for k in want} == {k: len(v) for k, v in want.items()}, text[:80]
        assert row["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert row["spans"] == listed or row["spans"].startswith(listed + "," if listed else "term:")


SHORT_EDGES = [x for x in EDGES if x is None or len(x) < 35000]


def test_base_spans_match_the_patterns(spark):
    docs = documents(spark, SHORT_EDGES)
    rows = privacy.find(docs.select("doc_id", "text", F.col("text").alias("copy"))).transform(
        lambda f: privacy.digest(f).withColumn("n", F.lit(1))
    )
    got = rows.collect()
    assert len(got) == len(SHORT_EDGES)
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    check_base([(t, by_id[i]) for i, t in enumerate(SHORT_EDGES) if i in by_id])


def test_a_long_run_is_found_once(spark):
    text = "x." * 20000 + "@" + "a." * 20000
    row = privacy.digest(privacy.find(documents(spark, [text]))).first()
    assert row["spans"] == f"email:0:{40001 + 39999}"


def test_terms_that_give_an_entity_away(spark):
    texts = [f"Filler number {'abcdefghij'[i % 10] * 5} about weather and harvest in general." for i in range(60)]
    texts += [f"Write to Zorblax at z@corp.example for {w} today." for w in ("parcels", "letters", "answers")]
    docs = documents(spark, texts, extra=CLASHING)
    got = {r["doc_id"]: r["spans"] for r in privacy.digest(privacy.find(docs.select("doc_id", "text"))).collect()}
    assert all(got[i] == "" for i in range(60))
    assert all("term:9:16" in got[i] and got[i].startswith("email:20:34") for i in (60, 61, 62))
    clean = privacy.sanitise(docs)
    assert clean.columns == docs.columns
    new = {r["doc_id"]: r for r in clean.collect()}
    assert "Zorblax" not in new[61]["text"] and "[EMAIL]" in new[61]["text"] and new[61]["n_chars"] == len(new[61]["text"])
    assert new[5]["text"] == texts[5]


def test_sanitise_keeps_rows_and_nulls(spark):
    docs = documents(spark, SHORT_EDGES, extra=CLASHING)
    new = privacy.sanitise(docs).collect()
    assert len(new) == len(SHORT_EDGES) and sum(r["text"] is None for r in new) == 2
    assert privacy.sanitise(docs.limit(0)).count() == 0


def hashed(key, *names):
    seed = xxhash.xxh64(struct.pack("<q", key), 42).intdigest() if key is not None else 42
    for name in names:
        seed = xxhash.xxh64(name.encode(), seed).intdigest()
    return seed


def descend(key, tree):
    node, below = "", tree.children()
    for _ in range(3):
        node = min((-math.log(((hashed(key, c) >> 11) + 0.5) / 2**53) / w, c) for c, w in below[node].items())[1]
    return int(node.rsplit("/", 1)[1])


def test_shards_follow_the_tree(spark):
    tree = sharding.even_tree(4, 2, 5)
    docs = documents(spark, [*EDGES, *(f"t {i}" for i in range(600))], extra=CLASHING).union(documents(spark, ["one"] * 3, 4, CLASHING))
    rows = sharding.shard_documents(docs, tree, tree.grown(40)).collect()
    assert len(rows) == docs.count()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in rows:
        assert r["shard"] == descend(r["doc_id"], tree) and r["grown_shard"] == descend(r["doc_id"], tree.grown(40))
        assert r["grown_shard"] in (r["shard"], 40)
        if r["doc_id"] is not None and r["doc_id"] not in (4, 5, 6):
            raw = (texts[r["doc_id"]] or "").encode()
            assert (r["size"], r["text_crc32"]) == (len(raw) + 16, zlib.crc32(raw))
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert sharding.shard_documents(docs.limit(0), tree).count() == 0


def test_a_weight_moves_rows_only_below_changed_parents(spark):
    tree = sharding.even_tree(3, 2, 2)
    heavier = sharding.Tree(tuple(sharding.Leaf(x.region, x.rack, x.shard, 3.0 if x.shard == 0 else 1.0) for x in tree.leaves))
    both = spark.range(4000).withColumns({"a": sharding.shard_of("id", tree), "b": sharding.shard_of("id", heavier)}).collect()
    moved = [(r["a"], r["b"]) for r in both if r["a"] != r["b"]]
    assert moved and all(b < 4 for _, b in moved)
    with pytest.raises(ValueError):
        sharding.Tree(())


def brute_quality(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = defaultdict(list)
    for i in range(len(words) - 4):
        windows[tuple(words[i : i + 5])].append(i)
    covered = {i + k for places in windows.values() if len(places) > 1 for i in places for k in range(5)}
    lines = Counter(x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x))
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), sum(n - 1 for n in lines.values()), len(covered), failed)


def test_line_rules(spark):
    docs = documents(spark, EDGES, extra=CLASHING)
    rows = quality.measure(docs).collect()
    got = Counter((r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in rows)
    assert got == Counter(map(brute_quality, EDGES))
    assert not any(r["kept"] for r in rows if r["base_failed"])
    mixed = next(r for r in rows if r["text"] and r["text"].startswith("the same"))
    assert mixed["kept_text"] == "A proper sentence stands here, and it is long enough."
    kept = quality.clean(docs)
    assert kept.columns == docs.columns and quality.clean(docs.limit(0)).count() == 0
    assert {r["key"] for r in kept.collect()} == {"x"}


def test_line_rules_on_the_test_data(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for r in quality.measure(docs).collect():
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == brute_quality(r["text"])
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    both = quality.measure(docs).join(labels, "doc_id").where("n_words >= 10").groupBy("quality").agg(F.avg(F.col("kept").cast("double")).alias("kept"))
    share = {r["quality"]: r["kept"] for r in both.collect()}
    assert share[1] > 0.97 and share[0] < 0.2


URLS = [
    None, "", "no scheme/x", "http://EXAMPLE.net/en/1?x#y", "https://a.example.net/fr/", "http://notexample.net", "http://x.org/fr/a",
    "http://example.com/de/", "http://example.com/de", "http://a.b.example.com/de/x://q", "http://net/", "://org/fr/?", "http://x.net#a/en/", "http://x.org/fr/a",
]
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def brute_url(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, "allow"))
    return host, path, best[1], best[2]


def test_url_rules(spark):
    pages = spark.createDataFrame([(i // 2, u, "x") for i, u in enumerate(URLS)], "page_id long, url string, row string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = Counter((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge(pages, rules).collect())
    assert got == Counter((i // 2, *brute_url(u)) for i, u in enumerate(URLS))
    assert urls.judge(pages.limit(0), rules).count() == 0
    assert all(r["rule"] is None for r in urls.judge(pages, rules.limit(0)).collect())
