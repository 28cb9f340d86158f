"""The registered queries of the text operators and the SQL twins of those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tidewatch.llm import leaks, licenses, packing, pages, pieces, privacy, quality, runs, sharding, simhash, toxicity, urls, whitening
from tidewatch.llm.common import SPACE, bind, literal, table, text_settings
from tidewatch.llm.oracles import ORACLES
from tidewatch.settings import configure

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


#: Vocabulary file of the packed sequences.
TOKENS = "/opt/tokenizers/byte_bpe_50k.json"


def _repeating() -> str:
    """The text; for a tenth of the ids, its n words with those from place a on repeating with period p."""
    word = "IF(i < s.a, w[i], w[s.a + (i - s.a) % p])"
    joined = bind("CAST(1 + (s.n - s.a) DIV (3 + s.g % 8) AS INT)", "p", f"array_join(transform(sequence(0, s.n - 1), i -> {word}), ' ')")
    shaped = bind("struct(CAST(g % size(w) AS INT) AS a, g, size(w) AS n)", "s", joined)
    planted = bind(f"filter(split(coalesce(text, ''), {literal(SPACE + '+')}), w -> w <> '')", "w", f"IF(size(w) = 0, '', {shaped})")
    return bind("crc32(CAST(CAST(doc_id AS STRING) AS BINARY))", "h", f"IF(h % 10 = 0, {bind('h DIV 10', 'g', planted)}, text)")


REPEATING = _repeating()


def query(build: Query) -> Query:
    _QUERIES[build.__name__] = lambda spark, folder: build(text_settings(configure(spark)), folder)
    return build


@query
def op1_patience(spark: SparkSession, folder: str) -> DataFrame:
    """License notices found in documents: one row for each notice."""
    return licenses.scan(table(spark, folder, "documents"))


@query
def op2_disclosure(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every document: counts, the digest of the base spans, and all spans."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return privacy.digest(privacy.find(docs))


@query
def op3_hash_tree(spark: SparkSession, folder: str) -> DataFrame:
    """40 shards in 4 regions of 2 racks; the grown tree has a 41st in a region of its own."""
    tree = sharding.even_tree(regions=4, racks=2, shards=5)
    placed = sharding.shard_documents(table(spark, folder, "documents"), tree, tree.grown(40))
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query
def op4_line_rules(spark: SparkSession, folder: str) -> DataFrame:
    measured = quality.measure(table(spark, folder, "documents").select("doc_id", "text"))
    return measured.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op5_deobfuscation(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op6_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(
        [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")],
        "host string, path string, verdict string",
    )
    return urls.judge(table(spark, folder, "pages"), rules)


@query
def op7_gray_index(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.expr("lpad(lower(hex(fp)), 16, '0') AS fingerprint"), "component_id")


@query
def op8_host_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    found = pages.extract(table(spark, folder, "pages"))
    return found.select("page_id", "url", "text", F.expr("CAST(length(text) AS BIGINT) AS n_chars"))


@query
def op9_seed_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Leaked benchmark items: the best alignment of each pair of a document and an item."""
    found = leaks.find(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    best = F.expr("max(struct(round(score, 4) AS score, -start AS start, end)) AS best")
    return found.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "best.score", F.expr("-best.start AS start"), F.expr("best.end AS end")
    )


@query
def op10_max_plus(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document, and whether decoding them gives the text back."""
    vocabulary = pieces.Vocabulary.load(corpus_pipeline.MODEL)
    back = pieces.decode(pieces.encode(table(spark, folder, "documents"), vocabulary), vocabulary)
    return back.select("doc_id", "ids", F.expr("CAST(size(ids) AS BIGINT) AS n_ids"), F.expr("decoded = coalesce(text, '') AS same"))


@query
def op11_suffix_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of every document; in a tenth of them, told by the id, the words from a place on repeat with a period."""
    docs = table(spark, folder, "documents")
    return runs.digest(runs.find(docs.select("doc_id", F.expr(REPEATING).alias("text"))))


@query
def op12_pattern_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of all documents in sequences of 2,048 tokens."""
    found = packing.pieces(table(spark, folder, "documents"), packing.Tokens.load(TOKENS), capacity=2048)
    return packing.pack(found.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), packing.Packing(capacity=2048))


@query
def op13_refined_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """32 whitened components of every embedding, one row each."""
    rows = table(spark, folder, "embeddings")
    found = whitening.fit(rows, "embedding", most=32)
    if found is None:
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    wide = whitening.whiten(rows, found, "embedding").select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    shares = F.array(*(F.lit(float(x)) for x in found.explained)).cast("array<double>")
    return wide.select(
        "vec_id",
        F.expr("at + 1 AS component"),
        F.lit(found.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(found.error).alias("identity_error"),
    )


@query
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    return dict(ORACLES)
