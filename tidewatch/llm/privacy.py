"""Personal data: pattern spans, and terms that give the protected entities away.

An entity is a normalised e-mail address, IP address, card or phone number. How much a term reveals of
an entity is their pointwise mutual information as a share of the entity's own information:
`ln(p(t, e) / (p(t) p(e))) / -ln p(e)`, with document frequencies over the whole corpus; `p(t, e)` counts
documents with the term close to the entity. A term at or above `remove_at` is removed, one at or above
`generalise_at` is replaced by a general word. Everything is DataFrame operations.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import bind, literal
from tidewatch.settings import cut_lineage

_DIGITS = "regexp_replace(x.t, '[^0-9]', '')"
_LUHN = (
    "aggregate(sequence(1, length({d})), 0, (a, i) -> a + "
    "transform(array(CAST(substr({d}, length({d}) - i + 1, 1) AS INT)), c -> CASE WHEN i % 2 = 1 THEN c WHEN c > 4 THEN 2 * c - 9 ELSE 2 * c END)[0]) % 10 = 0"
)
#: Kind: (a character every match has, pattern, test of match x.t, normal form). The patterns equal the plain
#: ones (a run starts where nothing of its class precedes, or where the last match ended) without backtracking.
KINDS = {
    "email": (
        "text LIKE '%@%'",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "true",
        "lower(x.t)",
    ),
    "ip": (
        "text LIKE '%.%'",
        r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        "forall(split(x.t, '[.]'), q -> length(ltrim('0', q)) <= 3 AND coalesce(try_cast(ltrim('0', q) AS INT), 0) <= 255)",
        "x.t",
    ),
    "card": (
        "true",
        r"(?:\G|(?<![0-9]))[0-9](?:[ -]?+[0-9])++",
        bind(_DIGITS, "d", f"CASE WHEN length(d) BETWEEN 13 AND 19 THEN {_LUHN.format(d='d')} ELSE false END"),
        _DIGITS,
    ),
    "phone": (
        "text LIKE '%+%'",
        r"\+[0-9][ ().0-9-]+[0-9]",
        f"length({_DIGITS}) BETWEEN 9 AND 15",
        _DIGITS,
    ),
}
_SPAN = "ARRAY<STRUCT<s: INT, e: INT, t: STRING>>"
_TERM = r"\p{L}{4,}"


@dataclass(frozen=True)
class Disclosure:
    """Thresholds. `reach` is in characters on either side of an entity; `support` counts different texts."""

    reach: int = 64
    support: int = 2
    generalise_at: float = 0.7
    remove_at: float = 0.9


def _found(text: str, pattern: str, shift: str = "0") -> str:
    """Spans of the matches in `text`: what lies between matches and the matches themselves give the offsets."""
    step = "named_struct('n', a.n + length(g[i]) + length(m[i]), 'o', array_append(a.o, named_struct('s', a.n + length(g[i]), 'e', a.n + length(g[i]) + length(m[i]), 't', m[i])))"
    spans = f"aggregate(sequence(0, size(m) - 1), named_struct('n', {shift}, 'o', CAST(array() AS {_SPAN})), (a, i) -> {step}, a -> a.o)"
    pieces = bind(f"split({text}, {literal(pattern)})", "g", spans)
    return bind(f"regexp_extract_all({text}, {literal(pattern)}, 0)", "m", f"CASE WHEN size(m) > 0 THEN {pieces} ELSE CAST(array() AS {_SPAN}) END")


def base_spans(docs: DataFrame) -> DataFrame:
    """Add one array of (s, e, t) for each kind: start, end (code points, exclusive) and the matched text.

    Matches are leftmost and do not overlap within a kind; a match that fails its kind's test is dropped
    without another try. A null text has none.
    """
    return docs.withColumns(
        {
            kind: F.expr(f"CASE WHEN {likely} AND text RLIKE '[0-9@]' THEN filter({_found('text', pattern)}, x -> {test}) ELSE CAST(array() AS {_SPAN}) END")
            for kind, (likely, pattern, test, _) in KINDS.items()
        }
    )


def _contexts(reach: int) -> str:
    """Terms near each entity: (entity hash, lower-case term, s, e), cut at the reach, outside all base spans."""
    entities = ", ".join(f"transform({kind}, x -> named_struct('h', xxhash64('{kind}', {form}), 's', x.s, 'e', x.e))" for kind, (_, _, _, form) in KINDS.items())
    left = _found("substr(text, greatest(x.s - {r}, 0) + 1, least(x.s, {r}))".format(r=reach), _TERM, f"greatest(x.s - {reach}, 0)")
    right = _found(f"substr(text, x.e + 1, {reach})", _TERM, "x.e")
    whole = f"(t.s = 0 OR t.s > x.s - {reach}) AND (t.e = length(text) OR t.e < x.e + {reach})"
    near = f"transform(filter(concat({left}, {right}), t -> {whole}), t -> named_struct('h', x.h, 't', lower(t.t), 's', t.s, 'e', t.e))"
    spans = f"concat({', '.join(KINDS)})"
    outside = f"NOT exists({spans}, b -> b.s < t.e AND t.s < b.e)"
    return f"array_distinct(filter(flatten(transform(concat({entities}), x -> {near})), t -> {outside}))"


def find(docs: DataFrame, settings: Disclosure = Disclosure()) -> DataFrame:
    """Per document: its columns without the text, `key`, the base spans by kind and `terms`, the added spans.

    `key` is a digest of the text; `terms` has (s, e, act) with act `remove` or `general`, by start. The
    scan of the texts is checkpointed without them. Copies of a text share their spans, and count as so
    many documents but as one text for `support`. Terms of entities found in fewer than `support` texts,
    empty texts and nulls get none; repeated rows stay.
    """
    scanned = cut_lineage(
        base_spans(docs)
        .withColumn("key", F.expr("unhex(md5(coalesce(text, '')))"))
        .withColumn("near", F.expr(f"CASE WHEN size({') + size('.join(KINDS)}) > 0 THEN {_contexts(settings.reach)} ELSE array() END"))
        .drop("text")
    )
    terms = _terms(docs, scanned, settings)
    return scanned.drop("near").join(terms, "key", "left").withColumn("terms", F.expr("coalesce(terms, array())"))


def _terms(docs: DataFrame, scanned: DataFrame, settings: Disclosure) -> DataFrame:
    """key and the array of its term spans.

    Counting goes in two steps, first per text and then over texts, so copies are combined before the
    shuffle. Document frequencies of terms are counted per task before they meet the few terms in question.
    """
    n = scanned.count()
    near = scanned.select("key", F.explode("near").alias("c")).select("key", "c.*")
    entities = ", ".join(f"transform({kind}, x -> xxhash64('{kind}', {form}))" for kind, (_, _, _, form) in KINDS.items())
    entity_docs = scanned.select(F.explode(F.expr(f"array_distinct(concat({entities}))")).alias("h")).groupBy("h").agg(F.count("*").alias("ce"))
    joint = (
        scanned.select("key", F.explode(F.expr("array_distinct(transform(near, c -> struct(c.h AS h, c.t AS t)))")).alias("c"))
        .groupBy("key", "c.h", "c.t")
        .agg(F.count("*").alias("copies"))
        .groupBy("h", "t")
        .agg(F.sum("copies").alias("j"), F.count("*").alias("texts"))
        .where(F.col("texts") >= settings.support)
    )
    joint = cut_lineage(joint)
    words = F.expr(r"array_distinct(filter(split(lower(text), '[^\\p{L}]+'), w -> length(w) >= 4))")
    term_docs = docs.select(F.explode(words).alias("t")).groupBy("t").agg(F.count("*").alias("ct")).join(joint.select("t").distinct(), "t")
    share = f"CASE WHEN ce < {n} THEN ln({n}D * j / (CAST(ct AS DOUBLE) * ce)) / ln({n}D / ce) ELSE 0D END"
    acts = (
        joint.join(term_docs, "t")
        .join(entity_docs, "h")
        .withColumn("share", F.expr(share))
        .where(F.col("share") >= settings.generalise_at)
        .select("h", "t", F.expr(f"CASE WHEN share >= {settings.remove_at} THEN 'remove' ELSE 'general' END AS act"))
    )
    return (
        near.join(acts, ["h", "t"])
        .groupBy("key", "s", "e")
        .agg(F.max("act").alias("act"))
        .groupBy("key")
        .agg(F.expr("sort_array(collect_list(struct(s, e, act)))").alias("terms"))
    )


def sanitise(docs: DataFrame, settings: Disclosure = Disclosure()) -> DataFrame:
    """The documents with every base span replaced by its kind in brackets, removed terms left out and
    general terms replaced by `[TERM]`; n_chars follows. Of overlapping spans the one that starts first,
    then the longer one, counts. All rows stay; a null text stays null; other columns are unchanged.
    """
    found = find(docs.select("text"), settings)
    labelled = ", ".join(f"transform({kind}, x -> struct(x.s AS s, -x.e AS e, '[{kind.upper()}]' AS w))" for kind in KINDS)
    spans = f"sort_array(concat({labelled}, transform(terms, x -> struct(x.s AS s, -x.e AS e, CASE x.act WHEN 'remove' THEN '' ELSE '[TERM]' END AS w))))"
    plans = found.groupBy("key").agg(F.expr(f"first({spans}) AS _spans")).where("size(_spans) > 0")
    step = (
        "CASE WHEN x.s < a.n THEN a ELSE named_struct('n', -x.e, "
        "'o', concat(a.o, substr(text, a.n + 1, x.s - a.n), x.w)) END"
    )
    new = f"aggregate(_spans, named_struct('n', 0, 'o', ''), (a, x) -> {step}, a -> concat(a.o, substr(text, a.n + 1)))"
    packed = docs.select(F.struct("*").alias("_row"), "text", F.expr("unhex(md5(coalesce(text, ''))) AS key")).join(plans, "key", "left")
    packed = packed.withColumn("text", F.expr(f"CASE WHEN _spans IS NULL THEN text ELSE {new} END"))
    replaced = {"text": F.col("text"), "n_chars": F.expr("CAST(length(text) AS BIGINT)")}
    return packed.select(*(replaced.get(name, F.col("_row")[name]).alias(name) for name in docs.columns))


def digest(found: DataFrame) -> DataFrame:
    """The result of `find` as counts and joined span lists: kind:start:end, base kinds in order, then terms."""
    listed = lambda kind, spans: f"transform({spans}, x -> concat('{kind}:', x.s, ':', x.e))"
    base = f"concat({', '.join(listed(kind, kind) for kind in KINDS)})"
    return found.select(
        "doc_id",
        *(F.expr(f"CAST(size({kind}) AS BIGINT)").alias(f"n_{kind}") for kind in KINDS),
        F.expr(f"sha2(array_join({base}, ','), 256)").alias("base_sha256"),
        F.expr(f"array_join(concat({base}, {listed('term', 'terms')}), ',')").alias("spans"),
    )
