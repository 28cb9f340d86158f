"""Promotion of observations to operational orders, decided for a whole batch at once.

Without a way to order versions, one identity has at most one observation that can create its
order, so every decision is a join. With a declared rank, the revisions accepted in sequence order
are the running maxima of that rank. An arbitrary comparator goes once over each identity's rows in
sequence order, with the current version as its only state.

An order number belongs to one order at a time, and a revision may give it up. Identities that claim
or hold a number in common depend on each other; each connected set of them is gone over once in
sequence order, with the owners of its numbers as further state. All others need no such pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.text import id_key, key_id
from tidewatch.operators.connected import connected
from tidewatch.settings import parked, released

IDENTITY = ("source_namespace", "source_order_id")
#: Fields an order takes from its observation.
PROJECTED = (
    "order_number", "order_status", "region", "source_warehouse_id", "ordered_at", "promised_at",
    "fulfilled_at", "total_amount", "currency",
)
ORDER_COLUMNS = (*IDENTITY, *PROJECTED, "projected_version", "current_observation")
OUTCOMES = ("CURRENT_NEWER", "INCOMING_NEWER", "SAME", "UNORDERED")
#: Sequence numbers per bucket of a running maximum; sequences are unique, so buckets stay small.
BUCKET = 100_000

Comparator = Callable[[str | None, str | None], object]


@dataclass(frozen=True)
class Promotion:
    observations: DataFrame
    orders: DataFrame


def version_outcome(comparator: Comparator) -> Callable[[str | None, str | None], str]:
    """Outcome of a user comparator as a function that travels to the workers by itself: true or
    false mean newer or older, anything that is no outcome means unordered."""
    outcomes = frozenset(OUTCOMES)

    def compare(current: str | None, incoming: str | None) -> str:
        try:
            outcome = comparator(current, incoming)
        except Exception:  # noqa: BLE001 - a failing comparator proves nothing
            return "UNORDERED"
        if isinstance(outcome, bool):
            return "INCOMING_NEWER" if outcome else "CURRENT_NEWER"
        name = str(getattr(outcome, "value", outcome))
        return name if name in outcomes else "UNORDERED"

    return compare


def running_max(rows: DataFrame, keys: tuple[str, ...], order: str, value: str, bucket: int = BUCKET) -> DataFrame:
    """Add `before`: the maximum of `value` over earlier rows of the same keys.

    Two levels, so a key with very many rows is spread over its buckets: maxima per bucket, their
    running maximum over the buckets, and a window inside each bucket.
    """
    bucketed = rows.withColumn("bucket", F.expr(f"{order} div {bucket}"))
    tops = bucketed.groupBy(*keys, "bucket").agg(F.expr(f"max({value}) AS top"))
    earlier = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = tops.withColumn("carried", F.max("top").over(earlier)).drop("top")
    inside = Window.partitionBy(*keys, "bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        bucketed.withColumn("inside", F.max(value).over(inside))
        .join(carried, [*keys, "bucket"])
        .withColumn("before", F.greatest("inside", "carried"))
        .drop("inside", "carried", "bucket")
    )


def next_in_sequence(rows: DataFrame, keys: tuple[str, ...], bucket: int = BUCKET) -> DataFrame:
    """Add `successor`: the observation that follows within the same keys, in two levels as well."""
    bucketed = rows.withColumn("bucket", F.expr(f"sequence div {bucket}"))
    heads = bucketed.groupBy(*keys, "bucket").agg(F.expr("min_by(observation_id, sequence) AS head"))
    following = Window.partitionBy(*keys).orderBy("bucket")
    heads = heads.withColumn("next_head", F.lead("head").over(following)).drop("head")
    inside = Window.partitionBy(*keys, "bucket").orderBy("sequence")
    return (
        bucketed.withColumn("inside", F.lead("observation_id").over(inside))
        .join(heads, [*keys, "bucket"])
        .withColumn("successor", F.coalesce("inside", "next_head"))
        .drop("inside", "next_head", "bucket")
    )


def _projection() -> str:
    """A digest of what an order takes from its observation, equal for equal content only."""
    texts = {name: f"CAST({name} AS STRING)" for name in PROJECTED}
    texts |= {name: f"CAST(unix_micros({name}) AS STRING)" for name in ("ordered_at", "promised_at", "fulfilled_at")}
    texts["total_amount"] = "CAST(CAST(total_amount AS DECIMAL(38,10)) AS STRING)"
    told = ", ".join(f"coalesce(concat(length({text}), ':', {text}), '-')" for text in texts.values())
    return f"unhex(sha2(concat({told}), 256))"


def _with_context(observations: DataFrame, warehouses: DataFrame, orders: DataFrame, *, ranked: bool) -> DataFrame:
    """What a decision looks at, with the key of the observation; its other columns stay where they are.

    Whether an identity has several versions is told only where versions are not `ranked`.
    """
    open_reasons = "array_except(reasons, array('MISSING_WAREHOUSE', 'UNKNOWN_WAREHOUSE'))"
    keyed = observations.selectExpr(
        f"{id_key('observation_id')} AS observation_id", "sequence", *IDENTITY, "order_number", "source_version", "source_warehouse_id",
        "CASE WHEN source_version IS NULL THEN 'none' ELSE concat('v', source_version) END AS version_key",
        "status IN ('PROMOTED', 'REJECTED_INVALID', 'CONFLICT_BLOCKED') AS settled",
        f"status <> 'NORMALIZED' AND size({open_reasons}) > 0 AS incomplete", f"{_projection()} AS projection",
    )
    contents = observations.selectExpr(
        *IDENTITY, "CASE WHEN source_version IS NULL THEN 'none' ELSE concat('v', source_version) END AS version_key",
        # Two numbers of different seeds, which an aggregation by hashing can hold.
        "xxhash64(source_row_hash) AS one", "xxhash64(1, source_row_hash) AS other",
    )
    per_version = contents.groupBy(*IDENTITY, "version_key").agg(*(F.expr(f"{side}({name}) AS {side}_{name}") for name in ("one", "other") for side in ("min", "max")))
    clashing = per_version.where("min_one <> max_one OR min_other <> max_other").selectExpr(*IDENTITY, "version_key", "true AS clashing")
    places = warehouses.selectExpr("source_warehouse_id", "true AS place_known")
    held = orders.selectExpr(*IDENTITY, "true AS has_order", f"{_projection()} AS held", "projected_version", "current_observation")
    placed = (
        keyed.join(places, "source_warehouse_id", "left")
        .selectExpr(
            "observation_id", "sequence", *IDENTITY, "order_number", "source_version", "version_key", "projection",
            f"{_PLACED} AS placed",
        )
        .join(held, list(IDENTITY), "left")
    )
    if not ranked:
        several = (
            per_version.groupBy(*IDENTITY)
            .agg(F.expr("min(version_key) AS low"), F.expr("max(version_key) AS high"))
            .where("low <> high")
            .selectExpr(*IDENTITY, "true AS several_versions")
        )
        placed = placed.join(several, list(IDENTITY), "left")
    return placed.join(clashing, [*IDENTITY, "version_key"], "left").selectExpr(
        "observation_id", "sequence", *IDENTITY, "order_number", "source_version", f"{_DECIDE} AS decision",
        "clashing AND placed <> 'KEEP' AS early", "coalesce(has_order, false) AS has_order", "held <=> projection AS fits",
        "projected_version", "current_observation", *([] if ranked else ["several_versions"]),
    )


#: The decision but for content that clashes inside one version.
_PLACED = """CASE
    WHEN settled THEN 'KEEP'
    WHEN place_known IS NULL AND source_warehouse_id IS NULL THEN 'MISSING_WAREHOUSE'
    WHEN place_known IS NULL THEN 'UNKNOWN_WAREHOUSE'
    WHEN incomplete THEN 'INCOMPLETE'
    ELSE 'COMPARE' END"""
_DECIDE = """CASE
    WHEN placed = 'KEEP' THEN 'KEEP'
    WHEN clashing AND source_version IS NULL THEN 'UNVERSIONED_CONTENT_CONFLICT'
    WHEN clashing THEN 'SOURCE_VERSION_CONTENT_CONFLICT'
    ELSE placed END"""
#: Of an observation in the version its order has: whether it says the same.
_SAME_VERSION = "CASE WHEN fits THEN 'ACCEPT' ELSE 'SOURCE_VERSION_CONTENT_CONFLICT' END"


def promote(
    observations: DataFrame,
    orders: DataFrame,
    warehouses: DataFrame,
    *,
    version_rank: str | None = None,
    comparator: Comparator | None = None,
) -> Promotion:
    """Promote observations in `sequence` order.

    `version_rank` is an SQL expression over `source_version` that orders revisions (null: cannot
    be ordered); `comparator(current, incoming)` is the general form. Without either, revisions
    are never ordered. Sequence numbers are unique and say only in which order rows are presented.

    An order number belongs to one order per namespace at a time: from the observation that takes it on to
    the revision that gives it up. An observation that claims a number while another order has it is
    refused, and counts as no revision.
    """
    ranked = comparator is not None or version_rank is not None
    decided = parked(_with_context(observations, warehouses, orders, ranked=ranked))
    open_cases = decided.where("decision = 'COMPARE'").drop("decision", "early", "current_observation")
    kept: list[DataFrame] = []
    if comparator is not None and version_rank is None:
        judged = _in_sequence(open_cases, orders, _by_comparator(comparator), kept)
    elif version_rank is not None:
        judged = _by_rank(open_cases, orders, version_rank, kept)
    else:
        judged = _unordered(open_cases, orders)
    judged = parked(judged.select("observation_id", "verdict"))
    released(*kept)
    rows = parked(
        decided.join(judged, "observation_id", "left").selectExpr(
            "observation_id", "sequence", *IDENTITY, "current_observation", "coalesce(verdict, decision) AS result", "early"
        )
    )
    released(decided, judged)
    return _apply(rows, observations, orders)


def _unordered(cases: DataFrame, orders: DataFrame) -> DataFrame:
    """Verdicts when versions cannot be ordered: an identity gets at most one order, and no order changes.

    So a number is its order's, or else goes to the first observation that makes an order of it.
    """
    judged = cases.select(
        "observation_id", "sequence", *IDENTITY, "order_number", "has_order",
        F.expr(
            f"CASE WHEN has_order AND projected_version <=> source_version THEN {_SAME_VERSION} "
            "WHEN has_order OR (source_version IS NOT NULL AND several_versions) "
            "THEN 'SOURCE_VERSION_ORDER_UNPROVEN' ELSE 'ACCEPT' END AS verdict"
        ),
    )
    claiming = "verdict = 'ACCEPT' AND NOT has_order"
    numbers = ["source_namespace", "order_number"]
    taken = orders.where("order_number IS NOT NULL").select(*numbers, F.col("source_order_id").alias("owner"), F.lit(-1).cast("long").alias("sequence"))
    claims = judged.where(claiming).select(*numbers, F.col("source_order_id").alias("owner"), "sequence")
    owners = taken.unionByName(claims).groupBy(*numbers).agg(F.expr("min_by(owner, sequence) AS owner"))
    refused = f"CASE WHEN {claiming} AND owner <> source_order_id THEN 'OPERATIONAL_ORDER_CONFLICT' ELSE verdict END"
    return judged.join(owners, numbers, "left").withColumn("verdict", F.expr(refused)).drop("owner")


_VERDICT_OF = {
    "INCOMING_NEWER": "ACCEPT",
    "CURRENT_NEWER": "STALE_SOURCE_VERSION",
    "SAME": "SOURCE_VERSION_ORDER_UNPROVEN",
    "UNORDERED": "SOURCE_VERSION_ORDER_UNPROVEN",
}


#: Outcome of comparing two (version, rank) pairs: the current one and the incoming one.
Compare = Callable[[tuple, tuple], str]


def _by_comparator(comparator: Comparator) -> Compare:
    compare = version_outcome(comparator)
    return lambda current, incoming: compare(current[0], incoming[0])


def _of_ranks(current: tuple, incoming: tuple) -> str:
    if current[1] is None or incoming[1] is None or current[1] == incoming[1]:
        return "UNORDERED"
    return "INCOMING_NEWER" if incoming[1] > current[1] else "CURRENT_NEWER"


def _by_rank(cases: DataFrame, orders: DataFrame, version_rank: str, kept: list[DataFrame]) -> DataFrame:
    """Accept the first observation of an identity without an order, and each one ranked above
    everything before it. Nothing follows an unranked first one. Where numbers are contested, the
    observations are gone over in sequence instead. `kept` gets the frames that verdicts are read from."""
    # The same expression over the stored version: a lambda's variable hides the column of its name.
    held_rank = f"transform(array(projected_version), source_version -> {version_rank})[0]"
    ranked = cases.selectExpr("*", f"CAST({version_rank} AS DECIMAL(38,10)) AS rank", f"CAST({held_rank} AS DECIMAL(38,10)) AS held_rank")
    sets = _contested(ranked, orders)
    if sets is None:
        return _running_ranks(ranked)
    ranked = parked(ranked.join(sets, list(IDENTITY), "left"))
    kept += [sets, ranked]
    alone = _running_ranks(ranked.where("contest IS NULL").drop("contest"))
    return alone.select("observation_id", "verdict").unionByName(_walk(ranked.where("contest IS NOT NULL"), _holders(sets, orders), _of_ranks))


def _running_ranks(ranked: DataFrame) -> DataFrame:
    first = ranked.groupBy(*IDENTITY).agg(
        F.expr("min(sequence) AS first_sequence"), F.expr("min_by(rank, sequence) AS first_rank")
    )
    known = running_max(ranked.join(first, list(IDENTITY)), IDENTITY, "sequence", "rank")
    opening = "NOT has_order AND sequence = first_sequence"
    start = "CASE WHEN has_order THEN held_rank ELSE first_rank END"
    current = "greatest(before, start)"
    # Until a revision is accepted, the order has the version it had.
    same = "has_order AND projected_version <=> source_version AND coalesce(before <= start, true)"
    return known.selectExpr("*", f"{start} AS start").selectExpr(
        *ranked.columns,
        f"CASE WHEN {opening} THEN 'ACCEPT' WHEN {same} THEN {_SAME_VERSION} WHEN start IS NULL OR rank IS NULL OR rank = {current} "
        f"THEN 'SOURCE_VERSION_ORDER_UNPROVEN' WHEN rank > {current} THEN 'ACCEPT' ELSE 'STALE_SOURCE_VERSION' END AS verdict",
    )


def _node(namespace: str = "source_namespace", order: str = "source_order_id") -> str:
    """One text for an identity; the length keeps namespaces apart."""
    return f"concat(length({namespace}), ':', {namespace}, {order})"


def _contested(cases: DataFrame, orders: DataFrame) -> DataFrame | None:
    """Identities that claim or hold a number another one claims or holds, and their connected set; None if there are none."""
    numbers = ["source_namespace", "order_number"]
    claims = cases.select(*numbers, "source_order_id").unionByName(orders.select(*numbers, "source_order_id")).where("order_number IS NOT NULL")
    shared = claims.groupBy(*numbers).agg(F.min("source_order_id").alias("low"), F.max("source_order_id").alias("high")).where("low <> high")
    shared = parked(shared.drop("high"))
    if shared.isEmpty():
        released(shared)
        return None
    edges = parked(claims.join(shared, numbers).select(*IDENTITY, "low").distinct())
    released(shared)
    labels = connected(edges.selectExpr(f"{_node()} AS a", f"{_node(order='low')} AS b"))
    names = edges.select(*IDENTITY).distinct().withColumn("node", F.expr(_node()))
    sets = parked(names.join(labels, "node").select(*IDENTITY, F.col("root").alias("contest")))
    released(edges, labels)
    return sets


def _holders(sets: DataFrame, orders: DataFrame) -> DataFrame:
    """The order numbers that contesting identities have at the start."""
    return orders.select(*IDENTITY, "order_number").where("order_number IS NOT NULL").join(sets, list(IDENTITY))


def _in_sequence(cases: DataFrame, orders: DataFrame, compare: Compare, kept: list[DataFrame]) -> DataFrame:
    """Verdicts one after the other: by identity, and by connected set where numbers are contested."""
    cases = cases.selectExpr("*", "CAST(NULL AS DECIMAL(38,10)) AS rank", "CAST(NULL AS DECIMAL(38,10)) AS held_rank")
    sets = _contested(cases, orders)
    if sets is None:
        return _walk(cases.withColumn("contest", F.expr(_node())), None, compare)
    kept.append(sets)
    dealt = cases.join(sets, list(IDENTITY), "left").withColumn("contest", F.expr(f"coalesce(contest, {_node()})"))
    return _walk(dealt, _holders(sets, orders), compare)


_WALKED = (
    "contest", "sequence", *IDENTITY, "order_number", "observation_id", "source_version", "rank", "projected_version", "held_rank",
    "has_order", "fits",
)


def _walk(cases: DataFrame, holders: DataFrame | None, compare: Compare) -> DataFrame:
    """observation_id and verdict: one pass over the rows, dealt out by `contest` and in sequence order.

    A task holds one batch and, of one contest, the version and number of every order and who owns each number.
    """
    rows = cases.select(*_WALKED)
    if holders is not None:
        filled = {"sequence": "-1L", **{name: name for name in ("contest", *IDENTITY, "order_number")}}
        kinds = dict(rows.dtypes)
        rows = rows.unionByName(holders.selectExpr(*(f"CAST({filled.get(name, 'NULL')} AS {kinds[name]}) AS {name}" for name in _WALKED)))
    verdict_of = dict(_VERDICT_OF)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contest = None
        owner: dict[str, tuple] = {}
        orders: dict[tuple, tuple] = {}  # identity -> (version, rank), number, and whether it is the one stored before
        for batch in batches:
            out = []
            for at, _, namespace, order, number, observation, version, rank, held, held_rank, has_order, fits in zip(
                *(column.to_pylist() for column in batch.columns)
            ):
                if at != contest:
                    contest, owner, orders = at, {}, {}
                identity, incoming = (namespace, order), (version, rank)
                if observation is None:  # an order there was before
                    owner[number] = identity
                    orders[identity] = (None, number, True)
                    continue
                if has_order and (identity not in orders or orders[identity][0] is None):
                    orders[identity] = ((held, held_rank), orders[identity][1] if identity in orders else None, True)
                current, own, stored = orders.get(identity, (None, None, False))
                if current is not None and stored and current[0] == version:
                    out.append((observation, "ACCEPT" if fits else "SOURCE_VERSION_CONTENT_CONFLICT"))
                    continue
                verdict = "ACCEPT" if current is None else verdict_of[compare(current, incoming)]
                if verdict == "ACCEPT":
                    if owner.get(number, identity) != identity:
                        verdict = "OPERATIONAL_ORDER_CONFLICT"
                    else:
                        if own is not None and own != number and owner.get(own) == identity:
                            del owner[own]
                        owner[number] = identity
                        orders[identity] = (incoming, number, False)
                out.append((observation, verdict))
            if out:
                judged, verdicts = zip(*out)
                yield pa.record_batch([pa.array(judged, pa.binary()), pa.array(verdicts, pa.string())], ["observation_id", "verdict"])

    dealt = rows.repartition("contest").sortWithinPartitions("contest", "sequence")
    return dealt.mapInArrow(judge, "observation_id binary, verdict string")


def _apply(rows: DataFrame, observations: DataFrame, orders: DataFrame) -> Promotion:
    """Observations and orders after the batch; `rows` have the results."""
    accepted = rows.where("result = 'ACCEPT'").select("observation_id", "sequence", *IDENTITY, "current_observation")
    accepted = parked(next_in_sequence(accepted, IDENTITY))
    links = accepted.where("successor IS NOT NULL").selectExpr("observation_id", "successor")
    first = accepted.where("current_observation IS NOT NULL").groupBy(*IDENTITY).agg(
        F.expr("min_by(observation_id, sequence) AS successor"), F.expr(f"first({id_key('current_observation')}) AS previous")
    )
    links = links.unionByName(first.where("previous <> successor").selectExpr("previous AS observation_id", "successor"))
    known = "array_except(reasons, array('MISSING_WAREHOUSE', 'UNKNOWN_WAREHOUSE'))"
    blocking = (
        "'UNVERSIONED_CONTENT_CONFLICT', 'SOURCE_VERSION_CONTENT_CONFLICT', 'SOURCE_VERSION_ORDER_UNPROVEN', "
        "'STALE_SOURCE_VERSION'"
    )
    placeless = "'MISSING_WAREHOUSE', 'UNKNOWN_WAREHOUSE'"
    # `early`: a content conflict inside one version is found before the warehouse is looked at.
    changed = {
        "status": f"CASE WHEN result = 'KEEP' THEN status WHEN result = 'ACCEPT' THEN 'PROMOTED' "
        f"WHEN result IN ({blocking}) THEN 'CONFLICT_BLOCKED' WHEN result = 'OPERATIONAL_ORDER_CONFLICT' THEN 'REJECTED_INVALID' "
        "ELSE 'CONTEXT_INCOMPLETE' END",
        "reasons": f"CASE WHEN result = 'KEEP' THEN reasons WHEN result = 'ACCEPT' THEN CAST(array() AS ARRAY<STRING>) "
        f"WHEN result = 'OPERATIONAL_ORDER_CONFLICT' THEN array(result) "
        f"WHEN result IN ({placeless}) OR early THEN array_union(reasons, array(result)) "
        f"WHEN result IN ({blocking}) THEN array_union({known}, array(result)) ELSE {known} END",
        "warehouse_capability": f"CASE WHEN result = 'KEEP' OR early THEN warehouse_capability "
        "WHEN result = 'MISSING_WAREHOUSE' THEN 'WAREHOUSE_CONTEXT_UNAVAILABLE' "
        "WHEN result = 'UNKNOWN_WAREHOUSE' THEN 'WAREHOUSE_UNKNOWN' ELSE 'WAREHOUSE_VALIDATED' END",
        "promoted": "promoted OR result = 'ACCEPT'",
        "superseded_by": f"coalesce({key_id('successor')}, superseded_by)",
    }
    results = rows.select("observation_id", "result", "early").join(links, "observation_id", "left")
    results = results.withColumnRenamed("observation_id", "result_of")
    keyed = observations.withColumn("result_of", F.expr(id_key("observation_id")))
    after = keyed.join(results, "result_of", "left").selectExpr(*[f"{changed.get(name, name)} AS {name}" for name in observations.columns])
    latest = accepted.where("successor IS NULL").select(F.col("observation_id").alias("result_of"))
    current = keyed.join(latest, "result_of").selectExpr(
        *IDENTITY, *PROJECTED, "source_version AS projected_version", "observation_id AS current_observation"
    )
    taken = accepted.where("successor IS NULL").select(*IDENTITY)
    kept = orders.select(*ORDER_COLUMNS).join(taken, list(IDENTITY), "left_anti")
    return Promotion(after, kept.unionByName(current))
