"""Witness events from anonymised feature rows, for all targets at once.

Each target's plan is an expression over its own row: which days, how many events a day, and which
counters fill them. Nothing is shuffled until slots become events.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.scalars import digest_int, row_fingerprint, total, uuid5
from tidewater.operators.pit import pit_features

#: Names that ids are derived from, and each reason's event type.
COUNTERS = ("f5", "f18", "f11", "f19")
RECENCY, FREE = "recency", "FREE"
#: What f30 counts: active days of the window, to be filled by free events, or events of its own, at most 30 of them and no free ones.
DAYS, OWN = "days", "own"
EVENT_TYPES = {"f5": "EVT_F5", "f11": "EVT_F11", "f18": "EVT_F18", "f19": "EVT_F19", "f30": "EVT_F30", RECENCY: "EVT_ORDER_PAID", FREE: "EVT_SESSION_STARTED"}
WINDOW_DAYS = 30
CAPACITY = 5
TRACK = "A"
SECONDS_PER_DAY = 86_400


def decode(targets: DataFrame) -> DataFrame:
    """Counts and days behind the features, and why a row can't be solved (null if it can).

    Natural logarithms in f5 and f11, decimal ones in f18, f19 and f30; only f5 and f1 must be there,
    and f1 stands in for a missing f2.
    """
    has = set(targets.columns)
    null = F.lit(None).cast("long")
    natural = lambda c: F.bround(F.exp(c)).cast("long") if c in has else null
    decimal = lambda c: F.bround(F.pow(F.lit(10.0), F.col(c))).cast("long") if c in has else null
    last = F.coalesce("f2", "f1") if "f2" in has else F.col("f1")
    n = {"n5": natural("f5"), "n11": natural("f11"), "n18": decimal("f18"), "n19": decimal("f19"), "n30": decimal("f30")}
    rows = targets.withColumns(n | {"d1": F.bround("f1").cast("int"), "d2": F.bround(last).cast("int")})
    forced = F.array_distinct(F.filter(F.array("d1", "d2"), lambda d: d < WINDOW_DAYS))
    rows = rows.withColumn("forced", F.sort_array(forced)).withColumn("n_forced", F.size("forced").cast("long"))
    small = [F.coalesce(F.col(c) < 1, F.lit(False)) for c in n]
    reason = (
        F.when(F.col("n5").isNull() | F.col("d1").isNull(), "missing_value")
        .when(F.col("d1") < F.col("d2"), "first_after_last")
        .when(total([s.cast("int") for s in small]) > 0, "count_below_one")
        .when(F.col("n30") < F.col("n_forced"), "forced_days")
        .when(F.col("n30") > WINDOW_DAYS, "window_too_short")
    )
    return rows.withColumn("reason", reason)


def counters(branch: str) -> tuple[str, ...]:
    return COUNTERS if branch == DAYS else (*COUNTERS, "f30")


def own_counter(decoded: DataFrame) -> DataFrame:
    """``decoded`` for the branch in which f30 counts its own events: days put no bound on it, but 30 does."""
    reason = F.when(F.col("n30") > WINDOW_DAYS, "above_cap").when(~F.col("reason").isin("forced_days", "window_too_short"), F.col("reason"))
    return decoded.withColumn("reason", reason)


def _settled(rows: DataFrame) -> DataFrame:
    """``rows`` with all columns computed once: a generator keeps the optimiser from writing them out again wherever they are used."""
    return rows.select(F.inline(F.array(F.struct(*rows.columns))))


def solvable(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows to solve, and those set aside with their reason."""
    return decoded.where(F.col("reason").isNull()), decoded.where(F.col("reason").isNotNull())


def bound(decoded: DataFrame, branch: str = DAYS) -> DataFrame:
    """The least free events, active days and sessions that any plan needs: free_min, days_min, sessions_min, and total events inside the window.

    Where f30 counts its own events, these need no days beyond the forced ones, or a single day if none
    is forced, and sessions are the fewest on so few days.
    """
    demand = total([F.coalesce(F.col(f"n{c[1:]}"), F.lit(0).cast("long")) for c in counters(branch)])
    fewest = F.greatest("n_forced", F.lit(1).cast("long"))
    days = F.coalesce("n30", fewest) if branch == DAYS else fewest
    free = F.when(F.col("n30").isNull() | F.lit(branch == OWN), F.lit(0).cast("long")).otherwise(F.greatest(F.lit(0).cast("long"), days - F.col("n_forced") - demand))
    outside = F.size(F.array_distinct(F.array("d1", "d2"))) - F.col("n_forced")
    rows = decoded.withColumns({"demand": demand, "n_days": days, "free_min": free}).withColumn("n_inside", F.col("demand") + F.col("n_forced") + F.col("free_min"))
    least = outside + F.greatest("n_days", F.ceil(F.col("n_inside") / CAPACITY))
    return rows.withColumns({"sessions_min": least.cast("long"), "days_min": (outside + F.col("n_days")).cast("long")})


def plan(decoded: DataFrame, seed: int, track: str = TRACK, branch: str = DAYS) -> DataFrame:
    """Targets with ``slots``, an array of (reason, day, n), one optimal plan each.

    Days: the forced ones and, of the others, those whose keyed digests come first. Every day gets
    an event; the rest fill days up to the capacity in order, and any excess goes to the first day.
    Counters, then free events, are poured into the days' room: slot sizes are the overlaps of the
    running sums of both, which have a closed form.
    """
    # A plan costs far more than its row weighs, so rows are dealt out by number and not by size; events keep that partitioning.
    parts = int(decoded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = _settled(bound(decoded.repartition(parts, "target_id"), branch))
    pool = F.filter(F.sequence(F.lit(0), F.lit(WINDOW_DAYS - 1)), lambda d: ~F.array_contains("forced", d))
    keyed = F.transform(pool, lambda d: F.struct(F.sha2(F.concat_ws("\u001f", "target_id", F.lit(str(seed)), F.lit(track), F.concat(F.lit("day"), d.cast("string"))), 256).alias("h"), d.alias("d")))
    need = (F.col("n_days") - F.col("n_forced")).cast("int")
    picked = F.transform(F.slice(F.sort_array(keyed), 1, need), lambda s: s["d"])
    rows = _settled(rows.withColumn("days", F.sort_array(F.concat("forced", picked))))
    zero = F.lit(0).cast("long")
    rest = F.greatest(zero, F.col("n_inside") - F.col("n_days"))
    most = F.lit(CAPACITY - 1)
    over = F.greatest(zero, rest - most * F.col("n_days"))
    counts = [F.coalesce(F.col(f"n{c[1:]}"), zero) for c in counters(branch)] + [F.col("free_min")]

    # What days share is computed once a target, and a day's room once a day: inside a lambda nothing is shared.
    ends, end = {}, zero
    for k, n in enumerate(counts):
        end = end + n
        ends[f"_end{k}"] = end
    rows = rows.withColumns({"_rest": rest, "_over": over} | ends)

    def room(day: Column, i: Column) -> Column:
        # Room before this day, and in it: one event a day, the rest in order, the excess first; forced days hold one already.
        low = i + F.least(F.col("_rest"), most * i) + F.when(i > 0, F.col("_over")).otherwise(zero) - F.size(F.filter("forced", lambda f: f < day))
        here = 1 + F.greatest(zero, F.least(most.cast("long"), F.col("_rest") - most * i)) + F.when(i == 0, F.col("_over")).otherwise(zero) - F.array_contains("forced", day).cast("long")
        return F.struct(day.alias("day"), low.alias("low"), here.alias("here"))

    def poured(r: Column) -> Column:
        parts, begin = [], zero
        for k, reason in enumerate((*counters(branch), FREE)):
            share = F.least(F.col(f"_end{k}"), r["low"] + r["here"]) - F.greatest(begin, r["low"])
            parts.append(F.struct(F.lit(reason).alias("reason"), r["day"].alias("day"), F.greatest(zero, share).alias("n")))
            begin = F.col(f"_end{k}")
        return F.array(*parts)

    fixed = F.transform(F.array_distinct(F.array("d1", "d2")), lambda d: F.struct(F.lit(RECENCY).alias("reason"), d.alias("day"), F.lit(1).cast("long").alias("n")))
    rows = _settled(rows.withColumn("_rooms", F.transform("days", room)))
    slots = F.filter(F.flatten(F.transform("_rooms", poured)), lambda s: s["n"] > 0)
    return _settled(rows.withColumn("slots", F.concat(fixed, slots)).drop("_rest", "_over", "_rooms", *ends))


def merged_slots(plans: DataFrame) -> DataFrame:
    """(target_id, reason, day, n): slots in long form, those of one reason and day as one."""
    rows = plans.select("target_id", F.explode("slots").alias("s"))
    return rows.groupBy("target_id", "s.reason", "s.day").agg(F.sum("s.n").alias("n"))


def materialise(plans: DataFrame, seed: int, track: str = TRACK) -> DataFrame:
    """Event rows of plans: ids from target, track, reason and occurrence, times from a digest within the day.

    ``plans`` needs reference_ts. An event of the reference day itself stays before the reference
    time; if that is midnight it goes to the day before.
    """
    slot = plans.select("target_id", "reference_ts", F.explode("slots").alias("s")).select("target_id", "reference_ts", "s.*")
    # Occurrences are numbered by slot, of which there are fewer than events.
    before = Window.partitionBy("target_id", "reason").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    slot = slot.withColumn("_before", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")))
    each = slot.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("sub_index"))
    each = each.withColumn("occurrence", (F.col("_before") + F.col("sub_index")).cast("int"))
    start = F.unix_seconds(F.date_trunc("day", "reference_ts")) - F.col("day") * SECONDS_PER_DAY
    room = F.when(F.col("day") == 0, F.unix_seconds("reference_ts") - start).otherwise(SECONDS_PER_DAY)
    begin = F.when(room > 0, start).otherwise(start - SECONDS_PER_DAY)
    upper = F.when(room > 0, room).otherwise(SECONDS_PER_DAY)
    drawn = digest_int(F.concat_ws("\u001f", F.lit(str(seed)), "reason", F.col("day").cast("string"), F.col("sub_index").cast("string")), upper)
    kind = F.element_at(F.create_map(*(F.lit(x) for pair in EVENT_TYPES.items() for x in pair)), F.col("reason"))
    name = F.concat_ws(":", "target_id", F.lit(track), "reason", F.col("occurrence").cast("string"))
    at = F.timestamp_seconds(begin + drawn)
    return each.select(
        uuid5(name).alias("event_id"),
        "target_id",
        kind.alias("event_type"),
        at.alias("event_ts"),
        at.alias("observation_ts"),
        F.lit("reconstructed").alias("source_type"),
        F.col("reason").alias("gen_reason"),
        F.col("day").alias("day_offset"),
        "sub_index",
        "occurrence",
    )


def canonical_order(events: DataFrame) -> DataFrame:
    return events.orderBy("event_ts", "event_type", "event_id")


def metrics(plans: DataFrame) -> DataFrame:
    """(target_id, active_days, days_in_window, sessions, unexplained) of plans."""
    day = plans.select("target_id", F.explode("slots").alias("s")).groupBy("target_id", "s.day").agg(F.sum("s.n").alias("n"), F.sum(F.when(F.col("s.reason") == FREE, F.col("s.n")).otherwise(0)).alias("free"))
    return day.groupBy("target_id").agg(
        F.count("*").alias("active_days"),
        F.count_if(F.col("day") < WINDOW_DAYS).alias("days_in_window"),
        F.sum(F.ceil(F.col("n") / CAPACITY)).cast("long").alias("sessions"),
        F.sum("free").cast("long").alias("unexplained"),
    )


def feasible(plans: DataFrame) -> DataFrame:
    """(target_id, feasible): the plan's counts, recency days and active days are the target's, and its objective is the bound."""
    count = lambda reason: F.aggregate(F.filter("slots", lambda s: s["reason"] == reason), F.lit(0).cast("long"), lambda a, s: a + s["n"])
    same = [count(c) == F.coalesce(F.col(f"n{c[1:]}"), F.lit(0)) for c in COUNTERS]
    recent = count(RECENCY) == F.size(F.array_distinct(F.array("d1", "d2")))
    own = plans.select("target_id", "n30", "free_min", "sessions_min", (total([s.cast("int") for s in (*same, recent)]) == len(same) + 1).alias("counts_ok"))
    rows = own.join(metrics(plans), "target_id")
    days = F.coalesce(F.col("days_in_window") == F.col("n30"), F.lit(True))
    best = (F.col("unexplained") == F.col("free_min")) & (F.col("sessions") == F.col("sessions_min"))
    return rows.select("target_id", (F.col("counts_ok") & days & best).alias("feasible"))


def feasible_own(plans: DataFrame) -> DataFrame:
    """(target_id, feasible) where f30 counts its own events: all counts are the target's, nothing is free, and active days, then sessions, are the fewest."""
    count = lambda reason: F.aggregate(F.filter("slots", lambda s: s["reason"] == reason), F.lit(0).cast("long"), lambda a, s: a + s["n"])
    same = [count(c) == F.coalesce(F.col(f"n{c[1:]}"), F.lit(0)) for c in counters(OWN)]
    recent = count(RECENCY) == F.size(F.array_distinct(F.array("d1", "d2")))
    covered = F.size(F.array_except("forced", F.transform("slots", lambda s: s["day"]))) == 0
    right = reduce(lambda a, b: a & b, (*same, recent, covered, count(FREE) == 0))
    rows = plans.select("target_id", "days_min", "sessions_min", right.alias("right")).join(metrics(plans), "target_id")
    return rows.select("target_id", (F.col("right") & (F.col("active_days") == F.col("days_min")) & (F.col("sessions") == F.col("sessions_min"))).alias("feasible"))


#: How each feature is compared: exactly, or with a relative tolerance.
REGIMES = {"f1": ("exact", 0.0), "f2": ("exact", 0.0), "f5": ("relative", 1e-15), "f18": ("exact", 0.0)}


def gate_a(targets: DataFrame, boundary: DataFrame, events: DataFrame) -> DataFrame:
    """(target_id, feature, expected, actual, ok) of all targets: features recomputed from the events by the mart's own code."""
    features = [f for f in REGIMES if f in targets.columns]
    actual = pit_features(boundary, events).unpivot(["target_id"], features, "feature", "actual")
    expected = targets.unpivot(["target_id"], features, "feature", "expected")
    tolerance = F.element_at(F.create_map(*(F.lit(x) for f in features for x in (f, REGIMES[f][1]))), F.col("feature"))
    near = F.abs(F.col("expected") - F.col("actual")) <= tolerance * F.greatest(F.abs("expected"), F.lit(1.0))
    return expected.join(actual, ["target_id", "feature"], "left").withColumn("ok", F.coalesce(near, F.lit(False)))


def gate_summary(gated: DataFrame) -> DataFrame:
    return gated.groupBy("feature").agg(F.count("*").alias("n"), F.count_if("ok").alias("n_ok"))


#: Columns that would tell a label.
LABELS = {"label", "is_treat", "y", "w", "outcome"}
MOST_EVENTS = 20_000


def gates_b_to_f(plans: DataFrame, events: DataFrame) -> DataFrame:
    """(target_id, before_reference, feasible, provenance, no_label, sane_volume)."""
    seen = events.join(plans.select("target_id", "reference_ts"), "target_id").groupBy("target_id").agg(
        F.bool_and(F.col("event_ts") < F.col("reference_ts")).alias("before_reference"),
        F.bool_and(F.col("source_type") == "reconstructed").alias("provenance"),
        (F.count("*") <= MOST_EVENTS).alias("sane_volume"),
    )
    rows = seen.withColumn("no_label", F.lit(not LABELS & set(events.columns)))
    return rows.join(feasible(plans), "target_id").select("target_id", "before_reference", "feasible", "provenance", "no_label", "sane_volume")


def handoff(plans: DataFrame, events: DataFrame, attributes: DataFrame, gated: DataFrame, gates: DataFrame) -> DataFrame:
    """(target_id, as_of, attributes, counters, last_event_ts): state of targets that passed every gate and whose events end before as_of."""
    passed = gated.groupBy("target_id").agg(F.bool_and("ok").alias("a_ok")).where("a_ok").select("target_id")
    passed = passed.join(gates.where("before_reference AND feasible AND provenance AND no_label AND sane_volume").select("target_id"), "target_id")
    known = attributes.groupBy("target_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("attr_name", "level_id")))).alias("attributes"))
    last = events.groupBy("target_id").agg(F.max("event_ts").alias("last_event_ts"))
    counters = F.map_filter(F.create_map(*(x for c in COUNTERS for x in (F.lit(f"n{c[1:]}"), F.col(f"n{c[1:]}")))), lambda k, v: v.isNotNull())
    rows = plans.select("target_id", F.col("reference_ts").alias("as_of"), counters.alias("counters")).join(passed, "target_id", "left_semi")
    return rows.join(last, "target_id").where("last_event_ts < as_of").join(known, "target_id", "left").select("target_id", "as_of", "attributes", "counters", "last_event_ts")


def sealed(targets: DataFrame, identity: list[str], columns: list[str]) -> DataFrame:
    """Targets with the hash that shows later changes."""
    return targets.withColumn("target_hash", row_fingerprint([F.col(c) for c in identity], {c: F.col(c) for c in columns}))


def tampered(rows: DataFrame, identity: list[str], columns: list[str]) -> DataFrame:
    now = row_fingerprint([F.col(c) for c in identity], {c: F.col(c) for c in columns})
    return rows.where(~now.eqNullSafe(F.col("target_hash")))


def feature_report(gated: DataFrame, aliases: DataFrame) -> DataFrame:
    """Expected and actual values with business name, tier and regime."""
    return gated.join(aliases, "feature", "left")


def tier_summary(report: DataFrame) -> DataFrame:
    """Passes of gate A by tier."""
    return report.groupBy("tier").agg(F.count("*").alias("n"), F.count_if("ok").alias("n_ok"))


#: Columns that say how an event was made; they go to the audit table only.
GENERATOR = ("gen_reason", "day_offset", "sub_index", "occurrence")


def emit(plans: DataFrame, set_aside: DataFrame, attributes: DataFrame, passthrough: list[str], root: str, seed: int, encodings: DataFrame, layout: DataFrame, track: str = TRACK) -> DataFrame:
    """Write the tables of a reconstruction, a folder each under ``root``; the manifest (table_name, n_rows) of what can be read back.

    Plans are written first, and boundary, targets and pass-through columns follow from that table, so
    that no plan is made twice. Events are made once, into the audit table, which says of each what it
    stands for; the event table is read off it and doesn't.
    """
    spark = plans.sparkSession
    plans.write.mode("overwrite").parquet(f"{root}/plans")
    made = spark.read.parquet(f"{root}/plans")
    materialise(made, seed, track).withColumn("track", F.lit(track)).write.mode("overwrite").parquet(f"{root}/audit")
    tables = {
        "events": spark.read.parquet(f"{root}/audit").drop("track", *GENERATOR),
        "boundary": made.select("target_id", "reference_ts"),
        "targets": made.select("target_id", *(c for c in ("n5", "n11", "n18", "n19", "n30", "d1", "d2") if c in made.columns)),
        "passthrough_source": made.select("target_id", *passthrough),
        "objective": made.select("target_id", "free_min", "sessions_min"),
        "customer_attribute": attributes,
        "encoding_map": encodings,
        "onehot_layout": layout,
        "quarantine": set_aside.select("target_id", "reason"),
    }
    for name, rows in tables.items():
        rows.write.mode("overwrite").parquet(f"{root}/{name}")
    counts = [spark.read.parquet(f"{root}/{name}").agg(F.lit(name).alias("table_name"), F.count("*").alias("n_rows")) for name in ("plans", "audit", *tables)]
    manifest = reduce(DataFrame.unionByName, counts)
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{root}/manifest")
    return spark.read.parquet(f"{root}/manifest")
