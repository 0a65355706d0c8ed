"""Trailing-window features: sums, counts and flags over the last 1/3/6/12 months.

A window test on ``months_between`` depends on calendar days only (see ``window_start``), so
events and targets are first reduced to one row per key and day. What a single key can hold
after that is bounded by the days of the history, however many raw rows it had, and what a
window can hold by the days of a year. Window totals then come from one sort per key.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refillcast.functions import feature_name, window_start
from refillcast.operators.reshape import long_union
from refillcast.operators.topk import fed_ranks, rank_entities, top_k_entities

WINDOWS = (1, 3, 6, 12)
CUSTOMER = "customer_entity_id"
TARGET_KEY = (CUSTOMER, "product_id", "purchase_dt")
TARGET_TS = "purchase_dt"
MASK_BITS = 62

def daily_events(events: DataFrame, keys: Sequence[str], ts: str, totals: dict[str, Column]) -> DataFrame:
    """One row per key and calendar day; rows without key or time can match no window."""
    return (
        events.dropna(subset=[*keys, ts])
        .groupBy(*keys, F.to_date(ts).alias("day"))
        .agg(*[total.alias(name) for name, total in totals.items()])
    )


def target_days(target: DataFrame, keys: Sequence[str], ts: str = TARGET_TS) -> DataFrame:
    """The distinct (key, day) pairs that need window totals."""
    return target.dropna(subset=[*keys, ts]).select(*keys, F.to_date(ts).alias("day")).distinct()


def day_rows(
    target: DataFrame,
    events: DataFrame,
    keys: Sequence[str],
    event_ts: str,
    totals: dict[str, Column],
    target_ts: str = TARGET_TS,
) -> DataFrame:
    """One row per key and day with target rows or events: ``is_target`` and the day's totals.

    ``totals`` are aggregates over the event columns that ignore NULL. Targets and events meet
    in one aggregate whose partial sums run before the exchange on (key, day).
    """
    own = [c for c in events.columns if c not in (*keys, event_ts)]
    mine = target.select(*keys, F.to_date(target_ts).alias("day"), F.lit(True).alias("is_target"))
    return (
        mine.unionByName(
            events.select(*keys, F.to_date(event_ts).alias("day"), F.lit(False).alias("is_target"), *own),
            allowMissingColumns=True,
        )
        .dropna(subset=[*keys, "day"])
        .groupBy(*keys, "day")
        .agg(
            F.max("is_target").alias("is_target"),
            *[t.alias(name) for name, t in totals.items()],
        )
    )


def day_code(day: Column) -> Column:
    """A whole number per day in which a month back is always 32 less, whether that day exists or not."""
    return (F.year(day) * 12 + F.month(day)) * 32 + F.dayofmonth(day)


#: Decimal places of the lower limb of a double, and the size from which doubles are no exact limbs.
LIMB = 10**15
WILD = 2**53


def _limbs(name: str, kind: str) -> dict[str, str]:
    """Whole-number columns, as SQL, that stand for a total: they add and subtract without residue.

    A double is its floor and its fraction in units of 10^-15; NaN, infinities and sizes of 2^53 or more have none.
    """
    if kind != "double":
        return {name: f"cast({name} as bigint)"}
    tame = _tame(name)
    return {
        f"{name}__whole": f"case when {tame} then cast(floor({name}) as bigint) end",
        f"{name}__part": f"case when {tame} then cast(round(({name} - floor({name})) * {LIMB}D) as bigint) end",
    }


def _tame(name: str) -> str:
    return f"(abs({name}) < {WILD}D and not isnan({name}))"


def running_windows(
    wanted: DataFrame,
    events: DataFrame,
    keys: Sequence[str],
    totals: Sequence[str],
    windows: Sequence[int] = WINDOWS,
    strict: Collection[str] = (),
) -> DataFrame:
    """Every row of ``wanted`` (keys, day, ...) with ``<total>__<months>`` over the trailing windows of its key.

    ``events`` has one row per key and day with the totals. A window is the difference of two running
    totals along ``day_code``: of all days up to the row's own (the day before for totals in ``strict``) and of all
    days a number of months before. Only where a month's last day asks for a shorter month, that month's last
    day belongs to the window as well; events of such days stand again at the codes without a day. Each
    total moves along one sort per key; no row meets another and nothing is listed, however many rows a key has.
    """
    kinds = {f.name: f.dataType.simpleString() for f in events.schema.fields}
    doubles = [t for t in totals if kinds[t] == "double"]
    limbs = {limb: (text, name in strict) for name in totals for limb, text in _limbs(name, kinds[name]).items()}
    # The last day of a short month, once more for each day that the month lacks.
    lacking = "case when day = last_day(day) then 31 - dayofmonth(day) else 0 end"
    split = (
        events.withColumn("at", day_code(F.col("day")))
        .selectExpr(*keys, "day", "at", *totals, f"explode(sequence(0, {lacking})) as late")
        .selectExpr(
            *keys, "at + late as at", "false as is_wanted",
            *[f"case when late = 0 then {text} end as {limb}" for limb, (text, _) in limbs.items()],
            *[f"case when late > 0 then {text} end as {limb}__end" for limb, (text, _) in limbs.items()],
            *[f"case when late = 0 and {t} is not null and not {_tame(t)} then day end as {t}__wild" for t in doubles]))
    own = [c for c in wanted.columns if c not in keys]
    # What a row of the target carries is one column, which rows of events leave empty.
    rows = wanted.select(
        *keys, day_code(F.col("day")).alias("at"), F.lit(True).alias("is_wanted"), F.struct(*own).alias("own")
    ).unionByName(split, allowMissingColumns=True)

    def over(aggregate: str, since: str, until: str) -> str:
        return f"{aggregate} over (partition by {', '.join(keys)} order by at range between {since} and {until})"

    running = []
    for limb, (_, is_strict) in limbs.items():
        running.append(over(f"sum({limb})", "unbounded preceding", "1 preceding" if is_strict else "current row") + f" as {limb}__now")
        for m in windows:
            running.append(over(f"sum({limb})", "unbounded preceding", f"{32 * m + 1} preceding") + f" as {limb}__before{m}")
            # As a difference too: a frame that slides copies every row.
            running += [
                over(f"sum({limb}__end)", "unbounded preceding", f"{end} preceding") + f" as {limb}__{name}{m}"
                for name, end in (("upto", 32 * m), ("past", 32 * m + 1))]
    running += [
        over(f"max({t}__wild)", "unbounded preceding", "1 preceding" if t in strict else "current row") + f" as {t}__last_wild"
        for t in doubles]
    seen = (
        rows.selectExpr(*keys, "own", "is_wanted", *running).where("is_wanted").selectExpr("*", "own.day as day")
        .select("*", *[window_start(F.col("day"), m).alias(f"from__{m}") for m in windows if doubles]))

    def inside(limb: str, m: int) -> str:
        end = f"case when day = last_day(day) then coalesce({limb}__upto{m}, 0L) - coalesce({limb}__past{m}, 0L) else 0L end"
        return f"(coalesce({limb}__now, 0L) - coalesce({limb}__before{m}, 0L) + {end})"

    def total(name: str, m: int) -> str:
        if name not in doubles:
            return inside(name, m)
        whole, part = inside(f"{name}__whole", m), inside(f"{name}__part", m)
        return (
            f"case when {name}__last_wild >= from__{m} then double('NaN') else"
            f" cast({whole} + {part} div {LIMB}L as double) + ({part} % {LIMB}L) / {LIMB}D end")

    carried = [c if c in keys else f"own.{c} as {c}" for c in wanted.columns]
    return seen.selectExpr(*carried, *[f"{total(t, m)} as {t}__{m}" for t in totals for m in windows])


def slot_windows(
    wanted: DataFrame,
    flagged: DataFrame | None,
    counted: DataFrame | None,
    keys: Sequence[str],
    masks: Mapping[str, int],
    counts: int,
    windows: Sequence[int] = WINDOWS,
    strict: Collection[int] = (),
    open_bits: Mapping[str, int] | None = None,
) -> DataFrame:
    """Many whole-number totals at once, for every row of ``wanted`` (keys, day).

    ``flagged`` has one row per key and day with 64-bit ``masks`` (how many of their bits are in use); each bit only asks
    whether a window holds any event, so the last day the bit was set tells for every window. ``counted`` has one
    row per key and day with ``adds``, a list of ``counts`` numbers; their window totals are differences of two
    running totals as in ``running_windows``. Days without numbers have no such row, target days carry nothing, and
    the totals of a window without any are NULL, so that a row stays narrow through the sort and the joins after it. The
    day itself counts except for the places in ``strict`` and for mask bits missing from ``open_bits``.
    Output: keys, day, ``<mask>__<months>``, ``adds__<months>``.
    """
    rows = wanted.select(*keys, "day", day_code(F.col("day")).alias("at"), F.lit(True).alias("is_wanted"))
    if flagged is not None:
        marks = flagged.select(*keys, "day", day_code(F.col("day")).alias("at"), F.lit(False).alias("is_wanted"), *masks)
        rows = rows.unionByName(marks, allowMissingColumns=True)
    if counted is not None:
        # The last day of a short month, once more for each day that the month lacks.
        lacking = "case when day = last_day(day) then 31 - dayofmonth(day) else 0 end"
        numbers = (
            counted.withColumn("at", day_code(F.col("day")))
            .selectExpr(*keys, "day", "at", "adds", f"explode(sequence(0, {lacking})) as late")
            .selectExpr(*keys, "day", "at + late as at", "false as is_wanted", "case when late = 0 then adds end as adds",
                        "case when late > 0 then adds end as adds__end"))
        rows = rows.unionByName(numbers, allowMissingColumns=True)
    places = range(counts if counted is not None else 0)
    bits = [(mask, bit) for mask, used in masks.items() for bit in range(used)] if flagged is not None else []

    def over(aggregate: str, since: str, until: str) -> str:
        return f"{aggregate} over (partition by {', '.join(keys)} order by at range between {since} and {until})"

    running = []
    for mask, bit in bits:
        end = "current row" if (open_bits or {}).get(mask, -1) >> bit & 1 else "1 preceding"
        running.append(over(f"max(case when {mask} & {1 << bit}L <> 0 then day end)", "unbounded preceding", end) + f" as last__{mask}_{bit}")
    for i in places:
        end = "1 preceding" if i in strict else "current row"
        running.append(over(f"sum(adds[{i}])", "unbounded preceding", end) + f" as now__{i}")
        running += [over(f"sum(adds[{i}])", "unbounded preceding", f"{32 * m + 1} preceding") + f" as before__{i}__{m}" for m in windows]
    if places:
        running += [over("max(adds__end)", f"{32 * m} preceding", f"{32 * m} preceding") + f" as end__{m}" for m in windows]
    seen = (
        rows.selectExpr(*keys, "day", "is_wanted", *running).where("is_wanted")
        .select("*", *[window_start(F.col("day"), m).alias(f"from__{m}") for m in windows if bits]))

    def combined(mask: str, m: int) -> str:
        held = [f"case when last__{mask}_{bit} >= from__{m} then {1 << bit}L else 0L end" for own, bit in bits if own == mask]
        return f"{' | '.join(held) or '0L'} as {mask}__{m}"

    def inside(i: int, m: int) -> str:
        end = f"case when day = last_day(day) then coalesce(end__{m}[{i}], 0L) else 0L end"
        return f"coalesce(now__{i}, 0L) - coalesce(before__{i}__{m}, 0L) + {end}"

    def listed(m: int) -> str:
        sums = [inside(i, m) for i in places]
        held = f"array({', '.join(sums)})"
        return f"nullif({held}, array_repeat(0L, {len(sums)})) as adds__{m}" if sums else f"cast(null as array<bigint>) as adds__{m}"

    return seen.selectExpr(*keys, "day", *[combined(mask, m) for mask in masks for m in windows], *[listed(m) for m in windows])


def target_copies(target: DataFrame, key: Sequence[str] = TARGET_KEY) -> DataFrame:
    """Distinct target keys with the number of rows that carry them."""
    return target.groupBy(*key).agg(F.count(F.lit(1)).alias("copies"))


def per_target(
    target: DataFrame,
    totals: DataFrame,
    keys: Sequence[str],
    outputs: dict[str, Column],
    key: Sequence[str] = TARGET_KEY,
    ts: str = TARGET_TS,
) -> DataFrame:
    """Bring (key, day) totals to one row per target key; ``outputs`` may use ``copies``."""
    keyed = target_copies(target, key).withColumn("day", F.to_date(ts))
    return keyed.join(totals, [*keys, "day"], "left").select(
        *key, *[value.alias(name) for name, value in outputs.items()]
    )


def _key_totals(
    target: DataFrame,
    events: DataFrame,
    keys: Sequence[str],
    totals: dict[str, Column],
    windows: Sequence[int],
    strict: Collection[str],
    outputs: dict[str, Column],
) -> DataFrame:
    """One row per target key with totals of the key; ``outputs`` may use ``copies``.

    The target's rows, counted once, go through the windows themselves, so nothing is joined back. Keys
    without a customer, product or time match nothing.
    """
    copies = target_copies(target).withColumn("day", F.to_date(TARGET_TS))
    whole = " and ".join(f"{c} is not null" for c in (*keys, TARGET_TS))
    days = daily_events(events, keys, "event_ts", totals)
    found = running_windows(copies.where(whole), days, keys, list(totals), windows, strict)
    none = [F.lit(0).cast(f.dataType).alias(f.name) for f in found.schema.fields if f.name not in copies.columns]
    incomplete = copies.where(f"not ({whole})").select("*", *none)
    return found.unionByName(incomplete).select(*TARGET_KEY, *[v.alias(n) for n, v in outputs.items()])


def trailing_sum(
    target: DataFrame,
    events: DataFrame,
    keys: Sequence[str],
    value: str,
    prefix: str,
    event_ts: str = "purchase_dt",
    windows: Sequence[int] = WINDOWS,
    include_zero: bool = False,
) -> DataFrame:
    """Sum of ``value`` per window, once per target row with the key; no events give 0."""
    values = events.select(*keys, F.col(event_ts).alias("event_ts"), F.col(value).cast("double").alias("value"))
    sums = {"total": F.sum("value")}
    return _key_totals(target, values, keys, sums, windows, () if include_zero else sums, {
        f"{prefix}_last{m}m": F.coalesce(F.col(f"total__{m}"), F.lit(0.0)) * F.col("copies")
        for m in windows
    })


def trailing_count(
    target: DataFrame,
    events: DataFrame,
    keys: Sequence[str],
    suffix: str,
    event_ts: str,
    windows: Sequence[int] = WINDOWS,
    include_zero: bool = True,
    flag: bool = False,
) -> DataFrame:
    """Number of events per window, once per target row with the key; no events give 0.

    With ``flag``: 1 where the window holds any event, else 0.
    """
    ones = events.select(*keys, F.col(event_ts).alias("event_ts"), F.lit(1).alias("one"))
    counts = {"n": F.sum("one")}

    def output(m: int) -> Column:
        n = F.coalesce(F.col(f"n__{m}"), F.lit(0))
        return (n > 0).cast("long") if flag else n * F.col("copies")

    return _key_totals(target, ones, keys, counts, windows, () if include_zero else counts, {
        f"last{m}m_{suffix}": output(m) for m in windows})


def trailing_flag(
    target: DataFrame,
    events: DataFrame,
    keys: Sequence[str],
    suffix: str,
    event_ts: str,
    windows: Sequence[int] = WINDOWS,
    include_zero: bool = True,
) -> DataFrame:
    """1 where the window holds any event of the key, else 0."""
    return trailing_count(target, events, keys, suffix, event_ts, windows, include_zero, flag=True)


@dataclass(frozen=True)
class Channel:
    """A top-k channel: which labels open slots, which column events match on, how to count."""

    entity: str  # slot name: <entity>_<rank>
    kind: str  # feature name ending
    ts: str
    labels: tuple[str, ...]
    match: str
    k: int
    mode: str  # "flag": any event in the window; "count": number of events
    keep_null: bool = False  # a NULL label may take a slot; that slot matches the text 'unknown'
    include_zero: bool = True  # events later on the day itself belong to the window

    def __post_init__(self) -> None:
        if self.mode not in ("flag", "count"):
            raise ValueError(f"unknown mode {self.mode!r}")


def ranked_labels(events: DataFrame, channel: Channel) -> DataFrame:
    top = top_k_entities(events, channel.labels, channel.k, channel.keep_null)
    return rank_entities(top, channel.labels)


@dataclass(frozen=True)
class Slot:
    """Where one rank of a channel is kept: a place of its own in a list (``s<place>``), or one bit of a mask column."""

    channel: Channel
    rank: int
    column: str
    bit: int | None


def channel_slots(channels: Sequence[Channel]) -> list[Slot]:
    """The slots of all channels: counts get places in a list, flags share masks of 62 bits."""
    slots, counts, flags = [], 0, 0
    for channel in channels:
        for rank in range(1, channel.k + 1):
            if channel.mode == "count":
                slots.append(Slot(channel, rank, f"s{counts}", None))
                counts += 1
            else:
                slots.append(Slot(channel, rank, f"hits{flags // MASK_BITS}", flags % MASK_BITS))
                flags += 1
    return slots


def channel_totals(
    target: DataFrame,
    channels: Sequence[tuple[Channel, DataFrame]],
    windows: Sequence[int] = WINDOWS,
) -> DataFrame:
    """History of every slot of all channels per (customer, target day), in one pass.

    The top-k tables (k rows each) are broadcast onto the events, which drops events of all
    other labels before the only shuffle of event data, and that shuffle carries partial sums.
    """
    slots = channel_slots([channel for channel, _ in channels])
    counts = [s for s in slots if s.bit is None]
    masks = {s.column: sum(t.column == s.column for t in slots) for s in slots if s.bit is not None}
    # Per event: the counts it adds, or the mask bits it sets.
    adding, marking = [], []
    for channel, events in channels:
        labels = fed_ranks(ranked_labels(events, channel), channel.match)
        if channel.mode == "count":
            adds = [f"cast(array_contains(ranks, {s.rank}) as tinyint)" if s.channel is channel else "0Y" for s in counts]
            fed = labels.selectExpr("match_label", f"array({', '.join(adds)}) as adds")
        else:
            bits = {mask: " | ".join(
                f"case when array_contains(ranks, {s.rank}) then {1 << s.bit}L else 0L end"
                for s in slots if s.channel is channel and s.column == mask) or "0L" for mask in masks}
            fed = labels.selectExpr("match_label", *[f"{text} as {mask}" for mask, text in bits.items()])
        (adding if channel.mode == "count" else marking).append(
            events.select(
                CUSTOMER, F.col(channel.ts).alias("event_ts"), F.col(channel.match).alias("match_label")
            ).join(F.broadcast(fed), "match_label").drop("match_label")
        )
    # Apart, so that the many rows of flags are added up in as many numbers as there are masks.
    flagged = daily_events(long_union(*marking), [CUSTOMER], "event_ts", {m: F.bit_or(m) for m in masks}) if marking else None
    counted = daily_events(
        long_union(*adding), [CUSTOMER], "event_ts", {f"s{i}": F.sum(F.get("adds", F.lit(i))) for i in range(len(counts))},
    ).select(CUSTOMER, "day", F.array(*[f"s{i}" for i in range(len(counts))]).alias("adds")) if adding else None
    return slot_windows(
        target_days(target, [CUSTOMER]), flagged, counted, [CUSTOMER], masks, len(counts), windows,
        strict=[i for i, s in enumerate(counts) if not s.channel.include_zero],
        open_bits={
            mask: sum(1 << s.bit for s in slots if s.column == mask and s.channel.include_zero) for mask in masks
        },
    )


def channel_outputs(channels: Sequence[Channel], windows: Sequence[int] = WINDOWS) -> dict[str, Column]:
    """Feature columns over ``channel_totals`` and ``copies``: every slot and window, else 0."""
    outputs = {}
    for slot in channel_slots(channels):
        for m in windows:
            if slot.bit is None:
                text = f"coalesce(adds__{m}[{slot.column[1:]}], 0L) * copies"
            else:
                text = f"shiftright(coalesce({slot.column}__{m}, 0L), {slot.bit}) & 1L"
            outputs[feature_name(slot.channel.entity, slot.rank, m, slot.channel.kind)] = F.expr(text)
    return outputs


def topk_trailing(
    target: DataFrame, events: DataFrame, channel: Channel, windows: Sequence[int] = WINDOWS
) -> DataFrame:
    """Wide top-k features of one channel: one row per target key, k slots x windows columns."""
    totals = channel_totals(target, [(channel, events)], windows)
    return per_target(target, totals, [CUSTOMER], channel_outputs([channel], windows))


def trailing_join(
    target: DataFrame,
    events: DataFrame,
    keys: Sequence[str],
    event_ts: str,
    max_months: int = 12,
    include_zero: bool = True,
    target_ts: str = TARGET_TS,
) -> DataFrame:
    """Left join of target days to the event days of their trailing window.

    Both sides are reduced to days first, ``n_events`` carries how many events a day had, so
    a target day meets at most the days of its window. Days lie in buckets as wide as the longest
    window; the bucket joins the equi key, so a target day stands in two buckets at most, and a busy key
    spreads over its buckets. Target days without events keep one row with NULL ``event_day``.
    """
    days = target_days(target, keys, target_ts).withColumnRenamed("day", "target_day")
    by_day = daily_events(events, keys, event_ts, {"n_events": F.count(F.lit(1))}).withColumnRenamed(
        "day", "event_day"
    )
    bucket = lambda day: F.floor(F.unix_date(day) / F.lit(31 * max_months))
    first = window_start(F.col("target_day"), max_months)
    last = F.col("target_day") if include_zero else F.date_sub("target_day", 1)
    touched = days.withColumn("bucket", F.explode(F.array_distinct(F.array(bucket(first), bucket(last)))))
    inside = F.col("event_day").between(first, last)
    met = (
        touched.join(by_day.withColumn("bucket", bucket(F.col("event_day"))), [*keys, "bucket"])
        .where(inside)
        .select(*keys, "target_day", "event_day", "n_events")
    )
    return days.join(met, [*keys, "target_day"], "left")
