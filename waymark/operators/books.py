"""Feature books: one row per (entity, item), anchored at the latest time the item was received.

Two modes. ``reference`` keeps the published definitions, made deterministic by
a total order (t, event, item) among equal times. ``point_in_time`` counts only
what happened strictly before the anchor instant and drops the definitions'
off-by-one subtractions and looks into the future.

All books that read the entity's history take their columns from one table,
``anchor_history``: its windows share a single exchange on the entity, and
Spark drops the windows a book does not use.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.functions.columns import duration_bucket, flag, null_if, pair_key, rate, value_bucket, year_of
from waymark.operators.events import purchases, received, with_items
from waymark.operators.frames import CELL, Frames, latest, most_recent, rows, total
from waymark.spec import (
    ANCHOR_TIME, BOOK_KEYS, CHANNELS, DEFAULT, ENTITY, EVENT, ITEM, ITEM_COLUMNS, KEY, TIME, EventSpec,
)

REFERENCE, POINT_IN_TIME = "reference", "point_in_time"
UNINFORMED_AGE = 118
HISTORY_ORDER = [TIME, EVENT, ITEM]
# Moving counts with the kind of event they count (purchase, received, viewed, conversion) and their days.
MOVING = {
    "qtd_transacoes_7d": ("x", 7), "qtd_transacoes_14d": ("x", 14), "qtd_ofertas_recebidas_14d": ("r", 14),
    "qtd_ofertas_visualizadas_14d": ("v", 14), "qtd_conversoes_validas_14d": ("k", 14),
}


def timeline(log: DataFrame, conversions: DataFrame | None, spec: EventSpec = DEFAULT, frames: Frames = Frames()) -> DataFrame:
    """Every event with its flags; all events at a conversion's instant carry its flag.

    The conversions join the log's own timeline as marker rows and are spread
    by a window, so that the only exchange is the one on the entity that the
    history frames need anyway.
    """
    if conversions is None:
        flagged = frames.gather(log, ENTITY).withColumn("is_conv_valid", F.lit(0))
    else:
        marked = log.withColumn("__mark", F.lit(0)).unionByName(
            conversions.select(ENTITY, TIME, F.lit(1).alias("__mark")), allowMissingColumns=True
        )
        instant = Window.partitionBy(ENTITY, TIME).orderBy(EVENT, ITEM).rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing
        )
        flagged = frames.gather(marked, ENTITY).withColumn("is_conv_valid", F.max("__mark").over(instant))
        flagged = flagged.filter("__mark = 0").drop("__mark")
    kind = F.col(EVENT)
    return flagged.withColumns({
        "is_offer_received": flag(kind == spec.received),
        "is_offer_viewed": flag(kind == spec.viewed),
        "is_offer_completed": flag(kind == spec.completed),
        "is_transaction": flag(kind == spec.purchase),
    })


def _when(name: str) -> Column:
    return F.when(F.col(name) == 1, F.col(TIME))


def anchor_history(
    log: DataFrame,
    items: DataFrame,
    conversions: DataFrame | None,
    spec: EventSpec = DEFAULT,
    frames: Frames = Frames(),
    mode: str = REFERENCE,
) -> DataFrame:
    """Received events with everything the entity did before them."""
    exact = mode == POINT_IN_TIME
    line = with_items(timeline(log, conversions, spec, frames), items, CHANNELS)
    sent = F.col("is_offer_received") if exact else F.lit(1)
    # A conversion is one event: the purchase at its instant carries it.
    converted = F.col("is_conv_valid") * F.col("is_transaction")
    measures = {
        "n_received": total(F.col("is_offer_received")),
        "n_completed": total(F.col("is_offer_completed")),
        "n_viewed": total(F.col("is_offer_viewed")),
        "n_purchases": total(F.col("is_transaction")),
        "n_converted": total(converted),
        "last_purchase": latest(_when("is_transaction")),
        "first_purchase": latest(-_when("is_transaction")),
        "n_purchase_days": total(F.col("__new_day")),
        "last_received": latest(_when("is_offer_received")),
        "last_viewed": latest(_when("is_offer_viewed")),
        "last_conversion": latest(F.when(converted == 1, F.col(TIME)) if exact else _when("is_conv_valid")),
        **{f"n_{c}": total(F.col(c) * sent) for c in CHANNELS},
    }
    if exact:
        line = _mark_new_days(line, frames)
        line = frames.gather(line, ENTITY)
    else:
        line = line.withColumn("__new_day", F.lit(0))
    line = frames.earlier(line, [ENTITY], HISTORY_ORDER, measures)
    strict = list(measures) if exact else ["n_converted"]
    line = frames.tick_start(line, [ENTITY], HISTORY_ORDER, {n: n for n in strict})
    line = line.withColumn("t_sec", (F.col(TIME) * F.lit(86400)).cast("long"))
    anchor = (F.col(EVENT) == spec.received) & F.col(ITEM).isNotNull()
    moved = F.col("is_conv_valid") * F.col("is_transaction") if exact else F.col("is_conv_valid")
    values = {"x": F.col("is_transaction"), "r": F.col("is_offer_received"), "v": F.col("is_offer_viewed"), "k": moved}
    line = frames.trailing(line, ENTITY, "t_sec", {n: (values[v], days) for n, (v, days) in MOVING.items()}, anchor)
    return line.withColumns({KEY: pair_key(), ANCHOR_TIME: F.col(TIME)})


def _mark_new_days(line: DataFrame, frames: Frames) -> DataFrame:
    """Flag the first purchase of each whole day, so that days can be counted by a running sum."""
    before = frames.earlier(line, [ENTITY], HISTORY_ORDER, {"__bought": latest(_when("is_transaction"))})
    new = F.col("__bought").isNull() | (F.floor("__bought") < F.floor(TIME))
    return before.withColumn("__new_day", F.when(new, F.col("is_transaction")).otherwise(0)).drop("__bought")


def latest_pairs(df: DataFrame) -> DataFrame:
    """The most recent row of each (entity, item) with an item."""
    rest = [F.asc(c) for c in df.columns if c not in BOOK_KEYS]
    return most_recent(df.filter(F.col(ITEM).isNotNull()), [ENTITY, ITEM], [F.desc(ANCHOR_TIME), *rest])


Columns = dict[str, Column]


def profile_columns(mode: str = REFERENCE) -> Columns:
    sent = F.col("n_received") - (0 if mode == POINT_IN_TIME else 1)
    return {"historico_conversao": rate(F.col("n_completed"), sent)}


def profile_of(entities: DataFrame) -> DataFrame:
    return entities.select(
        F.col("profile_id").alias(ENTITY),
        null_if(F.col("age"), UNINFORMED_AGE).alias("idade"),
        F.col("gender").alias("genero"),
        F.col("credit_card_limit").alias("limite_credito"),
        year_of(F.col("registered_on")).alias("safra_registro"),
    )


def last_of(history: DataFrame, columns: Columns) -> DataFrame:
    """The named columns at each pair's latest anchor."""
    return latest_pairs(history.select(*BOOK_KEYS, *[c.alias(n) for n, c in columns.items()]))


def book_profile(history: DataFrame, entities: DataFrame, mode: str = REFERENCE) -> DataFrame:
    """Who the entity is, and the share of earlier items it completed.

    The entity table joins after the reduction to one row per pair.
    """
    return last_of(history, profile_columns(mode)).join(profile_of(entities), ENTITY, "left").select(
        *BOOK_KEYS, "idade", "genero", "limite_credito", "safra_registro", "historico_conversao"
    )


def purchase_rhythm(log: DataFrame, spec: EventSpec = DEFAULT) -> DataFrame:
    """Mean gap between an entity's purchases and its number of purchase days.

    The gaps of an ordered series add up to its range, so no window is needed.
    """
    bought = purchases(log, spec)
    return bought.groupBy(ENTITY).agg(
        F.try_divide(F.max("t_tx") - F.min("t_tx"), F.count("t_tx") - 1).alias("media_tempo_entre_transacoes"),
        F.count_distinct(F.floor("t_tx")).alias("transacoes_distintas_dias"),
    )


RHYTHM = ["media_tempo_entre_transacoes", "transacoes_distintas_dias"]


def purchase_columns(mode: str = REFERENCE) -> Columns:
    columns = {
        "qtd_transacoes_anteriores": F.col("n_purchases"),
        "dias_desde_ultima_transacao": F.col(TIME) - F.col("last_purchase"),
    }
    if mode == POINT_IN_TIME:
        # first_purchase holds the negated time of the first purchase.
        columns[RHYTHM[0]] = F.try_divide(F.col("last_purchase") + F.col("first_purchase"), F.col("n_purchases") - 1)
        columns[RHYTHM[1]] = F.col("n_purchase_days")
    return columns


def book_purchases(history: DataFrame, log: DataFrame, spec: EventSpec = DEFAULT, mode: str = REFERENCE) -> DataFrame:
    """How often and how recently the entity bought."""
    last = last_of(history, purchase_columns(mode))
    if mode == POINT_IN_TIME:
        return last
    return last.join(purchase_rhythm(log, spec), ENTITY, "left").select(*last.columns, *RHYTHM)


def instances(
    log: DataFrame,
    items: DataFrame,
    conversions: DataFrame,
    spec: EventSpec = DEFAULT,
    frames: Frames = Frames(),
    mode: str = REFERENCE,
) -> DataFrame:
    """Received items with their first view, first conversion, flags and buckets.

    ``reference`` takes the first view and conversion of the (entity, item)
    pair for every repeat; ``point_in_time`` those of the repeat's own span.
    """
    if mode == POINT_IN_TIME:
        base = _own_span_firsts(log, items, conversions, spec, frames)
    else:
        base = _pair_firsts(log, conversions, spec, frames)
    return with_items(base, items).withColumns({
        KEY: pair_key(),
        "view_flag": F.col("first_t_view").isNotNull().cast("int"),
        "conv_flag": F.col("first_t_conv_valid").isNotNull().cast("int"),
        "bucket_duracao": duration_bucket(F.col("duration")),
        "bucket_desconto": value_bucket(F.col("discount_value")),
        "bucket_minimo": value_bucket(F.col("min_value")),
    })


def _pair_firsts(log: DataFrame, conversions: DataFrame, spec: EventSpec, frames: Frames) -> DataFrame:
    """First view and conversion of the pair, for each of its repeats.

    Ordinary histories gather by entity once and read the firsts over a window.
    Cut ones aggregate first and meet their repeats range by range.
    """
    time, nothing = F.col(TIME), F.lit(None).cast("double")
    starts = received(log, spec).select(ENTITY, ITEM, time.alias("start_t"), nothing.alias("v"), nothing.alias("c"))
    marks = (
        log.filter(F.col(EVENT) == spec.viewed).select(ENTITY, ITEM, nothing.alias("start_t"), time.alias("v"), nothing.alias("c"))
        .unionByName(conversions.select(ENTITY, ITEM, nothing.alias("start_t"), nothing.alias("v"), time.alias("c")))
    )
    pair = Window.partitionBy(ENTITY, ITEM)

    def over_pairs(part_of) -> DataFrame:
        line = part_of(starts.unionByName(marks)).repartition(ENTITY)
        firsts = line.withColumns({"first_t_view": F.min("v").over(pair), "first_t_conv_valid": F.min("c").over(pair)})
        return firsts.filter(F.col("start_t").isNotNull()).drop("v", "c")

    if not frames.cut:
        return over_pairs(lambda df: df)
    firsts = frames.only_cut(marks).groupBy(ENTITY, ITEM).agg(F.min("v").alias("first_t_view"), F.min("c").alias("first_t_conv_valid"))
    firsts = frames.every_cell(firsts).select(F.col(ENTITY).alias("__e"), F.col(ITEM).alias("__i"), F.col(CELL).alias("__n"), "first_t_view", "first_t_conv_valid")
    same = F.col(ENTITY).eqNullSafe(F.col("__e")) & F.col(ITEM).eqNullSafe(F.col("__i")) & (F.col(CELL) == F.col("__n"))
    long = frames.placed(frames.only_cut(starts), "start_t").join(firsts, same, "left")
    return over_pairs(frames.never_cut).unionByName(long.select(ENTITY, ITEM, "start_t", "first_t_view", "first_t_conv_valid"))


def _own_span_firsts(log: DataFrame, items: DataFrame, conversions: DataFrame, spec: EventSpec, frames: Frames) -> DataFrame:
    """First view and conversion in each repeat's own span.

    Views belong to the latest repeat at or before them, found as a running
    maximum on the pair's timeline. Conversions carry their start already.
    """
    time, nothing = F.col(TIME), F.lit(None).cast("double")
    marks = received(log, spec).select(ENTITY, ITEM, time.alias("at"), F.lit(0).alias("k"))
    seen = log.filter(F.col(EVENT) == spec.viewed).select(ENTITY, ITEM, time.alias("at"), F.lit(1).alias("k"))
    placed = frames.earlier(
        frames.gather(marks.unionByName(seen), ENTITY), [ENTITY, ITEM], ["at", "k"],
        {"start_t": latest(F.when(F.col("k") == 0, F.col("at")))}, time="at", frame=(Window.unboundedPreceding, 0),
    )
    events = placed.select(ENTITY, ITEM, "start_t", F.when(F.col("k") == 1, F.col("at")).alias("v"), nothing.alias("c"))
    earned = conversions.select(ENTITY, ITEM, "start_t", nothing.alias("v"), time.alias("c"))
    spans = with_items(events.unionByName(earned).filter(F.col("start_t").isNotNull()), items, ["duration"])
    inside = F.col("v") <= F.col("start_t") + F.col("duration")
    return spans.groupBy(ENTITY, ITEM, "start_t").agg(
        F.min(F.when(inside, F.col("v"))).alias("first_t_view"), F.min("c").alias("first_t_conv_valid")
    )


INSTANCE_ORDER = ["start_t", ITEM]


RESPONSE = ["tempo_medio_visualizacao", "tempo_medio_conversao"]


def response_times(spans: DataFrame, frames: Frames = Frames(), mode: str = REFERENCE) -> DataFrame:
    """Add the mean time to view and to convert over the repeats before each received item.

    ``reference``: each repeat has the running mean of the repeats before it,
    and an anchor takes the largest of those at strictly earlier times.
    ``point_in_time``: the mean over repeats at strictly earlier times.
    """
    seen = F.col("first_t_view") - F.col("start_t")
    earned = F.col("first_t_conv_valid") - F.col("first_t_view")
    parts = ["sv", "nv", "sc", "nc"]
    df = frames.earlier(frames.gather(spans, ENTITY), [ENTITY], INSTANCE_ORDER, {
        "sv": total(F.coalesce(seen, F.lit(0.0))), "nv": total(seen.isNotNull().cast("int")),
        "sc": total(F.coalesce(earned, F.lit(0.0))), "nc": total(earned.isNotNull().cast("int")),
    }, time="start_t")
    means = dict(zip(RESPONSE, [rate(F.col("sv"), F.col("nv"), None), rate(F.col("sc"), F.col("nc"), None)]))
    if mode == POINT_IN_TIME:
        df = frames.tick_start(df, [ENTITY], INSTANCE_ORDER, {n: n for n in parts}, time="start_t").withColumns(means)
    else:
        df = df.withColumns({f"__{n}": m for n, m in means.items()})
        df = frames.earlier(df, [ENTITY], INSTANCE_ORDER, {n: latest(F.col(f"__{n}")) for n in RESPONSE}, time="start_t")
        df = frames.tick_start(df, [ENTITY], INSTANCE_ORDER, {n: n for n in RESPONSE}, time="start_t")
    return df.drop(*parts, *[f"__{n}" for n in RESPONSE])


def interaction_columns() -> Columns:
    won = F.coalesce("n_converted", F.lit(0))
    return {
        "qtd_ofertas_anteriores": F.col("n_received"), "qtd_ofertas_visualizadas": F.col("n_viewed"),
        "qtd_ofertas_completas_validas": won,
        "taxa_visualizacao": rate(F.col("n_viewed"), F.col("n_received")), "taxa_conversao": rate(won, F.col("n_received")),
    }


def book_interaction(history: DataFrame, spans: DataFrame, frames: Frames = Frames(), mode: str = REFERENCE) -> DataFrame:
    """How the entity reacted to earlier items."""
    last = last_of(history, interaction_columns())
    times = last_of(
        response_times(spans, frames, mode).withColumn(ANCHOR_TIME, F.col("start_t")), {n: F.col(n) for n in RESPONSE}
    )
    return last.join(times.drop(KEY, ANCHOR_TIME), [ENTITY, ITEM], "left").select(*last.columns, *RESPONSE)


def book_offer(log: DataFrame, items: DataFrame, spec: EventSpec = DEFAULT) -> DataFrame:
    """Properties of the item itself; only received events are read."""
    last = received(log, spec).groupBy(ENTITY, ITEM).agg(F.max(TIME).alias(ANCHOR_TIME)).withColumn(KEY, pair_key())
    return with_items(last, items).select(*BOOK_KEYS, *ITEM_COLUMNS)


def recency_columns() -> Columns:
    since = {
        "dias_desde_ultima_transacao": "last_purchase", "dias_desde_ultima_oferta_recebida": "last_received",
        "dias_desde_ultima_oferta_visualizada": "last_viewed", "dias_desde_ultima_conversao_valida": "last_conversion",
    }
    return {**{n: F.col(TIME) - F.col(c) for n, c in since.items()}, **{n: F.col(n) for n in MOVING}}


def book_recency(history: DataFrame) -> DataFrame:
    """Time since the last event of each kind and counts over the last 7 and 14 days."""
    return last_of(history, recency_columns())


def communication_columns(mode: str = REFERENCE) -> Columns:
    before = {c: F.col(f"n_{c}") - (F.lit(0) if mode == POINT_IN_TIME else F.col(c)) for c in CHANNELS}
    everything = _sum(before.values())
    return {
        "canais_recebidos_total": _sum(F.col(c) for c in CHANNELS),
        **{f"recebeu_{c}": F.col(c) for c in CHANNELS},
        "canais_preferidos": _sum((b > 0).cast("int") for b in before.values()),
        **{f"{c}_ratio_historico": rate(b, everything) for c, b in before.items()},
    }


def _sum(columns) -> Column:
    return reduce(lambda a, b: a + b, columns)


def book_communication(history: DataFrame, mode: str = REFERENCE) -> DataFrame:
    """Channels of this item and of the items before it."""
    return last_of(history, communication_columns(mode))


# Prefix of the prior counts and the column that defines "the same kind of item".
SAME_KIND = {"tipo": "tipo_ou_vazio", "oferta": ITEM, "dur": "bucket_duracao", "disc": "bucket_desconto", "min": "bucket_minimo"}


def composite_counts(spans: DataFrame, frames: Frames = Frames(), mode: str = REFERENCE) -> DataFrame:
    """Received, viewed and converted repeats before each one, by entity and kind of item."""
    converted = F.col("conv_flag")
    # An item the catalogue lacks has no type; such items form one kind.
    spans = spans.withColumn("tipo_ou_vazio", F.coalesce("offer_type", F.lit("")))
    groups = []
    for prefix, column in SAME_KIND.items():
        names = {f"rcv_{prefix}": rows(), f"view_{prefix}": total(F.col("view_flag")), f"conv_{prefix}": total(converted)}
        if column == ITEM:
            names["last_start"] = latest(F.col("start_t"))
        groups.append(([ENTITY, column], names))
    channels = {}
    for c in CHANNELS:
        channels[f"rcv_{c}"] = total(flag(F.col(c) == 1))
        channels[f"conv_{c}"] = total(flag((F.col(c) == 1) & (converted == 1)))
    groups.append(([ENTITY], channels))
    spans = frames.earlier_each(frames.gather(spans, ENTITY), groups, INSTANCE_ORDER, time="start_t")
    if mode == POINT_IN_TIME:
        for keys, names in groups:
            spans = frames.tick_start(spans, keys, INSTANCE_ORDER, {n: n for n in names}, time="start_t")
    return spans


def previous_conversion(conversions: DataFrame) -> DataFrame:
    """The second latest conversion of each (entity, item): the largest one before the last."""
    w = Window.partitionBy(ENTITY, ITEM).orderBy(F.desc(TIME))
    return conversions.withColumn("__rn", F.row_number().over(w)).filter("__rn <= 2").groupBy(ENTITY, ITEM).agg(
        F.max(F.when(F.col("__rn") == 2, F.col(TIME))).alias("last_t_conv_same_offer")
    )


def pair_columns() -> Columns:
    def of(prefix: str, what: str) -> Column:
        return rate(F.col(f"{what}_{prefix}"), F.col(f"rcv_{prefix}"))

    channel = {c: of(c, "conv") for c in CHANNELS}
    active = _sum(F.coalesce(F.when(F.col(c) == 1, channel[c]), F.lit(0.0)) for c in CHANNELS)
    return {
        "taxa_visualizacao_historica_tipo": of("tipo", "view"), "taxa_conversao_historica_tipo": of("tipo", "conv"),
        "taxa_visualizacao_historica_oferta": of("oferta", "view"), "taxa_conversao_historica_oferta": of("oferta", "conv"),
        **{f"taxa_conversao_historica_canal_{c}": r for c, r in channel.items()},
        "afinidade_canais_conv": rate(active, _sum(F.col(c) for c in CHANNELS)),
        "taxa_conversao_historica_bucket_duracao": of("dur", "conv"),
        "taxa_conversao_historica_bucket_desconto": of("disc", "conv"),
        "taxa_conversao_historica_bucket_minimo": of("min", "conv"),
        "n_instancias_anteriores_mesma_oferta": F.col("rcv_oferta"),
        "n_conversoes_validas_anteriores_mesma": F.col("conv_oferta"),
        "dias_desde_ultima_oferta_mesma": F.col("start_t") - F.col("last_start"),
    }


def since_conversion(last: DataFrame, conversions: DataFrame, mode: str = REFERENCE) -> DataFrame:
    """Add the days from the pair's previous conversion to its anchor."""
    if mode == POINT_IN_TIME:
        found = last.select(ENTITY, ITEM, F.col(ANCHOR_TIME).alias("a")).join(conversions.select(ENTITY, ITEM, TIME), [ENTITY, ITEM])
        found = found.filter(F.col(TIME) < F.col("a")).groupBy(ENTITY, ITEM).agg(F.max(TIME).alias("last_t_conv_same_offer"))
    else:
        found = previous_conversion(conversions)
    days = F.col(ANCHOR_TIME) - F.col("last_t_conv_same_offer")
    return last.join(found, [ENTITY, ITEM], "left").select(*last.columns, days.alias("dias_desde_ultima_conversao_valida_mesma"))


def book_pair(spans: DataFrame, conversions: DataFrame, frames: Frames = Frames(), mode: str = REFERENCE) -> DataFrame:
    """How the entity reacted to the same item and to items like it."""
    df = composite_counts(spans, frames, mode).withColumn(ANCHOR_TIME, F.col("start_t"))
    return since_conversion(last_of(df, pair_columns()), conversions, mode)


def wide_books(
    history: DataFrame,
    spans: DataFrame,
    conversions: DataFrame,
    log: DataFrame,
    items: DataFrame,
    entities: DataFrame,
    spec: EventSpec = DEFAULT,
    frames: Frames = Frames(),
    mode: str = REFERENCE,
) -> DataFrame:
    """The features of all books: one pass over the history, one over the received items, then joins of one row per pair."""
    bought = purchase_columns(mode)
    recent = {f"recencia__{n}" if n in bought else n: c for n, c in recency_columns().items()}
    last = last_of(history, {
        **profile_columns(mode), **bought, **interaction_columns(), **recent, **communication_columns(mode),
    })
    counted = composite_counts(response_times(spans, frames, mode), frames, mode).withColumn(ANCHOR_TIME, F.col("start_t"))
    own = last_of(counted, {**{n: F.col(n) for n in RESPONSE}, **pair_columns()})
    both = last.join(own.drop(KEY, ANCHOR_TIME), [ENTITY, ITEM], "left")
    both = with_items(since_conversion(both, conversions, mode), items)
    both = both.join(profile_of(entities), ENTITY, "left")
    if mode == REFERENCE:
        both = both.join(purchase_rhythm(log, spec), ENTITY, "left")
    return both.select(*BOOK_KEYS, *[c for c in both.columns if c not in BOOK_KEYS])
