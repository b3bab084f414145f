"""Wide item feature table from knowledge-graph triples.

Original: five row-wise correlated lookups, O(items x triples). Here: one join
of the triples of used codes with the entity URIs, the bare ids of all items
beside it, and one conditional aggregation per item.

* every item of the triple table appears once (A1), even when none of its
  triples has a known entity or a used property code (five NULLs);
* author, genre, series, publisher: the value of the *first* matching triple
  (A2), where "first" is entity-file order, then triple-file order. The order
  keys are explicit columns (``entity_order`` / ``triple_order``); with none
  given the entity id is the order, which is the case when ids were assigned
  in file order;
* subject: all subjects in that order, each followed by a comma (A3): ``a,b,``.
  NULL when the item has no usable subject.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.fixed_values import (
    PROP_AUTHOR,
    PROP_GENRE,
    PROP_PUBLISHER,
    PROP_SERIES,
    PROP_SUBJECT,
)
from shelfwise.functions.uri import clean_genre, clean_subject, strip_resource
from shelfwise.operators.skew import Join, plain_join

CODES = (PROP_AUTHOR, PROP_SERIES, PROP_GENRE, PROP_PUBLISHER, PROP_SUBJECT)


def _order_key(entity_order: str | None, triple_order: str | None) -> Column:
    fields = [F.col("_eo" if entity_order else "id").alias("e")]
    if triple_order:
        fields.append(F.col("_to").alias("t"))
    return F.struct(*fields)


def _entities(entities: DataFrame, entity_order: str | None) -> DataFrame:
    extra = [F.col(entity_order).alias("_eo")] if entity_order else []
    return entities.select("id", "prop", *extra)


def _first_ids(triples: DataFrame, entities: DataFrame, join: Join) -> DataFrame:
    """``triples`` without those that can't be an item's first of their code, where the entity id is the order.

    The smallest id that has a URI is found by numbers alone, before any URI is joined or
    aggregated; subjects all stay.
    """
    known = entities.where(F.col("prop").isNotNull()).select("id").distinct()
    single = join(triples.where(F.col("type") != PROP_SUBJECT), known, "id", "inner")
    first = single.groupBy("item_id", "type").agg(F.min("id").alias("id"))
    return first.select("item_id", "id", "type").unionByName(triples.where(F.col("type") == PROP_SUBJECT))


def item_features(
    item_prop: DataFrame,
    entities: DataFrame,
    entity_order: str | None = None,
    triple_order: str | None = None,
    join: Join = plain_join,
    codes: Collection[int] = CODES,
) -> DataFrame:
    """Return ``item_id, author, genre, series, publisher, subject``; features of other than ``codes`` are NULL.

    ``item_prop``: item_id, id, type [, triple_order]; ``entities``: id, prop
    [, entity_order]. Duplicate entity ids multiply rows, as a relational join
    does (subjects then repeat).
    """
    triples = item_prop.select(
        "item_id", "id", "type", *([F.col(triple_order).alias("_to")] if triple_order else [])
    )
    ents = _entities(entities, entity_order)
    # Only triples of used codes meet the entities (the filter reaches the scan);
    # items without any are kept by a bare row each, distinct before its shuffle.
    triples = used = triples.where(F.col("type").isin(*codes))
    if not entity_order and not triple_order:
        triples = _first_ids(triples, ents, join)
    joined = join(triples, ents, "id", "inner", like=used)
    typ, prop = F.col("type"), F.col("prop")
    # One cleaned value and one order key per triple, computed before the
    # aggregation instead of once per aggregate function.
    value = (
        F.when(typ == PROP_GENRE, clean_genre(prop))
        .when(typ == PROP_SUBJECT, clean_subject(prop))
        .when(typ.isin(PROP_AUTHOR, PROP_SERIES, PROP_PUBLISHER), strip_resource(prop))
    )
    order = F.when(prop.isNotNull(), _order_key(entity_order, triple_order))
    rows = joined.select("item_id", typ.alias("_t"), value.alias("_v"), order.alias("_o"))
    rows = rows.unionByName(item_prop.select("item_id").distinct(), allowMissingColumns=True)
    t, v, o = F.col("_t"), F.col("_v"), F.col("_o")

    def first_of(code: int) -> Column:
        # min_by skips rows whose ordering is NULL; a NULL *value* in first
        # place stays NULL (the first URI lacked the prefix).
        return F.min_by(v, F.when(t == code, o))

    subjects = F.array_sort(
        F.collect_list(F.when((t == PROP_SUBJECT) & o.isNotNull() & v.isNotNull(), F.struct(o.alias("o"), v.alias("v"))))
    )
    subject_str = F.when(
        F.size(subjects) > 0, F.concat(F.array_join(F.transform(subjects, lambda x: x["v"]), ","), F.lit(","))
    )
    return rows.groupBy("item_id").agg(
        first_of(PROP_AUTHOR).alias("author"),
        first_of(PROP_GENRE).alias("genre"),
        first_of(PROP_SERIES).alias("series"),
        first_of(PROP_PUBLISHER).alias("publisher"),
        subject_str.alias("subject"),
    )


def first_publisher(item_prop: DataFrame, entities: DataFrame, entity_order: str | None = None) -> DataFrame:
    """A2 alone: ``item_id, publisher`` for items with at least one publisher."""
    pubs = item_prop.where(F.col("type") == PROP_PUBLISHER).select("item_id", "id")
    ents = _entities(entities, entity_order)
    if not entity_order:  # the first id by numbers alone, before any URI is joined
        pubs = pubs.join(ents.select("id").distinct(), "id").groupBy("item_id").agg(F.min("id").alias("id"))
    order = _order_key(entity_order, None)
    return pubs.join(ents, "id").groupBy("item_id").agg(
        F.min_by(strip_resource(F.col("prop")), order).alias("publisher")
    )


def item_subjects(item_prop: DataFrame, entities: DataFrame, entity_order: str | None = None) -> DataFrame:
    """A3 + F3 alone: ``item_id, subject`` (ordered, trailing comma)."""
    subs = item_prop.where(F.col("type") == PROP_SUBJECT).select("item_id", "id")
    ents = _entities(entities, entity_order)
    order = _order_key(entity_order, None)
    v = clean_subject(F.col("prop"))
    arr = F.array_sort(F.collect_list(F.when(v.isNotNull(), F.struct(order.alias("o"), v.alias("v")))))
    return (
        subs.join(ents, "id")
        .groupBy("item_id")
        .agg(arr.alias("_a"))
        .where(F.size("_a") > 0)
        .select("item_id", F.concat(F.array_join(F.transform("_a", lambda x: x["v"]), ","), F.lit(",")).alias("subject"))
    )
