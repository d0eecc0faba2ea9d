"""One aggregation chain for a customer's own purchases and their other-product purchases.

Every purchase plays one or more *roles*:

- its **own** role, keyed by its own type (``target_w`` null, ``code`` = its flag:
  0 neither, 1 pre-closing, 2 closing week);
- one **other** role for each window of another type whose span contains the purchase
  time (``target_w`` = that window's number, ``code`` = 1 inside the window's closing
  week, else 0).

The roles come from one broadcast hash join of the purchases with an edition-sized
table of (time bucket, window) rows plus one *own* sentinel row per bucket; the exact
window bounds are the join's residual condition. The purchases are thus read once, and
a single chain of map-side-combined aggregations serves both measures:

1. ticket runs    rows dealt and sorted by (customer, target type, target window, code,
   ticket): a row that differs from the one before it in type or number starts a new
   ticket there, and the first row of all is the ticket's first edition
2. edition level  (customer, target type, target window, type, number)
3. pair level     (customer, target type): two arrays whose length is bounded by the
   number of editions and windows, never by the number of tickets.

The first shuffle is keyed by the ticket number as well (by the purchase, where there is
none), so a customer holding a third of all purchases still spreads over every task.
"""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edflux.constants import FLAG_CLOSING, FLAG_PRE
from edflux.functions.tickets import ticket_count
from edflux.operators.history import pair_prefix
from edflux.operators.others import WindowSpan, bucket_of, record_texts, run_index
from edflux.plans.broadcast import bounded_broadcast

PAIR = ["clave_persona", "objetivo_tipo"]
EDITION = PAIR + ["objetivo_ventana", "tipo_producto", "numero_sorteo"]
TICKET = EDITION + ["code", "numero_boleto"]
NO_TICKET_PARTS = 1024  # rows of one key without a ticket are dealt over so many parts

OWN_ONLY, OTHERS_ONLY, BOTH = "own", "others", "both"


def window_lookup(bucketed: DataFrame) -> DataFrame:
    """Bucketed windows plus one *own* sentinel per bucket (null window), edition-sized.

    Joined on the purchase's bucket, every purchase meets its bucket's sentinel (its own
    role) and the windows of that bucket (candidate other roles).
    """
    windows = bucketed.select(
        "bucket",
        F.col("objetivo_tipo").alias("t"),
        F.col("objetivo_ventana").alias("w"),
        F.col("w_ini").alias("ini"),
        F.col("w_fin").alias("fin"),
        F.col("w_cierre_ini").alias("sci"),
    )
    sentinels = windows.select("bucket").distinct().select(
        "bucket",
        F.lit(None).cast("int").alias("t"),
        F.lit(None).cast("int").alias("w"),
        F.lit(None).cast("timestamp_ntz").alias("ini"),
        F.lit(None).cast("timestamp_ntz").alias("fin"),
        F.lit(None).cast("timestamp_ntz").alias("sci"),
    )
    return windows.unionByName(sentinels)


def role_rows(flagged: DataFrame, lookup: DataFrame | None, span: WindowSpan | None, roles: str = BOTH) -> DataFrame:
    """Every purchase once per role (see module doc); purchases without a customer drop.

    The roles come from one broadcast hash join with a residual condition (codegen'd, no
    higher-order functions): the bucket's sentinel row or, outside every window's span,
    the outer join's null row gives the own role; matching windows give the others.
    """
    t = F.col("fecha_rotulacion_finalizacion")
    facts = flagged.where(F.col("clave_persona").isNotNull()).select(
        "clave_persona",
        "tipo_producto",
        "numero_sorteo",
        "flag",
        "numero_boleto",
        "clave_detalle_compra",
        "clave_edicion_producto",
        t,
    )
    keep = [c for c in facts.columns if c != "fecha_rotulacion_finalizacion"]
    if roles == OWN_ONLY or lookup is None or span is None or span.lo is None:
        if roles == OTHERS_ONLY:
            facts = facts.where(F.lit(False))
        return facts.select(
            *keep,
            F.col("tipo_producto").alias("objetivo_tipo"),
            F.lit(None).cast("int").alias("objetivo_ventana"),
            F.col("flag").cast("int").alias("code"),
        )
    in_range = (t >= F.lit(span.lo.isoformat(sep=" ")).cast("timestamp_ntz")) & (
        t <= F.lit(span.hi.isoformat(sep=" ")).cast("timestamp_ntz")
    )
    # Purchases outside every window get bucket values below the lookup's smallest bucket:
    # they match only the outer join's null row, and spread over 64 keys instead of one
    # null key if the join has to shuffle.
    lowest = (span.lo.date() - date(1970, 1, 1)).days // span.width_days
    outside = F.lit(lowest - 1) - F.pmod(F.xxhash64("clave_detalle_compra"), F.lit(64))
    keyed = facts.withColumn("bucket", F.when(in_range, bucket_of(t, span.width_days)).otherwise(outside))
    lk = lookup.withColumnRenamed("bucket", "lk_bucket")
    # Broadcast when the lookup is within its bound; beyond it, a shuffle join on the
    # bucket, where adaptive execution splits buckets that hold too many purchases.
    lk = F.broadcast(lk) if span.fits else lk
    own_row = lk["w"].isNull()
    other_row = (lk["t"] != keyed["tipo_producto"]) & (t >= lk["ini"]) & (t <= lk["fin"])
    cond = (keyed["bucket"] == lk["lk_bucket"]) & (own_row | other_row)
    joined = keyed.join(lk, cond, "left")
    is_own = F.col("w").isNull()
    out = joined.select(
        *keep,
        F.when(is_own, F.col("tipo_producto")).otherwise(F.col("t")).alias("objetivo_tipo"),
        F.col("w").alias("objetivo_ventana"),
        F.when(is_own, F.col("flag").cast("int"))
        .when((t >= F.col("sci")) & (t <= F.col("fin")), F.lit(1))
        .otherwise(F.lit(0))
        .alias("code"),
    )
    if roles == OTHERS_ONLY:
        out = out.where(F.col("objetivo_ventana").isNotNull())
    return out


def ticket_level(roles: DataFrame) -> DataFrame:
    """One row per (customer, role, type, number, code, ticket) with its purchase rows."""
    return roles.groupBy(*TICKET).agg(F.count(F.lit(1)).alias("n_rows"))


def ticket_runs(roles: DataFrame) -> DataFrame:
    """Every role row, marked where its ticket starts in an edition and where it starts at all.

    ``starts``: the first row of its ticket in that (type, number); ``is_new``: the first row of
    its ticket (lowest type and number). Both are false without a ticket. Rows without a
    ticket need no neighbour, so they are dealt by their purchase.
    """
    ticket = F.col("numero_boleto")
    dealt = roles.withColumn("_none", F.when(ticket.isNull(), F.pmod(F.xxhash64("clave_detalle_compra"), F.lit(NO_TICKET_PARTS))))
    run = Window.partitionBy(*PAIR, "objetivo_ventana", "code", "numero_boleto", "_none").orderBy("tipo_producto", "numero_sorteo")
    before = {"_tp": F.lag("tipo_producto").over(run), "_ns": F.lag("numero_sorteo").over(run)}
    first = F.col("_ns").isNull()
    other = (F.col("_tp") != F.col("tipo_producto")) | (F.col("_ns") != F.col("numero_sorteo"))
    marks = {"starts": ticket.isNotNull() & (first | other), "is_new": ticket.isNotNull() & first}
    return dealt.withColumns(before).withColumns(marks).drop("_tp", "_ns", "_none")


def purchase_rank(key: Column, edition: Column) -> Column:
    """A total order of purchases for "the first": by purchase key (null last), then by edition key.

    Both keys stand in one decimal of 38 digits, which (unlike a struct) hash aggregation can
    update in place. Purchases with both keys equal have the same edition, so what is
    taken from the first row doesn't depend on the order of rows.
    """
    key = F.coalesce(key, F.lit(2**63 - 1)).cast("decimal(38,0)")
    return (key * F.lit(Decimal(10**19)) + edition).cast("decimal(38,0)")


def _count(code: int, marked: Column | None = None) -> Column:
    held = F.col("code") == code
    return F.count_if(held if marked is None else held & marked)


def edition_level(runs: DataFrame) -> DataFrame:
    """Per (customer, role, type, number): the ticket rule per code, and new tickets.

    A ticket is *new* at the lowest number where it appears for that customer, target
    type, window and code; summing new tickets below a number gives the distinct tickets
    over all those editions together.
    """
    starts, is_new = F.col("starts"), F.col("is_new")
    first = purchase_rank(F.col("clave_detalle_compra"), F.col("clave_edicion_producto"))
    agg = (
        runs.withColumn("rank", first)
        .groupBy(*EDITION)
        .agg(
            _count(0).alias("rows0"),
            _count(0, starts).alias("tickets0"),
            _count(FLAG_PRE).alias("rows1"),
            _count(FLAG_PRE, starts).alias("tickets1"),
            _count(FLAG_CLOSING).alias("rows2"),
            _count(FLAG_CLOSING, starts).alias("tickets2"),
            _count(FLAG_PRE, is_new).alias("new1"),
            _count(FLAG_CLOSING, is_new).alias("new2"),
            F.min_by("clave_edicion_producto", F.col("rank")).alias("cep"),
        )
    )
    return agg.select(
        *EDITION,
        "rows0",
        "rows1",
        "rows2",
        ticket_count(F.col("tickets0"), F.col("rows0")).alias("count0"),
        ticket_count(F.col("tickets1"), F.col("rows1")).alias("count1"),
        ticket_count(F.col("tickets2"), F.col("rows2")).alias("count2"),
        "new1",
        "new2",
        "cep",
    )


def with_end(editions: DataFrame, ends: DataFrame) -> DataFrame:
    """The edition level with ``fin``, the end of its edition, which no shuffle below has to carry.

    ``ends`` holds one row per edition key and is broadcast after a size check.
    """
    ends = ends.select(F.col("clave_edicion_producto").alias("cep"), F.col("fecha_fin").alias("fin"))
    return editions.join(bounded_broadcast(ends), "cep", "left")


def own_editions(editions: DataFrame) -> DataFrame:
    """Edition level of the own role, named as the inventory names it."""
    return editions.where(F.col("objetivo_ventana").isNull()).select(
        "clave_persona",
        "tipo_producto",
        "numero_sorteo",
        F.col("rows1").alias("pre_rows"),
        F.col("rows2").alias("closing_rows"),
        F.col("count1").alias("pre"),
        F.col("count2").alias("closing"),
        F.col("new1").alias("new_pre"),
        F.col("new2").alias("new_closing"),
        F.col("cep").alias("clave_edicion_producto"),
        F.col("fin").alias("fecha_fin"),
    )


def other_editions(editions: DataFrame) -> DataFrame:
    """Edition level of the other roles: closing-week and outside tickets per other edition."""
    return editions.where(F.col("objetivo_ventana").isNotNull()).select(
        "clave_persona",
        "objetivo_tipo",
        "objetivo_ventana",
        F.col("tipo_producto").alias("tp2"),
        F.col("numero_sorteo").alias("ns2"),
        F.col("cep").alias("cep2"),
        F.col("count1").alias("en_cierre"),
        F.col("count0").alias("fuera_cierre"),
    )


def pair_level(editions: DataFrame) -> DataFrame:
    """Per (customer, type) *that the customer bought*: own prefix arrays and ``od`` (others).

    The own editions are collected sorted by number and turned into the arrays of
    ``history.pair_prefix`` once per pair, before the rows are multiplied by windows; the
    others into the runs of ``others.run_index`` and the JSON texts of their records, which
    are longer than the records and written only after these were shuffled.
    """
    own = F.col("objetivo_ventana").isNull()
    ed = F.struct(
        F.col("numero_sorteo").alias("ns"),
        F.col("rows1").alias("pre_rows"),
        F.col("rows2").alias("closing_rows"),
        F.col("count1").alias("pre"),
        F.col("count2").alias("closing"),
        F.col("new1").alias("new_pre"),
        F.col("new2").alias("new_closing"),
        "cep",
        "fin",
    )
    od = F.struct(
        F.col("objetivo_ventana").alias("w"),
        F.col("tipo_producto").alias("tp2"),
        F.col("numero_sorteo").alias("ns2"),
        F.col("cep").alias("cep2"),
        F.col("count1").alias("en_cierre"),
        F.col("count0").alias("fuera_cierre"),
    )
    pairs = (
        # The records are made in a step of their own: aggregation into lists doesn't compile them.
        editions.select(*PAIR, F.when(own, ed).alias("ed"), F.when(~own, od).alias("od"))
        .groupBy(*PAIR)
        .agg(
            F.sort_array(F.collect_list("ed")).alias("ed"),
            # Sorted by (window, type, number) once per pair: a window's entries are then
            # an ordered run.
            F.sort_array(F.collect_list("od")).alias("od"),
        )
        .where(F.size("ed") > 0)
        .withColumnRenamed("objetivo_tipo", "tipo_producto")
    )
    arrays = pair_prefix(F.col("ed"), F.col("tipo_producto")) | run_index(F.col("od")) | record_texts(F.col("od"))
    return pairs.select("clave_persona", "tipo_producto", *[c.alias(k) for k, c in arrays.items()], "od")
