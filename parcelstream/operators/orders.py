"""Order / cargo facts (DWD layer).

* ``mask_order``            — sender/receiver name masking on the order image.
* ``fact_projection``        — the 28-column fact shared by all eight facts.
* ``place_order_facts``      — batch form of the order ⋈ cargo join.
* ``route_transitions``      — status-change label and fact routing.
* ``order_state_machine``    — exact batch twin of the per-order stream state:
  cargo-detail as-of with clear on sign/cancel, the order waiting ``window_ms``
  for cargo, place-order emission in both arrival orders, transition facts
  and the quarantine of updates without detail.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelstream import schemas
from parcelstream.functions.text import mask_name
from parcelstream.functions.timefn import (DEFAULT_TZ, estimate_arrive_text, iso_to_millis,
                                           millis_to_ymd_hms)
from parcelstream.operators.keyed_scan import asof_last

ORDER_FIELDS = [f.name for f in schemas.ORDER_INFO.fields]
CARGO_FIELDS = [f.name for f in schemas.ORDER_CARGO.fields]

# Output column order of every order fact (event-time column goes 8th).
CARGO_OUT = [("id", "id"), ("order_id", "order_id"), ("cargo_type", "cargo_type"),
             ("volume_length", "volumn_length"), ("volume_width", "volumn_width"),
             ("volume_height", "volumn_height"), ("weight", "weight")]
ORDER_OUT = ["order_no", "status", "collect_type", "user_id", "receiver_complex_id",
             "receiver_province_id", "receiver_city_id", "receiver_district_id",
             "receiver_name", "sender_complex_id", "sender_province_id", "sender_city_id",
             "sender_district_id", "sender_name", "payment_type", "cargo_num", "amount",
             "estimate_arrive_time", "distance"]

SIGN_FACT = schemas.TRANSITION_FACTS["60070 -> 60080"][0]
TERMINAL_FACTS = (SIGN_FACT, schemas.CANCEL_FACT[0])


def mask_order(order: Column) -> Column:
    """Order image with masked ``sender_name`` and ``receiver_name``."""
    return order.withField("sender_name", mask_name(order.getField("sender_name"))) \
                .withField("receiver_name", mask_name(order.getField("receiver_name")))


def fact_columns(cargo: Column, order: Column, time_name: str, time_from: str,
                 tz: str = DEFAULT_TZ) -> list[Column]:
    """The 28 fact columns from a cargo image and a (masked) order image.
    ``time_from`` is ``"cargo"`` (place order: cargo create time) or
    ``"order"`` (every other fact: order update time)."""
    src = cargo.getField("create_time") if time_from == "cargo" else order.getField("update_time")
    ms = iso_to_millis(src)
    cols = [cargo.getField(s).alias(o) for o, s in CARGO_OUT]
    cols.append(millis_to_ymd_hms(ms, tz).alias(time_name))
    for n in ORDER_OUT:
        if n == "estimate_arrive_time":
            cols.append(estimate_arrive_text(order.getField(n), tz).alias(n))
        else:
            cols.append(order.getField(n).alias(n))
    cols.append(ms.alias("ts"))
    return cols


def as_struct(df: DataFrame, fields: list[str]) -> Column:
    return F.struct(*[F.col(n) for n in fields])


def place_order_facts(order_info: DataFrame, order_cargo: DataFrame, tz: str = DEFAULT_TZ,
                      columns: Sequence[str] | None = None) -> DataFrame:
    """Batch form of the order ⋈ cargo join: every cargo row with its order.
    ``columns`` names the fact columns wanted; only the image fields that they
    come from enter the join (the planner does not see through the images).

    Equals the stream result whenever each cargo row arrives inside the
    order's waiting window.  A shuffle (sort-merge) join on the order id;
    AQE splits a hot order's partition (skew join) and may switch to a
    broadcast at run time when one side turns out small."""
    # Join on the numeric order key when both sides carry it (``id`` is its
    # text form, so the result is the same; hashing and sorting longs is
    # cheaper than strings), else on the text ids.
    numeric = "order_key" in order_info.columns and "order_key" in order_cargo.columns
    oid = F.col("order_key" if numeric else "id").alias("__oid")
    cid = F.col("order_key" if numeric else "order_id").alias("__cid")
    if columns is not None:
        order = [n for n in ORDER_OUT if n in columns]
        masked = {n: mask_name(n) for n in ("sender_name", "receiver_name") if n in order}
        cargo = [src for out, src in CARGO_OUT if out in columns]
        o = order_info.withColumns(masked).select(oid, *[F.col(n).alias(f"__o_{n}") for n in order])
        c = order_cargo.select(cid, *[F.col(n).alias(f"__c_{n}") for n in cargo],
                               F.col("create_time").alias("__c_create_time"))
        ms = iso_to_millis(F.col("__c_create_time"))
        made = {out: F.col(f"__c_{src}") for out, src in CARGO_OUT if out in columns}
        made |= {n: estimate_arrive_text(F.col(f"__o_{n}"), tz) if n == "estimate_arrive_time"
                 else F.col(f"__o_{n}") for n in order}
        made |= {schemas.PLACE_FACT[1]: millis_to_ymd_hms(ms, tz), "ts": ms}
        return c.join(o, c["__cid"] == o["__oid"]).select(*[made[n].alias(n) for n in columns])
    o = order_info.select(oid, mask_order(as_struct(order_info, ORDER_FIELDS)).alias("order"))
    c = order_cargo.select(cid, as_struct(order_cargo, CARGO_FIELDS).alias("cargo"))
    j = c.join(o, c["__cid"] == o["__oid"])
    return j.select(
        *fact_columns(F.col("cargo"), F.col("order"), schemas.PLACE_FACT[1], "cargo", tz))


def transition_label(before_status: Column, status: Column) -> Column:
    return F.concat_ws(" -> ", before_status, status)


def route_column(op: Column, table: Column, before_status: Column, status: Column) -> Column:
    """Fact name an order change is routed to, or null.

    Only ``u`` changes of ``order_info`` whose status really changed are
    candidates; six exact transitions have their own fact, any other change
    *to* 60999 is a cancel, everything else (e.g. 60030 -> 60040) emits
    nothing."""
    changed = ((table == "order_info") & (op == "u") & before_status.isNotNull()
               & status.isNotNull() & (before_status != status))
    label = transition_label(before_status, status)
    routed = None
    for lab, (fact, _) in schemas.TRANSITION_FACTS.items():
        routed = (F.when(label == lab, F.lit(fact)) if routed is None
                  else routed.when(label == lab, F.lit(fact)))
    routed = routed.when(status == schemas.ST_CANCELLED, F.lit(schemas.CANCEL_FACT[0]))
    return F.when(changed, routed)


FACT_TIME = {fact: tcol for fact, tcol in schemas.TRANSITION_FACTS.values()}
FACT_TIME[schemas.CANCEL_FACT[0]] = schemas.CANCEL_FACT[1]


def order_state_machine(log: DataFrame, window_ms: int = 5000) -> DataFrame:
    """Apply the per-order state rules to a clean change log.

    ``log`` columns: ``seq, ts_ms, op, table, order_key, status, before_status,
    order_after, cargo_after`` (images typed ORDER_INFO / ORDER_CARGO).

    Adds ``route`` (fact name or null), ``detail_seq`` (the cargo row the
    state holds *before* this row: latest cargo ``c`` row of the order,
    cleared after a sign or cancel) and, on cargo rows, ``stored_seq`` (the
    order waiting for cargo that this cargo joins: latest order ``c`` row
    that found no detail, still inside ``window_ms``).

    The scans carry only sequence numbers; row images are joined back for
    the rows that emit (on ``(order_key, seq)``, unique, so not skewed).
    """
    is_order = F.col("table") == "order_info"
    is_cargo_c = (F.col("table") == "order_cargo") & (F.col("op") == "c")
    is_order_c = is_order & (F.col("op") == "c")
    df = log.withColumn("order_after", F.when(is_order, mask_order(F.col("order_after"))))
    df = df.withColumn("route", route_column(F.col("op"), F.col("table"),
                                             F.col("before_status"), F.col("status")))
    upd = (F.when(is_cargo_c, F.struct(F.lit(False).alias("clear"), F.col("seq").alias("ref")))
           .when(F.col("route").isin(*TERMINAL_FACTS),
                 F.struct(F.lit(True).alias("clear"), F.lit(None).cast("long").alias("ref"))))
    df = asof_last(df, "order_key", ["ts_ms", "seq"], {"__d": upd}, keep_bucket=True)
    df = df.withColumn("detail_seq", F.when(~F.col("__d.clear"), F.col("__d.ref"))).drop("__d")
    store = F.when(is_order_c & F.col("detail_seq").isNull(),
                   F.struct(F.col("ts_ms").alias("at"), F.col("seq").alias("seq")))
    df = asof_last(df, "order_key", ["ts_ms", "seq"], {"__s": store})
    live = F.col("ts_ms") < F.col("__s.at") + F.lit(window_ms)
    return df.withColumn("stored_seq", F.when(is_cargo_c & live, F.col("__s.seq"))).drop("__s")


def _cargo_images(sm: DataFrame) -> DataFrame:
    return sm.filter((F.col("table") == "order_cargo") & (F.col("op") == "c")).select(
        F.col("order_key").alias("__ck"), F.col("seq").alias("__cs"),
        F.col("cargo_after").alias("detail"))


def _order_images(sm: DataFrame) -> DataFrame:
    return sm.filter((F.col("table") == "order_info") & (F.col("op") == "c")).select(
        F.col("order_key").alias("__ok"), F.col("seq").alias("__os"),
        F.col("order_after").alias("stored_order"))


def with_detail(rows: DataFrame, sm: DataFrame, how: str = "inner") -> DataFrame:
    """Attach the cargo image referenced by ``detail_seq``."""
    c = _cargo_images(sm)
    j = rows.join(c, (rows["order_key"] == c["__ck"]) & (rows["detail_seq"] == c["__cs"]), how)
    return j.drop("__ck", "__cs")


def place_order_from_state(sm: DataFrame, tz: str = DEFAULT_TZ) -> DataFrame:
    """Place-order facts in both arrival orders:
    order after cargo -> joins the latest cargo once; cargo after order ->
    every cargo inside the order's waiting window joins the stored order."""
    o = _order_images(sm)
    waiting = sm.filter(F.col("stored_seq").isNotNull())
    order_first = waiting.join(o, (waiting["order_key"] == o["__ok"])
                               & (waiting["stored_seq"] == o["__os"])).select(
        *fact_columns(F.col("cargo_after"), F.col("stored_order"), schemas.PLACE_FACT[1],
                      "cargo", tz))
    found = sm.filter((F.col("table") == "order_info") & (F.col("op") == "c")
                      & F.col("detail_seq").isNotNull())
    cargo_first = with_detail(found, sm).select(
        *fact_columns(F.col("detail"), F.col("order_after"), schemas.PLACE_FACT[1],
                      "cargo", tz))
    return order_first.unionByName(cargo_first)


def transition_facts(sm: DataFrame, fact: str, tz: str = DEFAULT_TZ) -> DataFrame:
    """One of the seven status-transition facts (rows with a detail)."""
    rows = sm.filter((F.col("route") == fact) & F.col("detail_seq").isNotNull())
    return with_detail(rows, sm).select(
        *fact_columns(F.col("detail"), F.col("order_after"), FACT_TIME[fact], "order", tz))


def orders_without_detail(sm: DataFrame) -> DataFrame:
    """Quarantine: routed updates that found no cargo detail, updates without
    a previous status, and orders that waited for cargo and never got any
    (expired or replaced by a newer waiting order)."""
    no_detail = F.col("route").isNotNull() & F.col("detail_seq").isNull()
    no_before = ((F.col("table") == "order_info") & (F.col("op") == "u")
                 & F.col("before_status").isNull())
    updates = sm.filter(no_detail | no_before).select(
        "seq", "ts_ms", F.col("order_key"), "status", "before_status",
        F.when(no_before, F.lit("no_before_status")).otherwise(F.lit("no_detail")).alias("reason"),
        F.col("route"))
    waited = sm.filter((F.col("table") == "order_info") & (F.col("op") == "c")
                       & F.col("detail_seq").isNull())
    joined = sm.filter(F.col("stored_seq").isNotNull()).select(
        "order_key", F.col("stored_seq").alias("seq")).distinct()
    expired = waited.join(joined, ["order_key", "seq"], "left_anti").select(
        "seq", "ts_ms", "order_key", "status", "before_status",
        F.lit("expired_without_cargo").alias("reason"), F.lit(None).cast("string").alias("route"))
    return updates.unionByName(expired)
